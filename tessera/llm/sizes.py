"""Broadcasts of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """A written table with the broadcast hint if it has at most ``max_rows`` rows; else unchanged, and
    Spark joins it by a shuffle.  The caller names a bound that suits its row width."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
