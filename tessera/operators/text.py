"""Text operators: tokenising and word counting (map-side combined)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import tokens as _tokens


def tokens(lines: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per token of each line, with its position ``pos`` (0-based)."""
    return lines.select(*keep, F.posexplode(_tokens(value)).alias("pos", "word"))


def word_count(lines: DataFrame, value: str = "value") -> DataFrame:
    """``word, n``: count of each token over all lines.

    ``groupBy`` runs a partial aggregate before the shuffle, so a very common
    word costs one row per map task, not one per occurrence.
    """
    return (lines.select(F.explode(_tokens(value)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
