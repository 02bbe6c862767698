"""Line-oriented text sources (S1, S2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import whitespace_fields


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``value string``.  Splittable, so large files fan out."""
    return spark.read.text(path)


def parse_edges(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(edges, rejects)`` of ``a b`` lines: ``src, dst`` longs, and the lines that are no edge.

    ``#`` comments and blank lines are skipped.  Fields are split on whitespace runs after trimming; a
    line with fewer than two fields, or whose first two aren't integers, is a reject.  Duplicate
    edges are kept.
    """
    f = whitespace_fields(F.trim(F.col(value)))
    staged = (lines.where(~F.col(value).startswith("#") & (F.trim(F.col(value)) != ""))
              .select(F.col(value), F.get(f, 0).try_cast("bigint").alias("src"), F.get(f, 1).try_cast("bigint").alias("dst")))
    good = F.col("src").isNotNull() & F.col("dst").isNotNull()
    return staged.where(good).select("src", "dst"), staged.where(~good).select(value)


def read_edges(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Edge-list file, two integer vertex ids per line: ``(edges, rejects)``."""
    return parse_edges(read_lines(spark, path))
