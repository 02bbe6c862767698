"""File sinks: tab-separated text output (K1, K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated lines without header, one part file per task; the folder is replaced."""
    df.write.mode(mode).option("sep", "\t").option("header", "false").csv(path)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("sep", "\t").schema(schema).csv(path)
