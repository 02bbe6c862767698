"""SQL views over stored tables and DataFrames, for ``spark.sql``.

``register_table`` is the data definition form (``CREATE TEMPORARY VIEW ... USING format OPTIONS (...)``): nothing is
read until a query runs, and Spark pushes its columns and filters into the scan.  ``register_frame`` names a
DataFrame.  Names and options are quoted; a view of the same name is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_table(spark: SparkSession, name: str, path: str, format: str = "parquet", schema: str | None = None, **options: str) -> DataFrame:
    """A temporary view over the stored table at ``path``; returns it as a DataFrame."""
    given = {"path": path, **options}
    listed = ", ".join(f"{quoted_name(k)} {quoted_text(str(v))}" for k, v in given.items())
    columns = f" ({schema})" if schema else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {quoted_name(name)}{columns} USING {quoted_name(format)} OPTIONS ({listed})")
    return spark.table(quoted_name(name))


def register_frame(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(quoted_name(name))
    return df
