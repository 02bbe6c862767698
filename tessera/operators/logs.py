"""Log mining operators over tab-separated and space-separated log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.logs import log_fields, with_smart_timestamp


def parse_tab_logs(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split tab lines into ``ts, level, app, message``; return ``(logs, rejects)``.

    Trailing empty fields are dropped before indexing, as a Java ``split``
    does.  A row without a level, or an ERROR row without an app, would fail
    the whole job in a strict parser; here it goes to ``rejects`` with a ``reason``.  Other columns of
    ``lines`` are carried along.
    """
    keep = [c for c in lines.columns if c != value]
    f = F.split(F.regexp_replace(F.col(value), "\t+\\z", ""), "\t", -1)
    staged = lines.select(*keep, F.col(value), f.alias("_f"))
    n = F.size("_f")
    bad = (n < 2) | ((F.get(F.col("_f"), 1) == "ERROR") & (n < 3))
    logs = staged.where(~bad).select(
        *keep,
        F.col("_f")[0].alias("ts"),
        F.get(F.col("_f"), 1).alias("level"),
        F.get(F.col("_f"), 2).alias("app"),
        F.when(n > 3, F.array_join(F.slice("_f", 4, F.greatest(n - 3, F.lit(1))), "\t")).alias("message"))
    reason = F.when(n < 2, F.lit("no level")).otherwise(F.lit("error without application"))
    rejects = staged.where(bad).select(*keep, F.col(value), reason.alias("reason"))
    return logs, rejects


def errors(logs: DataFrame, level: str = "ERROR") -> DataFrame:
    return logs.where(F.col("level") == F.lit(level))


def error_count(logs: DataFrame) -> DataFrame:
    return errors(logs).agg(F.count(F.lit(1)).alias("n_errors"))


def errors_of(logs: DataFrame, app: str, n: int = 10, order_by=("ts",)) -> DataFrame:
    """The first ``n`` errors of one application (ordered so the answer is repeatable)."""
    return errors(logs).where(F.col("app") == F.lit(app)).orderBy(*order_by).limit(n)


def errors_by_app(logs: DataFrame) -> DataFrame:
    """``app, n``: error count per application, kept distributed."""
    return errors(logs).groupBy("app").agg(F.count(F.lit(1)).alias("n"))


def parse_log_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``time timestamp, level``: lines matching the log pattern with a resolvable time.

    Other columns of ``lines`` are carried along; non-matching lines and
    unparsable times are dropped.
    """
    keep = [c for c in lines.columns if c != value]
    ok, text, level = log_fields(F.col(value))
    matched = lines.where(ok).select(*keep, text.alias("_time_text"), level.alias("level"))
    return with_smart_timestamp(matched, "_time_text", "time").select(*keep, "time", "level")


def errors_per_minute(logs: DataFrame, level: str = "ERROR") -> DataFrame:
    """``log_time, log_count``: matching rows per minute."""
    return (logs.where(F.col("level") == F.lit(level))
            .groupBy(F.date_trunc("minute", "time").alias("log_time"))
            .agg(F.count(F.lit(1)).alias("log_count")))
