"""Column functions for log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The streaming log line pattern (19-character time, one space,
# an upper-case level, anything) and the time layout it carries.
LOG_LINE_PATTERN = r"^(.{19}) ([A-Z]+).*\z"
LOG_TIME_LAYOUT = "yyyy-MM-dd HH:mm:ss"
# A time text the lenient resolver accepts: year 0001-9999,
# month 01-12, day 01-31, hour 00-23 (or exactly 24:00:00), minute and second 00-59.
_VALID_TIME = (r"^(?!0000)[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01]) "
               r"(([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]|24:00:00)\z")


def smart_timestamp(text: Column) -> Column:
    """Parse ``yyyy-MM-dd HH:mm:ss`` resolving like ``java.time``'s SMART style.

    A day of 29-31 past the month's end is moved to the month's last day and
    ``24:00:00`` is the next midnight; other out-of-range fields, or text not
    in the layout, give NULL.  (Spark's own parser returns NULL for both
    lenient cases.)  Validation is one regular expression; the fields are
    then read at fixed positions.
    """
    y, mo, d, h, mi, s = (F.substring(text, pos, ln).cast("int")
                          for pos, ln in ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2)))
    day = F.least(d, F.dayofmonth(F.last_day(F.make_date(y, mo, F.lit(1)))))
    midnight = h == 24
    base = F.make_timestamp(y, mo, day, F.when(midnight, F.lit(0)).otherwise(h), mi, s)
    ts = F.when(midnight, base + F.expr("INTERVAL 1 DAY")).otherwise(base)
    return F.when(text.rlike(_VALID_TIME), ts)


def with_smart_timestamp(df, text: str, out: str = "time"):
    """``df`` plus ``out`` = ``smart_timestamp(text)``; rows whose time does not resolve are dropped."""
    keep = [c for c in df.columns if c != text]
    return df.where(F.col(text).rlike(_VALID_TIME)).select(*keep, smart_timestamp(F.col(text)).alias(out))


def log_fields(value: Column) -> tuple[Column, Column, Column]:
    """(matches, time text, level) of a line against ``LOG_LINE_PATTERN``."""
    # The time is always the first 19 characters of a matching line.
    return (value.rlike(LOG_LINE_PATTERN),
            F.substring(value, 1, 19),
            F.regexp_extract(value, LOG_LINE_PATTERN, 2))
