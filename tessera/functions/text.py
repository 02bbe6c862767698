"""Column functions for line text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(col: Column | str) -> Column:
    """Split a line on single spaces with the reference tokeniser's edge rules.

    Trailing empty tokens are dropped, leading and inner ones kept; an empty
    line gives one empty token and an all-space line gives none.  Spark's
    ``split`` keeps trailing empties, so trailing spaces are trimmed first
    (``rtrim`` removes spaces only).
    """
    c = F.col(col) if isinstance(col, str) else col
    trimmed = F.rtrim(c)
    return F.when((c != F.lit("")) & (trimmed == F.lit("")),
                  F.array().cast("array<string>")) \
            .otherwise(F.split(trimmed, " ", -1))


def text_lines(col: Column | str) -> Column:
    """Lines of a text blob the way a line reader yields them.

    A single final newline ends the last line rather than opening an empty
    one, and an empty blob has no lines.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == F.lit(""), F.array().cast("array<string>")) \
            .otherwise(F.split(F.regexp_replace(c, "\n\\z", ""), "\n", -1))


def whitespace_fields(col: Column | str) -> Column:
    """Fields split on runs of whitespace (``\\s+``); leading whitespace gives an empty first field."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(c, "\\s+", -1)
