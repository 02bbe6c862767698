"""Operator 6, quality rules: cross-document line frequency.

Lines are normalised (white space collapsed, ASCII letters lowered, digits alike) and hashed; for
each host the distinct documents that hold a line are counted, lines found in more than
``max_line_docs`` documents of their host are removed, and documents are rejected that fail the base
rules or lose more than ``max_removed_pct`` percent of their words to such lines.

Null or empty texts have no words and fail the base rules.  A null host is a host of its own.
Repeated rows count as documents of their own.  Extra input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.words import BYTES, FOLD, chunks, lists, occurrences, signed, spans_hash
from tessera.session import materialize

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_LINE_DOCS = 20
MAX_REMOVED_PCT = 50

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

_SCHEMA = ("rid long, doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, line_hash array<long>, line_words array<long>")


def _lines(c):
    """Lines with a word: (first word, end word, document, hash of the raw line)."""
    nl = np.flatnonzero(c.data == 10)
    before = np.searchsorted(nl, c.starts)
    new = np.ones(len(c.starts), bool)
    new[1:] = (before[1:] != before[:-1]) | (c.doc[1:] != c.doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(c.starts))
    doc, b = c.doc[first], before[first]
    pad = np.concatenate([[-1], nl, [len(c.data)]])
    begin = np.maximum(pad[b] + 1, c.offs[:-1][doc])
    end = np.minimum(pad[b + 1], c.offs[1:][doc])
    return first, last, doc, spans_hash(BYTES[c.data], begin, end)


def measure(c) -> dict[str, np.ndarray]:
    """The base measures and the distinct normalised lines of every document of a chunk."""
    wh = c.hashes()
    cont = (c.data & 0xC0) == 0x80
    chars = c.byte_sums(~cont) - c.byte_sums(np.isin(c.data, [0x20, 9, 10, 11, 12, 13]))
    tri, ok = c.grams(wh, 3)
    at = np.flatnonzero(ok)
    order, new, _ = occurrences(tri[at], c.doc[at])
    group = np.cumsum(new) - 1
    twice = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, bool)
    cover = np.zeros(len(wh) + 2, bool)
    hit = at[order[twice]]
    for j in range(3):
        cover[hit + j] = True
    first, last, ldoc, raw = _lines(c)
    _, rnew, _ = occurrences(raw, ldoc)
    n_lines = np.bincount(ldoc, minlength=c.n)
    odoc = np.sort(ldoc)
    distinct = np.bincount(odoc[rnew], minlength=c.n)
    folded = spans_hash(c.hashes(FOLD), first, last)
    order, new, _ = occurrences(folded, ldoc)
    group = np.cumsum(new) - 1
    words = np.bincount(group, weights=(last - first)[order]).astype(np.int64) if len(order) else np.zeros(0, np.int64)
    per_doc = np.bincount(ldoc[order][new], minlength=c.n)
    return {"n_words": c.n_words, "word_chars": chars, "n_symbols": c.byte_sums(SYMBOLS[c.data]),
            "n_dup_lines": n_lines - distinct, "n_repeat_words": c.sums(cover[: len(wh)]),
            "line_hash": signed(folded[order][new]), "line_words": words,
            "bounds": np.concatenate([[0], np.cumsum(per_doc)])}


def _measured(batches):
    for b in batches:
        for c in chunks(b.column("text")):
            m = measure(c)
            bounds = m.pop("bounds")
            part = b.slice(c.first, c.n)
            yield pa.RecordBatch.from_arrays(
                [part.column("rid"), part.column("doc_id"), part.column("host"),
                 *(pa.array(m[k].astype(np.int64)) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                 lists(m["line_hash"], bounds), lists(m["line_words"], bounds)],
                names=["rid", "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "line_hash", "line_words"])


def quality_rules(docs: DataFrame, host: str = "source", min_words: int = MIN_WORDS,
                  max_repeat_pct: int = MAX_REPEAT_PCT, max_line_docs: int = MAX_LINE_DOCS,
                  max_removed_pct: int = MAX_REMOVED_PCT) -> DataFrame:
    """One row per input row: measures, ``n_removed_words``, ``base_failed`` and ``kept``.

    Only the narrow measures and line hashes are written and shuffled, never the texts.  The count
    of a line is a partial aggregate; the join back is against lines above the limit only, read
    from a table, so that Spark may broadcast it if small and splits hot lines otherwise.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col(host).cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    m = materialize(rows.mapInArrow(_measured, _SCHEMA), "lines")
    lines = m.select("rid", "host", F.explode(F.arrays_zip("line_hash", "line_words")).alias("l")) \
        .select("rid", F.coalesce(F.col("host"), F.lit("")).alias("host"), F.col("host").isNull().alias("no_host"),
                F.col("l.line_hash").alias("h"), F.col("l.line_words").alias("w"))
    key = ["host", "no_host", "h"]
    often = materialize(lines.groupBy(*key).count().where(F.col("count") > max_line_docs).select(*key), "frequent")
    removed = lines.join(often, key).groupBy("rid").agg(F.sum("w").alias("n_removed_words"))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    depleted = 100 * F.col("n_removed_words") > max_removed_pct * F.col("n_words")
    return m.drop("line_hash", "line_words", "host").join(removed, "rid", "left") \
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long"))) \
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words",
                base.alias("base_failed"), (~base & ~depleted).alias("kept"))
