"""Operator 13, target-distribution importance resampling over hashed word runs, with a head-tail vocabulary.

Features are all runs of 1 to ``max_run`` consecutive words, joined by one space; a feature's bucket is the
unsigned crc32 of its UTF-8 bytes modulo ``BUCKETS``.  A bucket's gain is the scaled log ratio of its share in
the target texts and in all documents, a document's weight the sum of its features' gains, and documents are
drawn without replacement by the highest weight plus Gumbel noise.

*Head.*  One aggregate counts every word of up to ``MAX_HEAD_BYTES`` bytes in all documents, as two integers
that hold its bytes (no hash, so nothing can be confused).  For the ``HEAD_WORDS`` most frequent, the state of
the crc register after the word is made once; of the pairs of such words the ``HEAD_PAIRS`` most frequent get
their buckets.  Both tables are bounded by these parameters, not by the data, and go to all tasks.

*Tail.*  Every other word takes the direct crc, byte by byte over a whole chunk of texts at once; a longer run
continues the register of the run before it with a space and the next word.  Head and tail give the same numbers,
so the bucket totals are exact, whatever the head holds.

Totals come to the driver as one row a bucket.  The draw needs the k-th highest score, found by counting in ever
finer ranges; only the drawn rows are sorted (by ranges, no single task) and numbered.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null and wordless texts have no features and weight 0.
A null id draws as an empty one and loses ties; repeated rows (same id) have the same noise, and of equal rows at
the cut as many are drawn as are needed.  Empty documents give an empty result, an empty target gain from smoothing
alone.  Columns other than ``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.importance import kth_largest
from tessera.llm.words import Chunk, U, chunks, mix
from tessera.operators.common import dense_number
from tessera.session import materialize

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
HEAD_WORDS = 4096
HEAD_PAIRS = 16_384
MAX_HEAD_BYTES = 16
#: Longer words take their crc one by one; below, byte by byte over all words at once.
LONG = 64

#: Bytes that are no part of a word, before lower-casing.
GAP = np.ones(256, bool)
GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

START = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_TABLE = _crc_table()


def advance(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc registers after the bytes ``data[starts:ends]``, from ``state``."""
    size = ends - starts
    state = state.copy()
    order = np.argsort(-size, kind="stable")
    order = order[np.searchsorted(-size[order], -LONG):]
    live, at, n = state[order], starts[order], size[order]
    for j in range(int(n[0]) if len(n) else 0):
        k = int(np.searchsorted(-n, -j))  # those with more than j bytes
        live[:k] = _TABLE[(live[:k] ^ data[at[:k] + j]) & 0xFF] ^ (live[:k] >> np.uint32(8))
    state[order] = live
    for i in np.flatnonzero(size > LONG):
        state[i] = zlib.crc32(data[starts[i]:ends[i]], int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return state


def _space(state: np.ndarray) -> np.ndarray:
    return _TABLE[(state ^ np.uint32(0x20)) & 0xFF] ^ (state >> np.uint32(8))


def bucket(state: np.ndarray) -> np.ndarray:
    return ((state ^ START) % np.uint32(BUCKETS)).astype(np.int64)


def packed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 16 bytes of each word as two integers (words hold no zero byte, so padding is unambiguous)."""
    out = []
    for part in (0, 8):
        n = np.clip(ends - starts - part, 0, 8)
        word = np.zeros(len(starts), U)
        for j in range(8):
            has = np.flatnonzero(n > j)
            word[has] |= data[starts[has] + part + j].astype(U) << U(8 * j)
        out.append(word)
    return out[0], out[1]


def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a) ^ (b * U(0x9E3779B97F4A7C15))


@dataclass
class Head:
    """Frequent words by their packed bytes, sorted by key: crc register after the word.  Frequent pairs of
    them (place of the first times the number of words plus place of the second), sorted: their buckets."""

    key: np.ndarray = field(default_factory=lambda: np.zeros(0, U))
    a: np.ndarray = field(default_factory=lambda: np.zeros(0, U))
    b: np.ndarray = field(default_factory=lambda: np.zeros(0, U))
    state: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    pair: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pair_bucket: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Place of each word in the head, -1 for words of the tail."""
        out = np.full(len(starts), -1)
        if len(self.key):
            short = np.flatnonzero(ends - starts <= MAX_HEAD_BYTES)
            a, b = packed(data, starts[short], ends[short])
            k = _key(a, b)
            at = np.minimum(np.searchsorted(self.key, k), len(self.key) - 1)
            hit = (self.a[at] == a) & (self.b[at] == b)
            out[short[hit]] = at[hit]
        return out


def head_of(words: list[bytes]) -> Head:
    """The head of the given words (of two with one key the later stays in the tail)."""
    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    a, b = packed(data, starts, ends)
    key, at = np.unique(_key(a, b), return_index=True)
    return Head(key, a[at], b[at], advance(np.full(len(at), START), data, starts[at], ends[at]))


def bytes_of(a: int, b: int) -> bytes:
    return (a & (1 << 64) - 1).to_bytes(8, "little").rstrip(b"\0") + (b & (1 << 64) - 1).to_bytes(8, "little").rstrip(b"\0")


def features(c: Chunk, head: Head, max_run: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every run of words of a chunk, shorter runs first."""
    data, starts, ends = LOWER[c.data], c.starts, c.ends
    place = head.find(data, starts, ends)
    state = np.full(len(starts), START)
    known = place >= 0
    state[known] = head.state[place[known]]
    tail = np.flatnonzero(~known)
    state[tail] = advance(state[tail], data, starts[tail], ends[tail])
    docs, buckets = [c.doc], [bucket(state)]
    left = c.wbounds[1:][c.doc] - np.arange(len(starts)) if len(starts) else starts
    for k in range(2, max_run + 1):
        run = np.flatnonzero(left >= k)
        last = run + k - 1
        found = np.zeros(len(run), np.int64)
        direct = np.arange(len(run))
        if k == 2 and len(head.pair):
            code = place[run] * len(head.key) + place[last]
            at = np.minimum(np.searchsorted(head.pair, code), len(head.pair) - 1)
            hit = known[run] & known[last] & (head.pair[at] == code)
            found[hit] = head.pair_bucket[at[hit]]
            if max_run == 2:  # longer runs go on from the register, so they need it
                direct = np.flatnonzero(~hit)
        on = advance(_space(state[run[direct]]), data, starts[last[direct]], ends[last[direct]])
        state = state.copy()
        state[run[direct]] = on
        found[direct] = bucket(on)
        docs.append(c.doc[run])
        buckets.append(found)
    return np.concatenate(docs), np.concatenate(buckets)


def _count_words(batches):
    for batch in batches:
        for c in chunks(batch.column(0), 8 << 20, GAP):
            short = np.flatnonzero(c.ends - c.starts <= MAX_HEAD_BYTES)
            a, b = packed(LOWER[c.data], c.starts[short], c.ends[short])
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else order
            yield pa.RecordBatch.from_arrays([pa.array(a[new].view(np.int64)), pa.array(b[new].view(np.int64)), pa.array(np.diff(np.append(new, len(a))))], names=["a", "b", "n"])


def _pair_counting(head: Head):
    def run(batches):
        for batch in batches:
            for c in chunks(batch.column(0), 8 << 20, GAP):
                place = head.find(LOWER[c.data], c.starts, c.ends)
                both = (place[:-1] >= 0) & (place[1:] >= 0) & (c.doc[:-1] == c.doc[1:])
                code, n = np.unique(place[:-1][both] * len(head.key) + place[1:][both], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["pair", "n"])
    return run


def most_frequent(counts: DataFrame, k: int, name: str) -> list:
    """The rows with the largest ``n``, at most ``k``: rows tied with the next one stay out, so that every task
    sends only rows that are taken."""
    counts = materialize(counts, name)
    if counts.count() <= k:
        return counts.collect()
    return counts.where(F.col("n") > kth_largest(counts, "n", k + 1)).collect()


def vocabulary(texts: DataFrame, max_run: int, n_words: int = HEAD_WORDS, n_pairs: int = HEAD_PAIRS) -> Head:
    """The head of the only column of ``texts``: at most ``n_words`` and ``n_pairs`` rows reach the driver."""
    if not n_words:
        return Head()
    words = texts.mapInArrow(_count_words, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    head = head_of([bytes_of(r["a"], r["b"]) for r in most_frequent(words, n_words, "word-counts")])
    if max_run > 1 and n_pairs and len(head.key):
        pairs = texts.mapInArrow(_pair_counting(head), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = np.array([r["pair"] for r in most_frequent(pairs, n_pairs, "pair-counts")], np.int64)
        words = [bytes_of(int(x), int(y)) for x, y in zip(head.a, head.b)]
        head.pair = np.sort(top)
        head.pair_bucket = np.array([zlib.crc32(words[p // len(words)] + b" " + words[p % len(words)]) % BUCKETS for p in head.pair.tolist()], np.int64)
    return head


def _totalling(head: Head, max_run: int):
    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for c in chunks(batch.column(0), space=GAP):
                total += np.bincount(features(c, head, max_run)[1], minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])
    return run


def totals(texts: DataFrame, head: Head, max_run: int) -> np.ndarray:
    """Features in each bucket over all texts, one row a bucket at the driver."""
    rows = texts.mapInArrow(_totalling(head, max_run), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + BUCKETS) / ((s + 1)(T + BUCKETS))))`` of every bucket."""
    s_all, t_all = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def _weighing(head: Head, gain: np.ndarray, max_run: int):
    def run(batches):
        for batch in batches:
            for c in chunks(batch.column("text"), space=GAP):
                doc, slot = features(c, head, max_run)
                n = np.bincount(doc, minlength=c.n).astype(np.int64)
                weight = np.bincount(doc, weights=gain[slot], minlength=c.n).astype(np.int64)  # whole numbers far below 2**53
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(c.first, c.n), pa.array(c.n_words.astype(np.int64)), pa.array(n), pa.array(weight)],
                                                 names=["doc_id", "n_words", "n_features", "weight"])
    return run


def noise(doc_id: Column, seed: int) -> Column:
    """``floor(-1000 ln(-ln((h + 0.5) / 2**32)))``, h from the first 8 hex digits of sha256(``seed:doc_id``)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, max_run: int = 1, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             n_words: int = HEAD_WORDS, n_pairs: int = HEAD_PAIRS) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``docs``; ``rank`` counts the drawn ones
    (``percent`` of those with at least ``min_words`` words) from 1.  ``target``: texts to resemble, column ``text``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    head = vocabulary(rows.select("text"), max_run, n_words, n_pairs)
    gain = gains(totals(rows.select("text"), head, max_run), totals(target.select("text"), head, max_run))
    weighed = rows.mapInArrow(_weighing(head, gain, max_run), "doc_id long, n_words long, n_features long, weight long")
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "target-scores")
    enough = scored.where(F.col("n_words") >= min_words)
    k = percent * enough.count() // 100
    none = F.lit(None).cast("long")
    if not k:
        return scored.withColumn("rank", none)
    cut = kth_largest(enough, "score", k)
    drawn = (F.col("n_words") >= min_words) & (F.col("score") >= cut)
    order = enough.where(F.col("score") >= cut).select("*", (-F.col("score")).alias("down"), F.col("doc_id").isNull().alias("no_id"), F.monotonically_increasing_id().alias("tie"))
    ranked = dense_number(order, ["down", "no_id", "doc_id", "n_features", "weight", "tie"], (), "at")
    ranked = ranked.select(*scored.columns, F.when(F.col("at") < k, F.col("at") + 1).cast("long").alias("rank"))
    return scored.where(~drawn).withColumn("rank", none).unionByName(ranked)
