"""Operator 8, substring dedup: suffix automata over shards of reference text.

A window is ``window`` consecutive words.  A word goes if a window that covers it also starts
earlier: in a smaller doc_id (null last), or in the same doc_id at an earlier start.  Windows are
judged on the input.

1. Documents with the word sequence of a smaller doc_id lose all their words, and are set aside.
2. Each window names an anchor, its ``ANCHOR``-word run of least hash, so equal windows have equal
   anchors; a document keeps about one in seven of its runs.  Sorted by hash, anchors found once
   can't be in a repeated window, and end here.
3. Around each occurrence of a repeated anchor, the words that any window with it covers are cut out
   and sent to the shard of the anchor.  A task builds the suffix automaton of the distinct cuttings
   of a bounded shard, in order of their places, and streams the cuttings through it: where the
   matching statistic reaches ``window`` words that ended earlier elsewhere, the window goes.
4. Anchors with more than ``MAX_GROUP`` occurrences don't fit a shard: a partial aggregate over the 128-bit
   hashes of their windows finds the repeated ones' first places, which the documents look up (the exact way
   for the rest).

The automata of all reference text have no size bound, so they aren't sent to every executor: the
documents' cuttings come to the shards instead, and a shard only sees what shares an anchor with it.

Null, empty and short texts have no windows and lose nothing.  Rows that agree in doc_id and words
are one document.  Extra columns don't matter.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from zstandard import ZstdCompressor, ZstdDecompressor

from tessera.llm.automaton import SuffixAutomaton
from tessera.llm.dartminhash import sequence
from tessera.llm.sizes import small
from tessera.llm.words import Chunk, U, chunks, mix, signed
from tessera.session import materialize

WINDOW = 20
ANCHOR = 8
MAX_GROUP = 16_384
SHARD_WORDS = 50_000
#: Rows of a lookup table that may be broadcast: keys; documents with a list.
MAX_KEYS, MAX_DOCS = 300_000, 10_000
#: First places of repeated windows (33 bytes each) that are broadcast.
MAX_FIRSTS = 300_000


def anchors(c: Chunk, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(word position, hash) of the runs that some window of the chunk names, in order."""
    n, w = len(c.starts), window - k + 1
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, U)
    h, _ = c.grams(c.hashes(), k)
    starts = np.flatnonzero(c.wbounds[1:][c.doc] - np.arange(n) >= window)
    best = np.full(n, -1)
    for s in range(0, len(starts), 1 << 16):
        at = starts[s:s + (1 << 16)]
        best[at] = at + np.argmin(h[at[:, None] + np.arange(w)], axis=1)
    pos = np.unique(best[starts])
    return pos, h[pos]


def _keys(c: Chunk, ids: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each document: a long that names its doc_id and words, and the two that name its words."""
    s1, s2 = sequence(c)
    known = pc.fill_null(ids, 0).to_numpy().view(U) ^ mix(np.asarray(ids.is_null()).astype(U) + U(17))
    return signed(mix(mix(known) + mix(s1.view(U) ^ mix(s2.view(U))))), s1, s2


def _sequences(window: int):
    """Of documents with a window: key, words and size."""
    def run(batches):
        for b in batches:
            for c in chunks(b.column("text")):
                ids = b.column("doc_id").slice(c.first, c.n)
                some = np.flatnonzero(c.n_words >= window)
                yield pa.RecordBatch.from_arrays([*(pa.array(x[some]) for x in _keys(c, ids)), ids.take(pa.array(some)), pa.array(c.n_words[some].astype(np.int32))],
                                                 names=["key", "s1", "s2", "doc_id", "n"])
    return run


def _anchored(window: int, k: int):
    def run(batches):
        for b in batches:
            for c in chunks(b.column("text")):
                pos, h = anchors(c, window, k)
                doc = c.doc[pos]
                key = _keys(c, b.column("doc_id").slice(c.first, c.n))[0]
                yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(key[doc]), pa.array((pos - c.wbounds[:-1][doc]).astype(np.int32))], names=["hash", "key", "pos"])
    return run


def _repeated(most: int):
    """Rows sorted by hash: those whose hash occurs again, and whether more than ``most`` times.

    Streams; what is held between batches is one run of at most ``most`` rows.
    """
    def out(cols, hot):
        return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(hot)], names=["hash", "key", "pos", "hot"])

    def run(batches):
        held, frequent = [np.zeros(0, t) for t in (np.int64, np.int64, np.int32)], None
        for b in batches:
            cols = [np.concatenate([x, b.column(n).to_numpy()]) for x, n in zip(held, ("hash", "key", "pos"))]
            h = cols[0]
            if not len(h):
                continue
            start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            size = np.diff(np.append(start, len(h)))
            hot = size > most
            if frequent is not None and h[0] == frequent:
                hot[0] = True
            else:
                frequent = None
            whole = size > 1
            whole |= hot
            if hot[-1]:
                frequent, cut = h[-1], len(h)
            else:
                cut = start[-1]
            row = np.repeat(whole, size)
            row[cut:] = False
            yield out([x[row] for x in cols], np.repeat(hot, size)[row])
            held = [x[cut:] for x in cols]
        if len(held[0]) > 1:
            yield out(held, np.zeros(len(held[0]), bool))
    return run


def _packed(batches):
    pack = ZstdCompressor(level=3).compress
    for b in batches:
        for c in chunks(b.column("text")):
            ids = b.column("doc_id").slice(c.first, c.n)
            yield pa.RecordBatch.from_arrays([pa.array(_keys(c, ids)[0]), ids, pa.array([pack(c.text(i)) for i in range(c.n)], pa.binary())], names=["key", "doc_id", "packed"])


def _unpacked(batches, rows: int = 512):
    """(rows, chunk of their texts) of batches with a column of compressed texts."""
    unpack = ZstdDecompressor().decompress
    for b in batches:
        for at in range(0, b.num_rows, rows):
            part = b.slice(at, rows)
            for c in chunks(pa.array([unpack(x.as_py()).decode() for x in part.column("packed")], pa.large_string())):
                yield part.slice(c.first, c.n), c


def _cut(window: int, k: int):
    """Cuttings around repeated anchors: words joined by one space, and where they start."""
    def run(batches):
        for part, c in _unpacked(batches):
            raw, starts, ends = c.data.tobytes(), c.starts.tolist(), c.ends.tolist()
            for i in range(c.n):
                first, last = int(c.wbounds[i]), int(c.wbounds[i + 1])
                words = [raw[a:b] for a, b in zip(starts[first:last], ends[first:last])]
                pos = np.array(part.column("pos")[i].as_py())
                low, high = np.maximum(pos - (window - k), 0), np.minimum(pos + window, len(words))
                cut = [b" ".join(words[a:z]) for a, z in zip(low.tolist(), high.tolist())]
                same = pa.array(np.full(len(pos), i, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("hash")[i].values, part.column("key").take(same), part.column("doc_id").take(same), pa.array(low.astype(np.int32)), pa.array((high - low).astype(np.int32)), pa.array(cut, pa.binary())],
                    names=["hash", "key", "doc_id", "start", "n", "words"])
    return run


def _place(row: tuple) -> tuple:
    """Order of a cutting (hash, key, doc_id, start, n, words): nulls last, then the start."""
    return row[2] is None, row[2] or 0, row[3]


def shard_ranges(groups: list[list[tuple]], window: int) -> list[tuple]:
    """Ranges (key, from, to) of words to remove, from whole groups of cuttings."""
    out, refs = [], []
    for group in groups:
        firsts: dict[bytes, tuple] = {}
        for row in sorted(group, key=_place):
            first = firsts.setdefault(row[5], row)
            if _place(first) < _place(row):
                out.append((row[1], row[3], row[3] + row[4]))
            elif first is not row:  # equal words at an equal place: judged like the first
                refs.append(row)
        if len(firsts) > 1:
            refs += firsts.values()
    refs.sort(key=_place)
    split = [row[5].split(b" ") for row in refs]
    automaton = SuffixAutomaton()
    for i, words in enumerate(split):
        automaton.add(i, words)
    for row, words in zip(refs, split):
        own, begin, end = _place(row)[:2], 0, -1
        for at, (number, ended) in automaton.matches(words, window):
            other = _place(refs[number])
            if (other[:2], other[2] + ended) < (own, row[3] + at):
                if at - window > end:
                    if end > 0:
                        out.append((row[1], row[3] + begin, row[3] + end))
                    begin = at - window
                end = at
        if end > 0:
            out.append((row[1], row[3] + begin, row[3] + end))
    return out


def _sharded(window: int):
    """Partitions sorted by anchor: whole groups are gathered into shards of bounded size."""
    def rows(batches):
        for b in batches:
            yield from zip(*(x.to_pylist() for x in b.columns))

    def batch(ranges):
        cols = list(zip(*ranges)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int32(), pa.int32()))], names=["key", "a", "z"])

    def run(batches):
        shard, size = [], 0
        for _, group in groupby(rows(batches), key=lambda r: r[0]):
            group = list(group)
            shard.append(group)
            size += sum(r[4] for r in group)
            if size >= SHARD_WORDS:
                yield batch(shard_ranges(shard, window))
                shard, size = [], 0
        yield batch(shard_ranges(shard, window))
    return run


def _hot_windows(part, c: Chunk, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word position, two hashes) of the windows of a chunk that hold a listed anchor, in order."""
    wh = c.hashes()
    h1, ok = c.grams(wh, window)
    h2, _ = c.grams(mix(wh ^ U(0xFEED)), window)
    pos = part.column("pos")
    doc = np.repeat(np.arange(c.n), pos.value_lengths().to_numpy())
    at = (pos.flatten().to_numpy().astype(np.int64) + c.wbounds[:-1][doc])[:, None] - np.arange(window - k + 1)
    at = np.unique(at[at >= c.wbounds[:-1][doc][:, None]])
    at = at[ok[at]]
    return at, h1[at], h2[at]


def _windows(window: int, k: int):
    """Every window with a frequent anchor: 128 bits of hash and its start."""
    def run(batches):
        for part, c in _unpacked(batches):
            at, h1, h2 = _hot_windows(part, c, window, k)
            take = pa.array(c.doc[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(h1)), pa.array(signed(h2)), part.column("key").take(take), part.column("doc_id").take(take), pa.array((at - c.wbounds[:-1][c.doc[at]]).astype(np.int32))],
                names=["h1", "h2", "key", "doc_id", "start"])
    return run


def _distinct_windows(window: int, k: int):
    """The distinct windows of each chunk that hold a frequent anchor: hashes, first place, number."""
    def run(batches):
        for part, c in _unpacked(batches):
            at, h1, h2 = _hot_windows(part, c, window, k)
            ids = part.column("doc_id")
            none = np.asarray(ids.is_null())[c.doc[at]]
            doc = pc.fill_null(ids, 0).to_numpy()[c.doc[at]]
            start = at - c.wbounds[:-1][c.doc[at]]
            order = np.lexsort((start, doc, none, h2, h1))
            h1, h2 = h1[order], h2[order]
            new = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])) if len(h1) else order
            first = order[new]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(h1[new])), pa.array(signed(h2[new])), pa.array(none[first]), pa.array(doc[first]), pa.array(start[first].astype(np.int64)), pa.array(np.diff(np.append(new, len(h1))))],
                names=["h1", "h2", "none", "doc_id", "start", "n"])
    return run


class Firsts:
    """First places of windows by their hashes: sorted by the first one, compared by both."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, none: np.ndarray, doc: np.ndarray, start: np.ndarray):
        order = np.argsort(h1, kind="stable")
        self.h1, self.h2, self.none, self.doc, self.start = (x[order] for x in (h1, h2, none, doc, start))
        self.most = int(np.unique(self.h1, return_counts=True)[1].max()) if len(h1) else 0

    def later(self, h1: np.ndarray, h2: np.ndarray, none: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Whether each window has an earlier first place (smaller id, null last, then smaller start)."""
        out = np.zeros(len(h1), bool)
        at = np.searchsorted(self.h1, h1)
        for _ in range(self.most):  # nearly always once: hashes that share their first half
            p = np.minimum(at, len(self.h1) - 1)
            hit = (self.h1[p] == h1) & (self.h2[p] == h2)
            same = self.none[p] == none
            earlier = none & ~self.none[p] | same & ((self.doc[p] < doc) | (self.doc[p] == doc) & (self.start[p] < start))
            out |= hit & earlier
            at = at + 1
        return out


def _late(box, window: int, k: int):
    """The ranges of words that late windows with a frequent anchor cover, one row a run of them."""
    def run(batches):
        firsts = box.value
        for part, c in _unpacked(batches):
            at, h1, h2 = _hot_windows(part, c, window, k)
            ids = part.column("doc_id")
            none = np.asarray(ids.is_null())[c.doc[at]]
            doc = pc.fill_null(ids, 0).to_numpy()[c.doc[at]]
            start = at - c.wbounds[:-1][c.doc[at]]
            late = np.flatnonzero(firsts.later(signed(h1), signed(h2), none, doc, start))
            of, start = c.doc[at[late]], start[late]
            new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (start[1:] > start[:-1] + window)])) if len(of) else late
            end = start[np.append(new[1:], len(start)) - 1] if len(of) else late
            yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(of[new])), pa.array(start[new].astype(np.int32)), pa.array((end + window).astype(np.int32))],
                                             names=["key", "a", "z"])
    return run


def _place_column(start: str) -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col(start).alias("start"))


def removed_ranges(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """``key, ranges``: for each document that loses words, the ranges (a, z) of their numbers.

    Shuffled: anchors (20 bytes in seven words), compressed texts with a repeated anchor (with all
    texts, if the list of them is too long to broadcast), cuttings of repeated text, ranges.
    """
    if not 1 <= k <= window:
        raise ValueError("the anchor must fit into the window")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sequences = materialize(rows.mapInArrow(_sequences(window), "key long, s1 long, s2 long, doc_id long, n int").distinct(), "sequences")
    never = sequences.withColumn("start", F.lit(0))
    first = materialize(never.groupBy("s1", "s2").agg(F.min(_place_column("start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "copied")
    copies = materialize(never.join(first, ["s1", "s2"]).where(_place_column("start") > F.col("first")).select("key", "n"), "copies")
    found = rows.mapInArrow(_anchored(window, k), "hash long, key long, pos int")
    repeated = found.repartition("hash").sortWithinPartitions("hash").mapInArrow(_repeated(MAX_GROUP), "hash long, key long, pos int, hot boolean")
    listed = repeated.groupBy("key").agg(F.collect_list(F.when(~F.col("hot"), F.struct("pos", "hash"))).alias("x"), F.collect_list(F.when(F.col("hot"), F.col("pos"))).alias("hot"))
    listed = listed.select("key", F.col("x.pos").alias("pos"), F.col("x.hash").alias("hash"), "hot")
    listed = materialize(listed.join(small(copies.select("key"), MAX_KEYS), "key", "left_anti"), "positions")
    texts = rows.mapInArrow(_packed, "key long, doc_id long, packed binary")
    work = texts.join(small(listed.where("size(pos) > 0").drop("hot"), MAX_DOCS), "key")
    cuttings = work.select("key", "doc_id", "packed", "pos", "hash").mapInArrow(_cut(window, k), "hash long, key long, doc_id long, start int, n int, words binary")
    ranges = cuttings.repartition("hash").sortWithinPartitions("hash").mapInArrow(_sharded(window), "key long, a int, z int")
    hot = listed.where("size(hot) > 0").select("key", F.col("hot").alias("pos"))
    if not hot.isEmpty():
        ranges = ranges.union(_frequent(texts, hot, window, k))
    ranges = ranges.union(copies.select("key", F.lit(0).alias("a"), F.col("n").alias("z")))
    return ranges.groupBy("key").agg(F.collect_list(F.struct("a", "z")).alias("ranges"))


def _frequent(texts: DataFrame, hot: DataFrame, window: int, k: int) -> DataFrame:
    """``key, a, z``: the words of windows with a frequent anchor that also start earlier.

    The first places of repeated windows are one aggregate.  A passage in very many documents has few of them, so
    they are broadcast after a count, and the documents look their windows up, a row a run; beyond the bound
    the windows are joined with them."""
    each = materialize(texts.join(small(hot, MAX_DOCS), "key").select("key", "doc_id", "packed", "pos"), "hot-texts")
    found = each.mapInArrow(_distinct_windows(window, k), "h1 long, h2 long, none boolean, doc_id long, start long, n long")
    firsts = found.groupBy("h1", "h2").agg(F.min(F.struct("none", "doc_id", "start")).alias("first"), F.sum("n").alias("n")).where("n > 1").drop("n")
    firsts = materialize(firsts, "firsts")
    if firsts.count() <= MAX_FIRSTS:
        t = firsts.select("h1", "h2", "first.none", "first.doc_id", "first.start").toArrow()
        box = texts.sparkSession.sparkContext.broadcast(Firsts(*(t.column(x).to_numpy() for x in t.column_names)))
        return each.mapInArrow(_late(box, window, k), "key long, a int, z int")
    every = each.mapInArrow(_windows(window, k), "h1 long, h2 long, key long, doc_id long, start int")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"), F.col("start").cast("long").alias("start"))
    return every.join(firsts, ["h1", "h2"]).where(place > F.col("first")).select("key", F.col("start").alias("a"), (F.col("start") + window).cast("int").alias("z"))


def _kept(batches):
    for part, c in _unpacked(batches):
        raw = c.data.tobytes()
        removed, digest = [], []
        ranges = part.column("ranges")
        for i in range(c.n):
            first, last = int(c.wbounds[i]), int(c.wbounds[i + 1])
            gone = np.zeros(last - first, bool)
            for r in ranges[i].as_py() or ():
                gone[r["a"]:r["z"]] = True
            keep = np.flatnonzero(~gone) + first
            words = b" ".join(raw[a:b] for a, b in zip(c.starts[keep].tolist(), c.ends[keep].tolist()))
            removed.append(int(gone.sum()))
            digest.append(words)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(c.n_words.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(digest, pa.binary())],
                                         names=["doc_id", "n_words", "n_removed", "kept"])


def _digested(batches):
    for b in _kept(batches):
        sha = [hashlib.sha256(x.as_py()).hexdigest() for x in b.column("kept")]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _texted(batches):
    for b in _kept(batches):
        yield b.set_column(3, "text", b.column("kept").cast(pa.string()))


def dedup_substrings(docs: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed`` and the kept words, joined by one space: as ``text``, or only
    their hash ``kept_sha256``.  One row per input row."""
    ranges = materialize(removed_ranges(docs, window), "ranges")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = rows.mapInArrow(_packed, "key long, doc_id long, packed binary")
    joined = texts.join(small(ranges, MAX_DOCS), "key", "left").select("doc_id", "packed", "ranges")
    run, last = (_digested, "kept_sha256") if digest else (_texted, "text")
    return joined.mapInArrow(run, f"doc_id long, n_words long, n_removed long, {last} string")
