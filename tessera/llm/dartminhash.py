"""Operator 9, near-duplicates by DartMinHash over five-word shingles.

A document is a weighted set: its shingles, each weighing the times it occurs.  Every unit of weight
of a shingle is a strip of the plane on which hashed darts fall at a rate of one a unit of rank; a
document throws the darts of its strips up to a rank at which it expects ``k ln k + 2k`` of them,
and goes on where a coordinate is still empty.  A dart's hash names its coordinate, and the dart of
least rank in a coordinate is kept, so that two documents agree in a coordinate with the probability
of their weighted Jaccard similarity.  128 coordinates in 32 bands of 4 miss a pair at 0.8 with a
probability of 5e-8.  Candidates are verified on whole shingle sets.

Documents are first reduced to classes of equal word sequences.  In a band's bucket every class is
compared with a leader (a star), the verified links are joined to components, and then the pairs of a
bucket that lie in different components are compared, so no link between different texts is lost,
and a large group of near copies isn't multiplied with itself.  Pairs that cannot reach the threshold
are left out exactly: by their sizes, because strips that no other set has can't be shared, and by
what both share with a leader.

Texts of one to four words are one shingle; null and wordless texts are a class of their own row each.
Repeated rows are one class.  A class is named by the least doc_id in it (null if all are null).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from zstandard import ZstdCompressor, ZstdDecompressor

from tessera.llm.components import connected_components
from tessera.llm.sizes import small
from tessera.llm.words import Chunk, U, chunks, lists, mix, occurrences, signed, spans_hash
from tessera.session import materialize

K, BANDS, SHINGLE = 128, 32, 5
THRESHOLD = 0.8
#: Rows (of three longs) of a lookup table that may be broadcast.
MAX_BROADCAST = 300_000
#: Longs of a map of the strips that a set hasn't in common with its pivot (a power of two).
MAP = 4

_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1, 16)])))


def unit(h: np.ndarray) -> np.ndarray:
    return (h >> U(11)).astype(np.float64) / float(1 << 53)


def strips(c: Chunk, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(id, document) of each unit of weight of a chunk's shingles, sorted by document."""
    wh = c.hashes()
    h, ok = c.grams(wh, k)
    short = np.flatnonzero((c.n_words > 0) & (c.n_words < k))
    ids = np.concatenate([h[ok], spans_hash(wh, c.wbounds[short], c.wbounds[short + 1])])
    doc = np.concatenate([c.doc[ok], short])
    order, _, rank = occurrences(ids, doc)
    return mix(ids[order] ^ mix(rank.astype(U) + U(31))), doc[order]


def signatures(ids: np.ndarray, doc: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """n x k ranks: the least dart of each coordinate (infinite where a document has no strip)."""
    best = np.full(n * k, np.inf)
    weight = np.bincount(doc, minlength=n)
    reach = np.ceil((k * np.log(k) + 2 * k) / np.maximum(weight, 1)).astype(np.int64)
    low, high = np.zeros(n, np.int64), np.where(weight > 0, reach, 0)
    live = np.arange(len(ids))
    while len(live):
        d = doc[live]
        cells = (high - low)[d]
        strip = np.repeat(live, cells)
        rank = np.arange(len(strip)) - np.repeat(np.cumsum(cells) - cells, cells) + low[doc[strip]]
        cell = mix(ids[strip] ^ mix(rank.astype(U) + U(71)))
        thrown = np.searchsorted(_POISSON, unit(cell))
        cell, rank, owner = np.repeat(cell, thrown), np.repeat(rank, thrown), np.repeat(doc[strip], thrown)
        number = np.arange(len(cell)) - np.repeat(np.cumsum(thrown) - thrown, thrown)
        dart = mix(cell + number.astype(U) * U(0x9E3779B97F4A7C15) + U(5))
        np.minimum.at(best, owner * k + (dart % U(k)).astype(np.int64), rank + unit(mix(dart)))
        empty = np.isinf(best.reshape(n, k)).any(axis=1)
        low, high = high, high * 2
        live = live[empty[doc[live]]]
    return best.reshape(n, k)


def band_keys(best: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """n x bands keys; a key also names its band."""
    bits = best.view(U).reshape(len(best), bands, best.shape[1] // bands)
    key = np.zeros(bits.shape[:2], U) + np.arange(bands, dtype=U) * U(0x2545F4914F6CDD1D)
    for j in range(bits.shape[2]):
        key = mix(key ^ bits[:, :, j])
    return key


def sequence(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a document's word sequence, as two longs; both null-safe zero for no words."""
    wh = c.hashes()
    s, e = c.wbounds[:-1], c.wbounds[1:]
    return signed(spans_hash(wh, s, e)), signed(spans_hash(mix(wh ^ U(0xABCDEF)), s, e))


def _signed_rows(batches):
    for b in batches:
        for c in chunks(b.column("text")):
            ids, doc = strips(c)
            some = np.flatnonzero(c.n_words)
            at = np.zeros(c.n, np.int64)
            at[some] = np.arange(len(some))
            keys = signed(band_keys(signatures(ids, at[doc], len(some)))).reshape(-1)
            bounds = np.concatenate([[0], np.cumsum(np.where(c.n_words > 0, BANDS, 0))])
            part, (s1, s2) = b.slice(c.first, c.n), sequence(c)
            yield pa.RecordBatch.from_arrays(
                [part.column("rid"), part.column("doc_id"), pa.array(s1), pa.array(s2), pa.array(c.n_words.astype(np.int64)),
                 pa.array(np.bincount(doc, minlength=c.n)), lists(keys, bounds)],
                names=["rid", "doc_id", "s1", "s2", "n_words", "weight", "bands"])


def _packed(batches):
    """The sequence name of each text and the compressed text, for the shuffle."""
    pack = ZstdCompressor(level=1).compress
    for b in batches:
        for c in chunks(b.column("text")):
            s1, s2 = sequence(c)
            some = np.flatnonzero(c.n_words)
            yield pa.RecordBatch.from_arrays([pa.array(s1[some]), pa.array(s2[some]), pa.array([pack(c.text(i)) for i in some], pa.binary())],
                                             names=["s1", "s2", "packed"])


def _sets(batches):
    unpack = ZstdDecompressor().decompress
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            texts = pa.array([unpack(x.as_py()).decode() for x in part.column("packed")], pa.large_string())
            for c in chunks(texts):
                ids, doc = strips(c)
                bounds = np.searchsorted(doc, np.arange(c.n + 1))
                yield pa.RecordBatch.from_arrays([part.column("node").slice(c.first, c.n), lists(signed(ids), bounds)], names=["node", "ids"])


def lost_map(ids: Column) -> Column:
    """``MAP`` longs, a bit set for each strip's hash."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def part(k: int) -> Column:
        bit = lambda t: F.call_function("shiftleft", one, t.bitwiseAND(F.lit(63)).cast("int"))
        return F.aggregate(ids, none, lambda s, t: F.when(F.shiftright(t, 6).bitwiseAND(F.lit(MAP - 1)) == k, s.bitwiseOR(bit(t))).otherwise(s))
    return F.array(*(part(k) for k in range(MAP)))


def bits(a: Column, b: Column | None = None) -> Column:
    """The number of bits of a map, or of those that two maps have in common."""
    return sum((F.bit_count(F.get(a, F.lit(k)) if b is None else F.get(a, F.lit(k)).bitwiseAND(F.get(b, F.lit(k)))) for k in range(MAP)), F.lit(0))


def compared(pairs: DataFrame, sets: DataFrame, threshold: float, maps: bool = False) -> DataFrame:
    """``a, b, common, similar``: the strips that two sets share, and whether their weighted Jaccard
    similarity is at least the threshold.  With ``maps`` also ``n_a, n_b``, the sets' sizes, and ``lost_a, lost_b``,
    maps of each set's strips that the other hasn't."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("ids").alias("x")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("ids").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    more = [F.size("x").alias("n_a"), F.size("y").alias("n_b"), lost_map(F.array_except("x", "y")).alias("lost_a"),
            lost_map(F.array_except("y", "x")).alias("lost_b")] if maps else []
    return both.select("a", "b", common.alias("common"), (common >= threshold * (F.size("x") + F.size("y") - common) - 1e-9).alias("similar"), *more)


def _possible(n: str, shared: str, m: str, other: str, threshold: float) -> Column:
    """Whether two sets can be similar, by their sizes and the strips that they share with any other."""
    sizes = F.least(n, m) >= threshold * F.greatest(n, m) - F.lit(1e-9)
    return sizes & (F.least(shared, other) >= threshold / (1 + threshold) * (F.col(n) + F.col(m)) - F.lit(1e-9))


def _shared(sets: DataFrame) -> DataFrame:
    """``node, shared``: how many strips of a node are in another set as well: no pair can share more."""
    once = sets.select("node", F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
    own = once.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    return sets.select("node", F.size("ids").alias("n")).join(own, "node", "left") \
        .select("node", (F.col("n") - F.coalesce("own", F.lit(0))).alias("shared"))


def _members(banded: DataFrame) -> DataFrame:
    """``key, node, weight, lead_met, leader`` of buckets with more than one class.

    The leader is the member that meets the most others over all bands: in a group of copies of one
    text it is likely that text, to which most copies are near.
    """
    sizes = materialize(banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    crowded = materialize(banded.join(sizes, "key"), "crowded")
    met = crowded.groupBy("node").agg(F.sum("n").alias("met"))
    ranked = materialize(crowded.drop("n").join(met, "node"), "ranked")
    first = F.max(F.struct(F.col("met"), (-F.col("node")).alias("node"))).alias("first")
    leaders = materialize(ranked.groupBy("key").agg(first).select("key", F.col("first.met").alias("lead_met"), (-F.col("first.node")).alias("leader")), "leaders")
    return ranked.drop("met").join(leaders, "key")


def with_sequence(docs: DataFrame) -> DataFrame:
    """``docs`` and the two longs ``_s1``, ``_s2`` that name each row's word sequence."""
    def run(batches):
        for b in batches:
            for c in chunks(b.column("text")):
                part, (s1, s2) = b.slice(c.first, c.n), sequence(c)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s1), pa.array(s2)], names=[*part.schema.names, "_s1", "_s2"])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, _s1 long, _s2 long")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, n_words, class_id, representative, s1, s2``: one row per input row.

    ``representative``: one row of the class (least doc_id, nulls last) is true.  Texts are read twice
    and shuffled once, compressed, and only if the classes with a candidate are too many to broadcast.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "rid long, doc_id long, s1 long, s2 long, n_words long, weight long, bands array<long>"
    sig = materialize(rows.mapInArrow(_signed_rows, kinds), "signatures")
    words = sig.where("n_words > 0")
    copies = materialize(words.groupBy("s1", "s2").agg(F.min("rid").alias("node"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "copies")
    named = materialize(sig.join(copies, ["s1", "s2"], "left").withColumn("node", F.coalesce(F.when(F.col("n_words") > 0, F.col("node")), "rid")), "named")
    reps = named.where("node = rid AND n_words > 0")
    members = materialize(_members(reps.select("node", "weight", F.explode("bands").alias("key"))), "members")
    needed = reps.join(members.select("node").distinct(), "node", "left_semi").select("node", "s1", "s2")
    texts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_packed, "s1 long, s2 long, packed binary")
    found = texts.join(small(materialize(needed, "needed"), MAX_BROADCAST), ["s1", "s2"]).select("node", "packed").dropDuplicates(["node"])
    sets = materialize(found.mapInArrow(_sets, "node long, ids array<long>"), "sets")
    members = materialize(members.join(_shared(sets), "node"), "members")
    leads = members.where("node = leader").select("key", F.col("weight").alias("lead_weight"), F.col("shared").alias("lead_shared"))
    near = members.join(leads, "key").where((F.col("node") != F.col("leader")) & _possible("weight", "shared", "lead_weight", "lead_shared", threshold))
    star = materialize(near.select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct(), "pairs")
    star = materialize(compared(star, sets, threshold, maps=True), "compared")
    links = star.where("similar").select("a", "b")
    comps = connected_components(links)
    cross = _cross_pairs(members, star, comps, threshold)
    if not cross.isEmpty():
        links = links.union(compared(cross.join(star, ["a", "b"], "left_anti"), sets, threshold).where("similar").select("a", "b"))
        comps = connected_components(links)
    comps = materialize(comps, "components")
    owned = named.select("rid", "doc_id", "n_words", "node", "s1", "s2").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")).drop("node")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("rid").alias("row")))
    heads = owned.groupBy("comp").agg(first.alias("h"), F.count(F.lit(1)).alias("n")).where("n > 1")
    heads = materialize(heads.select("comp", F.col("h.id").alias("class_id"), F.col("h.row").alias("row")), "heads")
    return owned.join(heads, "comp", "left").select(
        "doc_id", "n_words", F.when(F.col("row").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("row") == F.col("rid"), F.lit(True)).alias("representative"), "s1", "s2")


def _cross_pairs(members: DataFrame, star: DataFrame, comps: DataFrame, threshold: float) -> DataFrame:
    """Pairs of a bucket whose classes lie in different components and may be similar.

    Of each bucket with more than one component, the members outside its largest component are
    joined with the members of the other components, so a large component isn't joined with itself.
    What two members share lies inside or outside any third set, their pivot: inside, it is at most the
    lesser of what they share with the pivot, outside, the lesser of what else they share with any.  A
    member's pivot is the leader of its buckets that meets the most others.  Members with one pivot also
    miss in common at most as many of its strips as their maps of these have equal bits, and one more for
    each strip that a map's bits don't count; what either misses they don't share.
    """
    met = star.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "common", "n_a", "n_b", "lost_a", "lost_b")
    pair = (F.least("leader", "node") == F.col("_a")) & (F.greatest("leader", "node") == F.col("_b"))
    own, first = F.col("leader") == F.col("node"), F.col("leader") == F.col("_a")
    known = members.join(met, pair, "left").withColumn("inside", F.when(own, F.col("weight")).otherwise(F.col("common"))) \
        .withColumn("whole", F.when(own, F.col("weight")).when(first, F.col("n_a")).otherwise(F.col("n_b"))) \
        .withColumn("lost", F.when(own, F.array_repeat(F.lit(0).cast("long"), MAP)).when(first, F.col("lost_a")).otherwise(F.col("lost_b")))
    known = materialize(known.drop(*met.columns), "known")
    pivots = known.where("inside IS NOT NULL").groupBy("node").agg(F.max(F.struct("lead_met", "leader", "inside", "whole", "lost")).alias("best"))
    pivots = materialize(pivots.select("node", F.col("best.leader").alias("pivot"), "best.inside", "best.whole", "best.lost"), "pivots")
    labelled = known.drop("inside", "whole", "lost").join(pivots, "node", "left").join(comps, "node", "left") \
        .select("key", "node", "weight", "shared", "pivot", "inside", "whole", "lost", F.coalesce("comp", "node").alias("comp"))
    labelled = materialize(labelled, "labelled")
    parts = labelled.groupBy("key", "comp").count()
    main = parts.groupBy("key").agg(F.max(F.struct("count", "comp")).alias("m"), F.count(F.lit(1)).alias("n")).where("n > 1") \
        .select("key", F.col("m.comp").alias("main"))
    mixed = materialize(labelled.join(main, "key"), "mixed")
    rest = mixed.where("comp != main").select("key", F.col("node").alias("p"), F.col("weight").alias("pw"), F.col("shared").alias("ps"),
                                              F.col("inside").alias("pi"), F.col("pivot").alias("pp"), F.col("lost").alias("pl"), F.col("comp").alias("pc"))
    outside = F.least(F.col("ps") - F.col("pi"), F.col("shared") - F.col("inside"))
    uncounted = F.least(F.col("whole") - F.col("pi") - bits(F.col("pl")), F.col("whole") - F.col("inside") - bits(F.col("lost")))
    both_lost = bits(F.col("pl"), F.col("lost")) + uncounted
    most = F.least(F.col("pi"), F.col("inside"), F.col("pi") + F.col("inside") - F.col("whole") + both_lost) + outside
    enough = threshold / (1 + threshold) * (F.col("pw") + F.col("weight")) - F.lit(1e-9)
    pairs = rest.join(mixed, "key").where((F.col("pc") != F.col("comp")) & _possible("pw", "ps", "weight", "shared", threshold)
                                          & F.coalesce((F.col("pp") != F.col("pivot")) | (most >= enough), F.lit(True)))
    return materialize(pairs.select(F.least("p", "node").alias("a"), F.greatest("p", "node").alias("b")).distinct(), "cross")


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stand for their class, with its columns.

    A kept row is found again by its id and word sequence; of rows that agree in both, one stays.
    """
    kept = near_duplicates(docs, threshold).where("representative AND n_words > 0")
    kept = materialize(kept.select(F.col("doc_id").alias("_id"), F.col("s1").alias("_k1"), F.col("s2").alias("_k2")).distinct(), "kept")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_s1") == F.col("_k1")) & (F.col("_s2") == F.col("_k2"))
    has_words = F.coalesce(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    found = with_sequence(docs.where(has_words)).join(kept, same, "left_semi")
    return found.dropDuplicates(["doc_id", "_s1", "_s2"]).select(*docs.columns).unionByName(docs.where(~has_words))
