"""Operator 10, quality classifier: importance resampling with hashed n-gram models.

Two bag-of-n-grams models over ``SLOTS`` hashed features are counted, one of target text (documents
labelled good) and one of raw text (every document).  A document's log importance weight is the sum
over its n-grams of ``log p_target - log p_raw``; documents are then drawn without replacement by
Gumbel top-k: the k largest of weight plus Gumbel noise stay, k being the number of documents whose
weight is at or above the cut that best parts good from bad labels (losing a good one counts tenfold).

The features are words and runs of one to three word *shapes* (case, digits, symbols, punctuation,
length, line start, whether the word repeats one of the two before it), so that the models judge
words that they have never seen.

Labels: a bounded sample of ``max_labels`` rows, smallest id hash first, from rows whose crc32(doc_id)
mod 5 is not 0; residues 1 to 3 count the target model and residue 4 sets the cut.  Without labels of
both kinds nothing is rejected.  The raw model, the weights and the selection cover every document.

Null and wordless texts have weight 0.  Null ids draw noise as an id of their own; repeated rows draw
alike, and rows tied with the k-th all stay.  An empty table gives an empty one.  Extra columns are passed
through by ``select_good``, also those called like its working columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.mixing import uniform
from tessera.llm.words import FOLD, U, chunks, mix
from tessera.session import bound_batches, materialize

SLOTS = 1 << 16
MAX_LABELS = 20_000
SMOOTHING = 5.0
GOOD_COST = 10.0
#: Bytes of text that are turned into features at once: a word takes some 500 bytes of arrays then.
MAX_BYTES = 1 << 18

_KIND = np.zeros(256, np.int64)
_KIND[65:91] = 1
_KIND[97:123] = 1 << 16
_KIND[48:58] = 1 << 32
for _c in "#*$%&|<>":
    _KIND[ord(_c)] = 1 << 48


def shapes(c, wh: np.ndarray) -> np.ndarray:
    """A small code of each word's look and of its repetition."""
    d, s, e = c.data, c.starts, c.ends
    kind = _KIND[d]
    accent = np.flatnonzero((d[:-1] == 0xC3) & (d[1:] >= 0x80))
    kind[accent] += np.where(d[accent + 1] < 0x9F, 1, 1 << 16)
    total = np.concatenate([[0], np.cumsum(kind)])
    seen = total[e] - total[s]  # four counters of 16 bits; in words of over 65,535 bytes they run into one another
    up, lo, digit, symbol = (seen >> shift & 0xFFFF for shift in (0, 16, 32, 48))
    last = d[e - 1] if len(e) else np.zeros(0, np.uint8)
    last2 = d[np.maximum(e - 2, s)] if len(e) else last
    code = (kind[s] == 1).astype(np.int64)
    code |= ((up > 1) & (lo == 0)) * 2 | (digit > 0) * 4 | (symbol > 0) * 8
    code |= np.isin(last, [46, 33, 63]) * 16 | (last == 44) * 32 | ((last == 33) & (last2 == 33)) * 64
    size = e - s
    code |= ((size > 2).astype(np.int64) + (size > 5) + (size > 9)) << 7
    for back in (1, 2):
        same = np.zeros(len(wh), bool)
        same[back:] = (wh[back:] == wh[:-back]) & (c.doc[back:] == c.doc[:-back])
        code |= same.astype(np.int64) << (8 + back)
    nl = np.cumsum(d == 10)
    start = np.ones(len(wh), bool)
    start[1:] = (nl[s[1:]] != nl[s[:-1]]) | (c.doc[1:] != c.doc[:-1])
    return code | start.astype(np.int64) << 11


def features(c) -> tuple[np.ndarray, np.ndarray]:
    """(document, slot) of every n-gram of a chunk."""
    if not len(c.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    wh = c.hashes(FOLD)
    shape = mix(shapes(c, wh).astype(U))
    docs, slots = [c.doc], [mix(wh ^ U(11))]
    for k in (1, 2, 3):
        h, ok = c.grams(shape, k)
        docs.append(c.doc[ok])
        slots.append(mix(h[ok] ^ U(100 + k)))
    return np.concatenate(docs), (np.concatenate(slots) & U(SLOTS - 1)).astype(np.int64)


@dataclass
class Model:
    """``ratio``: log p_target - log p_raw by slot; ``cut``: the least weight of a good document."""

    ratio: np.ndarray
    cut: float = float("-inf")


def ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log p_target / p_raw by slot, both with ``SMOOTHING`` pseudo-counts of target size a slot, so
    that slots with few counts weigh little and unseen ones nothing."""
    expected = raw * (target.sum() / max(raw.sum(), 1.0))
    return np.log((target + SMOOTHING) / (expected + SMOOTHING))


def weigh(ratio: np.ndarray, c) -> tuple[np.ndarray, np.ndarray]:
    """(log importance weight, number of n-grams) of a chunk's documents."""
    doc, slot = features(c)
    n = np.bincount(doc, minlength=c.n)
    return np.bincount(doc, weights=ratio[slot], minlength=c.n).astype(np.float64), n


def best_cut(weight: np.ndarray, good: np.ndarray, cost: float = GOOD_COST) -> float:
    """The cut with the fewest errors, a rejected good document counting as ``cost`` kept bad ones."""
    if not good.any() or good.all():
        return float("-inf")
    order = np.argsort(weight, kind="stable")
    w, g = weight[order], good[order]
    gain = np.concatenate([[0], np.cumsum(np.where(g, -cost, 1.0))])
    gain[1:-1][w[1:] == w[:-1]] = -np.inf
    at = int(np.argmax(gain))
    return float("-inf") if at == 0 else float("inf") if at == len(w) else float((w[at - 1] + w[at]) / 2)


def label_sample(labels: DataFrame, max_labels: int) -> DataFrame:
    """``doc_id, good, fold``: at most ``max_labels`` rows, so it may be broadcast."""
    fold = (F.crc32(F.col("doc_id").cast("string")) % 5).cast("int")
    one = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("good"))
    return one.withColumn("fold", fold).where("fold != 0").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(max_labels)


def _counted(batches):
    raw, target = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    for b in batches:
        is_target = b.column("target").to_numpy(zero_copy_only=False).astype(bool)
        for c in chunks(b.column("text"), MAX_BYTES):
            doc, slot = features(c)
            raw += np.bincount(slot, minlength=SLOTS)
            target += np.bincount(slot[is_target[c.first:c.first + c.n][doc]], minlength=SLOTS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["slot", "raw", "target"])


def free(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it until no column is called so (in any case)."""
    while name.lower() in {x.lower() for x in taken}:
        name = f"_{name}"
    return name


def _weighing(ratio: np.ndarray, passed: list[str], names: list[str]):
    def run(batches):
        for b in batches:
            for c in chunks(b.column("text"), MAX_BYTES):
                w, n = weigh(ratio, c)
                part = b.slice(c.first, c.n)
                yield pa.RecordBatch.from_arrays([*(part.column(x) for x in passed), pa.array(w), pa.array(n.astype(np.int64))], names=[*passed, *names])
    return run


def weighed(docs: DataFrame, ratio: np.ndarray, passed: list[str]) -> DataFrame:
    """``passed`` columns of ``docs`` (its column ``text`` is read), ``log_weight`` and ``n_grams`` (see ``free``
    for tables that have such columns themselves)."""
    bound_batches(docs.sparkSession)
    names = [free(x, passed) for x in ("log_weight", "n_grams")]
    cols = list(dict.fromkeys([*passed, "text"]))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*passed).schema)
    return docs.select(*cols).mapInArrow(_weighing(ratio, passed, names), f"{kinds}, `{names[0]}` double, `{names[1]}` long")


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> Model:
    """Both models: one pass over all documents brings two counts a slot to the driver."""
    bound_batches(docs.sparkSession)
    sample = label_sample(labels, max_labels)
    target = sample.where("good = 1 AND fold < 4").select("doc_id", F.lit(True).alias("target"))
    marked = docs.select("doc_id", "text").join(F.broadcast(target), "doc_id", "left") \
        .select("text", F.coalesce("target", F.lit(False)).alias("target"))
    counts = marked.mapInArrow(_counted, "slot long, raw long, target long").groupBy("slot").agg(F.sum("raw"), F.sum("target")).collect()
    raw, good = np.zeros(SLOTS), np.zeros(SLOTS)
    for slot, r, t in counts:
        raw[slot], good[slot] = r, t
    return Model(ratios(good, raw))


def gumbel(col: str = "doc_id", seed: str = "gumbel") -> Column:
    return -F.log(-F.log(uniform(col, seed)))


def kth_largest(df: DataFrame, col: str, k: int, steps: int = 1024) -> float:
    """The k-th largest value, by counting in ever finer ranges: a pass brings ``steps`` counts to the
    driver, and no rows are sorted.  Values must be finite."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    above = 0
    while hi > lo:
        width = (hi - lo) / steps
        if lo + width == lo or hi - width == hi:
            break
        bin_ = F.least(F.floor((F.col(col) - lo) / width), F.lit(steps - 1))
        counts = {int(r[0]): (r[1], r[2], r[3]) for r in df.where((F.col(col) >= lo) & (F.col(col) <= hi))
                  .groupBy(bin_).agg(F.count(F.lit(1)), F.min(col), F.max(col)).collect()}
        for i in sorted(counts, reverse=True):
            n, low, high = counts[i]
            if above + n >= k:
                lo, hi = low, high
                break
            above += n
    values = df.where((F.col(col) >= lo) & (F.col(col) <= hi)).groupBy(col).count().orderBy(F.desc(col)).limit(steps).collect()
    for value, n in values:
        above += n
        if above >= k:
            return value
    return lo


def train(docs: DataFrame, labels: DataFrame, scores: DataFrame, model: Model, max_labels: int = MAX_LABELS) -> Model:
    """Sets the cut from the fold kept for it: at most ``max_labels`` weights reach the driver."""
    sample = label_sample(labels, max_labels).where("fold = 4").select("doc_id", "good")
    rows = scores.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.max("log_weight"), F.max("good")).collect()
    model.cut = best_cut(np.array([r[1] for r in rows]), np.array([r[2] == 1 for r in rows], bool))
    return model


def resample(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> tuple[DataFrame, Model, float]:
    """``doc_id, log_weight, n_grams, gumbel_key, selected`` for every row, the model, and the key at the cut."""
    model = fit(docs, labels, max_labels)
    scores = weighed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model.ratio, ["doc_id"])
    scores = materialize(scores.withColumn("gumbel_key", F.col("log_weight") + gumbel()), "weights")
    model = train(docs, labels, scores, model, max_labels)
    k = scores.where(F.col("log_weight") >= model.cut).count()
    least = kth_largest(scores, "gumbel_key", k) if k else float("inf")
    return scores.withColumn("selected", F.col("gumbel_key") >= F.lit(least)), model, least


def select_good(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """The selected rows of ``docs``, with its columns: the weights are recomputed in the same pass
    that reads the rows, so the texts aren't shuffled."""
    _, model, least = resample(docs, labels, max_labels)
    rows = weighed(docs, model.ratio, docs.columns)
    return rows.where(F.col(free("log_weight", docs.columns)) + gumbel() >= F.lit(least)).select(*docs.columns)
