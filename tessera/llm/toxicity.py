"""Operator 4, toxicity: class-conditional Kneser-Ney models of spelling and of word pairs.

A text is read as words, case folded and without punctuation, and a word as bytes between marks for
its start and end.  For each class, toxic and ordinary, an interpolated Kneser-Ney model predicts the
next byte from up to ``ORDER - 1`` bytes of the word, so that insults are known by their stems; both
classes back off to one shared Kneser-Ney chain of continuation counts, through every order down to
single bytes, so that a rare expression that only one class has seen weighs little.  Beside it, a model
of the same kind predicts each word from the word before it, so that phrases of ordinary words are
learned too; it backs off to shared continuation counts of words.  A gram of bytes counts once for each
distinct word of a document that holds it, a pair of words once a document; grams of a single document count as well.

A word's log-likelihood ratio is the sum over its bytes of toxic minus ordinary log-probability; a
document's measures are ratios normalised by length: over all of its words, over its worst
``WINDOW``-word stretch, its worst word's, the mean and worst of its word pairs, and the numbers of words above some ratios against its
length.  Logistic regression on a fold of its own turns them into a score from 0 to 1.

Labels are read only from rows whose crc32(doc_id) mod 5 is not 0 (1 to 3 are counted, 4 calibrates),
at most ``max_labels`` of a class (and those whose 53-bit id hash ties with the last), smallest id hash first;
every whole text is scored.  Spark counts, smooths and compares the models' grams; the driver only gets a key and a
log ratio of each (12 bytes) for the lookup that tasks share.  Without labels
of both classes every score is 0.  Null and wordless texts score like a text of unknown words.
Repeated rows score alike; null ids are not held out.  An empty table gives no rows.  Extra columns don't
matter, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.importance import kth_largest
from tessera.llm.words import BYTES, FOLD, SPACE, Chunk, U, chunks, mix, signed, spans_hash
from tessera.session import written

ORDER = 8
DISCOUNT = 0.75
WINDOW = 32
#: Words with a log ratio above each of these are counted.
LEAST = (3.0, 5.0, 7.0)
MEASURES = ["mean_ratio", "window_ratio", "word_ratio", "pair_ratio", "pair_worst", *(f"log_over_{int(x)}" for x in LEAST), "log_words"]
MAX_LABELS = 5_000
#: Bytes of text of a chunk: the larger, the fewer distinct words are scored again, and the more memory a task takes.
CHUNK = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_START, _END = 1, 2


def plain(c: Chunk) -> Chunk:
    """The chunk with case folded and punctuation and digits left out."""
    d = FOLD[c.data]
    accent = np.flatnonzero((d[:-1] == 0xC3) & (d[1:] >= 0x80) & (d[1:] < 0x9F))
    d[accent + 1] += 0x20
    keep = _LETTER[d] | SPACE[d]
    at = np.concatenate([[0], np.cumsum(keep)])
    return Chunk(d[keep], at[c.offs], c.first)


def spelled(c: Chunk, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, first byte, end) of the named words, each between its marks, end to end."""
    size = c.ends[words] - c.starts[words]
    end = np.cumsum(size + 2)
    begin = end - size - 2
    out = np.full(int(end[-1]) if len(end) else 0, _END, np.uint8)
    out[begin] = _START
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(begin + 1, size) + inner] = c.data[np.repeat(c.starts[words], size) + inner]
    return out, begin, end


def histories(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each predicted byte: its word, its place, hash of its context, hash of context and byte."""
    size = end - begin - 1
    word = np.repeat(np.arange(len(begin)), size)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin + 1, size)
    low = np.maximum(begin[word], at - ORDER + 1)
    values = BYTES[text]
    return word, at, spans_hash(values, low, at), spans_hash(values, low, at + 1)


class Lookup:
    """Values by 64-bit key: keys sorted, found by their upper bits; 0 where a key is missing."""

    BITS = 16

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.float32)
        bits = max(1, min(20, int(np.ceil(np.log2(len(keys) + 1)))))
        self.shift = U(64 - bits)
        self.at = np.searchsorted(self.keys >> self.shift, np.arange((1 << bits) + 1, dtype=U)).astype(np.int32)
        self.most = int(np.diff(self.at).max()) if len(keys) else 0

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.float32)
        if not len(self.keys):
            return out
        top = (keys >> self.shift).astype(np.int64)
        place, stop = self.at[top], self.at[top + 1]
        live = np.flatnonzero(place < stop)
        for _ in range(self.most):
            if not len(live):
                break
            p = place[live]
            hit = self.keys[p] == keys[live]
            out[live[hit]] = self.values[p[hit]]
            live = live[~hit]
            place[live] += 1
            live = live[place[live] < stop[live]]
        return out


@dataclass
class Model:
    """``known``: log ratio of a (context, byte); ``backoff``: of any other byte after the context;
    ``weights``: of the logistic regression on the measures and 1."""

    known: Lookup
    backoff: Lookup
    weights: np.ndarray
    #: The same of (word before, word).
    pairs: Lookup | None = None
    pair_backoff: Lookup | None = None

    def words(self, c: Chunk) -> np.ndarray:
        """The log ratio of every word of a plain chunk; each distinct word is scored once."""
        if not len(c.starts):
            return np.zeros(0)
        _, first, back = np.unique(c.hashes(), return_index=True, return_inverse=True)
        word, _, context, key = histories(*spelled(c, first))
        gram = self.known(key)
        gram = np.where(gram != 0, gram, self.backoff(context))
        return np.bincount(word, weights=gram, minlength=len(first))[back]

    def followed(self, c: Chunk) -> np.ndarray:
        """The log ratio of every word of a plain chunk after the word before it."""
        if not len(c.starts) or self.pairs is None or self.pair_backoff is None:
            return np.zeros(len(c.starts))
        context, _, key = word_pairs(c)
        gram = self.pairs(key)
        return np.where(gram != 0, gram, self.pair_backoff(context))

    def measures(self, c: Chunk) -> np.ndarray:
        """Documents x measures."""
        c = plain(c)
        ratio = self.words(c)
        n = np.maximum(c.n_words, 1)
        total = np.concatenate([[0.0], np.cumsum(ratio)])
        out = np.zeros((c.n, len(MEASURES)))
        out[:, 0] = c.sums(ratio) / n
        s, bound = np.arange(len(ratio)), c.wbounds[1:][c.doc]
        window = (total[np.minimum(s + WINDOW, bound)] - total[s]) / WINDOW
        some = np.flatnonzero(c.n_words)
        if len(some):
            at = c.wbounds[:-1][some]
            out[some, 1] = np.maximum.reduceat(window, at)
            out[some, 2] = np.maximum.reduceat(ratio, at)
        after = self.followed(c)
        out[:, 3] = c.sums(after) / n
        if len(some):
            out[some, 4] = np.maximum.reduceat(after, at)
        for i, least in enumerate(LEAST):
            out[:, 5 + i] = np.log1p(c.sums(ratio > least))
        out[:, -1] = np.log1p(c.n_words)
        return out

    def scores(self, measures: np.ndarray) -> np.ndarray:
        z = measures @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def word_pairs(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word: hash of the word before it (of a document's start, 0), its own, of both."""
    own = c.hashes()
    before = np.zeros(len(own), U)
    before[1:] = own[:-1]
    before[c.wbounds[:-1][c.n_words > 0]] = 0
    return before, own, pair_key(before, own)


def pair_key(before: np.ndarray, own: np.ndarray) -> np.ndarray:
    return mix(mix(before) ^ own)


def hashed(packed: np.ndarray) -> np.ndarray:
    """The hashes of packed grams' bytes."""
    out = np.zeros(len(packed), U)
    for at in range(0, len(packed), 1 << 17):  # bounds the memory of the bytes
        some = packed[at:at + (1 << 17)]
        each = (some[:, None] >> (U(8) * np.arange(ORDER, dtype=U)[::-1]) & U(255)).astype(np.uint8)
        end = np.cumsum((each != 0).sum(1))
        begin = np.concatenate([[0], end[:-1]]).astype(np.int64)
        out[at:at + (1 << 17)] = spans_hash(BYTES[each[each != 0]], begin, end)
    return out


def _last(packed: Column, n: Column) -> Column:
    """The last ``n`` bytes of a packed gram."""
    return packed.bitwiseAND(F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), F.lit(64) - 8 * n))


def lower_orders(grams: DataFrame) -> DataFrame:
    """``packed, lower``: the shared probability of each distinct gram's last byte after its context without
    the first byte, by Kneser-Ney's orders on the numbers of distinct bytes before a gram.

    An order's probability is ``a + b * (that of the next lower order)``: all orders' ``a`` and ``b`` are
    counted at once, and a gram folds those of its own endings (at most ``ORDER - 1``)."""
    size = F.ceil(F.length(F.hex("packed")) / 2).cast("int")
    endings = grams.select("packed", size.alias("size")).where("size > 1").select("packed", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("n"))
    longer = endings.select("n", _last(F.col("packed"), F.col("n") + 1).alias("x")).distinct()
    types = longer.groupBy("n", _last(F.col("x"), F.col("n")).alias("id")).agg(F.count(F.lit(1)).alias("types")).withColumn("back", F.shiftrightunsigned("id", 8))
    types = written(types, "orders")
    totals = types.groupBy("n", "back").agg(F.sum("types").alias("total"), F.count(F.lit(1)).alias("kinds"))
    first = F.col("n") == 1
    a = F.when(first, F.col("types") / F.col("total")).otherwise((F.col("types") - DISCOUNT) / F.col("total"))
    b = F.when(first, 0.0).otherwise(DISCOUNT * F.col("kinds") / F.col("total"))
    steps = types.join(totals, ["n", "back"]).select("n", "id", a.alias("a"), b.alias("b"))
    each = endings.withColumn("id", _last(F.col("packed"), F.col("n"))).join(steps, ["n", "id"])
    of = range(1, ORDER)
    # dealt by gram as narrow rows: an aggregate before the shuffle would find no two of one gram
    wide = each.select("packed", "n", "a", "b").repartition("packed").groupBy("packed").agg(*(F.max(F.when(F.col("n") == n, F.col(x))).alias(f"{x}{n}") for n in of for x in "ab"))
    lower = F.lit(0.0)
    for n in of:  # orders that a gram is too short for leave the value as it is
        lower = F.coalesce(f"a{n}", F.lit(0.0)) + F.coalesce(f"b{n}", F.lit(1.0)) * lower
    return wide.select("packed", lower.alias("lower"))


def ratios(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key, ratio`` of ``key, context, toxic, ordinary, lower``: the log ratio of the classes' interpolated
    models, ``lower`` being the probability that they share; and ``context, ratio`` of any other gram."""
    grams = written(grams, "named")  # read twice
    sums = [x for k in ("toxic", "ordinary") for x in (F.sum(k).alias(f"n_{k}"), F.count_if(F.col(k) > 0).alias(f"types_{k}"))]
    # one unseen gram is added to every context, so that classes that never saw it back off alike
    rest = {k: ((DISCOUNT * F.col(f"types_{k}") + 1) / (F.col(f"n_{k}") + 1)).alias(f"rest_{k}") for k in ("toxic", "ordinary")}
    contexts = written(grams.groupBy("context").agg(*sums).select("context", "n_toxic", "n_ordinary", *rest.values()), "contexts")

    def p(k: str) -> Column:
        seen = F.greatest(F.col(k) - DISCOUNT, F.lit(0.0)) / (F.col(f"n_{k}") + 1)
        return F.log(F.greatest(seen + F.col(f"rest_{k}") * F.col("lower"), F.lit(1e-12)))
    ratio = p("toxic") - p("ordinary")
    known = grams.join(contexts, "context").select("key", F.when(ratio == 0, 1e-9).otherwise(ratio).cast("float").alias("ratio"))
    back = F.log("rest_toxic") - F.log("rest_ordinary")
    return known, contexts.select("context", back.cast("float").alias("ratio"))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (the last is the constant's) by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    scale = np.maximum(np.abs(x).max(0), 1e-9)
    x = x / scale
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def count(c: Chunk, toxic: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct grams of a chunk: counts of each class, all bytes in one number."""
    c = plain(c)
    wh = c.hashes()
    pair = np.unique(np.column_stack([c.doc.astype(U), wh]), axis=0, return_index=True)[1] if len(wh) else np.zeros(0, int)
    text, begin, end = spelled(c, pair)
    word, at, _, key = histories(text, begin, end)
    is_toxic = toxic[c.doc[pair][word]]
    ids, first, back = np.unique(key, return_index=True, return_inverse=True)
    both = [np.bincount(back, weights=w, minlength=len(ids)).astype(np.int64) for w in (is_toxic, ~is_toxic)]
    packed = np.zeros(len(ids), U)
    for i in range(ORDER):
        inside = at[first] - i >= begin[word[first]]
        packed[inside] |= text[at[first][inside] - i].astype(U) << U(8 * i)
    return *both, signed(packed)


def count_pairs(c: Chunk, toxic: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct word pairs of a chunk: key, context, word, documents of each class."""
    c = plain(c)
    context, own, key = word_pairs(c)
    once = np.unique(np.column_stack([c.doc.astype(U), key]), axis=0, return_index=True)[1] if len(key) else np.zeros(0, int)
    is_toxic = toxic[c.doc[once]]
    ids, first, back = np.unique(key[once], return_index=True, return_inverse=True)
    both = [np.bincount(back, weights=w, minlength=len(ids)).astype(np.int64) for w in (is_toxic, ~is_toxic)]
    return signed(ids), signed(context[once][first]), signed(own[once][first]), *both


_GRAM = ["toxic", "ordinary", "packed"]
_PAIR = ["key", "context", "word", "toxic", "ordinary"]


def _counted(counter, names: list[str]):
    def run(batches):
        for b in batches:
            toxic = b.column("toxic").to_numpy(zero_copy_only=False) == 1
            for c in chunks(b.column("text"), CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in counter(c, toxic[c.first:c.first + c.n])], names=names)
    return run


def _measured(box, weights: np.ndarray):
    """``box``: the model as a broadcast variable, so that it is shipped once."""
    def run(batches):
        model = replace(box.value, weights=weights)
        for b in batches:
            for c in chunks(b.column("text"), CHUNK):
                m = model.measures(c)
                part = b.slice(c.first, c.n)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(np.ascontiguousarray(x)) for x in m.T), pa.array(model.scores(m))],
                                                 names=["doc_id", *MEASURES, "score"])
    return run


_SCHEMA = ", ".join(["doc_id long", *(f"{x} double" for x in MEASURES), "score double"])


def _arrays(df: DataFrame) -> dict[str, np.ndarray]:
    table = df.toArrow()
    return {x: table.column(x).to_numpy() for x in table.column_names}


def label_sample(labels: DataFrame, max_labels: int) -> DataFrame:
    """``doc_id, toxic, fold``: ``max_labels`` rows of each class by the least id hash (more only if 53 bits
    of it tie), so it may be broadcast.  The cut is found by counting, no task sorts a class."""
    fold = (F.crc32(F.col("doc_id").cast("string")) % 5).cast("int")
    one = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    place = (-F.shiftright(F.xxhash64("doc_id", F.lit(4)), 11)).cast("double")
    one = written(one.withColumn("fold", fold).where("fold != 0").withColumn("place", place), "labels")
    kept = F.lit(True)
    for r in one.groupBy("toxic").count().collect():
        if r["count"] > max_labels:
            kept &= (F.col("toxic") != r.toxic) | (F.col("place") >= kth_largest(one.where(F.col("toxic") == r.toxic), "place", max_labels))
    return one.where(kept).drop("place")


def _summed(counted: DataFrame, counter, names: list[str]) -> DataFrame:
    """The summed counts of all distinct grams, written once."""
    counts = ["toxic", "ordinary"]
    found = counted.mapInArrow(_counted(counter, names), ", ".join(f"{x} long" for x in names))
    return written(found.groupBy(*(x for x in names if x not in counts)).agg(*(F.sum(x).alias(x) for x in counts)), "grams")


def spelling(counted: DataFrame) -> tuple[Lookup, Lookup]:
    """The ratios of bytes after their contexts, and of other bytes, from ``text, toxic``."""
    grams = _summed(counted, count, _GRAM)
    named = grams.withColumnRenamed("packed", "key").join(lower_orders(grams).withColumnRenamed("packed", "key"), "key")
    found = ratios(named.withColumn("context", F.shiftrightunsigned("key", 8)))
    return tuple(_lookup(x, hashed) for x in found)


def pair_model(counted: DataFrame) -> tuple[Lookup, Lookup]:
    """The ratios of words after the word before them, and of other words, from ``text, toxic``."""
    pairs = _summed(counted, count_pairs, _PAIR)
    times = written(pairs.groupBy("word").agg(F.count(F.lit(1)).alias("times")), "words")
    total = times.agg(F.sum("times")).first()[0]
    found = ratios(pairs.join(times, "word").withColumn("lower", F.col("times") / F.lit(total)))
    return tuple(_lookup(x) for x in found)


def _lookup(found: DataFrame, key=lambda x: x) -> Lookup:
    keys, values = _arrays(written(found, "ratios")).values()
    return Lookup(key(np.ascontiguousarray(keys).view(U)), values)


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> Model:
    return _fitted(docs, labels, max_labels)[0]


def _fitted(docs: DataFrame, labels: DataFrame, max_labels: int):
    """The model, and a broadcast of it without the weights.  Spark makes it from the sample's distinct texts."""
    empty = Lookup(np.zeros(0, U), np.zeros(0))
    none = Model(empty, empty, np.zeros(len(MEASURES) + 1))
    none.weights[-1] = -500.0
    context = docs.sparkSession.sparkContext
    sample = label_sample(labels, max_labels).persist()
    sizes = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return none, context.broadcast(none)
    labelled = written(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["text", "toxic", "fold"]), "labelled")
    counted = labelled.where("fold < 4").select("text", "toxic")
    model = Model(*spelling(counted), none.weights, *pair_model(counted))
    box = context.broadcast(model)
    rows = labelled.where("fold = 4").select("doc_id", "text").mapInArrow(_measured(box, none.weights), _SCHEMA).join(F.broadcast(sample), "doc_id")
    calibration = _arrays(rows.select(*MEASURES, "toxic"))
    sample.unpersist()
    if len(set(calibration["toxic"])) < 2:
        return none, context.broadcast(none)
    weights = logistic(np.column_stack([calibration[x] for x in MEASURES]), calibration["toxic"])
    return replace(model, weights=weights), box


def toxicity(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the measures, one row per input row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model, box = _fitted(rows, labels, max_labels)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return rows.mapInArrow(_measured(box, model.weights), _SCHEMA).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *MEASURES)
