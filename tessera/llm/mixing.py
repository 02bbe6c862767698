"""Operator 3, mixing sources to target weights: Efraimidis-Spirakis sampling in DataFrame functions only.

Every document gets the key ``-ln(u) / weight`` (``u`` from a hash of its id, so reruns agree); within
its source, documents are ordered by key and their sizes prefix-summed.  A source whose target is
``e`` times its size and a rest gives every document ``e`` times (complete epochs), and the rest goes
to the documents with the smallest keys: a document is taken once more if the middle of its span of
words lies within the rest, so a source misses its target by half a document at most.

Targets are shares by weight of all words, each held at ``max_epochs`` times its source's size, the
excess reshared by weight over the others until none is above.

Null texts have size 0.  A null source is one source, ordered last.  Null, non-positive or missing
quality weights count as 1.  Repeated rows share a key, and are ordered by size and taken alike or
split at the cut (which of two equal rows is taken makes no difference to the mix).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.sizes import small
from tessera.operators.common import dense_number
from tessera.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
ROWS_PER_BIN = 2_000
#: Quality weight of a document by its label; unlabelled documents lie between.
LABEL_WEIGHTS = {1: 4.0, 0: 1.0}
UNLABELLED = 2.0
#: Rows (of about 40 bytes) of a lookup table that may be broadcast.
MAX_BROADCAST = 300_000


def uniform(col: str, seed: str) -> Column:
    """A number in (0, 1) from the md5 of a seed and a value (52 bits)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(col).cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def label_weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, quality_weight`` of the labelled documents, one row an id (its best label)."""
    best = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("q"))
    return best.select("doc_id", F.when(F.col("q") == 1, LABEL_WEIGHTS[1]).otherwise(LABEL_WEIGHTS[0]).alias("quality_weight"))


def source_targets(sizes: DataFrame, weights: Sequence[float], max_epochs: float) -> DataFrame:
    """``source, no_source, source_size, target``: one row a source.

    Resharing runs until no further source reaches its cap; a pass is one aggregate that brings two
    sums to the driver.  Sources are numbered by a range sort, not in one task.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"),
                                      F.min("weight").alias("min_weight"))
    per = per.withColumn("no_source", F.col("source").isNull())
    per = dense_number(per, ["no_source", "source"], out="pos")
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.col("pos") % len(weights) + 1).cast("int"))
    per = materialize(per.withColumn("w", w).withColumn("cap", max_epochs * F.col("source_size").cast("double")), "sources")
    total, level, n_capped = float(per.agg(F.sum("source_size")).first()[0] or 0), 0.0, -1
    while True:
        at_cap = F.col("cap") <= F.lit(level) * F.col("w")
        n, held, free = per.agg(F.count(F.when(at_cap, 1)), F.coalesce(F.sum(F.when(at_cap, F.col("cap"))), F.lit(0.0)),
                                F.coalesce(F.sum(F.when(~at_cap, F.col("w"))), F.lit(0.0))).first()
        if n == n_capped or not free:
            break
        n_capped, level = n, max(level, (total - held) / free)
    target = F.least(F.col("cap"), F.lit(level) * F.col("w"))
    return per.select("source", "no_source", "source_size", "n_docs", "min_weight", target.alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None = None, weights: Sequence[float] = WEIGHTS,
        max_epochs: float = MAX_EPOCHS, seed: str = "mix", default_weight: float = UNLABELLED) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source, copies, text_hash`` for every row of ``docs``.

    ``quality``: ``doc_id, quality_weight``.  Prefix sums run in two levels, so that a source with
    most of the rows isn't one task: a document's bin is a monotone function of its key, with about
    ``ROWS_PER_BIN`` rows a bin (times the largest over the smallest weight of the source at most);
    sums run within a bin and over the totals of a source's bins.
    """
    rows = docs.select(F.col("doc_id"), F.col("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64("text").alias("text_hash"))
    if quality is not None:
        rows = rows.join(quality.select("doc_id", F.col("quality_weight").alias("weight")), "doc_id", "left")
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.lit(default_weight if quality is not None else 1.0))
    rows = rows.withColumn("weight", weight).withColumn("u", uniform("doc_id", seed))
    sizes = materialize(rows.withColumn("key", -F.log("u") / F.col("weight")).drop("u"), "sizes")
    per = materialize(source_targets(sizes, weights, max_epochs), "targets")
    rows = sizes.join(per.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    bins = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / ROWS_PER_BIN))
    rows = rows.withColumn("bin", F.least(bins - 1, F.floor(bins * (1 - F.exp(-F.col("key") * F.col("min_weight"))))))
    by = ["no_source", "source", "bin"]
    totals = rows.groupBy(*by).agg(F.sum("size").alias("bin_size"))
    before = Window.partitionBy("no_source", "source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*by, F.coalesce(F.sum("bin_size").over(before), F.lit(0)).alias("bin_start"))
    totals = totals.withColumnsRenamed({x: f"_{x}" for x in by})
    within = Window.partitionBy(*by).orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("upto", F.sum("size").over(within)).join(
        totals, (F.col("no_source") == F.col("_no_source")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("bin") == F.col("_bin")))
    size = F.col("source_size").cast("double")
    epochs = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0))
    rest = F.col("target") - epochs * size
    middle = F.col("bin_start") + F.col("upto") - F.col("size") / 2
    copies = (epochs + F.when((F.col("size") > 0) & (middle < rest), 1).otherwise(0)).cast("long")
    return placed.withColumn("copies", F.least(copies, F.lit(int(max_epochs)))) \
        .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies", "text_hash")


def mixed(docs: DataFrame, quality: DataFrame | None = None, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its columns.  Rows that agree
    in doc_id, source and text are taken as often as the one of them that is taken most."""
    by = ["doc_id", "source", "text_hash"]
    taken = mix(docs, quality, **options).where("copies > 0").groupBy(*by).agg(F.max("copies").cast("int").alias("_copies"))
    taken = materialize(taken.withColumnsRenamed({x: f"_{x}" for x in by}), "taken")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.xxhash64("text") == F.col("_text_hash"))
    return docs.join(small(taken, MAX_BROADCAST), same).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)
