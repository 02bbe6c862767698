import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import importance as I

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = {r.doc_id: r for r in I.resample(docs, labels)[0].collect()}
    assert len(out) == docs.count()
    held = [(r.quality, out[r.doc_id].selected) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    good, bad = [s for q, s in held if q == 1], [s for q, s in held if q == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.15
    again = {r.doc_id: r.selected for r in I.resample(docs, labels)[0].collect()}
    assert again == {k: r.selected for k, r in out.items()}
    kept = I.select_good(docs.withColumn("log_weight", docs.doc_id), labels)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(k for k, r in out.items() if r.selected)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (5, "w " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_grams", "'x' AS u")
    for labels in ([], [(3, 1, 0), (5, 0, 0), (None, 1, 1), (1, None, 0)]):
        df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        got = I.resample(docs, df)[0].collect()
        assert len(got) == len(rows) and I.select_good(docs, df).columns == docs.columns
        if not labels:
            assert all(r.selected for r in got)
    assert I.resample(docs.limit(0), df)[0].count() == 0


def test_weights_and_selection_against_plain_python(spark):
    import math
    from collections import Counter, defaultdict

    import pyarrow as pa

    from tessera.llm.words import chunks
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice(["the", "Cat,", "sat!!", "777", "A#b", "on"], rng.integers(0, 60)))) for i in range(300)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 300, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in I.resample(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))[0].collect()}
    grams = {}  # slots of each document, in a chunk of its own
    for i, text in rows:
        grams[i] = Counter(x for c in chunks(pa.array([text])) for x in I.features(c)[1].tolist())
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in rows}
    good = {i: q for i, q, _ in labels if fold[i]}
    raw, target = Counter(), Counter()
    for i, g in grams.items():
        raw += g
        if good.get(i) and fold[i] < 4:
            target += g
    share = sum(target.values()) / sum(raw.values())
    weight = {i: sum(n * math.log((target[x] + I.SMOOTHING) / (raw[x] * share + I.SMOOTHING)) for x, n in g.items()) for i, g in grams.items()}
    assert all(abs(weight[i] - got[i].log_weight) < 1e-8 and sum(grams[i].values()) == got[i].n_grams for i in weight)
    judged = defaultdict(float)  # cost of each cut: a lost good document counts tenfold
    held = sorted((weight[i], q) for i, q in good.items() if fold[i] == 4)
    cuts = [float("-inf"), *((a + b) / 2 for (a, _), (b, _) in zip(held, held[1:]) if a != b), float("inf")]
    for cut in cuts:
        judged[cut] = sum(I.GOOD_COST if q else 0 for w, q in held if w < cut) + sum(1 - q for w, q in held if w >= cut)
    k = sum(w >= min(judged, key=lambda c: (judged[c], c)) for w in weight.values())
    chosen = sorted(got.values(), key=lambda r: -r.gumbel_key)[:k]
    assert {r.doc_id for r in chosen} == {r.doc_id for r in got.values() if r.selected} and k


@pytest.mark.parametrize("k", [1, 7, 500, 1000])
def test_kth_largest(spark, k):
    values = np.concatenate([np.random.default_rng(1).standard_cauchy(900) ** 3, np.full(100, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert I.kth_largest(df, "v", k, steps=16) == np.sort(values)[-k]


def test_texts_reach_the_workers_in_small_batches(spark):
    """A batch is bounded by its bytes: 10,000 texts of any length took several hundred MB an executor."""
    docs = spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word and more "), 200).alias("text"))
    I.weighed(docs, np.zeros(I.SLOTS), ["doc_id"])

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])
    n = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(n) == 3000 and max(n) <= 1000
