import numpy as np
import pyarrow as pa
import pytest
from frames import lines
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.functions.javarandom import start_weights
from tessera.operators import fit as FT

POINTS = ["0.0 0.0 0.0", "0.1 0.1 0.1", "0.2 0.2 0.2", "9.0 9.0 9.0", "9.1 9.1 9.1", "9.2 9.2 9.2"]


def test_kmeans_two_clusters(spark):
    pts = FT.parse_vectors(lines(spark, *POINTS)).withColumn("id", F.monotonically_increasing_id())
    centers, assigned = FT.kmeans(pts, 2, 0.01)
    got = sorted(round(c[0], 6) for c in centers)
    assert got == pytest.approx([0.1, 9.1])
    assert assigned.select("cluster").distinct().count() == 2


def test_kmeans_given_centers_and_empty_cluster(spark):
    pts = FT.parse_vectors(lines(spark, *POINTS)).withColumn("id", F.monotonically_increasing_id())
    centers, _ = FT.kmeans(pts, 3, 0.0, centers=[[0.0] * 3, [9.0] * 3, [100.0] * 3], max_iterations=5)
    assert centers[2] == [100.0] * 3  # empty cluster keeps its center
    assert centers[0] == pytest.approx([0.1] * 3) and centers[1] == pytest.approx([9.1] * 3)


def test_closest_ties_to_lowest_index(spark):
    df = spark.createDataFrame([([1.0],)], "x array<double>")
    got = FT.assign(df, [[0.0], [2.0]]).first()
    assert got["cluster"] == 0 and got["dist"] == 1.0


def test_start_weights_match_generator():
    assert start_weights(3) == [0.4551273600657362, 0.36644694351969087, -0.38256108933468047]


def test_logistic_one_step_by_hand(spark):
    pts = FT.parse_points(lines(spark, "1 1.0 0.0 99", "-1 0.0 2.0"), 2)
    w = {r["pos"]: r["weight"] for r in FT.logistic_gd(pts, 2, 1, w0=[0.0, 0.0]).collect()}
    # at w = 0 each point contributes x * (0.5 - 1) * y
    assert w == pytest.approx({0: 0.5, 1: -1.0})


def test_sample_k_is_repeatable(spark):
    df = spark.range(100).select(F.col("id"))
    a = [r["id"] for r in FT.sample_k(df, 5).collect()]
    b = [r["id"] for r in FT.sample_k(df.repartition(7), 5).collect()]
    assert a == b and len(set(a)) == 5


def test_logistic_zero_iterations_returns_start_weights(spark):
    pts = FT.parse_points(lines(spark, "1 1.0 0.0"), 2)
    got = sorted(tuple(r) for r in FT.logistic_gd(pts, 2, 0, w0=[0.25, -0.5]).collect())
    assert got == [(0, 0.25), (1, -0.5)]


def test_rows_of_nulls_slices_and_lengths():
    col = pa.array([[1.0, 2.0], None, [3.0, None], [4.0, 5.0], [6.0, 7.0]])
    m, which = V.rows_of(col)
    assert m.tolist() == [[1, 2], [4, 5], [6, 7]] and which.tolist() == [0, 3, 4]
    m, which = V.rows_of(col.slice(1, 3))
    assert m.tolist() == [[4, 5]] and which.tolist() == [2]
    assert V.rows_of(pa.array([], pa.list_(pa.float32())), 3)[0].shape == (0, 3)
    with pytest.raises(ValueError, match="vectors of"):
        V.rows_of(pa.array([[1.0], [1.0, 2.0]]))
    with pytest.raises(ValueError, match="vectors of"):
        V.rows_of(pa.array([[1.0]]), 2)


def test_vector_columns(spark):
    rows = [([1.0, 2.0], [3.0, 5.0]), (None, [1.0, 1.0]), ([0.5, 0.5], None), ([1.0, None], [1.0, 2.0]), ([-1.0, 4.0], [-1.0, 4.0])]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    got = df.select(V.dot(F.col("a"), F.col("b")), V.squared_distance(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(13.0, 13.0), (None, None), (None, None), (None, None), (17.0, 0.0)]
    near = df.select(V.closest(F.col("a"), [[0.0, 2.0], [2.0, 2.0], [1.0, 3.0]]).alias("c")).select("c.idx", "c.d").collect()
    assert [tuple(r) for r in near] == [(0, 1.0), (None, None), (0, 2.5), (None, None), (0, 5.0)]


def _lloyd(x, centers, steps):
    for _ in range(steps):
        idx = ((x[:, None] - centers[None]) ** 2).sum(2).argmin(1)
        centers = np.array([x[idx == c].mean(0) if (idx == c).any() else centers[c] for c in range(len(centers))])
    return centers, ((x[:, None] - centers[None]) ** 2).sum(2).argmin(1)


def test_kmeans_and_gradient_against_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 7)) + rng.integers(0, 4, (3000, 1)) * 3
    y = np.where(rng.random(3000) < 0.5, 1.0, -1.0)
    rows = [(i, x[i].tolist(), float(y[i])) for i in range(3000)] + [(5000, None, 1.0), (5001, [1.0, None] * 3 + [2.0], -1.0), (5002, [0.0] * 7, None)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y double").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")  # many batches a task
    try:
        centers, assigned = FT.kmeans(df.where("id < 5002"), 4, 0.0, centers=x[:4].tolist(), max_iterations=6)
        want, idx = _lloyd(x, x[:4].copy(), 6)
        assert np.allclose(centers, want)
        got = {r.id: r.cluster for r in assigned.collect()}
        assert [got[i] for i in range(3000)] == idx.tolist() and got[5000] is None and got[5001] is None
        w = rng.normal(size=7)
        grad = {r.pos: r.g for r in FT.logistic_gradient(df, w.tolist()).collect()}
        assert np.allclose([grad[i] for i in range(7)], ((1 / (1 + np.exp(-y * (x @ w))) - 1) * y) @ x)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    far = spark.createDataFrame([([1e6], -1.0)], "x array<double>, y double")
    assert FT.logistic_gradient(far, [1.0]).first()["g"] == pytest.approx(1e6)
    assert FT.logistic_gradient(far.limit(0), [1.0]).collect()[0:1] in ([], [(0, 0.0)])


def test_plan_does_not_grow_with_the_model(spark):
    df = spark.createDataFrame([(0, [0.0] * 64)], "id long, x array<double>")

    def size(k):
        return len(FT.assign(df, [[float(c)] * 64 for c in range(k)])._jdf.queryExecution().executedPlan().toString())
    assert size(200) < 1.2 * size(2)
