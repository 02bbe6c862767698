"""Top-n by inner product, and the check of the ALS factors."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import recommend as RC
from tessera.operators.inner_product import top_inner


def frame(spark, m):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id long, vec array<double>")


def brute(q, c, n):
    out = {}
    for i, v in enumerate(q):
        scores = c @ v
        order = sorted(range(len(c)), key=lambda j: (-round(scores[j], 9), j))[:n]
        out[i] = [(j, round(float(scores[j]), 6)) for j in order]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.id, r.rank)):
        out.setdefault(r.id, []).append((r.item, round(r.score, 6)))
        assert r.rank == len(out[r.id])
    return out


@pytest.mark.parametrize("block", [1, 7, 64, 1000])
def test_equals_brute_force(spark, block):
    rng = np.random.default_rng(block)
    q, c = rng.normal(size=(50, 6)), rng.normal(size=(130 if block > 1 else 20, 6)) * rng.lognormal(0, 1, (130 if block > 1 else 20, 1))
    c[3] = c[11]  # ties
    q[7] = 0
    n = 9
    assert got(top_inner(frame(spark, q).repartition(3), frame(spark, c), n, block)) == brute(q, c, n)


def test_queries_close_early(spark):
    rng = np.random.default_rng(0)
    c = rng.normal(size=(600, 5)) * (0.97 ** np.arange(600))[:, None]
    q = rng.normal(size=(80, 5))
    trace = []
    assert got(top_inner(frame(spark, q), frame(spark, c), 5, 40, trace)) == brute(q, c, 5)
    assert len(trace) < 8 and trace == sorted(trace, reverse=True) and trace[-1] == 0  # of 15 blocks


def test_edges(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id long, vec array<double>")
    assert got(top_inner(one, one, 5)) == {1: [(1, 5.0)]}
    assert top_inner(one.limit(0), one, 5).collect() == [] and top_inner(one, one.limit(0), 5).collect() == []


def test_als_factors_solve_their_equations(spark):
    rng = np.random.default_rng(3)
    rows = [(u, i, float(rng.integers(1, 6))) for u in range(40) for i in range(25) if rng.random() < 0.4] + [(0, 99, 0.0), (1, 99, -2.0)]
    train = spark.createDataFrame(rows, "user_id int, item int, rating double")
    model = RC.fit_als(train)
    x = {r.id: np.array(r.features, float) for r in model.userFactors.collect()}
    y = {r.id: np.array(r.features, float) for r in model.itemFactors.collect()}
    gram = sum(np.outer(v, v) for v in y.values())
    res = {r.user_id: r.residual for r in RC.als_residuals(model, train).collect()}
    for u, v in x.items():
        a, b, n = gram.copy(), np.zeros(10), 0
        for _, i, r in (row for row in rows if row[0] == u):
            a += abs(r) * np.outer(y[i], y[i])
            if r > 0:
                b, n = b + (1 + r) * y[i], n + 1
        assert res[u] == pytest.approx(np.linalg.norm((a + 0.01 * n * np.eye(10)) @ v - b) / np.linalg.norm(b), rel=1e-3, abs=1e-7)
        assert res[u] < 1e-4
    wrong = train.withColumn("rating", F.col("rating") + 1)  # other ratings than those of the fit
    assert RC.als_residuals(model, wrong).agg(F.min("residual")).first()[0] > 1e-3
    users, recs = RC.recommend_als(train, 4, "user-product", model=model)
    ids = sorted(y)
    want = {u: [(ids[j], s) for j, s in best] for u, best in brute(np.array([x[u] for u in range(40)]), np.array([y[i] for i in ids]), 4).items()}
    assert got(recs.withColumnRenamed("user_id", "id")) == want and users.count() == 40
