import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import nearest as N


def brute(rows, step=20, k=20, kind=np.float32):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = min(ok.get(i, v), v)
    ids = np.array(sorted(ok))
    if not len(ids):
        return {}
    x = np.array([ok[i] for i in ids], kind).astype(float)
    out = {}
    for q in ids[ids % step == 0]:
        s = (x * x[np.searchsorted(ids, q)]).sum(1)
        out[int(q)] = sorted((-a, int(i)) for a, i in zip(s, ids) if i != q)[:k]
    return out


def got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, {})[r.rank] = (-r.score, r.vec_id)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [v[i] for i in sorted(v)] for q, v in out.items()}


def recall(a, want):
    assert set(a) == {q for q, v in want.items() if v}
    for q, v in a.items():
        assert v == sorted(v) and len(v) == len(want[q])
    # by score, so that rounding between equal scores doesn't count
    return np.mean([sum(s <= want[q][-1][0] + 1e-12 for s, _ in a[q]) / len(want[q]) for q in a])


@pytest.mark.parametrize("sf,chunk,block", [("0.01", 4096, 2048), ("0.1", 100, 40)])
def test_recall(spark, monkeypatch, sf, chunk, block):
    monkeypatch.setattr(N, "CHUNK", chunk)
    monkeypatch.setattr(N, "BLOCK", block)
    e = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    want = brute(rows)
    out = got(N.neighbours(e, F.col("vec_id") % 20 == 0))
    assert recall(out, want) >= 0.9
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows if v}
    for q, v in out.items():
        assert all(abs((vectors[q] * vectors[i]).sum() + s) < 1e-12 for s, i in v)


@pytest.mark.parametrize("kind,scale", [("double", 1e-7), ("double", 1e140), ("int", 100)])
def test_other_numbers(spark, kind, scale):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((600, 16)) * scale
    rows = [(i, v) for i, v in enumerate(x.astype(int).tolist() if kind == "int" else x.tolist())]
    want = brute(rows, kind=float)
    out = got(N.neighbours(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>"), F.col("vec_id") % 20 == 0))
    assert set(out) == set(want)
    assert np.mean([len({i for _, i in v} & {i for _, i in want[q]}) / 20 for q, v in out.items()]) >= 0.9
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, v in out.items():
        assert all(abs((vectors[q] * vectors[i]).sum() / -s - 1) < 1e-9 for s, i in v)


def test_edges(spark):
    rng = np.random.default_rng(4)
    same = [1.0, 2.0, -1.0]
    rows = [(i, same) for i in range(70)] + [(100 + i, rng.standard_normal(3).astype(np.float32).tolist()) for i in range(30)]
    rows += [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 2.0]), (260, [1.0, float("nan"), 2.0]), (280, [float("inf"), 0.0, 1.0]), (300, [1.0]), (None, same), (20, same), (320, []), (340, [50.0, -3.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS rank", "'x' AS page", "2 AS rep")
    want = brute([r for r in rows if r[1] is None or len(r[1]) == 3])
    out = got(N.neighbours(df, F.col("vec_id") % 20 == 0))
    assert recall(out, want) >= 0.9
    assert [i for _, i in out[20]][:2] == [i for _, i in want[20]][:2]
    few = df.where("vec_id IN (0, 20, 105)")
    assert {q: [i for _, i in v] for q, v in got(N.neighbours(few, F.col("vec_id") % 20 == 0)).items()} == {0: [20, 105], 20: [0, 105]}
    assert N.neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def lengths(kind, rng, n):
    out = np.ones(n)
    if kind == "one long":
        out[77] = 5.0
    elif kind == "lognormal":
        out = np.exp(0.5 * rng.standard_normal(n))
    else:
        out = rng.choice([1e-3, 1.0, 1.05, 30.0], n, p=[0.3, 0.3, 0.38, 0.02])
    return out[:, None]


@pytest.mark.parametrize("kind", ["one long", "lognormal", "steps"])
def test_recall_of_unequal_norms(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 48))
    x = (x / np.sqrt((x * x).sum(1, keepdims=True)) * lengths(kind, rng, len(x))).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    want = brute(rows)
    out = got(N.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0))
    assert recall(out, want) >= 0.9
    assert min(sum(s <= want[q][-1][0] + 1e-12 for s, _ in v) for q, v in out.items()) >= 8


def test_ties_at_the_cut():
    x = np.array([[1.0, float(i)] for i in range(60)])
    ids = [[100 - i] for i in range(60)]
    found = N.best(np.array([7]), np.array([[1.0, 0.0]]), np.ones((1, 60), bool), ids, x, 5)
    assert found == ([7] * 5, [41, 42, 43, 44, 45], [1.0] * 5)
