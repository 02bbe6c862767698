"""The pruned neighbour search against the full one."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import pruned as P
from tessera.operators import similarity as S


def frame(spark, m):
    rows = [(int(u), int(i), float(m[u, i])) for u, i in zip(*np.nonzero(m))]
    return spark.createDataFrame(rows, "user_id int, item int, rating double")


def lists(df):
    return {(r.item, r.rank): (r.neighbour, round(r.weight, 6)) for r in df.collect()}


def full_search(df, k):
    """Rounded as the pruned search rounds: equal cosines may differ in the last bit."""
    return lists(S.top_neighbours(S.similarity(df, "cosine").withColumn("sim", F.round("sim", 12)), k))


def topics(seed=1, users=400, items=90):
    """Items in topics of ten; most users stay in one, a few rate everything a little."""
    rng = np.random.default_rng(seed)
    m = np.zeros((users, items))
    for u in range(users):
        if u % 25 == 0:
            m[u] = rng.integers(0, 2, items)
        else:
            own = 10 * (u % (items // 10)) + np.arange(10)
            m[u, own] = rng.integers(0, 9, 10)
    return m


@pytest.mark.parametrize("k", [1, 3, 9, 50])
def test_equal_to_the_full_search(spark, k):
    df = frame(spark, topics()).cache()
    want = full_search(df, k)
    assert lists(P.top_neighbours_pruned(df, k)) == want
    assert lists(P.top_neighbours_pruned(df, k, classes=7, light=0.4, chunk=5)) == want


def test_fewer_pairs_are_joined(spark):
    df = frame(spark, topics(users=900, items=300)).cache()
    full = S.co_pairs(S._entries(df, "user_id", "item", "rating")).count()
    trace = {}
    got = P.top_neighbours_pruned(df, 5, light=0.2, trace=trace)
    assert lists(got) == full_search(df, 5)
    n = {name: seen.get["pairs"] for name, seen in trace.items()}
    assert len(n) == 4 and sum(n.values()) < 0.3 * full, (n, full)


@pytest.mark.parametrize("seed", range(3))
def test_random_ratings_ties_and_single_items(spark, seed):
    rng = np.random.default_rng(seed)
    m = rng.integers(0, 3, (60, 25)) * (rng.random((60, 25)) < 0.2)  # many equal cosines
    m[:, 3] = m[:, 4]
    m[:, 7] = 0
    m[5, 7] = 1
    df = frame(spark, m)
    for k in (2, 6):
        assert lists(P.top_neighbours_pruned(df, k, light=0.3)) == full_search(df, k)


def test_edges(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 2, -1.0)], "user_id int, item int, rating double")
    with pytest.raises(ValueError, match="negative"):
        P.pruned_similarity(df)
    assert P.top_neighbours_pruned(df.limit(0)).collect() == []
    one = df.where("item = 1")
    assert P.top_neighbours_pruned(one).collect() == []
    twice = one.unionByName(one.select("user_id", "item", F.lit(5.0).alias("rating")))
    with pytest.raises(ValueError, match="repeated"):
        P.pruned_similarity(twice)
