import math

import pytest
from frames import lines
from pyspark.sql import functions as F

from tessera.operators import common as C
from tessera.operators import evaluate as EV
from tessera.operators import ratings as RT
from tessera.operators import recommend as RC
from tessera.operators import similarity as S

# FIXTURES.md section 9: one (user, item, clicks) row each.
RATINGS = ["a 1 1", "a 2 2", "a 3 3", "b 1 4", "b 2 1", "c 2 5", "c 3 1", "c 4 2", "d 1 3", "d 4 3", "e 4 2"]

EXPECTED = {  # (i, j): cosine, cosine-mod, llr, jaccard, euclidean
    (1, 2): (0.214834, 0.217931, 0.138443, 0.5, 2.0),
    (1, 3): (0.186052, 0.169098, 0.138443, 0.25, 2.449490),
    (1, 4): (0.428086, 0.410279, 2.911032, 0.2, None),
    (2, 3): (0.635085, 0.569010, 2.911032, 0.666667, 2.353394),
    (2, 4): (0.442807, 0.418358, 2.911032, 0.2, 1.765045),
    (3, 4): (0.153393, 0.161752, 0.138443, 0.25, 0.588348),
}


@pytest.fixture(scope="module")
def ratings(spark):
    parsed = RT.parse_ratings(lines(spark, *RATINGS)).select(
        "user", "item", F.col("clicks").cast("double").alias("rating"))
    return RT.with_user_id(parsed).cache()


def _sims(df):
    return {(r["i"], r["j"]): r["sim"] for r in df.collect()}


@pytest.mark.parametrize("k, method", list(enumerate(["cosine", "cosine-mod", "llr", "jaccard", "euclidean"])))
def test_similarities(ratings, k, method):
    got = _sims(S.similarity(ratings, method))
    for (i, j), vals in EXPECTED.items():
        if vals[k] is None:
            assert (i, j) not in got and (j, i) not in got
        else:
            assert got[(i, j)] == pytest.approx(vals[k], abs=1e-6)
            assert got[(j, i)] == pytest.approx(vals[k], abs=1e-6)


def test_spark_cosine_upper_triangle(ratings):
    got = _sims(S.similarity(ratings, "spark"))
    assert all(i < j for i, j in got)
    for (i, j), vals in EXPECTED.items():
        assert got[(i, j)] == pytest.approx(vals[0], abs=1e-6)
    appr = _sims(S.similarity(ratings, "spark-appr"))  # norms far below sqrt(gamma): exact
    assert appr == pytest.approx(got)


def test_unknown_method(ratings):
    with pytest.raises(ValueError):
        S.similarity(ratings, "nope")


def test_blocked_pairs_equal_plain_pairs(ratings):
    small = {(r["i"], r["j"]): (r["dot"], r["co"]) for r in S.pair_stats(ratings, chunk=1).collect()}
    big = {(r["i"], r["j"]): (r["dot"], r["co"]) for r in S.pair_stats(ratings).collect()}
    assert small == big


def _by_user(ratings, recs):
    names = {r["user_id"]: r["user"] for r in ratings.select("user", "user_id").distinct().collect()}
    out = {}
    for r in recs.orderBy("user_id", "rank").collect():
        out.setdefault(names[r["user_id"]], []).append((r["item"], round(r["score"], 6)))
    return out


def test_neighbours_and_recommendations(ratings):
    nb = S.top_neighbours(S.similarity(ratings, "cosine"), 50).cache()
    got = {(r["item"], r["neighbour"]): r["weight"] for r in nb.collect()}
    assert got[(1, 4)] == 1 and got[(1, 2)] == pytest.approx(0.118919, abs=1e-6) and got[(1, 3)] == 0
    users, recs = RC.recommend_score(nb, ratings, 30)
    score = _by_user(ratings, recs)
    assert score["a"] == [(4, 1.0), (4, 0.542469), (4, 0.0)]
    assert score["b"] == [(3, 1.0), (4, 1.0), (4, 0.542469), (3, 0.0)]
    assert score["e"] == [(2, 1.0), (1, 0.949135), (3, 0.0)]
    users, recs = RC.recommend_weighted_sum(nb, ratings, 30)
    ws = _by_user(ratings, recs)
    assert ws["a"] == [(4, 0.175844)]
    assert ws["b"] == [(4, 0.648311), (3, 0.0)]
    assert ws["d"] == [(2, 0.5), (3, 0.0)]
    assert ws["e"] == [(1, 0.5), (2, 0.5), (3, 0.0)]
    assert users.count() == 5


def test_zscore_per_group(spark):
    rows = [("p", 1, 4.0), ("p", 2, 10.0), ("p", 3, 7.0), ("p", 4, 7.0), ("q", 1, -2.0), ("q", 2, 6.0), ("r", 1, 5.0)]
    got = {(r["g"], r["i"]): r["z"] for r in C.zscore(spark.createDataFrame(rows, "g string, i int, v double"), "g", "v").collect()}
    sd = math.sqrt(18 / 4)
    assert math.isnan(got.pop(("r", 1)))
    assert got == pytest.approx({("p", 1): -3 / sd, ("p", 2): 3 / sd, ("p", 3): 0, ("p", 4): 0, ("q", 1): -1, ("q", 2): 1})


def test_repeated_user_item_rows_raise(spark):
    from tessera.plans.recommender import run_recommender
    rated = spark.createDataFrame([(1, 5, 1.0), (1, 6, 2.0), (1, 5, 3.0)], "user_id long, item int, rating double")
    with pytest.raises(ValueError, match="repeated"):
        RT.require_unique(rated, ("user_id", "item"))
    assert RT.require_unique(RT.group_ratings(rated, "user_id"), ("user_id", "item")).count() == 2
    with pytest.raises(ValueError, match="repeated"):
        S.similarity(rated, "cosine")
    with pytest.raises(ValueError, match="repeated"):
        run_recommender(lines(spark, "a 1 1", "a 2 2", "b 1 1", "a 1 1"), "sim")


def test_minmax_all_equal_and_lp(spark):
    df = spark.createDataFrame([("u", 1, 2.0), ("u", 2, 2.0), ("w", 1, 3.0), ("w", 2, 4.0)], "g string, i int, v double")
    got = {(r["g"], r["i"]): r["v"] for r in C.minmax(df, "g", "v").collect()}
    assert got == {("u", 1): 0.5, ("u", 2): 0.5, ("w", 1): 0.0, ("w", 2): 1.0}
    lp = {(r["g"], r["i"]): r["v"] for r in C.lp_scale(df, "g", "v", 2).collect()}
    assert lp[("w", 1)] == pytest.approx(3 / 5)


def test_parse_ratings_lenient(spark):
    got = RT.parse_ratings(lines(spark, "x 1", "x y 2", "x 1 2.5", "", "x 1 2 3", "y +3 -4")).collect()
    assert [(r["user"], r["item"], r["clicks"]) for r in got] == [("x", 1, 2), ("y", 3, -4)]


def test_split_is_disjoint_and_complete(ratings):
    train, test = RT.train_test_split(ratings, 913)
    assert train.count() + test.count() == ratings.count()
    assert train.join(test, ["user", "item"]).count() == 0


def test_evaluation_metrics(spark):
    test = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "user_id int, item int")
    recs = spark.createDataFrame([(1, 1, 10, 0.9), (1, 2, 13, 0.5)], "user_id int, rank int, item int, score double")
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    m = EV.precision_recall(test, users, recs).first()
    assert (m["tp"], m["tp_fn"], m["tp_fp"]) == (1, 3, 2)  # user 2 has an empty list: counts in recall
    assert m["precision"] == 0.5 and m["recall"] == pytest.approx(1 / 3)
    train = spark.createDataFrame([(1, 10), (2, 10), (1, 13)], "user_id int, item int")
    assert EV.coverage(train, recs).first()["coverage"] == 1.0
    assert EV.popularity(train, recs).first()["popularity"] == pytest.approx((math.log(3) + math.log(2)) / 2)
    none = EV.precision_recall(test, users.limit(0), recs).first()
    assert math.isnan(none["precision"])


def test_dimsum_samples_at_scale_and_stays_close(spark):
    import os
    sf = "/root/testdata/sf0.1"
    if not os.path.exists(sf):
        pytest.skip("test data not present")
    from tessera.sources import tables as B
    r = RT.with_user_id(B.event_ratings(spark, sf)).cache()
    mags = S.item_stats(r).select(F.sqrt("ss").alias("m")).agg(F.max("m")).first()[0]
    sg = math.sqrt(10 * math.log(r.agg(F.max("item")).first()[0] + 1) / 0.1)
    assert mags > sg  # some columns really are sampled
    exact = _sims(S.similarity(r, "spark"))
    appr = _sims(S.similarity(r, "spark-appr"))
    big = [k for k, v in exact.items() if v >= 0.1]
    err = sum(abs(appr.get(k, 0.0) - exact[k]) / exact[k] for k in big) / len(big)
    assert err < 0.2
    assert appr != pytest.approx(exact)
    again = _sims(S.similarity(r, "spark-appr"))  # repeatable: same sampled pairs, same values
    assert set(again) == set(appr) and again == pytest.approx(appr, rel=1e-9)


def test_zero_ratings_and_single_item_users(spark):
    # user 0 owns item 1 with a zero rating and nothing else; user 3 rates one item
    df = spark.createDataFrame([(0, 1, 0.0), (1, 1, 2.0), (1, 2, 1.0), (2, 1, 1.0), (2, 2, 3.0), (3, 2, 5.0)],
                               "user_id int, item int, rating double")
    st = {r["item"]: (r["ss"], r["cnt"]) for r in S.item_stats(df).collect()}
    assert st == {1: (5.0, 2), 2: (35.0, 3)}  # the zero is not stored
    pairs = {(r["i"], r["j"]): (r["dot"], r["co"]) for r in S.pair_stats(df).collect()}
    assert pairs == {(1, 2): (5.0, 2)}
    llr = _sims(S.similarity(df, "llr"))
    k11, k12, k21, k22 = 2, 3 - 2, 2 - 2, 4 - 2 - 3 + 2  # n = 4 users, the zero-only one included

    def xlx(x):
        return 0.0 if x == 0 else x * math.log(x)

    def ent(*xs):
        return xlx(sum(xs)) - sum(xlx(x) for x in xs)
    row, col, mat = ent(k11 + k12, k21 + k22), ent(k11 + k21, k12 + k22), ent(k11, k12, k21, k22)
    assert llr[(1, 2)] == pytest.approx(max(0.0, 2 * (row + col - mat)))
    # single-item user 3 and equal-rating users give no euclidean entries of their own
    eu = _sims(S.similarity(df, "euclidean"))
    assert set(eu) <= {(1, 2), (2, 1)}


def test_zero_rated_item_counts_as_owned(spark):
    train = spark.createDataFrame([(0, 1, 0.0), (0, 2, 1.0)], "user_id int, item int, rating double")
    nb = spark.createDataFrame([(2, 1, 1.0, 1), (2, 3, 0.5, 2)], "item int, neighbour int, weight double, rank int")
    users, recs = RC.recommend_score(nb, train, 10)
    # item 1 has no neighbour list, so it is not recognised as owned and can come back
    assert [(r["item"], r["score"]) for r in recs.orderBy("rank").collect()] == [(1, 1.0), (3, 0.5)]
    nb2 = nb.unionByName(spark.createDataFrame([(1, 2, 0.7, 1)], "item int, neighbour int, weight double, rank int"))
    users, recs = RC.recommend_score(nb2, train, 10)
    assert [(r["item"], r["score"]) for r in recs.collect()] == [(3, 0.5)]  # zero-rated item 1 is owned


def test_als_directions(spark):
    rows = [(u, i, float(1 + (u * 7 + i * 3) % 5)) for u in range(6) for i in range(8) if (u + i) % 3 != 0]
    train = spark.createDataFrame(rows, "user_id int, item int, rating double")
    users, recs = RC.recommend_als(train, 3, "user-product")
    got = recs.collect()
    assert {r["user_id"] for r in got} == set(range(6))
    assert all(r["rank"] in (1, 2, 3) for r in got)
    owned = {(u, i) for u, i, _ in rows}
    assert any((r["user_id"], r["item"]) in owned for r in got)  # owned items are not removed
    users2, recs2 = RC.recommend_als(train, 3, "product-user")
    assert recs2.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 3
    with pytest.raises(ValueError):
        RC.recommend_als(train, 3, "sideways")


@pytest.fixture(scope="module")
def heavy(spark):
    """Forty items that nearly all of 3,000 users rate: every column is far over the bound."""
    u, i = F.col("id") % 3000, F.floor(F.col("id") / 3000)
    value = (1 + F.pmod(F.xxhash64(u, i), F.lit(3)) + F.when(i % 2 == u % 2, 3).otherwise(0)).cast("double")
    return spark.range(120_000).select(u.alias("user_id"), i.cast("int").alias("item"), value.alias("rating")).where("(user_id + item) % 11 != 0").cache()


def test_dimsum_thins_entries_before_they_are_paired(heavy):
    e = S._entries(heavy, "user_id", "item", "rating")
    bound = S.dimsum_bound(40, 0.1)
    kept = S.sampled_entries(e, bound).cache()
    norms = {r["item"]: math.sqrt(r["ss"]) for r in S.item_stats(heavy).collect()}
    expected = sum(min(1, bound / norms[r["i"]]) for r in e.collect())
    n, low, high = kept.count(), kept.where("low").count(), kept.where("high").count()
    assert min(norms.values()) > 5 * bound and n < 0.3 * e.count()
    assert low == pytest.approx(expected, rel=0.05) and high == pytest.approx(expected, rel=0.05)
    assert kept.where("low AND high").count() < 0.2 * low  # the draws are independent
    pairs = S.sided_pairs(kept).count()  # what the join makes shrinks by the product of both chances
    assert pairs == pytest.approx(S.co_pairs(e).count() * (expected / e.count()) ** 2, rel=0.15)
    assert sorted(map(tuple, S.sided_pairs(kept, chunk=2).collect())) == sorted(map(tuple, S.sided_pairs(kept).collect()))


def test_dimsum_join_reads_only_kept_entries(spark, heavy):
    kept = S.sampled_entries(S._entries(heavy, "user_id", "item", "rating"), S.dimsum_bound(40, 0.1))
    chunks = S.chunked(kept)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = S.sided_pairs(chunks)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [ln for ln in plan.splitlines() if "PushedFilters" in ln]
    assert any("EqualTo(low,true)" in ln for ln in scans) and any("EqualTo(high,true)" in ln for ln in scans)
    assert any("SortMergeJoin" in ln and "_a" in ln and "_b" in ln for ln in plan.splitlines())


def test_dimsum_estimates_are_unbiased(heavy):
    exact = _sims(S.column_similarities(heavy))
    runs = [_sims(S.column_similarities(heavy, 0.1, seed=seed)) for seed in range(6)]
    mean = {k: sum(r.get(k, 0.0) for r in runs) / len(runs) for k in exact}
    errors = [mean[k] - exact[k] for k in exact]
    assert abs(sum(errors) / len(errors)) < 0.01 and sum(map(abs, errors)) / len(errors) < 0.1
    assert runs[0] != runs[1] and _sims(S.column_similarities(heavy, 0.1, seed=0)) == pytest.approx(runs[0])


def test_dimsum_edges(spark):
    one = spark.createDataFrame([(1, 0, 3.0), (2, 0, 1.0)], "user_id int, item int, rating double")
    assert S.similarity(one, "spark-appr").collect() == [] and S.similarity(one.limit(0), "spark-appr").collect() == []
    zero = spark.createDataFrame([(1, 0, 0.0), (1, 1, 2.0), (1, 2, 5.0)], "user_id int, item int, rating double")
    assert _sims(S.similarity(zero, "spark-appr")) == pytest.approx({(1, 2): 1.0})


def test_column_similarities_matrix_fixture(spark):
    entries = [(0, 0, 1.0), (0, 1, 2.0), (0, 2, 3.0), (1, 1, 1.0), (1, 2, 2.0), (5, 0, 4.0)]
    df = spark.createDataFrame(entries, "user_id int, item int, rating double")
    got = _sims(S.similarity(df, "spark"))
    assert got == pytest.approx({(0, 1): 0.216930, (0, 2): 0.201802, (1, 2): 0.992278}, abs=1e-6)
    dup = spark.createDataFrame(entries + [(0, 0, 2.0)], "user_id int, item int, rating double")
    assert [(r["user_id"], r["item"]) for r in RT.check_unique(dup, ("user_id", "item")).collect()] == [(0, 0)]
    summed = RT.group_ratings(dup, "user_id", "item", "rating")
    assert summed.where("user_id = 0 AND item = 0").first()["rating"] == 3.0
