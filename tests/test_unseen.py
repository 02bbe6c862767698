"""Candidates that a user doesn't own: all of them, without a shuffle of the candidates."""

from collections import Counter
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from tessera.operators import recommend as RC

TRAIN = [(1, 1, 1.0), (1, 2, 2.0), (1, 3, 3.0), (2, 1, 4.0), (2, 1, 5.0), (2, None, 1.0), (3, 4, 2.0), (3, 9, 1.0),
         (None, 1, 1.0), (None, 2, 1.0), (4, 3, 1.0)]
# 7 is a neighbour without a list of its own, so owning it doesn't count
NB = [(1, 2, 1.0), (1, 3, 0.5), (1, 7, 0.0), (2, 1, 1.0), (2, 4, 0.25), (3, 4, 1.0), (4, 1, 0.5), (4, 9, 0.75)]


@pytest.fixture(scope="module")
def tables(spark):
    train = spark.createDataFrame([*TRAIN, (1, 7, 1.0)], "user_id long, item int, rating double")
    return spark.createDataFrame(NB, "item long, neighbour long, weight double"), train


@pytest.mark.parametrize("max_owned", [1, 2, 512])
def test_unseen_is_drop_seen_of_all_candidates(tables, max_owned):
    nb, train = tables
    cols = ["user_id", "item", "neighbour", "weight", "rating"]
    got = reduce(DataFrame.unionByName, RC.unseen(nb, train, extra=("rating",), max_owned=max_owned))
    plain = RC.drop_seen(RC.candidates(nb, train, extra=("rating",)), RC.owned(nb, train))
    rows = Counter(tuple(r) for r in plain.select(*cols).collect())
    assert Counter(tuple(r) for r in got.select(*cols).collect()) == rows
    assert rows[(1, 1, 7, 0.0, 1.0)] == 1 and rows[(None, 1, 2, 1.0, 1.0)] == 1


@pytest.mark.parametrize("method", ["score", "weighted-sum"])
def test_candidates_are_not_shuffled(spark, tables, method):
    nb, train = tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, recs = RC.recommend(method, nb, train.where("user_id IS NOT NULL"))
        plan = recs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" in plan
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "neighbour" in x]
