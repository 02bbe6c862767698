"""Pairs of many items in rounds: the shuffle of one round at a time, and no files of the rounds before."""

import time

import pytest

from tessera.operators import similarity as S
from tessera.plans.catalog import QUERIES

ROWS = [(u, i, float(1 + (u * i) % 5)) for u in range(12) for i in range(20) if (u + i) % 3 and (u < 9 or i % 2)]
ODD = [(None, 4, 1.0), (None, 5, 1.0), (5, None, 1.0), (40, 7, 1.0), (41, 3, 0.0), (41, 4, 2.0), (41, 5, None)]


def few_pairs_a_round(monkeypatch):
    for name, n in (("MAX_COMBINED", 1), ("ROUND_PAIRS", 200), ("ROUND_ENTRIES", 1)):
        monkeypatch.setattr(S, name, n, raising=False)


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle")}


def left_over(spark, before):
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    return shuffle_files(spark) - before


@pytest.mark.parametrize("chunk, part_pairs", [(512, 1 << 21), (3, 1 << 21), (512, 7), (3, 7)])
def test_each_pair_is_in_one_round(spark, monkeypatch, chunk, part_pairs):
    monkeypatch.setattr(S, "ROUND_ENTRIES", 1)
    entries = spark.createDataFrame([*ROWS, *ODD, (3, 4, 2.0)], "u long, i long, v double").where("v != 0")
    rounds = S.pair_rounds(entries, chunk, part_pairs, round_pairs=200)
    got = [[(r.i, r.j, r.v_i, r.v_j) for r in x.collect()] for x in rounds]
    plain = S.co_pairs(entries.where("i IS NOT NULL"), 512).collect()
    assert len(rounds) > 2 and sum(1 for x in got if x) > 1
    assert sorted(sum(got, [])) == sorted((r.i, r.j, r.v_i, r.v_j) for r in plain)
    assert sum(len({i for i, *_ in x}) for x in got) == len({r.i for r in plain})


@pytest.mark.parametrize("method", [m for m in S.METHODS if m != "spark-appr"])
def test_rounds_return_what_one_join_returns(spark, monkeypatch, method):
    rated = spark.createDataFrame([*ROWS, *ODD], "user_id long, item int, rating double")
    want = {(r.i, r.j): r.sim for r in S.similarity(rated, method).collect()}
    few_pairs_a_round(monkeypatch)
    out = S.similarity(rated, method)
    got = out.collect()
    assert out.schema.simpleString() == "struct<i:bigint,j:bigint,sim:double>"
    assert len(got) == len(want) and {(r.i, r.j): r.sim for r in got} == pytest.approx(want, nan_ok=True)


@pytest.mark.parametrize("method", ["spark", "cosine"])
def test_rounds_leave_no_shuffle(spark, monkeypatch, method):
    """All pairs were in one shuffle, which stayed with those of all steps before until the last task."""
    few_pairs_a_round(monkeypatch)
    rated = spark.createDataFrame(ROWS, "user_id long, item int, rating double")
    before = shuffle_files(spark)
    out = S.similarity(rated, method)
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert not left_over(spark, before)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB") != "16m"


@pytest.mark.parametrize("query", ["sim_cosine_orders", "sim_spark_quantities"])
def test_queries_leave_no_shuffle_before_the_result(spark, tmp_path, query):
    spark.createDataFrame([(o, o % 7) for o in range(60)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(o, (o * 5 + n * n) % 11, float(1 + (o + n) % 9)) for o in range(60) for n in range(4)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    before = shuffle_files(spark)
    out = QUERIES[query](spark, str(tmp_path))
    assert not left_over(spark, before)
    assert out.count() == (110 if query == "sim_cosine_orders" else 55)
