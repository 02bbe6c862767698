"""Plan properties the scale design relies on (checked on the physical plan)."""

import os

import pytest
from frames import lines
from pyspark.sql import functions as F

from tessera.operators import common as C
from tessera.operators import similarity as S
from tessera.operators.text import word_count

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").cast("double").alias("s"))
    plan = _plan(C.top_k(df, "g", C.score_order("s"), 3))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


def test_word_count_aggregates_map_side(spark):
    plan = _plan(word_count(lines(spark, "a b a", "c")))
    assert "partial_count" in plan


def test_pair_join_is_keyed_by_user_and_chunks(spark):
    df = spark.createDataFrame([(u, i, 1.0) for u in range(5) for i in range(6)], "user_id int, item int, rating double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(S.pair_stats(df, chunk=2))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = [ln for ln in plan.splitlines() if "SortMergeJoin" in ln][0]
    assert "_a" in join and "_b" in join and "u#" in join  # (user, chunk a, chunk b), never user alone


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_scans_are_pruned(spark):
    from tessera.sources import tables as B
    plan = _plan(word_count(B.doc_lines(spark, SF)))
    assert "ReadSchema: struct<text:string>" in plan
    ev = B.table(spark, SF, "events").where(F.col("event_type") == "error").groupBy("user_id").count()
    plan = _plan(ev)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan
