import pytest

from tessera.operators import evaluate as EV
from tessera.operators import graph as G
from tessera.session import scratch_path
from tessera.sinks.files import read_tsv, write_tsv


def test_split_ranks_orders_each_side(spark):
    ranks = spark.createDataFrame([(1, 0.2), (11, 0.5), (2, 0.4), (12, 0.1), (13, 0.5)], "id long, rank double")
    items, users = G.split_ranks(ranks, ranks["id"] >= 10)
    assert [r["id"] for r in items.collect()] == [11, 13, 12]
    assert [r["id"] for r in users.collect()] == [2, 1]


def test_matrix_mae_counts_missing_as_zero(spark):
    a = spark.createDataFrame([(0, 1, 0.5), (0, 2, 0.25), (1, 2, 1.0)], "i long, j long, sim double")
    b = spark.createDataFrame([(0, 1, 0.25), (1, 2, 1.0), (5, 5, 9.0)], "i long, j long, sim double")
    row = EV.matrix_mae(a, b).first()
    assert row["n_entries"] == 3 and row["mae"] == pytest.approx((0.25 + 0.25 + 0.0) / 3)


def test_tsv_round_trip_replaces_folder(spark):
    path = scratch_path(spark, "tsv-test")
    df = spark.createDataFrame([(1, 2, 0.5), (3, 4, 1.0)], "item long, neighbour long, weight double")
    write_tsv(df, path)
    write_tsv(df.limit(1), path)  # overwrite, not append
    back = read_tsv(spark, path, "item long, neighbour long, weight double").collect()
    assert len(back) == 1
    raw = spark.read.text(path).first()["value"]
    assert raw.count("\t") == 2 and not raw.startswith("item")


def test_per_batch_counts_with_offsets(spark):
    from pyspark.sql import functions as F

    from tessera.streaming.batches import batch_counts_with_offsets
    out = scratch_path(spark, "kc-test")
    fn = batch_counts_with_offsets(out)
    rows = [("t", 0, o, None, "a b a") for o in range(5, 8)] + [("t", 1, 0, None, "c")]
    fn(spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string"), 7)
    ranges = spark.read.parquet(f"{out}/ranges")
    got = sorted((r["partition"], r["from_offset"], r["until_offset"], r["batch_words"], r["batch_id"])
                 for r in ranges.collect())
    assert got == [(0, 5, 8, 10, 7), (1, 0, 1, 10, 7)]
    words = {r["word"]: r["n"] for r in spark.read.parquet(f"{out}/words").collect()}
    assert words == {"a": 6, "b": 3, "c": 1}
    assert ranges.where(F.col("batch_time").isNotNull()).count() == 2
