"""The manifest sink: results and positions move together, whatever fails in between."""
import pytest
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.streaming import manifest_sink as M


def records(spark, part, lo, texts):
    rows = [("t", part, lo + i, None, x) for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string")


def error(minute):
    return f"2020-05-06 07:{minute:02d}:10 ERROR x"


def counts(table):
    return {r.log_time.minute: r.log_count for r in table.read().collect()}


@pytest.fixture
def table(spark):
    return M.errors_table(spark, scratch_path(spark, "manifest-test"))


def test_positions():
    plan = M.plan_positions
    assert plan([("t", 0, 0, 5)], {}) == {("t", 0): 5}
    assert plan([("t", 0, 5, 9), ("t", 1, 0, 2)], {("t", 0): 5}) == {("t", 0): 9, ("t", 1): 2}
    assert plan([("t", 0, 0, 5)], {("t", 0): 5}) is None and plan([("t", 0, 1, 3)], {("t", 0): 5}) is None
    assert plan([], {("t", 0): 5}) is None
    assert plan([("t", 0, 7, 9)], {("t", 0): 5}, strict=False) == {("t", 0): 9}
    for ranges, strict in (([("t", 0, 3, 8)], False), ([("t", 0, 7, 9)], True), ([("t", 0, 0, 5), ("t", 1, 0, 2)], True)):
        with pytest.raises(RuntimeError):
            plan(ranges, {("t", 0): 5}, strict)


def test_batches_and_replays(spark, table):
    first = records(spark, 0, 0, [error(1), error(1), "junk", error(2)])
    assert M.commit_errors(table, first) and counts(table) == {1: 2, 2: 1}
    assert not M.commit_errors(table, first) and table.versions.newest() == 1  # a replay changes nothing
    both = records(spark, 0, 4, [error(2)]).unionByName(records(spark, 1, 0, [error(3)]))
    assert M.commit_errors(table, both) and counts(table) == {1: 2, 2: 2, 3: 1}
    assert table.positions() == {("t", 0): 5, ("t", 1): 1}
    with pytest.raises(RuntimeError, match="read up to 5"):
        M.commit_errors(table, records(spark, 0, 6, [error(4)]))
    assert M.commit_errors(table, records(spark, 0, 5, ["no error here"])) and counts(table) == {1: 2, 2: 2, 3: 1}
    assert not M.commit_errors(table, first.limit(0))


def test_crash_between_data_and_manifest(spark, table, monkeypatch):
    M.commit_errors(table, records(spark, 0, 0, [error(1)]))
    batch = records(spark, 0, 1, [error(1), error(5)])

    def crash(*_):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(M.Manifests, "create", crash)
        with pytest.raises(OSError):
            M.commit_errors(table, batch)
    assert counts(table) == {1: 1} and table.positions() == {("t", 0): 1}  # the data lie there, but don't count
    again = M.errors_table(spark, table.path)  # a new process
    assert M.commit_errors(again, batch) and counts(again) == {1: 2, 5: 1}
    assert not M.commit_errors(again, batch) and counts(again) == {1: 2, 5: 1}


def test_crash_after_the_manifest(spark, table, monkeypatch):
    batch = records(spark, 0, 0, [error(1)])
    create = M.Manifests.create

    def late(self, *a):
        create(self, *a)
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(M.Manifests, "create", late)
        with pytest.raises(OSError):
            M.commit_errors(table, batch)
    assert not M.commit_errors(table, batch) and counts(table) == {1: 1}


def test_two_writers(spark, table, monkeypatch):
    mine, other = records(spark, 0, 0, [error(1)]), records(spark, 1, 0, [error(2)])
    rival = M.errors_table(spark, table.path)
    create, calls = M.Manifests.create, []

    def raced(self, version, state):
        calls.append(version)
        if len(calls) == 1:  # the rival takes the version that was read
            assert create(rival.versions, version, {"data": [rival._write(M.errors_per_minute(M.parse_log_lines(other)))], "positions": [["t", 1, 1]]})
        return create(self, version, state)
    with monkeypatch.context() as m:
        m.setattr(M.Manifests, "create", raced)
        assert M.commit_errors(table, mine)
    assert calls == [1, 2] and counts(table) == {1: 1, 2: 1} and table.positions() == {("t", 0): 1, ("t", 1): 1}
    assert not create(table.versions, 2, {"data": [], "positions": []})  # a version is never replaced
    assert counts(table) == {1: 1, 2: 1}


def test_merge(spark, table, monkeypatch):
    monkeypatch.setattr(M, "MERGE_AT", 3)
    for i in range(6):
        assert M.commit_errors(table, records(spark, 0, i, [error(i % 2)]))
        assert len(table.state()["data"]) <= 3
    assert counts(table) == {0: 3, 1: 3}


def test_stream_and_replay_with_a_new_checkpoint(spark, table):
    path = scratch_path(spark, "log")
    rows = spark.range(200).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit(None).cast("string").alias("key"),
                                   F.format_string("2020-05-06 07:%02d:10 %s x", F.col("id") % 7, F.when(F.col("id") % 2 == 0, "ERROR").otherwise("INFO")).alias("value"))
    rows.repartitionByRange(8, "offset").write.parquet(path)
    from tessera.streaming.sources import RECORD_SCHEMA, stamp_files, starting_offsets
    assert stamp_files(spark, path) == 8
    stream = spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", 3).parquet(path)
    want = {m: sum(i % 7 == m and i % 2 == 0 for i in range(200)) for m in range(7)}
    for _ in range(2):  # the second run knows nothing but the manifest
        M.run_errors(stream, table, scratch_path(spark, "log-ckpt"), {"availableNow": True}).awaitTermination()
        assert counts(table) == want and table.versions.newest() == 3
    assert starting_offsets(M.position_frame(table), "t") == ('{"t": [0]}', '{"t": {"0": 200}}')
