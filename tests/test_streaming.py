import pytest
from pyspark.sql import functions as F

from tessera.sources import jdbc as J
from tessera.streaming import exactly_once as XO
from tessera.streaming.batches import offset_ranges
from tessera.streaming.sources import kafka_options, start_offsets_frame, starting_offsets


def test_ledger_rules():
    plan = XO.plan_ledger
    assert plan([("t", 0, 10, 15)], {("t", 0): 10}) is not None
    assert plan([("t", 0, 10, 15)], {("t", 0): 15}) is None  # replay: skipped
    with pytest.raises(RuntimeError):
        plan([("t", 0, 12, 15)], {("t", 0): 10})  # gap, strict
    stmts = plan([("t", 0, 12, 15)], {("t", 0): 10}, strict=False)
    assert '"offset" = 15' in stmts[0][0] and '"offset" = 10' in stmts[0][0]
    with pytest.raises(RuntimeError):
        plan([("t", 0, 12, 18)], {("t", 0): 15})  # overlap
    new = plan([("t", 1, 0, 5)], {})
    assert new[0][0].startswith("INSERT") and len(new) == 2
    with pytest.raises(RuntimeError):
        plan([("t", 0, 10, 15), ("t", 1, 0, 5)], {("t", 0): 15})  # mixes committed and new


def _records(spark, part, lo, hi, lines):
    rows = [("t", part, o, None, lines[(o - lo) % len(lines)]) for o in range(lo, hi)]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string")


def test_commit_batch_exactly_once(spark):
    url = J.derby_memory_url()
    XO.create_tables(spark, url)
    b = _records(spark, 0, 0, 4, ["2014-12-11 18:33:52 ERROR a", "2014-12-11 18:33:59 INFO b"])
    assert XO.commit_batch(spark, url, b)
    assert not XO.commit_batch(spark, url, b)  # replay changes nothing
    res = XO.read_results(spark, url).collect()
    assert [(r["log_time"].strftime("%H:%M"), r["log_count"]) for r in res] == [("18:33", 2)]
    b2 = _records(spark, 0, 4, 6, ["2014-12-11 18:33:00 ERROR c"])
    assert XO.commit_batch(spark, url, b2)
    assert XO.read_results(spark, url).first()["log_count"] == 4
    led = XO.read_ledger_table(spark, url).collect()
    assert [(r["topic"], r["partition"], r["offset"]) for r in led] == [("t", 0, 6)]
    with pytest.raises(RuntimeError):
        XO.commit_batch(spark, url, _records(spark, 0, 8, 9, ["x"]))  # gap
    assert XO.read_results(spark, url).first()["log_count"] == 4


def test_offsets_and_options(spark):
    recs = _records(spark, 0, 3, 7, ["a"]).unionByName(_records(spark, 1, 0, 2, ["b"]))
    got = sorted(tuple(r) for r in offset_ranges(recs).collect())
    assert got == [("t", 0, 3, 7), ("t", 1, 0, 2)]
    ledger = offset_ranges(recs).select("topic", "partition", F.col("until_offset").alias("offset"))
    assert starting_offsets(ledger, "t") == ('{"t": [0, 1]}', '{"t": {"0": 7, "1": 2}}')
    assert starting_offsets(ledger, "other") is None
    assert start_offsets_frame(ledger).first()["offsets_json"] == '{"t":{"0":7,"1":2}}'
    opts = kafka_options("b:9092", "x, y")
    assert opts["subscribe"] == "x,y" and opts["startingOffsets"] == "latest"


def test_per_batch_word_count_stream(spark, tmp_path):
    from tessera.session import scratch_path
    from tessera.streaming.batches import batch_word_counts, start
    from tessera.streaming.sources import stream_lines
    src = tmp_path / "in"
    for i, text in enumerate(["a b a", "a c"]):
        d = src / f"f{i}"
        d.mkdir(parents=True)
        (d / "part.txt").write_text(text + "\n")
    out = scratch_path(spark, "wc-test")
    stream = stream_lines(spark, format="text", path=str(src / "*"), max_files_per_trigger=1)
    start(stream, batch_word_counts(out), scratch_path(spark, "wc-test-ckpt")).awaitTermination()
    got = sorted((r["word"], r["n"]) for r in spark.read.parquet(out).collect())
    assert got == [("a", 1), ("a", 2), ("b", 1), ("c", 1)]  # per batch, not cumulative


def test_resume_options_from_ledger(spark):
    url = J.derby_memory_url()
    XO.create_tables(spark, url)
    assert XO.resume_options(spark, url, "t") is None
    J.run_transaction(spark, url, ['INSERT INTO consumed_offsets ("topic", "partition", "offset") VALUES (\'t\', 1, 40)',
                                   'INSERT INTO consumed_offsets ("topic", "partition", "offset") VALUES (\'t\', 0, 7)'])
    assert XO.resume_options(spark, url, "t") == ('{"t": [0, 1]}', '{"t": {"0": 7, "1": 40}}')
    opts = kafka_options("b:9092", assign='{"t": [0, 1]}', starting_offsets='{"t": {"0": 7, "1": 40}}')
    assert "subscribe" not in opts and opts["failOnDataLoss"] == "true"


def test_batch_without_errors_still_moves_the_ledger(spark):
    url = J.derby_memory_url()
    XO.create_tables(spark, url)
    assert XO.commit_batch(spark, url, _records(spark, 3, 0, 3, ["2014-12-11 18:33:52 INFO a", "junk"]))
    assert XO.read_results(spark, url).count() == 0
    assert [tuple(r) for r in XO.read_ledger_table(spark, url).collect()] == [("t", 3, 3)]
