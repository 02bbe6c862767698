"""Exactly-once errors-per-minute: results and consumed offsets committed together.

Each micro-batch is aggregated on the executors (errors per minute), the
aggregate is staged into the database from the executors, and the driver
runs one transaction: an additive MERGE of the counts and, per Kafka
partition, a compare-and-set of the offset ledger from the batch's first
offset to its end.  If the ledger does not move by exactly one row the
transaction rolls back, so a batch replayed after a crash cannot count twice.

Ledger rules (``strict`` is for dense offsets, the default):

* a range wholly at or below the ledger is already committed; a batch made
  only of such ranges is skipped;
* a range that starts at the ledger (or a partition with no ledger row) is
  committed;
* a range that overlaps the ledger, or mixes committed and new ranges, raises;
* a range that starts above the ledger (a gap) raises in strict mode; with
  ``strict=False`` (topics with gaps from compaction or transactions) the
  compare-and-set starts from the ledger value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.logs import errors_per_minute, parse_log_lines
from tessera.sources import jdbc as J
from tessera.streaming.batches import offset_ranges

RESULT_TABLE = "minute_errors"
LEDGER_TABLE = "consumed_offsets"


def create_tables(spark: SparkSession, url: str) -> None:
    """DDL for the result table and the offset ledger (each with its key)."""
    J.run_transaction(spark, url, [
        f'CREATE TABLE {RESULT_TABLE} ("log_time" TIMESTAMP NOT NULL PRIMARY KEY, "log_count" BIGINT)',
        f'CREATE TABLE {LEDGER_TABLE} ("topic" VARCHAR(255) NOT NULL, "partition" INT NOT NULL, '
        '"offset" BIGINT, PRIMARY KEY ("topic", "partition"))'])


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def plan_ledger(ranges: list[tuple[str, int, int, int]], ledger: dict[tuple[str, int], int],
                strict: bool = True) -> list[tuple[str, int]] | None:
    """Ledger statements for a batch, or ``None`` when the batch was already committed.

    ``ranges`` are ``(topic, partition, from, until)``; ``ledger`` maps
    ``(topic, partition)`` to the stored offset.  Raises on overlaps and mixes,
    and on gaps in strict mode.
    """
    done, todo = [], []
    for topic, part, lo, hi in ranges:
        cur = ledger.get((topic, part))
        if cur is not None and hi <= cur and lo < cur:
            done.append((topic, part))
        elif cur is not None and lo < cur < hi:
            raise RuntimeError(f"offset range {lo}..{hi} of {topic}/{part} overlaps the ledger at {cur}")
        elif cur is not None and lo > cur and strict:
            raise RuntimeError(f"offset range {lo}..{hi} of {topic}/{part} leaves a gap after {cur}")
        else:
            todo.append((topic, part, lo, hi, cur))
    if done and not todo:
        return None
    if done:
        raise RuntimeError(f"batch mixes committed partitions {done} with new ranges")
    stmts: list[tuple[str, int]] = []
    for topic, part, lo, hi, cur in todo:
        if cur is None:
            stmts.append((f'INSERT INTO {LEDGER_TABLE} ("topic", "partition", "offset") '
                          f"VALUES ({_sql_str(topic)}, {part}, {lo})", 1))
            start = lo
        else:
            start = cur if lo > cur else lo
        stmts.append((f'UPDATE {LEDGER_TABLE} SET "offset" = {hi} WHERE "topic" = {_sql_str(topic)} '
                      f'AND "partition" = {part} AND "offset" = {start}', 1))
    return stmts


def read_ledger(spark: SparkSession, url: str, keys: list[tuple[str, int]]) -> dict[tuple[str, int], int]:
    """Stored offsets of the given partitions (one row each: bounded by the partition count)."""
    if not keys:
        return {}
    cond = " OR ".join(f'("topic" = {_sql_str(t)} AND "partition" = {p})' for t, p in keys)
    rows = J.query_rows(spark, url, f'SELECT "topic", "partition", "offset" FROM {LEDGER_TABLE} WHERE {cond}')
    return {(str(t), int(p)): int(o) for t, p, o in rows}


def commit_batch(spark: SparkSession, url: str, batch: DataFrame, strict: bool = True) -> bool:
    """Aggregate one batch of records and commit it with its offsets; False if skipped."""
    b = batch.persist()
    try:
        # One row per Kafka partition in the batch: bounded by the topic layout.
        ranges = [(r["topic"], int(r["partition"]), int(r["from_offset"]), int(r["until_offset"]))
                  for r in offset_ranges(b).collect()]
        if not ranges:
            return False
        stmts = plan_ledger(ranges, read_ledger(spark, url, [(t, p) for t, p, _, _ in ranges]), strict)
        if stmts is None:
            return False
        counts = errors_per_minute(parse_log_lines(b.select("value")))
        J.jdbc_upsert(counts, url, RESULT_TABLE, ["log_time"], additive=["log_count"], extra_statements=stmts)
        return True
    finally:
        b.unpersist()


def exactly_once_batch(url: str, strict: bool = True):
    """The ``foreachBatch`` function of the exactly-once stream."""
    def run(batch: DataFrame, batch_id: int) -> None:
        commit_batch(batch.sparkSession, url, batch, strict)
    return run


def read_results(spark: SparkSession, url: str) -> DataFrame:
    return J.jdbc_scan(spark, url, RESULT_TABLE)


def read_ledger_table(spark: SparkSession, url: str) -> DataFrame:
    return J.jdbc_scan(spark, url, LEDGER_TABLE)


def resume_options(spark: SparkSession, url: str, topic: str) -> tuple[str, str] | None:
    """``(assign, startingOffsets)`` for the Kafka source from the stored ledger (W5).

    On first start the ledger decides where to begin; afterwards the stream
    checkpoint leads and the ledger guards each commit.  ``None`` when the
    ledger holds nothing for the topic (nothing assigned, as in the reference).
    """
    from tessera.streaming.sources import starting_offsets
    return starting_offsets(read_ledger_table(spark, url), topic)


def run_exactly_once(spark: SparkSession, url: str, brokers: str, topic: str, checkpoint: str,
                     trigger: dict | None = None, strict: bool = True):
    """Errors per minute from a Kafka topic, committed exactly once with the offsets (W4, W5).

    Needs the Kafka connector on the classpath.  Returns the started query.
    """
    from tessera.streaming.batches import start
    from tessera.streaming.sources import EXACTLY_ONCE_INTERVAL, stream_kafka
    resume = resume_options(spark, url, topic)
    if resume is None:
        raise RuntimeError(f"no stored offsets for topic {topic}: nothing to assign")
    assign, offsets = resume
    records = stream_kafka(spark, brokers, assign=assign, starting_offsets=offsets)
    return start(records, exactly_once_batch(url, strict), checkpoint,
                 trigger or {"processingTime": EXACTLY_ONCE_INTERVAL}, name=f"exactly-once-{topic}")
