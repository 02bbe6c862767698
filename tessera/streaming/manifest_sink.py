"""Exactly-once results without a database: data and source position in one manifest, created exclusively.

A table is a folder in shared storage::

    data/<random>/part-*.parquet     what one batch (or a merge of several) adds up to
    manifests/<version>.json         which data folders hold, and how far the source is read

The highest version is the table's state.  A batch is written to a data folder of its own first; the one step that
makes it count is the creation of the next manifest, which names that folder beside the earlier ones and moves the
positions.  The file is written under another name and renamed; a rename never replaces (on HDFS in one step), so of
two writers that have read the same version one fails, reads the new state and plans its batch anew: compare and
set (``sinks.manifest``).  A crash before the rename leaves a folder that nothing names; a crash after it a batch that the positions
show as done, so a replay, also one with a new checkpoint, changes nothing.

Positions are offsets by (topic, partition); a batch's ranges follow ``plan_positions``.  Results are sums by key: a
read adds up the named folders, and every ``MERGE_AT`` commits they are merged into one.  The driver handles a
manifest of that many names and a number a partition; the data stay with the executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.logs import errors_per_minute, parse_log_lines
from tessera.sinks.manifest import Manifests
from tessera.streaming.batches import offset_ranges

#: Data folders that a manifest names before they are merged.
MERGE_AT = 16
Range = tuple[str, int, int, int]
Positions = dict[tuple[str, int], int]


def plan_positions(ranges: list[Range], at: Positions, strict: bool = True) -> Positions | None:
    """Positions after a batch of ``(topic, partition, from, until)``, or ``None`` if all of it is committed.

    A range that starts at its position (or in a partition without one) is new, one that ends at or before it is
    committed.  Raises if a range overlaps its position, if committed and new ranges are mixed, and, where offsets
    are dense (``strict``), if a range leaves a gap.
    """
    old = [r for r in ranges if r[3] <= at.get(r[:2], r[2])]
    new = [r for r in ranges if r not in old]
    for topic, part, lo, _ in new:
        here = at.get((topic, part), lo)
        if lo < here or (strict and lo > here):
            raise RuntimeError(f"{topic}/{part} is read up to {here}; a batch begins at {lo}")
    if old and new:
        raise RuntimeError(f"a batch mixes committed ranges {old} with new ones {new}")
    return {**at, **{r[:2]: r[3] for r in new}} if new else None


class ManifestTable:
    """Sums of ``measures`` by ``keys`` under ``path``, with the positions of the source."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], measures: list[str]):
        self.spark, self.path, self.keys, self.measures = spark, path, keys, measures
        self.versions = Manifests(spark, path)

    def state(self, version: int | None = None) -> dict:
        """``{"data": [folders], "positions": [[topic, partition, offset]]}`` of a version (default: the newest)."""
        return {"data": [], "positions": []} | self.versions.read(self.versions.newest() if version is None else version)

    def positions(self) -> Positions:
        return {(t, int(p)): int(o) for t, p, o in self.state()["positions"]}

    def _write(self, df: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        df.select(*self.keys, *self.measures).write.parquet(f"{self.path}/{folder}")
        return folder

    def _added(self, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.path}/{f}" for f in folders)).groupBy(*self.keys).agg(*(F.sum(m).alias(m) for m in self.measures))

    def read(self) -> DataFrame:
        """The sums of the newest version (raises before the first commit: there is no schema yet)."""
        return self._added(self.state()["data"])

    def commit(self, ranges: list[Range], result: Callable[[], DataFrame], strict: bool = True) -> bool:
        """Add ``result()`` and move the positions over ``ranges``, both or neither; False if that was done before.

        ``result`` is evaluated and written at most once, also if another writer comes first with another batch.
        """
        folder = None
        while True:
            version = self.versions.newest()
            state = self.state(version)
            after = plan_positions(ranges, {(t, int(p)): int(o) for t, p, o in state["positions"]}, strict)
            if after is None:
                return False
            folder = folder or self._write(result())
            data = [*state["data"], folder]
            if len(data) > MERGE_AT:
                data = [self._write(self._added(data))]
            if self.versions.create(version + 1, {"data": data, "positions": [[t, p, o] for (t, p), o in sorted(after.items())]}):
                return True


def commit_errors(table: ManifestTable, batch: DataFrame, strict: bool = True) -> bool:
    """Errors per minute of one batch of records (``topic, partition, offset, value``), committed with its offsets."""
    batch = batch.persist()
    try:
        # a row for each source partition of the batch
        ranges = [(r["topic"], int(r["partition"]), int(r["from_offset"]), int(r["until_offset"])) for r in offset_ranges(batch).collect()]
        if not ranges:
            return False
        return table.commit(ranges, lambda: errors_per_minute(parse_log_lines(batch.select("value"))), strict)
    finally:
        batch.unpersist()


def errors_table(spark: SparkSession, path: str) -> ManifestTable:
    return ManifestTable(spark, path, ["log_time"], ["log_count"])


def run_errors(records: DataFrame, table: ManifestTable, checkpoint: str, trigger: dict | None = None, strict: bool = True):
    """The stream of ``records`` into ``table``, exactly once; returns the started query."""
    from tessera.streaming.batches import start
    from tessera.streaming.sources import EXACTLY_ONCE_INTERVAL

    def batch(df: DataFrame, batch_id: int) -> None:
        commit_errors(table, df, strict)
    return start(records, batch, checkpoint, trigger or {"processingTime": EXACTLY_ONCE_INTERVAL}, name=f"exactly-once-{uuid.uuid4().hex[:8]}")


def position_frame(table: ManifestTable) -> DataFrame:
    """``topic, partition, offset``: where a new stream resumes (see ``sources.starting_offsets``)."""
    rows = [(t, p, o) for (t, p), o in sorted(table.positions().items())]
    return table.spark.createDataFrame(rows, "topic string, partition int, offset bigint")
