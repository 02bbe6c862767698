"""A stored table with a key, changed by copy-on-write merges.

Rows are dealt to ``buckets`` by a hash of the key, and a version of the table (``sinks.manifest``) names a folder for
each bucket.  A merge finds the buckets that its updates fall into, reads and rewrites only these, and creates the
next version, which names the new folders beside the untouched old ones.  Readers of an earlier version keep their
files; a merge that fails or loses a race leaves nothing that counts.

Memory: a task of the rewrite holds no bucket whole (anti join and union); the driver sees the bucket numbers.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.session import materialize
from tessera.sinks.manifest import Manifests
from tessera.sinks.upsert import upsert

_BUCKET = "_bucket"


class MergeTable:
    """The table at ``path`` with the rows' ``schema``; ``buckets`` is fixed when the table is first written."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, list(keys)
        self.versions = Manifests(spark, path)
        self.buckets = self._state(self.versions.newest()).get("buckets", buckets)

    def _state(self, version: int) -> dict:
        return self.versions.read(version)

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(n)).cast("int")

    def files(self) -> dict[int, str]:
        """The folder of each bucket that has rows or had some, in the newest version."""
        return {int(b): f for b, f in self._state(self.versions.newest()).get("folders", {}).items()}

    def _read(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def read(self) -> DataFrame:
        return self._read(list(self.files().values()))

    def _write(self, rows: DataFrame, touched: Sequence[int]) -> dict[int, str]:
        """Each bucket's rows in a folder of its own; buckets without rows get none."""
        name = f"data/{uuid.uuid4().hex}"
        rows.select(*self.schema.names, self._bucket(self.buckets).alias(_BUCKET)).repartition(F.col(_BUCKET)) \
            .write.partitionBy(_BUCKET).parquet(f"{self.path}/{name}")
        fs, root = self.versions._fs, self.versions._hadoop(name)
        there = {s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()}
        return {b: f"{name}/{_BUCKET}={b}" for b in touched if f"{_BUCKET}={b}" in there}

    def _change(self, updates: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        updates = materialize(updates.select(*self.schema.names), "merge-updates")
        while True:
            version = self.versions.newest()
            folders = self.files() if version else {}
            touched = sorted(r[0] for r in updates.select(self._bucket(self.buckets)).distinct().collect())  # at most ``buckets`` numbers
            if not touched:
                return []
            rows = change(self._read([folders[b] for b in touched if b in folders]), updates)
            new = self._write(rows, touched)
            after = {b: f for b, f in folders.items() if b not in touched} | new
            if self.versions.create(version + 1, {"buckets": self.buckets, "folders": after}):
                return touched

    def merge(self, updates: DataFrame) -> list[int]:
        """Replace or add the rows of ``updates`` by key (repeated keys raise); the buckets that were rewritten.

        Beaten by another writer, it reads the new version and merges into that.
        """
        return self._change(updates, lambda old, new: upsert(old, new, self.keys))

    def delete(self, rows: DataFrame) -> list[int]:
        """Remove the rows with the keys of ``rows`` (of the table's schema); the buckets that were rewritten."""
        return self._change(rows, lambda old, gone: old.join(gone.select(*self.keys), self.keys, "left_anti"))
