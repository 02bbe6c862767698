"""Versions of a table in shared storage: numbered JSON files that are created exclusively.

``manifests/<version>.json`` under the table's folder says what the table is made of; the highest version counts.
A version is written under another name and renamed, and the rename never replaces (on HDFS in one step), so of two
writers that build on the same version one fails and starts anew: compare and set.  What no version names doesn't
exist for readers; a crash before the rename leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Manifests:
    """The versions of the table at ``path``, through the Hadoop file system of its scheme."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._folder = self._hadoop("manifests")
        self._fs = self._folder.getFileSystem(self._conf)
        self._fs.mkdirs(self._folder)

    def _hadoop(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def newest(self) -> int:
        """The highest version; 0 before the first."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._folder)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)

    def read(self, version: int) -> dict:
        """What a version says; an empty dictionary for version 0."""
        if not version:
            return {}
        stream = self._fs.open(self._hadoop(f"manifests/{version:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def create(self, version: int, state: dict) -> bool:
        """Make ``version`` the newest; False, and no change, if it exists."""
        target, written = self._hadoop(f"manifests/{version:012d}.json"), self._hadoop(f"manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(written, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if self._fs.exists(target) or not self._rename(written, target):
            self._fs.delete(written, False)
            return False
        return True

    def _rename(self, source, target) -> bool:
        """A rename that fails if ``target`` exists."""
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(source, target, none)
            return True
        except Exception as e:
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
