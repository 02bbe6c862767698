"""Session construction and the shared scratch location.

Everything that needs to outlive a stage (lineage cuts in iterative loops,
round-trip outputs, stream checkpoints) goes under the folder the cluster
names in ``spark.checkpoint.dir``.  That setting is read from the running
session; a default is only installed when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app_name: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every operator here assumes.

    UTC session zone (log times are zone-less), AQE with partition coalescing
    and skew-join splitting, and the UI off.  ``master`` is only applied when
    given, so spark-submit keeps control on a cluster.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if master and master.startswith("local"):
        # Local runs: the driver is the only JVM, give it room for plans and shuffles.
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local run without one gets a temporary one, a cluster raises."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None) \
        or sc.getConf().get(CHECKPOINT_CONF, None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share (master {sc.master})")
        current = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 2 MB for the session: 10,000 rows, the usual bound, may hold any size of text,
    and the JVM and each Python worker keep several copies of a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 21))


#: Shuffle files go when the execution that made them ends.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The driver keeps the text of each execution's plan, with all that a literal holds: so many characters for a written table.
PLAN_CONF, PLAN_CHARS = "spark.sql.maxPlanStringLength", "20000"
CLEAN = {CLEANUP_CONF: "true", PLAN_CONF: PLAN_CHARS}
#: Tasks read at most so much of a table or a shuffle, so that their sorts and aggregates stay in memory, not on disk.
SMALL_TASKS = {"spark.sql.files.maxPartitionBytes": "16m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}


@contextmanager
def held(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the actions inside the block."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df, name: str, clean: bool = False, options: dict | None = None, conf: Mapping[str, str] | None = None):
    """Write ``df`` once as a table under the shared checkpoint folder and read it back.

    Used where one intermediate feeds several branches of a plan (Spark
    recomputes a shared subtree per branch otherwise) and to cut lineage:
    the table lives in shared storage, so a lost executor does not force a
    recompute from the sources.  Eager: runs one job (the schema is known, so reading back runs none).
    ``clean``: the shuffle files of the write go when it ends, not when the driver next collects garbage, and the
    driver keeps a short text of its plan.
    ``options``: of the Parquet writer.  ``conf``: held during the write.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with held(spark, {**(CLEAN if clean else {}), **(conf or {})}):
        df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(df, name: str, options: dict | None = None, conf: Mapping[str, str] | None = None):
    """A table of ``df``, and no shuffle files besides: those of all steps of a query, kept until the driver
    collects garbage, may hold several times the input."""
    return materialize(df, name, clean=True, options=options, conf=conf)
