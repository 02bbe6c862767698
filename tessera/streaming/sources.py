"""Stream sources: text lines (socket or files) and Kafka records, plus resume offsets."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Batch intervals of the three reference streams.
WORD_COUNT_INTERVAL = "3 seconds"
KAFKA_COUNT_INTERVAL = "3 seconds"
EXACTLY_ONCE_INTERVAL = "5 seconds"

RECORD_SCHEMA = "topic string, partition int, offset bigint, key string, value string"


def stream_lines(spark: SparkSession, format: str = "socket", host: str = "localhost", port: int = 9999,
                 path: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming frame of ``value`` lines, from a socket or from text files."""
    if format == "socket":
        return spark.readStream.format("socket").option("host", host).option("port", port).load()
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def kafka_options(brokers: str, topics: str | None = None, assign: str | None = None,
                  starting_offsets: str = "latest", fail_on_data_loss: bool = True) -> dict[str, str]:
    """Options for the Kafka source: subscribe to a comma list, or assign partitions explicitly."""
    opts = {"kafka.bootstrap.servers": brokers, "startingOffsets": starting_offsets,
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    if assign is not None:
        opts["assign"] = assign
    else:
        opts["subscribe"] = ",".join(t.strip() for t in (topics or "").split(",") if t.strip())
    return opts


def stream_kafka(spark: SparkSession, brokers: str, topics: str | None = None, assign: str | None = None,
                 starting_offsets: str = "latest") -> DataFrame:
    """Kafka records as ``topic, partition, offset, key, value`` strings (needs the Kafka connector jar)."""
    raw = spark.readStream.format("kafka").options(**kafka_options(brokers, topics, assign, starting_offsets)).load()
    return raw.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"))


def starting_offsets(ledger: DataFrame, topic: str) -> tuple[str, str] | None:
    """``(assign, startingOffsets)`` JSON options from a ledger ``topic, partition, offset``.

    The ledger has one row per Kafka partition (a few hundred at most), so it
    is brought to the driver to build the option strings.  An empty ledger
    assigns nothing: ``None``.
    """
    rows = ledger.where(F.col("topic") == topic).select("partition", "offset").orderBy("partition").collect()
    if not rows:
        return None
    assign = json.dumps({topic: [int(r["partition"]) for r in rows]})
    start = json.dumps({topic: {str(int(r["partition"])): int(r["offset"]) for r in rows}})
    return assign, start


def start_offsets_frame(ledger: DataFrame) -> DataFrame:
    """``topic, offsets_json``: the ``startingOffsets`` JSON per topic, built distributed."""
    entries = F.array_sort(F.collect_list(F.struct(F.col("partition").cast("int").alias("p"),
                                                   F.col("offset").cast("bigint").alias("o"))))
    per_topic = ledger.groupBy("topic").agg(entries.alias("_e"))
    as_map = F.map_from_entries(F.transform("_e", lambda s: F.struct(s["p"].cast("string"), s["o"])))
    return per_topic.select("topic", F.to_json(F.create_map(F.col("topic"), as_map)).alias("offsets_json"))


def stamp_files(spark: SparkSession, path: str) -> int:
    """Give the files of ``path`` modification times in the order of their names (the order in which a file
    stream takes them).  Metadata only.  Returns their number."""
    import time
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((st.getPath().getName(), st.getPath()) for st in fs.listStatus(root) if st.isFile() and not st.getPath().getName().startswith((".", "_")))
    base = int(time.time() * 1000) - 1000 * (len(files) + 60)
    for i, (_, file) in enumerate(files):
        fs.setTimes(file, base + 1000 * i, -1)
    return len(files)


def stamp_in_order(spark: SparkSession, path: str, partition_col: str) -> int:
    """Give the files under ``path/<col>=<n>/`` modification times increasing with ``n``.

    A file stream picks files up in modification-time order; Kafka delivers
    each partition in offset order.  When a topic is replayed from files (one
    folder per offset slice), this makes the file stream deliver the slices in
    order.  Metadata only: one listing and one ``setTimes`` per file, through
    the Hadoop FileSystem API.  Returns the number of files stamped.
    """
    import time
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    prefix = partition_col + "="
    dirs = [st.getPath() for st in fs.listStatus(root)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)]
    dirs.sort(key=lambda p: float(p.getName()[len(prefix):]))
    base = int(time.time() * 1000) - 1000 * (len(dirs) + 60)
    n = 0
    for i, d in enumerate(dirs):
        for st in fs.listStatus(d):
            name = st.getPath().getName()
            if st.isFile() and not name.startswith((".", "_")):
                fs.setTimes(st.getPath(), base + 1000 * i, -1)
                n += 1
    return n
