"""Bindings from the driver's parquet tables to operator inputs.

Each function reads only the columns it needs (Catalyst prunes the parquet
scan) and derives the input an operator expects: text lines, log lines,
(user, item, rating) triples, edge lists, vectors, Kafka-shaped records.
Nothing here collects data; every binding grows with its tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import text_lines

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Application names of the tab log format, in order.
LOG_APPS = ["Java", "MySQL", "Nginx"]
KAFKA_TOPIC = "events"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, line_no, value``: each document's text as lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(text_lines("text")).alias("line_no", "value"))


def _log_time(ts: str = "ts"):
    return F.date_format(F.col(ts), "yyyy-MM-dd HH:mm:ss")


def log_lines_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, value``: ``<time> <LEVEL> <props>`` lines from ``events``."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.concat_ws(" ", _log_time(), F.upper("event_type"),
                                             F.col("props")).alias("value"))


def log_app(user_id: str = "user_id"):
    return F.element_at(F.array(*[F.lit(a) for a in LOG_APPS]),
                        (F.pmod(F.col(user_id), F.lit(len(LOG_APPS))) + 1).cast("int"))


def log_lines_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, value``: tab-separated ``time, LEVEL, app, props`` lines."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.concat_ws("\t", _log_time(), F.upper("event_type"),
                                             log_app(), F.col("props")).alias("value"))


def damaged_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab log lines of which a tenth end after the time and another tenth after the level."""
    line, kind = F.split("value", "\t"), F.col("event_id") % 10
    cut = F.when(kind == 3, F.slice(line, 1, 1)).when(kind == 7, F.slice(line, 1, 2)).otherwise(line)
    return log_lines_tab(spark, sf_dir).select("event_id", F.array_join(cut, "\t").alias("value"))


def event_item(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user string, item int, rating double``: clicks per (user, item) of ``events``.

    One row per (user, item), as the recommender's input contract requires.
    """
    ev = table(spark, sf_dir, "events")
    return (ev.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"),
                      event_item().alias("item"))
            .groupBy("user", "item").agg(F.count(F.lit(1)).cast("double").alias("rating")))


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: ``user item clicks`` text lines built from the event ratings."""
    r = event_ratings(spark, sf_dir)
    return r.select(F.concat_ws(" ", "user", F.col("item").cast("string"),
                                F.col("rating").cast("bigint").cast("string")).alias("value"))


def order_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger ratings: (customer, supplier, line count) from ``orders`` joined with ``lineitem``."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy("o_custkey", "l_suppkey").agg(F.count(F.lit(1)).cast("double").alias("rating"))
            .select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("user"),
                    F.col("l_suppkey").cast("int").alias("item"), "rating"))


def quantity_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heavy ratings: (customer, supplier, pieces ordered) from ``orders`` joined with ``lineitem``.  Whole
    numbers from one to hundreds, so the columns' norms pass DIMSUM's bound at every scale."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_suppkey").cast("int").alias("item"))
            .agg(F.sum("l_quantity").cast("double").alias("rating")))


def user_vertex(user_id: str = "user_id"):
    """Users of the bipartite graphs get negative vertex ids, items keep theirs."""
    return -(F.col(user_id).cast("bigint") + 1)


def bipartite_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user, item`` vertex ids of the distinct (user, item) pairs of ``events``."""
    ev = table(spark, sf_dir, "events")
    return (ev.select(user_vertex().alias("user"), event_item().cast("bigint").alias("item"))
            .distinct())


def order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed customer -> supplier edges, one per line item; suppliers are sinks.

    Customers keep their keys (>= 0); supplier ``k`` is vertex ``-(k + 1)``, so
    the two id ranges cannot meet (key 0 exists on both sides).
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("src"), (-(F.col("l_suppkey") + 1)).alias("dst"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, x array<double>``: the embedding vectors."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"))


def labelled_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, y, x``: y = +1 for even labels else -1, x = the embedding values."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"),
                    F.when(F.pmod("label", F.lit(2)) == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("y"),
                    F.col("embedding").cast("array<double>").alias("x"))


def kafka_records(spark: SparkSession, sf_dir: str, partitions: int = 2) -> DataFrame:
    """Kafka-shaped records from ``events``: ``topic, partition, offset, key, value``.

    Partition is ``user_id mod partitions``; offsets are dense per partition in
    event order (what a broker assigns), value is the space-format log line.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "props")
    part = F.pmod(F.col("user_id"), F.lit(partitions)).cast("int")
    base = ev.select(F.lit(KAFKA_TOPIC).alias("topic"), part.alias("partition"), "event_id",
                     F.col("user_id").cast("string").alias("key"),
                     F.concat_ws(" ", _log_time(), F.upper("event_type"), F.col("props")).alias("value"))
    return with_dense_offsets(base)


def with_dense_offsets(df: DataFrame) -> DataFrame:
    """Dense 0-based ``offset`` per (topic, partition) in ``event_id`` order.

    No per-partition window: one topic partition may hold a third of all rows.
    ``dense_number`` numbers range partitions and stitches them with a small
    prefix sum instead.
    """
    from tessera.operators.common import dense_number
    numbered = dense_number(df, ["event_id"], ["topic", "partition"], "offset")
    return numbered.select("topic", "partition", F.col("offset").cast("bigint").alias("offset"),
                           "event_id", "key", "value")


def next_item_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``src, dst``: each event's item to the same user's next event's item, by (ts, event_id).

    Repeated edges are kept.  Built with ``next_in_group`` (a lead without a
    per-user window), so one very active user is never a single task.
    """
    from tessera.operators.common import next_in_group
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id",
                                               event_item().cast("bigint").alias("k"))
    nxt = next_in_group(ev, ["user_id"], ["ts", "event_id"], ["k"])
    return nxt.where(F.col("next_k").isNotNull()).select(F.col("k").alias("src"), F.col("next_k").alias("dst"))
