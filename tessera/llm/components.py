"""Connected components of a link table, on Spark only: nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

JUMPS = 3


def _relabel(df: DataFrame, parent: DataFrame, col: str) -> DataFrame:
    """``df`` with ``col`` replaced by its parent, if it has one."""
    p = parent.select(F.col("child").alias("_child"), F.col("root").alias("_root"))
    return df.join(p, F.col(col) == F.col("_child"), "left") \
        .withColumn(col, F.coalesce("_root", F.col(col))).drop("_child", "_root")


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, comp`` for every node of ``links``; ``comp`` is a node of the component (its least).

    Each pass hangs every label under its least neighbour, follows the parents ``2**JUMPS`` steps,
    and contracts the links; written tables cut the lineage after each pass.  The links shrink with
    every pass; a pass costs a shuffle of the links and the labels.  Null ends are not linked.
    """
    links = materialize(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b").distinct(), "links")
    nodes = links.select("a").union(links.select("b")).distinct().select(F.col("a").alias("node"), F.col("a").alias("comp"))
    edges = links
    while not edges.isEmpty():
        low, high = F.least("a", "b"), F.greatest("a", "b")
        parent = materialize(edges.select(high.alias("child"), low.alias("root")).groupBy("child").agg(F.min("root").alias("root")), "parents")
        for _ in range(JUMPS):
            parent = _relabel(parent, parent, "root")
        parent = materialize(parent, "parents")
        nodes = materialize(_relabel(nodes, parent, "comp"), "labels")
        edges = materialize(_relabel(_relabel(edges, parent, "a"), parent, "b").where("a != b").distinct(), "links")
    return nodes
