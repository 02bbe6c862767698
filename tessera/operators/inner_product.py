"""Exact top-n by inner product between two factor tables, without scoring all pairs.

Candidates are numbered by falling norm and cut into blocks of ``BLOCK``.  In each round one block, a matrix of
bounded size, goes to all tasks and meets every query that is still open; a query's list is closed once the product of
its norm and the next block's largest cannot reach its n-th score (Cauchy-Schwarz).  Rounds end when no query
is open.  Where norms vary, most queries need few blocks; at worst every pair is scored, as a full join would,
but in matrix products without a shuffle of pairs.

A query's state between rounds is its vector and at most n candidates, written to the shared folder.  Ties go to
the lower candidate id after rounding to 9 places.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.vectors import rows_of
from tessera.operators.common import dense_number
from tessera.session import materialize

#: Candidates of one round (times the vector's length, 8 bytes each, at the driver and in every task).
BLOCK = 16_384
#: Queries scored at once: 256 x BLOCK scores are 32 MB.
QUERIES = 256

_STATE = "id long, vec array<double>, items array<long>, scores array<double>, open boolean"


def _best(items: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    key = np.round(scores, 9)
    if len(key) > n:
        keep = np.flatnonzero(key >= np.partition(key, len(key) - n)[len(key) - n])
        items, scores, key = items[keep], scores[keep], key[keep]
    order = np.lexsort((items, -key))[:n]
    return items[order], scores[order]


def _round(ids: np.ndarray, block: np.ndarray, next_norm: float | None, n: int):
    """Scores a block for every open query; ``next_norm``: the largest norm after it (None: it is the last)."""
    def run(batches):
        for b in batches:
            vectors, which = rows_of(b.column("vec"), block.shape[1])
            b = b.take(pa.array(which))
            for lo in range(0, len(vectors), QUERIES):
                part = b.slice(lo, QUERIES)
                x = vectors[lo:lo + QUERIES]
                scores = x @ block.T
                norms = np.sqrt(np.square(x).sum(axis=1))
                out: list[list] = [[], [], []]
                for i, (old, had) in enumerate(zip(part.column("items").to_pylist(), part.column("scores").to_pylist())):
                    items, best = _best(np.concatenate([np.array(old, np.int64), ids]), np.concatenate([np.array(had, float), scores[i]]), n)
                    reach = -np.inf if next_norm is None else norms[i] * next_norm
                    out[0].append(items.tolist())
                    out[1].append(best.tolist())
                    out[2].append(bool(next_norm is not None and (len(best) < n or reach >= best[-1] - 1e-8 * max(1.0, abs(best[-1])))))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("vec"), pa.array(out[0], pa.list_(pa.int64())),
                                                  pa.array(out[1], pa.list_(pa.float64())), pa.array(out[2])], names=["id", "vec", "items", "scores", "open"])
    return run


def top_inner(queries: DataFrame, candidates: DataFrame, n: int, block: int = BLOCK, trace: list | None = None) -> DataFrame:
    """``id, rank, item, score``: the ``n`` candidates with the largest inner product for every query.

    Both tables are ``id, vec array<double>``; null vectors take no part.  ``trace`` takes the number of open
    queries of each round.
    """
    vec = F.col("vec").cast("array<double>")
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, v: a + v * v))
    rows = candidates.where("vec IS NOT NULL").select(F.col("id").cast("long").alias("id"), vec.alias("vec"), norm.alias("norm")).withColumn("down", -F.col("norm"))
    numbered = materialize(dense_number(rows, ["down", "id"], (), "pos").withColumn("block", F.floor(F.col("pos") / block)), "factor-blocks")
    blocks = numbered.agg(F.max("block")).first()[0]
    state = queries.where("vec IS NOT NULL").select(F.col("id").cast("long").alias("id"), vec.alias("vec"), F.array().cast("array<long>").alias("items"),
                                                    F.array().cast("array<double>").alias("scores"), F.lit(True).alias("open"))
    closed = state.limit(0)
    for k in range(0 if blocks is None else blocks + 1):
        own = numbered.where(F.col("block") == k).orderBy("pos").select("id", "vec").collect()  # at most BLOCK rows
        after = numbered.where(F.col("pos") == (k + 1) * block).select("norm").first()
        ids, matrix = np.array([r["id"] for r in own], np.int64), np.array([r["vec"] for r in own], float)
        state = materialize(state.where("open").mapInArrow(_round(ids, matrix, after and after["norm"], n), _STATE), "top-inner")
        closed = closed.unionByName(state.where("NOT open"))
        left = state.where("open").count()
        if trace is not None:
            trace.append(left)
        if not left:
            break
    ranked = closed.select("id", F.posexplode(F.arrays_zip("items", "scores")).alias("p", "c"))
    return ranked.select("id", (F.col("p") + 1).alias("rank"), F.col("c.items").alias("item"), F.col("c.scores").alias("score"))
