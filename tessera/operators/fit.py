"""Iterative fitting as distributed loops: Lloyd's k-means and logistic gradient descent.

The model (k centers, or d weights) is a handful of numbers held by the driver and shipped to the tasks
inside the batch function; each iteration is one map over Arrow batches, which adds up its task's part of
the sums with numpy, and one small aggregate over those parts.  The plan has the same size for every k and
d.  Points are dealt to all cores if they have fewer partitions, and persisted once (memory and disk), so a
lost executor recomputes its partitions from the scan.

Points without a vector (null, or with a null in it) belong to no cluster and have no gradient.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.javarandom import start_weights
from tessera.functions.text import tokens
from tessera.functions.vectors import closest, nearest, rows_of


def parse_vectors(lines: DataFrame, value: str = "value") -> DataFrame:
    """``x array<double>`` from space-separated numbers; a bad number fails (ANSI cast).

    Other columns of ``lines`` are carried along.
    """
    keep = [c for c in lines.columns if c != value]
    return lines.select(*keep, F.transform(tokens(value), lambda s: s.cast("double")).alias("x"))


def parse_points(lines: DataFrame, d: int, value: str = "value") -> DataFrame:
    """``y double, x array<double>``: field 0 is the label, the next ``d`` fields the point."""
    keep = [c for c in lines.columns if c != value]
    f = F.slice(tokens(value), 1, d + 1)
    nums = F.transform(f, lambda s: s.cast("double"))
    return lines.select(*keep, F.element_at(nums, 1).alias("y"), F.slice(nums, 2, d).alias("x"))


def sample_k(points: DataFrame, k: int, seed: int = 42, id_col: str = "id") -> DataFrame:
    """Exactly ``k`` rows without replacement, repeatably: the ``k`` smallest ``md5(seed:id)``.

    A top-k (``TakeOrderedAndProject``): each task keeps k rows, so nothing
    data-sized reaches the driver.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    return points.orderBy(key, F.col(id_col)).limit(k)


def assign(points: DataFrame, centers: list[list[float]], x: str = "x") -> DataFrame:
    """Add ``cluster`` (nearest center, ties to the lowest index) and ``dist`` (squared)."""
    return points.withColumn("_best", closest(F.col(x), centers)).select(
        *points.columns, F.col("_best.idx").alias("cluster"), F.col("_best.d").alias("dist"))


def _kept(points: DataFrame) -> DataFrame:
    """``points`` persisted, on at least as many partitions as there are cores."""
    cores = points.sparkSession.sparkContext.defaultParallelism
    spread = points.rdd.getNumPartitions() < cores
    return (points.repartition(cores) if spread else points).persist(StorageLevel.MEMORY_AND_DISK)


def _parts(values: np.ndarray, group: int) -> pa.RecordBatch:
    """One row a value of a partial sum: ``grp, pos, v``."""
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(values), group, np.int32)), pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)],
                                      names=["grp", "pos", "v"])


def _summed(parts: DataFrame) -> dict[int, dict[int, float]]:
    """The sums of all tasks' parts by group and place: the model's own size, whatever the number of points."""
    out: dict[int, dict[int, float]] = {}
    for g, pos, v in parts.groupBy("grp", "pos").agg(F.sum("v")).collect():
        out.setdefault(g, {})[pos] = v
    return out


def _cluster_sums(centers: np.ndarray):
    """Each task's count and sum of the points nearest to each center (place 0: the count)."""
    def run(batches):
        k, d = centers.shape
        total = np.zeros((k, d + 1))
        for b in batches:
            m, _ = rows_of(b.column(0), d)
            idx, _ = nearest(m, centers)
            total[:, 0] += np.bincount(idx, minlength=k)
            for c in np.unique(idx):
                total[c, 1:] += m[idx == c].sum(axis=0)
        for c in np.flatnonzero(total[:, 0]):
            yield _parts(total[c], c)
    return run


def _cluster_means(points: DataFrame, centers: list[list[float]], x: str = "x") -> dict[int, list[float]]:
    sums = _summed(points.select(x).mapInArrow(_cluster_sums(np.array(centers, float)), "grp int, pos int, v double"))
    return {c: [v[i] * (1.0 / v[0]) for i in range(1, len(v))] for c, v in sums.items()}


def kmeans(points: DataFrame, k: int, converge_dist: float, centers: list[list[float]] | None = None,
           seed: int = 42, max_iterations: int | None = None, x: str = "x", id_col: str = "id"
           ) -> tuple[list[list[float]], DataFrame]:
    """Lloyd's algorithm; returns ``(centers, points with cluster and dist)``.

    Stops when the **sum** of squared center moves is at most ``converge_dist``
    (or after ``max_iterations``).  At least one step is always taken; a
    cluster left empty keeps its previous center.
    """
    pts = _kept(points.select(id_col, x) if centers is None else points.select(x))
    if centers is None:
        centers = [list(r[x]) for r in sample_k(pts, k, seed, id_col).select(x).collect()]
    centers = [list(map(float, c)) for c in centers]
    step = 0
    while True:
        means = _cluster_means(pts, centers, x)
        moved = 0.0
        new = []
        for i, c in enumerate(centers):
            m = means.get(i, c)
            moved += sum((a - b) ** 2 for a, b in zip(c, m))
            new.append(m)
        centers = new
        step += 1
        if moved <= converge_dist or (max_iterations is not None and step >= max_iterations):
            break
    pts.unpersist()
    # The returned assignment is lazy and re-reads the points from their source.
    return centers, assign(points, centers, x)


def _gradient_sums(w: np.ndarray):
    """Each task's part of the gradient: two matrix products a batch."""
    def run(batches):
        total = np.zeros(len(w))
        for b in batches:
            m, which = rows_of(b.column(0), len(w))
            y = b.column(1).take(pa.array(which)).to_numpy(zero_copy_only=False).astype(float)
            with np.errstate(over="ignore"):  # a margin far below 0: exp is inf, its inverse 0
                factor = (1.0 / (1.0 + np.exp(-y * (m @ w))) - 1.0) * y
            total += np.where(np.isnan(y), 0.0, factor) @ m
        yield _parts(total, 0)
    return run


def logistic_gradient(points: DataFrame, w: list[float], x: str = "x", y: str = "y") -> DataFrame:
    """``pos, g``: the sum over points of ``x * (1/(1+exp(-y w.x)) - 1) * y``, one row a weight (none without
    points).  Points without a label add nothing."""
    parts = points.select(x, F.col(y).cast("double")).mapInArrow(_gradient_sums(np.array(w, float)), "grp int, pos int, v double")
    return parts.groupBy("pos").agg(F.sum("v").alias("g"))


def logistic_gd(points: DataFrame, d: int, iterations: int, w0: list[float] | None = None,
                seed: int = 42, x: str = "x", y: str = "y") -> DataFrame:
    """Full-batch gradient descent, step 1, no intercept or penalty; labels -1/+1.

    Returns the final weights as a frame ``pos, weight`` of d rows; each step brings d numbers to the driver.
    """
    w = list(w0) if w0 is not None else start_weights(d, seed)
    if iterations > 1:
        pts = _kept(points.select(x, y))
    for step in range(iterations):
        g = dict(map(tuple, logistic_gradient(pts if iterations > 1 else points, w, x, y).collect()))
        w = [w[i] - g.get(i, 0.0) for i in range(d)]
    if iterations > 1:
        pts.unpersist()
    return points.sparkSession.createDataFrame(list(enumerate(w)), "pos int, weight double")
