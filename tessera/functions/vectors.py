"""Dense-vector kernels: numpy over the flat values of an Arrow list column, one call a batch.

``rows_of`` views a list column as a matrix without copying a value, so a kernel's cost is its arithmetic.
``dot``, ``squared_distance`` and ``closest`` are column functions built on them; ``operators.fit`` calls the
kernels inside its own batch maps.

A null vector, or one with a null in it, gives null; vectors of unequal length raise.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def rows_of(vectors: pa.Array, d: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(matrix, which)``: the rows of a list column that are vectors, and their places in it.  Vectors of
    another length than ``d`` (default: than the first) raise."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    size = vectors.value_lengths()
    whole = ~np.asarray(vectors.is_null())
    flat, bounds = vectors.flatten(), np.concatenate([[0], np.cumsum(size.fill_null(0).to_numpy())])
    if flat.null_count:
        holes = np.concatenate([[0], np.cumsum(np.asarray(flat.is_null()))])
        whole &= holes[bounds[1:]] == holes[bounds[:-1]]
    which = np.flatnonzero(whole)
    lengths = np.diff(bounds)[which]
    d = int(lengths[0]) if d is None and len(lengths) else d or 0
    if (lengths != d).any():
        raise ValueError(f"vectors of {sorted(set(lengths.tolist()) | {d})} values in one column")
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    if len(which) < len(vectors):
        keep = np.repeat(whole, np.diff(bounds))
        values = values[keep]
    return values.reshape(len(which), d), which


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Of every row of ``x`` to every center.  Differences are squared, not expanded into products, so equal
    points are at exactly 0 and ties stay ties; one center at a time bounds the memory to the batch."""
    return np.stack([np.square(x - c).sum(axis=1) for c in centers], axis=1) if len(centers) else np.zeros((len(x), 0))


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(index, squared distance)`` of each row's nearest center; ties go to the lowest index."""
    d = squared_distances(x, centers)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(x)), best]


def spread(values: np.ndarray, which: np.ndarray, n: int) -> pa.Array:
    """``values`` at the places ``which`` of a column of n, null elsewhere."""
    out, none = np.zeros(n, values.dtype), np.ones(n, bool)
    out[which], none[which] = values, False
    return pa.array(out, mask=none)


def _pairwise(a: pa.Array, b: pa.Array, kernel) -> pa.Array:
    (x, at), (y, bt) = rows_of(a), rows_of(b)
    both, i, j = np.intersect1d(at, bt, assume_unique=True, return_indices=True)
    if len(both) and x.shape[1] != y.shape[1]:
        raise ValueError(f"vectors of {x.shape[1]} and {y.shape[1]} values")
    return spread(kernel(x[i], y[j]), both, len(a))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two ``array<double>`` columns."""
    def kernel(x: pa.Array, y: pa.Array) -> pa.Array:
        return _pairwise(x, y, lambda p, q: (p * q).sum(axis=1) if p.size else np.zeros(len(p)))
    return F.arrow_udf(kernel, "double")(a, b)


def squared_distance(a: Column, b: Column) -> Column:
    def kernel(x: pa.Array, y: pa.Array) -> pa.Array:
        return _pairwise(x, y, lambda p, q: np.square(p - q).sum(axis=1) if p.size else np.zeros(len(p)))
    return F.arrow_udf(kernel, "double")(a, b)


def closest(x: Column, centers: Sequence[Sequence[float]]) -> Column:
    """``struct(d, idx)`` of the nearest of ``centers`` by squared distance; ties go to the lowest index.  The
    centers travel with the function, not as literals of the plan."""
    at = np.array(centers, float)

    def kernel(v: pa.Array) -> pa.Array:
        m, which = rows_of(v, at.shape[1])
        idx, d = nearest(m, at)
        return pa.StructArray.from_arrays([spread(d, which, len(v)), spread(idx.astype(np.int32), which, len(v))], names=["d", "idx"])
    return F.arrow_udf(kernel, "d double, idx int")(x)
