"""Operator 1, approximate nearest neighbours: multiprobe p-stable hashing for inner products.

Vectors are split into bands of norms that differ by less than a factor ``RATIO``.  Within a band they are
scaled by its largest norm and get one more component that makes all norms 1, so the largest inner
product with a query is the least distance.  Every band, however few vectors it holds, is hashed and searched with
probes of its own, and none is skipped.  ``TABLES`` tables of ``HASHES`` functions
``floor((a x + b) / WIDTH)`` with normal (2-stable) ``a`` name a vector's buckets.  A query visits its
own bucket and perturbed ones, one step up or down in any of the coordinates, in order of their
estimated success (the squared distances to the walls that are crossed), ``PROBES`` a table.  The
candidates of all tables are merged and ranked by their exact inner products in double precision.

Buckets are grouped to pages by their first two coordinates.  A page is split into chunks of about
``CHUNK`` vectors and meets the queries in blocks of about ``BLOCK``, so no bucket or query set is too
large for a task, and none is capped.  A task only scores buckets that the query probes.

Equal vectors are indexed once, with their least ids (no query's list can hold more of them), and
equal queries are searched once.  Queries with fewer than ``k`` finds are searched again against all
buckets, so lists are short only if there are too few candidates.

The functions are drawn at random from a seed; nothing is fitted to the data but the bands' largest norms
and the dimension.  Vectors null, zero, of another length than most, or with null or non-finite
components take no part, nor do rows without id.  Of rows with equal ids the least vector counts.  Vectors
of floats or doubles are compared as they are, other numbers as doubles; products that overflow a double have no
defined order.  An empty table, or one without queries, gives no rows; extra columns don't matter, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.sizes import small
from tessera.session import materialize

TABLES, HASHES, WIDTH, PROBES = 3, 6, 2.0, 110
RATIO = 1.1
CHUNK, BLOCK = 16_384, 4096
_SPAN = 64


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths of the rows, none of them zero, without overflow of the squares."""
    top = np.abs(x).max(1)
    return top * np.sqrt(((x / top[:, None]) ** 2).sum(1))


class Hashes:
    """The hash functions: a, b by table; vectors are given with their extra component."""

    def __init__(self, dim: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.a = rng.standard_normal((TABLES, dim + 1, HASHES))
        self.b = rng.uniform(0, WIDTH, (TABLES, HASHES))
        self.steps = np.array(list(itertools.product((0, -1, 1), repeat=HASHES)))

    def index(self, x: np.ndarray, scale: np.ndarray) -> np.ndarray:
        x = x / scale[:, None]
        return np.column_stack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1)))])

    def query(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([x / norms(x)[:, None], np.zeros(len(x))])

    def place(self, table: int, x: np.ndarray) -> np.ndarray:
        """Real-valued coordinates; their floors name the bucket."""
        return (x @ self.a[table] + self.b[table]) / WIDTH

    @staticmethod
    def name(coords: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(page, code in the page) of bucket coordinates in the last axis."""
        c = np.clip(coords.astype(np.int64) + _SPAN // 2, 0, _SPAN - 1)
        page, code = np.zeros(c.shape[:-1], np.int64), np.zeros(c.shape[:-1], np.int64)
        for i in range(c.shape[-1]):
            if i < 2:
                page = page * _SPAN + c[..., i]
            else:
                code = code * _SPAN + c[..., i]
        return page.astype(np.int32), code

    def probes(self, table: int, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(page, code) of the buckets to visit, queries x most, the likeliest first."""
        f = self.place(table, x)
        low = np.floor(f)
        up = f - low
        cost = np.zeros((len(x), len(self.steps)))
        for i in range(HASHES):
            cost += np.stack([np.zeros(len(x)), (1 - up[:, i]) ** 2, up[:, i] ** 2], 1)[:, self.steps[:, i]]
        order = np.argsort(cost, axis=1, kind="stable")[:, :most]
        return self.name(low[:, None, :] + self.steps[order])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _index(h: Hashes, scales: dict[int, float]):
    """``scales``: the largest norm of each band."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                band = part.column("band")
                x = h.index(_matrix(part.column("vec")), np.array([scales[i] for i in band.to_pylist()]))
                for table in range(TABLES):
                    page, code = h.name(np.floor(h.place(table, x)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), table, np.int32)), band, pa.array(page), pa.array(code), part.column("ids"), part.column("vec")],
                                                     names=["table", "band", "page", "code", "ids", "vec"])
    return run


def _visits(h: Hashes, most: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                x = h.query(_matrix(part.column("vec")))
                for table in range(TABLES):
                    page, code = h.probes(table, x, most)
                    order = np.argsort(page, axis=1, kind="stable")
                    page, code = np.take_along_axis(page, order, 1), np.take_along_axis(code, order, 1)
                    new = np.ones(page.shape, bool)
                    new[:, 1:] = page[:, 1:] != page[:, :-1]
                    at_ = np.flatnonzero(new)
                    codes = pa.ListArray.from_arrays(pa.array(np.append(at_, page.size).astype(np.int32)), pa.array(code.reshape(-1)))
                    who = pa.array((at_ // page.shape[1]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at_), table, np.int32)), pa.array(page.reshape(-1)[at_]), codes, part.column("rep").take(who), part.column("vec").take(who)],
                                                     names=["table", "page", "codes", "rep", "vec"])
    return run


def best(reps: np.ndarray, q: np.ndarray, allowed: np.ndarray, ids: list, x: np.ndarray, k: int) -> tuple[list, list, list]:
    """The k best ids of each query among its allowed vectors: exact scores, ties to the smaller id."""
    score = np.where(allowed, q @ x.T, -np.inf)
    m = min(k, score.shape[1])
    # all that may tie with the k-th: the product's rounding is less than the tolerance
    error = 1e-12 * norms(q) * norms(x).max()
    cut = np.partition(score, score.shape[1] - m, axis=1)[:, score.shape[1] - m] - error
    least = np.array([i[0] for i in ids])
    out: tuple[list, list, list] = ([], [], [])
    for i in range(len(q)):
        at = np.flatnonzero(allowed[i] & (score[i] >= cut[i]))
        exact = (x[at] * q[i]).sum(1)
        order = np.lexsort((least[at], -exact))[:k]  # a vector's least id stands for it
        at, exact = at[order], exact[order]
        found = sorted((-s, int(v)) for s, j in zip(exact.tolist(), at) for v in ids[j])[:k]
        out[0].extend([int(reps[i])] * len(found))
        out[1].extend(v for _, v in found)
        out[2].extend(-s for s, _ in found)
    return out


def _scored(k: int, probed: bool):
    def run(_key, base: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"rep": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if not len(base) or not len(asked):
            return none
        x, q = (np.stack(d["vec"].to_numpy()).astype(np.float64) for d in (base, asked))
        reps, ids = asked["rep"].to_numpy(), list(base["ids"])
        codes, back = np.unique(base["code"].to_numpy(), return_inverse=True)
        found: tuple[list, list, list] = ([], [], [])
        for at in range(0, len(q), 128):  # bounds the matrix of scores
            part = slice(at, at + 128)
            allowed = np.ones((len(q[part]), len(x)), bool)
            if probed:
                allowed = np.stack([np.isin(codes, c) for c in asked["codes"][part]])[:, back]
            for column, more in zip(found, best(reps[part], q[part], allowed, ids, x, k)):
                column.extend(more)
        return pd.DataFrame(dict(zip(("rep", "vec_id", "score"), found))).astype({"rep": "int64", "vec_id": "int64", "score": "float64"}) if found[0] else none
    return run


def _finds(index: DataFrame, asked: DataFrame, k: int, probed: bool) -> DataFrame:
    """``rep, vec_id, score``: the k best of each chunk that a query visits.

    A query visits its pages in every band.  Both sides are dealt by (table, band, page, chunk, block);
    the numbers of chunks come from one count a page (at most a few hundred rows a band, one for each
    pair of coordinates in use)."""
    keys = ["table", "band", "page"]
    pages = materialize(index.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks")), "pages")
    blocks = max(1, -(-asked.select("rep").distinct().count() // BLOCK))
    base = index.join(small(pages, 100_000), keys) \
        .withColumn("chunk", F.pmod(F.xxhash64("ids"), F.col("chunks")).cast("int")).drop("chunks") \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.join(small(pages, 100_000), ["table", "page"]) \
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks") \
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int"))
    by = [*keys, "chunk", "block"]
    return base.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(_scored(k, probed), "rep long, vec_id long, score double")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best different ids of each query."""
    order = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    return found.groupBy("rep", "vec_id").agg(F.max("score").alias("score")).withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, vec`` of the rows that take part, one an id."""
    kept = dict(vectors.dtypes)[vec_col] in ("array<float>", "array<double>")
    vec = F.col(vec_col) if kept else F.col(vec_col).cast("array<double>")
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).where("vec_id IS NOT NULL AND size(vec) > 0")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.where(finite & F.exists("vec", lambda x: x != 0)).groupBy("vec_id").agg(F.min("vec").alias("vec"))


def neighbours(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", probes: int = PROBES, seed: int = 1) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row for which ``is_query`` (a column of ``vec_id``) holds,
    the k rows of largest inner product, itself left out."""
    rows = materialize(usable(vectors, id_col, vec_col), "vectors")
    kind = dict(rows.dtypes)["vec"]
    most = F.array_max(F.transform("vec", lambda x: F.abs(x.cast("double"))))
    # logarithms of lengths, as squares of doubles may overflow
    length = F.log(most) + F.log(F.aggregate("vec", F.lit(0.0), lambda s, x: s + F.pow(x.cast("double") / F.col("most"), 2))) / 2
    stats = rows.withColumn("most", most).groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("length")) \
        .orderBy(F.desc("n"), "dim").limit(1).collect()
    dim, top = (stats[0].dim, stats[0].length) if stats else (1, 0.0)
    rows = rows.where(F.size("vec") == dim)
    h = Hashes(dim, seed)
    least = Window.partitionBy("vec").orderBy("vec_id")
    classes = rows.withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1).groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = classes.withColumn("most", most).withColumn("length", length)
    classes = materialize(classes.withColumn("band", F.floor((F.lit(top) - F.col("length")) / float(np.log(RATIO)) + 1e-9).cast("int")).drop("most"), "classes")
    # one row a band; all norms that doubles hold make some thousand bands
    bands = classes.groupBy("band").agg(F.max("length").alias("length")).collect()
    scales = {b.band: float(np.exp(b.length)) * (1 + 1e-9) for b in bands}
    index = materialize(classes.select("ids", "vec", "band").mapInArrow(_index(h, scales), f"table int, band int, page int, code long, ids array<long>, vec {kind}"), "index")
    asked = rows.where(is_query)
    queries = materialize(asked.groupBy("vec").agg(F.min("vec_id").alias("rep")), "queries")
    visits = queries.mapInArrow(_visits(h, probes), f"table int, page int, codes array<long>, rep long, vec {kind}")
    found = materialize(_top(_finds(index, visits, k + 1, True), k + 1), "found")
    short = queries.join(found.groupBy("rep").count(), "rep", "left").where(F.coalesce("count", F.lit(0)) < k + 1).select("rep", "vec")
    short = materialize(short, "short")
    if not short.isEmpty():
        pages = index.where("table = 0").select("table", "page").distinct()
        every = short.withColumn("page", F.explode(F.array(*(F.lit(r.page) for r in pages.collect())))).withColumn("table", F.lit(0)).withColumn("codes", F.array().cast("array<long>"))
        rest = _finds(index.where("table = 0"), every.select("table", "page", "codes", "rep", "vec"), k + 1, False)
        found = _top(found.union(rest), k + 1)
    owner = materialize(asked.join(queries, "vec").select(F.col("vec_id").alias("query_id"), "rep"), "owners")
    lists = owner.join(found, "rep").where("vec_id != query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
