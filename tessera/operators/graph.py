"""Graph ranking over edge tables: PageRank and personalised PageRank.

A graph is ``edges(src, dst)`` (directed, repeated edges kept) plus an optional ``vertices(id)`` frame for
isolated vertices.  Ranks are sums of *waves*: the first wave is the reset mass, and each step sends the last
wave along the out-edges, ``x'(v) = (1 - reset) * sum(x(u) / outdeg(u))``.  Only vertices whose last wave
exceeds the tolerance send (any positive wave in runs of a fixed length), so a converging run sends less and
less, and a personalised run touches only what the source has reached so far; the others aren't in its state.

A step is one join and one aggregate.  The state ``id, x, acc`` (last wave, sum of all) is joined with the
persisted lists of out-edges, a row for thousands of edges, which are unfolded after the join; a row of each vertex to itself carries ``acc`` over.  Waves are summed per ``dst`` with partial aggregation before
the shuffle.  Every few steps the state is written as a table under the shared checkpoint folder, which cuts
the lineage and survives executor loss.  The driver sees one number a job (the largest wave).
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.session import materialize, scratch_path

RESET = 0.15
# Steps chained into one job between table writes.
STEPS_PER_JOB = 5
# Out-edges of one vertex per salt (see _weighted_edges).
EDGE_CHUNK = 1 << 20
# Out-edges of one vertex in a row of the kept table, about.
LIST_EDGES = 1 << 12


def parse_users(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(users, rejects)`` of ``id,handle[,...]`` lines: ``id bigint, handle string``, and the lines
    without an integer id or without a handle (null lines among them)."""
    f = F.split(F.col(value), ",", -1)
    staged = lines.select(F.col(value), F.get(f, 0).try_cast("bigint").alias("id"), F.get(f, 1).alias("handle"))
    good = F.col("id").isNotNull() & F.col("handle").isNotNull()
    return staged.where(good).select("id", "handle"), staged.where(~good).select(value)


def bipartite_edges(relation: DataFrame, a: str = "user", b: str = "item") -> DataFrame:
    """Both directions of every (a, b) pair, from one scan (explode, not a union)."""
    return relation.select(F.explode(F.array(
        F.struct(F.col(a).alias("src"), F.col(b).alias("dst")),
        F.struct(F.col(b).alias("src"), F.col(a).alias("dst")))).alias("_e")).select("_e.src", "_e.dst")


def graph_vertices(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """``id, degree``: edge endpoints plus any given (isolated) vertices, and their numbers of out-edges."""
    v = edges.select(F.explode(F.array(F.struct(F.col("src").alias("id"), F.lit(1).alias("out")),
                                       F.struct(F.col("dst").alias("id"), F.lit(0).alias("out")))).alias("_e")).select("_e.id", "_e.out")
    if vertices is not None:
        v = v.unionByName(vertices.select(F.col("id").cast(edges.schema["src"].dataType), F.lit(0).alias("out")))
    return v.groupBy("id").agg(F.sum("out").alias("degree"))


def _weighted_edges(edges: DataFrame, verts: DataFrame, largest: int, edge_chunk: int = EDGE_CHUNK) -> tuple[DataFrame, DataFrame | None]:
    """``(lists, hot)``: ``src, dsts, w, _salt`` kept for the loop, and ``src, _nc`` of the vertices with several
    salts (None if there are none; ``largest`` is the largest degree).

    ``w = 1/outdeg(src)``, ``dsts`` holds about ``LIST_EDGES`` out-edges at most, and each vertex has a row to itself of weight 0 and salt -1.  The table is partitioned
    and sorted on ``src``, as the waves are, so a step moves only them.  If a vertex has more than ``edge_chunk``
    out-edges, those are spread over ``ceil(outdeg / edge_chunk)`` salts and the table is partitioned on (src, salt):
    no task holds more than about ``edge_chunk`` edges of one vertex.
    """
    n = max(1, int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    nc = F.ceil(F.col("degree") / F.lit(edge_chunk)).cast("int")
    deg = verts.where("degree > 0").select(F.col("id").alias("src"), "degree")
    # Any salt in [0, nc) is correct (every salt of a vertex gets its wave) and any list of it, so
    # seeded random draws are fine even if a lost partition recomputes them.
    pieces = F.ceil(F.least("degree", F.lit(edge_chunk)) / F.lit(LIST_EDGES))
    weighted = edges.join(deg, "src").select("src", "dst", (F.lit(1.0) / F.col("degree")).alias("w"), F.floor(F.rand(17) * nc).cast("int").alias("_salt"),
                                             F.floor(F.rand(18) * pieces).cast("int").alias("_piece"))
    own = verts.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0.0).alias("w"), F.lit(-1).alias("_salt"), F.lit(0).alias("_piece"))
    keys = ["src", "_salt"] if largest > edge_chunk else ["src"]
    # collect_list leaves nulls out, but a null end takes its share like any other
    nulls = F.array_repeat(F.lit(None).cast(edges.schema["dst"].dataType), F.count_if(F.col("dst").isNull()).cast("int"))
    lists = weighted.unionByName(own).repartition(n, *keys).groupBy("src", "_salt", "_piece").agg(F.concat(F.collect_list("dst"), nulls).alias("dsts"), F.first("w").alias("w"))
    we = lists.drop("_piece").sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK)
    return we, deg.select("src", nc.alias("_nc")).where("_nc > 1") if len(keys) > 1 else None


def _step(state: DataFrame, we: DataFrame, hot: DataFrame | None, tol: float, reset: float, sent: Observation | None) -> DataFrame:
    """The next wave and the new sums; the state appears once in the plan."""
    s = state.withColumnRenamed("id", "src")
    if hot is None:
        moved = s.join(we, "src").where(f"_salt < 0 OR x > {tol!r}D")
    else:  # hot: at most edges / edge_chunk rows
        salts = f"explode(sequence(-1, IF(x > {tol!r}D, coalesce(_nc - 1, 0), -1))) AS _salt"
        moved = s.join(hot, "src", "left").selectExpr("src", "x", "acc", salts).join(we, ["src", "_salt"])
    if sent is not None:
        moved = moved.observe(sent, F.expr("sum(IF(_salt >= 0, size(dsts), 0)) AS sent"))
    moved = moved.selectExpr("x * w AS x", "IF(_salt < 0, acc, NULL) AS acc", "explode(dsts) AS dst")
    waves = moved.groupBy("dst").agg(F.expr(f"{1.0 - reset!r}D * sum(x) AS x"), F.expr("max(acc) AS old"))
    return waves.selectExpr("dst AS id", "x", "coalesce(old, 0D) + x AS acc")


def _run(edges: DataFrame, vertices: DataFrame | None, source, tol: float | None, iterations: int | None, reset: float,
         edge_chunk: int = EDGE_CHUNK, trace: list | None = None) -> DataFrame:
    spark = edges.sparkSession
    # Degrees, weighted edges and the vertex set all read the edge list: write it once.
    edges = materialize(edges.select("src", "dst"), "edges")
    most = Observation(f"degree-{uuid.uuid4().hex[:8]}")
    verts = materialize(graph_vertices(edges, vertices).observe(most, F.max("degree").alias("degree")), "vertices")
    we, hot = _weighted_edges(edges, verts, most.get.get("degree") or 0, edge_chunk)
    if source is None:
        state = verts.select("id", F.lit(reset).alias("x"), F.lit(reset).alias("acc"))
    else:
        state = verts.where(F.col("id") == F.lit(source)).select("id", F.lit(1.0).alias("x"), F.lit(1.0).alias("acc"))
    least = tol if tol is not None else 0.0
    base = scratch_path(spark, "ranks")
    step = jobs = 0
    while iterations is None or step < iterations:
        # Fixed runs chain STEPS_PER_JOB steps a job; converging ones start with 1 and double, so a graph
        # that settles in a few steps wastes none.
        todo = min(STEPS_PER_JOB, 1 << jobs) if iterations is None else min(STEPS_PER_JOB, iterations - step)
        jobs += 1
        used = [Observation(f"sent-{uuid.uuid4().hex[:8]}") if trace is not None else None for _ in range(todo)]
        for sent in used:
            state = _step(state, we, hot, least, reset, sent)
        # One job per batch of steps; the last wave is observed during the write.
        wave = Observation(f"wave-{uuid.uuid4().hex[:8]}")
        state = state.observe(wave, F.expr("max(x) AS largest"))
        path = f"{base}/it={step + todo}"
        state.write.parquet(path)
        state = spark.read.schema(state.schema).parquet(path)
        step += todo
        if trace is not None:
            trace += [sent.get.get("sent") or 0 for sent in used]
        if step != iterations and (wave.get.get("largest") or 0.0) <= least:
            break
    we.unpersist()
    if source is None:
        ranks, scale = state.select("id", F.col("acc").alias("rank")), state.agg(F.count(F.lit(1))).scalar()
    else:
        # after a fixed number of steps the last wave still has its reset share, the ones before kept theirs
        rank = F.col("acc") if tol is not None else F.lit(reset) * (F.col("acc") - F.col("x")) + F.col("x")
        ranks = verts.join(state.select("id", rank.alias("rank")), "id", "left").select("id", F.coalesce("rank", F.lit(0.0)).alias("rank"))
        scale = F.lit(1.0)
    total = ranks.agg(F.sum("rank")).scalar()
    return ranks.select("id", F.coalesce(F.try_divide(F.col("rank") * scale, total), F.lit(0.0)).alias("rank"))


def pagerank(edges: DataFrame, tol: float = 1e-4, vertices: DataFrame | None = None,
             reset: float = RESET, max_iterations: int | None = None, edge_chunk: int = EDGE_CHUNK, trace: list | None = None) -> DataFrame:
    """``id, rank``: rank = reset + (1 - reset) * sum(rank(src) / outdeg(src)), to tolerance.

    A vertex passes on what its rank gained in a step only if that is more than ``tol``; when no vertex has
    more, the ranks are scaled to sum to the vertex count (mass lost at sinks is restored proportionally).
    ``trace`` takes the number of edges that each step sends on.
    """
    return _run(edges, vertices, None, tol, max_iterations, reset, edge_chunk, trace)


def personalized_pagerank(edges: DataFrame, source, iterations: int | None = 20, tol: float | None = None,
                          vertices: DataFrame | None = None, reset: float = RESET,
                          edge_chunk: int = EDGE_CHUNK, trace: list | None = None) -> DataFrame:
    """``id, rank`` personalised to ``source``: reset mass returns to the source only.

    Starts at 1 on the source and 0 elsewhere; runs ``iterations`` steps, or until no vertex gains more than
    ``tol`` when ``tol`` is given.  Ranks sum to 1 (all 0 if the source is no vertex).
    """
    if tol is not None:
        iterations = None
    return _run(edges, vertices, source, tol, iterations, reset, edge_chunk, trace)


def split_ranks(ranks: DataFrame, is_item) -> tuple[DataFrame, DataFrame]:
    """``(items, users)`` each ordered by rank descending (ties by id)."""
    items = ranks.where(is_item).orderBy(F.col("rank").desc(), F.col("id"))
    users = ranks.where(~is_item).orderBy(F.col("rank").desc(), F.col("id"))
    return items, users
