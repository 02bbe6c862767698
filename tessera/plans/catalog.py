"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query binds the driver's tables to an operator input (``tessera.sources.tables``)
and runs the operator over the whole input.  Doubles are rounded to 6 places
so the DuckDB oracles in ``tessera.plans.oracles`` compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import text_lines
from tessera.operators import common as C
from tessera.operators import evaluate as EV
from tessera.operators import fit as FT
from tessera.operators import graph as G
from tessera.operators import logs as L
from tessera.operators import pruned as PN
from tessera.operators import ratings as RT
from tessera.operators import recommend as RC
from tessera.operators import similarity as S
from tessera.operators import text as T
from tessera.plans.recommender import run_recommender
from tessera.session import SMALL_TASKS, materialize, scratch_path, written
from tessera.sinks import files as FS
from tessera.sinks import merge_table as MT
from tessera.sinks import upsert as U
from tessera.sources import tables as B
from tessera.sources import views as VW
from tessera.sources.text import parse_edges
from tessera.streaming import batches as SB
from tessera.streaming import manifest_sink as MS
from tessera.streaming import sources as SS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def r6(c):
    return F.round(c.cast("double") if not isinstance(c, str) else F.col(c).cast("double"), 6)


# --- text -----------------------------------------------------------------

@query
def q_read_lines(spark, sf):
    return B.doc_lines(spark, sf).select("doc_id", F.col("line_no").cast("bigint").alias("line_no"),
                                         "value")


@query
def q_tokens(spark, sf):
    return T.tokens(B.doc_lines(spark, sf), keep=("doc_id", "line_no")).select(
        "doc_id", F.col("line_no").cast("bigint").alias("line_no"),
        F.col("pos").cast("bigint").alias("pos"), "word")


@query
def q_word_count(spark, sf):
    return T.word_count(B.doc_lines(spark, sf))


# --- logs -----------------------------------------------------------------


_LOG_COLS = ("event_id", "ts", "level", "app", "message")


def _tab_logs(spark, sf):
    logs, _ = L.parse_tab_logs(B.log_lines_tab(spark, sf))
    return logs


@query
def q_parse_tab_logs(spark, sf):
    return _tab_logs(spark, sf).select(*_LOG_COLS)


@query
def q_tab_log_rejects(spark, sf):
    _, rejects = L.parse_tab_logs(B.damaged_log_lines(spark, sf))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def q_log_errors(spark, sf):
    return L.errors(_tab_logs(spark, sf)).select(*_LOG_COLS)


@query
def q_log_error_count(spark, sf):
    return L.error_count(_tab_logs(spark, sf))


@query
def q_log_app_errors(spark, sf):
    return L.errors_of(_tab_logs(spark, sf), "MySQL", 10, order_by=("ts", "event_id")).select(*_LOG_COLS)


@query
def q_log_errors_by_app(spark, sf):
    return L.errors_by_app(_tab_logs(spark, sf))


def _fmt_time(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@query
def q_parse_log_lines(spark, sf):
    return L.parse_log_lines(B.log_lines_space(spark, sf)).select(
        "event_id", _fmt_time(F.col("time")).alias("time"), "level")


@query
def q_errors_per_minute(spark, sf):
    epm = L.errors_per_minute(L.parse_log_lines(B.log_lines_space(spark, sf)))
    return epm.select(_fmt_time(F.col("log_time")).alias("log_time"), "log_count")


# --- ratings, similarity, recommendation, evaluation ------------------------


SPLIT_SEED = 913
NUM_NEIGHBOURS = 50
NUM_RECS = 30


def _rated(spark, sf):
    # Materialised once: the split, similarity and recommendation branches all read it.
    return materialize(RT.with_user_id(B.event_ratings(spark, sf)), "rated")


def _split(spark, sf):
    return RT.train_test_split(_rated(spark, sf), SPLIT_SEED)


def _train(spark, sf):
    return _split(spark, sf)[0]


def _sim(spark, sf, method):
    return S.similarity(_train(spark, sf), method).select(
        F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), r6("sim").alias("sim"))


def _nb(spark, sf, method="cosine", train=None):
    train = train if train is not None else _train(spark, sf)
    return materialize(S.top_neighbours(S.similarity(train, method), NUM_NEIGHBOURS), "neighbours")


def _recs(spark, sf, how, train=None):
    train = train if train is not None else _train(spark, sf)
    nb = _nb(spark, sf, train=train)
    if how == "score":
        return RC.recommend_score(nb, train, NUM_RECS)
    return RC.recommend_weighted_sum(nb, train, NUM_RECS)


def _rec_out(recs):
    return recs.select(F.col("user_id").cast("bigint").alias("user_id"), F.col("rank").cast("bigint").alias("rank"),
                       F.col("item").cast("bigint").alias("item"), r6("score").alias("score"))


@query
def q_parse_ratings(spark, sf):
    return RT.parse_ratings(B.rating_lines(spark, sf)).select(
        "user", F.col("item").cast("bigint").alias("item"), F.col("clicks").cast("bigint").alias("clicks"))


@query
def q_rating_stats(spark, sf):
    return RT.rating_stats(B.event_ratings(spark, sf))


@query
def q_user_ids(spark, sf):
    return RT.user_ids(B.event_ratings(spark, sf)).select("user", F.col("user_id").cast("bigint").alias("user_id"))


@query
def q_user_id_join(spark, sf):
    return _rated(spark, sf).select("user", F.col("user_id").cast("bigint").alias("user_id"),
                                    F.col("item").cast("bigint").alias("item"), r6("rating").alias("rating"))


@query
def q_train_test_split(spark, sf):
    train, test = _split(spark, sf)
    cols = ["user", F.col("item").cast("bigint").alias("item"), r6("rating").alias("rating")]
    return (train.select(*cols, F.lit("train").alias("part"))
            .unionByName(test.select(*cols, F.lit("test").alias("part"))))


@query
def q_zscore_by_user(spark, sf):
    z = C.zscore(B.event_ratings(spark, sf), "user", "rating", "z")
    return z.select("user", F.col("item").cast("bigint").alias("item"), r6("z").alias("z"))


@query
def q_minmax_by_user(spark, sf):
    m = C.minmax(B.event_ratings(spark, sf), "user", "rating", "scaled")
    return m.select("user", F.col("item").cast("bigint").alias("item"), r6("scaled").alias("scaled"))


@query
def q_lp_scale_by_user(spark, sf):
    m = C.lp_scale(B.event_ratings(spark, sf), "user", "rating", 2.0, "scaled")
    return m.select("user", F.col("item").cast("bigint").alias("item"), r6("scaled").alias("scaled"))


@query
def q_item_stats(spark, sf):
    s = S.item_stats(_train(spark, sf))
    return s.select(F.col("item").cast("bigint").alias("item"), r6("ss").alias("ss"), "cnt")


@query
def q_item_pairs(spark, sf):
    p = S.pair_stats(_train(spark, sf))
    return p.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"),
                    r6("dot").alias("dot"), "co")


for _m in S.METHODS:
    if _m == "spark-appr":  # below, over ratings that it samples
        continue

    def _mk(m):
        def fn(spark, sf):
            return _sim(spark, sf, m)
        fn.__name__ = "q_sim_" + m.replace("-", "_")
        return fn
    query(_mk(_m))


def _upper(sim):
    return sim.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), r6("sim").alias("sim"))


def _quantities(spark, sf):
    return written(B.quantity_ratings(spark, sf), "quantities", conf=SMALL_TASKS)


@query
def q_sim_spark_appr(spark, sf):
    """Sampled cosine between suppliers over the pieces customers ordered; every column is over the bound."""
    return _upper(S.similarity(_quantities(spark, sf), "spark-appr"))


@query
def q_sim_spark_quantities(spark, sf):
    """The exact cosines that ``sim_spark_appr`` estimates."""
    return _upper(S.similarity(_quantities(spark, sf), "spark"))


@query
def q_sim_spark_appr_events(spark, sf):
    """Sampled cosine of the training ratings (light columns: exact until they pass the bound)."""
    return _upper(S.similarity(_train(spark, sf), "spark-appr"))


@query
def q_top_neighbours(spark, sf):
    nb = _nb(spark, sf)
    return nb.select(F.col("item").cast("bigint").alias("item"), F.col("neighbour").cast("bigint").alias("neighbour"),
                     r6("weight").alias("weight"), F.col("rank").cast("bigint").alias("rank"))


@query
def q_top_neighbours_pruned(spark, sf):
    """The lists of ``top_neighbours`` by the search that skips pairs."""
    nb = PN.top_neighbours_pruned(_train(spark, sf), NUM_NEIGHBOURS)
    return nb.select(F.col("item").cast("bigint").alias("item"), F.col("neighbour").cast("bigint").alias("neighbour"),
                     r6("weight").alias("weight"), F.col("rank").cast("bigint").alias("rank"))


@query
def q_rec_candidates(spark, sf):
    c = RC.candidates(_nb(spark, sf), _train(spark, sf))
    return c.select(F.col("user_id").cast("bigint").alias("user_id"), F.col("item").cast("bigint").alias("item"),
                    F.col("neighbour").cast("bigint").alias("neighbour"), r6("weight").alias("weight"))


@query
def q_candidates_unseen(spark, sf):
    train, nb = _train(spark, sf), _nb(spark, sf)
    c = reduce(DataFrame.unionByName, RC.unseen(nb, train))
    return c.select(F.col("user_id").cast("bigint").alias("user_id"), F.col("item").cast("bigint").alias("item"),
                    F.col("neighbour").cast("bigint").alias("neighbour"), r6("weight").alias("weight"))


@query
def q_rec_users(spark, sf):
    return RC.rec_users(_nb(spark, sf), _train(spark, sf)).select(F.col("user_id").cast("bigint").alias("user_id"))


@query
def q_rec_score(spark, sf):
    return _rec_out(_recs(spark, sf, "score")[1])


@query
def q_rec_weighted_sum(spark, sf):
    return _rec_out(_recs(spark, sf, "weighted-sum")[1])


def _metric_cols(df):
    return df.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query
def q_eval_precision(spark, sf):
    train, test = _split(spark, sf)
    users, recs = _recs(spark, sf, "weighted-sum", train=train)
    return _metric_cols(EV.precision_recall(test, users, recs))


@query
def q_eval_coverage(spark, sf):
    train = _train(spark, sf)
    users, recs = _recs(spark, sf, "weighted-sum", train=train)
    return _metric_cols(EV.coverage(train, recs))


@query
def q_eval_popularity(spark, sf):
    train = _train(spark, sf)
    users, recs = _recs(spark, sf, "weighted-sum", train=train)
    return _metric_cols(EV.popularity(train, recs))


@query
def q_matrix_mae(spark, sf):
    train = _train(spark, sf)
    return _metric_cols(EV.matrix_mae(S.similarity(train, "cosine"), S.similarity(train, "cosine-mod")))


# --- graph ----------------------------------------------------------------


CONVERGED_TOL = 1e-10
#: The usual tolerance: gains up to it aren't passed on.
USUAL_TOL = 1e-4
PPR_ITERATIONS = 20


def _bip_edges(spark, sf):
    return G.bipartite_edges(B.bipartite_relation(spark, sf))


def _ppr_source(spark, sf):
    """The first user's vertex (lowest user id), read from the data."""
    return -(B.table(spark, sf, "events").agg(F.min("user_id")).first()[0] + 1)


def _ranks_out(r):
    return r.select(F.col("id").cast("bigint").alias("id"), r6("rank").alias("rank"))


@query
def q_bipartite_edges(spark, sf):
    return _bip_edges(spark, sf)


@query
def q_edge_list(spark, sf):
    lines = B.order_edges(spark, sf).select(F.concat_ws(" ", "src", "dst").alias("value"))
    return parse_edges(lines)[0]


@query
def q_parse_users(spark, sf):
    c = B.table(spark, sf, "customer")
    lines = c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment").alias("value"))
    return G.parse_users(lines)[0]


@query
def q_pagerank(spark, sf):
    return _ranks_out(G.pagerank(_bip_edges(spark, sf), tol=CONVERGED_TOL))


@query
def q_next_item_edges(spark, sf):
    return B.next_item_edges(spark, sf)


@query
def q_pagerank_next_item(spark, sf):
    return _ranks_out(G.pagerank(B.next_item_edges(spark, sf), tol=CONVERGED_TOL))


@query
def q_pagerank_sinks(spark, sf):
    return _ranks_out(G.pagerank(B.order_edges(spark, sf), tol=CONVERGED_TOL))


@query
def q_pagerank_named(spark, sf):
    c = B.table(spark, sf, "customer")
    users = G.parse_users(c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("value")))[0]
    ranks = G.pagerank(B.order_edges(spark, sf), tol=CONVERGED_TOL)
    return users.join(ranks, "id").select("handle", r6("rank").alias("rank"))


@query
def q_ppr_static(spark, sf):
    return _ranks_out(G.personalized_pagerank(_bip_edges(spark, sf), _ppr_source(spark, sf), PPR_ITERATIONS))


@query
def q_ppr_converged(spark, sf):
    return _ranks_out(G.personalized_pagerank(_bip_edges(spark, sf), _ppr_source(spark, sf), tol=CONVERGED_TOL))


@query
def q_pagerank_tolerance(spark, sf):
    return _ranks_out(G.pagerank(B.next_item_edges(spark, sf), tol=USUAL_TOL))


@query
def q_ppr_tolerance(spark, sf):
    return _ranks_out(G.personalized_pagerank(_bip_edges(spark, sf), _ppr_source(spark, sf), tol=USUAL_TOL))


@query
def q_ppr_split(spark, sf):
    """Items and users apart, each with the place that ``split_ranks`` gives it."""
    ranks = G.personalized_pagerank(_bip_edges(spark, sf), _ppr_source(spark, sf), PPR_ITERATIONS)
    ranks = materialize(ranks.select("id", F.round("rank", 9).alias("rank")), "ppr")
    sides = [C.dense_number(side.withColumn("_neg", -F.col("rank")), ["_neg", "id"], (), "pos").withColumn("side", F.lit(name))
             for side, name in zip(G.split_ranks(ranks, F.col("id") >= 0), ("item", "user"))]
    return sides[0].unionByName(sides[1]).select("side", "id", (F.col("pos") + 1).cast("bigint").alias("pos"), r6("rank").alias("rank"))


@query
def q_pagerank_ascending(spark, sf):
    """The lowest-ranked customers first, with their names."""
    c = B.table(spark, sf, "customer")
    users = G.parse_users(c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("value")))[0]
    ranks = G.pagerank(B.order_edges(spark, sf), tol=USUAL_TOL).withColumn("rank", F.round("rank", 9))
    placed = C.dense_number(users.join(ranks, "id"), ["rank", "id"], (), "pos")
    return placed.select("handle", r6("rank").alias("rank"), (F.col("pos") + 1).cast("bigint").alias("pos"))


@query
def q_ppr_items(spark, sf):
    ranks = G.personalized_pagerank(_bip_edges(spark, sf), _ppr_source(spark, sf), PPR_ITERATIONS)
    items = ranks.where(F.col("id") >= 0).withColumn("_neg", -F.round("rank", 9))
    ordered = C.dense_number(items, ["_neg", "id"], (), "pos")
    return ordered.select(F.col("id").cast("bigint").alias("id"), r6("rank").alias("rank"),
                          (F.col("pos") + 1).cast("bigint").alias("pos"))


# --- iterative fitting ------------------------------------------------------


KMEANS_K = 5
KMEANS_CONVERGE = 1e-12
LR_DIMS = 64
LR_ITERATIONS = 3


def _vector_lines(spark, sf, with_label=False):
    e = B.table(spark, sf, "embeddings")
    nums = F.transform(F.col("embedding").cast("array<double>"), lambda v: F.format_string("%.9f", v))
    parts = [F.when(F.pmod("label", F.lit(2)) == 0, F.lit("1.0")).otherwise(F.lit("-1.0"))] if with_label else []
    return e.select(F.col("vec_id").alias("id"), F.concat_ws(" ", *parts, F.array_join(nums, " ")).alias("value"))


@query
def q_parse_vectors(spark, sf):
    v = FT.parse_vectors(_vector_lines(spark, sf))
    return v.select("id", F.posexplode("x").alias("pos", "x")).select(
        "id", F.col("pos").cast("bigint").alias("pos"), r6("x").alias("x"))


@query
def q_parse_points(spark, sf):
    p = FT.parse_points(_vector_lines(spark, sf, True), LR_DIMS)
    return p.select("id", "y", F.posexplode("x").alias("pos", "x")).select(
        "id", r6("y").alias("y"), F.col("pos").cast("bigint").alias("pos"), r6("x").alias("x"))


@query
def q_sample_k(spark, sf):
    return FT.sample_k(B.vectors(spark, sf), KMEANS_K).select("id")


def _kmeans_out(df):
    return df.select("id", F.col("cluster").cast("bigint").alias("cluster"), r6("dist").alias("dist"))


@query
def q_kmeans_assign(spark, sf):
    pts = B.vectors(spark, sf)
    centers = [list(r["x"]) for r in FT.sample_k(pts, KMEANS_K).collect()]
    return _kmeans_out(FT.assign(pts, centers))


@query
def q_kmeans_steps(spark, sf):
    _, assigned = FT.kmeans(B.vectors(spark, sf), KMEANS_K, KMEANS_CONVERGE)
    return _kmeans_out(assigned)


@query
def q_logistic_steps(spark, sf):
    w = FT.logistic_gd(B.labelled_points(spark, sf), LR_DIMS, LR_ITERATIONS)
    return w.select(F.col("pos").cast("bigint").alias("pos"), r6("weight").alias("weight"))


# --- sources and sinks: JDBC, ranges, files, upserts ------------------------


_SUP_COLS = ("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
Q1_NATION = 7


def _supplier_rows(spark, sf):
    return B.table(spark, sf, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", F.col("s_acctbal").cast("decimal(12,2)").alias("s_acctbal"))


def _sup_out(df):
    return df.select("s_suppkey", "s_name", F.col("s_nationkey").cast("int").alias("s_nationkey"),
                     r6("s_acctbal").alias("s_acctbal"))


def _supplier_updates(spark, sf):
    c = B.table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name"),
        F.col("c_nationkey").alias("s_nationkey"), F.col("c_acctbal").cast("decimal(12,2)").alias("s_acctbal"))


@query
def q_upsert_table(spark, sf):
    return _sup_out(U.upsert(_supplier_rows(spark, sf), _supplier_updates(spark, sf), ["s_suppkey"]))


@query
def q_merge_table(spark, sf):
    """The updates of ``upsert_table`` merged into the suppliers as a stored table."""
    target = _supplier_rows(spark, sf)
    table = MT.MergeTable(spark, scratch_path(spark, "supplier-table"), target.schema, ["s_suppkey"])
    table.merge(target)
    table.merge(_supplier_updates(spark, sf))
    return _sup_out(table.read())


@query
def q_sql_count_avg(spark, sf):
    """Count and average in SQL over a stored table's view; the balance is a decimal."""
    VW.register_table(spark, "supplier_view", f"{sf}/supplier.parquet")
    out = spark.sql(f"SELECT count(*) AS n, avg(CAST(s_acctbal AS DECIMAL(12, 2))) AS mean FROM supplier_view WHERE s_nationkey = {Q1_NATION}")
    return out.select("n", r6("mean").alias("mean"), F.typeof("mean").alias("kind"))


@query
def q_sql_view_groups(spark, sf):
    """Grouped SQL over two stored tables' views."""
    for name in ("orders", "customer"):
        VW.register_table(spark, f"{name}_view", f"{sf}/{name}.parquet")
    return spark.sql("SELECT c_mktsegment, count(*) AS n, round(avg(CAST(o_totalprice AS DECIMAL(15, 2))), 2) AS mean "
                     "FROM orders_view JOIN customer_view ON o_custkey = c_custkey GROUP BY c_mktsegment").select("c_mktsegment", "n", r6("mean").alias("mean"))


@query
def q_sql_frame_view(spark, sf):
    """A DataFrame (the parsed ratings) as a view."""
    VW.register_frame(RT.parse_ratings(B.rating_lines(spark, sf)), "ratings_view")
    return spark.sql("SELECT CAST(item AS BIGINT) AS item, count(*) AS n, round(avg(clicks), 6) AS mean FROM ratings_view GROUP BY item")


def _hourly(spark, sf, kind):
    ev = B.table(spark, sf, "events")
    return (ev.where(kind)
            .groupBy(F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("log_time"))
            .agg(F.count(F.lit(1)).alias("log_count")))


@query
def q_upsert_add(spark, sf):
    return U.upsert_add(_hourly(spark, sf, F.col("event_type") == "error"), _hourly(spark, sf, ~F.col("event_type").eqNullSafe("error")), "log_time", "log_count")


@query
def q_write_tsv_roundtrip(spark, sf):
    nb = _nb(spark, sf)
    path = scratch_path(spark, "item_similarities")
    FS.write_tsv(nb.select("item", "neighbour", "weight"), path)
    back = FS.read_tsv(spark, path, "item bigint, neighbour bigint, weight double")
    return back.select("item", "neighbour", r6("weight").alias("weight"))


# --- streaming --------------------------------------------------------------


#: Micro-batches of a replayed table; a batch grows with its table.
BATCHES = 8


def _doc_line_files(spark, sf):
    """Document lines as text files, one folder (and file) per micro-batch.

    Documents are dealt to batches by ``doc_id mod B`` rather than by their
    ``source`` column: a source may hold a third of all documents, and one
    file per source would be written by one task.
    """
    path = scratch_path(spark, "doc-lines")
    docs = B.table(spark, sf, "documents").select("doc_id", "text")
    lines = docs.select(F.pmod("doc_id", F.lit(BATCHES)).alias("batch"), F.explode(text_lines("text")).alias("value"))
    lines.repartition("batch").write.partitionBy("batch").text(path)
    return path


def _record_files(spark, sf):
    """Kafka-shaped records as parquet files, one folder per slice of events (one micro-batch each)."""
    path = scratch_path(spark, "records")
    end = B.table(spark, sf, "events").agg(F.max("event_id") + 1).first()[0] or 1
    recs = B.kafka_records(spark, sf).withColumn("slice", F.floor(F.col("event_id") * BATCHES / F.lit(end)))
    recs.repartition("slice").write.partitionBy("slice").parquet(path)
    SS.stamp_in_order(spark, path, "slice")
    return path


def _record_stream(spark, path):
    return spark.readStream.schema(SS.RECORD_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


@query
def q_stream_word_count(spark, sf):
    src, out = _doc_line_files(spark, sf), scratch_path(spark, "wc-out")
    stream = SS.stream_lines(spark, format="text", path=src, max_files_per_trigger=1).select("value")
    SB.stream_word_count(stream, out, scratch_path(spark, "wc-ckpt"), {"availableNow": True}).awaitTermination()
    res = spark.read.parquet(out)
    return res.groupBy("word").agg(F.count_distinct("batch_id").alias("n_batches"), F.sum("n").alias("n"))


@query
def q_stream_counts_with_offsets(spark, sf):
    src, out = _record_files(spark, sf), scratch_path(spark, "kc-out")
    SB.stream_counts_with_offsets(_record_stream(spark, src), out, scratch_path(spark, "kc-ckpt"),
                                  {"availableNow": True}).awaitTermination()
    return spark.read.parquet(f"{out}/ranges").select("topic", "partition", "from_offset", "until_offset",
                                                      "batch_words")


@query
def q_offset_ranges(spark, sf):
    return SB.offset_ranges(B.kafka_records(spark, sf))


@query
def q_ledger_start_offsets(spark, sf):
    ledger = SB.offset_ranges(B.kafka_records(spark, sf)).select(
        "topic", "partition", F.col("until_offset").alias("offset"))
    return SS.start_offsets_frame(ledger)


def _log_segments(spark, sf):
    """The events as segments of one log, each a file with a run of event ids (its offsets), as many as Spark
    writes tasks; a stream takes some of them a batch, in order."""
    path = scratch_path(spark, "segments")
    n = max(BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lines = B.log_lines_space(spark, sf).select(F.lit(B.KAFKA_TOPIC).alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
                                                F.lit(None).cast("string").alias("key"), "value")
    lines.repartitionByRange(n, "offset").write.parquet(path)
    files = SS.stamp_files(spark, path)
    return spark.readStream.schema(SS.RECORD_SCHEMA).option("maxFilesPerTrigger", max(1, files // BATCHES)).parquet(path)


def _exactly_once(spark, sf):
    table = MS.errors_table(spark, scratch_path(spark, "minute-errors"))
    MS.run_errors(_log_segments(spark, sf), table, scratch_path(spark, "segments-ckpt"), {"availableNow": True}, strict=False).awaitTermination()
    return table


@query
def q_exactly_once_errors(spark, sf):
    return _exactly_once(spark, sf).read().select(_fmt_time(F.col("log_time")).alias("log_time"), "log_count")


@query
def q_exactly_once_resume(spark, sf):
    """Where a new stream over the same log would start."""
    return SS.start_offsets_frame(MS.position_frame(_exactly_once(spark, sf)))


# --- recommender run and ALS ------------------------------------------------


@query
def q_recommender_run(spark, sf):
    m = run_recommender(B.rating_lines(spark, sf), "sim", "cosine", "weighted-sum", NUM_RECS,
                        output_path=scratch_path(spark, "recommender-out"))
    return _metric_cols(m)


#: Largest relative residual of a user's normal equations (the factors are 32-bit floats).
ALS_RESIDUAL = 1e-4


def _als_lists(spark, sf, direction):
    """A row for every trained user: what the served list holds, and whether the user's factors solve their equations."""
    train = _train(spark, sf)
    model = RC.fit_als(train)
    _, recs = RC.recommend_als(train, NUM_RECS, direction, model=model)
    known = train.select("item").distinct().withColumn("known", F.lit(1))
    per = recs.join(known, "item", "left").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_recs"), F.count_distinct("item").alias("n_items"), F.max("rank").cast("bigint").alias("last_rank"),
        F.count("known").alias("n_known"))
    solved = RC.als_residuals(model, train).select("user_id", (F.col("residual") < ALS_RESIDUAL).alias("solved"))
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_recs", "n_items", "last_rank", "n_known")]
    return (train.select("user_id").distinct().join(per, "user_id", "left").join(solved, "user_id", "left")
            .select(F.col("user_id").cast("bigint").alias("user_id"), *counts, F.coalesce("solved", F.lit(False)).alias("solved")))


@query
def q_rec_als_user(spark, sf):
    return _als_lists(spark, sf, "user-product")


@query
def q_rec_als_item(spark, sf):
    return _als_lists(spark, sf, "product-user")


@query
def q_recommender_run_als(spark, sf):
    """The whole run over ALS factors: what is counted, not scored, as factors differ in their last digits."""
    m = run_recommender(B.rating_lines(spark, sf), "als", None, "user-product", NUM_RECS, output_path=scratch_path(spark, "recommender-out"))
    return m.select(F.col("tp_fn").cast("bigint").alias("tp_fn"), F.col("tp_fp").cast("bigint").alias("tp_fp"),
                    ((F.col("precision") >= 0) & (F.col("precision") <= 1) & (F.col("recall") <= 1)).alias("in_range"))


@query
def q_recommender_run_score(spark, sf):
    return _metric_cols(run_recommender(B.rating_lines(spark, sf), "sim", "cosine", "score", NUM_RECS,
                                        output_path=scratch_path(spark, "recommender-out")))


@query
def q_sim_cosine_orders(spark, sf):
    """Cosine between suppliers over customers' line counts (the larger ratings binding)."""
    sim = S.similarity(written(B.order_ratings(spark, sf), "order-ratings", conf=SMALL_TASKS), "cosine", user="user")
    return sim.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), r6("sim").alias("sim"))
