"""DuckDB SQL oracles, one per registered query, written independently of the Spark code.

Shared inputs are CTE snippets mirroring the bindings in ``tessera.sources.tables``.
Iterative operators get an unrolled form: one CTE per iteration generated
from a single template, so the iteration count cannot drift.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


def doc_lines_cte(extra: str = "") -> str:
    """CTEs ``doc_split``/``doc_lines``: each document's text as lines (plus ``extra`` columns)."""
    x = f"{extra}, " if extra else ""
    return rf"""
doc_split AS (
  SELECT doc_id, {x}CASE WHEN text = '' THEN []::VARCHAR[]
              ELSE string_split(regexp_replace(text, '\n$', ''), chr(10)) END AS ls
  FROM documents),
doc_lines AS (
  SELECT doc_id, {x}CAST(generate_subscripts(ls, 1) - 1 AS BIGINT) AS line_no, unnest(ls) AS value
  FROM doc_split)"""


def tokens_cte(extra: str = "") -> str:
    """CTEs ``tok_split``/``doc_tokens``: one row per token of each line."""
    x = f"{extra}, " if extra else ""
    return rf"""
tok_split AS (
  SELECT doc_id, {x}line_no,
         CASE WHEN value <> '' AND rtrim(value, ' ') = '' THEN []::VARCHAR[]
              ELSE string_split(rtrim(value, ' '), ' ') END AS ts
  FROM doc_lines),
doc_tokens AS (
  SELECT doc_id, {x}line_no, CAST(generate_subscripts(ts, 1) - 1 AS BIGINT) AS pos, unnest(ts) AS word
  FROM tok_split)"""


DOC_LINES = doc_lines_cte()
TOKENS = tokens_cte()

oracle("read_lines", f"WITH {DOC_LINES} SELECT doc_id, line_no, value FROM doc_lines")
oracle("tokens", f"WITH {DOC_LINES}, {TOKENS} SELECT doc_id, line_no, pos, word FROM doc_tokens")
oracle("word_count", f"WITH {DOC_LINES}, {TOKENS} "
       "SELECT word, CAST(count(*) AS BIGINT) AS n FROM doc_tokens GROUP BY word")


# --- logs -----------------------------------------------------------------

TAB_LOGS = r"""
tab_lines AS (
  SELECT event_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') || chr(9) || upper(event_type) || chr(9) ||
         (['Java', 'MySQL', 'Nginx'])[CAST(user_id % 3 AS INTEGER) + 1] || chr(9) || props AS value
  FROM events),
tab_f AS (
  SELECT event_id, string_split(regexp_replace(value, '\t+$', ''), chr(9)) AS f FROM tab_lines),
tab_logs AS (
  SELECT event_id, f[1] AS ts, f[2] AS level, f[3] AS app,
         CASE WHEN len(f) > 3 THEN array_to_string(f[4:], chr(9)) END AS message
  FROM tab_f
  WHERE NOT (len(f) < 2 OR (f[2] = 'ERROR' AND len(f) < 3)))"""

SPACE_LOGS = r"""
space_lines AS (
  SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || upper(event_type) || ' ' || props AS value
  FROM events),
space_m AS (
  SELECT event_id,
         regexp_extract(value, '^(.{19}) ([A-Z]+).*$', 1) AS t,
         regexp_extract(value, '^(.{19}) ([A-Z]+).*$', 2) AS level
  FROM space_lines WHERE regexp_matches(value, '^(.{19}) ([A-Z]+).*$')),
space_p AS (
  SELECT event_id, level,
         CAST(regexp_extract(t, '^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$', 1) AS INTEGER) AS y,
         CAST(regexp_extract(t, '^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$', 2) AS INTEGER) AS mo,
         CAST(regexp_extract(t, '^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$', 3) AS INTEGER) AS d,
         CAST(regexp_extract(t, '^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$', 4) AS INTEGER) AS h,
         CAST(regexp_extract(t, '^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$', 5) AS INTEGER) AS mi,
         CAST(regexp_extract(t, '^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$', 6) AS INTEGER) AS s
  FROM space_m WHERE regexp_matches(t, '^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$')),
space_logs AS (
  SELECT event_id, level,
         make_timestamp(y, mo, least(d, day(last_day(make_date(y, mo, 1)))),
                        CASE WHEN h = 24 THEN 0 ELSE h END, mi, s)
           + CASE WHEN h = 24 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS time
  FROM space_p
  WHERE y >= 1 AND mo BETWEEN 1 AND 12 AND d BETWEEN 1 AND 31 AND mi BETWEEN 0 AND 59
    AND s BETWEEN 0 AND 59 AND (h BETWEEN 0 AND 23 OR (h = 24 AND mi = 0 AND s = 0)))"""

_LOGC = "event_id, ts, level, app, message"
oracle("parse_tab_logs", f"WITH {TAB_LOGS} SELECT {_LOGC} FROM tab_logs")
oracle("log_errors", f"WITH {TAB_LOGS} SELECT {_LOGC} FROM tab_logs WHERE level = 'ERROR'")
oracle("log_error_count", f"WITH {TAB_LOGS} SELECT CAST(count(*) AS BIGINT) AS n_errors "
       "FROM tab_logs WHERE level = 'ERROR'")
oracle("tab_log_rejects", r"""
SELECT CASE WHEN event_id % 10 = 3 THEN 'no level' ELSE 'error without application' END AS reason,
       CAST(count(*) AS BIGINT) AS n
FROM events WHERE event_id % 10 = 3 OR (event_id % 10 = 7 AND upper(event_type) = 'ERROR') GROUP BY 1""")
oracle("log_app_errors", f"WITH {TAB_LOGS} SELECT {_LOGC} FROM tab_logs "
       "WHERE level = 'ERROR' AND app = 'MySQL' ORDER BY ts, event_id LIMIT 10")
oracle("log_errors_by_app", f"WITH {TAB_LOGS} SELECT app, CAST(count(*) AS BIGINT) AS n "
       "FROM tab_logs WHERE level = 'ERROR' GROUP BY app")
oracle("parse_log_lines", f"WITH {SPACE_LOGS} SELECT event_id, "
       "strftime(time, '%Y-%m-%d %H:%M:%S') AS time, level FROM space_logs")
oracle("errors_per_minute", f"WITH {SPACE_LOGS} SELECT "
       "strftime(date_trunc('minute', time), '%Y-%m-%d %H:%M:%S') AS log_time, "
       "CAST(count(*) AS BIGINT) AS log_count FROM space_logs WHERE level = 'ERROR' GROUP BY 1")


# --- ratings, similarity, recommendation, evaluation ------------------------

def r6(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


RATINGS = r"""
ratings AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS "user", CAST(json_extract_string(props, '$.k') AS INTEGER) AS item,
         CAST(count(*) AS DOUBLE) AS rating
  FROM events GROUP BY 1, 2),
uids AS (
  SELECT "user", CAST(row_number() OVER (ORDER BY "user") - 1 AS BIGINT) AS user_id
  FROM (SELECT DISTINCT "user" FROM ratings)),
rated AS (SELECT r."user", r.item, r.rating, u.user_id FROM ratings r JOIN uids u USING ("user")),
bucketed AS (
  SELECT *, CAST('0x' || substr(md5('913:' || "user" || ':' || CAST(item AS VARCHAR)), 1, 8) AS BIGINT) % 10 AS bucket
  FROM rated),
train AS (SELECT "user", item, rating, user_id FROM bucketed WHERE bucket < 9),
test AS (SELECT "user", item, rating, user_id FROM bucketed WHERE bucket = 9),
entries AS (SELECT user_id AS u, CAST(item AS BIGINT) AS i, rating AS v FROM train WHERE rating <> 0),
istats AS (SELECT i AS item, sum(v * v) AS ss, count(*) AS cnt FROM entries GROUP BY i),
pairs AS (
  SELECT a.i, b.i AS j, sum(a.v * b.v) AS dot, count(*) AS co
  FROM entries a JOIN entries b ON a.u = b.u AND a.i < b.i GROUP BY 1, 2),
ps AS (
  SELECT p.*, si.ss AS ss_i, si.cnt AS n_i, sj.ss AS ss_j, sj.cnt AS n_j
  FROM pairs p JOIN istats si ON p.i = si.item JOIN istats sj ON p.j = sj.item),
zst AS (SELECT u, avg(v) AS mean, stddev_pop(v) AS sd FROM entries GROUP BY u),
zs AS (
  SELECT e.u, e.i, CASE WHEN z.sd <> 0 THEN (e.v - z.mean) / z.sd ELSE 'NaN'::DOUBLE END AS z
  FROM entries e JOIN zst z USING (u)),
zf AS (SELECT u, i, z FROM zs WHERE NOT isnan(z) AND z <> 0)"""

_N_USERS = "(SELECT count(DISTINCT user_id) FROM train)"

def llr_term(k: str, row: str, col: str) -> str:
    return f"coalesce(({k}) * ln(CAST({k} AS DOUBLE) * {_N_USERS} / nullif(({row}) * ({col}), 0)), 0)"


_LLR = " + ".join(f"CASE WHEN {k} > 0 THEN {llr_term(k, row, col)} ELSE 0 END" for k, row, col in (
    ("co", "n_i", "n_j"), ("(n_i - co)", "n_i", f"{_N_USERS} - n_j"), ("(n_j - co)", f"{_N_USERS} - n_i", "n_j"),
    (f"({_N_USERS} - n_i - n_j + co)", f"{_N_USERS} - n_i", f"{_N_USERS} - n_j")))

SIMS = {
    "cosine": "SELECT i, j, dot / sqrt(ss_i) / sqrt(ss_j) AS sim FROM ps",
    "cosine_mod": "SELECT i, j, dot / pow(ss_i, 0.6) / pow(ss_j, 0.4) AS sim FROM ps",
    "llr": f"SELECT i, j, greatest(0.0, 2.0 * ({_LLR})) AS sim FROM ps",
    "jaccard": "SELECT i, j, CAST(co AS DOUBLE) / (n_i + n_j - co) AS sim FROM ps",
    "euclidean": "SELECT a.i, b.i AS j, sqrt(sum(pow(a.z - b.z, 2))) AS sim "
                 "FROM zf a JOIN zf b ON a.u = b.u AND a.i < b.i GROUP BY 1, 2",
}


def sim_cte(name: str, measure: str) -> str:
    """Symmetric measure as a CTE named ``name`` (both directions)."""
    return (f"{name}_h AS ({SIMS[measure]}),\n"
            f"{name} AS (SELECT i, j, sim FROM {name}_h UNION ALL SELECT j AS i, i AS j, sim FROM {name}_h)")


_UPPER_COS = "SELECT i, j, dot / (sqrt(ss_i) * sqrt(ss_j)) AS sim FROM ps"
for _m in ("cosine", "cosine_mod", "llr", "jaccard", "euclidean"):
    oracle(f"sim_{_m}", f"WITH {RATINGS}, {sim_cte('s', _m)} "
           f"SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, {r6('sim')} AS sim FROM s")
oracle("sim_spark", f"WITH {RATINGS}, s AS ({_UPPER_COS}) SELECT i, j, {r6('sim')} AS sim FROM s")

QUANTITIES = """
entries AS (
  SELECT o.o_custkey AS u, CAST(l.l_suppkey AS BIGINT) AS i, CAST(sum(l.l_quantity) AS DOUBLE) AS v
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)"""


def sampled_cosine(threshold: float, seed: int = 42) -> str:
    """CTEs after ``entries(u, i, v)``: the bound, norms, the entries that both draws leave, and ``s(i, j, sim)``."""
    def draw(at: int) -> str:
        return f"CAST('0x' || substr(md5('{seed}:' || CAST(u AS VARCHAR) || ':' || CAST(i AS VARCHAR)), {at}, 13) AS BIGINT) / 4503599627370496.0"

    return f"""
bd AS (SELECT sqrt(10 * ln(max(i) + 1) / {threshold}) AS b FROM entries),
nm AS (SELECT i, sqrt(sum(v * v)) AS norm FROM entries GROUP BY i),
dr AS (SELECT u, i, v / least(b, norm) AS s, {draw(1)} < b / norm AS low, {draw(14)} < b / norm AS high FROM entries JOIN nm USING (i), bd),
s AS (SELECT x.i, y.i AS j, sum(x.s * y.s) AS sim FROM dr x JOIN dr y ON x.u = y.u AND x.i < y.i AND x.low AND y.high GROUP BY 1, 2)"""


oracle("sim_spark_appr", f"WITH {QUANTITIES}, {sampled_cosine(0.1)} SELECT i, j, {r6('sim')} AS sim FROM s")
oracle("sim_spark_quantities", f"WITH {QUANTITIES}, nm AS (SELECT i, sqrt(sum(v * v)) AS norm FROM entries GROUP BY i), "
       "w AS (SELECT u, i, v / norm AS s FROM entries JOIN nm USING (i)), "
       "s AS (SELECT x.i, y.i AS j, sum(x.s * y.s) AS sim FROM w x JOIN w y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2) "
       f"SELECT i, j, {r6('sim')} AS sim FROM s")
oracle("sim_spark_appr_events", f"WITH {RATINGS}, {sampled_cosine(0.1)} SELECT i, j, {r6('sim')} AS sim FROM s")

NEIGHBOURS = sim_cte("cos", "cosine") + r""",
nbr AS (SELECT i, j, sim, row_number() OVER (PARTITION BY i ORDER BY round(sim, 9) DESC, j) AS rank FROM cos),
nb AS (
  SELECT i AS item, j AS neighbour,
         CASE WHEN max(sim) OVER w = min(sim) OVER w THEN 0.5
              ELSE (sim - min(sim) OVER w) / (max(sim) OVER w - min(sim) OVER w) END AS weight,
         rank
  FROM nbr WHERE rank <= 50 WINDOW w AS (PARTITION BY i)),
owned AS (SELECT user_id, item FROM train WHERE item IN (SELECT item FROM nb)),
rusers AS (SELECT DISTINCT user_id FROM owned),
cands AS (SELECT t.user_id, t.item, n.neighbour, n.weight FROM train t JOIN nb n ON t.item = n.item),
unseen AS (
  SELECT * FROM cands c
  WHERE NOT EXISTS (SELECT 1 FROM owned o WHERE o.user_id = c.user_id AND o.item = c.neighbour)),
rs AS (
  SELECT user_id, neighbour AS item, weight AS score,
         row_number() OVER (PARTITION BY user_id ORDER BY round(weight, 9) DESC, neighbour, item) AS rank
  FROM unseen),
sc AS (
  SELECT t.user_id, t.item,
         CASE WHEN m.hi = m.lo THEN 0.5 ELSE (t.rating - m.lo) / (m.hi - m.lo) END AS r
  FROM train t JOIN (SELECT user_id, min(rating) AS lo, max(rating) AS hi FROM train GROUP BY 1) m USING (user_id)),
ws_c AS (
  SELECT s.user_id, s.item, s.r, n.neighbour, n.weight FROM sc s JOIN nb n ON s.item = n.item
  WHERE NOT EXISTS (SELECT 1 FROM owned o WHERE o.user_id = s.user_id AND o.item = n.neighbour)),
ws_a AS (
  SELECT user_id, neighbour AS item,
         CASE WHEN sum(weight) <> 0 THEN sum(weight * r) / sum(weight) ELSE 0.0 END AS score
  FROM ws_c GROUP BY 1, 2),
ws AS (
  SELECT user_id, item, score,
         row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item) AS rank
  FROM ws_a)"""

_REC_COLS = f"CAST(user_id AS BIGINT) AS user_id, CAST(rank AS BIGINT) AS rank, CAST(item AS BIGINT) AS item, {r6('score')} AS score"

oracle("parse_ratings", f"WITH {RATINGS} SELECT \"user\", CAST(item AS BIGINT) AS item, "
       "CAST(rating AS BIGINT) AS clicks FROM ratings")
oracle("rating_stats", f"WITH {RATINGS} SELECT CAST(count(*) AS BIGINT) AS n_ratings, "
       "CAST(count(DISTINCT \"user\") AS BIGINT) AS n_users, CAST(count(DISTINCT item) AS BIGINT) AS n_items FROM ratings")
oracle("user_ids", f"WITH {RATINGS} SELECT \"user\", user_id FROM uids")
oracle("user_id_join", f"WITH {RATINGS} SELECT \"user\", user_id, CAST(item AS BIGINT) AS item, "
       f"{r6('rating')} AS rating FROM rated")
oracle("train_test_split", f"WITH {RATINGS} SELECT \"user\", CAST(item AS BIGINT) AS item, {r6('rating')} AS rating, "
       "CASE WHEN bucket = 9 THEN 'test' ELSE 'train' END AS part FROM bucketed")
oracle("zscore_by_user", f"WITH {RATINGS}, st AS (SELECT \"user\", avg(rating) AS m, stddev_pop(rating) AS sd "
       "FROM ratings GROUP BY 1) SELECT \"user\", CAST(item AS BIGINT) AS item, "
       f"{r6(chr(39) + 'NaN' + chr(39) + '::DOUBLE')} AS z FROM ratings JOIN st USING (\"user\") WHERE sd = 0 "
       f"UNION ALL SELECT \"user\", CAST(item AS BIGINT) AS item, {r6('(rating - m) / sd')} AS z "
       "FROM ratings JOIN st USING (\"user\") WHERE sd <> 0")
oracle("minmax_by_user", f"WITH {RATINGS}, st AS (SELECT \"user\", min(rating) AS lo, max(rating) AS hi "
       "FROM ratings GROUP BY 1) SELECT \"user\", CAST(item AS BIGINT) AS item, "
       f"{r6('CASE WHEN hi = lo THEN 0.5 ELSE (rating - lo) / (hi - lo) END')} AS scaled "
       "FROM ratings JOIN st USING (\"user\")")
oracle("lp_scale_by_user", f"WITH {RATINGS}, st AS (SELECT \"user\", pow(sum(pow(rating, 2.0)), 0.5) AS nrm "
       "FROM ratings GROUP BY 1) SELECT \"user\", CAST(item AS BIGINT) AS item, "
       f"{r6('rating / nrm')} AS scaled FROM ratings JOIN st USING (\"user\")")
oracle("item_stats", f"WITH {RATINGS} SELECT item, {r6('ss')} AS ss, CAST(cnt AS BIGINT) AS cnt FROM istats")
oracle("item_pairs", f"WITH {RATINGS} SELECT i, j, {r6('dot')} AS dot, CAST(co AS BIGINT) AS co FROM pairs")
oracle("top_neighbours", f"WITH {RATINGS}, {NEIGHBOURS} SELECT CAST(item AS BIGINT) AS item, "
       f"CAST(neighbour AS BIGINT) AS neighbour, {r6('weight')} AS weight, CAST(rank AS BIGINT) AS rank FROM nb")
oracle("top_neighbours_pruned", ORACLES["top_neighbours"])
oracle("rec_candidates", f"WITH {RATINGS}, {NEIGHBOURS} SELECT CAST(user_id AS BIGINT) AS user_id, "
       f"CAST(item AS BIGINT) AS item, CAST(neighbour AS BIGINT) AS neighbour, {r6('weight')} AS weight FROM cands")
oracle("candidates_unseen", f"WITH {RATINGS}, {NEIGHBOURS} SELECT CAST(user_id AS BIGINT) AS user_id, "
       f"CAST(item AS BIGINT) AS item, CAST(neighbour AS BIGINT) AS neighbour, {r6('weight')} AS weight FROM unseen")
oracle("rec_users", f"WITH {RATINGS}, {NEIGHBOURS} SELECT CAST(user_id AS BIGINT) AS user_id FROM rusers")
oracle("rec_score", f"WITH {RATINGS}, {NEIGHBOURS} SELECT {_REC_COLS} FROM rs WHERE rank <= 30")
oracle("rec_weighted_sum", f"WITH {RATINGS}, {NEIGHBOURS} SELECT {_REC_COLS} FROM ws WHERE rank <= 30")

EVAL = r"""
recs AS (SELECT user_id, item FROM ws WHERE rank <= 30),
common AS (SELECT DISTINCT user_id FROM test WHERE user_id IN (SELECT user_id FROM rusers)),
tc AS (SELECT DISTINCT user_id, item FROM test WHERE user_id IN (SELECT user_id FROM common)),
rc AS (SELECT DISTINCT user_id, item FROM recs WHERE user_id IN (SELECT user_id FROM common)),
tot AS (
  SELECT CAST((SELECT count(*) FROM tc JOIN rc USING (user_id, item)) AS BIGINT) AS tp,
         CAST((SELECT count(*) FROM tc) AS BIGINT) AS tp_fn,
         CAST((SELECT count(*) FROM rc) AS BIGINT) AS tp_fp),
pr AS (
  SELECT *, CASE WHEN tp_fp = 0 THEN 'NaN'::DOUBLE ELSE CAST(tp AS DOUBLE) / tp_fp END AS precision,
         CASE WHEN tp_fn = 0 THEN 'NaN'::DOUBLE ELSE CAST(tp AS DOUBLE) / tp_fn END AS recall FROM tot)"""

oracle("eval_precision", f"WITH {RATINGS}, {NEIGHBOURS}, {EVAL} SELECT tp, tp_fn, tp_fp, {r6('precision')} AS precision, "
       f"{r6('recall')} AS recall, "
       f"{r6('CASE WHEN precision + recall = 0 THEN ' + chr(39) + 'NaN' + chr(39) + '::DOUBLE ELSE 2.0 * precision * recall / (precision + recall) END')} AS f1 FROM pr")
oracle("eval_coverage", f"WITH {RATINGS}, {NEIGHBOURS}, {EVAL} SELECT "
       "CAST((SELECT count(DISTINCT item) FROM recs) AS BIGINT) AS n_rec_items, "
       "CAST((SELECT count(DISTINCT item) FROM train) AS BIGINT) AS n_train_items, "
       f"{r6('(SELECT count(DISTINCT item) FROM recs) / (SELECT count(DISTINCT item) FROM train)')} AS coverage")
oracle("eval_popularity", f"WITH {RATINGS}, {NEIGHBOURS}, {EVAL}, cnt AS (SELECT item, count(*) AS n FROM train GROUP BY 1) "
       f"SELECT {r6('avg(ln(1 + n))')} AS popularity, CAST(count(*) AS BIGINT) AS n_rows FROM recs JOIN cnt USING (item)")
oracle("matrix_mae", f"WITH {RATINGS}, {sim_cte('a', 'cosine')}, {sim_cte('b', 'cosine_mod')} "
       f"SELECT {r6('avg(abs(a.sim - coalesce(b.sim, 0)))')} AS mae, CAST(count(*) AS BIGINT) AS n_entries "
       "FROM a LEFT JOIN b ON a.i = b.i AND a.j = b.j")


# --- graph ----------------------------------------------------------------

BIP_EDGES = r"""
bip_rel AS (
  SELECT DISTINCT -(CAST(user_id AS BIGINT) + 1) AS "user", CAST(json_extract_string(props, '$.k') AS BIGINT) AS item
  FROM events),
g_edges AS (SELECT "user" AS src, item AS dst FROM bip_rel UNION ALL SELECT item AS src, "user" AS dst FROM bip_rel)"""

ORDER_EDGES = r"""
g_edges AS (
  SELECT o.o_custkey AS src, -(l.l_suppkey + 1) AS dst FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

NEXT_ITEM_EDGES = r"""
ev_k AS (SELECT user_id, ts, event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
ev_next AS (SELECT k AS src, lead(k) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dst FROM ev_k),
g_edges AS (SELECT src, dst FROM ev_next WHERE dst IS NOT NULL)"""

PPR_SOURCE = "(SELECT -(min(user_id) + 1) FROM events)"

# Iteration counts of the unrolled oracles: a fixed count for the static
# variant, and for converging variants enough steps that the 0.85 contraction
# leaves an error far below the 6 decimals compared.
UNROLL_CONVERGED = 220


def unrolled_ranks(edges_cte: str, iterations: int, source: str | None) -> str:
    """``WITH ...`` prefix ending in CTE ``ranks(id, rank)`` after ``iterations`` plain steps."""
    parts = [edges_cte.strip().rstrip(","),
             "g_deg AS (SELECT src, count(*) AS d FROM g_edges GROUP BY src)",
             "g_w AS (SELECT e.src, e.dst, 1.0 / g.d AS w FROM g_edges e JOIN g_deg g USING (src))",
             "g_v AS (SELECT DISTINCT id FROM (SELECT src AS id FROM g_edges UNION ALL SELECT dst FROM g_edges))"]
    if source is None:
        parts.append("r0 AS (SELECT id, 1.0 AS rank FROM g_v)")
        reset = "0.15"
    else:
        parts.append(f"r0 AS (SELECT id, CASE WHEN id = {source} THEN 1.0 ELSE 0.0 END AS rank FROM g_v)")
        reset = f"CASE WHEN v.id = {source} THEN 0.15 ELSE 0.0 END"
    for t in range(iterations):
        parts.append(
            f"r{t + 1} AS (SELECT v.id, {reset} + 0.85 * coalesce(c.s, 0.0) AS rank FROM g_v v LEFT JOIN "
            f"(SELECT w.dst, sum(r.rank * w.w) AS s FROM g_w w JOIN r{t} r ON w.src = r.id GROUP BY w.dst) c "
            f"ON v.id = c.dst)")
    scale = "1.0" if source is not None else "count(*) OVER ()"
    parts.append(f"ranks AS (SELECT id, rank * {scale} / sum(rank) OVER () AS rank FROM r{iterations})")
    return "WITH " + ",\n".join(parts)


_RANK_OUT = f"SELECT CAST(id AS BIGINT) AS id, {r6('rank')} AS rank FROM ranks"
oracle("bipartite_edges", f"WITH {BIP_EDGES} SELECT src, dst FROM g_edges")
oracle("edge_list", f"WITH {ORDER_EDGES} SELECT src, dst FROM g_edges")
oracle("parse_users", "SELECT c_custkey AS id, c_name AS handle FROM customer")
oracle("pagerank", unrolled_ranks(BIP_EDGES, UNROLL_CONVERGED, None) + " " + _RANK_OUT)
oracle("pagerank_sinks", unrolled_ranks(ORDER_EDGES, 40, None) + " " + _RANK_OUT)
oracle("next_item_edges", f"WITH {NEXT_ITEM_EDGES} SELECT src, dst FROM g_edges")
oracle("pagerank_next_item", unrolled_ranks(NEXT_ITEM_EDGES, UNROLL_CONVERGED, None) + " " + _RANK_OUT)
oracle("pagerank_named", unrolled_ranks(ORDER_EDGES, 40, None) +
       f" SELECT c.c_name AS handle, {r6('r.rank')} AS rank FROM ranks r JOIN customer c ON r.id = c.c_custkey")
oracle("ppr_static", unrolled_ranks(BIP_EDGES, 20, PPR_SOURCE) + " " + _RANK_OUT)
oracle("ppr_converged", unrolled_ranks(BIP_EDGES, UNROLL_CONVERGED, PPR_SOURCE) + " " + _RANK_OUT)
oracle("ppr_items", unrolled_ranks(BIP_EDGES, 20, PPR_SOURCE) +
       f" SELECT CAST(id AS BIGINT) AS id, {r6('rank')} AS rank, CAST(row_number() OVER "
       "(ORDER BY round(rank, 9) DESC, id) AS BIGINT) AS pos FROM ranks WHERE id >= 0")


def unrolled_waves(edges_cte: str, steps: int, tol: float, source: str | None) -> str:
    """``WITH ...`` ending in ``ranks(id, rank)``: gains of more than ``tol`` are passed on, ``steps`` times
    (steps after the last gain change nothing)."""
    start = "0.15::DOUBLE" if source is None else f"CASE WHEN id = {source} THEN 1.0::DOUBLE ELSE 0.0 END"
    parts = [edges_cte.strip().rstrip(","),
             "g_deg AS (SELECT src, count(*) AS d FROM g_edges GROUP BY src)",
             "g_w AS MATERIALIZED (SELECT e.src, e.dst, 1.0::DOUBLE / g.d AS w FROM g_edges e JOIN g_deg g USING (src))",
             f"x0 AS MATERIALIZED (SELECT id, {start} AS x FROM (SELECT src AS id FROM g_edges UNION SELECT dst FROM g_edges))"]
    for t in range(steps):
        parts.append(f"x{t + 1} AS MATERIALIZED (SELECT w.dst AS id, 0.85 * sum(x.x * w.w) AS x FROM g_w w JOIN x{t} x ON w.src = x.id WHERE x.x > {tol} GROUP BY w.dst)")
    waves = " UNION ALL ".join(f"SELECT id, x FROM x{t}" for t in range(steps + 1))
    scale = "1.0" if source is not None else "count(*) OVER ()"
    parts.append(f"ranks AS (SELECT id, sum(x) * {scale} / sum(sum(x)) OVER () AS rank FROM ({waves}) GROUP BY id)")
    return "WITH " + ",\n".join(parts)


oracle("pagerank_tolerance", unrolled_waves(NEXT_ITEM_EDGES, 70, 1e-4, None) + " " + _RANK_OUT)
oracle("ppr_tolerance", unrolled_waves(BIP_EDGES, 70, 1e-4, PPR_SOURCE) + " " + _RANK_OUT)
oracle("ppr_split", unrolled_ranks(BIP_EDGES, 20, PPR_SOURCE) +
       f" SELECT CASE WHEN id >= 0 THEN 'item' ELSE 'user' END AS side, CAST(id AS BIGINT) AS id, CAST(row_number() OVER "
       f"(PARTITION BY id >= 0 ORDER BY round(rank, 9) DESC, id) AS BIGINT) AS pos, {r6('round(rank, 9)')} AS rank FROM ranks")
oracle("pagerank_ascending", unrolled_waves(ORDER_EDGES, 4, 1e-4, None) +
       f" SELECT c.c_name AS handle, {r6('round(r.rank, 9)')} AS rank, CAST(row_number() OVER (ORDER BY round(r.rank, 9), r.id) AS BIGINT) AS pos "
       "FROM ranks r JOIN customer c ON r.id = c.c_custkey")


# --- iterative fitting ------------------------------------------------------

def _java_start_weights(d: int, seed: int = 42) -> list[float]:
    from tessera.functions.javarandom import start_weights
    return start_weights(d, seed)


_PTS = "pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"
_SAMPLE_KEY = "md5('42:' || CAST(id AS VARCHAR)), id"


def kmeans_sql(k: int, steps: int) -> str:
    parts = [_PTS,
             f"c0 AS (SELECT CAST(row_number() OVER (ORDER BY {_SAMPLE_KEY}) - 1 AS INTEGER) AS cid, x FROM pts "
             f"QUALIFY row_number() OVER (ORDER BY {_SAMPLE_KEY}) <= {k})"]
    dist = "list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i])))"
    for t in range(steps + 1):
        parts.append(f"b{t} AS (SELECT p.id, p.x, c.cid, {dist} AS d FROM pts p, c{t} c "
                     f"QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY {dist}, c.cid) = 1)")
        if t == steps:
            break
        parts.append(f"m{t} AS (SELECT cid, list(s ORDER BY k) AS x FROM (SELECT b.cid, r.k, "
                     f"sum(b.x[r.k]) * (1.0 / count(*)) AS s FROM b{t} b, range(1, 65) r(k) GROUP BY b.cid, r.k) "
                     "GROUP BY cid)")
        parts.append(f"c{t + 1} AS (SELECT c.cid, coalesce(m.x, c.x) AS x FROM c{t} c LEFT JOIN m{t} m USING (cid))")
    return "WITH " + ",\n".join(parts)


def logistic_sql(d: int, iterations: int) -> str:
    w0 = ", ".join(repr(v) for v in _java_start_weights(d))
    parts = [f"lp AS (SELECT CAST(CASE WHEN label % 2 = 0 THEN 1.0 ELSE -1.0 END AS DOUBLE) AS y, "
             f"CAST(embedding AS DOUBLE[]) AS x FROM embeddings)",
             f"w0 AS (SELECT [{w0}]::DOUBLE[] AS w)"]
    for t in range(iterations):
        parts.append(f"f{t} AS (SELECT lp.x, (1.0 / (1.0 + exp(-lp.y * list_sum(list_transform(range(1, {d} + 1), "
                     f"lambda i: lp.x[i] * w{t}.w[i])))) - 1.0) * lp.y AS f FROM lp, w{t})")
        parts.append(f"w{t + 1} AS (SELECT list(wk ORDER BY k) AS w FROM (SELECT r.k, w{t}.w[r.k] - sum(f.x[r.k] * f.f) AS wk "
                     f"FROM f{t} f, range(1, {d} + 1) r(k), w{t} GROUP BY r.k, w{t}.w))")
    return "WITH " + ",\n".join(parts)


_VEC9 = "CAST(printf('%.9f', CAST(v AS DOUBLE)) AS DOUBLE)"
oracle("parse_vectors", "SELECT vec_id AS id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS pos, "
       f"round({_VEC9.replace('v', 'unnest(embedding)', 1)}, 6) AS x FROM embeddings")
oracle("parse_points", "SELECT id, y, CAST(pos AS BIGINT) AS pos, round(CAST(printf('%.9f', v) AS DOUBLE), 6) AS x FROM "
       "(SELECT vec_id AS id, CAST(CASE WHEN label % 2 = 0 THEN 1.0 ELSE -1.0 END AS DOUBLE) AS y, "
       "generate_subscripts(embedding, 1) - 1 AS pos, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings)")
oracle("sample_k", f"WITH {_PTS} SELECT id FROM pts ORDER BY {_SAMPLE_KEY} LIMIT 5")
oracle("kmeans_assign", kmeans_sql(5, 0) + f" SELECT id, CAST(cid AS BIGINT) AS cluster, {r6('d')} AS dist FROM b0")
# unrolled past the step at which the centers stop moving (further steps change nothing)
oracle("kmeans_steps", kmeans_sql(5, 40) + f" SELECT id, CAST(cid AS BIGINT) AS cluster, {r6('d')} AS dist FROM b40")
oracle("logistic_steps", logistic_sql(64, 3) + f" SELECT CAST(k - 1 AS BIGINT) AS pos, {r6('w3.w[k]')} AS weight "
       "FROM w3, range(1, 65) r(k)")


# --- sources and sinks: JDBC, ranges, files, upserts ------------------------

_SUP = "s_suppkey, s_name, s_nationkey, round(CAST(CAST(s_acctbal AS DECIMAL(12, 2)) AS DOUBLE), 6) AS s_acctbal"
_UPD = ("SELECT c_custkey AS s_suppkey, c_name AS s_name, c_nationkey AS s_nationkey, "
        "round(CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS DOUBLE), 6) AS s_acctbal FROM customer")
_UPSERTED = (f"SELECT {_SUP} FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer) "
             f"UNION ALL {_UPD}")
oracle("upsert_table", _UPSERTED)
oracle("merge_table", _UPSERTED)
oracle("sql_count_avg", "SELECT CAST(count(*) AS BIGINT) AS n, round(CAST(sum(CAST(s_acctbal AS DECIMAL(12, 2))) AS DOUBLE) / count(*), 6) AS mean, "
       "'decimal(16,6)' AS kind FROM supplier WHERE s_nationkey = 7")
oracle("sql_view_groups", "SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n, round(CAST(sum(CAST(o_totalprice AS DECIMAL(15, 2))) AS DOUBLE) / count(*), 2) AS mean "
       "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment")
oracle("sql_frame_view", f"WITH {RATINGS} SELECT CAST(item AS BIGINT) AS item, CAST(count(*) AS BIGINT) AS n, round(avg(rating), 6) AS mean FROM ratings GROUP BY item")
oracle("upsert_add", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS log_time, "
       "CAST(count(*) AS BIGINT) AS log_count FROM events GROUP BY 1")
oracle("write_tsv_roundtrip", f"WITH {RATINGS}, {NEIGHBOURS} SELECT CAST(item AS BIGINT) AS item, "
       f"CAST(neighbour AS BIGINT) AS neighbour, {r6('weight')} AS weight FROM nb")


# --- streaming --------------------------------------------------------------

RECORDS = r"""
records AS (
  SELECT event_id, 'events' AS topic, CAST(user_id % 2 AS INTEGER) AS partition,
         CAST(row_number() OVER (PARTITION BY user_id % 2 ORDER BY event_id) - 1 AS BIGINT) AS "offset",
         strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || upper(event_type) || ' ' || props AS value
  FROM events)"""

_NTOK = ("len(CASE WHEN value <> '' AND rtrim(value, ' ') = '' THEN []::VARCHAR[] "
         "ELSE string_split(rtrim(value, ' '), ' ') END)")

oracle("stream_word_count", f"WITH {doc_lines_cte('doc_id % 8 AS batch')}, "
       f"{tokens_cte('batch')} "
       "SELECT word, CAST(count(DISTINCT batch) AS BIGINT) AS n_batches, CAST(count(*) AS BIGINT) AS n "
       "FROM doc_tokens GROUP BY word")
oracle("stream_counts_with_offsets", f"WITH {RECORDS}, sl AS (SELECT *, CAST(floor(event_id * 8 / (SELECT max(event_id) + 1 FROM events)) AS BIGINT) AS slice "
       f"FROM records), bw AS (SELECT slice, CAST(sum({_NTOK}) AS BIGINT) AS batch_words FROM sl GROUP BY slice) "
       "SELECT topic, partition, min(\"offset\") AS from_offset, max(\"offset\") + 1 AS until_offset, "
       "any_value(bw.batch_words) AS batch_words FROM sl JOIN bw USING (slice) GROUP BY topic, partition, slice")
oracle("offset_ranges", f"WITH {RECORDS} SELECT topic, partition, min(\"offset\") AS from_offset, "
       "max(\"offset\") + 1 AS until_offset FROM records GROUP BY topic, partition")
oracle("ledger_start_offsets", f"WITH {RECORDS}, led AS (SELECT topic, partition, max(\"offset\") + 1 AS o "
       "FROM records GROUP BY 1, 2) SELECT topic, '{\"' || topic || '\":{' || "
       "string_agg('\"' || CAST(partition AS VARCHAR) || '\":' || CAST(o AS VARCHAR), ',' ORDER BY partition) "
       "|| '}}' AS offsets_json FROM led GROUP BY topic")

oracle("exactly_once_errors", ORACLES["errors_per_minute"])
oracle("exactly_once_resume", "SELECT 'events' AS topic, '{\"events\":{\"0\":' || CAST(max(event_id) + 1 AS VARCHAR) || '}}' AS offsets_json FROM events HAVING count(*) > 0")

oracle("recommender_run", f"WITH {RATINGS}, {NEIGHBOURS}, {EVAL}, cnt AS (SELECT item, count(*) AS n FROM train GROUP BY 1) "
       f"SELECT tp, tp_fn, tp_fp, {r6('precision')} AS precision, {r6('recall')} AS recall, "
       f"{r6('CASE WHEN precision + recall = 0 THEN ' + chr(39) + 'NaN' + chr(39) + '::DOUBLE ELSE 2.0 * precision * recall / (precision + recall) END')} AS f1, "
       f"{r6('(SELECT count(DISTINCT item) FROM recs) / (SELECT count(DISTINCT item) FROM train)')} AS coverage, "
       f"{r6('(SELECT avg(ln(1 + n)) FROM recs JOIN cnt USING (item))')} AS popularity FROM pr")

oracle("sim_cosine_orders", r"""
WITH ords AS (
  SELECT 'c' || CAST(o.o_custkey AS VARCHAR) AS u, CAST(l.l_suppkey AS BIGINT) AS i, CAST(count(*) AS DOUBLE) AS v
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
st AS (SELECT i, sum(v * v) AS ss FROM ords GROUP BY i),
pr AS (SELECT a.i, b.i AS j, sum(a.v * b.v) AS dot FROM ords a JOIN ords b ON a.u = b.u AND a.i < b.i GROUP BY 1, 2),
h AS (SELECT p.i, p.j, p.dot / sqrt(si.ss) / sqrt(sj.ss) AS sim FROM pr p JOIN st si ON p.i = si.i JOIN st sj ON p.j = sj.i)
SELECT i, j, round(sim, 6) AS sim FROM h UNION ALL SELECT j AS i, i AS j, round(sim, 6) AS sim FROM h""")

_ALS = f"""
WITH {RATINGS}, n AS (SELECT least(30, count(DISTINCT item)) AS items, least(30, count(DISTINCT user_id)) AS users FROM train)
"""
_ALS_ROW = ("SELECT user_id, items AS n_recs, items AS n_items, items AS last_rank, items AS n_known, true AS solved "
            "FROM (SELECT DISTINCT user_id FROM train), n")
oracle("rec_als_user", _ALS + _ALS_ROW)
# every item lists its 300 best users: all of them at the scales where this runs, so everybody is served in full
oracle("rec_als_item", _ALS + _ALS_ROW)
oracle("recommender_run_als", f"""
WITH {RATINGS}, common AS (SELECT DISTINCT user_id FROM test WHERE user_id IN (SELECT user_id FROM train))
SELECT CAST((SELECT count(DISTINCT (user_id, item)) FROM test JOIN common USING (user_id)) AS BIGINT) AS tp_fn,
       CAST((SELECT count(*) FROM common) * (SELECT least(30, count(DISTINCT item)) FROM train) AS BIGINT) AS tp_fp, true AS in_range""")
oracle("recommender_run_score", ORACLES["recommender_run"].replace("FROM ws WHERE", "FROM rs WHERE"))
