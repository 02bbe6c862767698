"""DuckDB SQL of the queries that SQL can express, written from the definitions, not from the operators.

The others (searches with approximate candidates, fitted models, keyed permutations, tokenisers) are
tested against brute force, held-out labels or exact round trips in tests/llm.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"

OP3 = rf"""
WITH docs AS (
  SELECT doc_id, source, CAST(len({_WORDS.format('text')}) AS BIGINT) AS size,
         CASE q WHEN 1 THEN 4.0 WHEN 0 THEN 1.0 ELSE 2.0 END AS weight
  FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels WHERE quality IN (0, 1) GROUP BY 1) USING (doc_id)),
src AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS pos FROM docs GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0])[CAST((pos - 1) % 3 + 1 AS INTEGER)] AS weight, 3.0 * source_size AS cap FROM src),
s AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM w WINDOW before AS (ORDER BY cap / weight, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (SELECT min_by(level, cap / weight) FILTER (cap / weight > level) AS level FROM s),
t AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, least(cap, coalesce(lv.level * weight, cap)) AS target FROM s, lv),
k AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY
           -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) / d.weight,
           d.doc_id NULLS FIRST, d.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM docs d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * least(3, floor(target / source_size)
         + CASE WHEN upto - size / 2.0 < target - floor(target / source_size) * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken, source
FROM k"""

OP6 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_WORDS.format('text')} AS ws FROM documents),
tri AS (SELECT r, i, ws[i:i + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
hit AS (SELECT r, i FROM tri QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
rep AS (SELECT r, count(DISTINCT i + j) AS n FROM hit, (SELECT unnest([0, 1, 2]) AS j) GROUP BY r),
ln AS (SELECT r, source, line, {_WORDS.format('line')} AS lw FROM (SELECT r, source, unnest(string_split(text, chr(10))) AS line FROM d)),
worded AS (SELECT r, source, line, len(lw) AS n,
           translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000') AS folded
           FROM ln WHERE len(lw) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY r),
often AS (SELECT source, folded FROM worded GROUP BY 1, 2 HAVING count(DISTINCT r) > 20),
gone AS (SELECT r, sum(n) AS n FROM worded w JOIN often o ON w.source IS NOT DISTINCT FROM o.source AND w.folded = o.folded GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words
  FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT 100 * n_removed_words > 50 * n_words AS kept
FROM m"""

OP7 = r"""
WITH docs AS (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
ln AS (SELECT doc_id, text, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_no, unnest(ls) AS line FROM docs),
tk AS (SELECT *, list_sort(list_distinct(regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+'))) AS ws FROM ln),
cls AS (
  SELECT ws, min(struct_pack(a := doc_id IS NULL, b := doc_id, c := text, d := line_no)) AS first, row_number() OVER () AS id
  FROM tk WHERE len(ws) > 0 GROUP BY ws),
df AS (SELECT w, count(*) AS n FROM (SELECT unnest(ws) AS w FROM cls) GROUP BY w),
ranked AS (
  SELECT id, len(ws) AS n, w, row_number() OVER (PARTITION BY id ORDER BY df.n, w) AS pos
  FROM (SELECT id, ws, unnest(ws) AS w FROM cls) JOIN df USING (w)),
prefix AS (SELECT id, n, w FROM ranked WHERE pos <= n - ceil(0.8 * n - 1e-9) + 1),
cand AS (SELECT DISTINCT a.id AS x, b.id AS y FROM prefix a JOIN prefix b ON a.w = b.w AND a.id < b.id AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
sim AS (
  SELECT CASE WHEN p.first < q.first THEN y ELSE x END AS id FROM cand JOIN cls p ON p.id = x JOIN cls q ON q.id = y
  WHERE len(list_intersect(p.ws, q.ws)) >= 0.8 * (len(p.ws) + len(q.ws) - len(list_intersect(p.ws, q.ws))) - 1e-9),
stay AS (SELECT first.b AS doc_id, first.c AS text, first.d AS line_no FROM cls WHERE id NOT IN (SELECT id FROM sim)),
gone AS (
  SELECT t.doc_id, t.text, t.line_no FROM tk t LEFT JOIN stay s ON t.doc_id IS NOT DISTINCT FROM s.doc_id AND t.text = s.text AND t.line_no = s.line_no
  WHERE len(t.ws) > 0 AND s.line_no IS NULL)
SELECT d.doc_id, CAST(len(any_value(d.ls)) AS BIGINT) AS n_lines, CAST(count(g.line_no) AS BIGINT) AS n_removed,
       coalesce(string_agg(CAST(g.line_no AS VARCHAR), ',' ORDER BY g.line_no), '') AS removed_lines
FROM docs d LEFT JOIN gone g ON d.doc_id IS NOT DISTINCT FROM g.doc_id AND d.text = g.text GROUP BY d.doc_id, d.text"""

OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format('text')} AS ws FROM documents),
win AS (SELECT r, doc_id, i, array_to_string(ws[i:i + 19], ' ') AS g FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d)),
late AS (
  SELECT r, i FROM win
  QUALIFY struct_pack(a := doc_id IS NULL, b := doc_id, c := i) > min(struct_pack(a := doc_id IS NULL, b := doc_id, c := i)) OVER (PARTITION BY g)),
gone AS (SELECT DISTINCT r, i + j AS i FROM late, (SELECT unnest(range(20)) AS j)),
word AS (SELECT r, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM d),
kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS t FROM word w WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.r = w.r AND g.i = w.i) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN n USING (r)"""

OP9 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format('text')} AS ws FROM documents),
sg AS (
  SELECT r, g, count(*) AS n FROM (
    SELECT r, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM d WHERE len(ws) > 0))
  GROUP BY r, g),
tot AS (SELECT r, sum(n) AS n FROM sg GROUP BY r),
same AS (
  SELECT a.r AS x, b.r AS y, sum(least(a.n, b.n)) AS common FROM sg a JOIN sg b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2),
link AS (
  SELECT x, y FROM same JOIN tot p ON p.r = x JOIN tot q ON q.r = y WHERE common >= 0.8 * (p.n + q.n - common) - 1e-9),
reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
cls AS (SELECT x AS r, min(y) AS c FROM reach GROUP BY x),
head AS (SELECT c, min(doc_id) AS class_id FROM d JOIN cls USING (r) GROUP BY c)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, class_id,
       row_number() OVER (PARTITION BY c ORDER BY doc_id NULLS LAST, r) = 1 AS representative
FROM d JOIN cls USING (r) JOIN head USING (c)"""

def _op11() -> str:
    """Host and path, eight levels of the template tree, purity, rules."""
    parts = [r"""u AS (
  SELECT row_number() OVER () AS r, page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
lab AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
t0 AS (
  SELECT r, page_id, host, path, string_split(path, '/')[2:] AS segs, good, '' AS t
  FROM u LEFT JOIN lab ON lab.doc_id = TRY_CAST(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) AS BIGINT))"""]
    chi = "CASE WHEN {A} * ({N} - {A}) * {n} * ({N} - {n}) > 0 THEN ({a} * ({N} - {n}) - ({A} - {a}) * {n}) * ({a} * ({N} - {n}) - ({A} - {a}) * {n}) * {N} / ({A} * ({N} - {A}) * {n} * ({N} - {n})) ELSE 0 END > 10.828"
    for d in range(8):
        parts.append(f"""c{d} AS (
  SELECT host, t, segs[{d + 1}] AS child, count(*)::DOUBLE AS n, count(*) FILTER (len(segs) = {d + 1})::DOUBLE AS ends, count(good)::DOUBLE AS lab, coalesce(sum(good), 0)::DOUBLE AS good
  FROM t{d} WHERE len(segs) > {d} GROUP BY 1, 2, 3),
k{d} AS (
  SELECT host, t, child, '~' || CAST(least(floor(5 * ((good + 5.0 * CASE WHEN l_all > 0 THEN g_all / l_all ELSE 0.5 END) / (lab + 5.0))), 4) AS INTEGER)
         || CAST(least(floor(5 * (ends / n)), 4) AS INTEGER) AS branch
  FROM c{d} JOIN (SELECT host, t, sum(n) AS n_all, sum(ends) AS e_all, sum(lab) AS l_all, sum(good) AS g_all FROM c{d} GROUP BY 1, 2) USING (host, t)
  WHERE n >= 20 AND ({chi.format(a='good', n='lab', A='g_all', N='l_all')} OR {chi.format(a='ends', n='n', A='e_all', N='n_all')})),
t{d + 1} AS (
  SELECT x.* EXCLUDE (t), CASE WHEN len(segs) > {d} THEN x.t || '/' || coalesce(k.branch, '*') ELSE x.t END AS t
  FROM t{d} x LEFT JOIN k{d} k ON k.host = x.host AND k.t = x.t AND k.child = x.segs[{d + 1}])""")
    parts.append("""tt AS (SELECT *, t || CASE WHEN len(segs) > 8 THEN '/**' ELSE '' END AS template FROM t8),
al AS (SELECT (coalesce(sum(good), 0) + 1.0::DOUBLE) / (count(good) + 2.0::DOUBLE) AS prior FROM tt),
ho AS (SELECT host, (coalesce(sum(good), 0) + 5.0::DOUBLE * any_value(prior)) / (count(good) + 5.0::DOUBLE) AS usual FROM tt, al GROUP BY host),
pu AS (SELECT host, template, (coalesce(sum(good), 0) + 5.0::DOUBLE * any_value(usual)) / (count(good) + 5.0::DOUBLE) AS purity FROM tt JOIN ho USING (host) GROUP BY host, template),
rules(verdict, rule, own, start) AS (VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'),
  ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
ru AS (
  SELECT r, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM u JOIN rules ON (host = own OR host LIKE '%.' || own) AND starts_with(path, start) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(ru.verdict, CASE WHEN purity < 0.5 THEN 'block' ELSE 'allow' END) AS verdict, template
FROM tt JOIN pu USING (host, template) LEFT JOIN ru USING (r)""")
    return "WITH " + ",\n".join(parts[:-1]) + ",\n" + parts[-1]


OP11 = _op11()

#: The 256 entries of the crc32 table, and the crc32 of a list of bytes.
_CRC_TABLE = """crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) x(i))"""


def _crc32(octets: str) -> str:
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])))"


def _octets(text: str) -> str:
    return f"list_transform(range(1, 2 * strlen({text}), 2), lambda j: CAST('0x' || substr(hex(encode({text})), j, 2) AS BIGINT))"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen(CAST({x} AS VARCHAR)) AS VARCHAR) || ':' || CAST({x} AS VARCHAR), '-')"
                                   for x in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _climb(name: str, start: str, levels: str, tree: str, keep: str) -> str:
    """Recursive CTE: each row's digest and proof from ``start`` to the root of its tree in ``levels``."""
    same = f"{{}}.{tree} IS NOT DISTINCT FROM w.{tree} AND {{}}.h = w.h AND {{}}.i = "
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT {keep}, w.h + 1, w.i // 2, CASE WHEN s.x IS NULL THEN sha256(w.x) WHEN s.i < w.i THEN sha256(s.x || w.x) ELSE sha256(w.x || s.x) END,
         w.proof || coalesce(s.x, ''), m.n = 2
  FROM {name} w JOIN {levels} m ON {same.format('m', 'm', 'm')} w.i AND m.n > 1
  LEFT JOIN {levels} s ON {same.format('s', 's', 's')} xor(w.i, 1))"""


OP12 = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, {_leaf('n_chars')} AS leaf, {_leaf('(n_chars + 1)')} AS changed,
         {_crc32(_octets('CAST(doc_id AS VARCHAR)'))} AS code FROM documents, crc),
lf AS (
  SELECT r, doc_id, lang, leaf, CASE WHEN code % 7 = 0 THEN changed ELSE leaf END AS claim, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i FROM d),
lv AS (
  SELECT lang, 0 AS h, i, leaf AS x, n FROM lf
  UNION ALL
  SELECT lang, h + 1, i // 2, sha256(string_agg(x, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM lv WHERE n > 1 GROUP BY lang, h, i // 2),
sub AS (SELECT lang, x AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM lv WHERE n = 1),
tv AS (
  SELECT 0 AS t, 0 AS h, i, subroot AS x, n FROM sub
  UNION ALL
  SELECT t, h + 1, i // 2, sha256(string_agg(x, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM tv WHERE n > 1 GROUP BY t, h, i // 2),
{_climb('up', "SELECT r, lang, 0 AS h, i, claim AS x, '' AS proof, n = 1 AS done FROM lf", 'lv', 'lang', 'w.r, w.lang')},
{_climb('top', "SELECT up.r, 0 AS t, 0 AS h, sub.i, up.x, up.proof, sub.n = 1 AS done FROM up JOIN sub ON up.done AND up.lang IS NOT DISTINCT FROM sub.lang", 'tv', 't', 'w.r, w.t')}
SELECT lf.doc_id, lf.leaf, sub.subroot, tv.x AS root, sha256(top.proof) AS proof_sha256, top.x AS folded_root, top.x = tv.x AS verified
FROM lf JOIN sub ON lf.lang IS NOT DISTINCT FROM sub.lang JOIN top ON top.r = lf.r AND top.done JOIN tv ON tv.n = 1"""

_RUNS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP13 = rf"""
WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, {_RUNS} AS ws FROM documents),
w AS (SELECT r, unnest(ws) AS f FROM d),
b AS (SELECT unnest({_RUNS}) AS f FROM benchmark),
slot AS (SELECT f, {_crc32(_octets('f'))} % 10000 AS slot FROM (SELECT f FROM w UNION SELECT f FROM b), crc),
s AS (SELECT slot, count(*) AS n FROM w JOIN slot USING (f) GROUP BY slot),
t AS (SELECT slot, count(*) AS n FROM b JOIN slot USING (f) GROUP BY slot),
gain AS (
  SELECT slot, floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM w) + 10000) / ((s.n + 1.0::DOUBLE) * ((SELECT count(*) FROM b) + 10000)))) AS gain
  FROM s LEFT JOIN t USING (slot)),
doc AS (SELECT r, count(*) AS n_features, sum(gain) AS weight FROM w JOIN slot USING (f) JOIN gain USING (slot) GROUP BY r),
scored AS (
  SELECT r, doc_id, coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN doc USING (r)),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight, r) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_words, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN rank <= 10 * (SELECT count(*) FROM placed) // 100 THEN rank END AS rank
FROM scored LEFT JOIN placed USING (r)"""

ORACLES: dict[str, str] = {
    "op3_mix_sources": OP3,
    "op6_quality_rules": OP6,
    "op7_line_dedup": OP7,
    "op8_substring_dedup": OP8,
    "op9_near_duplicates": OP9,
    "op11_url_filters": OP11,
    "op12_merkle_manifest": OP12,
    "op13_target_sampling": OP13,
}
