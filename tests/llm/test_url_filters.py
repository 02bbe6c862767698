"""Templates, purity and rules against plain Python."""
import random
import re
from collections import defaultdict

from tessera.llm import url_filters as UF

SF = "/root/testdata/sf0.01"


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def chi(a, n, all_a, all_n):
    below = all_a * (all_n - all_a) * n * (all_n - n)
    return (a * (all_n - n) - (all_a - a) * n) ** 2 * all_n / below if below else 0


def ruled(host, path, rules):
    fits = [(len(r), r.index("/"), r, v) for v, r in rules if ("." + host).endswith("." + r[:r.index("/")]) and path.startswith(r[r.index("/"):])]
    return max(fits)[2:] if fits else (None, None)


def brute(rows, rules=UF.RULES, least=UF.MIN_URLS, max_depth=UF.MAX_DEPTH):
    """rows: (page_id, url, label or None)."""
    urls = []
    for page, url, good in rows:
        host, path = parts(url)
        urls.append([page, host, path, path.split("/")[1:], good, ""])
    for depth in range(max_depth):
        nodes, children = defaultdict(lambda: [0] * 4), defaultdict(lambda: [0] * 4)
        for _, host, _, segs, good, tmpl in urls:
            if len(segs) > depth:
                for c in (nodes[host, tmpl], children[host, tmpl, segs[depth]]):
                    for k, v in enumerate((1, len(segs) == depth + 1, good is not None, good or 0)):
                        c[k] += v
        kept = {}
        for (host, tmpl, seg), (n, ends, lab, good) in children.items():
            an, aends, alab, agood = nodes[host, tmpl]
            if n >= least and (chi(good, lab, agood, alab) > UF.DIFFERENT or chi(ends, n, aends, an) > UF.DIFFERENT):
                share = (good + 5 * (agood / alab if alab else 0.5)) / (lab + 5)
                kept[host, tmpl, seg] = f"~{min(int(5 * share), 4)}{min(int(5 * (ends / n)), 4)}"
        for u in urls:
            if len(u[3]) > depth:
                u[5] += "/" + kept.get((u[1], u[5], u[3][depth]), "*")
    for u in urls:
        u[5] += "/**" if len(u[3]) > max_depth else ""
    count, hosts = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for u in urls:
        if u[4] is not None:
            for c in (count[u[1], u[5]], hosts[u[1]], hosts[None]):
                c[0] += 1
                c[1] += u[4]
    prior = (hosts[None][1] + 1) / (hosts[None][0] + 2)
    out = []
    for page, host, path, _, _, tmpl in urls:
        n, good = hosts[host]
        mine = (good + 5 * prior) / (n + 5)
        n, good = count[host, tmpl]
        rule, verdict = ruled(host, path, rules)
        out.append((page, host, path, rule, verdict or ("block" if (good + 5 * mine) / (n + 5) < 0.5 else "allow"), tmpl))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict", "template").collect()), key=str)


def frames(spark, rows):
    return (spark.createDataFrame([r[:2] for r in rows], "page_id long, url string"),
            spark.createDataFrame([(r[0], r[2]) for r in rows if r[2] is not None], "page_id long, good int"))


def test_templates_merging_and_purity(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        kind = rng.choice(["en", "de", "tag", "spam"])
        deep = f"/{rng.randrange(10**6)}" if kind != "tag" else ""
        rows.append((i, f"http{rng.choice(['', 's'])}://A.net/{kind}{deep}{rng.choice(['', '/', '?q=/x', '#a/b'])}", rng.choice([None, int(rng.random() < (0.1 if kind == "spam" else 0.95))])))
    rows += [(4000 + i, f"https://b.net/{i}/x/y/{i}", i % 2) for i in range(200)]
    out = got(UF.judge(*frames(spark, rows)))
    assert out == brute(rows)
    tmpl = {(r[1], r[5]): r[4] for r in out}
    assert tmpl["a.net", "/~00/*"] == "block" and tmpl["a.net", "/~40/*"] == "allow"  # ids vary; en and de are alike, tag has another shape
    assert tmpl["a.net", "/~43"] == "allow"


def test_hot_host_and_deep_paths(spark):
    rows = [(i, f"http://hot.net/p{i}/" + "/".join(str(i % 7) for _ in range(i % 12)), i % 3 and 1) for i in range(600)] + [(700, "http://deep.net/" + "a/" * 5000, 0)] * 2
    out = got(UF.judge(*frames(spark, rows)))
    assert len(out) == 602 and {r[5] for r in out if r[0] == 700} == {"/*" * 8 + "/**"}
    assert [r[:4] for r in out] == [r[:4] for r in brute(rows)]


def test_rules(spark):
    urls = ["http://a.example.org/en/12", "http://example.org/es/", "http://xexample.org/es/9", "http://org/x", "http://o.org", "http://COM/fr/1", "https://w.com/de/2?x",
            "http://w.com/dex", "ftp://x.com:80/de/", "http://example.org/en/2", "http://net/", "http://e.org/en/1"]
    rows = [(i, u, None) for i, u in enumerate(urls)]
    out = got(UF.judge(frames(spark, rows)[0]))
    assert out == brute(rows)
    assert {urls[r[0]]: (r[3], r[4]) for r in out}["http://a.example.org/en/12"] == ("example.org/en/1", "block")
    same = [("allow", "b.c/de"), ("block", "a.b.c/")]  # equally long: the longer host wins
    assert got(UF.judge(spark.createDataFrame([(1, "x://a.b.c/de")], "page_id long, url string"), rules=same))[0][3:5] == ("a.b.c/", "block")


def test_nulls_ties_long_urls_and_extra_columns(spark):
    long = "http://l.net/" + "q" * 1_000_000
    rows = [(1, None, 1), (2, "", 0), (3, "no scheme/de/", None), (4, "://", 0), (5, "a://b\n.net/x\ny?z://", 1), (None, "http://n.net/*/1", None), (None, "http://n.net/*/1", None),
            (6, long, 0), (7, "http://a://b/c", None), (8, "http://É.net/de#/", None), (9, "http://x.net?/a", 1), *((20, "http://same.net/en/1", 0),) * 30]
    pages, labels = frames(spark, rows)
    labels = labels.unionByName(spark.createDataFrame([(9, None), (None, 1), (2, 7)], "page_id long, good int"))
    assert got(UF.judge(pages, labels)) == brute(rows)
    more = pages.selectExpr("*", "1 AS host", "2 AS path", "3 AS template", "4 AS good", "'k' AS kept", "5 AS segments", "6 AS labelled_id")
    assert got(UF.judge(more.repartition(3), labels)) == brute(rows)
    assert UF.judge(pages.limit(0), labels).collect() == [] and len(got(UF.judge(pages, labels.limit(0)))) == len(rows)


def test_table(spark):
    pages, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("pages", "labels"))
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = []
    for r in pages.collect():
        number = re.search(r"([0-9]+)[^0-9]*$", parts(r.url)[1])
        rows.append((r.page_id, r.url, quality.get(int(number[1])) if number else None))
    assert got(UF.judge(pages, UF.page_labels(pages, labels))) == brute(rows)
