import numpy as np
import pytest

from tessera.operators import graph as G

# 1 -> 2 -> 3 -> 1 is a ring; 4 and 5 point into it; 6 is only pointed at.
LINKS = [(1, 2), (2, 3), (3, 1), (4, 1), (5, 1), (5, 4), (3, 6), (6, 3)]


def _ranks(df):
    return {r["id"]: r["rank"] for r in df.collect()}


def solved(links, source=None, vertices=(), reset=0.15):
    """Ranks from the linear system x = r + (1 - reset) A x, scaled as the operator scales them."""
    ids = sorted({v for e in links for v in e} | set(vertices))
    at = {v: i for i, v in enumerate(ids)}
    a = np.zeros((len(ids), len(ids)))
    out = {v: sum(s == v for s, _ in links) for v in ids}
    for s, d in links:
        a[at[d], at[s]] += 1 / out[s]
    r = np.full(len(ids), reset) if source is None else reset * (np.array(ids) == source)
    x = np.linalg.solve(np.eye(len(ids)) - (1 - reset) * a, r)
    return dict(zip(ids, x / x.sum() * (len(ids) if source is None else 1)))


def test_pagerank_fixed_point(spark):
    e = spark.createDataFrame(LINKS, "src long, dst long")
    got = _ranks(G.pagerank(e, tol=1e-8))
    assert got == pytest.approx(solved(LINKS), abs=1e-6)
    assert sum(got.values()) == pytest.approx(6)


def test_salted_hot_vertices_give_same_ranks(spark):
    e = spark.createDataFrame(LINKS + [(5, 2), (5, 3), (5, 6), (5, 1)], "src long, dst long")
    plain = _ranks(G.pagerank(e, tol=1e-6, max_iterations=30))
    salted = _ranks(G.pagerank(e, tol=1e-6, max_iterations=30, edge_chunk=2))  # vertex 5 spread over 3 salts
    assert salted == pytest.approx(plain, abs=1e-9)


def test_pagerank_default_tolerance_close(spark):
    e = spark.createDataFrame(LINKS, "src long, dst long")
    assert _ranks(G.pagerank(e)) == pytest.approx(solved(LINKS), abs=2e-3)


def test_hub_with_a_large_rank_settles(spark):
    """The stop test is relative above 1, so a rank of thousands ends at a tolerance below its last digits."""
    links = [(i, 1) for i in range(2, 3000)] + [(1, 2)]
    got = _ranks(G.pagerank(spark.createDataFrame(links, "src long, dst long"), tol=1e-12))
    assert got[1] == pytest.approx(solved(links)[1], rel=1e-6)


def test_personalised_static(spark):
    rel = {1: [11, 12, 13], 2: [12], 3: [14, 15], 4: [16]}
    pairs = [(u, i) for u, items in rel.items() for i in items]
    links = pairs + [(i, u) for u, i in pairs]
    got = _ranks(G.personalized_pagerank(G.bipartite_edges(spark.createDataFrame(pairs, "user long, item long")), 2, iterations=20))
    ids = sorted({v for e in links for v in e})
    x = {v: float(v == 2) for v in ids}
    for _ in range(20):
        x = {v: 0.15 * (v == 2) + 0.85 * sum(x[s] / sum(a == s for a, _ in links) for s, d in links if d == v) for v in ids}
    total = sum(x.values())
    assert got == pytest.approx({v: r / total for v, r in x.items()}, abs=1e-9)
    assert got[14] == got[16] == 0


def test_personalised_converged_with_isolated_vertex(spark):
    pairs = [(1, 21), (1, 22), (2, 22), (2, 23), (3, 25)]
    verts = spark.createDataFrame([(i,) for i in (1, 2, 3, 21, 22, 23, 24, 25)], "id long")
    got = _ranks(G.personalized_pagerank(G.bipartite_edges(spark.createDataFrame(pairs, "user long, item long")), 1, tol=1e-8, vertices=verts))
    assert got == pytest.approx(solved(pairs + [(i, u) for u, i in pairs], source=1, vertices=[24]), abs=1e-6)


def waves(links, first, tol, steps=400):
    """Plain delta propagation: ``(sums of waves, edges used by each step)``."""
    out = {}
    for s, d in links:
        out.setdefault(s, []).append(d)
    x, total, used = dict(first), dict(first), []
    while any(v > tol for v in x.values()) and len(used) < steps:
        after, n = {}, 0
        for v, mass in x.items():
            if mass > tol:
                for d in out.get(v, ()):
                    after[d] = after.get(d, 0.0) + 0.85 * mass / len(out[v])
                    n += 1
        used.append(n)
        x = after
        for v, mass in x.items():
            total[v] = total.get(v, 0.0) + mass
    return total, used


def test_only_vertices_that_gained_send(spark):
    rng = np.random.default_rng(4)
    links = [(int(s), int(d)) for s, d in zip(rng.integers(0, 300, 900), (300 * rng.random(900) ** 3).astype(int))]
    ids = {v for e in links for v in e}
    e = spark.createDataFrame(links, "src long, dst long")
    total, used = waves(links, {v: 0.15 for v in ids}, 1e-3)
    trace = []
    got = _ranks(G.pagerank(e, tol=1e-3, trace=trace))
    scale = len(ids) / sum(total.values())
    assert got == pytest.approx({v: total[v] * scale for v in ids}, abs=1e-9)
    assert trace[:len(used)] == used and not any(trace[len(used):])
    assert all(b <= a for a, b in zip(used[2:], used[3:])) and used[-1] < used[0] / 20  # fewer and fewer edges are used


def test_personalised_frontier_grows_from_the_source(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(1, 3), (100, 101), (101, 100)]
    e = spark.createDataFrame(links, "src long, dst long")
    trace = []
    got = _ranks(G.personalized_pagerank(e, 1, iterations=6, trace=trace))
    assert trace == [2, 2, 2, 2, 2, 2] and got[100] == got[101] == got[30] == 0  # two walkers, not 62 edges
    x = {1: 1.0}
    for _ in range(6):
        nxt = {1: 0.15}
        for s, d in links:
            nxt[d] = nxt.get(d, 0) + 0.85 * x.get(s, 0) / sum(a == s for a, _ in links)
        x = nxt
    assert {v: r for v, r in got.items() if r} == pytest.approx({v: r / sum(x.values()) for v, r in x.items() if r}, abs=1e-12)
    total, used = waves(links, {1: 1.0}, 1e-2)
    trace = []
    got = _ranks(G.personalized_pagerank(e, 1, tol=1e-2, trace=trace, edge_chunk=1))  # vertex 1 has two salts
    assert {v: r for v, r in got.items() if r} == pytest.approx({v: r / sum(total.values()) for v, r in total.items()}, abs=1e-12)
    assert trace[:len(used)] == used
    assert set(_ranks(G.personalized_pagerank(e, 999)).values()) == {0.0}


def test_step_moves_only_waves(spark):
    """The persisted edges are neither shuffled nor sorted again."""
    e = spark.createDataFrame(LINKS, "src long, dst long")
    verts = G.graph_vertices(e)
    we, hot = G._weighted_edges(e, verts, 2)
    assert hot is None
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = verts.selectExpr("id", "0.15D AS x", "0.15D AS acc")
        for _ in range(2):
            state = G._step(state, we, None, 0.0, 0.15, None)
        state.write.format("noop").mode("overwrite").save()
        plan = state._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        we.unpersist()
    final = plan.split("Initial Plan")[0].split("InMemoryRelation")[0]
    lines = [ln.strip(" :+-*()0123456789") for ln in plan.splitlines()]
    at = [i for i, ln in enumerate(lines) if "InMemoryTableScan" in ln or "TableCacheQueryStage" in ln]
    assert at and not any("Exchange" in lines[i - 1] or lines[i - 1].startswith("Sort") for i in at), final


def test_edges_and_users_parsing(spark):
    from frames import lines

    from tessera.sources.text import parse_edges
    edges, bad = parse_edges(lines(spark, "# a note", "12 7", "5\t9", "", "y 3", "7", "3   12 extra"))
    assert sorted((r["src"], r["dst"]) for r in edges.collect()) == [(3, 12), (5, 9), (12, 7)]
    assert sorted(r["value"] for r in bad.collect()) == ["7", "y 3"]
    users, bad = G.parse_users(lines(spark, "31,heron,Grey Heron", "44,coot", "teal", "x,swan"))
    assert sorted((r["id"], r["handle"]) for r in users.collect()) == [(31, "heron"), (44, "coot")]
    assert sorted(r["value"] for r in bad.collect()) == ["teal", "x,swan"]


def test_edge_file(spark, tmp_path):
    from tessera.sources.text import read_edges, read_lines
    (tmp_path / "e.txt").write_text("# x\n1 2\n2 3\nbroken\n")
    edges, bad = read_edges(spark, str(tmp_path / "e.txt"))
    assert edges.count() == 2 and [r.value for r in bad.collect()] == ["broken"]
    assert read_lines(spark, str(tmp_path / "e.txt")).count() == 4


def test_split_ranks_orders_both_sides(spark):
    ranks = spark.createDataFrame([(1, 0.2), (2, 0.5), (-1, 0.4), (-2, 0.1)], "id long, rank double")
    items, users = G.split_ranks(ranks, ranks["id"] > 0)
    assert [r.id for r in items.collect()] == [2, 1] and [r.id for r in users.collect()] == [-1, -2]


def test_kept_edges_are_lists(spark):
    """The loop's table has a row for many out-edges of a vertex, however they are repeated, not a row for each."""
    e = spark.createDataFrame([(1, 2 + i % 40) for i in range(120)] + [(2, 1)], "src long, dst long")
    we, _ = G._weighted_edges(e, G.graph_vertices(e), 120)
    rows = [r for r in we.collect() if r["_salt"] >= 0]
    we.unpersist()
    assert sorted((r["src"], len(r["dsts"]), r["w"]) for r in rows) == [(1, 120, 1 / 120), (2, 1, 1.0)]


def test_long_lists_are_cut(spark, monkeypatch):
    links = LINKS + [(5, 2), (5, 3), (5, 6), (5, 1)]
    e = spark.createDataFrame(links, "src long, dst long")
    monkeypatch.setattr(G, "LIST_EDGES", 2)
    assert _ranks(G.pagerank(e, tol=1e-8)) == pytest.approx(solved(links), abs=1e-6)


def test_null_ends_take_their_share(spark):
    e = spark.createDataFrame([(1, 2), (1, None), (1, None), (2, 1)], "src long, dst long")
    got = _ranks(G.pagerank(e, tol=1e-3, max_iterations=1))
    x = {1: 0.15 + 0.85 * 0.15, 2: 0.15 + 0.85 * 0.05, None: 0.85 * 0.1}
    assert got == pytest.approx({v: r * 3 / sum(x.values()) for v, r in x.items()})
