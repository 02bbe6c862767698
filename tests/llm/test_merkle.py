"""The manifest against a plain recursive one."""
import hashlib
import zlib

import pytest

from tessera.llm import merkle as M

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, more=0):
    values = (r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text)
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def level_up(level):
    return [H(*level[i:i + 2]) for i in range(0, len(level), 2)]


def levels_of(level):
    out = [level]
    while len(out[-1]) > 1:
        out.append(level_up(out[-1]))
    return out


def path(levels, i):
    """(sibling on the left?, sibling or None) of each level."""
    out = []
    for level in levels[:-1]:
        j = i ^ 1
        out.append((j < i, level[j] if j < len(level) else None))
        i >>= 1
    return out


def brute(rows):
    langs = sorted({r.lang for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r.lang == lang), key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r)))
        trees[lang] = own, levels_of([leaf_of(r) for r in own])
    top = levels_of([trees[x][1][-1][0] for x in langs])
    out = []
    for at, lang in enumerate(langs):
        own, levels = trees[lang]
        for i, r in enumerate(own):
            proof = path(levels, i) + path(top, at)
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            end = leaf_of(r, 1 if hit else 0)
            for left, other in proof:
                end = H(end) if other is None else H(other, end) if left else H(end, other)
            out.append((r.doc_id, levels[0][i], levels[-1][0], top[-1][0], H(*(s for _, s in proof if s)), end, end == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_places_are_a_postorder():
    import numpy as np
    for n in (1, 2, 3, 5, 8, 13, 64, 100):
        log = []

        def append(level, idx, log=log, n=n):
            if level:
                for child in (2 * idx, 2 * idx + 1):
                    if child << level - 1 < n:
                        append(level - 1, child)
            log.append((level, idx))
        append(M.height(n), 0)
        assert [int(M.place(np.int64(h), np.array([i]), n)[0]) for h, i in log] == list(range(len(log)))


@pytest.mark.parametrize("span", [1, 2, 3])
@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 33])
def test_rounds(spark, span, n):
    rows = [(i * 3, f"text {i}", "abcd"[i % 4 if i % 5 else 0], "s", i if i % 6 else None) for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(M.tampered(df, span)) == brute(df.collect())


def test_nulls_ties_repeats_and_extra_columns(spark):
    long = "é" * 300_000
    rows = [(1, "a", "en", "s", 1), (1, "b", "en", "s", 1), (1, "b", "en", "s", 1), (None, None, None, None, None), (None, None, None, None, None),
            (None, "x", "en", "", 2**63 - 1), (2, "", "", "", 0), (4, long, "zh", "s", len(long)), (5, "y", "Z", None, -3), (700, "t", "é", "s", 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(df.collect())
    assert got(M.tampered(df, 2)) == want
    more = df.selectExpr("*", "'k' AS key", "1 AS tree", "2 AS name", "'d' AS digest", "0 AS idx", "'l' AS leaf", "5 AS run", "text AS proof")
    assert got(M.tampered(more.repartition(3), 2)) == want
    assert M.tampered(df.limit(0)).collect() == [] and M.manifest(df.limit(0)).root() is None


def test_table_log_and_tampering(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    out = got(M.tampered(docs))
    assert out == brute(rows)
    hit = {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 == 0}
    assert {r[0] for r in out if not r[-1]} == hit and hit
    found = M.manifest(docs, span=4)
    assert found.root() == out[0][3]
    for tree in found.trees.collect():  # every place of a tree's log is taken once, roots stand last
        log = sorted(r for part in found.log for r in part.where(f"tree = {tree.tree}").select("pos", "level", "digest").collect())
        assert [r.pos for r in log] == list(range(len(log))) and log[-1].digest == tree.subroot
    proofs = found.proofs().limit(50).collect()
    assert all(M.fold(r.leaf, r.proof) == found.root() for r in proofs)
    assert not any(M.fold(M.node(r.leaf), r.proof) == found.root() for r in proofs)


def test_hot_tree_is_many_runs(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "'same' AS text", "'en' AS lang", "'s' AS source", "id AS n_chars")
    found = M.manifest(docs, span=6)
    assert len(found.log) == 3 and [part.where("root").count() for part in found.log] == [0, 0, 1]
    assert found.root() == brute(docs.collect())[0][3]
