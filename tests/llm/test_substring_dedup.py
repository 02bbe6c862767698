import hashlib
import random
import re

import pytest

from tessera.llm import substring_dedup as S
from tessera.llm.automaton import SuffixAutomaton

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    first = {}
    split = [(d is None, d or 0, WORD.findall(t or "")) for d, t in rows]
    for none, d, w in split:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, (none, d, i)), (none, d, i))
    out = []
    for (doc, _), (none, d, w) in zip(rows, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (none, d, i):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc is None, doc or 0, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_automaton_against_search():
    rng = random.Random(2)
    for _ in range(60):
        texts = [[rng.choice("abc") for _ in range(rng.randint(0, 25))] for _ in range(4)]
        a = SuffixAutomaton()
        for i, t in enumerate(texts):
            a.add(i, t)
        for t in texts + [[rng.choice("abcd") for _ in range(20)]]:
            want = []
            for end in range(4, len(t) + 1):
                hit = next(((i, e) for i, o in enumerate(texts) for e in range(4, len(o) + 1) if o[e - 4:e] == t[end - 4:end]), None)
                if hit:
                    want.append((end, hit))
            assert list(a.matches(t, 4)) == want


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    assert got(S.dedup_substrings(docs, digest=True)) == want and sum(x[3] for x in want) > 0
    texts = {r.doc_id: r.text for r in S.dedup_substrings(docs).collect()}
    assert sorted(hashlib.sha256(t.encode()).hexdigest() for t in texts.values()) == sorted(x[4] for x in want)


def passages(seed, n=60):
    rng = random.Random(seed)
    shared = [" ".join(rng.choice("abcdefgh") * 2 + rng.choice("xyz") for _ in range(rng.randint(10, 45))) for _ in range(6)]
    rows = []
    for d in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.6 else " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 5))]
        rows.append((rng.randrange(n), rng.choice((" ", "\n", "\t \n")).join(parts)))
    return rows


@pytest.mark.parametrize("most, firsts", [(1024, 0), (3, 300_000), (3, 0)])
def test_passages(spark, monkeypatch, most, firsts):
    monkeypatch.setattr(S, "MAX_GROUP", most)
    monkeypatch.setattr(S, "MAX_FIRSTS", firsts)
    rows = [*passages(4), (None, passages(4)[0][1]), (None, passages(4)[3][1] + " tail")]
    assert got(S.dedup_substrings(frame(spark, rows), digest=True)) == brute(rows)


def test_first_places_with_equal_hashes():
    import numpy as np
    u = np.array
    f = S.Firsts(u([5, 5, 7]), u([1, 2, 3]), u([False, False, True]), u([10, 20, 0]), u([0, 4, 6]))
    asked = [(5, 1, False, 10, 0), (5, 1, False, 10, 1), (5, 2, False, 20, 5), (5, 2, False, 3, 9), (5, 3, False, 99, 9), (7, 3, True, 0, 7), (7, 3, False, 1, 0), (5, 1, True, 0, 0), (9, 9, False, 0, 0)]
    assert f.later(*(u(x) for x in zip(*asked))).tolist() == [False, True, True, False, False, True, False, True, False]
    assert not S.Firsts(*(u([], int),) * 2, u([], bool), *(u([], int),) * 2).later(*(u(x) for x in zip(*asked))).any()


def test_edges(spark):
    run = " ".join(f"w{i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, "a " * 50_000), (4, run), (4, run), (5, run + " " + run), (None, run), (None, None), (6, " ".join(run.split()[:20])), (7, " ".join(run.split()[:19]))]
    docs = frame(spark, rows).selectExpr("*", "'x' AS key", "1 AS pos", "text AS packed", "2 AS n_words")
    assert got(S.dedup_substrings(docs, digest=True)) == brute(rows)
    assert S.dedup_substrings(docs.limit(0)).count() == 0
