import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tessera.llm import dartminhash as D
from tessera.llm.components import connected_components
from tessera.llm.words import chunks


def shingles(text):
    w = (text or "").split()
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def classes(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    pairs = {(a, b) for h in holders.values() for k, b in enumerate(h) for a in h[:k]}
    for a, b in pairs:
        if jaccard(sets[a], sets[b]) >= threshold:
            at[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        key = (d is None, d or 0)
        least[root(i)] = min(least.get(root(i), key), key)
    return sorted(((d is None, d or 0), least[root(i)]) for i, (d, _) in enumerate(rows))


def got(df):
    rows = df.collect()
    heads = Counter(r.class_id for r in rows if r.representative and r.class_id is not None)
    assert set(heads.values()) <= {1} and set(heads) == {r.class_id for r in rows} - {None}
    return sorted(((r.doc_id is None, r.doc_id or 0), (r.class_id is None, r.class_id or 0)) for r in rows)


def test_signatures_estimate_weighted_jaccard():
    rng = random.Random(3)
    base = [rng.choice("abcdefgh") for _ in range(400)]
    other = list(base)
    for i in range(0, 400, 40):
        other[i] = "z"
    texts = [" ".join(base), " ".join(other), " ".join(base)]
    (c,) = chunks(pa.array(texts))
    ids, doc = D.strips(c)
    sig = D.signatures(ids, doc, 3, k=4096)
    assert np.isfinite(sig).all() and (sig[0] == sig[2]).all()
    assert abs((sig[0] == sig[1]).mean() - jaccard(shingles(texts[0]), shingles(texts[1]))) < 0.03


def test_table_classes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(D.near_duplicates(docs)) == classes(rows)


def test_edges_and_chains(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    text = [word() for _ in range(200)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a b"), (6, "a b c"), (7, "x " * 9000), (8, "x " * 9100), (None, "a b"), (9, None)]
    for i in range(12):  # a chain: neighbours are near, the ends aren't
        rows.append((100 + i, " ".join(text)))
        text[i * 3 + 7] = word()
        text[i * 3 + 8] = word()
    rows += [(100, rows[10][1]), (50, rows[15][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS rid", "'x' AS node", "2 AS n_words", "3 AS s1")
    assert got(D.near_duplicates(docs)) == classes(rows)
    kept = D.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert ids == [(False, x) for x in (1, 2, 3, 4, 6, 7, 9, 50)]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert D.near_duplicates(none).count() == 0 and D.drop_near_duplicates(none).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(101, 100), (101, 102), (200, 200), (301, 300)]
    rows = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.comp for r in rows} == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100, 300: 300, 301: 300}


def test_copies_just_below_the_threshold_are_not_all_compared(spark, monkeypatch):
    """Forty copies that each differ from the text at seven words, one of them a change that others have too: every pair
    has enough in common with the text and outside it, but they miss different strips."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(base))]
    for d in range(1, 41):
        words = list(base)
        for i in rng.sample(range(3, 33), 6):
            words[i * 9] = f"u{d}"
        words[4 + 288 * (d % 2)] = "q"
        rows.append((d, " ".join(words)))
    seen, real = [], D._cross_pairs
    monkeypatch.setattr(D, "_cross_pairs", lambda *a: seen.append(real(*a)) or seen[0])
    assert got(D.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == classes(rows)
    assert seen[0].count() < 40
