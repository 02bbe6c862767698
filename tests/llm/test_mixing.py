import math
import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, total, free = {}, float(sum(sizes.values())), list(names)
    while free:
        level = (total - sum(out.values())) / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] >= cap * sizes[s]]
        if not over:
            return out | {s: level * w[s] for s in free}
        out |= {s: float(cap * sizes[s]) for s in over}
        free = [s for s in free if s not in over]
    return out


def brute(rows, quality):
    """(doc_id, size, source_size, target, taken) by one sort of each source."""
    docs = [(d, len(WORD.findall(t or "")), s) for d, t, s in rows]
    sizes = Counter()
    for _, n, s in docs:
        sizes[s] += n
    target, out = targets(sizes), []
    for source in sizes:
        keyed = []
        for d, n, s in docs:
            if s == source:
                u = (int(hashlib.md5(f"mix:{'' if d is None else d}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                keyed.append((-math.log(u) / quality.get(d, 2.0), d is not None, d or 0, n, d))
        at = 0
        for _, _, _, n, d in sorted(keyed):
            at += n
            epochs = int(target[source] / sizes[source]) if sizes[source] else 0
            rest = target[source] - epochs * sizes[source]
            out.append((d, n, sizes[source], target[source], min(3, epochs + (n > 0 and at - n / 2 < rest)) * n))
    return sorted(out, key=str)


def check(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=str), want):
        assert a[:3] == b[:3] and a[4] == b[4] and abs(a[3] - b[3]) < 1e-6 * max(1, b[3])


FIELDS = ["doc_id", "size", "source_size", "target", "taken"]


@pytest.mark.parametrize("rows_per_bin", [2000, 5])
def test_table(spark, monkeypatch, rows_per_bin):
    monkeypatch.setattr(M, "ROWS_PER_BIN", rows_per_bin)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    got = [tuple(r) for r in M.mix(docs, M.label_weights(docs, labels)).select(*FIELDS).collect()]
    check(got, brute(rows, {r.doc_id: 4.0 if r.quality == 1 else 1.0 for r in labels.collect()}))
    by = defaultdict(lambda: [0, 0.0, 0])
    source = {d: s for d, _, s in rows}
    for d, n, _, t, taken in got:
        x = by[source[d]]
        by[source[d]] = [x[0] + taken, t, max(x[2], n)]
    assert all(abs(taken - t) <= most / 2 + 1e-6 for taken, t, most in by.values())


def test_edges(spark):
    rows = [(1, None, "b"), (2, "", "a"), (3, "x y", None), (4, "a " * 50_000, "c"), (5, "q w e", "a"), (5, "q w e", "a"), (None, "n n", "a"), (6, "\t", "empty"), (7, "é ß", "é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "'x' AS target", "2 AS bin", "3 AS weight")
    got = [tuple(r) for r in M.mix(docs).select(*FIELDS).collect()]
    check(got, brute(rows, {d: 1.0 for d, _, _ in rows}))
    out = M.mixed(docs)
    assert out.columns == docs.columns
    counts = Counter(r.doc_id for r in out.collect())
    assert all(counts[d] * n >= taken for d, n, _, _, taken in got if n)
    assert M.mix(docs.limit(0)).count() == 0 and M.mixed(docs.limit(0)).count() == 0
    quality = spark.createDataFrame([(5, -1.0), (4, None)], "doc_id long, quality_weight double")
    assert M.mix(docs, quality).count() == len(rows)
    assert M.mix(docs.where("doc_id = 6")).agg(F.sum("taken")).first()[0] == 0


def test_weights_prefer_good_documents(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), (F.col("id") % 2).cast("string").alias("source"))
    quality = docs.select("doc_id", F.when(F.col("doc_id") % 4 < 2, 4.0).otherwise(1.0).alias("quality_weight"))
    got = M.mix(docs, quality, weights=(1.0, 3.0)).where("source = '0'").groupBy((F.col("doc_id") % 4).alias("k")).agg(F.sum("copies").alias("n")).collect()
    n = {r.k: r.n for r in got}
    # half of the source by the cut where 1000(1-e^-4x) + 1000(1-e^-x) = 1000
    assert 700 < n[0] < 860 and n[0] + n[2] == pytest.approx(1000, abs=1)
