"""Resampling towards a target against plain Python."""
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import target_sampling as T

SF = "/root/testdata/sf0.01"
UPPER = {c: c + 32 for c in range(65, 91)}


def runs(text, max_run):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    return words, [" ".join(words[i:i + k]) for k in range(1, max_run + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, max_run, percent=10, least=20, seed=2024):
    slot = lambda f: zlib.crc32(f.encode()) % T.BUCKETS
    raw = Counter(slot(f) for _, text in docs for f in runs(text, max_run)[1])
    good = Counter(slot(f) for text in target for f in runs(text, max_run)[1])
    s_all, t_all = sum(raw.values()) + T.BUCKETS, sum(good.values()) + T.BUCKETS
    gain = [math.floor(1000 * math.log((good[b] + 1) * s_all / ((raw[b] + 1) * t_all))) for b in range(T.BUCKETS)]
    rows = []
    for i, text in docs:
        words, found = runs(text, max_run)
        weight = sum(gain[slot(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    enough = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for at, r in enumerate(enough[:percent * len(enough) // 100]):
        r[4] = at + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_registers_are_crc32():
    words = [b"", b"a", "größe".encode(), b"x" * 64, b"y" * 65, b"z" * 5000, b"tail"]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    first = T.advance(np.full(len(words), T.START), data, starts, ends)
    assert [int(x ^ T.START) for x in first] == [zlib.crc32(w) for w in words]
    on = T.advance(T._space(first), data, starts[::-1], ends[::-1])
    assert [int(x ^ T.START) for x in on] == [zlib.crc32(w + b" " + v) for w, v in zip(words, words[::-1])]


def test_head_is_exact():
    words = [b"the", b"of", b"sixteen-byteword", "ü".encode() * 8, b"a"]
    head = T.head_of(words)
    text = b"the them th of sixteen-byteword sixteen-byteword1 " + "ü".encode() * 8 + b" a aa"
    spans = [(m.start(), m.end()) for m in re.finditer(rb"[^ ]+", text)]
    place = head.find(np.frombuffer(text, np.uint8), *(np.array(x) for x in zip(*spans)))
    assert [p >= 0 for p in place] == [text[s:e] in words for s, e in spans]
    assert all(T.bytes_of(int(head.a[p]), int(head.b[p])) == text[s:e] for p, (s, e) in zip(place, spans) if p >= 0)


@pytest.mark.parametrize("max_run, n_words, n_pairs", [(1, 4096, 0), (1, 0, 0), (1, 7, 0), (2, 50, 200), (2, 3, 2), (3, 50, 200), (3, 0, 0)])
def test_against_plain_python(spark, max_run, n_words, n_pairs):
    docs, target = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], max_run)
    assert got(T.resample(docs, target, max_run, n_words=n_words, n_pairs=n_pairs)) == want


def test_frequent_pairs_are_looked_up(spark):
    texts = spark.createDataFrame([("The cat. the CAT; the dog",), (None,), ("cat the cat",)], "text string")
    head = T.vocabulary(texts, 2, 3, 2)
    words = [T.bytes_of(int(a), int(b)) for a, b in zip(head.a, head.b)]
    assert set(words) == {b"the", b"cat", b"dog"} and len(head.pair) == 2
    assert {words[p // 3] + b" " + words[p % 3] for p in head.pair.tolist()} >= {b"the cat", b"cat the"}
    for c in T.chunks(pa.array(["THE CAT the dog"]), space=T.GAP):
        want = [zlib.crc32(x) % T.BUCKETS for x in (b"the", b"cat", b"the", b"dog", b"the cat", b"cat the", b"the dog")]
        assert T.features(c, head, 2)[1].tolist() == want


def test_most_frequent_is_bounded(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([5, 4, 4, 3, 3, 3, 1])], "i int, n long")
    for k, want in ((0, 0), (1, 1), (2, 1), (3, 3), (5, 3), (6, 6), (7, 7), (9, 7)):
        rows = T.most_frequent(df, k, "t")
        assert len(rows) == want and len(rows) <= k and {r.i for r in rows} == set(range(want))


def test_nulls_ties_long_texts_and_extra_columns(spark):
    long = "wörd " * 100_000 + "x" * 3_000_000
    rows = [(1, None), (2, ""), (3, "..."), (4, "A b"), (None, "one two " * 10), (None, "one two " * 10), (5, "three " * 19), (6, long), (7, "\x00a\x7fb"),
            *((8, "same words " * 10) for _ in range(12)), *((i, "other words " * 12) for i in range(20, 30))]
    target = ["one two three", None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for max_run in (1, 2):
        assert got(T.resample(docs, goal, max_run, percent=50)) == brute(rows, target, max_run, percent=50)
    more = docs.selectExpr("*", "1 AS weight", "'x' AS score", "2 AS rank", "3 AS n_words", "4 AS tie", "5 AS bucket")
    assert got(T.resample(more, goal)) == brute(rows, target, 1)
    assert got(T.resample(docs, goal.limit(0))) == brute(rows, [], 1)
    assert T.resample(docs.limit(0), goal).collect() == []
