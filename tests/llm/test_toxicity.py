import math
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tessera.llm import toxicity as T
from tessera.llm.words import chunks

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = {r.doc_id: r for r in T.toxicity(docs, labels).collect()}
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for d, r in out.items())
    held = [(r.toxic == 1, out[r.doc_id].predicted == 1) for r in labels.collect() if out[r.doc_id].held_out]
    hit = sum(a and b for a, b in held)
    assert np.mean([a == b for a, b in held]) > 0.96
    assert hit > 0.9 * sum(b for _, b in held) and hit > 0.8 * sum(a for a, _ in held)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "### 12"), (4, "a " * 60_000), (4, "a " * 60_000), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "'x' AS toxic")
    for labels in ([], [(4, 1, 1), (2, 0, 0), (None, 1, 1), (1, 1, None)], [(i, 0, i % 2) for i in range(5)]):
        got = T.toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert not [r.held_out for r in got if r.doc_id is None][0]
    assert T.toxicity(docs.limit(0), spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")).count() == 0


def spell(text):
    return ["\1" + w + "\2" for w in "".join(ch.lower() if ch.isalpha() or ch == " " else "" for ch in text).split()]


def orders(grams):
    """The shared probability of a gram's last byte after the rest of it, for all endings of ``grams``."""
    before = defaultdict(set)
    for g in grams:
        for i in range(1, len(g)):
            before[g[i:]].add(g[i - 1])

    def p(g):
        same = {x: len(v) for x, v in before.items() if len(x) == len(g) and x[:-1] == g[:-1]}
        if len(g) == 1:
            return same[g] / sum(same.values())
        return (same[g] - T.DISCOUNT + T.DISCOUNT * len(same) * p(g[1:])) / sum(same.values())

    return p


def kneser_ney(counts, lower):
    """The log ratio of (context, next), by plain counts of (context, next): [toxic, ordinary]."""
    context = defaultdict(lambda: [0, 0, 0, 0])
    for (h, _), (a, b) in counts.items():
        for i, x in enumerate((a, b, a > 0, b > 0)):
            context[h][i] += x

    def ratio(h, y):
        if h not in context:
            return 0.0
        a, b, ta, tb = context[h]
        la, lb = (T.DISCOUNT * ta + 1) / (a + 1), (T.DISCOUNT * tb + 1) / (b + 1)
        if (h, y) not in counts:
            return math.log(la) - math.log(lb)
        x, z = counts[h, y]
        s = lower(h, y)
        return math.log(max(x - T.DISCOUNT, 0) / (a + 1) + la * s) - math.log(max(z - T.DISCOUNT, 0) / (b + 1) + lb * s)

    return ratio


def test_models_against_plain_counts(spark):
    """All that the query's own model says of words and pairs, grams of single documents included."""
    texts = ["idiot idiots! the idiom", "The idiot, theme", "the them idea", "theme a the idol idea", "a IDOL of the them", "the", None]
    toxic = [1, 1, 0, 0, 0, 1, 1]
    df = spark.createDataFrame(list(zip(texts, toxic)), "text string, toxic int")
    model = T.Model(*T.spelling(df), np.zeros(len(T.MEASURES) + 1), *T.pair_model(df))
    grams, pairs, n = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0]), T.ORDER
    for t, label in zip(texts, toxic):
        words = spell(t or "")
        for w in set(words):
            for i in range(1, len(w)):
                grams[w[max(0, i - n + 1):i], w[i]][1 - label] += 1
        for pair in set(zip([None, *words], words)):
            pairs[pair][1 - label] += 1
    p = orders([h + y for h, y in grams])
    byte = kneser_ney(grams, lambda h, y: p((h + y)[1:]))
    times = Counter(w for _, w in pairs)
    word = kneser_ney(pairs, lambda h, y: times[y] / len(pairs))
    probes = ["IDIOT's idol", "", "theme idiotic unseen the idol", "the them", "zzz"]
    (c,) = chunks(pa.array(probes))
    c = T.plain(c)
    want = [sum(byte(w[max(0, i - n + 1):i], w[i]) for i in range(1, len(w))) for t in probes for w in spell(t)]
    assert np.allclose(model.words(c), want, atol=1e-4)
    after = [word(h, y) for t in probes for h, y in zip([None, *spell(t)], spell(t))]
    assert np.allclose(model.followed(c), after, atol=1e-4)
    assert want[0] > 0 > want[2] and any(after)


def test_orders_against_plain_orders(spark):
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("aabc "), 60)) + " abacabacaba \u00e9t\u00e9 \u4e16\u754c\u4e16\u754c" for _ in range(6)]
    (c,) = chunks(pa.array(texts))
    packed = np.unique(T.count(c, np.zeros(6, bool))[2])
    grams = {int(x): int(x).to_bytes(8, "big", signed=True).lstrip(b"\0") for x in packed}
    p = orders(list(grams.values()))
    got = {r.packed: r.lower for r in T.lower_orders(spark.createDataFrame([(int(x),) for x in packed], "packed long")).collect()}
    assert max(map(len, grams.values())) == 8 and min(grams) < 0 and set(got) == set(grams)
    assert all(abs(got[x] - p(g[1:])) < 1e-9 for x, g in grams.items())


def test_label_sample(spark):
    rows = [(i, i % 3 == 0) for i in range(900)]
    labels = spark.createDataFrame([(i, int(t)) for i, t in rows] + [(None, 1), (5, None), (6, 7)], "doc_id long, toxic int")
    order = {r.doc_id: r.h for r in labels.where("doc_id is not null").selectExpr("doc_id", "xxhash64(doc_id, 4) AS h").distinct().collect()}
    got = T.label_sample(labels, 50).collect()
    for label in (0, 1):
        of = sorted((i for i, t in rows if t == label and zlib.crc32(str(i).encode()) % 5), key=order.get)
        assert sorted(r.doc_id for r in got if r.toxic == label) == sorted(of[:50])
    assert all(r.fold == zlib.crc32(str(r.doc_id).encode()) % 5 for r in got)


def fitted(spark, toxic, ordinary):
    """A model of many documents of filler, and the given texts among those counted."""
    fold = [zlib.crc32(str(i).encode()) % 5 for i in range(400)]
    filler = ["the tree is green", "a river runs far", "we walk the long road", "rain falls on the hill"]
    rows = [(i, filler[i % 4] + " " + filler[i // 4 % 4], i % 2) for i in range(400)]
    for texts, label in ((toxic, 1), (ordinary, 0)):
        free = iter([i for i in range(400) if i % 2 == label and 0 < fold[i] < 4])
        for text in texts:
            i = next(free)
            rows[i] = (i, text, label)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return T.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))


def test_single_documents_and_phrases_count(spark):
    model = fitted(spark, ["you zorkful grumph", *["road green %s" % w for w in ("the", "far", "hill")]], ["far green hill", "road far tree", "zebra crossing"])
    (probe,) = chunks(pa.array(["zorkful", "zebra", "qqq"]))
    once = model.words(T.plain(probe))
    assert once[0] > 0.5 and once[1] < -0.5
    (probe,) = chunks(pa.array(["road green", "road far"]))
    after = model.followed(T.plain(probe))
    assert after[1] > 0.5 > 0 > after[3]


def test_models_leave_no_shuffle_files(spark):
    """The shuffle files of all steps stayed until the driver collected garbage, over four times the input on disk."""
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        files = manager.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle")}
    rows = [("the idiot theme %d" % i, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "text string, toxic int")
    before = shuffles()
    T.spelling(df)
    for _ in range(50):
        if shuffles() <= before:
            break
        time.sleep(0.2)
    assert shuffles() <= before
