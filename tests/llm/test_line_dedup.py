import random
import re
import time

from pyspark.sql import functions as F

from tessera.llm import line_dedup as L
from tessera.session import CLEANUP_CONF

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def brute(rows, threshold=0.8):
    """removed line numbers by row, from all earlier lines."""
    docs = sorted({(d is None, d or 0, t) for d, t in rows if t is not None})
    seen, out = [], {}
    for none, d, t in docs:
        gone = []
        for i, line in enumerate(t.split("\n")):
            s = {w for w in SPACES.split(line.lower()) if w}
            if not s:
                continue
            if any(len(s & o) >= threshold * len(s | o) - 1e-9 for o in seen if min(len(s), len(o)) >= threshold * max(len(s), len(o)) - 1e-9):
                gone.append(i)
            seen.append(s)
        out[None if none else d, t] = gone
    return out


def got(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, sorted(r.removed)) for r in df.collect())


def want(rows):
    return sorted((d is None, d or 0, len(t.split("\n")), sorted(x)) for (d, t), x in brute(rows).items())


def test_table_lines(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(L.line_verdicts(docs)) == want(rows)


def test_random_lines(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(60):
        text = "\n".join(" ".join(rng.sample(vocabulary[: rng.choice((6, 12, 60))], rng.choice((1, 4, 5, 6)))) for _ in range(rng.randint(1, 6)))
        rows.append((d, text))
    for d in range(60, 80):
        base = rows[rng.randrange(60)][1].split("\n")[0].split(" ") + ["A", "b", "C", "d", "E"]
        base[rng.randrange(len(base))] = "z"
        rows.append((d, " ".join(base) + "\n\n \t\n" + " ".join(reversed(base)).upper()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(L.line_verdicts(docs)) == want(rows)


def test_edges(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [(2, None), (3, ""), (1, "a b\n\na b"), (4, "A  b\nx"), (5, long), (6, long + " more"), (7, "p q"), (7, "p q"), (None, "p q"), (None, None), (9, "\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS line_no", "'x' AS c", "text AS tokens", "7 AS n_chars")
    assert got(L.line_verdicts(docs)) == want(rows)
    kept = L.drop_lines(docs)
    assert kept.columns == docs.columns
    out = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.n_chars) for r in kept.collect())
    assert out == sorted([(False, 2, "", 7), (False, 3, "", 7), (False, 1, "a b\n", 4), (False, 4, "x", 1), (False, 5, long, 7),
                          (False, 7, "p q", 7), (False, 7, "p q", 7), (True, 0, "", 7), (False, 9, "\n\n", 7)])
    assert L.line_verdicts(docs.limit(0)).count() == 0 and L.drop_lines(docs.limit(0)).count() == 0


def test_tables_leave_no_shuffle_files(spark):
    """Files of earlier shuffles stayed until the driver collected garbage, several times the input on disk."""
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    kept = spark.conf.get(CLEANUP_CONF, None)

    def shuffles():
        files = manager.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle")}
    before = shuffles()
    out = L.written(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count(), "t")
    for _ in range(50):
        if shuffles() <= before:
            break
        time.sleep(0.2)
    assert shuffles() <= before and out.count() == 700
    assert spark.conf.get(CLEANUP_CONF, None) == kept


def test_maps_of_halves_rule_out_pairs(spark):
    """Sets whose words' bits agree but lie in other halves: the map of all words can't tell them apart."""
    rows = [(1, 6, 0b111111, 0), (2, 6, 0, 0b111111), (3, 6, 0b111111, 0)]
    classes = spark.createDataFrame(rows, "c long, n int, even long, odd long")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long")
    assert [tuple(r) for r in L._close(pairs, classes, 0.8).collect()] == [(1, 3)]


def test_pairs_are_joined_in_parts(spark, monkeypatch):
    """Every word's entries were dealt at once: with the tables beside them, over three times the input on disk."""
    rng = random.Random(4)
    rows = [(d, "\n".join(" ".join(rng.sample([f"w{i}" for i in range(40)], rng.choice((4, 5, 6)))) for _ in range(4))) for d in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    entries, dealt = L._entries, []

    def seen(classes, part):
        out = entries(classes, part)
        dealt.append((part, {r.token for r in out.select("token").distinct().collect()}))
        return out
    monkeypatch.setattr(L, "_entries", seen)
    assert got(L.line_verdicts(docs)) == want(rows)
    first, second = dealt[:L.PARTS], dealt[L.PARTS:]
    assert first == second and len(first) == L.PARTS > 1
    assert all(0 < len(t) < 40 / 2 for _, t in first) and sum(len(t) for _, t in first) == len(set().union(*(t for _, t in first)))


def test_joins_rule_out_pairs_of_long_lines(spark, monkeypatch):
    """One map of all words is full for long lines: each two of them that share a rare word were written as a pair."""
    rng = random.Random(5)
    rows = [(d, " ".join([f"rare{d % 5}", *(f"w{i}" for i in rng.sample(range(3000), 150))])) for d in range(100)]
    rows += [(100 + d, rows[d][1] + " more") for d in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    written, sizes = L.written, {}

    def seen(df, name, *more):
        out = written(df, name, *more)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out
    monkeypatch.setattr(L, "written", seen)
    assert got(L.line_verdicts(docs)) == want(rows)
    assert 3 <= sizes["pairs"] < 30


def test_texts_are_split_once(spark, monkeypatch):
    """Words were split to be counted, again for the sets, and again for each table of sets to compare."""
    words, calls = L.words, []
    monkeypatch.setattr(L, "words", lambda text: calls.append(1) or words(text))
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "f e d c b a g\nx"), (4, "y")]
    assert got(L.line_verdicts(spark.createDataFrame(rows, "doc_id long, text string"))) == want(rows)
    assert len(calls) == 1


def test_driver_keeps_short_plan_texts(spark):
    """The text of a plan holds its literals: the rarity table stood in those of all executions that the driver kept."""
    from tessera.session import PLAN_CHARS, PLAN_CONF
    kept = spark.conf.get(PLAN_CONF, None)
    out = L.written(spark.range(3).select("id", F.lit("x" * 500_000).alias("s")).where(F.length("s") > F.col("id")), "t")
    assert out.count() == 3 and spark.conf.get(PLAN_CONF, None) == kept
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    executions = spark._jsparkSession.sharedState().statusStore().executionsList()
    texts = [executions.apply(i).physicalPlanDescription() for i in range(max(0, executions.size() - 3), executions.size())]
    assert any("InsertIntoHadoopFsRelationCommand" in x for x in texts)
    assert all(len(x) <= int(PLAN_CHARS) + 200 for x in texts if "InsertIntoHadoopFsRelationCommand" in x)
