import re
from collections import Counter, defaultdict

import pytest

from tessera.llm.quality_rules import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    words = WORD.findall(text or "")
    tri = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + j for i in range(len(words) - 2) if tri[tuple(words[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def folded(line):
    return tuple(re.sub(r"\d", "0", "".join(c.lower() if c.isascii() else c for c in w)) for w in WORD.findall(line))


def verdicts(rows, limit, pct=50, min_words=50):
    seen = defaultdict(set)
    for i, (_, text, host) in enumerate(rows):
        for line in (text or "").split("\n"):
            if folded(line):
                seen[host, folded(line)].add(i)
    out = []
    for _, text, host in rows:
        n, rep = brute(text)[0], brute(text)[4]
        gone = sum(len(folded(x)) for x in (text or "").split("\n") if len(seen[host, folded(x)]) > limit)
        base = n < min_words or 100 * rep > 50 * n
        out.append((base, not base and not 100 * gone > pct * n))
    return out


def check(spark, rows, limit, **extra):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(quality_rules(df.withColumns(extra), max_line_docs=limit).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    assert [tuple(r[f] for f in FIELDS) for r in got] == [brute(t) for _, t, _ in rows]
    assert [(r.base_failed, r.kept) for r in got] == verdicts(rows, limit)
    return got


def test_edges(spark):
    from pyspark.sql import functions as F
    body = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t\n", None), (4, "a b c a b c", "a"), (5, "é#é\x0bß x\n x \nx\nx", None),
            (6, body + "\nCommon  Line 12 here", "h"), (7, body + "\ncommon line 34 HERE", "h"), (8, body, "h"), (8, body, "h"),
            (9, "z " * 70_000 + "\nend", "long"), (None, body, None), (11, "x\n" * 3 + body, "a")]
    check(spark, rows, 1, rid=F.lit("clash"), host=F.lit(1), n_words=F.lit(2), h=F.lit(0))


def test_empty(spark):
    assert quality_rules(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


@pytest.mark.parametrize("limit", [2, 20])
def test_table_rows(spark, limit):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source").collect()]
    got = check(spark, rows, limit)
    assert any(r.kept for r in got) and any(r.base_failed for r in got)
