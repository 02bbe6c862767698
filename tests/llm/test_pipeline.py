"""Every stage against a plain version of it, each on its own input."""
from collections import Counter

import sentencepiece as library
from test_dartminhash import classes
from test_line_dedup import brute as similar_lines
from test_mixing import brute as mix_of

import corpus_pipeline as P
from tessera.llm import importance, mixing, sentencepiece

SF = "/root/testdata/sf0.01"


def key(r):
    return (r.doc_id is None, r.doc_id or 0)


def test_stages(spark):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "line dedup", "MinHash near-dedup", "mixing sources to target weights", "SentencePiece encoding and decoding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stage = dict(P.STAGES)
    rows = docs.collect()

    good = stage["quality classifier"](spark, docs, SF)
    assert good.columns == docs.columns
    chosen = {r.doc_id for r in importance.resample(docs, labels)[0].where("selected").select("doc_id").collect()}
    one = sorted(good.collect(), key=key)
    assert [r.doc_id for r in one] == sorted(chosen) and set(one) <= set(rows) and 0 < len(one) < len(rows)

    docs = spark.createDataFrame(one, docs.schema)
    gone = similar_lines([(r.doc_id, r.text) for r in one])
    want = {}
    for r in one:
        lines = [x for i, x in enumerate(r.text.split("\n")) if i not in set(gone[r.doc_id, r.text])]
        if not gone[r.doc_id, r.text] or " ".join(lines).split():
            want[r.doc_id] = "\n".join(lines)
    two = sorted(stage["line dedup"](spark, docs, SF).collect(), key=key)
    assert {r.doc_id: r.text for r in two} == want and all(r.n_chars == len(r.text) for r in two) and len(two) <= len(one)

    docs = spark.createDataFrame(two, docs.schema)
    three = sorted(stage["MinHash near-dedup"](spark, docs, SF).collect(), key=key)
    heads = {c for _, c in classes([(r.doc_id, r.text) for r in two])}
    assert [key(r) for r in three] == sorted(heads) and set(three) <= set(two)

    docs = spark.createDataFrame(three, docs.schema)
    four = stage["mixing sources to target weights"](spark, docs, SF).collect()
    quality = {r.doc_id: mixing.LABEL_WEIGHTS[r.quality] for r in labels.collect()}
    taken = {d: t // n for d, n, _, _, t in mix_of([(r.doc_id, r.text, r.source) for r in three], quality) if t}
    assert Counter(r.doc_id for r in four) == taken and set(four) <= set(three)

    docs = spark.createDataFrame(four, docs.schema)
    five = stage["SentencePiece encoding and decoding"](spark, docs, SF).collect()
    encode = library.SentencePieceProcessor(model_file=sentencepiece.MODEL).encode
    text = {r.doc_id: r.text for r in four}
    assert Counter(r.doc_id for r in five) == Counter(r.doc_id for r in four)
    assert all(r.round_trip and r.decoded == text[r.doc_id] and r.ids == encode(text[r.doc_id]) and r.n_ids == len(r.ids) for r in five)


def test_run_and_empty(spark, tmp_path):
    out = P.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "lang", "source", "ids", "n_ids", "round_trip", "decoded"]
    assert out.where("NOT round_trip").count() == 0 and out.count() > 0
    for name in ("documents", "labels"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_repeated_rows_and_nulls(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (None, None, None, None, None), (2, "", "en", None, 0), (None, text, None, "a", None)]
    for _, stage in P.STAGES:
        got = stage(spark, spark.createDataFrame(rows, schema), "/root/testdata/sf0.001")
        assert got.count() <= 3 * len(rows)
