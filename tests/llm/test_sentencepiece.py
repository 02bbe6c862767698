import random

import pytest
import sentencepiece as library

from tessera.llm import sentencepiece as S


@pytest.fixture(scope="module")
def content():
    with open(S.MODEL, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def model(content):
    return S.Transducer(content)


@pytest.fixture(scope="module")
def reference():
    return library.SentencePieceProcessor(model_file=S.MODEL)


def test_random_strings(model, reference):
    rng = random.Random(6)
    pieces = [p.replace(S.META, " ") for p in model.ids]
    for _ in range(4000):
        text = "".join(rng.choice((rng.choice(pieces), rng.choice(" \n\t  ab\U0001F600一é"), chr(rng.randrange(1, 0x2500)))) for _ in range(rng.randint(0, 12)))
        assert model.encode(text) == reference.encode(text)
        assert model.decode(model.encode(text)) == text


def test_batches_equal_single_texts(model, reference):
    import pyarrow as pa
    rng = random.Random(9)
    words = ["the", "then", "Größe", "日本", "", "x\ny", "a\u2581b", "\u2581", "\U0001F600", "1,5", "\t", "word" * 40]
    texts = [None, "", " ", "a", " a", "a ", "a  b", "a b", *("".join(rng.choice((" ", " ", " ", "  ", "")) + rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(300))]
    clean = [w for w in words if w and S.META not in w]
    texts += [" ".join(rng.choice(clean) for _ in range(rng.randint(1, 40))) + rng.choice(("", " ")) for _ in range(300)]
    rng.shuffle(texts)
    ids, decoded = model.encode_all(pa.array(texts, pa.string()))
    assert ids.to_pylist() == [None if x is None else reference.encode(x) for x in texts]
    assert decoded.to_pylist() == [None if x is None else model.decode(reference.encode(x)) for x in texts]
    assert 250 < sum(model.plain(pa.array(texts, pa.string())).to_pylist()) < 600  # both ways were taken
    for some in ([], [None], [""], ["a b"]):
        assert model.encode_all(pa.array(some, pa.string()))[0].to_pylist() == [None if x is None else reference.encode(x) for x in some]


def test_spaces_and_long_parts(model, reference):
    for text in ("", " ", "  ", "\n", " " * 40 + "a", "a" + " " * 33 + "b  c", "ab" * 3000, "é" * 2000 + "日本" * 500, " lead", "tail  "):
        assert model.encode(text) == reference.encode(text)
        assert model.decode(model.encode(text)) == text


def test_small_cache_gives_the_same(content, model, monkeypatch):
    monkeypatch.setattr(S, "CACHE", 3)
    monkeypatch.setattr(S, "PAIRS", 3)
    small = S.Transducer(content)
    text = "the thing then thinks there is a thing there and the thing thanks then"
    assert small.encode(text) == model.encode(text) and len(small._young) <= 5


def test_known_words_keep_ids_only(content, reference):
    """Each known word had a list of its own, a pair and its spelling besides the cached part: twice the memory."""
    import pyarrow as pa
    t = S.Transducer(content)
    texts = ["the thing thinks", "a thing \u2047 \x01", "then the thing"]
    for _ in range(2):
        ids, decoded = t.encode_all(pa.array(texts, pa.string()))
        assert ids.to_pylist() == [reference.encode(x) for x in texts] and decoded.to_pylist() == texts
    assert len(t._known) == 7 and all(t._known[w] is t._young[S.META + w] for w in ("the", "thing", "thinks", "a", "then"))
    assert not t._respelled


def field(number, value):
    head = bytes([number << 3 | 2, len(value)]) if isinstance(value, bytes) else bytes([number << 3, value])
    return head + (value if isinstance(value, bytes) else b"")


def test_unigram_shortest_path():
    import itertools
    import struct
    pieces = [("<unk>", 0.0, S.UNKNOWN), ("▁", -2.0, 1), ("a", -1.5, 1), ("b", -1.6, 1), ("ab", -2.5, 1), ("aba", -4.2, 1), ("▁a", -1.1, 1), ("ba", -2.2, 1)]
    data = b"".join(field(1, field(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", s) + field(3, k)) for p, s, k in pieces)
    t = S.Transducer(data + field(2, field(3, S.UNIGRAM)) + field(3, field(3, 1) + field(4, 1)))
    score = {p: s for p, s, k in pieces if k == 1}

    def brute(text):
        best = None
        for cuts in itertools.product((0, 1), repeat=len(text) - 1):
            at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(text)]
            parts = [text[x:y] for x, y in zip(at, at[1:])]
            if all(p in score for p in parts):
                best = max(best or (-1e9,), (sum(score[p] for p in parts), parts))
        return best
    for n in range(1, 7):
        for text in map("".join, itertools.product("ab", repeat=n)):
            got = t.encode(text)
            assert abs(sum(t.scores[i] for i in got) - brute("▁" + text)[0]) < 1e-5
            assert t.decode(got) == text
    assert t.encode("  a  b ") == t.encode("a b") and t.encode("axxb").count(0) == 1


def test_table(spark, content, reference):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    out = S.encode(docs, content)
    rows = out.collect()
    assert len(rows) == len(texts)
    assert all(r.round_trip and r.ids == reference.encode(texts[r.doc_id]) and r.n_ids == len(r.ids) for r in rows)
    assert {r.doc_id: r.text for r in S.decode(out, content).collect()} == texts == {r.doc_id: r.decoded for r in rows}


def test_edges(spark, content):
    rows = [(1, None), (2, ""), (3, "x " * 60_000), (3, "x " * 60_000), (None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "'x' AS n_ids")
    got = S.encode(docs, content).collect()
    assert sorted((r.doc_id or 0, r.ids is None, r.n_ids > 0) for r in got) == [(0, False, True), (1, True, False), (2, False, False), (3, False, True), (3, False, True)]
    assert sorted((r.text is None, r.text or "") for r in S.decode(S.encode(docs, content), content).collect()) == sorted((t is None, t or "") for _, t in rows)
    assert S.encode(docs.limit(0), content).count() == 0
    odd = docs.selectExpr("*", "'l' AS lang")
    assert S.encode(odd, content, ["lang"]).columns == ["doc_id", "lang", "ids", "n_ids", "round_trip", "decoded"]
