from frames import lines

from tessera.operators.text import tokens, word_count


def test_word_count_sample(spark):
    df = lines(spark, "ships sail by night", "by day ships rest", "by")
    got = {r["word"]: r["n"] for r in word_count(df).collect()}
    assert got == {"by": 3, "ships": 2, "sail": 1, "night": 1, "day": 1, "rest": 1}


def test_tokeniser_edges(spark):
    def toks(s):
        return [r["word"] for r in tokens(lines(spark, s)).orderBy("pos").collect()]
    assert toks("a  b ") == ["a", "", "b"]
    assert toks("") == [""]
    assert toks("  ") == []
    assert toks(" a") == ["", "a"]


def test_text_lines_final_newline(spark):
    from pyspark.sql import functions as F

    from tessera.functions.text import text_lines
    df = spark.createDataFrame([("a\n\nb\n",), ("",), ("x",)], "t string")
    got = [r[0] for r in df.select(text_lines(F.col("t"))).collect()]
    assert got == [["a", "", "b"], [], ["x"]]
