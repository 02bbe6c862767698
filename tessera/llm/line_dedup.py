"""Operator 7, line dedup by an exact set-similarity join, in DataFrame functions only.

A line is the set of its lower-case words.  Words are ordered by rarity (counted over all documents
in ``SLOTS`` hashed counters, so the table has a fixed size), each line's first words in that order
are its prefix, and two lines can only be similar if their prefixes share a word.  Sharing pairs pass
the length filter, the positional filter and a filter on two 64-bit maps, each of one half of the words
(bits that differ are words that aren't shared), then their whole sets are compared: a line goes if an earlier line
(smaller doc_id, null last; in the same document an earlier line) has a Jaccard similarity of
``threshold`` or more.  Lines are judged on the input, not on what is left.

Equal sets are joined as one class, so copies aren't multiplied.  A class is first compared with the
earliest class of each word of its prefix; only classes that this doesn't settle are joined with all
earlier ones, so a large group of similar lines isn't joined with itself.  Texts are split once, into
sets of 64-bit hashes that are written with the lines; words and sets are compared by these.  Wordless lines stay.  Null and empty texts have no lines to lose.
Rows that agree in doc_id and text are one document and lose the same lines.  Extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.sizes import small
from tessera.session import written

THRESHOLD = 0.8
SLOTS = 1 << 19
#: Rows (of 8 to 50 bytes) of a lookup table that may be broadcast.
MAX_BROADCAST = 500_000
#: The prefixes' words are joined in so many parts, one after another: the shuffle files of one part are on disk at a time.
PARTS = 4
#: Bytes of distinct words that a file of lines may keep as a dictionary: their places in it take a third of the hashes' bytes.
DICTIONARY = 1 << 23


def words(text: Column) -> Column:
    """The lower-case words of a line, empty strings among them."""
    text = F.lower(text)
    for space in "\t\x0b\x0c\r\n":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.split(text, " ")


def token_set(line: Column) -> Column:
    """The sorted set of the hashes of a line's words."""
    return F.sort_array(F.array_distinct(F.transform(F.array_remove(words(line), ""), lambda w: F.xxhash64(w))))


def rarity(lines: DataFrame) -> Column:
    """A literal array of ``SLOTS`` numbers: the whole log2 of the number of ``tokens`` that fall into each slot, 0 for
    one line's word or none.  The driver gets it as strings of 4096 slots each."""
    spark = lines.sparkSession
    counts = lines.select(F.explode("tokens").alias("t")).groupBy(F.col("t").bitwiseAND(F.lit(SLOTS - 1)).alias("id")).count()
    level = F.coalesce(F.floor(F.log2("count") + 1e-12), F.lit(0)).cast("string")
    every = spark.range(SLOTS).join(counts, "id", "left").select(F.shiftright("id", 12).alias("part"), "id", level.alias("level"))
    parts = every.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("id", "level"))).alias("x")) \
        .select("part", F.array_join(F.col("x.level"), ",").alias("levels"))
    return F.split(F.lit(",".join(r.levels for r in sorted(parts.collect()))), ",").cast("array<bigint>")


def by_rarity(tokens: Column, levels: Column) -> Column:
    """The tokens in the order of their rarity, as longs: rarity level in the upper 6 bits, hash in the rest."""
    def keyed(h: Column) -> Column:
        return F.shiftleft(levels[h.bitwiseAND(F.lit(SLOTS - 1)).cast("int")], 57).bitwiseOR(F.shiftrightunsigned(h, 7))
    return F.sort_array(F.transform(tokens, keyed))


def word_map(tokens: Column, half: int) -> Column:
    """64 bits, one set for each word's hash, of the words that fall into a half (0 or 1)."""
    one = F.lit(1).cast("long")

    def add(s: Column, t: Column) -> Column:
        bit = F.call_function("shiftleft", one, t.bitwiseAND(F.lit(63)).cast("int"))
        return F.when(t.bitwiseAND(F.lit(64)) == 64 * half, s.bitwiseOR(bit)).otherwise(s)
    return F.aggregate(tokens, F.lit(0).cast("long"), add)


def _exploded(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, line_no, line``; a text is hashed once, not for each of its lines."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.split("text", "\n").alias("lines"))
    return docs.select("doc_id", "text_hash", F.posexplode("lines").alias("line_no", "line"))


def prefix_size(n: Column, threshold: float) -> Column:
    return (n - F.ceil(threshold * n - 1e-9) + 1).cast("int")


def _entries(classes: DataFrame, part: int) -> DataFrame:
    """``token, doc, c, n, even, odd, p`` of each word of a class's prefix that other lines have as well, of one of
    ``PARTS`` parts of the words.  Dealt by word once a part: both sides of a join read the same exchange."""
    doc = F.coalesce(F.col("first.doc_id"), F.lit((1 << 63) - 1)).alias("doc")
    return classes.select("c", doc, "n", "even", "odd", F.posexplode("prefix").alias("p", "token")).where(F.pmod("token", F.lit(PARTS)) == part).repartition("token")


def _alike(n: Column, even: Column, odd: Column, threshold: float) -> Column:
    """The map filter, by the sum of two sizes and the bits that differ in the maps of either half."""
    return (n - F.bit_count(even) - F.bit_count(odd)) / 2 >= threshold / (1 + threshold) * n - 1e-9


def _possible(a: Column, b: Column, threshold: float) -> Column:
    """The length, positional and map filters.  They keep every similar pair, by its first common word:
    after it, no more words can be shared than the shorter rest holds."""
    both = a["n"] + b["n"]
    enough = threshold / (1 + threshold) * both - 1e-9
    sizes = F.least(a["n"], b["n"]) >= threshold * F.greatest(a["n"], b["n"]) - 1e-9
    rest = F.least(a["n"] - a["p"], b["n"] - b["p"])
    return (a["c"] != b["c"]) & sizes & (rest >= enough) & _alike(both, a["even"].bitwiseXOR(b["even"]), a["odd"].bitwiseXOR(b["odd"]), threshold)


_FIELDS = ("doc", "c", "n", "even", "odd", "p")
_ORDERED = ["least(lead.c, x.c) AS a", "greatest(lead.c, x.c) AS b"]


def _near(entries: DataFrame, threshold: float) -> DataFrame:
    """The possible pairs ``a, b`` of a class and the earliest class of a word of its prefix."""
    so_far = Window.partitionBy("token").orderBy("doc", "c").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = F.struct(*_FIELDS)
    both = entries.select(x.alias("x"), F.first(x).over(so_far).alias("lead"))
    return both.where(_possible(F.col("lead"), F.col("x"), threshold)).selectExpr(*_ORDERED)


def _rest(entries: DataFrame, settled: DataFrame, threshold: float) -> DataFrame:
    """The possible pairs of a class that isn't settled and any earlier class of a word of its prefix."""
    lead, x = entries.select("token", F.struct(*_FIELDS).alias("lead")), entries.join(settled, "c", "left_anti").select("token", F.struct(*_FIELDS).alias("x"))
    return lead.join(x, "token").where((F.col("lead.doc") <= F.col("x.doc")) & _possible(F.col("lead"), F.col("x"), threshold)).selectExpr(*_ORDERED)


def _in_parts(pairs: Callable[[int], DataFrame]) -> DataFrame:
    """The distinct pairs of all parts."""
    found = [written(pairs(part).distinct(), "part") for part in range(PARTS)]
    return written(reduce(DataFrame.union, found).distinct(), "pairs")


def _close(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Of any pairs ``a, b`` those that the maps don't rule out; the joins by words apply this filter themselves."""
    def side(c: str) -> DataFrame:
        return classes.select(F.col("c").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in ("n", "even", "odd")))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(_alike(F.col("n_a") + F.col("n_b"), F.col("even_a").bitwiseXOR(F.col("even_b")), F.col("odd_a").bitwiseXOR(F.col("odd_b")), threshold)).select("a", "b")


def _later(pairs: DataFrame, lines: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """``c``: the classes of the pairs ``a, b`` that have a similar earlier one, by their whole sets."""
    wanted = pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct().join(classes.select("c", "first"), "c")
    wanted = written(wanted.select("c", "first", "first.*"), "wanted")
    some = small(wanted, MAX_BROADCAST).select(F.col("c").alias("_c"), "first", *(F.col(x).alias(f"_{x}") for x in ("doc_id", "text_hash", "line_no")))
    same = (lines["c"] == some["_c"]) & lines["doc_id"].eqNullSafe(some["_doc_id"]) & (lines["text_hash"] == some["_text_hash"]) & (lines["line_no"] == some["_line_no"])
    sets = written(lines.join(some, same).select("c", "first", "tokens"), "sets")
    if sets.count() > wanted.count():  # rows that agree in doc_id and text
        sets = written(sets.dropDuplicates(["c"]), "sets")
    both = pairs.join(sets.select(F.col("c").alias("a"), F.col("tokens").alias("x"), F.col("first").alias("fa")), "a") \
        .join(sets.select(F.col("c").alias("b"), F.col("tokens").alias("y"), F.col("first").alias("fb")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common >= threshold * (F.size("x") + F.size("y") - common) - 1e-9) \
        .select(F.when(F.col("fa") < F.col("fb"), F.col("b")).otherwise(F.col("a")).alias("c")).distinct()


def line_verdicts(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, text_hash, n_lines, removed``: one row for each distinct (doc_id, text), ``removed``
    being the sorted numbers (from 0) of the lines to remove."""
    tokens = token_set(F.col("line"))
    lines = _exploded(docs).withColumn("tokens", tokens).withColumn("n", F.size("tokens")) \
        .select("doc_id", "text_hash", "line_no", F.when(F.col("n") > 0, F.xxhash64("tokens")).alias("c"), "n", "tokens")
    lines = written(lines, "lines", {"parquet.dictionary.page.size": DICTIONARY})
    n, (even, odd) = F.col("n"), (word_map(F.col("tokens"), half) for half in (0, 1))
    # a set that is too small to be similar to another set needs no prefix
    first = F.when(n / (n + 1) >= threshold - 1e-9, F.slice(by_rarity(F.col("tokens"), rarity(lines)), 1, prefix_size(n, threshold)))
    shared = F.transform(first, lambda t: F.when(F.shiftrightunsigned(t, 57) > 0, t.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "line_no")
    classes = lines.where("n > 0").select("c", place.alias("first"), "n", even.alias("even"), odd.alias("odd"), shared.alias("prefix")) \
        .groupBy("c").agg(F.min("first").alias("first"), *(F.first(x).alias(x) for x in ("n", "even", "odd", "prefix")))
    classes = written(classes, "classes")
    pairs = _in_parts(lambda part: _near(_entries(classes, part), threshold))
    later = written(_later(pairs, lines, classes, threshold), "later")
    settled = small(later, MAX_BROADCAST)
    rest = written(_in_parts(lambda part: _rest(_entries(classes, part), settled, threshold)).join(pairs, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        later = written(later.union(_later(rest, lines, classes, threshold)).distinct(), "later")
    firsts = classes.join(later, "c", "left_anti").select("first.doc_id", "first.text_hash", "first.line_no")
    return _by_document(lines, firsts)


def _by_document(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """A worded line stays if it is the first of a class with no earlier similar class."""
    n = lines.groupBy("doc_id", "text_hash").agg(F.countDistinct("line_no").alias("n_lines"), F.array_sort(F.collect_set(F.when(F.col("n") > 0, F.col("line_no")))).alias("worded"))
    stays = firsts.groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("stays"))
    same = n["doc_id"].eqNullSafe(stays["doc_id"]) & (n["text_hash"] == stays["text_hash"])
    joined = n.join(stays, same, "left").select(n["doc_id"], n["text_hash"], "n_lines", "worded", F.coalesce("stays", F.array().cast("array<int>")).alias("stays"))
    return joined.select("doc_id", "text_hash", "n_lines", F.array_except("worded", "stays").alias("removed"))


def drop_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the removed lines; a document whose every worded line went is left out, one
    that had none stays.  Untouched texts stay as they are; ``n_chars``, if there, is brought up to date."""
    v = line_verdicts(docs, threshold).where(F.size("removed") > 0) \
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("removed").alias("_removed"), F.col("n_lines").alias("_lines"))
    v = written(v, "verdicts")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    joined = docs.join(small(v, MAX_BROADCAST // 4), same, "left")
    numbered = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_removed", i))
    text = F.when(F.col("_removed").isNull(), F.col("text")).otherwise(F.array_join(numbered, "\n"))
    out = joined.withColumn("text", text).where(F.col("_removed").isNull() | F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("_removed").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)
