"""Operator 11, URL filters: rules first, then a path-template tree for each host.

*Tree.*  A host's urls share a root, and a level is added for each segment of their paths.  At every node, the
children are counted (urls, urls that end there, labelled ones, good ones).  Children with under ``MIN_URLS`` urls are
variable segments (ids, names, dates) and become one branch, the wildcard ``*``.  So do those that are like the rest
of the node: chi-square of their share of good labels, and of their share of urls that end there, against those of
their siblings is at most ``DIFFERENT``.  The others are merged with those like them: a branch ``~ab`` holds the children
whose smoothed share of good labels lies in the a-th fifth and whose share of ends lies in the b-th (from 0).  What
lies below a branch is counted together.  A template is a path of the tree, such as ``/*/~04/*``; segments after the
``MAX_DEPTH``-th are one tail, ``**``.  A node has 26 branches at most, however many children it has.

*Purity.*  A template's share of good labels is smoothed towards its host's (``SMOOTHING`` labels), and that one
likewise towards the share of all.  Templates with a purity under ``LEAST`` are rejected, and urls that no rule
decides follow their template.

Each level is one aggregate over all urls with partial sums, so a host with a third of all rows is combined before the
shuffle; the branches that stay, and the rejected templates, are joined back by broadcast after a check of their number, else
by a shuffle from written tables, whose hot keys Spark splits.

Rules are a short list, ``(verdict, host + path)``.  A rule fits its host and all subdomains if the path starts with
the rule's; the longest wins (of equally long ones the longer host).

Null urls and urls without ``://`` have an empty host and path, and share a template.  Null labels count as unlabelled;
without labels every template has the purity of one good and one bad label, and is kept.  Repeated rows count as often as
they occur.  An empty table gives an empty result.  Columns but the named ones are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.sizes import small
from tessera.operators.common import stats_join
from tessera.session import materialize

MIN_URLS = 20
#: Chi-square with one degree of freedom: chance of a larger one 0.001.
DIFFERENT = 10.828
MAX_DEPTH = 8
SMOOTHING = 5.0
LEAST = 0.5
#: Up to so many branches or templates (a host and a path each) are broadcast.
MAX_BROADCAST = 50_000

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, null without one."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"))):  # the last one that is asked wins
        own, start = rule[:rule.index("/")], rule[rule.index("/"):]
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def chi_square(a: Column, n: Column, all_a: Column, all_n: Column) -> Column:
    """Of a table of two groups (n of which a are so, and the rest of all_n); 0 where a side is empty."""
    a, n, all_a, all_n = (c.cast("double") for c in (a, n, all_a, all_n))
    below = all_a * (all_n - all_a) * n * (all_n - n)
    gap = a * (all_n - n) - (all_a - a) * n
    return F.when(below > 0, gap * gap * all_n / below).otherwise(F.lit(0.0))


def _branches(rows: DataFrame, depth: int, least: int) -> DataFrame:
    """``host, template, child, branch`` of the children at ``depth`` that don't go to the wildcard."""
    counts = materialize(rows.where(F.size("segments") > depth).groupBy("host", "template", F.get("segments", F.lit(depth)).alias("child")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.size("segments") == depth + 1).alias("ends"), F.count("good").alias("labelled"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good")), f"url-children-{depth}")
    nodes = counts.groupBy("host", "template").agg(*(F.sum(c).alias(f"all_{c}") for c in ("n", "ends", "labelled", "good")))
    often = counts.where(F.col("n") >= least)
    quality = chi_square(F.col("good"), F.col("labelled"), F.col("all_good"), F.col("all_labelled"))
    shape = chi_square(F.col("ends"), F.col("n"), F.col("all_ends"), F.col("all_n"))
    usual = F.coalesce(F.try_divide("all_good", "all_labelled"), F.lit(0.5))
    share = (F.col("good") + SMOOTHING * usual) / (F.col("labelled") + SMOOTHING)
    fifths = [F.least(F.floor(5 * x), F.lit(4)).cast("string") for x in (share, F.col("ends") / F.col("n"))]
    return stats_join(often, ["host", "template"], nodes, f"url-nodes-{depth}").where((quality > DIFFERENT) | (shape > DIFFERENT)) \
        .select("host", "template", "child", F.concat(F.lit("~"), *fifths).alias("branch"))


def templates(rows: DataFrame, least: int = MIN_URLS, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``rows`` (``host, path, good`` and more) plus ``template``.  Eager: a pass over the rows for each level."""
    rows = rows.withColumn("segments", F.expr("slice(split(path, '/'), 2, 2147483647)")).withColumn("template", F.lit(""))
    deepest = rows.agg(F.max(F.size("segments"))).first()[0] or 0
    for depth in range(min(deepest, max_depth)):
        kept = small(materialize(_branches(rows, depth, least), f"url-branches-{depth}"), MAX_BROADCAST) \
            .select(F.col("host").alias("kept_host"), F.col("template").alias("kept_template"), F.col("child").alias("kept"), "branch")
        child = F.get("segments", F.lit(depth))
        on = (F.col("host") == F.col("kept_host")) & (F.col("template") == F.col("kept_template")) & (child == F.col("kept"))
        step = F.concat("template", F.lit("/"), F.coalesce("branch", F.lit("*")))
        rows = rows.join(kept, on, "left").withColumn("template", F.when(F.size("segments") > depth, step).otherwise(F.col("template"))) \
            .drop("kept_host", "kept_template", "kept", "branch")
    tail = F.when(F.size("segments") > max_depth, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
    return rows.withColumn("template", tail).drop("segments")


def rejected(rows: DataFrame, smoothing: float = SMOOTHING, least: float = LEAST) -> DataFrame:
    """``host, template`` of the templates whose smoothed purity is too low."""
    counts = materialize(rows.groupBy("host", "template").agg(F.count("good").alias("labelled"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")), "url-templates")
    labelled, good = counts.agg(F.sum("labelled"), F.sum("good")).first()
    prior = ((good or 0) + 1.0) / ((labelled or 0) + 2.0)
    hosts = counts.groupBy("host").agg(((F.sum("good") + smoothing * prior) / (F.sum("labelled") + smoothing)).alias("host_purity"))
    purity = (F.col("good") + smoothing * F.col("host_purity")) / (F.col("labelled") + smoothing)
    return stats_join(counts, "host", hosts, "url-hosts").where(purity < least).select("host", "template")


def judge(pages: DataFrame, good: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES, least_urls: int = MIN_URLS) -> DataFrame:
    """``page_id, host, path, rule, verdict, template`` of every row of ``pages`` (``page_id, url``).  ``good``: labels
    of some pages, ``page_id, good`` (0 or 1); of repeated ones the largest holds."""
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    if good is None:
        rows = rows.withColumn("good", F.lit(None).cast("int"))
    else:
        one = good.where(F.col("good").isin(0, 1)).groupBy(F.col("page_id").alias("labelled_id")).agg(F.max("good").cast("int").alias("good"))
        rows = rows.join(materialize(one, "url-labels"), F.col("page_id") == F.col("labelled_id"), "left").drop("labelled_id")
    rows = materialize(rows, "urls")
    placed = templates(rows, least_urls)
    bad = small(materialize(rejected(placed), "url-rejected"), MAX_BROADCAST).select(F.col("host").alias("bad_host"), F.col("template").alias("bad_template"))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    return placed.join(bad, (F.col("host") == F.col("bad_host")) & (F.col("template") == F.col("bad_template")), "left").withColumn("found", rule).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(F.col("bad_host").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "template")


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id, good``: the quality label of the document that a page shows, whose id is the last number of its path."""
    doc = F.regexp_extract(path_of(F.col("url")), r"([0-9]+)[^0-9]*$", 1).try_cast("long")
    one = materialize(labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("good")), "document-labels")
    return pages.select("page_id", doc.alias("doc_id")).join(one, "doc_id").select("page_id", "good")
