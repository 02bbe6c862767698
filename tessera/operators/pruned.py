"""Top-k neighbours by cosine without pairing everything: an exact search that skips what cannot enter a list.

Full pairing costs the square of every user's degree.  Here users are cut into classes of about equal pairing
cost, those with few items first, and three steps replace the one big join:

1. *Light classes* (the first ``light`` of the cost) are paired in full.  Ratings aren't negative, so these
   partial cosines are lower bounds, and the k-th largest of an item's is a bound ``tau`` that its last
   neighbour must reach.
2. *Prefixes.*  By Cauchy-Schwarz two unit vectors that share nothing but the classes from c on have a cosine of at
   most the norm of the one's part in them.  An item is therefore paired only in the classes before its cut, the
   first one from which the norm of its remaining part is below ``tau``: whoever shares none of these cannot be in
   its list.  Entries before their items' cuts meet each other once, and the others of the same users.  The classes left out are those of the users with the most items.
3. *Verification.*  A candidate stays if its sum so far plus the product of both remaining norms can reach
   ``tau``; only for these the remaining classes are added.

The lists equal those of the full search, ties included; bounds give way by ``SLACK`` for rounding, and sums are
rounded to 12 places, as equal cosines may be summed in different orders.  The joins are
blocked as in ``similarity.co_pairs``.  How much is skipped depends on the data: much where an item's best
neighbours stand out and some users rate very much, nothing where all items are alike (step 2 pairs everything).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tessera.operators.common import stats_join, top_k
from tessera.operators.ratings import require_unique
from tessera.operators.similarity import DEFAULT_CHUNK, _entries, chunked, co_pairs, top_neighbours
from tessera.session import materialize

CLASSES = 64
LIGHT = 0.1
SLACK = 1e-6


def user_classes(entries: DataFrame, classes: int = CLASSES, light: float = LIGHT) -> tuple[DataFrame, int]:
    """``entries`` plus ``cls``, and the number of light classes.

    Users are binned by the logarithm of their degree (quarters of octaves, so at most some 160 rows reach the
    driver); a bin with more than its share of the cost is cut further by a hash of the user.
    """
    deg = materialize(entries.groupBy("u").agg(F.count(F.lit(1)).alias("deg")).withColumn("bin", F.floor(4 * F.log2("deg")).cast("int")), "user-degrees")
    bins = sorted((r["bin"], float(r["cost"])) for r in deg.groupBy("bin").agg(F.sum(F.col("deg").cast("double") * F.col("deg")).alias("cost")).collect())
    total, first, split, cost = sum(c for _, c in bins), {}, {}, []
    for b, c in bins:
        first[b], split[b] = len(cost), max(1, round(c * classes / total))
        cost += [c / split[b]] * split[b]
    lit = F.create_map(*[F.lit(x) for b in first for x in (b, F.struct(F.lit(first[b]).alias("at"), F.lit(split[b]).alias("n")))]) if first else None
    if lit is None:
        return entries.withColumn("cls", F.lit(0)), 0
    place = F.element_at(lit, F.col("bin"))
    cls = (place["at"] + F.pmod(F.xxhash64("u"), place["n"]).cast("int")).alias("cls")
    n_light, spent = 0, 0.0
    while n_light < len(cost) and spent < light * total:
        spent += cost[n_light]
        n_light += 1
    return stats_join(entries, "u", deg.select("u", cls), "user-classes"), n_light


def pruned_similarity(ratings: DataFrame, k: int = 50, user: str = "user_id", item: str = "item", value: str = "rating",
                      classes: int = CLASSES, light: float = LIGHT, chunk: int = DEFAULT_CHUNK, trace: dict | None = None) -> DataFrame:
    """``i, j, sim``: exact cosines of the pairs that can be among item i's ``k`` largest (and some more), both ways.

    Negative ratings raise (their partial sums bound nothing).  ``trace`` takes the pairs that each step joins.
    """
    require_unique(ratings, (user, item))
    e = _entries(ratings, user, item, value)
    norms = e.groupBy("i").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"), F.min("v").alias("least"))
    norms = materialize(norms, "item-norms")
    if (norms.agg(F.min("least")).first()[0] or 0) < 0:
        raise ValueError("negative ratings")
    unit = e.join(norms, "i").select("u", "i", (F.col("v") / F.col("norm")).alias("w"))
    unit, n_light = user_classes(unit, classes, light)
    unit = chunked(unit, chunk)  # written: every step below reads it

    def counted(df: DataFrame, name: str) -> DataFrame:
        if trace is None:
            return df
        trace[name] = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        return df.observe(trace[name], F.count(F.lit(1)).alias("pairs"))

    # 1. light classes, and the bound that the last neighbour must reach
    half = counted(co_pairs(unit.where(F.col("cls") < n_light), chunk, ("w",)), "light").groupBy("i", "j").agg(F.sum(F.col("w_i") * F.col("w_j")).alias("q"))
    both = F.explode(F.array(F.struct("i", "j", "q"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "q"))).alias("p")
    partial = materialize(half.select(both).select("p.i", "p.j", "p.q"), "light-pairs")
    tau = top_k(partial, "i", [F.col("q").desc()], k).where(F.col("rank") == k).select("i", F.greatest(F.col("q") - SLACK, F.lit(0.0)).alias("tau"))

    # 2. the classes that each item needs: a row for each item and class, a bounded window for each item
    parts = unit.where(F.col("cls") >= n_light).groupBy("i", "cls").agg(F.sum(F.col("w") * F.col("w")).alias("s"))
    rest = F.sum("s").over(Window.partitionBy("i").orderBy(F.col("cls").desc()).rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("rest", rest).join(tau, "i", "left").withColumn("tau", F.coalesce("tau", F.lit(0.0)))
    needed = F.col("rest") >= F.col("tau") * F.col("tau")
    cuts = parts.groupBy("i").agg(F.max("tau").alias("tau"), (F.coalesce(F.max(F.when(needed, F.col("cls"))), F.lit(n_light - 1)) + 1).alias("cut"),
                                  F.sqrt(F.coalesce(F.max(F.when(~needed, F.col("rest"))), F.lit(0.0))).alias("left"), F.sqrt(F.max("rest")).alias("all_left"))
    cuts = materialize(cuts, "item-cuts")
    later = unit.where(F.col("cls") >= n_light).join(cuts.select("i", "cut"), "i")
    active = F.col("cls") < F.col("cut")
    once = counted(co_pairs(later.where(active).drop("cut"), chunk, ("w",)), "prefix").select("i", "j", (F.col("w_i") * F.col("w_j")).alias("q")).select(both).select("p.i", "p.j", "p.q")
    every = F.explode(F.sequence(F.lit(0), F.col("_nc") - 1))
    left = later.where(active).select("u", F.col("_c").alias("_a"), every.alias("_b"), "i", F.col("w").alias("w_i"))
    right = later.where(~active).select("u", every.alias("_a"), F.col("_c").alias("_b"), F.col("i").alias("j"), F.col("w").alias("w_j"))
    more = counted(left.join(right, ["u", "_a", "_b"]), "prefix with the rest").select("i", "j", (F.col("w_i") * F.col("w_j")).alias("q"))
    found = partial.unionByName(once).unionByName(more).groupBy("i", "j").agg(F.sum("q").alias("q"))

    # 3. who can still reach the bound, and the classes after the cut for them (items without heavy users have none)
    mine = cuts.select("i", "tau", "cut", "left")
    theirs = cuts.select(F.col("i").alias("j"), "all_left")
    reach = F.col("q") + F.coalesce(F.col("left") * F.col("all_left"), F.lit(0.0)) >= F.coalesce("tau", F.lit(0.0)) - SLACK
    kept = materialize(found.join(mine, "i", "left").join(theirs, "j", "left").where(reach).select("i", "j", "q", "cut", "left"), "candidates")
    after = later.where(~active).select("i", "u", F.col("w").alias("w_i"))
    pairs = counted(kept.where("left > 0").select("i", "j").join(after, "i"), "verified") \
        .join(unit.where(F.col("cls") >= n_light).select("u", F.col("i").alias("j"), F.col("w").alias("w_j")), ["u", "j"])
    tails = pairs.select("i", "j", (F.col("w_i") * F.col("w_j")).alias("q"))
    return kept.select("i", "j", "q").unionByName(tails).groupBy("i", "j").agg(F.round(F.sum("q"), 12).alias("sim"))


def top_neighbours_pruned(ratings: DataFrame, k: int = 50, **how) -> DataFrame:
    """``item, neighbour, weight, rank`` as ``top_neighbours`` of the cosines, by the pruned search."""
    return top_neighbours(pruned_similarity(ratings, k, **how), k)
