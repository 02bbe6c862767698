"""Neighbour-based and matrix-factorisation recommendation.

Every recommender returns ``(users, recs)``: ``users`` lists each user that
gets a recommendation list (possibly empty, which still counts in recall),
``recs`` holds ``user, rank, item, score`` rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.common import minmax, score_order, top_k
from tessera.operators.inner_product import top_inner
from tessera.session import materialize

#: Items of a user up to which what they own travels with each of their rows.
MAX_OWNED = 512
#: Train rows of one partition: each meets a whole neighbour list.
PART_ROWS = 1 << 16
#: Rows (of three longs) of a neighbour table that may be broadcast.
MAX_BROADCAST = 1_000_000


def candidates(nb: DataFrame, train: DataFrame, user: str = "user_id", item: str = "item",
               extra: tuple[str, ...] = ()) -> DataFrame:
    """Each rated item's neighbours: ``user, item, neighbour, weight`` (+ ``extra`` train columns)."""
    return train.select(user, item, *extra).join(nb.select("item", "neighbour", "weight")
                                                 .withColumnRenamed("item", item), item)


def owned(nb: DataFrame, train: DataFrame, user: str = "user_id", item: str = "item") -> DataFrame:
    """(user, item) pairs that reach the neighbour table: only these count as already owned."""
    return train.select(user, item).join(nb.select(F.col("item").alias(item)).distinct(), item, "left_semi")


def drop_seen(cands: DataFrame, seen: DataFrame, user: str = "user_id", item: str = "item") -> DataFrame:
    """Candidates whose ``neighbour`` the user does not already own (anti join on the pair)."""
    return cands.join(seen.select(user, F.col(item).alias("neighbour")), [user, "neighbour"], "left_anti")


def _unseen_by_user(nb: DataFrame, train: DataFrame, user: str, item: str, extra: tuple[str, ...]) -> DataFrame:
    """``unseen`` of users with few items: the ratings are dealt by user, each user's items become one array, and
    the candidates are tested against it where they arise.  They stay dealt by user: what follows moves none."""
    listed = nb.select(F.col("item").alias("neighbour")).distinct().withColumn("_listed", F.lit(True))
    lists = materialize(nb.select(F.col("item").alias("_item"), "neighbour", "weight").join(listed, "neighbour", "left"), "lists")
    if lists.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        lists = F.broadcast(lists)
    parts = max(train.sparkSession.sparkContext.defaultParallelism, -(-train.count() // PART_ROWS))
    kind = nb.schema["neighbour"].dataType
    rows = train.where(F.col(item).isNotNull()).repartition(parts, user).groupBy(user).agg(
        F.collect_list(F.col(item).cast(kind)).alias("_seen"), F.collect_list(F.struct(item, *extra)).alias("_rows"))
    rows = rows.select(user, "_seen", F.explode("_rows").alias("_row")).select(user, "_seen", "_row.*")
    seen = F.coalesce(F.col("_listed") & F.array_contains("_seen", F.col("neighbour")), F.lit(False))
    return rows.join(lists, F.col(item) == F.col("_item")).where(~seen).select(user, item, "neighbour", "weight", *extra)


def unseen(nb: DataFrame, train: DataFrame, user: str = "user_id", item: str = "item", extra: tuple[str, ...] = (),
           max_owned: int = MAX_OWNED) -> list[DataFrame]:
    """``drop_seen`` of all ``candidates``, as frames ``user, item, neighbour, weight`` (+ ``extra``) of disjoint users.

    Candidates are many times the ratings, so they aren't shuffled to find those that the user owns
    (``_unseen_by_user``); only the ones of users with more than ``max_owned`` items are.  Eager: counts items by user.
    """
    many = train.groupBy(F.col(user).alias("_many")).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > max_owned) | F.col("_many").isNull())
    many = materialize(many.drop("_n"), "many-items")
    if many.isEmpty():
        return [_unseen_by_user(nb, train, user, item, extra)]
    same = F.col(user).eqNullSafe(F.col("_many"))
    few, heavy = train.join(many, same, "left_anti"), train.join(many, same, "left_semi")
    shuffled = drop_seen(candidates(nb, heavy, user, item, extra), owned(nb, heavy, user, item), user, item)
    return [_unseen_by_user(nb, few, user, item, extra), shuffled.select(user, item, "neighbour", "weight", *extra)]


def rec_users(nb: DataFrame, train: DataFrame, user: str = "user_id", item: str = "item") -> DataFrame:
    return owned(nb, train, user, item).select(user).distinct()


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def recommend_score(nb: DataFrame, train: DataFrame, n: int = 30, user: str = "user_id",
                    item: str = "item") -> tuple[DataFrame, DataFrame]:
    """Every neighbour of an owned item is a candidate with its weight; no merging.

    One item can fill several of the ``n`` places (once per owned item that
    lists it).  Ties: weight rounded to 9 places, then item, then source item.
    """
    top = _union(top_k(c, user, score_order("weight", "neighbour", item), n) for c in unseen(nb, train, user, item))
    recs = top.select(user, "rank", F.col("neighbour").alias("item"), F.col("weight").alias("score"))
    return rec_users(nb, train, user, item), recs


def recommend_weighted_sum(nb: DataFrame, train: DataFrame, n: int = 30, user: str = "user_id",
                           item: str = "item", rating: str = "rating") -> tuple[DataFrame, DataFrame]:
    """Score = sum(w * r) / sum(w) over owned items listing the candidate (0 when sum(w) = 0).

    ``r`` is the user's rating min-max scaled over all of the user's ratings.
    """
    scaled = minmax(train.select(user, item, rating), user, rating, out="_r")

    def best(c: DataFrame) -> DataFrame:
        agg = c.groupBy(user, "neighbour").agg(F.sum("weight").alias("_tw"),
                                               F.sum(F.col("weight") * F.col("_r")).alias("_ws"))
        scored = agg.select(user, F.col("neighbour").alias("item"),
                            F.when(F.col("_tw") != 0, F.col("_ws") / F.col("_tw")).otherwise(F.lit(0.0)).alias("score"))
        return top_k(scored, user, score_order("score", "item"), n)
    top = _union(best(c) for c in unseen(nb, scaled, user, item, extra=("_r",)))
    return rec_users(nb, train, user, item), top.select(user, "rank", "item", "score")


def fit_als(train: DataFrame, user: str = "user_id", item: str = "item", rating: str = "rating",
            rank: int = 10, iterations: int = 20, reg: float = 0.01, alpha: float = 1.0, seed: int = 42):
    """Implicit-preference ALS with the classic API's defaults (lambda 0.01, alpha 1.0)."""
    from pyspark.ml.recommendation import ALS
    als = ALS(rank=rank, maxIter=iterations, regParam=reg, alpha=alpha, implicitPrefs=True,
              userCol=user, itemCol=item, ratingCol=rating, seed=seed, coldStartStrategy="drop")
    return als.fit(train)


def als_residuals(model, train: DataFrame, user: str = "user_id", item: str = "item", rating: str = "rating",
                  reg: float = 0.01, alpha: float = 1.0) -> DataFrame:
    """``user, residual``: how far each user's factors are from solving their normal equations, relative to the
    right-hand side.

    With item factors y, weights ``c = 1 + alpha |r|`` and preferences ``p = [r > 0]``, a user's x solves
    ``(Y'Y + sum (c - 1) y y' + reg n I) x = sum c p y`` over the user's items, n of them with ``r > 0``.  The last
    half-step of the fit makes the user factors, so they must solve it to the precision of their floats.
    ``Y'Y`` is rank x rank numbers at the driver; the sums are one aggregate by user.
    """
    rank = model.rank
    items = model.itemFactors.select(F.col("id").alias("_item"), F.col("features").cast("array<double>").alias("_y"))
    users = model.userFactors.select(F.col("id").alias("_user"), F.col("features").cast("array<double>").alias("_x"))
    y, x = ([F.col(f"_{v}")[i] for i in range(rank)] for v in "yx")
    gram = items.agg(*(F.sum(y[i] * y[j]).alias(f"g{i}_{j}") for i in range(rank) for j in range(rank))).first()
    rows = train.join(items, F.col(item) == F.col("_item")).join(users, F.col(user) == F.col("_user"))
    r = F.col(rating).cast("double")
    seen = sum((y[i] * x[i] for i in range(rank)), F.lit(0.0))
    positive = F.when(r > 0, 1.0).otherwise(0.0)
    staged = rows.select(user, "_x", "_y", positive.alias("_p"), (F.abs(r) * alpha).alias("_c"), seen.alias("_s"))
    left = F.col("_c") * F.col("_s")
    right = (1.0 + F.col("_c")) * F.col("_p")
    sums = staged.groupBy(user).agg(F.first("_x").alias("_x"), F.sum("_p").alias("_n"), *(F.sum(left * y[i]).alias(f"_l{i}") for i in range(rank)),
                                    *(F.sum(right * y[i]).alias(f"_r{i}") for i in range(rank)))
    gap = [sum((F.lit(gram[f"g{i}_{j}"] or 0.0) * x[j] for j in range(rank)), F.lit(0.0)) + F.col(f"_l{i}") + reg * F.col("_n") * x[i] - F.col(f"_r{i}") for i in range(rank)]
    size = F.sqrt(sum((F.col(f"_r{i}") * F.col(f"_r{i}") for i in range(rank)), F.lit(0.0)))
    return sums.select(user, (F.sqrt(sum((g * g for g in gap), F.lit(0.0))) / F.greatest(size, F.lit(1e-12))).alias("residual"))


def recommend_als(train: DataFrame, n: int = 30, direction: str = "user-product", user: str = "user_id",
                  item: str = "item", rating: str = "rating", model=None, seed: int = 42
                  ) -> tuple[DataFrame, DataFrame]:
    """ALS recommendations, found by ``inner_product.top_inner`` over the factors.

    ``user-product``: the top ``n`` items per user, owned items not removed.
    ``product-user``: the top ``10 n`` users of each item, flipped, then the
    top ``n`` per user; users in no item's list get nothing.
    """
    if direction not in ("user-product", "product-user"):
        raise ValueError(f"unknown recommend method: {direction}")
    model = model or fit_als(train, user, item, rating, seed=seed)
    users = model.userFactors.select("id", F.col("features").alias("vec"))
    items = model.itemFactors.select("id", F.col("features").alias("vec"))
    if direction == "user-product":
        recs = top_inner(users, items, n).select(F.col("id").alias(user), "rank", F.col("item"), "score")
        return train.select(user).distinct(), recs
    listed = top_inner(items, users, 10 * n).select(F.col("item").alias(user), F.col("id").alias("item"), "score")
    top = top_k(listed, user, score_order("score", "item"), n)
    return top.select(user).distinct(), top.select(user, "rank", "item", "score")


def recommend(method: str, nb: DataFrame | None, train: DataFrame, n: int = 30, **kw):
    if method == "score":
        return recommend_score(nb, train, n, **kw)
    if method == "weighted-sum":
        return recommend_weighted_sum(nb, train, n, **kw)
    if method in ("user-product", "product-user"):
        return recommend_als(train, n, method, **kw)
    raise ValueError(f"unknown recommend method: {method}")
