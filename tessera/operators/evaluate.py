"""Offline evaluation of recommendation lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.common import stats_join


def ratio(num: Column, den: Column) -> Column:
    """IEEE division (0/0 = NaN, x/0 = +-inf); ANSI mode would raise instead."""
    return F.when(den != 0, num / den) \
            .when(num == 0, F.lit(float("nan"))) \
            .otherwise(F.signum(num) * F.lit(float("inf")))


def precision_recall(test: DataFrame, users: DataFrame, recs: DataFrame, user: str = "user_id",
                     item: str = "item") -> DataFrame:
    """``tp, tp_fn, tp_fp, precision, recall, f1`` micro-averaged over users in test and recs.

    Sets are of distinct items per user; a user with an empty list counts in
    recall.  One shuffle on (user, item) tags each pair as test and/or rec;
    the common-user restriction is a semi join on one row per user.
    """
    common = test.select(user).distinct().join(users.select(user).distinct(), user)
    tagged = (test.select(user, item, F.lit(1).alias("_t"), F.lit(0).alias("_r"))
              .unionByName(recs.select(user, item, F.lit(0).alias("_t"), F.lit(1).alias("_r")))
              .groupBy(user, item).agg(F.max("_t").alias("_t"), F.max("_r").alias("_r"))
              .join(common, user, "left_semi"))
    tot = tagged.agg(F.coalesce(F.sum(F.col("_t") * F.col("_r")), F.lit(0)).cast("bigint").alias("tp"),
                     F.coalesce(F.sum("_t"), F.lit(0)).cast("bigint").alias("tp_fn"),
                     F.coalesce(F.sum("_r"), F.lit(0)).cast("bigint").alias("tp_fp"))
    p = ratio(F.col("tp").cast("double"), F.col("tp_fp").cast("double"))
    r = ratio(F.col("tp").cast("double"), F.col("tp_fn").cast("double"))
    return tot.select("tp", "tp_fn", "tp_fp", p.alias("precision"), r.alias("recall")) \
        .withColumn("f1", ratio(F.lit(2.0) * F.col("precision") * F.col("recall"),
                                F.col("precision") + F.col("recall")))


def coverage(train: DataFrame, recs: DataFrame, item: str = "item") -> DataFrame:
    """Distinct recommended items over distinct training items."""
    n_train = train.agg(F.count_distinct(item)).scalar()
    return recs.agg(F.count_distinct(item).alias("n_rec_items")).select(
        "n_rec_items", n_train.alias("n_train_items"),
        ratio(F.col("n_rec_items").cast("double"), n_train.cast("double")).alias("coverage"))


def popularity(train: DataFrame, recs: DataFrame, item: str = "item") -> DataFrame:
    """Mean of ``ln(1 + training count)`` over recommendation rows (duplicates counted)."""
    counts = train.groupBy(item).agg(F.count(F.lit(1)).alias("_n"))
    j = stats_join(recs.select(item), item, counts, "item-counts")
    return j.agg(F.avg(F.ln(F.lit(1.0) + F.col("_n"))).alias("popularity"),
                 F.count(F.lit(1)).alias("n_rows"))


def matrix_mae(left: DataFrame, right: DataFrame, keys=("i", "j"), value: str = "sim") -> DataFrame:
    """Mean absolute error on ``left``'s entries; a missing ``right`` entry counts as 0."""
    r = right.select(*keys, F.col(value).alias("_v"))
    return (left.select(*keys, F.col(value).alias("_u")).join(r, list(keys), "left")
            .agg(F.avg(F.abs(F.col("_u") - F.coalesce(F.col("_v"), F.lit(0.0)))).alias("mae"),
                 F.count(F.lit(1)).alias("n_entries")))
