"""Rating input: parsing, statistics, user ids, repeatable train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import whitespace_fields
from tessera.operators.common import dense_number
from tessera.session import CLEAN, SMALL_TASKS, held

_INT = r"^[+-]?[0-9]+\z"


def parse_ratings(lines: DataFrame, value: str = "value") -> DataFrame:
    """``user string, item int, clicks int`` from ``user item clicks`` lines.

    Fields split on whitespace runs; rows with a missing or non-integer item or
    clicks field are dropped silently, extra fields ignored.
    """
    f = whitespace_fields(F.col(value))
    staged = lines.select(F.get(f, 0).alias("user"), F.get(f, 1).alias("_i"), F.get(f, 2).alias("_c"))
    ok = F.col("_i").rlike(_INT) & F.col("_c").rlike(_INT)
    return (staged.where(ok)
            .select("user", F.col("_i").try_cast("int").alias("item"), F.col("_c").try_cast("int").alias("clicks"))
            .where(F.col("item").isNotNull() & F.col("clicks").isNotNull()))


def check_unique(ratings: DataFrame, keys=("user", "item")) -> DataFrame:
    """Rows of ``ratings`` whose key occurs more than once (empty when the input is valid)."""
    return ratings.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def require_unique(ratings: DataFrame, keys=("user", "item")) -> DataFrame:
    """``ratings``, or ValueError if a key occurs more than once (sum them with ``group_ratings`` first).
    Eager: one partial aggregate, whose shuffle files go when it ends."""
    with held(ratings.sparkSession, {**CLEAN, **SMALL_TASKS}):
        twice = check_unique(ratings, keys).first()
    if twice:
        raise ValueError(f"repeated ({', '.join(keys)}) rows, for example {tuple(twice[k] for k in keys)}")
    return ratings


def group_ratings(ratings: DataFrame, user="user", item="item", value="rating") -> DataFrame:
    """Sum duplicate (user, item) rows into one."""
    return ratings.groupBy(user, item).agg(F.sum(value).cast("double").alias(value))


def rating_stats(ratings: DataFrame, user="user", item="item") -> DataFrame:
    """``n_ratings, n_users, n_items``."""
    return ratings.agg(F.count(F.lit(1)).alias("n_ratings"),
                       F.count_distinct(user).alias("n_users"),
                       F.count_distinct(item).alias("n_items"))


def user_ids(ratings: DataFrame, user: str = "user", out: str = "user_id") -> DataFrame:
    """``user, user_id``: dense, repeatable 0-based ids in user-name order."""
    users = ratings.select(user).distinct()
    return dense_number(users, [user], (), out).select(user, F.col(out).cast("int").alias(out))


def with_user_id(ratings: DataFrame, user: str = "user", out: str = "user_id") -> DataFrame:
    """Ratings joined with their generated user ids (the user name is kept)."""
    return ratings.join(user_ids(ratings, user, out), user)


def split_bucket(seed: int, *cols: str, buckets: int = 10):
    """A repeatable bucket in [0, buckets) from ``md5(seed:col1:col2...)``."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols])
    h = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets)).cast("int")


def train_test_split(ratings: DataFrame, seed: int = 913, user="user", item="item",
                     buckets: int = 10) -> tuple[DataFrame, DataFrame]:
    """Ten equal-weight random parts: the first nine train, the last one tests.

    The bucket is a hash of (seed, user, item), so the split is the same on
    any partitioning and can be repeated outside Spark.
    """
    b = ratings.withColumn("_bucket", split_bucket(seed, user, item, buckets=buckets))
    train = b.where(F.col("_bucket") < buckets - 1).drop("_bucket")
    test = b.where(F.col("_bucket") == buckets - 1).drop("_bucket")
    return train, test
