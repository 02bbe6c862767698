"""Shared distributed building blocks: dense numbering, per-group scaling, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import written

_LOW33 = (1 << 33) - 1


def dense_number(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
                 out: str = "idx") -> DataFrame:
    """Add a 0-based dense row number per ``group_cols`` in ``order_cols`` order.

    A global ``row_number()`` would pull every row through one task.  Here the
    rows are range-partitioned and sorted on (group, order), and each row's
    (partition, position) is taken from ``monotonically_increasing_id``.  That
    numbering is written once as a table in the shared checkpoint folder:
    range bounds come from sampling and may differ between two evaluations of
    the same plan, so every later use must read the same materialised rows.
    A table of per-partition counts, one row per (partition, group), then
    gives each partition's starting number.  It is bounded by the number of
    partitions times the number of groups, so ``group_cols`` must have few
    values (no grouping, or Kafka partitions); it is broadcast.
    """
    from tessera.session import scratch_path
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [*group_cols, *order_cols]
    path = scratch_path(spark, "dense-number")
    (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
     .withColumn("_mid", F.monotonically_increasing_id())
     .write.parquet(path))
    ranged = (spark.read.parquet(path)
              .withColumn("_sp", F.shiftright("_mid", 33))
              .withColumn("_i", F.col("_mid").bitwiseAND(F.lit(_LOW33))))
    stats = ranged.groupBy("_sp", *group_cols).agg(F.min("_i").alias("_i0"),
                                                    F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*group_cols).orderBy("_sp").rowsBetween(Window.unboundedPreceding, -1)
    starts = stats.select("_sp", *group_cols, "_i0",
                          F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_start"))
    return (ranged.join(F.broadcast(starts), ["_sp", *group_cols])
            .select(*df.columns, (F.col("_start") + F.col("_i") - F.col("_i0")).alias(out)))


def stats_join(df: DataFrame, group: str | Sequence[str], stats: DataFrame, name: str = "group-stats") -> DataFrame:
    """``df`` joined with one row of statistics per group.

    ``stats`` is an aggregate on the join key; joined directly, Spark would reuse its partitioning,
    and then cannot split a group that holds a large share of ``df``.  The statistics are therefore
    written once and read back: Spark broadcasts a small table and splits hot groups of a shuffled
    join (AQE skew join) otherwise.  Eager: runs the aggregate.
    """
    keys = [group] if isinstance(group, str) else list(group)
    return df.join(written(stats, name), keys)


def zscore(df: DataFrame, group: str | Sequence[str], value: str, out: str = "z") -> DataFrame:
    """Per-group z-score with the population deviation; an all-equal group gives NaN.

    The group statistics are a partial aggregate joined back by ``stats_join``,
    not a window, so a group holding a large share of the rows is never sorted
    in one task.
    """
    keys = [group] if isinstance(group, str) else list(group)
    stats = df.groupBy(*keys).agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_std"))
    return (stats_join(df, keys, stats)
            .withColumn(out, F.when(F.col("_std") != 0, (F.col(value) - F.col("_mean")) / F.col("_std"))
                        .otherwise(F.lit(float("nan"))))
            .drop("_mean", "_std"))


def minmax(df: DataFrame, group: str | Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Per-group min-max scaling to [0, 1]; an all-equal group gives 0.5."""
    keys = [group] if isinstance(group, str) else list(group)
    out = out or value
    stats = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    return (stats_join(df, keys, stats)
            .withColumn(out, minmax_expr(F.col(value), F.col("_lo"), F.col("_hi")))
            .drop("_lo", "_hi"))


def minmax_expr(v: Column, lo: Column, hi: Column) -> Column:
    return F.when(lo == hi, F.lit(0.5)).otherwise((v - lo) / (hi - lo))


def lp_scale(df: DataFrame, group: str | Sequence[str], value: str, p: float = 2.0,
             out: str | None = None) -> DataFrame:
    """Divide each value by its group's Lp norm ``(sum v^p)^(1/p)``."""
    keys = [group] if isinstance(group, str) else list(group)
    out = out or value
    stats = df.groupBy(*keys).agg(F.pow(F.sum(F.pow(F.col(value), F.lit(p))), F.lit(1.0 / p)).alias("_norm"))
    return (stats_join(df, keys, stats)
            .withColumn(out, F.when(F.col("_norm") != 0, F.col(value) / F.col("_norm"))
                        .otherwise(F.lit(float("nan"))))
            .drop("_norm"))


def top_k(df: DataFrame, group: str | Sequence[str], order: Sequence[Column], k: int,
          rank: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows per group in ``order``, numbering them 1..k.

    ``row_number() <= k`` lets Spark insert a partial ``WindowGroupLimit``
    before the shuffle, so each map task sends at most k rows per group.
    """
    keys = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def score_order(score: str, *ids: str) -> list[Column]:
    """Descending score rounded to 9 places, then ascending ids: a repeatable tie rule."""
    return [F.round(F.col(score), 9).desc(), *[F.col(i).asc() for i in ids]]


def next_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str], values: Sequence[str],
                  prefix: str = "next_") -> DataFrame:
    """``df`` plus the ``values`` of the next row of the same group in ``order`` (NULL for the last).

    The same answer as ``lead()`` over ``partitionBy(group).orderBy(order)``,
    without a per-group window (which puts a whole group in one task): rows
    get a dense global position in (group, order) order (``dense_number``),
    and each row is joined to the row at position + 1 when it belongs to the
    same group.  The join key is the unique position, so no key is hot.
    ``order`` must make rows unique within a group.
    """
    group, order, values = list(group), list(order), list(values)
    numbered = dense_number(df, order, (), "_pos") if not group else dense_number(df, [*group, *order], (), "_pos")
    nxt = numbered.select((F.col("_pos") - 1).alias("_pos"), *[F.col(g).alias(f"_g_{g}") for g in group],
                          *[F.col(v).alias(f"{prefix}{v}") for v in values])
    same = None
    for g in group:
        cond = F.col(g) == F.col(f"_g_{g}")
        same = cond if same is None else same & cond
    joined = numbered.join(nxt, "_pos", "left")
    out = [F.when(same, F.col(f"{prefix}{v}")).alias(f"{prefix}{v}") if same is not None else F.col(f"{prefix}{v}")
           for v in values]
    return joined.select(*df.columns, *out)
