"""Keyed upserts on DataFrames (K3, K4); the JDBC forms live in ``tessera.sources.jdbc``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Rows of ``target`` replaced or added by ``updates`` (last write wins).

    ``updates`` must be unique per key (checked: a repeated key raises), or carry
    an ``order`` column whose largest value wins.  Plan: anti join of the target on the keys, then a
    union; both sides shuffle on the keys only.
    """
    keys = list(keys)
    cols = target.columns
    if order is not None:
        latest = updates.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in cols if c not in keys]), F.col(order))
                                            .alias("_v"))
        updates = latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in cols if c not in keys])
    else:
        twice = updates.groupBy(*keys).count().where("count > 1").first()
        if twice:
            raise ValueError(f"repeated key in updates: {tuple(twice[k] for k in keys)}")
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates.select(*cols))


def upsert_add(target: DataFrame, updates: DataFrame, key: str | Sequence[str], measure: str) -> DataFrame:
    """Additive upsert: an existing key gets ``measure + new``, a new key is inserted.

    One union and one partially aggregated ``groupBy`` on the key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    both = target.select(*keys, measure).unionByName(updates.select(*keys, measure))
    return both.groupBy(*keys).agg(F.sum(measure).alias(measure))
