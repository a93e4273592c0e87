"""Keyed snapshots: each change reads a snapshot and returns the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def insert_ignore(old: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """old and the rows of new whose key it lacks, the first of each key by order."""
    fresh = new.join(old.select(*key).distinct(), key, "left_anti")
    first = fresh.groupBy(*key).agg(F.min_by(F.struct(*[F.col(c) for c in new.columns if c not in key]), order).alias("r"))
    return old.unionByName(first.select(*key, "r.*").select(*old.columns))


def upsert(old: DataFrame, new: DataFrame, key: str | list[str], order: str, keep: tuple[str, ...] = ("created_at",)) -> DataFrame:
    """old with new's rows put in by key, of one column or several; the last by order wins, and the columns in keep stay as they first were.

    Of rows new to old, what is kept is the first one's by order. Where several rows of new have one order, the
    greatest by the other columns wins, so a rerun agrees.
    """
    key = [key] if isinstance(key, str) else list(key)
    rest = [c for c in old.columns if c not in key]
    ranked = dict(new.dtypes)
    at = F.struct(order, *[c for c in rest if c != order and "map<" not in ranked[c]])  # maps have no order
    kept = [c for c in keep if c in rest]
    last = new.groupBy(*key).agg(F.max_by(F.struct(*rest), at).alias("__new"), *[F.min_by(c, at).alias(f"__first_{c}") for c in kept])
    joined = old.select(*key, F.struct(*rest).alias("__old")).join(last, key, "full")
    pick = lambda c: F.when(F.col("__old").isNotNull(), F.col(f"__old.{c}")).otherwise(F.col(f"__first_{c}")) if c in kept else F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(f"__old.{c}"))
    return joined.select(*key, *[pick(c).alias(c) for c in rest])


def replace_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old without the keys that new touches, and new."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)
