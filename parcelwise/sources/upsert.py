"""Key merges on tables without in-place updates: join, then write the result."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Insert new keys, overwrite ``columns`` (default: all) of known ones.

    ``updates`` must be unique on the keys, a repeated one raises. NULL keys are equal.
    """
    keys = list(keys)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    alone = F.when(n == 1, True).otherwise(F.raise_error(F.lit("several updates for one key")).cast("boolean"))
    changed = [c for c in (columns or target.columns) if c not in keys]
    new = updates.select(*[F.col(k).alias(f"_key_{k}") for k in keys], alone.alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in updates.columns if c not in keys])
    old = target.withColumn("_old", F.lit(True))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    joined = old.join(new, same, "full_outer")

    def value(c: str):
        if c in keys:
            return F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_key_{c}")).alias(c)
        if f"_new_{c}" not in joined.columns:
            return F.col(c)
        take_new = F.col("_hit") & (F.col("_old").isNull() if c not in changed else F.lit(True))
        return F.when(take_new, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[value(c) for c in target.columns])


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the rows whose key is unknown; of several rows of a key the smallest."""
    return target.unionByName(absent_rows(target, rows, keys), allowMissingColumns=True)


def absent_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of unknown keys, one per key: the smallest by its columns in order. NULL keys are equal."""
    rest = [c for c in rows.columns if c not in keys]
    once = rows.groupBy(*keys).agg(F.min(F.struct(*rest) if rest else F.struct(*keys)).alias("_row"))
    once = once.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in rows.columns])
    known = target.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()
    return once.join(known, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]), "left_anti")


def latest_rows(df: DataFrame, order: Sequence, n: int = 1, offset: int = 0) -> DataFrame:
    """The ``n`` first rows of an order after skipping ``offset``."""
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset else ordered).limit(n)
