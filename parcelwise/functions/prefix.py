"""Positions and running totals over orders of any size, without one task for the whole order.

Rows are cut into buckets of bounded size along the order. Totals per bucket are small; a running
sum over them gives each bucket its offset, and a window inside the bucket does the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.functions.lineage import cut

#: Rows that one task orders.
BUCKET_ROWS = 1 << 20
#: Every round cuts a bucket that is too large into 2 ** STEPS.
STEPS = 10


def positions(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with its 1-based position in a total ``order``, over range partitions.

    Equal rows of the order must be equal rows (they stay in one partition and share it freely).
    """
    parted = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition.
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parted.join(offsets, "_part").withColumn(name, (F.col("_before") + inside).cast("long")).drop("_part", "_before")


def bucketed(data: DataFrame, keys: Sequence[str], order: str, rows: int = BUCKET_ROWS, steps: int = STEPS) -> DataFrame:
    """``data`` with ``_bucket``, an array that ascends with the double ``order`` inside each key.

    A bucket holds at most ``rows`` rows unless they share one value. All rows of a key start in one
    bucket; a bucket that is too large is cut at sketched quantiles of its own values, and so on.
    Each round reads the data once; the number of rounds is the logarithm of the largest key.
    """
    keys, width = list(keys), 1 << steps
    out = data.withColumn("_bucket", F.array().cast("array<int>"))
    at = [*keys, "_bucket"]
    cuts = F.array(*[F.lit((i + 1) / width) for i in range(width - 1)])
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(steps))])

    def descend(found: Column, half: Column) -> Column:
        return found + F.when(F.get("_edges", found + half - 1) < F.col(order), half).otherwise(0)

    # A value that is an edge gets a place of its own: a value with many rows is set apart at once, and every
    # round splits every bucket it takes, since edges are values of the bucket.
    below = F.aggregate(halves, F.lit(0), descend)
    place = F.get(F.transform(F.array(below), lambda b: b * 2 + F.coalesce(F.get("_edges", b) == F.col(order), F.lit(False)).cast("int")), F.lit(0))
    path = F.when(F.col("_edges").isNull(), F.col("_bucket")).otherwise(F.concat("_bucket", F.array(place)))
    while True:
        sizes = out.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_low"), F.max(order).alias("_high"))
        large = cut(sizes.filter((F.col("_n") > rows) & (F.col("_low") < F.col("_high"))).select(*at))
        if large.isEmpty():
            return out
        full = out.join(large, at)
        edges = full.groupBy(*at).agg(F.percentile_approx(order, cuts, F.lit(max(10_000, 4 * width))).alias("_edges"))
        out = cut(out.join(edges, at, "left").withColumn("_bucket", path).drop("_edges"))


def running_totals(
    totals: DataFrame,
    keys: Sequence[str],
    value: str,
    measures: Sequence[str],
    *,
    descending: bool = False,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Running sums over distinct values: adds ``cum_{measure}`` to ``totals``.

    ``totals`` has one row per key and value; keys are not NULL. ``cum_{measure}`` is the sum over
    all values up to this one (from the top when ``descending``). No task orders more than ``rows``
    values, whatever the number of distinct values of a key.
    """
    keys, measures = list(keys), list(measures)
    sign = -1.0 if descending else 1.0
    data = bucketed(totals.withColumn("_o", F.col(value).cast("double") * F.lit(sign)), keys, "_o", rows)
    at = [*keys, "_bucket"]
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket.
    offsets = (
        data.groupBy(*at)
        .agg(*[F.sum(m).alias(f"_t_{m}") for m in measures])
        .select(*at, *[F.coalesce(F.sum(f"_t_{m}").over(before), F.lit(0)).alias(f"_b_{m}") for m in measures])
    )
    within = Window.partitionBy(*at).orderBy("_o").rowsBetween(Window.unboundedPreceding, 0)
    out = data.join(offsets, at).withColumns({f"cum_{m}": F.sum(m).over(within) + F.col(f"_b_{m}") for m in measures})
    return out.drop("_o", "_bucket", *[f"_b_{m}" for m in measures])
