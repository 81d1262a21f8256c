"""Which windows to build: months, sizes, specs, refresh and chunk plans.

These tables have one row per month, size or window, so they stay small
whatever the data size; each is still a DataFrame that joins with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.functions import columns as C


def observation_month(shipments: DataFrame) -> DataFrame:
    """Newest month with shipments, one row ``t_obs``."""
    return shipments.agg(F.to_date(F.trunc(F.max("sending_time"), "MM")).alias("t_obs"))


def month_range(bounds: DataFrame) -> DataFrame:
    """One row per month between ``start_date`` and ``end_date`` of a one-row frame."""
    months = F.sequence(F.trunc("start_date", "MM"), F.trunc("end_date", "MM"), F.expr("interval 1 month"))
    return (
        bounds.select(F.posexplode(months).alias("pos", "month"))
        .select((F.col("pos") + 1).alias("month_no"), F.to_date("month").alias("month"))
    )


def window_sizes(months: DataFrame, smallest: int, largest: int | None = None) -> DataFrame:
    """Sizes ``smallest..min(largest, months - 2)``; no rows when that is empty."""
    available = F.count(F.lit(1))
    auto = F.greatest(available - 2, F.lit(1))
    top = auto if largest is None else F.least(auto, F.lit(largest))
    low = F.least(F.lit(smallest), available)
    bounds = months.agg(low.cast("int").alias("low"), top.cast("int").alias("top"))
    return bounds.filter("low <= top").select(F.explode(F.sequence("low", "top")).alias("window_size"))


def search_sizes(months: DataFrame, smallest: int, horizon: int, min_train_windows: int) -> DataFrame:
    """Sizes that leave ``min_train_windows`` windows to train on, one to validate and the horizon; at least the smallest."""
    top = F.greatest(F.lit(smallest), F.count(F.lit(1)) - (horizon + min_train_windows - 1))
    return months.agg(top.cast("int").alias("top")).select(F.explode(F.sequence(F.lit(smallest), "top")).alias("window_size"))


def month_plan(bounds: DataFrame, smallest: int = 3, largest: int | None = None) -> DataFrame:
    """Months and window sizes as one long table ``(kind, month, window_size)``."""
    months = month_range(bounds)
    sizes = window_sizes(months, smallest, largest)
    return months.select(F.lit("month").alias("kind"), "month", F.lit(None).cast("int").alias("window_size")).unionByName(
        sizes.select(F.lit("size").alias("kind"), F.lit(None).cast("date").alias("month"), "window_size")
    )


def window_specs(months: DataFrame, sizes: Sequence[int], floor: str) -> DataFrame:
    """One row per window size and end month whose start is not before ``floor``."""
    sized = months.select("month", F.explode(F.array(*[F.lit(int(s)) for s in sizes])).alias("window_size"))
    start = F.to_date(F.add_months("month", 1 - F.col("window_size")))
    return (
        sized.withColumn("start_date", start)
        .filter(F.col("start_date") >= F.lit(floor).cast("date"))
        .select(
            "window_size",
            "start_date",
            F.last_day("month").alias("end_date"),
            C.month_key(F.col("start_date")).alias("window_start"),
            C.month_key(F.col("month")).alias("window_end"),
            C.month_index(F.col("month")).alias("end_idx"),
        )
    )


def specs_between(spark, start: str, end: str, sizes: Sequence[int], floor: str | None = None) -> DataFrame:
    """Window specs for all end months in a date range."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("start_date"), F.lit(end).cast("date").alias("end_date"))
    return window_specs(month_range(bounds), sizes, floor or start)


def valid_training_ends(months: DataFrame, window_size: int, horizon: int) -> DataFrame:
    """Months that can end a training window: a full window before, a full horizon after.

    ``months`` holds one row per month in order (``month_no`` from 1).
    """
    last = months.agg(F.max("month_no")).scalar()
    return months.filter(F.col("month_no").between(F.lit(window_size), last - (horizon + 1))).select("month_no", "month")


def refresh_plan(existing: DataFrame, specs: DataFrame, last_n: int) -> DataFrame:
    """keep / recompute / new per window.

    ``existing`` has ``window_size, window_end, row_count``. The newest ``last_n``
    existing windows of each size and the empty ones are computed again. With a column
    ``end_idx`` the calendar tells which are newest, without it their names do.
    """
    latest = F.col("end_idx" if "end_idx" in existing.columns else "window_end")
    newest = Window.partitionBy("window_size").orderBy(latest.desc())
    known = existing.select(
        "window_size",
        "window_end",
        ((F.row_number().over(newest) <= last_n) | (F.col("row_count") == 0)).alias("_redo"),
    )
    action = F.when(F.col("_redo").isNull(), "new").when(F.col("_redo"), "recompute").otherwise("keep")
    return (
        specs.select("window_size", "window_start", "window_end")
        .join(known, ["window_size", "window_end"], "left")
        .select("window_size", "window_start", "window_end", action.alias("action"))
    )


def refresh_counts(plan: DataFrame) -> DataFrame:
    """Totals of a refresh plan."""
    n = lambda a: F.count(F.when(F.col("action") == a, 1))
    return plan.agg(
        F.count(F.lit(1)).alias("total_possible"),
        (n("new") + n("recompute")).alias("to_compute"),
        n("recompute").alias("recomputed"),
        n("new").alias("new_tables"),
        n("keep").alias("kept_tables"),
    )


def chunk_plan(specs: DataFrame, month_chunk: int, size_chunk: int, done: DataFrame | None = None) -> DataFrame:
    """Groups of windows to build per job, without the chunks listed in ``done``.

    Chunk ids are ``months:a..b|sizes:c..d``. A chunk size of 0 means one group.
    """
    def grouped(df: DataFrame, column: str, size: int, group: str) -> DataFrame:
        # One row per calendar month or window size: an ordered window is fine.
        order = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(column))
        gid = F.floor((order - 1) / size).cast("int") if size > 0 else F.lit(0)
        return df.select(column).distinct().withColumn(group, gid)

    months = grouped(specs, "window_end", month_chunk, "month_group")
    sizes = grouped(specs, "window_size", size_chunk, "size_group")
    label = lambda c: F.concat(F.lit("20"), F.substring(c, 1, 2), F.lit("-"), F.substring(c, 3, 2))
    month_labels = months.groupBy("month_group").agg(
        F.concat(label(F.min("window_end")), F.lit(".."), label(F.max("window_end"))).alias("month_label")
    )
    size_labels = sizes.groupBy("size_group").agg(
        F.concat(F.min("window_size").cast("string"), F.lit(".."), F.max("window_size").cast("string")).alias("size_label")
    )
    plan = (
        specs.join(F.broadcast(months), "window_end")
        .join(F.broadcast(sizes), "window_size")
        .join(F.broadcast(month_labels), "month_group")
        .join(F.broadcast(size_labels), "size_group")
        .withColumn("chunk_id", F.concat(F.lit("months:"), "month_label", F.lit("|sizes:"), "size_label"))
        .groupBy("chunk_id", "month_group", "size_group")
        .agg(F.count(F.lit(1)).alias("windows"))
    )
    return plan if done is None else plan.join(done.select("chunk_id"), "chunk_id", "left_anti")
