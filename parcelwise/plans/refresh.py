"""The executed window refresh: only missing and changed months and windows are computed.

Below the root lie ``monthly`` (customer-months by ``yymm``), ``asof`` (lifetime features by
``yymm`` of their date) and ``windows`` (features by size and end). Every step replaces whole
partitions, and the windows come last: a window that is there is complete, and so are its months and
as-of rows. A run that dies is repeated; what it left half done is planned again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.functions.lineage import cut
from parcelwise.operators import features as X
from parcelwise.operators import rollup as R
from parcelwise.plans import windows as P
from parcelwise.sources import tables as T


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A table, or None before its first partition is written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def month_numbers(start: str, end: str) -> list[int]:
    """``YYMM`` of all months between two dates, oldest first."""
    first, last = (int(d[:4]) * 12 + int(d[5:7]) - 1 for d in (start, end))
    return [m // 12 % 100 * 100 + m % 12 + 1 for m in range(first, last + 1)]


def months_to_roll(known: DataFrame | None, start: str, end: str, last_n: int) -> list[int]:
    """Months without stored rows, the newest ``last_n``, and the newest stored one, whose last day an earlier end may have cut."""
    months = month_numbers(start, end)
    if known is None:
        return months
    have = {r["yymm"] for r in known.select(F.col("yymm").cast("int").alias("yymm")).distinct().collect()}  # one row per month
    newest = [m for m in months if m in have][-1:]
    return [m for k, m in enumerate(months) if m not in have or k >= len(months) - last_n or m in newest]


def refresh_months(spark: SparkSession, root: str, shipments: DataFrame, start: str, end: str, last_n: int) -> list[int]:
    """Roll up what is missing or may have changed, from those partitions of the shipments alone."""
    months = months_to_roll(stored(spark, f"{root}/monthly"), start, end, last_n)
    rows = R.monthly_rollup(T.scan_month_list(shipments, months), start, end, with_days=True)
    T.write_month_partitions(rows, f"{root}/monthly", "report_month")
    return months


def built_windows(spark: SparkSession, root: str) -> DataFrame:
    """``(window_size, window_end, row_count)`` of the stored windows."""
    found = stored(spark, f"{root}/windows")
    if found is None:
        return spark.createDataFrame([], "window_size int, window_end string, row_count bigint")
    return T.read_windows(spark, f"{root}/windows").groupBy("window_size", "window_end").agg(F.count(F.lit(1)).alias("row_count"))


def run_refresh(
    spark: SparkSession,
    root: str,
    shipments: DataFrame,
    complaints: DataFrame,
    *,
    start: str,
    end: str,
    sizes: Sequence[int],
    last_n: int = 2,
    slopes: str = "yymm",
) -> DataFrame:
    """Bring the tables below ``root`` up to date; returns the plan with the action of every window.

    ``shipments`` is partitioned by ``yymm``. Months that planned windows do not touch are
    not read: neither their shipments nor, for the windows, their customer-months. The as-of
    tables of the planned window ends read the stored customer-months up to the last of them.
    """
    refresh_months(spark, root, shipments, start, end, last_n)
    specs = P.specs_between(spark, start, end, sizes)
    known = built_windows(spark, root).join(F.broadcast(specs.select("window_size", "window_end", "end_idx")), ["window_size", "window_end"])
    plan = cut(P.refresh_plan(known, specs, last_n))
    todo = specs.join(plan.filter("action <> 'keep'"), ["window_size", "window_start", "window_end"]).select(specs.columns)
    span = todo.agg(F.min("start_date").cast("string").alias("a"), F.max("end_date").cast("string").alias("b")).first()
    if span["a"] is None:
        return plan
    todo = cut(todo)
    monthly = spark.read.parquet(f"{root}/monthly")
    asof = X.lifetime_asof_all(T.scan_months(monthly, start, span["b"]), todo, start)
    T.write_month_partitions(asof, f"{root}/asof", "lifetime_asof_date")
    starts = [(r["start_date"].isoformat(), r["end_date"].isoformat()) for r in todo.select("start_date", "end_date").distinct().collect()]  # windows of the calendar
    needed = sorted({m for a, b in starts for m in month_numbers(a, b)})
    late = F.col("create_complaint_date")
    recent = complaints.filter((late >= F.lit(span["a"]).cast("timestamp_ntz")) & (late < F.lit(span["b"]).cast("timestamp_ntz") + F.expr("interval 1 day")))
    rows = X.window_features(T.scan_month_list(monthly, needed), recent, todo, max(sizes), slopes=slopes)
    T.write_window_tables(rows, f"{root}/windows")
    return plan


def read_asof(spark: SparkSession, root: str) -> DataFrame:
    """All stored as-of rows."""
    return spark.read.parquet(f"{root}/asof").drop("yymm")

