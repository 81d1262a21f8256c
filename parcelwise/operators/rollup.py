"""Shipments to one row per customer and month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions import columns as C
from parcelwise.schemas import CUSTOMER, SERVICES

Date = dt.date | str


def date_range(df: DataFrame, column: str, start: Date, end: Date, *, inclusive_end_day: bool = False) -> DataFrame:
    """Rows with ``start <= column <= end``.

    ``end`` is midnight, so later times of the last day fall out unless
    ``inclusive_end_day`` is set. The filter reaches the scan.
    """
    c = F.col(column)
    lower = F.lit(str(start)).cast("timestamp_ntz")
    upper = F.lit(str(end)).cast("timestamp_ntz")
    if inclusive_end_day:
        return df.filter((c >= lower) & (c < upper + F.expr("interval 1 day")))
    return df.filter((c >= lower) & (c <= upper))


def rollup_measures() -> list[Column]:
    """The monthly measures. ``weight_kg`` is the mean weight, ``satisfaction_score``
    the mean success flag and ``intra_province`` the number of domestic items."""

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    def mean(c: Column) -> Column:
        return F.coalesce(F.avg(c.cast("double")), F.lit(0.0))

    def hits(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")

    zero = F.lit(0)
    return [
        F.count(F.lit(1)).alias("item_count"),
        total("total_fee").alias("total_fee"),
        total("total_complaint").alias("total_complaint"),
        hits(F.coalesce("delay_day", zero) > 0).alias("delay_count"),
        total("delay_day").alias("delay_day"),
        hits(F.coalesce("done", zero) == 0).alias("nodone"),
        total("refunded").alias("refunded"),
        total("no_accepted").alias("noaccepted"),
        total("lost_order").alias("lost_order"),
        hits(F.coalesce("is_domestic", zero) == 1).alias("intra_province"),
        hits(F.coalesce("is_domestic", zero) == 0).alias("international"),
        mean(F.col("order_score")).alias("order_score"),
        mean(F.col("rec_success")).alias("satisfaction_score"),
        mean(F.col("weight_kg")).alias("weight_kg"),
        mean(F.dayofmonth("sending_time")).alias("lastday"),
        *[F.sum(C.code_flag(F.col("service_code"), s.upper())).cast("bigint").alias(f"ser_{s}") for s in SERVICES],
    ]


def day_measures() -> list[Column]:
    """Days with shipments as a bit set, so distinct days need no extra shuffle.

    The ``_cut`` versions leave out times after midnight on the last day of the
    month; they apply when the month ends a window.
    """
    t = F.col("sending_time")
    day = F.dayofmonth(t)
    bit = F.expr("shiftleft(1L, dayofmonth(sending_time) - 1)")
    late = (F.to_date(t) == F.last_day(t)) & (t > F.to_date(t).cast("timestamp_ntz"))
    return [
        F.bit_or(bit).alias("day_mask"),
        F.bit_or(F.when(~late, bit).otherwise(F.lit(0).cast("bigint"))).alias("day_mask_cut"),
        F.max(day).alias("last_day"),
        F.max(F.when(~late, day)).alias("last_day_cut"),
    ]


def monthly_rollup(
    shipments: DataFrame,
    start: Date,
    end: Date,
    *,
    inclusive_end_day: bool = False,
    with_days: bool = False,
) -> DataFrame:
    """One row per customer and month with counts, sums and means of the shipments.

    One shuffle with map-side combine. ``with_days`` adds the day sets used by
    the window features.
    """
    scope = date_range(shipments, "sending_time", start, end, inclusive_end_day=inclusive_end_day)
    measures = rollup_measures() + (day_measures() if with_days else [])
    month = F.to_date(F.trunc("sending_time", "MM"))
    return (
        scope.groupBy(CUSTOMER, month.alias("report_month"))
        .agg(*measures)
        .withColumn("month_key", C.month_key(F.col("report_month")))
        .withColumn("month_key_num", C.month_number(F.col("report_month")))
    )


def monthly_sums(customer_month: DataFrame) -> DataFrame:
    """Per customer and month: sums, mean scores, rows and rows with complaints."""
    keyed = customer_month.withColumn("month_key_num", C.month_number(F.col("report_month")))
    return keyed.groupBy(CUSTOMER, "month_key_num").agg(
        F.sum("item_count").cast("bigint").alias("item_sum"),
        F.sum("total_fee").cast("bigint").alias("revenue_sum"),
        F.sum("total_complaint").cast("bigint").alias("complaint_sum"),
        F.sum("delay_count").cast("bigint").alias("delay_sum"),
        F.sum("nodone").cast("bigint").alias("nodone_sum"),
        F.avg(F.col("order_score").cast("double")).alias("order_score_avg"),
        F.avg(F.col("satisfaction_score").cast("double")).alias("satisfaction_avg"),
        F.count(F.lit(1)).cast("int").alias("month_record_count"),
        F.count(F.when(F.col("total_complaint") > 0, 1)).cast("int").alias("months_with_complaint"),
    )
