"""Lifetime, as-of and sliding-window features.

All windows are built in one job: every customer-month is copied into the windows
that contain it and one aggregate keyed (customer, size, end) computes them all.
The monthly rows are shuffled to their customer once; the copies are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.functions import columns as C
from parcelwise.operators.rollup import date_range
from parcelwise.schemas import CUSTOMER, PIVOT_METRICS, SERVICE_COLUMNS, WINDOW_KEYS

# Input column of each pivoted metric.
METRIC_SOURCE = {
    "item": "item_count",
    "revenue": "total_fee",
    "complaint": "total_complaint",
    "delay": "delay_count",
    "nodone": "nodone",
    "order_score": "order_score",
    "satisfaction": "satisfaction_score",
}
# Metrics whose best and worst month is reported, with the output prefix.
EXTREMES = {
    "item": "item",
    "revenue": "revenue",
    "complaint": "complaint",
    "order_score": "order",
    "satisfaction": "satisfaction",
}

#: How far a partition of customers is cut down because its rows are copied into windows.
COPIES = 4
#: Bytes of the files behind a partition of customers: its windows take some hundred times as many in a task's memory.
PART_BYTES = 1 << 20
#: Partitions at most.
MOST_PARTS = 1 << 15


def month_suffix(offset: int) -> str:
    return "last" if offset == 0 else f"{offset}m_ago"


# --------------------------------------------------------------------------
# copying rows into windows


def customer_parts(df: DataFrame) -> int:
    """Partitions of customers for rows of ``df``: ``COPIES`` times the usual ones, more for files of more bytes."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    files = [leaf for leaf in map(leaves.apply, range(leaves.size())) if leaf.nodeName() == "LogicalRelation"]  # the sizes of others are guesses
    wanted = -(-sum(int(str(leaf.stats().sizeInBytes())) for leaf in files) // PART_BYTES)
    return max(COPIES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(wanted, MOST_PARTS))


def by_customer(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Shuffle compact rows to their customer before they are copied.

    The partition count is fixed: the rows multiply after the shuffle, which
    adaptive coalescing cannot foresee. It grows with the tables (``customer_parts``), since all windows of
    a partition's customers are in a task's memory at once.
    """
    return df.repartition(parts or customer_parts(df), CUSTOMER)


def into_windows(df: DataFrame, month_idx: Column, specs: DataFrame, max_size: int) -> DataFrame:
    """Copy each row into every window that contains its month.

    Adds the window columns and ``_offset``, the months before the window end.
    ``specs`` has one row per window and is bounded by the calendar, so it is
    broadcast; the join is on the end month.
    """
    offsets = F.sequence(F.lit(0), F.lit(max_size - 1))
    copied = df.withColumn("_offset", F.explode(offsets)).withColumn("end_idx", (month_idx + F.col("_offset")).cast("int"))
    wanted = specs.select("window_size", "window_start", "window_end", "start_date", "end_date", F.col("end_idx").cast("int"))
    return copied.join(F.broadcast(wanted), "end_idx").filter(F.col("_offset") < F.col("window_size"))


# --------------------------------------------------------------------------
# sliding windows


def _window_aggregates(max_size: int, *, slopes: str) -> list[Column]:
    off = F.col("_offset")

    def dsum(name: str) -> Column:
        return F.sum(F.col(name).cast("double"))

    pivots = [
        F.max(F.when(off == k, F.col(METRIC_SOURCE[m]))).alias(f"_{m}_{k}")
        for k in range(max_size)
        for m in PIVOT_METRICS
    ]
    spread = []
    for m, src in (("item", "item_count"), ("revenue", "total_fee"), ("complaint", "total_complaint")):
        spread += [
            F.sum(src).cast("bigint").alias(f"{m}_sum"),
            F.avg(F.col(src).cast("double")).alias(f"{m}_avg"),
            F.stddev_pop(F.col(src).cast("double")).alias(f"{m}_std"),
        ]
    x = F.col("month_key_num" if slopes == "yymm" else "month_idx").cast("double")
    slope = lambda c: F.coalesce(F.regr_slope(F.col(c).cast("double"), x), F.lit(0.0))
    full_days = F.when(off == 0, F.col("day_mask_cut")).otherwise(F.col("day_mask"))
    last_seen = F.when(off == 0, F.col("last_day_cut")).otherwise(F.col("last_day"))
    last_date = F.date_add(F.col("report_month"), (last_seen - 1).cast("int"))
    return [
        F.count(F.lit(1)).alias("month_count"),
        *spread,
        F.count(F.when(F.col("total_complaint") > 0, 1)).alias("_months_with_complaint"),
        dsum("weight_kg").alias("weight_sum"),
        F.avg(F.col("weight_kg").cast("double")).alias("weight_avg"),
        F.stddev_pop(F.col("weight_kg").cast("double")).alias("weight_std"),
        dsum("delay_count").alias("_delay_sum"),
        F.sum(F.when(F.col("delay_count") > 0, 1)).alias("_delay_months"),
        dsum("delay_day").alias("_delay_days"),
        dsum("refunded").alias("_refund_sum"),
        dsum("noaccepted").alias("_noaccepted_sum"),
        dsum("lost_order").alias("_lost_sum"),
        dsum("nodone").alias("_nodone_sum"),
        dsum("intra_province").alias("_intra_sum"),
        dsum("international").alias("_intl_sum"),
        F.avg(F.col("order_score").cast("double")).alias("order_score_avg"),
        F.stddev_pop(F.col("order_score").cast("double")).alias("order_score_std"),
        F.avg(F.col("satisfaction_score").cast("double")).alias("satisfaction_avg"),
        F.stddev_pop(F.col("satisfaction_score").cast("double")).alias("satisfaction_std"),
        F.count(F.when(F.col("item_count") > 0, 1)).cast("int").alias("active_months"),
        F.avg(F.col("lastday").cast("double")).alias("avg_lastday"),
        *[F.sum(s).cast("bigint").alias(f"{s}_sum") for s in SERVICE_COLUMNS],
        slope("item_count").alias("item_slope"),
        slope("total_fee").alias("revenue_slope"),
        slope("satisfaction_score").alias("satisfy_slope"),
        slope("total_complaint").alias("complaint_slope"),
        F.sum(F.bit_count(full_days)).cast("int").alias("active_days"),
        F.max(last_date).alias("_last_date"),
        *pivots,
    ]


def _history(metric: str, max_size: int) -> Column:
    """The months of a metric, oldest first, NULL where there was no activity."""
    return F.array(*[F.col(f"_{metric}_{k}") for k in range(max_size - 1, -1, -1)])


def _median(metric: str, max_size: int) -> Column:
    ordered = F.sort_array(_history(metric, max_size))  # NULLs first
    first = F.lit(max_size) - F.col("month_count")
    low = F.get(ordered, (first + F.floor((F.col("month_count") - 1) / 2)).cast("int"))
    high = F.get(ordered, (first + F.floor(F.col("month_count") / 2)).cast("int"))
    return (low.cast("double") + high.cast("double")) / 2


def _extreme_month(metric: str, max_size: int, *, largest: bool) -> Column:
    """``YYMM`` of the best or worst month; the earliest one on ties."""
    history = _history(metric, max_size)
    best = F.array_max(history) if largest else F.array_min(history)
    # A NULL element never equals ``best``; positions count from the oldest month.
    offset = F.lit(max_size) - F.array_position(history, best)
    return C.index_to_number((F.col("end_idx") - offset).cast("int"))


def window_base(monthly: DataFrame, specs: DataFrame, max_size: int, *, slopes: str = "yymm", parts: int | None = None) -> DataFrame:
    """All per-window aggregates of the monthly rows, still without ratios.

    ``monthly`` must come from ``monthly_rollup(..., with_days=True)``: one row per
    customer and month and no NULL measures.
    """
    rows = monthly.withColumn("month_idx", C.month_index(F.col("report_month"))).transform(by_customer, parts)
    # Rows are grouped by numbers; the window's texts and dates join its one row afterwards.
    keys = [CUSTOMER, "window_size", "end_idx"]
    grouped = into_windows(rows, F.col("month_idx"), specs, max_size).groupBy(*keys).agg(*_window_aggregates(max_size, slopes=slopes))
    names = specs.select("window_size", F.col("end_idx").cast("int").alias("end_idx"), "window_start", "window_end", "start_date", "end_date")
    return grouped.join(F.broadcast(names), ["window_size", "end_idx"])


def complaint_stats(complaints: DataFrame, specs: DataFrame, max_size: int, *, parts: int | None = None) -> DataFrame:
    """Distinct complaint codes and the most frequent one per customer and window.

    The smaller code wins ties. A time after midnight on the last day of a window
    is outside of it.
    """
    t = F.col("create_complaint_date")
    late = (F.to_date(t) == F.last_day(t)) & (t > F.to_date(t).cast("timestamp_ntz"))
    counted = (
        complaints.groupBy(CUSTOMER, C.month_index(t).alias("month_idx"), "complaint_code", late.alias("_late"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .transform(by_customer, parts)
    )
    inside = into_windows(counted, F.col("month_idx"), specs, max_size).filter(~(F.col("_late") & (F.col("_offset") == 0)))
    per_code = inside.groupBy(*WINDOW_KEYS, "complaint_code").agg(F.sum("cnt").alias("cnt"))
    return per_code.groupBy(*WINDOW_KEYS).agg(
        F.count("complaint_code").cast("int").alias("complaint_diversity"),
        (-F.max(F.struct("cnt", (-F.col("complaint_code")).alias("neg")))["neg"]).cast("int").alias("most_common_complaint"),
    )


def month_extremes(base: DataFrame, max_size: int) -> DataFrame:
    """Best and worst month of five metrics per window."""
    return base.select(
        *WINDOW_KEYS,
        *[
            _extreme_month(m, max_size, largest=big).alias(f"{prefix}_{'max' if big else 'min'}_month")
            for m, prefix in EXTREMES.items()
            for big in (True, False)
        ],
    )


def pivot_months(base: DataFrame, max_size: int) -> DataFrame:
    """The monthly metrics as columns; 0 for a month without activity, NULL beyond the window."""
    return base.select(*WINDOW_KEYS, *pivot_columns(max_size))


def pivot_columns(max_size: int) -> list[Column]:
    zero = {"order_score": F.lit(0.0), "satisfaction": F.lit(0.0)}
    return [
        F.when(F.col("window_size") > k, F.coalesce(F.col(f"_{m}_{k}"), zero.get(m, F.lit(0).cast("bigint")))).alias(
            f"{m}_{month_suffix(k)}"
        )
        for k in range(max_size)
        for m in PIVOT_METRICS
    ]


def window_features(
    monthly: DataFrame,
    complaints: DataFrame,
    specs: DataFrame,
    max_size: int,
    *,
    slopes: str = "yymm",
) -> DataFrame:
    """The full feature table for all windows: 72 features and 7 columns per month.

    One scan of the shipments, one shuffle of the monthly rows. ``slopes`` picks
    the trend axis: ``yymm`` (the number, with its jump at new year) or
    ``month_index``.
    """
    parts = customer_parts(monthly)  # one count for both sides, which are joined where they are
    base = window_base(monthly, specs, max_size, slopes=slopes, parts=parts)
    codes = complaint_stats(complaints, specs, max_size, parts=parts)
    return base.join(codes, WINDOW_KEYS, "left").select(*feature_columns(max_size))


def feature_columns(max_size: int) -> list[Column]:
    """Output columns of ``window_features`` over the aggregates of ``window_base``."""
    col = F.col
    services = [col(f"{s}_sum") for s in SERVICE_COLUMNS]
    service_total = services[0]
    for s in services[1:]:
        service_total = service_total + s
    window_days = (F.datediff("end_date", "start_date") + 1).cast("int")
    days_off = window_days - col("active_days")
    blocks = F.greatest(F.ceil(window_days / F.lit(30.0)), F.lit(1))

    def per_item(name: str) -> Column:
        return C.safe_ratio(col(name), col("item_sum"))

    def variation(m: str) -> Column:
        return F.coalesce(F.try_divide(col(f"{m}_std"), col(f"{m}_avg")), F.lit(0.0))

    def spread(m: str) -> Column:
        history = _history(m, max_size)
        return (F.array_max(history) - F.array_min(history)).cast("bigint")

    def extreme(m: str, which: str) -> Column:
        return _extreme_month(m, max_size, largest=which == "max").alias(f"{EXTREMES[m]}_{which}_month")

    def block(m: str) -> list[Column]:
        return [
            col(f"{m}_sum"), col(f"{m}_avg"), col(f"{m}_std"),
            extreme(m, "min"), extreme(m, "max"), _median(m, max_size).alias(f"{m}_median"),
        ]

    return [
        col(CUSTOMER), col("window_size"), col("window_start"), col("window_end"),
        *pivot_columns(max_size),
        *block("item"), *block("revenue"), *block("complaint"),
        F.coalesce("complaint_diversity", F.lit(0)).alias("complaint_diversity"), col("most_common_complaint"),
        col("weight_sum"), col("weight_avg"), col("weight_std"),
        per_item("revenue_sum").alias("avg_revenue_per_item"),
        per_item("weight_sum").alias("avg_weight_per_item"),
        per_item("_delay_sum").alias("pct_delay"),
        per_item("_refund_sum").alias("pct_refund"),
        per_item("_noaccepted_sum").alias("pct_noaccepted"),
        per_item("_lost_sum").alias("pct_lost_order"),
        per_item("complaint_sum").alias("pct_complaint"),
        C.safe_ratio(col("_months_with_complaint"), col("month_count")).alias("pct_complaint_per_item"),
        C.safe_ratio(col("item_sum").cast("double") - col("_nodone_sum"), col("item_sum")).alias("pct_successful_item"),
        per_item("_intra_sum").alias("pct_intra_province"),
        per_item("_intl_sum").alias("pct_international"),
        C.safe_ratio(col("_delay_days"), col("_delay_months")).alias("avg_delayday"),
        col("order_score_avg"), col("order_score_std"), extreme("order_score", "min"), extreme("order_score", "max"),
        col("satisfaction_avg"), col("satisfaction_std"), extreme("satisfaction", "min"), extreme("satisfaction", "max"),
        col("active_months"), (col("window_size") - col("active_months")).cast("int").alias("inactive_months"),
        col("active_days"), days_off.cast("int").alias("inactive_days"),
        (days_off.cast("double") / blocks).alias("avg_noservice_days"),
        F.lit(0).alias("max_consecutive_inactive"),
        col("avg_lastday"),
        *services,
        col("item_slope"), col("revenue_slope"), col("satisfy_slope"), col("complaint_slope"),
        variation("item").alias("cv_item"), variation("revenue").alias("cv_revenue"),
        spread("item").alias("item_range"), spread("revenue").alias("revenue_range"),
        C.count_positive(services).alias("service_types_used"),
        C.dominant_label(services).alias("dominant_service"),
        C.safe_ratio(F.greatest(*services), service_total).alias("dominant_service_ratio"),
        F.coalesce(F.datediff("end_date", "_last_date"), F.lit(0)).cast("int").alias("recency"),
        C.safe_ratio(col("item_sum"), col("active_months")).alias("frequency"),
        C.safe_ratio(col("revenue_sum"), col("active_months")).alias("monetary"),
    ]


def max_idle_run(monthly: DataFrame, specs: DataFrame, max_size: int) -> DataFrame:
    """Longest run of months without shipments inside each window."""
    rows = monthly.withColumn("month_idx", C.month_index(F.col("report_month"))).transform(by_customer)
    inside = into_windows(rows, F.col("month_idx"), specs, max_size).filter(F.col("item_count") > 0)
    # At most ``max_size`` rows per window.
    order = Window.partitionBy(*WINDOW_KEYS).orderBy("month_idx")
    start_idx = F.col("end_idx") - F.col("window_size") + 1
    before = F.coalesce(F.lag("month_idx").over(order), start_idx - 1)
    gaps = inside.withColumn("_gap", F.col("month_idx") - before - 1)
    return gaps.groupBy(*WINDOW_KEYS).agg(
        F.greatest(F.max("_gap"), F.max("end_idx") - F.max("month_idx")).cast("int").alias("max_idle_run")
    )


# --------------------------------------------------------------------------
# lifetime


def _lifetime_sums(df: DataFrame) -> list[Column]:
    """Additive parts of the lifetime features of customer-month rows."""
    s = lambda c: F.sum(c)
    late = F.col("delay_count") > 0
    return [
        s("item_count").cast("bigint").alias("_items"),
        s("total_fee").cast("bigint").alias("_fee"),
        s(F.col("weight_kg").cast("double")).alias("_weight"),
        s("total_complaint").cast("bigint").alias("_complaint"),
        s("delay_count").cast("bigint").alias("_delay"),
        s("refunded").cast("bigint").alias("_refund"),
        s("noaccepted").cast("bigint").alias("_noaccepted"),
        s("lost_order").cast("bigint").alias("_lost"),
        s("nodone").cast("bigint").alias("_nodone"),
        s(F.when(late, F.col("delay_day")).otherwise(0)).cast("bigint").alias("_late_days"),
        s(F.when(late, 1).otherwise(0)).cast("bigint").alias("_late_rows"),
        s(F.col("order_score").cast("double")).alias("_order"),
        F.count("order_score").alias("_order_n"),
        s(F.col("satisfaction_score").cast("double")).alias("_satisfaction"),
        F.count("satisfaction_score").alias("_satisfaction_n"),
        s("international").cast("bigint").alias("_intl"),
        s(F.when(F.col("intra_province") == 1, 1).otherwise(0)).cast("bigint").alias("_intra"),
    ]


LIFETIME_PARTS = (
    "_items _fee _weight _complaint _delay _refund _noaccepted _lost _nodone _late_days _late_rows "
    "_order _order_n _satisfaction _satisfaction_n _intl _intra"
).split()


def _lifetime_ratios() -> list[Column]:
    col = F.col

    def per_item(name: str) -> Column:
        return C.safe_ratio(col(name), col("_items"))

    return [
        col("_items").alias("lifetime_total_items"),
        col("_fee").alias("lifetime_total_revenue"),
        col("_weight").alias("lifetime_total_weight"),
        col("_complaint").alias("lifetime_total_complaint"),
        per_item("_fee").alias("lifetime_avg_revenue_per_item"),
        per_item("_weight").alias("lifetime_avg_weight_per_item"),
        col("_months").cast("int").alias("lifetime_months_active"),
        per_item("_delay").alias("lifetime_pct_delay"),
        per_item("_refund").alias("lifetime_pct_refund"),
        per_item("_noaccepted").alias("lifetime_pct_noaccepted"),
        per_item("_lost").alias("lifetime_pct_lost_order"),
        per_item("_complaint").alias("lifetime_pct_complaint"),
        C.safe_ratio(col("_items").cast("double") - col("_nodone"), col("_items")).alias("lifetime_pct_successful_item"),
        C.safe_ratio(col("_late_days"), col("_late_rows")).alias("lifetime_avg_delayday"),
        C.safe_ratio(col("_order"), col("_order_n")).alias("lifetime_avg_order_score"),
        C.safe_ratio(col("_satisfaction"), col("_satisfaction_n")).alias("lifetime_avg_satisfaction"),
        per_item("_intl").alias("lifetime_pct_international"),
        per_item("_intra").alias("lifetime_pct_intra_province"),
    ]


def _since(df: DataFrame, start: str, end: str | None = None) -> DataFrame:
    df = df.filter(F.col("report_month") >= F.lit(start).cast("date"))
    return df if end is None else df.filter(F.col("report_month") <= F.lit(end).cast("date"))


def lifetime_activity(customer_month: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Totals, ratios, first month and service sums per customer since ``start``."""
    summed = (
        _since(customer_month, start, end)
        .groupBy(CUSTOMER)
        .agg(
            *_lifetime_sums(customer_month),
            F.count("report_month").alias("_months"),
            F.min("report_month").alias("first_month"),
            *[F.sum(F.coalesce(s, F.lit(0))).cast("bigint").alias(s) for s in SERVICE_COLUMNS],
        )
    )
    return summed.select(CUSTOMER, "first_month", *_lifetime_ratios(), *SERVICE_COLUMNS)


def latest_per_key(info: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    """The row with the newest ``order`` value per key, NULLs last.

    Ties go to the largest remaining values, so the choice is total. An aggregate,
    not a sort: a hot key combines map-side.
    """
    newest = F.max(F.struct(order, *values)).alias("_r")
    return info.groupBy(key).agg(newest).select(key, F.col(f"_r.{order}").alias(order), *[F.col(f"_r.{v}").alias(v) for v in values])


INFO_VALUES = ["contract_classify", "contract_service", "custype", "tenure", "contract_mgr_org", "cus_poscode", "cus_province"]


def latest_info(info: DataFrame) -> DataFrame:
    """Newest contract row per customer, with the default class, service and type."""
    newest = latest_per_key(info, CUSTOMER, "contract_sig_first", INFO_VALUES)
    return newest.withColumns(
        {
            "contract_classify": F.coalesce("contract_classify", F.lit(1)),
            "contract_service": F.coalesce("contract_service", F.lit(62)),
            "custype": F.coalesce("custype", F.lit(1)),
        }
    )


def lifetime_shipments(shipments: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Active days, share of shipments with a complaint and usual destination per customer.

    One scan: every shipment counts for its month and for each of its places, in one
    aggregate that combines map-side; days are monthly bit sets. The smallest code wins when
    destinations tie, and no task holds the places of a customer.
    """
    scope = shipments.filter(F.col("sending_time") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        scope = date_range(scope, "sending_time", start, end)
    none = F.lit(None)
    month = C.month_index(F.col("sending_time")).cast("bigint")
    day = F.expr("shiftleft(1L, dayofmonth(sending_time) - 1)")
    complaint = F.when(F.col("total_complaint") > 0, 1).otherwise(0).cast("bigint")

    def part(kind: int, code: Column, name: Column, days: Column, hit: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), code.cast("bigint").alias("code"), name.cast("string").alias("name"), days.cast("bigint").alias("days"), hit.cast("bigint").alias("hit"))

    codes = [f"rec_{p}_code" for p in ("province", "district", "commune")]
    parts = [part(0, month, none, day, complaint)]
    parts += [part(k, F.col(c), none, none, none) for k, c in enumerate(codes, 1)]
    parts += [part(4, none, F.col("region"), none, none)]
    counted = (
        scope.select(CUSTOMER, F.explode(F.array(*parts)).alias("p"))
        .groupBy(CUSTOMER, "p.kind", "p.code", "p.name")
        .agg(F.bit_or("p.days").alias("days"), F.sum("p.hit").alias("hit"), F.count(F.lit(1)).alias("n"))
    )
    kind = F.col("kind")

    def usual(k: int, value: str) -> Column:
        # The most frequent value, then the smallest.
        return F.min(F.when((kind == k) & F.col(value).isNotNull(), F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"))))["v"]

    return counted.groupBy(CUSTOMER).agg(
        F.sum(F.when(kind == 0, F.bit_count("days"))).cast("int").alias("lifetime_days_active"),
        C.safe_ratio(F.sum(F.when(kind == 0, F.col("hit"))), F.sum(F.when(kind == 0, F.col("n")))).alias("lifetime_pct_complaint_per_item"),
        usual(1, "code").alias("most_common_rec_province"),
        usual(2, "code").alias("most_common_rec_district"),
        usual(3, "code").alias("most_common_rec_commune"),
        usual(4, "name").alias("most_common_region"),
    )


def customer_lifetime(
    customer_month: DataFrame,
    info: DataFrame,
    shipments: DataFrame,
    start: str,
    asof: str,
    end: str | None = None,
) -> DataFrame:
    """One wide row per customer. ``asof`` dates the tenure; ``end`` bounds the
    activity (none by default, so use the as-of tables for training)."""
    activity = lifetime_activity(customer_month, start, end)
    joined = activity.join(latest_info(info), CUSTOMER, "left").join(lifetime_shipments(shipments, start, end), CUSTOMER, "left")
    services = [F.col(s) for s in SERVICE_COLUMNS]
    signed = F.coalesce(F.to_date("contract_sig_first"), F.to_date(F.trunc("first_month", "MM")))
    # Nine digits first: sums of doubles differ in the last bits with the task order.
    ratio = lambda c: F.round(c, 9).cast("decimal(18,3)").alias(c)
    return joined.select(
        CUSTOMER,
        C.is_corporate(F.col(CUSTOMER)).alias("is_corporate"),
        F.coalesce("contract_classify", F.lit(1)).alias("contract_classify"),
        F.coalesce("contract_service", F.lit(62)).alias("contract_service"),
        F.coalesce("custype", F.lit(1)).alias("custype"),
        signed.alias("contract_sig_first"),
        F.coalesce("tenure", C.tenure_months(F.lit(asof).cast("date"), signed)).cast("int").alias("tenure"),
        "contract_mgr_org", "cus_poscode", "cus_province",
        "lifetime_total_items", "lifetime_total_revenue", ratio("lifetime_total_weight"), "lifetime_total_complaint",
        ratio("lifetime_avg_revenue_per_item"), ratio("lifetime_avg_weight_per_item"),
        "lifetime_months_active", F.coalesce("lifetime_days_active", F.lit(0)).alias("lifetime_days_active"),
        *[ratio(f"lifetime_pct_{r}") for r in ("delay", "refund", "noaccepted", "lost_order", "complaint")],
        F.round(F.coalesce("lifetime_pct_complaint_per_item", F.lit(0.0)), 9).cast("decimal(18,3)").alias("lifetime_pct_complaint_per_item"),
        ratio("lifetime_pct_successful_item"), ratio("lifetime_avg_delayday"),
        ratio("lifetime_avg_order_score"), ratio("lifetime_avg_satisfaction"),
        C.count_positive(services).alias("lifetime_service_types_count"),
        C.dominant_label(services, zero="U", otherwise="U").alias("lifetime_dominant_service"),
        ratio("lifetime_pct_international"), ratio("lifetime_pct_intra_province"),
        F.coalesce("most_common_rec_province", F.lit(0)).cast("bigint").alias("most_common_rec_province"),
        F.coalesce("most_common_rec_district", F.lit(0)).cast("bigint").alias("most_common_rec_district"),
        F.coalesce("most_common_rec_commune", F.lit(0)).cast("bigint").alias("most_common_rec_commune"),
        F.coalesce("most_common_region", F.lit("N/A")).alias("most_common_region"),
    )


def lifetime_asof(customer_month: DataFrame, start: str, asof: str) -> DataFrame:
    """Lifetime features of one as-of date, months counted once."""
    per_month = _since(customer_month, start, asof).groupBy(CUSTOMER, "report_month").agg(*_lifetime_sums(customer_month))
    summed = per_month.groupBy(CUSTOMER).agg(
        *[F.sum(p).alias(p) for p in LIFETIME_PARTS], F.count("report_month").alias("_months")
    )
    return summed.select(CUSTOMER, F.lit(asof).cast("date").alias("lifetime_asof_date"), *_lifetime_ratios())


def lifetime_asof_all(customer_month: DataFrame, specs: DataFrame, start: str) -> DataFrame:
    """Lifetime features as of every window end, in one pass.

    Running sums per customer change only in active months; each value is then
    repeated for the ends up to the next active month. The work is the size of
    the output, not months x ends.
    """
    ends = specs.select("end_idx", "end_date").distinct()
    last_idx = ends.agg(F.max("end_idx")).scalar()
    per_month = (
        _since(customer_month, start)
        .groupBy(CUSTOMER, C.month_index(F.col("report_month")).alias("month_idx"))
        .agg(*_lifetime_sums(customer_month))
        .withColumn("_months", F.lit(1).cast("bigint"))
    )
    order = Window.partitionBy(CUSTOMER).orderBy("month_idx")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    running = per_month.select(
        CUSTOMER,
        "month_idx",
        F.lead("month_idx").over(order).alias("_next"),
        *[F.sum(p).over(upto).alias(p) for p in [*LIFETIME_PARTS, "_months"]],
    )
    valid_to = F.least(F.coalesce(F.col("_next") - 1, F.col("_last_idx")), F.col("_last_idx"))
    spread = (
        running.withColumn("_last_idx", last_idx)
        .filter(F.col("month_idx") <= F.col("_last_idx"))
        .withColumn("end_idx", F.explode(F.sequence("month_idx", valid_to)))
        .join(F.broadcast(ends), "end_idx")
    )
    return spread.select(CUSTOMER, F.col("end_date").alias("lifetime_asof_date"), *_lifetime_ratios())


# --------------------------------------------------------------------------
# smoothed signals


def ewma(df: DataFrame, window_size: int, alpha: float, metrics: list[str] | None = None, *, order_parity: bool = False) -> DataFrame:
    """Exponentially smoothed level and last change of each monthly metric.

    Columns ``{metric}_last`` (or ``_t``), ``{metric}_1m_ago``, ... are read oldest
    first, NULL as 0. With fewer than two of them the level is the newest value
    and the change 0. The signal ``order`` reads the ``order_score`` columns unless
    ``order_parity`` is set, which keeps it constant 0.
    """
    from parcelwise.schemas import EWMA_METRICS

    out: dict[str, Column] = {}
    for metric in metrics or EWMA_METRICS:
        prefix = "order_score" if metric == "order" and not order_parity else metric
        newest = next((c for c in (f"{prefix}_last", f"{prefix}_t") if c in df.columns), None)
        older = [f"{prefix}_{k}m_ago" for k in range(window_size - 1, 0, -1)]
        series = [c for c in older if c in df.columns] + ([newest] if newest else [])
        level, previous = f"ewma_{metric}", f"delta_ewma_{metric}"
        if len(series) < 2:
            out[level] = F.col(newest).cast("double") if newest else F.lit(0.0)
            out[previous] = F.lit(0.0)
            continue
        values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in series]
        state = before = values[0]
        for v in values[1:]:
            before, state = state, v * alpha + state * (1 - alpha)
        out[level], out[previous] = state, state - before
    if "ewma_item" in out:
        out["ewma"], out["delta_ewma"] = out["ewma_item"], out["delta_ewma_item"]
    return df.withColumns(out)
