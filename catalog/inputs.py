"""Shared inputs of the catalogue queries, built from the given tables."""

from __future__ import annotations

import calendar
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.operators import features as X
from parcelwise.operators import labels as L
from parcelwise.operators import rollup as R
from parcelwise.plans import windows as P
from parcelwise.schemas import MODEL_FEATURES
from parcelwise.session import tune
from parcelwise.sources import adapters as A

HISTORY = "1995-01-01"  # first day of all activity
FUTURE = "2001-12-31"  # after the last day of all activity
T_OBS = "2001-08-01"
END_MONTH = "2001-07-01"
END_KEY = "0107"
SIZES = [3, 4, 5, 6]
MAX_SIZE = 6
W = 3
HORIZON = 2
ALPHA = 0.3
SEED = 42

#: All model features, and two with NULLs.
EDA_FEATURES = [*MODEL_FEATURES, "known_delay", "known_ratio"]
TOP_FEATURES = ["item_sum", "recency", "pct_delay"]


class Inputs:
    """Lazy frames over one data directory. ``keep`` persists what one query reads several times.

    Customer-months and windows are not among it: they are wide and many times the shipments, and a query
    that takes a few of their columns or windows builds only those. Windows cover every month of the data between ``first`` and ``last``, by default all of them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, keep: bool = True, first: str = HISTORY, last: str = FUTURE):
        self.spark, self.sf_dir, self.keep = tune(spark), sf_dir, keep
        self.first, self.last = first, last
        self.memo: dict[str, object] = {}

    def _kept(self, df: DataFrame) -> DataFrame:
        return df.persist() if self.keep else df

    def table(self, name: str) -> DataFrame:
        return A.table(self.spark, self.sf_dir, name)

    @cached_property
    def shipments(self) -> DataFrame:
        return A.shipments(self.spark, self.sf_dir)

    @cached_property
    def complaints(self) -> DataFrame:
        return A.complaints(self.spark, self.sf_dir)

    @cached_property
    def info(self) -> DataFrame:
        return A.customer_info(self.spark, self.sf_dir)

    @cached_property
    def confirmed(self) -> DataFrame:
        return A.confirmed(self.spark, self.sf_dir)

    @cached_property
    def monthly(self) -> DataFrame:
        """Customer-months of the window plan, with day sets."""
        return R.monthly_rollup(self.shipments, self.first, self.last, with_days=True)

    @cached_property
    def customer_month(self) -> DataFrame:
        """All customer-months."""
        return R.monthly_rollup(self.shipments, HISTORY, FUTURE)

    @cached_property
    def months(self) -> DataFrame:
        bounds = self.shipments.agg(
            F.greatest(F.min("sending_time").cast("date"), F.lit(self.first).cast("date")).alias("start_date"),
            F.least(F.max("sending_time").cast("date"), F.lit(self.last).cast("date")).alias("end_date"),
        )
        return P.month_range(self._kept(bounds))  # one row

    @cached_property
    def specs(self) -> DataFrame:
        return P.window_specs(self.months, SIZES, self.first)

    @cached_property
    def base(self) -> DataFrame:
        return X.window_base(self.monthly, self.specs, MAX_SIZE)

    @cached_property
    def features(self) -> DataFrame:
        return X.window_features(self.monthly, self.complaints, self.specs, MAX_SIZE)

    @cached_property
    def sized(self) -> DataFrame:
        """``features`` of the model's size, with as many monthly columns as it has."""
        return X.window_features(self.monthly, self.complaints, P.window_specs(self.months, [W], self.first), W)

    def window(self, end: str, size: int = W) -> DataFrame:
        """``features`` of one window, from the shipments and complaints of its months alone."""
        year, month = 2000 + int(end[:2]), int(end[2:])
        first = year * 12 + month - size
        start, stop = f"{first // 12}-{first % 12 + 1:02d}-01", f"{year}-{month:02d}-{calendar.monthrange(year, month)[1]}"
        shipments = R.date_range(self.shipments, "sending_time", start, stop, inclusive_end_day=True)
        complaints = R.date_range(self.complaints, "create_complaint_date", start, stop, inclusive_end_day=True)
        specs = self.specs.filter((F.col("window_size") == size) & (F.col("window_end") == end))
        return X.window_features(R.monthly_rollup(shipments, self.first, self.last, with_days=True), complaints, specs, MAX_SIZE)

    @cached_property
    def eda(self) -> DataFrame:
        """``eda_rows``, persisted for what reads them several times."""
        return self._kept(self.eda_rows)

    @cached_property
    def eda_rows(self) -> DataFrame:
        """All three-month windows with their smoothed signals, two features with NULLs and a target.

        Doubles have nine digits: their last bits depend on the order of sums, and a value on a bin's
        edge must not change sides with it.
        """
        rows = X.ewma(self.sized, W, ALPHA)
        rows = rows.withColumns(
            {
                "known_delay": F.when(F.col("avg_delayday") > 0, F.col("avg_delayday")),
                "known_ratio": F.when(F.col("service_types_used") >= 3, F.col("dominant_service_ratio")),
                "target": F.when(F.col("recency") > 60, 1).otherwise(0),
            }
        ).select("cms_code_enc", "window_end", "target", *EDA_FEATURES)
        doubles = {f.name: F.round(f.name, 9) + 0.0 for f in rows.schema.fields if f.dataType.typeName() == "double"}
        return rows.withColumns(doubles)

    @cached_property
    def current(self) -> DataFrame:
        """Features of the newest window with the horizon label."""
        return L.build_label(self.window(END_KEY), self.customer_month, END_MONTH, HORIZON)

    @cached_property
    def scored(self) -> DataFrame:
        """The newest window with a made score: ties occur on purpose."""
        key = F.substring("cms_code_enc", 2, 8).cast("bigint")
        return self._kept(
            self.current.withColumn("churn_probability", ((key * 7919) % 1000) / 1000.0).withColumn("label", F.col("y_raw"))
        )

    @cached_property
    def working(self) -> DataFrame:
        """Customers in scope with recency and tier."""
        scope = L.working_set_asof(self.customer_month, self.info, HISTORY, T_OBS, 3)
        return self._kept(L.assign_tiers(L.attach_recency(scope, self.customer_month, T_OBS, HISTORY)))

    @cached_property
    def risk(self) -> DataFrame:
        """Scored rows as a risk list with rates in percent and reasons."""
        from parcelwise.operators import evaluate as E

        flagged = E.top_percent_threshold(self.scored, 0.5, 50.0)
        return self._kept(E.reasons(flagged, TOP_FEATURES).withColumn("churn_rate", F.col("churn_probability") * 100.0))


_known: dict[tuple[str, str], Inputs] = {}


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _known:
        _known[key] = Inputs(spark, sf_dir)
    return _known[key]


def tidy(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Fixed output types: doubles rounded, decimals as doubles, dates and times as text."""
    cols = []
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("double", "float") or kind.startswith("decimal"):
            c = F.round(c.cast("double"), special.get(f.name, digits)) + 0.0
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind in ("byte", "short", "integer", "long"):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
