"""Scope, labels, tiers, pseudo-labels, weights, splits and scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions import columns as C
from parcelwise.functions.lineage import cut
from parcelwise.functions.quantiles import hash_sample
from parcelwise.operators.features import ewma, latest_info
from parcelwise.schemas import CUSTOMER, LEAKY_NAME_PARTS, MODEL_FEATURES

# --- fixed values: label, weight (None = the unlabelled weight) and smoothing group by label source
LABEL_SOURCES = {
    "confirmed": (1.0, 1.0, "confirmed"),
    "confirmed_eval": (1.0, 0.0, "confirmed"),
    "pseudo_churn": (1.0, 0.50, "pseudo"),
    "reliable_neg": (0.0, 0.80, "pseudo"),
    "pu_unlabeled": (0.0, None, "pseudo"),
}


# --------------------------------------------------------------------------
# scope


def working_set(lifetime: DataFrame, min_orders: int) -> DataFrame:
    """Customers with enough lifetime items."""
    return lifetime.filter(F.col("lifetime_total_items") >= min_orders)


def working_set_asof(customer_month: DataFrame, info: DataFrame, start: str, asof: str, min_orders: int) -> DataFrame:
    """The working set from activity up to ``asof`` only, with the newest contract row."""
    month = F.col("report_month")
    activity = (
        customer_month.filter(month.between(F.lit(start).cast("date"), F.lit(asof).cast("date")))
        .groupBy(CUSTOMER)
        .agg(
            F.sum("item_count").cast("bigint").alias("lifetime_total_items"),
            F.sum("total_fee").cast("bigint").alias("lifetime_total_revenue"),
            F.sum(F.col("weight_kg").cast("double")).alias("lifetime_total_weight"),
            F.sum("total_complaint").cast("bigint").alias("lifetime_total_complaint"),
            F.min("report_month").alias("first_month"),
            # Customer-month rows are unique per month after the roll-up, but raw
            # tables may repeat a month, so months are counted distinct.
            F.count_distinct("report_month").cast("int").alias("lifetime_months_active"),
        )
        .filter(F.col("lifetime_total_items") >= min_orders)
    )
    signed = F.coalesce(F.to_date("contract_sig_first"), F.col("first_month"))
    return activity.join(latest_info(info), CUSTOMER, "left").select(
        CUSTOMER,
        C.is_corporate(F.col(CUSTOMER)).alias("is_corporate"),
        "contract_classify",
        "contract_service",
        "custype",
        F.coalesce(F.to_date("contract_sig_first"), F.to_date(F.trunc("first_month", "MM"))).alias("contract_sig_first"),
        F.coalesce("tenure", C.tenure_months(F.lit(asof).cast("date"), signed)).cast("int").alias("tenure"),
        "contract_mgr_org",
        "cus_poscode",
        "cus_province",
        "lifetime_total_items",
        "lifetime_total_revenue",
        "lifetime_total_weight",
        "lifetime_total_complaint",
        "lifetime_months_active",
    )


def restrict_to_ids(ids: DataFrame, scope: DataFrame, *, inside: bool = True) -> DataFrame:
    """Distinct ids inside (or outside) the scope."""
    return ids.select(CUSTOMER).distinct().join(scope.select(CUSTOMER), CUSTOMER, "left_semi" if inside else "left_anti")


def scope_counts(ids: DataFrame, scope: DataFrame) -> DataFrame:
    """How many distinct ids lie inside and outside the scope."""
    known = scope.select(CUSTOMER).distinct().withColumn("_in", F.lit(True))
    flagged = ids.select(CUSTOMER).distinct().join(known, CUSTOMER, "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("total_ids"),
        F.count("_in").alias("inside_scope"),
        (F.count(F.lit(1)) - F.count("_in")).alias("outside_scope"),
    )


def drop_low_volume(df: DataFrame, minimum: int) -> DataFrame:
    return df.filter(F.col("item_sum") >= minimum)


# --------------------------------------------------------------------------
# recency, tiers and horizon labels


def recency(customer_month: DataFrame, t_obs: str, start: str) -> DataFrame:
    """Last active month and days from it to the observation date."""
    obs = F.lit(t_obs).cast("date")
    month = F.col("report_month")
    return (
        customer_month.filter(month.between(F.lit(start).cast("date"), obs))
        .groupBy(CUSTOMER)
        .agg(F.max("report_month").alias("last_active_month"))
        .withColumn("recency_days", C.days_between(obs, F.col("last_active_month")))
    )


def attach_recency(working: DataFrame, customer_month: DataFrame, t_obs: str, start: str, *, unknown: int = 9999) -> DataFrame:
    joined = working.join(recency(customer_month, t_obs, start), CUSTOMER, "left")
    return joined.withColumn("recency_days", F.coalesce("recency_days", F.lit(unknown)))


def assign_tiers(df: DataFrame, active: int = 90, at_risk: int = 180) -> DataFrame:
    return df.withColumn("tier", C.tier_label(F.col("recency_days"), active, at_risk))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def active_only(features: DataFrame, working: DataFrame) -> DataFrame:
    """Feature rows of customers in the active tier."""
    tiers = working.filter(F.col("tier") == "active").select(CUSTOMER, "tier", "recency_days")
    return features.join(tiers, CUSTOMER)


def horizon_activity(customer_month: DataFrame, end_month: str, horizon: int) -> DataFrame:
    """Items and revenue in the ``horizon`` months after ``end_month``."""
    end = F.lit(end_month).cast("date")
    months = F.col("report_month").between(F.add_months(end, 1), F.add_months(end, horizon))
    active = (F.col("item_count") > 0) | (F.col("total_fee") > 0)
    return customer_month.filter(months & active).groupBy(CUSTOMER).agg(
        F.sum("item_count").cast("bigint").alias("item_in_horizon"), F.sum("total_fee").cast("bigint").alias("rev_in_horizon")
    )


def _y_raw() -> Column:
    silent = (F.col("item_in_horizon") == 0) & (F.col("rev_in_horizon") == 0)
    return F.when(silent, 1).otherwise(0)


def build_label(features: DataFrame, customer_month: DataFrame, end_month: str, horizon: int) -> DataFrame:
    """Attach the horizon activity; ``y_raw`` is 1 without items and revenue."""
    joined = features.join(horizon_activity(customer_month, end_month, horizon), CUSTOMER, "left")
    return joined.fillna(0, ["item_in_horizon", "rev_in_horizon"]).withColumn("y_raw", _y_raw())


def training_windows(
    features: DataFrame,
    customer_month: DataFrame,
    ends: DataFrame,
    window_size: int,
    horizon: int,
    alpha: float,
    min_orders: int = 1,
) -> DataFrame:
    """Labelled rows of every valid training window of one size, in one join.

    ``ends`` lists the valid end months (``month``). Activity is copied to the
    ``horizon`` ends before it and summed per customer and end.
    """
    idx = C.month_index(F.col("month")).alias("end_idx")
    wanted = ends.select(idx, C.month_key(F.col("month")).alias("window_end"), F.col("month").alias("_end_month"))
    active = (F.col("item_count") > 0) | (F.col("total_fee") > 0)
    horizon_sums = (
        customer_month.filter(active)
        .withColumn("_ahead", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .withColumn("end_idx", C.month_index(F.col("report_month")) - F.col("_ahead"))
        .join(F.broadcast(wanted.select("end_idx", "window_end")), "end_idx")
        .groupBy(CUSTOMER, "window_end")
        .agg(
            F.sum("item_count").cast("bigint").alias("item_in_horizon"),
            F.sum("total_fee").cast("bigint").alias("rev_in_horizon"),
        )
    )
    rows = drop_low_volume(features.filter(F.col("window_size") == window_size), min_orders)
    rows = ewma(rows, window_size, alpha).join(F.broadcast(wanted.drop("end_idx")), "window_end")
    return (
        rows.join(horizon_sums, [CUSTOMER, "window_end"], "left")
        .fillna(0, ["item_in_horizon", "rev_in_horizon"])
        .withColumn("y_raw", _y_raw())
        .withColumn("_W", F.lit(window_size))
    )


# --------------------------------------------------------------------------
# confirmed ids, weights and pseudo-labels


def holdout_size(n: Column, frac: float) -> Column:
    """Ids to hold out of ``n``: at least one, never all."""
    wanted = F.greatest(F.lit(1), F.bround(n * F.lit(float(frac))).cast("bigint"))
    return F.when(n > 1, F.least(wanted, n - 1)).otherwise(F.lit(0))


def split_confirmed(ids: DataFrame, frac: float, seed: int) -> DataFrame:
    """Each confirmed id with ``is_holdout``; exact size, reproducible, disjoint."""
    unique = ids.select(CUSTOMER).distinct()
    if frac <= 0:
        return unique.withColumn("is_holdout", F.lit(False))
    unique = cut(unique)
    held = hash_sample(unique, CUSTOMER, lambda n: holdout_size(n, frac), frac, seed).withColumn("_h", F.lit(True))
    return unique.join(held, CUSTOMER, "left").select(CUSTOMER, F.coalesce("_h", F.lit(False)).alias("is_holdout"))


def pu_weight(confirmed: DataFrame, working: DataFrame, *, minimum: float = 0.01, fallback: float = 0.05) -> DataFrame:
    """Weight of unlabelled rows: confirmed over the other active customers."""
    n_active = working.agg(F.count(F.when(F.col("tier") == "active", 1)))
    both = confirmed.agg(F.count_distinct(CUSTOMER).alias("n_confirmed")).withColumn("n_active", n_active.scalar())
    ratio = F.col("n_confirmed") / F.greatest(F.col("n_active") - F.col("n_confirmed"), F.lit(1))
    weight = F.when(F.col("n_confirmed") > 0, F.greatest(ratio, F.lit(minimum))).otherwise(F.lit(fallback))
    return both.withColumn("pu_weight", weight)


def _flag_ids(df: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    flagged = ids.select(CUSTOMER).distinct().withColumn(name, F.lit(True))
    return df.join(flagged, CUSTOMER, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def pseudo_labels(
    scored: DataFrame,
    train_ids: DataFrame,
    holdout_ids: DataFrame,
    *,
    sim_threshold: float = 0.80,
    recency_reliable_neg: int = 30,
    trend_down_ratio: float = 0.85,
) -> DataFrame:
    """Label source of each row. ``scored`` carries ``sim_score``.

    Precedence: confirmed_eval, confirmed, reliable_neg, pseudo_churn, pu_unlabeled.
    """
    falling = F.col("delta_ewma") < 0
    if "item_last" in scored.columns:
        trend_down = (F.col("item_avg") > 0) & (F.col("item_last") < F.col("item_avg") * trend_down_ratio)
    else:
        trend_down = falling
    likely = (F.col("sim_score") > sim_threshold) & falling & trend_down
    steady = (F.col("recency_days") <= recency_reliable_neg) & (F.col("delta_ewma") >= 0)
    flagged = _flag_ids(_flag_ids(scored, train_ids, "_train"), holdout_ids, "_hold")
    source = (
        F.when(F.col("_hold"), "confirmed_eval")
        .when(F.col("_train"), "confirmed")
        .when(steady, "reliable_neg")
        .when(likely, "pseudo_churn")
        .otherwise("pu_unlabeled")
    )
    return flagged.withColumn("label_source", source).drop("_train", "_hold")


def weights_and_smoothing(
    df: DataFrame, pu_weight_c: float | Column, eps_confirmed: float = 0.0, eps_pseudo: float = 0.10
) -> DataFrame:
    """Hard label, sample weight and smoothed label from the label source."""
    c = pu_weight_c if isinstance(pu_weight_c, Column) else F.lit(float(pu_weight_c))
    eps = {"confirmed": eps_confirmed, "pseudo": eps_pseudo}
    source = F.col("label_source")

    def by_source(value) -> Column:
        return F.coalesce(*[F.when(source == s, value(*v)) for s, v in LABEL_SOURCES.items()])

    y = by_source(lambda label, _w, _g: F.lit(label))
    w = by_source(lambda _l, weight, _g: c if weight is None else F.lit(weight))
    e = by_source(lambda _l, _w, group: F.lit(float(eps[group])))
    return df.withColumns({"y_label": y, "sample_weight": w}).withColumn("y_smooth", C.smooth_label(F.col("y_label"), e))


# --------------------------------------------------------------------------
# final dataset


def leaky_features(names: Sequence[str], extra: Sequence[str] = ()) -> list[str]:
    """Names that contain a label or future word."""
    return [n for n in names if any(part in n.lower() for part in [*LEAKY_NAME_PARTS, *extra])]


def reject_leaky_features(names: Sequence[str]) -> None:
    bad = leaky_features(names)
    if bad:
        raise ValueError(f"these features would leak the label: {', '.join(bad)}")


def feature_projection(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The named features as doubles, NULL or absent ones as 0."""
    cols = [
        (F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in df.columns else F.lit(0.0)).alias(n) for n in names
    ]
    return df.select(*keep, *cols)


def eval_size(n: Column, frac: float) -> Column:
    """Rows to sample for evaluation; none from a single row."""
    return F.when(n >= 2, F.ceil(n * F.lit(float(frac)))).otherwise(F.lit(0))


def sample_eval(df: DataFrame, frac: float = 0.20, seed: int = 42, *, id_col: str = CUSTOMER) -> DataFrame:
    """Random evaluation rows, stratified by label when each class has two rows."""
    if frac <= 0:
        return df.limit(0)
    classes = df.groupBy("y_label").agg(F.count(F.lit(1)).alias("_n"))
    usable = classes.agg((F.count(F.lit(1)) > 1) & (F.min("_n") >= 2)).scalar()
    marked = df.withColumn("_stratum", F.when(usable, F.col("y_label").cast("string")).otherwise("all"))
    picked = hash_sample(marked, id_col, lambda n: eval_size(n, frac), frac, seed, ["_stratum"])
    return picked.drop("_stratum")


@dataclass
class Scaler:
    """Means and scales of the training features, one row per feature."""

    stats: DataFrame
    features: list[str]
    values: dict[str, tuple[float, float]] = field(default_factory=dict)


def scaler_stats(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and population scale per feature; a constant feature has scale 1."""
    wide = train.agg(
        *[
            # Constant by range: merged deviations can be off zero by rounding.
            F.struct(F.avg(f).alias("mean"), F.when(F.max(f) > F.min(f), F.stddev_pop(f)).otherwise(0.0).alias("std")).alias(f)
            for f in features
        ]
    )
    rows = wide.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("s")) for f in features])).alias("r"))
    std = F.col("r.s.std")
    return rows.select(
        F.col("r.feature").alias("feature"), F.col("r.s.mean").alias("mean"), F.when(std == 0, F.lit(1.0)).otherwise(std).alias("scale")
    )


def fit_scaler(train: DataFrame, features: Sequence[str]) -> Scaler:
    """Fit on the training rows only. One row per feature reaches the driver."""
    stats = scaler_stats(train, features)
    values = {r["feature"]: (r["mean"], r["scale"]) for r in stats.collect()}
    return Scaler(stats, list(features), values)


def apply_scaler(df: DataFrame, scaler: Scaler) -> DataFrame:
    scaled = {f: (F.col(f) - F.lit(scaler.values[f][0])) / F.lit(scaler.values[f][1]) for f in scaler.features}
    return df.withColumns(scaled)


@dataclass
class Dataset:
    """Prepared rows: scaled ``train``, ``evaluation`` and ``predict`` frames."""

    train: DataFrame
    evaluation: DataFrame
    predict: DataFrame
    active: DataFrame
    scaler: Scaler
    features: list[str]
    metadata: dict = field(default_factory=dict)


def split_active(active: DataFrame, holdout_ids: DataFrame, frac: float = 0.20, seed: int = 42) -> DataFrame:
    """Active rows with ``_dataset_split``: confirmed holdout and sampled rows are eval."""
    flagged = _flag_ids(active, holdout_ids, "_hold")
    pool = flagged.filter(~F.col("_hold")).select(CUSTOMER, "y_label")
    sampled = sample_eval(pool, frac, seed).select(CUSTOMER)
    flagged = _flag_ids(flagged, sampled, "_sampled")
    split = F.when(F.col("_hold") | F.col("_sampled"), "eval").otherwise("train")
    return flagged.withColumn("_dataset_split", split).drop("_hold", "_sampled")


def training_rows(active_split: DataFrame, history: DataFrame | None, features: Sequence[str]) -> DataFrame:
    """Unscaled training rows: active rows with their smoothed label, and history rows
    with their own horizon label and weight 1."""
    current = feature_projection(
        active_split.filter(F.col("_dataset_split") == "train"),
        features,
        [F.col(CUSTOMER), F.col("y_smooth").alias("y"), F.col("sample_weight").alias("w")],
    )
    if history is None:
        return current
    past = feature_projection(
        history, features, [F.col(CUSTOMER), (F.col("y_raw") == 1).cast("double").alias("y"), F.lit(1.0).alias("w")]
    )
    return current.unionByName(past)


def final_dataset(
    active: DataFrame,
    history: DataFrame | None,
    holdout_ids: DataFrame,
    feature_names: Sequence[str] | None = None,
    *,
    seed: int = 42,
    frac: float = 0.20,
) -> Dataset:
    """Split, project, merge history and scale. The scaler sees training rows only."""
    features = [f for f in (feature_names or MODEL_FEATURES) if f in active.columns]
    reject_leaky_features(features)
    split = cut(split_active(active, holdout_ids, frac, seed))
    # Rebalanced: the windows leave several partitions per shuffle partition and size, each a task of every later pass.
    train = cut(training_rows(split, history, features).hint("rebalance"))
    scaler = fit_scaler(train, features)
    keep_eval = [F.col(CUSTOMER), F.col("y_label").alias("y")]
    evaluation = feature_projection(split.filter(F.col("_dataset_split") == "eval"), features, keep_eval)
    predict = feature_projection(split, features, [F.col(CUSTOMER)])
    return Dataset(
        apply_scaler(train, scaler),
        apply_scaler(evaluation, scaler),
        apply_scaler(predict, scaler),
        split,
        scaler,
        features,
    )


def sanity_report(ds: Dataset, holdout_ids: DataFrame) -> DataFrame:
    """Seven checks as rows ``(check_no, check, value, passed, critical)``."""
    spark = ds.train.sparkSession
    per_id = ds.active.groupBy(CUSTOMER).agg(
        F.max((F.col("_dataset_split") == "train").cast("int")).alias("t"),
        F.max((F.col("_dataset_split") == "eval").cast("int")).alias("e"),
    )
    held = _flag_ids(per_id, holdout_ids, "_hold")
    missing = holdout_ids.select(CUSTOMER).distinct().join(per_id.filter("e = 1"), CUSTOMER, "left_anti")
    nulls = F.lit(0)
    for f in ds.features:
        nulls = nulls + F.when(F.col(f).isNull() | F.isnan(f), 1).otherwise(0)

    def row(no: int, name: str, agg: DataFrame, passed: Column, critical: bool) -> DataFrame:
        value = F.coalesce(F.col("v").cast("double"), F.lit(0.0))
        return agg.select(
            F.lit(no).alias("check_no"), F.lit(name).alias("check"), value.alias("value"),
            F.coalesce(passed, F.lit(False)).alias("passed"), F.lit(critical).alias("critical"),
        )

    v = F.col("v")
    count_if = lambda c: F.count(F.when(c, 1)).alias("v")
    constant = lambda x: spark.range(1).select(F.lit(float(x)).alias("v"))
    n_missing = missing.agg(F.count(F.lit(1))).scalar()
    in_train = F.count(F.when(F.col("_hold") & (F.col("t") == 1), 1))
    misplaced = held.agg(in_train.alias("v1")).select((F.col("v1") + n_missing).alias("v"))
    checks = [
        row(1, "split_overlap", per_id.agg(count_if((F.col("t") == 1) & (F.col("e") == 1))), v == 0, True),
        row(2, "train_positive_share", ds.train.agg(F.avg((F.col("y") > 0.5).cast("double")).alias("v")), v.between(0.03, 0.35), False),
        row(3, "null_weights", ds.train.agg(count_if(F.col("w").isNull())), v == 0, True),
        row(4, "null_features", ds.train.agg(F.sum(nulls).alias("v")), v == 0, True),
        row(5, "scaler_fitted", constant(len(ds.scaler.values)), v == len(ds.features), True),
        row(6, "holdout_misplaced", misplaced, v == 0, True),
        row(7, "leaky_names", constant(len(leaky_features(ds.features, ["horizon"]))), v == 0, True),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def raise_on_failure(report: DataFrame) -> bool:
    """Raise on a failed critical check; False when only a warning failed."""
    failed = report.filter(~F.col("passed")).collect()  # at most seven rows
    critical = [r["check"] for r in failed if r["critical"]]
    if critical:
        raise ValueError(f"Sanity check failed: {critical}")
    return not failed
