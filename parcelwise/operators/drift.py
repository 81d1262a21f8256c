"""Reference profiles, stability indices, score drift, backtests and run logs."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.functions import columns as C
from parcelwise.functions.lineage import cut
from parcelwise.functions.quantiles import column_quantiles, exact_quantiles
from parcelwise.operators.eda import present
from parcelwise.schemas import CUSTOMER

SHARE_FLOOR = 1e-8


# --------------------------------------------------------------------------
# profiles and stability


def numeric_edges(df: DataFrame, features: Sequence[str], n_bins: int = 10) -> DataFrame:
    """Bin edges per feature with values: distinct quantiles; a nearly constant feature gets one wide bin."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = column_quantiles(df, features, probs)
    distinct = F.array_distinct("quantiles")
    low, high = F.get("quantiles", F.lit(0)), F.get("quantiles", F.lit(n_bins))
    edges = F.when(F.size(distinct) >= 3, distinct).otherwise(F.array(low - 1e-6, high + 1e-6))
    return q.select("feature", "n", edges.alias("edges"))


def bin_counts(df: DataFrame, edges: DataFrame, keys: Sequence[str] = (), *, clamp: bool = False) -> DataFrame:
    """Values per key, feature and zero-based bin ``[lo, hi)``; the last bin is closed.

    Values outside the edges are dropped, unless ``clamp`` puts them into the end bins. Tasks count
    whole columns; there is one edge array per feature, and keys are not NULL.
    """
    keys = list(keys)
    known = {r["feature"]: np.array(r["edges"]) for r in edges.select("feature", "edges").collect() if r["feature"] in df.columns}
    wide = df.select(*keys, *[C.finite_double(F.col(f)).alias(f"_c{k}") for k, f in enumerate(known)])
    key_ddl = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)
    parts = wide.mapInPandas(_bin_partials(known, keys, clamp), f"{key_ddl}feature string, bin int, cnt bigint")
    return parts.groupBy(*keys, "feature", "bin").agg(F.sum("cnt").alias("cnt"))


def _bin_partials(edges: dict[str, np.ndarray], keys: list[str], clamp: bool):
    """Values per key, feature and left-closed bin, summed over the rows of a task."""
    width = max((len(e) for e in edges.values()), default=0)

    def run(batches):
        sums: dict[tuple, np.ndarray] = {}  # per key: features x bins
        for pdf in batches:
            if not len(pdf):
                continue
            if keys:
                groups = pdf.groupby(keys, sort=False)
                place, found = groups.ngroup().to_numpy(np.int64), [tuple(r) for r in groups.head(1)[keys].itertuples(index=False)]
            else:
                place, found = np.zeros(len(pdf), np.int64), [()]
            counts = np.zeros((len(found), len(edges), width), np.int64)
            for k, e in enumerate(edges.values()):
                v = pdf[f"_c{k}"].to_numpy(dtype=float)
                at = np.searchsorted(e, v, side="right") - 1
                inside = ~np.isnan(v) if clamp else (at >= 0) & (v <= e[-1])
                at = np.clip(at, 0, len(e) - 2)
                counts[:, k] = np.bincount(place[inside] * width + at[inside], minlength=len(found) * width).reshape(-1, width)
            for key, part in zip(found, counts):
                sums[key] = sums.get(key, 0) + part
        names = np.array(list(edges), dtype=object)
        for key, total in sums.items():
            of, at = np.nonzero(total)
            frame = pd.DataFrame({"feature": names[of], "bin": at.astype("int32"), "cnt": total[of, at]})
            for j, name in enumerate(keys):
                frame.insert(j, name, [key[j]] * len(frame))
            yield frame

    return run


def numeric_profile(df: DataFrame, features: Sequence[str], n_bins: int = 10) -> DataFrame:
    """Reference profile: ``feature, n, bin, lo, hi, train_count``, for every feature
    that has values."""
    edges = cut(numeric_edges(df, present(df, features), n_bins))  # one row per feature, read twice
    counts = bin_counts(df, edges)
    slots = edges.select("feature", "n", "edges", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin"))
    return slots.join(counts, ["feature", "bin"], "left").select(
        "feature",
        "n",
        "bin",
        F.get("edges", F.col("bin")).alias("lo"),
        F.get("edges", F.col("bin") + 1).alias("hi"),
        F.coalesce("cnt", F.lit(0)).alias("train_count"),
    )


def categorical_profile(df: DataFrame, columns: Sequence[str], top: int = 30) -> DataFrame:
    """The most frequent values per text column, NULL as ``NA``."""
    names = present(df, columns)
    text = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NA")).alias(c) for c in names])
    long = text.unpivot([], names, "feature", "value")
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))
    totals = counts.groupBy("feature").agg(F.sum("cnt").alias("n"))
    # ``row_number() <= top`` keeps only ``top`` rows per task before the shuffle.
    order = Window.partitionBy("feature").orderBy(F.col("cnt").desc(), "value")
    best = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(F.broadcast(totals), "feature").select("feature", "rank", "value", "cnt", "n")


def profile_edges(profile: DataFrame) -> DataFrame:
    """Edge arrays back from a stored profile."""
    bins = F.sort_array(F.collect_list(F.struct("bin", "lo", "hi")))
    edges = F.concat(F.transform(bins, lambda b: b["lo"]), F.array(F.element_at(bins, -1)["hi"]))
    return profile.groupBy("feature").agg(edges.alias("edges"))


def counts_on_profile(df: DataFrame, profile: DataFrame, *, clamp: bool = False) -> DataFrame:
    """Current values per stored bin, zero where empty; values outside the edges are
    dropped (or put into the end bins with ``clamp``)."""
    counts = bin_counts(df.drop(CUSTOMER), profile_edges(profile), clamp=clamp)
    return profile.join(counts, ["feature", "bin"], "left").select(
        "feature", "bin", "lo", "hi", "train_count", F.coalesce("cnt", F.lit(0)).alias("cur_count")
    )


def stability(counts: DataFrame, keys: Sequence[str] = ("feature",)) -> DataFrame:
    """Population stability index and discrete KS distance per key.

    Shares are kept within ``[1e-8, 1]``. A side without any count has share 0
    everywhere, which makes the index infinite.
    """
    keys = list(keys)
    whole = Window.partitionBy(*keys)  # one row per bin

    def share(c: str) -> Column:
        total = F.sum(c).over(whole)
        return F.when(total > 0, F.greatest(F.least(F.col(c) / total, F.lit(1.0)), F.lit(SHARE_FLOOR))).otherwise(0.0)

    shares = counts.withColumns({"_t": share("train_count"), "_c": share("cur_count")})
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    gaps = shares.withColumn("_gap", F.abs(F.sum("_t").over(upto) - F.sum("_c").over(upto)))
    empty = (F.col("_t") == 0) | (F.col("_c") == 0)
    term = F.when(empty, F.lit(float("inf"))).otherwise(
        (F.col("_c") - F.col("_t")) * F.ln(F.col("_c") / F.when(F.col("_t") > 0, F.col("_t")))
    )
    return gaps.groupBy(*keys).agg(F.sum(term).alias("psi"), F.max("_gap").alias("ks_stat"))


def feature_drift(current: DataFrame, profile: DataFrame) -> DataFrame:
    """Drift of every profiled feature; one missing from the current rows is an alert.

    The profile (one row per feature and bin) is stored first: three steps read it.
    """
    profile = cut(profile)
    absent = ~F.col("feature").isin([c for c in current.columns if c != CUSTOMER])
    scored = stability(counts_on_profile(current, profile))
    names = [c for c in current.columns if c != CUSTOMER]
    known = current.agg(*[F.count(C.finite_double(F.col(f))).alias(f) for f in names])
    sizes = known.unpivot([], names, "feature", "_cur_n")
    base = profile.groupBy("feature").agg(F.max("n").alias("_train_n"))
    joined = base.join(scored, "feature", "left").join(sizes, "feature", "left").withColumn("_absent", absent)
    psi = F.when(~F.col("_absent"), F.col("psi"))
    details = F.when(F.col("_absent"), F.to_json(F.struct(F.lit("missing_in_current").alias("reason")))).otherwise(
        F.to_json(F.struct(F.col("_train_n").alias("train_n"), F.coalesce("_cur_n", F.lit(0)).alias("cur_n")))
    )
    severity = C.severity(psi)
    return joined.select(
        F.col("feature").alias("feature_name"),
        psi.alias("psi"),
        F.when(~F.col("_absent"), F.col("ks_stat")).alias("ks_stat"),
        severity.alias("severity"),
        (severity == "ALERT").alias("is_anomaly"),
        details.alias("details_json"),
    )


def monthly_drift(df: DataFrame, features: Sequence[str], month: str, n_bins: int = 10) -> DataFrame:
    """Each later month against the first one, for all features in one job."""
    first = df.agg(F.min(month)).scalar()
    reference = cut(numeric_profile(df.filter(F.col(month) == first), features, n_bins))
    later = df.select(month).distinct().filter(F.col(month) > first)
    months = F.array(*[F.lit(r[0]) for r in later.collect()]).cast(T.ArrayType(df.schema[month].dataType))  # bounded by the calendar
    counts = bin_counts(df.filter(F.col(month) > first), profile_edges(reference), [month])
    slots = reference.withColumn(month, F.explode(months))
    filled = slots.join(counts, [month, "feature", "bin"], "left").withColumn("cur_count", F.coalesce("cnt", F.lit(0)))
    psi = F.col("psi")
    return (
        stability(filled, [month, "feature"])
        .withColumn("reference_month", first)
        .select(
            "reference_month",
            F.col(month).alias("comparison_month"),
            F.col("feature").alias("feature_name"),
            F.when(psi == float("inf"), psi).otherwise(F.bround(psi, 6)).alias("psi"),
            F.bround("ks_stat", 6).alias("ks_stat"),
            C.severity(psi).alias("severity"),
        )
    )


# --------------------------------------------------------------------------
# scores


def score_stats(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and quantiles of the scores, flagged and active rows, risk ratio."""
    keys = list(keys)
    grouped = scored if keys else scored.withColumn("_all", F.lit(1))
    by = keys or ["_all"]
    q = exact_quantiles(grouped, by, "churn_probability", [0.5, 0.9, 0.99])
    sums = grouped.groupBy(*by).agg(
        F.avg("churn_probability").alias("mean"),
        F.coalesce(F.sum("churn_flag"), F.lit(0)).cast("bigint").alias("risk_count"),
        F.count(F.lit(1)).alias("active_count"),
    )
    at = lambda i: F.get("quantiles", F.lit(i))
    return sums.join(q, by, "left").select(
        *keys, "mean", at(0).alias("p50"), at(1).alias("p90"), at(2).alias("p99"), "risk_count", "active_count",
        (F.col("risk_count") / F.greatest("active_count", F.lit(1))).alias("risk_ratio"),
    )


def risk_ratio_anomaly(history: DataFrame, n: int = 6) -> DataFrame:
    """Flag ratios above ``median + 3 * (MAD + 1e-9)`` of the ``n`` runs up to and
    including any earlier run of the same window.

    ``history`` has one row per horizon and window end, so a horizon holds one row
    per month. At least four known ratios are needed.
    """
    frame = Window.partitionBy("horizon").orderBy("window_end").rowsBetween(-n, -1)
    past = F.sort_array(F.collect_list("risk_ratio").over(frame))  # NULLs are not collected

    def median(a: Column) -> Column:
        k = F.size(a)
        low = F.get(a, F.floor((k - 1) / 2).cast("int"))
        high = F.get(a, F.floor(k / 2).cast("int"))
        return (low + high) / 2

    step = history.withColumn("_past", past).withColumn("_med", median(F.col("_past")))
    step = step.withColumn("_mad", median(F.sort_array(F.transform("_past", lambda x: F.abs(x - F.col("_med"))))))
    limit = F.col("_med") + (F.col("_mad") + 1e-9) * 3.0
    known = F.size("_past") >= 4
    flag = F.coalesce(known & (F.col("risk_ratio") > limit), F.lit(False))
    reason = F.format_string("risk_ratio %.4f > median+3*MAD (%.4f) over last %d", "risk_ratio", limit, F.size("_past"))
    return (
        step.withColumn("anomaly_limit", F.when(known, limit))
        .withColumn("is_anomaly", flag)
        .withColumn("anomaly_reason", F.when(flag, reason))
        .drop("_past", "_med", "_mad")
    )


def score_drift(scored: DataFrame, history: DataFrame, *, window_end: int, horizon: int, best_k: int | None, churned_now: int, risk_pct: int, n: int = 6) -> DataFrame:
    """The monitoring row of one scoring run.

    The stored row of the same window, if any, is part of the comparison.
    """
    stats = score_stats(scored)
    recent = (
        history.filter(F.col("horizon") == horizon).orderBy(F.col("window_end").desc()).limit(n)
    )  # n rows
    ratios = F.sort_array(F.collect_list("risk_ratio"))
    past = recent.agg(ratios.alias("p")).scalar()
    row = stats.select(
        F.lit(window_end).alias("window_end"), F.lit(horizon).alias("horizon"), F.lit(best_k).cast("int").alias("best_k"),
        F.col("active_count").cast("int").alias("active_cnt"), F.lit(churned_now).alias("churned_now_cnt"),
        F.col("mean").alias("mean_score"), "p50", "p90", "p99", F.lit(risk_pct).alias("risk_threshold_pct"),
        F.col("risk_count").cast("int").alias("risk_cnt"),
        F.when(F.col("active_count") > 0, F.col("risk_ratio")).alias("risk_ratio"),
        past.alias("_past"),
    )
    k = F.size("_past")
    mid = lambda a: (F.get(a, F.floor((k - 1) / 2).cast("int")) + F.get(a, F.floor(k / 2).cast("int"))) / 2
    row = row.withColumn("_med", mid(F.col("_past")))
    row = row.withColumn("_mad", mid(F.sort_array(F.transform("_past", lambda x: F.abs(x - F.col("_med"))))))
    limit = F.col("_med") + (F.col("_mad") + 1e-9) * 3.0
    flag = F.coalesce((k >= 4) & (F.col("risk_ratio") > limit), F.lit(False))
    reason = F.format_string("risk_ratio %.4f > median+3*MAD (%.4f) over last %d", "risk_ratio", limit, k)
    return row.withColumn("is_anomaly", flag).withColumn("anomaly_reason", F.when(flag, reason)).drop("_past", "_med", "_mad")


def precision_in_list(predictions: DataFrame, labels: DataFrame, *, flag: str = "churn_flag", label: str = "churned") -> DataFrame:
    """Precision, recall and F1 of the flagged list against later labels."""
    known = labels.select(CUSTOMER, F.coalesce(F.col(label).cast("int"), F.lit(0)).alias("_y"))
    flagged = predictions.filter(F.col(flag) == 1).select(CUSTOMER).join(known, CUSTOMER, "left")
    hits = flagged.agg(F.count(F.lit(1)).alias("list_size"), F.coalesce(F.sum("_y"), F.lit(0)).alias("churn_true_in_list"))
    active = predictions.agg(F.count(F.lit(1))).scalar()
    total = known.agg(F.coalesce(F.sum("_y"), F.lit(0))).scalar()
    row = hits.withColumns({"active_cnt": active, "churn_true_total": F.when(active > 0, total).otherwise(0)})
    p = F.try_divide(F.col("churn_true_in_list"), F.col("list_size"))
    r = F.try_divide(F.col("churn_true_in_list"), F.col("churn_true_total"))
    return row.select(
        "active_cnt", "list_size", "churn_true_total", "churn_true_in_list",
        p.alias("precision_in_list"), r.alias("recall_in_list"), F.try_divide(p * r * 2, p + r).alias("f1_in_list"),
    )


def backtest_row(metrics: DataFrame, *, pred_window_end: int, label_window_end: int, horizon: int, best_k: int | None, risk_pct: int) -> DataFrame:
    """A backtest row keyed by ``(pred_window_end, horizon)``, ready to merge."""
    return metrics.select(
        F.lit(pred_window_end).alias("pred_window_end"), F.lit(label_window_end).alias("label_window_end"),
        F.lit(horizon).alias("horizon"), F.lit(best_k).cast("int").alias("best_k"),
        F.lit(risk_pct).alias("risk_threshold_pct"), "*",
    )


# --------------------------------------------------------------------------
# run log


def start_run(log: DataFrame, rows: DataFrame) -> DataFrame:
    """The log with new runs added; a known run id is left alone."""
    from parcelwise.sources.upsert import insert_if_absent

    return insert_if_absent(log, rows, ["run_id"])


def finish_run(log: DataFrame, updates: DataFrame) -> DataFrame:
    """The log with the given fields of known runs filled in; NULL keeps the old value."""
    fields = [c for c in updates.columns if c != "run_id" and c in log.columns]
    new = updates.select("run_id", *[F.col(c).alias(f"_new_{c}") for c in fields])
    joined = log.join(new, "run_id", "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in fields else F.col(c) for c in log.columns])


def latest_runs(log: DataFrame, order: str, n: int = 20, tie: Sequence[str] = ()) -> DataFrame:
    return log.orderBy(F.col(order).desc(), *tie).limit(n)
