"""Thresholds, evaluation metrics, gates and configuration history.

Everything that sweeps over scores works on counts per distinct score, so equal
scores are one row and the sweep is a bucketed running sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.lineage import cut
from parcelwise.functions.prefix import running_totals
from parcelwise.functions.quantiles import exact_quantiles

METRICS = ["f1", "f05", "precision", "recall", "pr_auc", "roc_auc", "threshold", "n_eval", "n_pos", "n_neg"]


def score_counts(scored: DataFrame, score: str = "churn_probability", label: str = "label") -> DataFrame:
    """Positives and rows per distinct score."""
    y = F.col(label).cast("int")
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).alias("pos"), F.count(F.lit(1)).alias("cnt")
    )


def pr_curve(scored: DataFrame, score: str = "churn_probability", label: str = "label") -> DataFrame:
    """Precision and recall when flagging every row at or above each distinct score."""
    counts = cut(score_counts(scored, score, label).withColumn("_all", F.lit(1)))
    swept = running_totals(counts, ["_all"], "score", ["pos", "cnt"], descending=True)
    n_pos = counts.agg(F.sum("pos")).scalar()
    recall = F.coalesce(F.try_divide(F.col("cum_pos"), n_pos), F.lit(1.0))
    return swept.select(
        "score", "pos", "cnt", "cum_pos", "cum_cnt",
        (F.col("cum_pos") / F.col("cum_cnt")).alias("precision"), recall.alias("recall"),
    )


def _fbeta(p: Column, r: Column, beta: float, eps: float = 0.0) -> Column:
    b2 = beta * beta
    return F.coalesce(F.try_divide(p * r * (1 + b2), p * b2 + r + eps), F.lit(0.0))


def best_threshold_fbeta(scored: DataFrame, beta: float = 0.5, score: str = "churn_probability", label: str = "label") -> DataFrame:
    """The score with the largest F-beta; the lowest one on ties, 0.5 without rows."""
    return _best_threshold(pr_curve(scored, score, label), beta)


def _best_threshold(curve: DataFrame, beta: float) -> DataFrame:
    f = _fbeta(F.col("precision"), F.col("recall"), beta, 1e-9)
    best = curve.agg(F.max(F.struct(f.alias("f"), (-F.col("score")).alias("s"))).alias("b"))
    return best.select(F.coalesce(-F.col("b.s"), F.lit(0.5)).alias("threshold"))


def evaluate(scored: DataFrame, score: str = "churn_probability", label: str = "label") -> DataFrame:
    """One row of metrics at the best F0.5 threshold; zeros for an empty set."""
    curve = cut(pr_curve(scored, score, label))
    threshold = _best_threshold(curve, 0.5).scalar()
    # AUC: each positive beats the negatives below it and half of those on its score.
    negatives_above = F.col("cum_cnt") - F.col("cum_pos")
    neg_here = F.col("cnt") - F.col("pos")
    flagged = F.col("score") >= F.col("_t")
    sums = curve.withColumn("_t", threshold).agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("cnt"), F.lit(0)).alias("n_eval"),
        F.coalesce(F.sum(F.when(flagged, F.col("pos"))), F.lit(0)).alias("_tp"),
        F.coalesce(F.sum(F.when(flagged, F.col("cnt"))), F.lit(0)).alias("_flagged"),
        F.sum(F.col("pos") * F.col("precision")).alias("_ap"),
        F.sum(F.col("pos") * (negatives_above - neg_here / F.lit(2.0))).alias("_lost"),
        F.max("_t").alias("_t"),
    )
    n_pos, n_neg = F.col("n_pos"), F.col("n_eval") - F.col("n_pos")
    p = F.coalesce(F.try_divide(F.col("_tp"), F.col("_flagged")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("_tp"), n_pos), F.lit(0.0))
    auc = F.lit(1.0) - F.try_divide(F.col("_lost"), n_pos.cast("double") * n_neg)
    return sums.select(
        _fbeta(p, r, 1.0).alias("f1"),
        _fbeta(p, r, 0.5).alias("f05"),
        p.alias("precision"),
        r.alias("recall"),
        F.coalesce(F.try_divide(F.col("_ap"), n_pos), F.lit(0.0)).alias("pr_auc"),
        F.coalesce(auc, F.lit(0.0)).alias("roc_auc"),
        F.when(F.col("n_eval") > 0, F.col("_t")).otherwise(1.0).alias("threshold"),
        "n_eval",
        "n_pos",
        n_neg.alias("n_neg"),
    )


# --- fixed values: the two pairs of gate metrics and the stored rule codes
GATES = [(("f05", "F0.5"), ("pr_auc", "PR-AUC")), (("f2", "F2"), ("roc_auc", "ROC-AUC"))]
RULE_FIRST, RULE_BETTER, RULE_WORSE = "accepted_no_previous", "accepted_f05_improved", "rejected_f05_not_improved"


def guardrail(metrics: DataFrame, *, min_score: float = 0.10, min_auc: float = 0.05) -> DataFrame:
    """Adds ``passed`` and ``reason``: each gate metric must reach its minimum.

    The F gate and the area gate each take the first of their names that is a column of
    ``metrics``; a missing or NULL metric counts as 0.
    """
    checks = []
    for options, least in zip(zip(*GATES), (min_score, min_auc)):
        column, label = next((o for o in options if o[0] in metrics.columns), options[-1])
        value = F.coalesce(F.col(column).cast("double"), F.lit(0.0)) if column in metrics.columns else F.lit(0.0)
        ok = value >= least
        text = F.concat(F.lit(f"{label} "), F.format_string("%.4f", value), F.when(ok, f" reaches {least}").otherwise(f" is below {least}"))
        checks.append((ok, text))
    passed = checks[0][0] & checks[1][0]
    shown = [F.when(passed | ~ok, text) for ok, text in checks]
    return metrics.select("*", passed.alias("passed"), F.concat_ws(", ", *shown).alias("reason"))


def accept_reject(candidates: DataFrame, eps: float = 1e-6) -> DataFrame:
    """Accept ``new_f05`` when there is no ``prev_f05`` or it is beaten by more than ``eps``.

    ``accept_rule`` is the rule's code, followed by both scores where there are two.
    """
    gain = F.col("new_f05") - F.col("prev_f05")
    accepted = F.coalesce(F.col("new_f05") > F.col("prev_f05") + eps, gain.isNull() & F.col("prev_f05").isNull())
    code = F.when(F.col("prev_f05").isNull(), RULE_FIRST).when(accepted, RULE_BETTER).otherwise(RULE_WORSE)
    scores = F.when(gain.isNotNull(), F.format_string(" (%.4f to %.4f)", "prev_f05", "new_f05"))
    return candidates.select("*", accepted.alias("accepted"), F.concat(code, F.coalesce(scores, F.lit(""))).alias("accept_rule"))


def top_percent_threshold(scored: DataFrame, threshold: float, pct: float | None = 10.0) -> DataFrame:
    """Flag scores at or above the stricter of ``threshold`` and the top-``pct`` cut."""
    used = F.lit(float(threshold))
    if pct is not None:
        q = exact_quantiles(scored.withColumn("_all", F.lit(1)), ["_all"], "churn_probability", [(100.0 - pct) / 100.0])
        used = F.greatest(used, q.select(F.get("quantiles", F.lit(0))).scalar())
    out = scored.withColumn("threshold_used", used)
    return out.withColumn("churn_flag", F.when(F.col("churn_probability") >= F.col("threshold_used"), 1).otherwise(0))


def reasons(scored: DataFrame, top_features: list[str]) -> DataFrame:
    """``reason_i``: whether the i-th most important feature is above its median."""
    from parcelwise.operators.eda import finite_long

    known = [f for f in top_features if f in scored.columns]
    out = scored
    if known:
        medians = exact_quantiles(finite_long(scored, known), ["feature"], "value", [0.5])
        lookup = medians.agg(F.map_from_entries(F.collect_list(F.struct("feature", F.get("quantiles", F.lit(0)))))).scalar()
        out = out.withColumn("_medians", lookup)  # one entry per reason
    for i, f in enumerate(top_features, start=1):
        if f in known:
            high = F.col(f) > F.try_element_at("_medians", F.lit(f))
            out = out.withColumn(f"reason_{i}", F.when(high, f"High {f}").otherwise(f"Low {f}"))
        else:
            out = out.withColumn(f"reason_{i}", F.lit(f"Feature: {f}"))
    return out.drop("_medians")


# --------------------------------------------------------------------------
# configuration history, one row per (as_of_month, horizon)


def upsert_config(history: DataFrame, row: DataFrame) -> DataFrame:
    from parcelwise.sources.upsert import merge_by_key

    return merge_by_key(history, row, ["as_of_month", "horizon"])


def latest_config(history: DataFrame, horizon: int, *, accepted: bool = False, skip: int = 0) -> DataFrame:
    """The newest (accepted) configuration of a horizon; ``skip=1`` is the one before it."""
    rows = history.filter(F.col("horizon") == horizon)
    if accepted:
        rows = rows.filter("is_accepted")
    ordered = rows.orderBy(F.col("as_of_month").desc())
    return (ordered.offset(skip) if skip else ordered).limit(1)


def update_metrics(history: DataFrame, report: DataFrame) -> DataFrame:
    """Write the main metrics of a report into its row.

    ``report`` has the key, ``guardrail_warning`` and the columns to overwrite; a
    warning raises.
    """
    from parcelwise.sources.upsert import merge_by_key

    warned = F.coalesce(F.col("guardrail_warning"), F.lit("")) != ""
    checked = report.withColumn(
        "as_of_month",
        F.when(warned, F.raise_error(F.concat(F.lit("Guardrail failed: "), "guardrail_warning")).cast("int")).otherwise(F.col("as_of_month")),
    )
    known = checked.join(history.select("as_of_month", "horizon"), ["as_of_month", "horizon"], "left_semi")
    return merge_by_key(history, known, ["as_of_month", "horizon"], [c for c in report.columns if c in history.columns])
