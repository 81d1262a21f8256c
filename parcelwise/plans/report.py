"""The exploratory report: all analyses of one table, a summary, and stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.lineage import cut
from parcelwise.operators import drift as D
from parcelwise.operators import eda as E
from parcelwise.plans import runs
from parcelwise.sources.upsert import merge_by_key


@dataclass
class EdaReport:
    """Result frames of one run; a part that was not asked for is None."""

    descriptive: DataFrame
    missing: DataFrame
    patterns: DataFrame
    outliers: DataFrame
    correlations: DataFrame
    high_correlations: DataFrame
    class_distribution: DataFrame | None = None
    point_biserial: DataFrame | None = None
    iv: DataFrame | None = None
    monthly_drift: DataFrame | None = None
    trends: DataFrame | None = None
    metadata: dict = field(default_factory=dict)


def eda_report(
    df: DataFrame,
    features: Sequence[str],
    *,
    target: str | None = None,
    monthly: DataFrame | None = None,
    month: str = "window_end",
    method: str = "pearson",
    threshold: float = 0.80,
) -> EdaReport:
    """Run all analyses. ``df`` should be a stored or persisted table: it is read by each."""
    pairs = cut(E.correlation_matrix(df, features, method))
    report = EdaReport(
        cut(E.descriptive_stats(df, features)),
        cut(E.missing_stats(df, features)),
        cut(E.missing_patterns(df, features)),
        cut(E.outlier_stats(df, features)),
        pairs,
        cut(E.high_correlations(pairs, threshold)),
        metadata={"n_features": len(E.present(df, features)), "has_target": target is not None, "has_temporal": monthly is not None},
    )
    if target is not None and target in df.columns:
        report.class_distribution = E.class_distribution(df, target)
        report.point_biserial = cut(E.point_biserial_p(df, features, target))
        report.iv = cut(E.all_iv(df, features, target))
    if monthly is not None:
        report.monthly_drift = cut(D.monthly_drift(monthly, features, month))
        report.trends = cut(E.feature_trends_p(monthly, features, month))
    return report


def report_summary(report: EdaReport) -> DataFrame:
    """Counts of what stands out, as ``(metric, value)``."""
    def count(df: DataFrame | None, name: str, cond: str) -> DataFrame | None:
        if df is None:
            return None
        return df.agg(F.count(F.when(F.expr(cond), 1)).cast("double").alias("value")).select(F.lit(name).alias("metric"), "value")

    parts = [
        count(report.descriptive, "n_features_analysed", "true"),
        count(report.missing, "features_with_high_missing", "missing_pct > 0.10"),
        count(report.outliers, "features_with_high_outliers", "iqr_outlier_pct > 0.05"),
        count(report.high_correlations, "high_correlation_pairs", "true"),
        count(report.iv, "strong_iv_features", "iv_strength in ('medium', 'strong')"),
        count(report.monthly_drift, "drift_alerts", "severity = 'ALERT'"),
        count(report.trends, "trending_features", "is_trending"),
    ]
    if report.class_distribution is not None:
        parts.append(report.class_distribution.select(F.lit("churn_rate").alias("metric"), F.col("churn_rate").alias("value")))
    known = [p for p in parts if p is not None]
    out = known[0]
    for p in known[1:]:
        out = out.unionByName(p)
    return out


REPORT_KEYS = {
    "feature_stats": ["run_id", "feature_name"],
    "correlation_pairs": ["run_id", "feature_a", "feature_b"],
    "target_analysis": ["run_id", "feature_name"],
    "temporal_drift": ["run_id", "reference_month", "comparison_month", "feature_name"],
    "run_log": ["run_id"],
}


def report_tables(report: EdaReport, run_id: str) -> dict[str, DataFrame]:
    """The five stored tables of a run."""
    run = F.lit(run_id).alias("run_id")
    spark = report.descriptive.sparkSession
    tables = {
        "feature_stats": E.merged_feature_stats(report.descriptive, report.missing, report.outliers).select(run, "*"),
        "correlation_pairs": report.high_correlations.select(run, "*"),
        "run_log": spark.range(1).select(run, *[F.lit(v).alias(k) for k, v in report.metadata.items()]),
    }
    if report.iv is not None:
        tables["target_analysis"] = E.merged_target_stats(report.point_biserial, report.iv).select(run, "*")
    if report.monthly_drift is not None:
        tables["temporal_drift"] = report.monthly_drift.select(run, "*")
    return tables


def persist_report(report: EdaReport, run_id: str, path: str) -> None:
    """Store the tables of a run as a unit.

    Readers see all tables of a run or none, and a repeated run replaces all its tables.
    """
    spark = report.descriptive.sparkSession
    attempt = runs.start(spark, path, run_id)
    try:
        runs.publish(spark, path, run_id, attempt, report_tables(report, run_id))
    except Exception as error:
        runs.fail(spark, path, run_id, attempt, error)
        raise


def read_report(spark, path: str, name: str) -> DataFrame | None:
    """The stored rows of one table, of whole runs only."""
    return runs.read_table(spark, path, name)


def merge_report_rows(stored: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """In-memory merge of one report table by its key."""
    return merge_by_key(stored, new, REPORT_KEYS[name])
