"""Exploratory statistics: one row per feature, computed on long data.

Wide feature tables are unpivoted to ``(feature, value)`` inside the scan stage;
all features are then handled by one job. Cells without a value are dropped
before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.functions import columns as C
from parcelwise.functions.lineage import cut
from parcelwise.functions.quantiles import average_ranks, column_quantiles, exact_quantiles
from parcelwise.functions.tdist import t_p_value

PERCENTILES = (0.05, 0.25, 0.50, 0.75, 0.95)
BASELINE_STATS = ["mean", "median", "std", "skew", "kurtosis", "min_val", "max_val", "p5", "p25", "p50", "p75", "p95"]


def present(df: DataFrame, features: Sequence[str]) -> list[str]:
    return [f for f in features if f in df.columns]


def unpivot(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``(keep..., feature, value)`` with values as doubles."""
    names = present(df, features)
    doubles = df.select(*keep, *[F.col(f).try_cast("double").alias(f) for f in names])
    return doubles.unpivot(list(keep), names, "feature", "value")


def finite_long(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form without NULLs, NaN and infinities."""
    long = unpivot(df, features, keep)
    return long.withColumn("value", C.finite_double(F.col("value"))).filter(F.col("value").isNotNull())


def feature_names(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The analysed features as rows, so that empty ones keep a result row."""
    spark = df.sparkSession
    names = present(df, features)
    return spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("feature"))


def percentile_name(p: float) -> str:
    """``p`` and the percentage with the digits it needs: p5, p99, p99_5."""
    return f"p{round(p * 100, 10):g}".replace(".", "_")


# --------------------------------------------------------------------------
# single features


def moments(long: DataFrame, keys: Sequence[str] = ("feature",)) -> DataFrame:
    """Count, mean, spread and bias-corrected shape per key."""
    v = F.col("value")
    raw = long.groupBy(*keys).agg(
        F.count(v).alias("count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.skewness(v).alias("_g1"),
        F.kurtosis(v).alias("_g2"),
        F.min(v).alias("min_val"),
        F.max(v).alias("max_val"),
    )
    n = F.col("count").cast("double")
    spread = F.col("max_val") > F.col("min_val")
    skew = F.when(n < 3, None).when(~spread, 0.0).otherwise(F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = (
        F.when(n < 4, None)
        .when(~spread, 0.0)
        .otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("_g2") + 6))
    )
    return raw.select(*keys, "count", "mean", "std", skew.alias("skew"), kurt.alias("kurtosis"), "min_val", "max_val")


def descriptive_stats(df: DataFrame, features: Sequence[str], percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """Distribution summary per feature; NULLs for a feature without values."""
    long = finite_long(df, features)
    quantiles = column_quantiles(df, present(df, features), [0.5, *percentiles])
    q = F.col("quantiles")
    named = [F.get(q, F.lit(i + 1)).alias(percentile_name(p)) for i, p in enumerate(percentiles)]
    named = quantiles.select("feature", F.get(q, F.lit(0)).alias("median"), *named)
    joined = feature_names(df, features).join(moments(long), "feature", "left").join(named, "feature", "left")
    return joined.select(
        F.col("feature").alias("feature_name"),
        F.coalesce("count", F.lit(0)).alias("count"),
        "mean", "median", "std", "skew", "kurtosis", "min_val", "max_val",
        *[percentile_name(p) for p in percentiles],
    )


def missing_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows, missing values, share and whether infinities occur, per feature."""
    names = present(df, features)
    structs = [
        F.struct(
            F.count(F.lit(1)).alias("total_count"),
            F.count(F.when(_number(f).isNull(), 1)).alias("missing_count"),
            F.coalesce(F.max(F.abs(_number(f)) == float("inf")), F.lit(False)).alias("has_inf"),
        ).alias(f)
        for f in names
    ]
    wide = df.agg(*structs)
    rows = wide.select(F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("s")) for f in names])).alias("r"))
    share = F.coalesce(F.try_divide(F.col("r.s.missing_count"), F.col("r.s.total_count")), F.lit(0.0))
    return rows.select(
        F.col("r.f").alias("feature_name"),
        F.col("r.s.total_count").alias("total_count"),
        F.col("r.s.missing_count").alias("missing_count"),
        F.bround(share, 6).alias("missing_pct"),
        F.col("r.s.has_inf").alias("has_inf"),
    )


def _number(f: str) -> Column:
    d = F.col(f).try_cast("double")
    return F.when(~F.isnan(d), d)


def missing_patterns(df: DataFrame, features: Sequence[str], top_n: int = 10) -> DataFrame:
    """The most common sets of columns that are NULL together."""
    names = present(df, features)
    gaps = F.concat_ws(",", *[F.when(F.col(f).isNull(), F.lit(f)) for f in names])
    total = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    counted = df.groupBy(gaps.alias("affected_columns")).agg(F.count(F.lit(1)).alias("row_count"))
    return (
        counted.filter("affected_columns <> ''")
        .withColumn("pattern_hash", F.substring(F.md5(F.col("affected_columns").cast("binary")), 1, 12))
        .withColumn("pct_of_total", F.bround(F.col("row_count") / total, 6))
        .orderBy(F.col("row_count").desc(), "affected_columns")
        .limit(top_n)
        .select("pattern_hash", "affected_columns", "row_count", "pct_of_total")
    )


def outlier_stats(df: DataFrame, features: Sequence[str], iqr_factor: float = 1.5, z_threshold: float = 3.0) -> DataFrame:
    """Values beyond the quartile fences and beyond ``z_threshold`` deviations."""
    long = finite_long(df, features)
    quartiles = column_quantiles(df, present(df, features), [0.25, 0.75])
    # A constant column is told by its range: merged deviations can be off zero by rounding.
    varied = F.max("value") > F.min("value")
    spread = long.groupBy("feature").agg(
        F.avg("value").alias("_mean"), F.when(varied, F.stddev_samp("value")).otherwise(0.0).alias("_std")
    )
    q1, q3 = F.get("quantiles", F.lit(0)), F.get("quantiles", F.lit(1))
    fences = quartiles.join(spread, "feature").select(
        "feature",
        "n",
        "_mean",
        "_std",
        (q1 - (q3 - q1) * iqr_factor).alias("_lower"),
        (q3 + (q3 - q1) * iqr_factor).alias("_upper"),
    )
    v = F.col("value")
    outside = (v < F.col("_lower")) | (v > F.col("_upper"))
    far = F.abs((v - F.col("_mean")) / F.when(F.col("_std") > 0, F.col("_std"))) > z_threshold
    # One row per feature.
    counted = (
        long.join(F.broadcast(fences), "feature")
        .groupBy("feature")
        .agg(
            F.max("n").alias("n"),
            F.max("_std").alias("_std"),
            F.max("_lower").alias("_lower"),
            F.max("_upper").alias("_upper"),
            F.count(F.when(outside, 1)).alias("_iqr"),
            F.count(F.when(far, 1)).alias("_z"),
        )
    )
    joined = feature_names(df, features).join(counted, "feature", "left")
    usable = F.coalesce((F.col("_std") != 0) | (F.col("n") == 1), F.lit(False))
    count = lambda c: F.when(usable, F.col(c)).otherwise(0).cast("bigint")
    pct = lambda c: F.when(usable, F.bround(F.col(c) / F.col("n"), 6)).otherwise(0.0)
    return joined.select(
        F.col("feature").alias("feature_name"),
        F.when(usable, F.bround("_lower", 6)).alias("iqr_lower"),
        F.when(usable, F.bround("_upper", 6)).alias("iqr_upper"),
        count("_iqr").alias("iqr_outlier_count"),
        pct("_iqr").alias("iqr_outlier_pct"),
        count("_z").alias("zscore_outlier_count"),
        pct("_z").alias("zscore_outlier_pct"),
    )


# --------------------------------------------------------------------------
# pairs


def correlation_matrix(df: DataFrame, features: Sequence[str], method: str = "pearson") -> DataFrame:
    """All pairs ``(feature_a, feature_b, correlation)``, pairwise complete.

    Each task multiplies its Arrow batches into D x D partial sums; only those are
    shuffled. Values are centred first to keep the sums small.
    """
    names = present(df, features)
    if method == "spearman":
        return _spearman(df, names)
    numeric = df.select(*[C.finite_double(F.col(f)).alias(f) for f in names])
    totals = gram_sums(_centre(numeric, names), names)
    labels = F.array(*[F.lit(f) for f in names])
    return totals.select(
        F.get(labels, F.col("i")).alias("feature_a"),
        F.get(labels, F.col("j")).alias("feature_b"),
        _pearson().alias("correlation"),
    )


def gram_sums(df: DataFrame, names: list[str]) -> DataFrame:
    """Pairwise sums ``i, j, n, sx, sy, sxx, syy, sxy`` over the rows where both columns are known."""
    parts = df.select(*names).mapInPandas(
        _gram_partials(len(names)), "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    )
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])


def _centre(numeric: DataFrame, names: list[str]) -> DataFrame:
    """Subtract the column means, which come from one scalar subquery."""
    means = numeric.agg(F.array(*[F.coalesce(F.avg(f), F.lit(0.0)) for f in names]).alias("m")).scalar()
    return numeric.withColumn("_m", means).select(*[(F.col(f) - F.get("_m", F.lit(i))).alias(f) for i, f in enumerate(names)])


def _pearson() -> Column:
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    cov = F.col("sxy") - F.try_divide(sx * sy, n)
    vx = F.col("sxx") - F.try_divide(sx * sx, n)
    vy = F.col("syy") - F.try_divide(sy * sy, n)
    # Sums of squares of a constant column leave only rounding noise.
    flat = (vx <= F.col("sxx") * 1e-14) | (vy <= F.col("syy") * 1e-14)
    r = F.try_divide(cov, F.sqrt(vx) * F.sqrt(vy))
    return F.when(~flat & (n > 1), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))


def _gram_partials(width: int):
    def run(batches):
        acc = np.zeros((6, width, width))
        for pdf in batches:
            x = pdf.to_numpy(dtype=float, na_value=np.nan)
            mask = (~np.isnan(x)).astype(float)
            x = np.where(mask > 0, x, 0.0)
            acc[0] += mask.T @ mask
            acc[1] += x.T @ mask
            acc[2] += mask.T @ x
            acc[3] += (x * x).T @ mask
            acc[4] += mask.T @ (x * x)
            acc[5] += x.T @ x
        i, j = np.indices((width, width)).reshape(2, -1)
        yield pd.DataFrame(
            {"i": i.astype("int32"), "j": j.astype("int32")}
            | {c: acc[k].ravel() for k, c in enumerate(("n", "sx", "sy", "sxx", "syy", "sxy"))}
        )

    return run


def _known_together(df: DataFrame, names: Sequence[str]) -> dict[tuple[int, int], int]:
    """Rows where both columns are known, by their positions. The driver sees D x D counts."""
    known = df.select(*[F.when(F.col(f).isNotNull(), 0.0).alias(f) for f in names])
    return {(r["i"], r["j"]): int(r["n"]) for r in gram_sums(known, list(names)).select("i", "j", "n").collect()}


def _classes(both: dict[tuple[int, int], int], width: int) -> list[list[int]]:
    classes: list[list[int]] = []
    for k in range(width):
        n = both.get((k, k), 0)
        same = next((c for c in classes if both.get((c[0], c[0]), 0) == n == both.get((c[0], k), 0)), None)
        if same is None:
            classes.append([k])
        else:
            same.append(k)
    return classes


def null_classes(df: DataFrame, names: Sequence[str]) -> list[list[int]]:
    """Positions of the columns that are known in the same rows, class by class."""
    return _classes(_known_together(df, names), len(names))


def _spearman(df: DataFrame, names: list[str]) -> DataFrame:
    """Pearson correlation of average ranks, ranked over the rows valid for the pair.

    Columns known in the same rows form a class; a column is ranked over the rows where another
    class is known, too, for each class. A value has one row with all these ranks, so every known cell is
    shuffled once to its value and once back to its row, whatever the number of classes. Ranks come from
    value counts: equal values share one row. Pairs of classes are mirrored.
    """
    # Stored once: the row numbers must not change when a task is repeated.
    numeric = cut(
        df.select(*[C.finite_double(F.col(f)).alias(f) for f in names]).withColumn("_id", F.monotonically_increasing_id())
    )
    both = _known_together(numeric, names)
    classes = _classes(both, len(names))
    groups = [(a, b) for a in range(len(classes)) for b in range(a, len(classes))]
    among = [f"in_{c}" for c in range(len(classes))]

    cells = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f).alias("v")) for k, f in enumerate(names)])
    known = F.filter(cells, lambda c: c["v"].isNotNull())
    flags = [F.col(names[c[0]]).isNotNull().alias(a) for a, c in zip(among, classes)]
    long = numeric.select("_id", *flags, F.explode(known).alias("c")).select("_id", *among, "c.k", "c.v")
    ranks = average_ranks(long, ["k"], "v", among)
    ranked = long.select("_id", "k", "v").join(ranks.select("k", "v", F.array(*[f"avg_rank_{a}" for a in among]).alias("r")), ["k", "v"])
    rows = ranked.groupBy("_id").agg(F.collect_list(F.struct("k", "r")).alias("c"))
    cells_of = rows.select(F.transform("c", lambda x: x["k"]).alias("k"), F.flatten(F.transform("c", lambda x: x["r"])).alias("r"))
    # Ranks around their mean, (n + 1) / 2; one size per column and class.
    means = [[(both.get((k, c[0]), 0) + 1) / 2 for c in classes] for k in range(len(names))]
    parts = cells_of.mapInArrow(_rank_products(classes, groups, means), "g int, i int, j int, n bigint, xy double")
    sums = parts.groupBy("g", "i", "j").agg(F.sum("n").alias("n"), F.sum("xy").alias("xy"))
    diagonal = sums.filter("i = j").select("g", F.col("i").alias("d"), F.col("xy").alias("xx"))
    xx, yy = (diagonal.select("g", F.col("d").alias(c), F.col("xx").alias(f"{c}{c}")) for c in ("i", "j"))
    r = F.try_divide(F.col("xy"), F.sqrt("ii") * F.sqrt("jj"))
    found = sums.join(xx, ["g", "i"]).join(yy, ["g", "j"]).select("g", "i", "j", F.when((F.col("n") > 1) & r.isNotNull(), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0))).alias("r"))
    # The class pair that stands for a pair of columns.
    of = {k: c for c, members in enumerate(classes) for k in members}
    place = {pair: g for g, pair in enumerate(groups)}
    grid = [(place[min(of[a], of[b]), max(of[a], of[b])], a, b, names[a], names[b]) for a in range(len(names)) for b in range(len(names))]
    wanted = df.sparkSession.createDataFrame(grid, "g int, i int, j int, feature_a string, feature_b string")
    return wanted.join(found, ["g", "i", "j"], "left").select("feature_a", "feature_b", F.col("r").alias("correlation"))


def _rank_products(classes: list[list[int]], groups: list[tuple[int, int]], means: list[list[float]]):
    """Per class pair: products of all ranked columns, summed over the rows of a task.

    A row comes as its known columns ``k`` and their ranks ``r``, one per class and column.
    """
    width, n_classes = len(means), len(classes)
    # A column's rank for a class pair is the one among the rows of the pair's other class.
    columns = [sorted((k, b if k in classes[a] else a) for k in {*classes[a], *classes[b]}) for a, b in groups]

    def run(batches):
        centre = np.array(means).reshape(width, n_classes)
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            lengths = batch.column("k").value_lengths().to_numpy()
            k = batch.column("k").flatten().to_numpy()
            r = batch.column("r").flatten().to_numpy().reshape(-1, n_classes)
            x = np.zeros((len(lengths), width, n_classes))
            known = np.zeros((len(lengths), width), bool)
            at = np.repeat(np.arange(len(lengths)), lengths)
            x[at, k], known[at, k] = r - centre[k], True
            for g, (a, b) in enumerate(groups):
                inside = known[:, classes[a][0]] & known[:, classes[b][0]]
                if inside.any():
                    of, other = np.array(columns[g]).T
                    ranked = x[np.flatnonzero(inside)[:, None], of, other]
                    sums[g] = sums.get(g, 0.0) + ranked.T @ ranked
                    counts[g] = counts.get(g, 0) + len(ranked)
        for g, xy in sums.items():
            of = np.array(columns[g], "int32")[:, 0]
            i, j = np.meshgrid(of, of, indexing="ij")
            full = {"g": np.full(xy.size, g, "int32"), "i": i.ravel(), "j": j.ravel(), "n": np.full(xy.size, counts[g], "int64"), "xy": xy.ravel()}
            yield pa.RecordBatch.from_pydict(full)

    return run


def high_correlations(matrix: DataFrame, threshold: float = 0.80) -> DataFrame:
    """Each pair once, names in order, strongest first."""
    pairs = matrix.filter((F.col("feature_a") < F.col("feature_b")) & (F.abs("correlation") >= threshold))
    return pairs.select("feature_a", "feature_b", F.bround("correlation", 6).alias("correlation")).orderBy(
        F.abs("correlation").desc(), "feature_a", "feature_b"
    )


# --------------------------------------------------------------------------
# target


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Counts, rate and imbalance of a binary target; unreadable labels count as 0."""
    y = F.coalesce(F.col(target).try_cast("double").cast("int"), F.lit(0))
    counts = df.agg(F.count(F.lit(1)).alias("total_count"), F.count(F.when(y == 1, 1)).alias("positive_count"))
    neg = F.col("total_count") - F.col("positive_count")
    rate = F.coalesce(F.try_divide(F.col("positive_count"), F.col("total_count")), F.lit(0.0))
    return counts.select(
        "total_count",
        "positive_count",
        neg.alias("negative_count"),
        F.bround(rate, 6).alias("churn_rate"),
        F.when(F.col("positive_count") > 0, F.bround(neg / F.col("positive_count"), 4)).otherwise(float("inf")).alias("imbalance_ratio"),
    )


def point_biserial(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Correlation with a binary target, with the t statistic and its freedom."""
    names = present(df, features)
    y = F.col("_y").cast("double")
    long = unpivot(df.withColumn("_y", F.col(target).try_cast("double")), names, ["_y"]).filter("value is not null and _y is not null")
    stats = long.groupBy("feature").agg(F.count("value").alias("n"), F.corr("value", y).alias("r"))
    r = F.when(F.col("n") >= 3, F.nanvl("r", F.lit(None)))
    df_ = F.col("n") - 2
    t = F.when(F.abs(r) < 1, r * F.sqrt(df_) / F.sqrt(F.lit(1.0) - r * r))
    joined = feature_names(df, features).join(stats, "feature", "left")
    return joined.select(
        F.col("feature").alias("feature_name"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.bround(r, 6).alias("correlation"),
        t.alias("t_stat"),
        F.when(r.isNotNull(), df_).alias("df"),
    )


def point_biserial_p(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``point_biserial`` with the two-sided p-value (0 for a perfect correlation)."""
    base = point_biserial(df, features, target)
    p = F.when(F.abs("correlation") >= 1, F.lit(0.0)).otherwise(t_p_value(F.col("t_stat"), F.col("df")))
    return base.select("feature_name", "correlation", F.bround(p, 8).alias("p_value"))


def quantile_bins(long: DataFrame, n_bins: int, keys: Sequence[str] = ("feature",)) -> DataFrame:
    """Distinct quantile edges per key: ``keys, n, edges``."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = exact_quantiles(long, keys, "value", probs)
    return q.select(*keys, "n", F.array_distinct("quantiles").alias("edges"))


def right_closed_bin(v: Column, edges: Column) -> Column:
    """Zero-based bin of intervals ``(lo, hi]``; the lowest edge belongs to the first bin."""
    below = F.size(F.filter(edges, lambda e: e < v))
    return F.greatest(below - 1, F.lit(0))


def woe_bins(df: DataFrame, features: Sequence[str], target: str, n_bins: int = 10) -> DataFrame:
    """Weight of evidence per feature and quantile bin.

    Bins are right-closed quantile intervals without repeated edges. A constant
    feature has no bins.
    """
    names = present(df, features)
    known = df.select(*names, F.col(target).try_cast("double").alias("_y")).filter("_y is not null")
    probs = [i / n_bins for i in range(n_bins + 1)]
    edges = column_quantiles(known, names, probs).select("feature", F.array_distinct("quantiles").alias("edges")).filter("size(edges) > 1")
    # One edge array per feature.
    wide = known.select("_y", *[C.finite_double(F.col(f)).alias(f) for f in names])
    counted = (
        wide.mapInPandas(_bin_partials({r["feature"]: r["edges"] for r in edges.collect()}), "feature string, bin int, event double, total bigint")
        .groupBy("feature", "bin")
        .agg(F.sum("event").alias("event"), F.sum("total").alias("total"))
        .withColumn("non_event", F.col("total") - F.col("event"))
    )
    per_feature = Window.partitionBy("feature")  # at most n_bins rows each
    events, others = F.sum("event").over(per_feature), F.sum("non_event").over(per_feature)
    k = F.count(F.lit(1)).over(per_feature)
    tagged = counted.withColumns({"_events": events, "_others": others, "_k": k}).filter("_events > 0 and _others > 0")
    dist_event = (F.col("event") + 0.5) / (F.col("_events") + F.col("_k") * 0.5)
    dist_non = (F.col("non_event") + 0.5) / (F.col("_others") + F.col("_k") * 0.5)
    out = tagged.withColumns({"dist_event": dist_event, "dist_non": dist_non}).withColumn(
        "woe", F.ln(F.col("dist_non") / F.col("dist_event"))
    )
    return out.select(
        F.col("feature").alias("feature_name"), "bin", "event", "total", "non_event", "dist_event", "dist_non", "woe",
        ((F.col("dist_non") - F.col("dist_event")) * F.col("woe")).alias("iv_bin"),
    )


def _bin_partials(edges: dict[str, list[float]]):
    """Events and rows per feature and right-closed bin, summed over the rows of a task."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            y = pdf["_y"].to_numpy(dtype=float)
            for f, e in edges.items():
                v = pdf[f].to_numpy(dtype=float)
                known = ~np.isnan(v)
                at = np.maximum(np.searchsorted(e, v[known]) - 1, 0)
                parts = np.stack([np.bincount(at, y[known], len(e)), np.bincount(at, minlength=len(e))])
                sums[f] = sums.get(f, 0.0) + parts
        for f, (event, total) in sums.items():
            filled = np.flatnonzero(total)
            yield pd.DataFrame({"feature": f, "bin": filled.astype("int32"), "event": event[filled], "total": total[filled].astype("int64")})

    return run


def all_iv(df: DataFrame, features: Sequence[str], target: str, n_bins: int = 10) -> DataFrame:
    """Information value and its strength per feature, strongest first."""
    iv = woe_bins(df, features, target, n_bins).groupBy("feature_name").agg(F.bround(F.sum("iv_bin"), 6).alias("iv"))
    names = feature_names(df, features).withColumnRenamed("feature", "feature_name")
    return (
        names.join(iv, "feature_name", "left")
        .withColumn("iv", F.coalesce("iv", F.lit(0.0)))
        .withColumn("iv_strength", C.iv_strength(F.col("iv")))
        .orderBy(F.col("iv").desc(), "feature_name")
    )


# --------------------------------------------------------------------------
# time


def monthly_snapshots(features: DataFrame, window_size: int, n: int) -> DataFrame:
    """Feature rows of the newest ``n`` window ends of one size."""
    sized = features.filter(F.col("window_size") == window_size)
    newest = sized.select("window_end").distinct().orderBy(F.col("window_end").desc()).limit(n)
    return sized.join(F.broadcast(newest), "window_end")  # at most n rows


def feature_trends(df: DataFrame, features: Sequence[str], month: str) -> DataFrame:
    """Straight-line trend of the monthly medians: slope, fit and t statistic.

    Months are numbered by their position among all months present; a feature
    needs a median in three of them.
    """
    medians = column_quantiles(df, present(df, features), [0.5], [month])
    # One row per month.
    months = df.select(month).distinct().withColumn("_x", (F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(month)) - 1).cast("double"))
    points = medians.join(F.broadcast(months), month).withColumn("_y", F.get("quantiles", F.lit(0)))
    fit = points.groupBy("feature").agg(
        F.count("_y").alias("n_months"),
        F.regr_slope("_y", "_x").alias("_slope"),
        F.regr_syy("_y", "_x").alias("_syy"),
        F.regr_sxx("_y", "_x").alias("_sxx"),
        F.regr_sxy("_y", "_x").alias("_sxy"),
    )
    joined = feature_names(df, features).join(fit, "feature", "left")
    ok = F.coalesce(F.col("n_months") >= 3, F.lit(False))
    moves = F.col("_syy") > 0
    residual = F.greatest(F.col("_syy") - F.try_divide(F.col("_sxy") * F.col("_sxy"), F.col("_sxx")), F.lit(0.0))
    r2 = F.when(moves, F.lit(1.0) - residual / F.col("_syy")).otherwise(0.0)
    se = F.sqrt(residual / (F.col("n_months") - 2)) / F.sqrt("_sxx")
    return joined.select(
        F.col("feature").alias("feature_name"),
        F.coalesce("n_months", F.lit(0)).alias("n_months"),
        F.when(ok, F.bround("_slope", 8)).alias("slope"),
        F.when(ok, F.bround(r2, 6)).alias("r_squared"),
        F.when(ok & moves, F.coalesce(F.try_divide(F.col("_slope"), se), F.lit(float("inf")))).alias("t_stat"),
        F.when(ok, F.col("n_months") - 2).alias("df"),
    )


def feature_trends_p(df: DataFrame, features: Sequence[str], month: str, p_threshold: float = 0.05) -> DataFrame:
    """``feature_trends`` with p-value and trend flag."""
    base = feature_trends(df, features, month)
    p = F.when(F.col("df").isNull(), None).when(F.col("t_stat").isNull(), 1.0).otherwise(t_p_value(F.col("t_stat"), F.col("df")))
    return base.withColumn("_p", p).select(
        "feature_name", "n_months", "slope", "r_squared",
        F.bround("_p", 8).alias("p_value"),
        F.coalesce(F.col("_p") < p_threshold, F.lit(False)).alias("is_trending"),
    )


# --------------------------------------------------------------------------
# baseline


def baseline_rows(stats: DataFrame, run_id: str) -> DataFrame:
    """One JSON document of statistics per feature, keyed by run."""
    doc = F.to_json(F.struct(*[F.col(s) for s in ["count", *BASELINE_STATS] if s in stats.columns]))
    return stats.select(F.lit(run_id).alias("run_id"), "feature_name", doc.alias("stats_json"))


def load_baseline(rows: DataFrame) -> DataFrame:
    """Statistics columns back from the stored JSON documents."""
    schema = "struct<count bigint," + ",".join(f"{s} double" for s in BASELINE_STATS) + ">"
    parsed = rows.select("feature_name", F.from_json("stats_json", schema).alias("s"))
    return parsed.select("feature_name", "s.*")


def compare_to_baseline(stats: DataFrame, baseline: DataFrame) -> DataFrame:
    """Change of each statistic against the stored one; no relative change from 0."""

    def long(df: DataFrame, name: str) -> DataFrame:
        names = [s for s in BASELINE_STATS if s in df.columns]
        doubles = df.select("feature_name", *[F.col(s).cast("double").alias(s) for s in names])
        return doubles.unpivot(["feature_name"], names, "stat_name", name).filter(F.col(name).isNotNull())

    both = long(stats, "cur").join(long(baseline, "base"), ["feature_name", "stat_name"])
    delta = F.col("cur") - F.col("base")
    return both.select(
        "feature_name",
        "stat_name",
        F.bround("base", 6).alias("baseline_value"),
        F.bround("cur", 6).alias("current_value"),
        F.bround(delta, 6).alias("delta"),
        F.bround(F.try_divide(delta, F.col("base")), 6).alias("delta_pct"),
    )


# --------------------------------------------------------------------------
# merged result tables and chart rows


def merged_feature_stats(desc: DataFrame, missing: DataFrame, outliers: DataFrame) -> DataFrame:
    return desc.join(missing, "feature_name", "left").join(outliers, "feature_name", "left")


def merged_target_stats(biserial: DataFrame, iv: DataFrame) -> DataFrame:
    return biserial.join(iv, "feature_name", "left")


def chart_rows(desc: DataFrame, missing: DataFrame, outliers: DataFrame, pairs: DataFrame, iv: DataFrame, biserial: DataFrame, trends: DataFrame) -> DataFrame:
    """The rows behind the report charts as ``(chart, item, value)``."""
    name = F.col("feature_name")

    def top(df: DataFrame, chart: str, item: Column, value: Column, n: int | None, order: Column | None = None) -> DataFrame:
        rows = df.select(F.lit(chart).alias("chart"), item.alias("item"), value.cast("double").alias("value"), (order if order is not None else value).alias("_o"))
        rows = rows.filter(F.col("value").isNotNull())
        rows = rows.orderBy(F.col("_o").desc(), "item").limit(n) if n else rows
        return rows.drop("_o")

    parts = [
        top(desc, "mean", name, F.col("mean"), 15),
        top(missing.filter("missing_count > 0"), "missing", name, F.col("missing_pct"), None),
        top(outliers.filter("iqr_outlier_count > 0"), "outliers", name, F.col("iqr_outlier_pct"), None),
        top(pairs, "correlation", F.concat_ws(" / ", "feature_a", "feature_b"), F.col("correlation"), 20, F.abs("correlation")),
        top(iv, "iv", name, F.col("iv"), 20),
        top(biserial, "point_biserial", name, F.col("correlation"), 20, F.abs("correlation")),
        top(trends, "slope", name, F.col("slope"), 15, F.abs("slope")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
