"""Exploratory statistics queries with their check SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from catalog.inputs import EDA_FEATURES, Inputs, tidy
from catalog.q_labels import remember
from catalog.sql import r, with_ctes
from parcelwise.functions.lineage import scratch_path
from parcelwise.operators import drift as D
from parcelwise.operators import eda as E
from parcelwise.plans import report as RP

PAIR = RANKED = EDA_FEATURES
STATS = ["mean", "median", "std", "skew", "kurtosis", "min_val", "max_val", "p5", "p25", "p50", "p75", "p95"]


@remember
def stats(i: Inputs):
    return E.descriptive_stats(i.eda, EDA_FEATURES).persist()


@remember
def iv(i: Inputs):
    return E.all_iv(i.eda, EDA_FEATURES, "target").persist()


@remember
def outliers(i: Inputs):
    return E.outlier_stats(i.eda, EDA_FEATURES).persist()


@remember
def pairs(i: Inputs):
    return E.correlation_matrix(i.eda_rows, PAIR).persist()


@remember
def trends(i: Inputs):
    return E.feature_trends(i.eda, EDA_FEATURES, "window_end").persist()


def q_compare_to_baseline(i: Inputs):
    """The newest window against all windows before it."""
    last = E.descriptive_stats(i.eda.filter("window_end = '0107'"), EDA_FEATURES)
    before = E.descriptive_stats(i.eda.filter("window_end <> '0107'"), EDA_FEATURES)
    stored = E.load_baseline(E.baseline_rows(before, "run"))
    return tidy(E.compare_to_baseline(last, stored))


def q_save_baseline(i: Inputs):
    """One JSON document per feature, read back by path."""
    rows = E.baseline_rows(stats(i), "run1")
    value = lambda k: F.get_json_object("stats_json", f"$.{k}").cast("double").alias(k)
    return tidy(rows.select("run_id", "feature_name", value("count"), value("min_val"), value("max_val"), value("p50")))


def q_persist_report(i: Inputs):
    """Stored statistics of two runs, the second of which was repeated and so replaced its own tables."""
    root = scratch_path(i.spark, "report")
    full = RP.EdaReport(
        stats(i), E.missing_stats(i.eda, EDA_FEATURES), E.missing_patterns(i.eda, EDA_FEATURES), outliers(i), pairs(i), E.high_correlations(pairs(i), 0.5),
        point_biserial=E.point_biserial(i.eda, EDA_FEATURES, "target"), iv=iv(i), metadata={"n_features": len(EDA_FEATURES)},
    )
    zero = replace(full, descriptive=stats(i).withColumn("count", F.lit(0).cast("bigint")))
    for run, report in (("r0", zero), ("r1", zero), ("r1", full)):
        RP.persist_report(report, run, root)
    return tidy(RP.read_report(i.spark, root, "feature_stats").select("run_id", "feature_name", "count", "missing_count"))


def q_chart_rows(i: Inputs):
    missing = E.missing_stats(i.eda, EDA_FEATURES)
    biserial = E.point_biserial(i.eda, EDA_FEATURES, "target")
    high = E.high_correlations(pairs(i), 0.3)
    return tidy(E.chart_rows(stats(i), missing, outliers(i), high, iv(i), biserial, trends(i)))


QUERIES = {
    "descriptive_stats": lambda i: tidy(stats(i), 4),
    "missing_stats": lambda i: tidy(E.missing_stats(i.eda, EDA_FEATURES)),
    "missing_patterns": lambda i: tidy(E.missing_patterns(i.eda, EDA_FEATURES)),
    "outlier_stats": lambda i: tidy(outliers(i)),
    "correlation_matrix": lambda i: tidy(pairs(i), 5),
    "correlation_matrix_spearman": lambda i: tidy(E.correlation_matrix(i.eda_rows, RANKED, "spearman"), 5),
    "high_correlations": lambda i: tidy(E.high_correlations(pairs(i), 0.5)),
    "class_distribution": lambda i: tidy(E.class_distribution(i.eda_rows, "target")),
    "point_biserial": lambda i: tidy(E.point_biserial(i.eda, EDA_FEATURES, "target"), 4, correlation=6),
    "point_biserial_p": lambda i: tidy(E.point_biserial_p(i.eda, EDA_FEATURES, "target"), 6),
    "woe_iv": lambda i: tidy(E.woe_bins(i.eda, EDA_FEATURES, "target"), 5),
    "all_iv": lambda i: tidy(iv(i)),
    "monthly_drift": lambda i: tidy(D.monthly_drift(i.eda, EDA_FEATURES, "window_end")),
    "feature_trends": lambda i: tidy(trends(i), 4, slope=8, r_squared=6),
    "feature_trends_p": lambda i: tidy(E.feature_trends_p(i.eda, EDA_FEATURES, "window_end"), 6),
    "monthly_snapshots": lambda i: tidy(E.monthly_snapshots(i.features, 4, 3).select("cms_code_enc", "window_end", "item_sum", "recency")),
    "save_baseline": q_save_baseline,
    "compare_to_baseline": q_compare_to_baseline,
    "merged_feature_stats": lambda i: tidy(E.merged_feature_stats(stats(i), E.missing_stats(i.eda, EDA_FEATURES), outliers(i)), 4, missing_pct=6, iqr_lower=6, iqr_upper=6, iqr_outlier_pct=6, zscore_outlier_pct=6),
    "merged_target_stats": lambda i: tidy(E.merged_target_stats(E.point_biserial(i.eda, EDA_FEATURES, "target").drop("t_stat", "df", "n"), iv(i))),
    "persist_report": q_persist_report,
    "chart_rows": q_chart_rows,
}

# --------------------------------------------------------------------------


def e6(expr: str) -> str:
    """Rounded half to even, as the stored results are."""
    return f"round_even({expr}, 6)"


def each(template: str, names=EDA_FEATURES) -> str:
    return "\nUNION ALL ".join(template.replace("{f}", f) for f in names)


def stats_sql(src: str, f: str) -> str:
    x = f"{f}::DOUBLE"
    return f"""SELECT '{f}' AS feature_name, count({f}) AS count, avg({x}) AS mean, quantile_cont({x}, 0.5) AS median, stddev_samp({x}) AS std,
  CASE WHEN max({x}) > min({x}) THEN skewness({x}) ELSE 0 END AS skew, CASE WHEN max({x}) > min({x}) THEN kurtosis({x}) ELSE 0 END AS kurtosis,
  min({x}) AS min_val, max({x}) AS max_val, quantile_cont({x}, 0.05) AS p5, quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50,
  quantile_cont({x}, 0.75) AS p75, quantile_cont({x}, 0.95) AS p95 FROM {src}"""


def all_stats(src: str) -> str:
    return "\nUNION ALL ".join(stats_sql(src, f) for f in EDA_FEATURES)


STATS_CTE = f"stats AS ({all_stats('eda')})"
STATS_OUT = ", ".join(f"{r('s.' + c, 4)} AS {c}" for c in STATS)
MISSING = each("SELECT '{f}' AS feature_name, count(*) AS total_count, count(*) - count({f}) AS missing_count, round_even((count(*) - count({f}))::DOUBLE / count(*), 6) AS missing_pct, false AS has_inf FROM eda")
OUTLIERS = "\nUNION ALL ".join(
    f"""SELECT '{f}' AS feature_name, {e6('any_value(lo)')} AS iqr_lower, {e6('any_value(hi)')} AS iqr_upper,
  count(*) FILTER (v < lo OR v > hi) AS iqr_outlier_count, {e6('count(*) FILTER (v < lo OR v > hi)::DOUBLE / count(*)')} AS iqr_outlier_pct,
  count(*) FILTER (abs((v - m) / s) > 3.0) AS zscore_outlier_count, {e6('count(*) FILTER (abs((v - m) / s) > 3.0)::DOUBLE / count(*)')} AS zscore_outlier_pct
FROM (SELECT {f}::DOUBLE AS v FROM eda WHERE {f} IS NOT NULL),
     (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi, m, s FROM (SELECT quantile_cont({f}::DOUBLE, 0.25) AS q1, quantile_cont({f}::DOUBLE, 0.75) AS q3, avg({f}::DOUBLE) AS m, stddev_samp({f}::DOUBLE) AS s FROM eda))"""
    for f in EDA_FEATURES
)


def all_pairs(corr: str, src: str, names: list[str]) -> str:
    """Correlations of all pairs in one aggregate, mirrored; NULL for a constant column."""
    rows = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'c': {corr.format(a=a, b=b)}}}" for k, a in enumerate(names) for b in names[k:])
    one = f"SELECT u.a AS a, u.b AS b, CASE WHEN isnan(u.c) THEN NULL ELSE u.c END AS c FROM (SELECT unnest([{rows}]) AS u FROM {src})"
    return f"SELECT a AS feature_a, b AS feature_b, c AS correlation FROM ({one}) UNION ALL SELECT b, a, c FROM ({one}) WHERE a <> b"


CORR = all_pairs("corr({a}::DOUBLE, {b}::DOUBLE)", "eda", EDA_FEATURES)


def spearman_sql() -> str:
    """Pearson correlation of average ranks over the rows that are known for the pair: one ranking per set of known columns."""
    known = ["known_delay", "known_ratio"]
    whole = [f for f in EDA_FEATURES if f not in known]
    ctes, parts = [], []
    for tag, gaps in (("w", []), ("d", known[:1]), ("q", known[1:]), ("b", known)):
        cols = whole if not gaps else [*whole, *gaps] if len(gaps) == 1 else gaps
        ranks = ", ".join(f"rank() OVER (ORDER BY {f}) + (count(*) OVER (PARTITION BY {f}) - 1) / 2.0 AS {f}" for f in cols)
        where = " AND ".join(f"{g} IS NOT NULL" for g in gaps) or "true"
        ctes.append(f"rank_{tag} AS MATERIALIZED (SELECT {ranks} FROM eda WHERE {where})")
        pairs = [(a, b) for k, a in enumerate(cols) for b in cols[k:] if not gaps or (len(gaps) == 1 and gaps[0] in (a, b)) or (len(gaps) == 2 and a != b)]
        rows = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'c': corr({a}, {b})}}" for a, b in pairs)
        parts.append(f"SELECT unnest([{rows}]) AS u FROM rank_{tag}")
    one = " UNION ALL ".join(parts)
    return f""", {", ".join(ctes)}, one AS MATERIALIZED (SELECT u.a AS a, u.b AS b, round(CASE WHEN isnan(u.c) THEN NULL ELSE u.c END, 5) + 0.0 AS c FROM ({one}))
SELECT a AS feature_a, b AS feature_b, c AS correlation FROM one UNION ALL SELECT b, a, c FROM one WHERE a <> b"""


BISERIAL = each("SELECT '{f}' AS feature_name, count({f}) AS n, corr({f}::DOUBLE, target::DOUBLE) AS r FROM eda")


def bins_cte() -> str:
    """Quantile edges without repeats and the right-closed bin of every value."""
    probs = ", ".join(str(k / 10) for k in range(11))
    edges = each("SELECT '{f}' AS f, list_sort(list_distinct(quantile_cont({f}::DOUBLE, [" + probs + "]))) AS e FROM eda")
    vals = each("SELECT '{f}' AS f, {f}::DOUBLE AS v, target FROM eda WHERE {f} IS NOT NULL")
    return f"""edges AS ({edges}), vals AS ({vals}),
binned AS (SELECT v.f, greatest(len(list_filter(e.e, lambda x: x < v.v)) - 1, 0) AS bin, v.target FROM vals v JOIN edges e ON e.f = v.f WHERE len(e.e) > 1),
agg AS (SELECT f, bin, sum(target)::DOUBLE AS event, count(*) AS total, (count(*) - sum(target))::DOUBLE AS non_event FROM binned GROUP BY ALL),
tot AS (SELECT *, sum(event) OVER w AS te, sum(non_event) OVER w AS tn, count(*) OVER w AS k FROM agg WINDOW w AS (PARTITION BY f)),
woe AS (SELECT *, (event + 0.5) / (te + 0.5 * k) AS de, (non_event + 0.5) / (tn + 0.5 * k) AS dn FROM tot WHERE te > 0 AND tn > 0),
iv AS (SELECT f, round_even(sum((dn - de) * ln(dn / de)), 6) AS iv FROM woe GROUP BY f)"""


IV_ALL = "(SELECT n.f, coalesce(i.iv, 0) AS iv FROM (SELECT unnest([" + ", ".join(f"'{f}'" for f in EDA_FEATURES) + "]) AS f) n LEFT JOIN iv i ON i.f = n.f)"
STRENGTH = "CASE WHEN iv < 0.02 THEN 'useless' WHEN iv < 0.10 THEN 'weak' WHEN iv < 0.30 THEN 'medium' WHEN iv < 0.50 THEN 'strong' ELSE 'suspicious' END"


def drift_cte(ref: str, cur: str, keys: str) -> str:
    """Profile edges of ``ref``, counts of ``cur`` on them, PSI and KS per ``keys``."""
    return f"""qs AS (SELECT f, quantile_cont(v, [{', '.join(str(k / 10) for k in range(11))}]) AS q, count(*) AS n FROM {ref} GROUP BY f),
pe AS (SELECT f, n, CASE WHEN len(list_distinct(q)) >= 3 THEN list_sort(list_distinct(q)) ELSE [q[1] - 1e-6, q[11] + 1e-6] END AS e FROM qs),
slots AS (SELECT f, n, e, unnest(range(0, len(e) - 1)) AS bin FROM pe),
tc AS (SELECT v.f, least(len(list_filter(e.e, lambda x: x <= v.v)) - 1, len(e.e) - 2) AS bin, count(*) AS c FROM {ref} v JOIN pe e ON e.f = v.f
       WHERE v.v >= e.e[1] AND v.v <= e.e[-1] GROUP BY ALL),
cc AS (SELECT {keys}v.f, least(len(list_filter(e.e, lambda x: x <= v.v)) - 1, len(e.e) - 2) AS bin, count(*) AS c FROM {cur} v JOIN pe e ON e.f = v.f
       WHERE v.v >= e.e[1] AND v.v <= e.e[-1] GROUP BY ALL)"""


MONTH_VALS = each("SELECT '{f}' AS f, window_end AS m, {f}::DOUBLE AS v FROM eda WHERE {f} IS NOT NULL")
DRIFT = f"""allv AS ({MONTH_VALS}), refv AS (SELECT f, v FROM allv WHERE m = (SELECT min(window_end) FROM eda)),
curv AS (SELECT * FROM allv WHERE m > (SELECT min(window_end) FROM eda)), {drift_cte('refv', 'curv', 'v.m, ')},
grid AS (SELECT s.f, s.bin, mm.m, coalesce(t.c, 0) AS t, coalesce(c.c, 0) AS c FROM slots s CROSS JOIN (SELECT DISTINCT window_end AS m FROM eda WHERE window_end > (SELECT min(window_end) FROM eda)) mm
  LEFT JOIN tc t ON t.f = s.f AND t.bin = s.bin LEFT JOIN cc c ON c.f = s.f AND c.bin = s.bin AND c.m = mm.m),
sh AS (SELECT f, m, bin, CASE WHEN sum(t) OVER w > 0 THEN greatest(least(t / sum(t) OVER w, 1), 1e-8) ELSE 0 END AS pt,
  CASE WHEN sum(c) OVER w > 0 THEN greatest(least(c / sum(c) OVER w, 1), 1e-8) ELSE 0 END AS pc FROM grid WINDOW w AS (PARTITION BY f, m)),
cum AS (SELECT *, abs(sum(pt) OVER w - sum(pc) OVER w) AS gap FROM sh WINDOW w AS (PARTITION BY f, m ORDER BY bin)),
res AS (SELECT f, m, sum(CASE WHEN pt = 0 OR pc = 0 THEN 'inf'::DOUBLE ELSE (pc - pt) * ln(pc / pt) END) AS psi, max(gap) AS ks FROM cum GROUP BY f, m)"""

MEDIANS = each("SELECT '{f}' AS f, window_end AS m, quantile_cont({f}::DOUBLE, 0.5) AS y FROM eda WHERE {f} IS NOT NULL GROUP BY window_end")
TREND = f"""med AS ({MEDIANS}), mo AS (SELECT window_end AS m, (row_number() OVER (ORDER BY window_end) - 1)::DOUBLE AS x FROM (SELECT DISTINCT window_end FROM eda)),
fit AS (SELECT f, count(y) AS n, regr_slope(y, x) AS slope, regr_syy(y, x) AS syy, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy FROM med JOIN mo ON mo.m = med.m GROUP BY f),
tr AS (SELECT f, n, slope, CASE WHEN syy > 0 THEN 1 - greatest(syy - sxy * sxy / sxx, 0) / syy ELSE 0 END AS r2,
  CASE WHEN syy > 0 THEN slope / (sqrt(greatest(syy - sxy * sxy / sxx, 0) / (n - 2)) / sqrt(sxx)) END AS t FROM fit)"""

_CUR = all_stats("(SELECT * FROM eda WHERE window_end = '0107')")
_BASE = all_stats("(SELECT * FROM eda WHERE window_end <> '0107')")
_LONG = lambda src: "\nUNION ALL ".join(f"SELECT feature_name, '{s}' AS stat_name, {s} AS v FROM {src} WHERE {s} IS NOT NULL" for s in STATS)

_CHART = lambda chart, src, item, value, n, order: f"SELECT * FROM (SELECT '{chart}' AS chart, {item} AS item, {r(value)} AS value FROM {src} WHERE ({value}) IS NOT NULL ORDER BY {order} DESC, {item} LIMIT {n})"

ORACLE = {
    "descriptive_stats": with_ctes(f", {STATS_CTE} SELECT feature_name, count, {STATS_OUT} FROM stats s", "eda"),
    "missing_stats": with_ctes(MISSING, "eda"),
    "missing_patterns": with_ctes(
        """SELECT substr(md5(affected_columns), 1, 12) AS pattern_hash, affected_columns, count(*) AS row_count, round_even(count(*)::DOUBLE / (SELECT count(*) FROM eda), 6) + 0.0 AS pct_of_total
FROM (SELECT concat_ws(',', """ + ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in EDA_FEATURES) + """) AS affected_columns FROM eda) WHERE affected_columns <> '' GROUP BY affected_columns""", "eda"),
    "outlier_stats": with_ctes("SELECT * REPLACE (" + ", ".join(f"{r(c)} AS {c}" for c in ("iqr_lower", "iqr_upper", "iqr_outlier_pct", "zscore_outlier_pct")) + f") FROM ({OUTLIERS})", "eda"),
    "correlation_matrix": with_ctes(f"SELECT feature_a, feature_b, {r('correlation', 5)} AS correlation FROM ({CORR})", "eda"),
    "correlation_matrix_spearman": with_ctes(spearman_sql(), "eda"),
    "high_correlations": with_ctes(f"SELECT feature_a, feature_b, {r('correlation')} AS correlation FROM (SELECT * REPLACE ({e6('correlation')} AS correlation) FROM ({CORR})) WHERE feature_a < feature_b AND abs(correlation) >= 0.5", "eda"),
    "class_distribution": with_ctes(
        """SELECT count(*) AS total_count, count(*) FILTER (target = 1) AS positive_count, count(*) FILTER (target <> 1) AS negative_count,
  round_even(avg((target = 1)::INT), 6) AS churn_rate, round_even(count(*) FILTER (target <> 1)::DOUBLE / count(*) FILTER (target = 1), 4) AS imbalance_ratio FROM eda""", "eda"),
    "point_biserial": with_ctes(
        f"SELECT feature_name, n, {r(e6('r'))} AS correlation, {r('r * sqrt(n - 2) / sqrt(1 - r * r)', 4)} AS t_stat, n - 2 AS df FROM ({BISERIAL})", "eda"),
    "woe_iv": with_ctes(
        f""", {bins_cte()} SELECT f AS feature_name, bin, event, total, non_event, {r('de', 5)} AS dist_event, {r('dn', 5)} AS dist_non, {r('ln(dn / de)', 5)} AS woe,
  {r('(dn - de) * ln(dn / de)', 5)} AS iv_bin FROM woe""", "eda"),
    "all_iv": with_ctes(f", {bins_cte()} SELECT f AS feature_name, {r('iv')} AS iv, {STRENGTH} AS iv_strength FROM {IV_ALL}", "eda"),
    "monthly_drift": with_ctes(
        f""", {DRIFT} SELECT (SELECT min(window_end) FROM eda) AS reference_month, m AS comparison_month, f AS feature_name, {r(e6('psi'))} AS psi, {r(e6('ks'))} AS ks_stat,
  CASE WHEN psi > 0.2 THEN 'ALERT' WHEN psi > 0.1 THEN 'WARN' ELSE 'OK' END AS severity FROM res""", "eda"),
    "feature_trends": with_ctes(f", {TREND} SELECT f AS feature_name, n AS n_months, {r('round_even(slope, 8)', 8)} AS slope, {r(e6('r2'))} AS r_squared, {r('t', 4)} AS t_stat, n - 2 AS df FROM tr", "eda"),
    "monthly_snapshots": with_ctes("SELECT cms_code_enc, window_end, item_sum, recency::BIGINT AS recency FROM features WHERE window_size = 4 AND window_end IN (SELECT DISTINCT window_end FROM features WHERE window_size = 4 ORDER BY 1 DESC LIMIT 3)", "features"),
    "save_baseline": with_ctes(f", {STATS_CTE} SELECT 'run1' AS run_id, feature_name, count::DOUBLE AS count, {r('min_val')} AS min_val, {r('max_val')} AS max_val, {r('p50')} AS p50 FROM stats", "eda"),
    "compare_to_baseline": with_ctes(
        f""", c AS ({_CUR}), b AS ({_BASE}), cl AS ({_LONG('c')}), bl AS ({_LONG('b')})
SELECT feature_name, stat_name, {r(e6('bl.v'))} AS baseline_value, {r(e6('cl.v'))} AS current_value, {r(e6('cl.v - bl.v'))} AS delta, {r(e6('CASE WHEN bl.v <> 0 THEN (cl.v - bl.v) / bl.v END'))} AS delta_pct
FROM cl JOIN bl USING (feature_name, stat_name)""", "eda"),
    "merged_feature_stats": with_ctes(
        f""", {STATS_CTE}, mi AS ({MISSING}), ou AS ({OUTLIERS})
SELECT feature_name, s.count, {STATS_OUT}, mi.total_count, mi.missing_count, {r('mi.missing_pct')} AS missing_pct, mi.has_inf, {r('ou.iqr_lower')} AS iqr_lower, {r('ou.iqr_upper')} AS iqr_upper,
  ou.iqr_outlier_count, {r('ou.iqr_outlier_pct')} AS iqr_outlier_pct, ou.zscore_outlier_count, {r('ou.zscore_outlier_pct')} AS zscore_outlier_pct
FROM stats s LEFT JOIN mi USING (feature_name) LEFT JOIN ou USING (feature_name)""", "eda"),
    "merged_target_stats": with_ctes(
        f", {bins_cte()}, bs AS ({BISERIAL}) SELECT b.feature_name, {r(e6('b.r'))} AS correlation, {r('i.iv')} AS iv, {STRENGTH} AS iv_strength FROM bs b LEFT JOIN {IV_ALL} i ON i.f = b.feature_name", "eda"),
    "persist_report": with_ctes(
        f", mi AS ({MISSING}) SELECT 'r0' AS run_id, feature_name, 0 AS count, missing_count FROM mi UNION ALL SELECT 'r1', feature_name, total_count - missing_count, missing_count FROM mi", "eda"),
    "chart_rows": with_ctes(
        f""", {STATS_CTE}, mi AS ({MISSING}), ou AS ({OUTLIERS}), cr AS ({CORR}), bs AS ({BISERIAL}), {bins_cte()}, ivs AS (SELECT * FROM {IV_ALL}), {TREND},
hc AS (SELECT feature_a || ' / ' || feature_b AS pair, {e6('correlation')} AS correlation FROM cr WHERE feature_a < feature_b AND abs(correlation) >= 0.3) """
        + " UNION ALL ".join([
            _CHART("mean", "stats", "feature_name", "mean", 15, "mean"),
            _CHART("missing", "(SELECT * FROM mi WHERE missing_count > 0)", "feature_name", "missing_pct", 999, "missing_pct"),
            _CHART("outliers", "(SELECT * FROM ou WHERE iqr_outlier_count > 0)", "feature_name", "iqr_outlier_pct", 999, "iqr_outlier_pct"),
            _CHART("correlation", "hc", "pair", "correlation", 20, "abs(correlation)"),
            _CHART("iv", "ivs", "f", "iv", 20, "iv"),
            _CHART("point_biserial", "bs", "feature_name", "round_even(r, 6)", 20, "abs(r)"),
            _CHART("slope", "tr", "f", "round_even(slope, 8)", 15, "abs(slope)"),
        ]), "eda"),
}
