"""Drift, scoring, evaluation, report and table-merge queries with their check SQL."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from catalog.inputs import EDA_FEATURES, TOP_FEATURES, Inputs, tidy
from catalog.q_eda import drift_cte, each
from catalog.q_labels import remember
from catalog.sql import r, with_ctes
from parcelwise.functions import columns as C
from parcelwise.operators import drift as D
from parcelwise.operators import evaluate as V
from parcelwise.operators import prototype as PR
from parcelwise.operators import reports as R
from parcelwise.sources import tables as TB
from parcelwise.sources.upsert import insert_if_absent, latest_rows, merge_by_key

DRIFT_FEATURES = EDA_FEATURES


def _reference(i: Inputs):
    return i.eda.filter("window_end <> '0107'")


def _current(i: Inputs):
    return i.eda.filter("window_end = '0107'").select("cms_code_enc", *DRIFT_FEATURES)


@remember
def profile(i: Inputs):
    return D.numeric_profile(_reference(i), DRIFT_FEATURES).persist()


@remember
def run_history(i: Inputs):
    """One scoring row per month and horizon, made from the monthly activity."""
    per_month = i.customer_month.groupBy(C.month_number(F.col("report_month")).cast("int").alias("window_end")).agg(
        F.count(F.lit(1)).alias("active"),
        F.sum(F.when((F.col("item_count") % 3 == 0) | (F.col("total_complaint") > 0), 1).otherwise(0)).alias("risk"),
    )
    both = per_month.withColumn("horizon", F.explode(F.array(F.lit(1), F.lit(2))))
    ratio = F.when(F.col("window_end") % 7 != 0, F.col("risk") / (F.col("active") + F.col("horizon")))
    return both.select("horizon", "window_end", ratio.alias("risk_ratio")).persist()


def config_history(i: Inputs):
    """A configuration row per month and horizon from the same activity."""
    h = run_history(i)
    return h.select(
        F.col("window_end").alias("as_of_month"), "horizon", (F.col("window_end") % 4 + 3).alias("best_k"),
        F.coalesce("risk_ratio", F.lit(0.0)).alias("metric_f05"), (F.col("window_end") % 3 != 0).alias("is_accepted"),
    )


def q_counts_on_profile(i: Inputs):
    return tidy(D.counts_on_profile(_current(i), profile(i)))


def q_feature_drift(i: Inputs):
    """``revenue_avg`` is left out of the current rows on purpose."""
    return tidy(D.feature_drift(_current(i).drop("revenue_avg"), profile(i)), 5)


def q_upsert_feature_drift(i: Inputs):
    """Drift rows of a window merged over an older run of the same window."""
    keys = {"window_end": F.lit(107), "horizon": F.lit(2)}
    new = D.feature_drift(_current(i), profile(i)).select("feature_name", "severity", "ks_stat").withColumns(keys)
    old = new.filter("feature_name <> 'recency'").withColumn("severity", F.lit("OLD")).withColumn("ks_stat", F.lit(0.0))
    other = old.withColumn("window_end", F.lit(106))
    return tidy(merge_by_key(old.unionByName(other), new, ["window_end", "horizon", "feature_name"]), 5)


def q_categorical_profile(i: Inputs):
    rows = i.features.filter("window_size = 3").select("dominant_service", "window_end", "most_common_complaint")
    return tidy(D.categorical_profile(rows, ["dominant_service", "window_end", "most_common_complaint"], 10))


def q_score_drift(i: Inputs):
    history = run_history(i).filter("window_end < 107")
    flagged = V.top_percent_threshold(i.scored, 0.5)
    row = D.score_drift(flagged, history, window_end=107, horizon=2, best_k=3, churned_now=0, risk_pct=90)
    return tidy(row.drop("anomaly_reason"))


def _backtest(i: Inputs):
    flagged = V.top_percent_threshold(i.scored, 0.5, 30.0)
    labels = i.scored.select("cms_code_enc", F.col("label").alias("churned")).filter("substr(cms_code_enc, 9, 1) <> '7'")
    return D.precision_in_list(flagged, labels)


def q_upsert_backtest(i: Inputs):
    row = D.backtest_row(_backtest(i), pred_window_end=107, label_window_end=109, horizon=2, best_k=3, risk_pct=90)
    old = run_history(i).select(F.col("window_end").alias("pred_window_end"), "horizon", F.lit(-1).cast("bigint").alias("list_size"))
    new = row.select("pred_window_end", "horizon", "list_size")
    return tidy(merge_by_key(old, new, ["pred_window_end", "horizon"]))


def _runs(i: Inputs):
    orders = i.table("orders").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("run_id")).agg(
        F.count(F.lit(1)).cast("int").alias("window_end"), F.max("o_orderdate").alias("started_at")
    )
    return orders.withColumn("status", F.lit("RUNNING")).withColumn("notes", F.when(F.col("window_end") % 2 == 0, "even"))


def q_run_log(i: Inputs):
    """New runs added, then some of them finished; a NULL update keeps the old value."""
    first = _runs(i).filter("run_id < '200001'")
    started = D.start_run(first, _runs(i).withColumn("status", F.lit("NEW")))
    done = _runs(i).filter("run_id >= '199906'").select(
        "run_id", F.lit("SUCCESS").alias("status"), F.when(F.col("window_end") % 3 == 0, "closed").alias("notes")
    )
    return tidy(D.finish_run(started, done))


def q_merge_by_key(i: Inputs):
    """Customer totals of the early years updated by later ones."""
    def totals(cond: str):
        return i.table("orders").filter(cond).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last_key"))

    return tidy(merge_by_key(totals("o_orderdate < '1997-01-01'"), totals("o_orderdate >= '2001-01-01'"), ["o_custkey"], ["n"]))


def q_insert_if_absent(i: Inputs):
    orders = i.table("orders")
    old = orders.filter("o_orderpriority = '2-HIGH'").select("o_custkey").distinct().withColumn("src", F.lit("old"))
    new = orders.filter("o_orderpriority <> '2-HIGH'").select("o_custkey").withColumn("src", F.lit("new"))
    return tidy(insert_if_absent(old, new, ["o_custkey"]))


def q_guardrail(i: Inputs):
    rows = i.scored.withColumn("label", F.when(F.substring("cms_code_enc", 9, 1) == "3", F.col("label")).otherwise(0))
    return tidy(V.guardrail(V.evaluate(rows).select("f05", "pr_auc"), min_score=0.5, min_auc=0.05), 5)


def q_accept_reject(i: Inputs):
    h = config_history(i).filter("horizon = 1")
    from pyspark.sql import Window

    prev = F.lag("metric_f05").over(Window.partitionBy("horizon").orderBy("as_of_month"))
    rows = h.withColumn("prev_f05", prev).select("as_of_month", F.col("metric_f05").alias("new_f05"), "prev_f05")
    return tidy(V.accept_reject(rows))


def q_update_metrics(i: Inputs):
    report = config_history(i).filter("as_of_month % 5 = 0").select(
        "as_of_month", "horizon", F.lit(0.5).alias("metric_f05"), F.lit(None).cast("string").alias("guardrail_warning")
    )
    unknown = report.withColumn("as_of_month", F.col("as_of_month") + 5000)
    return tidy(V.update_metrics(config_history(i), report.unionByName(unknown)))


def q_prototype_cache(i: Inputs):
    """What the cache of all runs since 2000 offers at two months, after one more run was saved."""
    runs = config_history(i).filter("is_accepted and as_of_month < 9000")
    columns = {
        "mu": F.array("metric_f05"), "sigma_inv": F.array(F.array("metric_f05")), "sigma2": F.col("metric_f05"), "features": F.array(F.lit("x")),
        "n_confirmed": F.lit(1), "run_month": F.col("as_of_month").cast("int"), "horizon": F.col("horizon").cast("int"),
    }
    cache = runs.select(*[c.alias(n) for n, c in columns.items()])
    fresh = PR.Prototype(np.array([9.0]), np.array([[9.0]]), 9.0, ["x"], 1)
    cache = PR.save_prototype(i.spark, cache, fresh, 109, 1)
    found = [(h, at, PR.load_latest_prototype(cache, h, at)) for h in (1, 2) for at in (112, 206)]
    return i.spark.createDataFrame([(h, at, p.sigma2 if p else None) for h, at, p in found], "horizon bigint, at_month bigint, sigma2 double").withColumn("sigma2", F.round("sigma2", 6))


def q_month_status(i: Inputs):
    keyed = i.shipments.withColumn("yymm", C.month_key(F.col("sending_time")))
    parts = {"bccp_orderitem": i.shipments, "cms_complaint": i.complaints, "cas_info": i.info,
             "bccp_orderitem_9001": TB.scan_months(keyed, "1990-01-01", "1990-01-31"), "cas_customer": None}
    return tidy(TB.table_status(parts))


def q_write_risk_table(i: Inputs):
    return tidy(R.risk_table(i.risk, window_end="0107", w_star=3, horizon=2))


def q_confusion(i: Inputs):
    truth = i.scored.select("cms_code_enc", F.col("label").alias("actual_churn"))
    return tidy(R.confusion_by_list(truth, i.risk.filter("churn_rate >= 70")))


RISK_COLS = ["cms_code_enc", "churn_rate", "risk_level", "item_last", "revenue_last", "complaint_last", "delay_last", "nodone_last", "reason_1"]

QUERIES = {
    "numeric_profile": lambda i: tidy(profile(i)),
    "categorical_profile": q_categorical_profile,
    "counts_on_profile": q_counts_on_profile,
    "counts_on_profile_clamped": lambda i: tidy(D.counts_on_profile(_current(i), profile(i), clamp=True)),
    "psi": lambda i: tidy(D.stability(D.counts_on_profile(_current(i), profile(i))), 5),
    "feature_drift": q_feature_drift,
    "upsert_feature_drift": q_upsert_feature_drift,
    "risk_ratio_anomaly": lambda i: tidy(D.risk_ratio_anomaly(run_history(i)).drop("anomaly_reason")),
    "score_stats": lambda i: tidy(D.score_stats(V.top_percent_threshold(i.scored, 0.5))),
    "score_drift": q_score_drift,
    "precision_in_list": lambda i: tidy(_backtest(i)),
    "upsert_backtest": q_upsert_backtest,
    "run_log": q_run_log,
    "latest_runs": lambda i: tidy(D.latest_runs(_runs(i), "started_at", 20, ["run_id"])),
    "latest_rows": lambda i: tidy(latest_rows(config_history(i).filter("horizon = 2"), [F.col("as_of_month").desc()], 1, 1)),
    "config_history": lambda i: tidy(V.latest_config(config_history(i), 1, accepted=True, skip=1)),
    "update_metrics": q_update_metrics,
    "prototype_cache": q_prototype_cache,
    "merge_by_key": q_merge_by_key,
    "insert_if_absent": q_insert_if_absent,
    "table_status": q_month_status,
    "top_percent_threshold": lambda i: tidy(V.top_percent_threshold(i.scored, 0.5).select("cms_code_enc", "churn_probability", "threshold_used", "churn_flag")),
    "pr_curve": lambda i: tidy(V.pr_curve(i.scored)),
    "best_threshold_fbeta": lambda i: tidy(V.best_threshold_fbeta(i.scored)),
    "evaluate": lambda i: tidy(V.evaluate(i.scored)),
    "guardrail": q_guardrail,
    "accept_reject": q_accept_reject,
    "reasons": lambda i: tidy(V.reasons(i.scored, [*TOP_FEATURES, "no_such_feature"]).select("cms_code_enc", "reason_1", "reason_2", "reason_3", "reason_4")),
    "write_risk_table": q_write_risk_table,
    "top_risk": lambda i: tidy(R.top_risk(i.risk)),
    "risk_distribution": lambda i: tidy(R.risk_distribution(i.risk)),
    "reason_frequency": lambda i: tidy(R.reason_frequency(i.risk)),
    "reason_frequency_all": lambda i: tidy(R.reason_frequency_all(i.risk)),
    "risk_by_reason": lambda i: tidy(R.risk_by_reason(i.risk, "Low item_sum")),
    "export_risk_campaign": lambda i: tidy(R.risk_campaign(i.risk)),
    "risk_summary": lambda i: tidy(R.risk_summary(i.risk)),
    "threshold_comparison": lambda i: tidy(R.threshold_comparison(i.risk)),
    "confusion_by_list": q_confusion,
    "risk_summary_view": lambda i: tidy(R.risk_summary_view(i.risk).select(*RISK_COLS)),
    "critical_and_high": lambda i: tidy(R.critical_and_high(R.risk_summary_view(i.risk)).select(*RISK_COLS)),
}

# --------------------------------------------------------------------------

_VALS = lambda cond: each("SELECT '{f}' AS f, {f}::DOUBLE AS v FROM eda WHERE {f} IS NOT NULL AND " + cond, DRIFT_FEATURES)
PROFILE = f"refv AS ({_VALS(chr(34) + 'window_end' + chr(34) + ' <> ' + chr(39) + '0107' + chr(39))}), curv AS ({_VALS(chr(34) + 'window_end' + chr(34) + ' = ' + chr(39) + '0107' + chr(39))}), {drift_cte('refv', 'curv', '')}"
GRID = """grid AS (SELECT s.f, s.bin, s.e[s.bin + 1] AS lo, s.e[s.bin + 2] AS hi, s.n, coalesce(t.c, 0) AS t, coalesce(c.c, 0) AS c FROM slots s
  LEFT JOIN tc t ON t.f = s.f AND t.bin = s.bin LEFT JOIN cc c ON c.f = s.f AND c.bin = s.bin)"""
PSI = """sh AS (SELECT f, n, bin, CASE WHEN sum(t) OVER w > 0 THEN greatest(least(t / sum(t) OVER w, 1), 1e-8) ELSE 0 END AS pt,
  CASE WHEN sum(c) OVER w > 0 THEN greatest(least(c / sum(c) OVER w, 1), 1e-8) ELSE 0 END AS pc FROM grid WINDOW w AS (PARTITION BY f)),
cum AS (SELECT *, abs(sum(pt) OVER w - sum(pc) OVER w) AS gap FROM sh WINDOW w AS (PARTITION BY f ORDER BY bin)),
res AS (SELECT f, any_value(n) AS n, sum(CASE WHEN pt = 0 OR pc = 0 THEN 'inf'::DOUBLE ELSE (pc - pt) * ln(pc / pt) END) AS psi, max(gap) AS ks FROM cum GROUP BY f)"""
SEV = "CASE WHEN psi > 0.2 THEN 'ALERT' WHEN psi > 0.1 THEN 'WARN' ELSE 'OK' END"
RUNS = """hist AS (SELECT h AS horizon, month_key_num AS window_end, CASE WHEN month_key_num % 7 <> 0 THEN risk / (active + h)::DOUBLE END AS risk_ratio
  FROM (SELECT month_key_num, count(*) AS active, sum(CASE WHEN item_count % 3 = 0 OR total_complaint > 0 THEN 1 ELSE 0 END) AS risk FROM cm GROUP BY 1) CROSS JOIN (SELECT unnest([1, 2]) AS h)),
conf AS (SELECT window_end AS as_of_month, horizon::BIGINT AS horizon, window_end % 4 + 3 AS best_k, coalesce(risk_ratio, 0) AS metric_f05, window_end % 3 <> 0 AS is_accepted FROM hist)"""
MAD = "median(list_transform(p, lambda x: abs(x - list_median(p))))"
CUT90 = "greatest(0.5, (SELECT quantile_cont(churn_probability, 0.9) FROM scored))"
CUT70 = "greatest(0.5, (SELECT quantile_cont(churn_probability, 0.7) FROM scored))"
_MED = "list_aggregate({a}, 'median')"
_LIMIT = f"{_MED.format(a='p')} + 3.0 * ({_MED.format(a='list_transform(p, lambda x: abs(x - ' + _MED.format(a='p') + '))')} + 1e-9)"
BACK = f"""lab AS (SELECT cms_code_enc, label FROM scored WHERE substr(cms_code_enc, 9, 1) <> '7'),
fl AS (SELECT s.cms_code_enc, l.label FROM scored s LEFT JOIN lab l ON l.cms_code_enc = s.cms_code_enc WHERE s.churn_probability >= {CUT70}),
m AS (SELECT (SELECT count(*) FROM scored) AS active_cnt, count(*) AS list_size, (SELECT sum(label) FROM lab)::BIGINT AS churn_true_total, coalesce(sum(label), 0)::BIGINT AS churn_true_in_list FROM fl)"""
RUNTAB = """runs AS (SELECT strftime(o_orderdate, '%Y%m') AS run_id, count(*) AS window_end, max(o_orderdate) AS started_at, CASE WHEN count(*) % 2 = 0 THEN 'even' END AS notes FROM orders GROUP BY 1)"""
CURVE = """sc AS (SELECT churn_probability AS score, sum(label) AS pos, count(*) AS cnt FROM scored GROUP BY 1),
cv AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(cnt) OVER w AS cum_cnt FROM sc WINDOW w AS (ORDER BY score DESC)),
pr AS (SELECT *, cum_pos / cum_cnt AS precision, cum_pos / (SELECT sum(pos) FROM sc) AS recall FROM cv),
th AS (SELECT score AS t FROM pr ORDER BY 1.25 * precision * recall / (0.25 * precision + recall + 1e-9) DESC, score LIMIT 1),
ev AS (SELECT (SELECT t FROM th) AS threshold, sum(label) AS n_pos, count(*) AS n_eval, count(*) - sum(label) AS n_neg,
  sum(label) FILTER (churn_probability >= (SELECT t FROM th)) AS tp, count(*) FILTER (churn_probability >= (SELECT t FROM th)) AS fl FROM scored),
ap AS (SELECT sum((pos / (SELECT sum(pos) FROM sc)) * precision) AS ap FROM pr),
rk AS (SELECT label, avg(rn) OVER (PARTITION BY churn_probability) AS rank FROM (SELECT *, row_number() OVER (ORDER BY churn_probability) AS rn FROM scored)),
auc AS (SELECT (sum(rank) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)::DOUBLE / (count(*) FILTER (label = 1) * count(*) FILTER (label <> 1)) AS auc FROM rk),
met AS (SELECT *, tp / fl AS p, tp / n_pos AS r FROM ev, ap, auc)"""
_F = lambda b2: f"coalesce({1 + b2} * p * r / nullif({b2} * p + r, 0), 0)"

ORACLE = {
    "numeric_profile": with_ctes(f", {PROFILE}, {GRID} SELECT f AS feature, n, bin, {r('lo')} AS lo, {r('hi')} AS hi, t AS train_count FROM grid", "eda"),
    "categorical_profile": with_ctes(
        """, v AS (SELECT 'dominant_service' AS feature, dominant_service AS value FROM features WHERE window_size = 3 UNION ALL SELECT 'window_end', window_end FROM features WHERE window_size = 3
  UNION ALL SELECT 'most_common_complaint', coalesce(most_common_complaint::VARCHAR, 'NA') FROM features WHERE window_size = 3)
SELECT feature, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, value) AS rank, value, count(*) AS cnt, sum(count(*)) OVER (PARTITION BY feature)::BIGINT AS n
FROM v GROUP BY feature, value QUALIFY rank <= 10""", "features"),
    "counts_on_profile": with_ctes(f", {PROFILE}, {GRID} SELECT f AS feature, bin, {r('lo')} AS lo, {r('hi')} AS hi, t AS train_count, c AS cur_count FROM grid", "eda"),
    "counts_on_profile_clamped": with_ctes(
        f""", {PROFILE}, {GRID}, k AS (SELECT v.f, greatest(least(len(list_filter(e.e, lambda x: x <= v.v)) - 1, len(e.e) - 2), 0) AS bin, count(*) AS c FROM curv v JOIN pe e ON e.f = v.f GROUP BY ALL)
SELECT g.f AS feature, g.bin, {r('lo')} AS lo, {r('hi')} AS hi, t AS train_count, coalesce(k.c, 0) AS cur_count FROM grid g LEFT JOIN k ON k.f = g.f AND k.bin = g.bin""", "eda"),
    "psi": with_ctes(f", {PROFILE}, {GRID}, {PSI} SELECT f AS feature, {r('psi', 5)} AS psi, {r('ks', 5)} AS ks_stat FROM res", "eda"),
    "feature_drift": with_ctes(
        f""", {PROFILE}, {GRID}, {PSI}, cn AS (SELECT f, count(*) AS c FROM curv GROUP BY f)
SELECT res.f AS feature_name, CASE WHEN res.f <> 'revenue_avg' THEN {r('psi', 5)} END AS psi, CASE WHEN res.f <> 'revenue_avg' THEN {r('ks', 5)} END AS ks_stat,
  CASE WHEN res.f = 'revenue_avg' THEN 'ALERT' ELSE {SEV} END AS severity, res.f = 'revenue_avg' OR psi > 0.2 AS is_anomaly,
  CASE WHEN res.f = 'revenue_avg' THEN '{{"reason":"missing_in_current"}}' ELSE '{{"train_n":' || n || ',"cur_n":' || cn.c || '}}' END AS details_json
FROM res LEFT JOIN cn ON cn.f = res.f""", "eda"),
    "upsert_feature_drift": with_ctes(
        f""", {PROFILE}, {GRID}, {PSI} SELECT 107 AS window_end, 2 AS horizon, f AS feature_name, {SEV} AS severity, {r('ks', 5)} AS ks_stat FROM res
UNION ALL SELECT 106, 2, f, 'OLD', 0.0 FROM res WHERE f <> 'recency'""", "eda"),
    "risk_ratio_anomaly": with_ctes(
        f""", {RUNS}, w AS (SELECT *, list(risk_ratio) FILTER (risk_ratio IS NOT NULL) OVER (PARTITION BY horizon ORDER BY window_end ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS p FROM hist)
SELECT horizon, window_end, {r('risk_ratio')} AS risk_ratio, CASE WHEN len(p) >= 4 THEN {r(_LIMIT)} END AS anomaly_limit,
  coalesce(len(p) >= 4 AND risk_ratio > {_LIMIT}, false) AS is_anomaly FROM w""", "cm"),
    "score_stats": with_ctes(
        f"""SELECT {r('avg(churn_probability)')} AS mean, {r('quantile_cont(churn_probability, 0.5)')} AS p50, {r('quantile_cont(churn_probability, 0.9)')} AS p90, {r('quantile_cont(churn_probability, 0.99)')} AS p99,
  count(*) FILTER (churn_probability >= {CUT90}) AS risk_count, count(*) AS active_count, {r(f'count(*) FILTER (churn_probability >= {CUT90})::DOUBLE / count(*)')} AS risk_ratio FROM scored""", "scored"),
    "score_drift": with_ctes(
        f""", {RUNS}, hp AS (SELECT list(risk_ratio) FILTER (risk_ratio IS NOT NULL) AS p FROM (SELECT * FROM hist WHERE horizon = 2 AND window_end < 107 ORDER BY window_end DESC LIMIT 6)),
st AS (SELECT avg(churn_probability) AS mean, quantile_cont(churn_probability, 0.5) AS p50, quantile_cont(churn_probability, 0.9) AS p90, quantile_cont(churn_probability, 0.99) AS p99,
  count(*) FILTER (churn_probability >= {CUT90}) AS risk, count(*) AS n FROM scored)
SELECT 107 AS window_end, 2 AS horizon, 3 AS best_k, n AS active_cnt, 0 AS churned_now_cnt, {r('mean')} AS mean_score, {r('p50')} AS p50, {r('p90')} AS p90, {r('p99')} AS p99, 90 AS risk_threshold_pct,
  risk AS risk_cnt, {r('risk::DOUBLE / n')} AS risk_ratio, coalesce(len(p) >= 4 AND risk::DOUBLE / n > {_LIMIT}, false) AS is_anomaly FROM st, hp""", "scored", "cm"),
    "precision_in_list": with_ctes(
        f""", {BACK} SELECT active_cnt, list_size, churn_true_total, churn_true_in_list, {r('churn_true_in_list / list_size')} AS precision_in_list, {r('churn_true_in_list / churn_true_total')} AS recall_in_list,
  {r('2 * (churn_true_in_list / list_size) * (churn_true_in_list / churn_true_total) / nullif(churn_true_in_list / list_size + churn_true_in_list / churn_true_total, 0)')} AS f1_in_list FROM m""", "scored"),
    "upsert_backtest": with_ctes(
        f""", {BACK}, {RUNS} SELECT window_end AS pred_window_end, horizon, CASE WHEN window_end = 107 AND horizon = 2 THEN (SELECT list_size FROM m) ELSE -1 END AS list_size FROM hist""", "scored", "cm"),
    "run_log": f"""WITH {RUNTAB} SELECT run_id, window_end, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at,
  CASE WHEN run_id >= '199906' THEN 'SUCCESS' WHEN run_id < '200001' THEN 'RUNNING' ELSE 'NEW' END AS status,
  CASE WHEN run_id >= '199906' AND window_end % 3 = 0 THEN 'closed' ELSE notes END AS notes FROM runs""",
    "latest_runs": f"WITH {RUNTAB} SELECT run_id, window_end, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at, 'RUNNING' AS status, notes FROM runs ORDER BY runs.started_at DESC, run_id LIMIT 20",
    "latest_rows": with_ctes(f", {RUNS} SELECT as_of_month, horizon, best_k, {r('metric_f05')} AS metric_f05, is_accepted FROM conf WHERE horizon = 2 ORDER BY as_of_month DESC LIMIT 1 OFFSET 1", "cm"),
    "config_history": with_ctes(f", {RUNS} SELECT as_of_month, horizon, best_k, {r('metric_f05')} AS metric_f05, is_accepted FROM conf WHERE horizon = 1 AND is_accepted ORDER BY as_of_month DESC LIMIT 1 OFFSET 1", "cm"),
    "update_metrics": with_ctes(f", {RUNS} SELECT as_of_month, horizon, best_k, CASE WHEN as_of_month % 5 = 0 THEN 0.5 ELSE {r('metric_f05')} END AS metric_f05, is_accepted FROM conf", "cm"),
    "prototype_cache": with_ctes(
        f""", {RUNS}, c AS (SELECT as_of_month AS run_month, horizon, metric_f05 AS s FROM conf WHERE is_accepted AND as_of_month < 9000 AND NOT (as_of_month = 109 AND horizon = 1) UNION ALL SELECT 109, 1, 9.0),
n AS (SELECT horizon, max(run_month) AS run_month, arg_max(s, run_month) AS s FROM c GROUP BY horizon)
SELECT horizon, at_month, CASE WHEN (at_month // 100 - run_month // 100) * 12 + at_month % 100 - run_month % 100 <= 3 THEN {r('s')} END AS sigma2 FROM n CROSS JOIN (SELECT unnest([112, 206])::BIGINT AS at_month)""", "cm"),
    "merge_by_key": """WITH a AS (SELECT o_custkey, count(*) AS n, max(o_orderkey) AS k FROM orders WHERE o_orderdate < '1997-01-01' GROUP BY 1),
b AS (SELECT o_custkey, count(*) AS n, max(o_orderkey) AS k FROM orders WHERE o_orderdate >= '2001-01-01' GROUP BY 1)
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(b.n, a.n) AS n, coalesce(a.k, b.k) AS last_key FROM a FULL JOIN b ON a.o_custkey = b.o_custkey""",
    "insert_if_absent": """SELECT o_custkey, CASE WHEN bool_or(o_orderpriority = '2-HIGH') THEN 'old' ELSE 'new' END AS src FROM orders GROUP BY o_custkey""",
    "table_status": with_ctes(
        """SELECT 'bccp_orderitem' AS table_name, 'HAS DATA' AS status, count(*) AS row_count FROM shipments UNION ALL SELECT 'cms_complaint', 'HAS DATA', count(*) FROM complaints
UNION ALL SELECT 'cas_info', 'HAS DATA', count(*) FROM info UNION ALL SELECT 'bccp_orderitem_9001', 'EMPTY', 0 UNION ALL SELECT 'cas_customer', 'MISSING', NULL""", "shipments", "complaints", "info"),
    "top_percent_threshold": with_ctes(f"SELECT cms_code_enc, churn_probability, {r(CUT90)} AS threshold_used, CASE WHEN churn_probability >= {CUT90} THEN 1 ELSE 0 END AS churn_flag FROM scored", "scored"),
    "pr_curve": with_ctes(f", {CURVE} SELECT score, pos::BIGINT AS pos, cnt, cum_pos::BIGINT AS cum_pos, cum_cnt::BIGINT AS cum_cnt, {r('precision')} AS precision, {r('recall')} AS recall FROM pr", "scored"),
    "best_threshold_fbeta": with_ctes(f", {CURVE} SELECT t AS threshold FROM th", "scored"),
    "evaluate": with_ctes(
        f""", {CURVE} SELECT {r(_F(1.0))} AS f1, {r(_F(0.25))} AS f05, {r('p')} AS precision, {r('r')} AS recall, {r('ap')} AS pr_auc, {r('auc')} AS roc_auc, threshold,
  n_eval, n_pos::BIGINT AS n_pos, n_neg::BIGINT AS n_neg FROM met""", "scored"),
    "guardrail": with_ctes(
        f""", keep AS (SELECT * REPLACE (CASE WHEN substr(cms_code_enc, 9, 1) = '3' THEN label ELSE 0 END AS label) FROM scored), {CURVE.replace('FROM scored', 'FROM keep')}
SELECT {r(_F(0.25), 5)} AS f05, {r('ap', 5)} AS pr_auc, {_F(0.25)} >= 0.5 AND ap >= 0.05 AS passed,
  CASE WHEN {_F(0.25)} >= 0.5 AND ap >= 0.05 THEN printf('F0.5 %.4f reaches 0.5, PR-AUC %.4f reaches 0.05', {_F(0.25)}, ap)
  ELSE concat_ws(', ', CASE WHEN {_F(0.25)} < 0.5 THEN printf('F0.5 %.4f is below 0.5', {_F(0.25)}) END, CASE WHEN ap < 0.05 THEN printf('PR-AUC %.4f is below 0.05', ap) END) END AS reason FROM met""", "scored"),
    "accept_reject": with_ctes(
        f""", {RUNS}, l AS (SELECT as_of_month, metric_f05 AS new_f05, lag(metric_f05) OVER (ORDER BY as_of_month) AS prev_f05 FROM conf WHERE horizon = 1)
SELECT as_of_month, {r('new_f05')} AS new_f05, {r('prev_f05')} AS prev_f05, prev_f05 IS NULL OR new_f05 > prev_f05 + 1e-6 AS accepted,
  CASE WHEN prev_f05 IS NULL THEN 'accepted_no_previous' ELSE CASE WHEN new_f05 > prev_f05 + 1e-6 THEN 'accepted_f05_improved' ELSE 'rejected_f05_not_improved' END || printf(' (%.4f to %.4f)', prev_f05, new_f05) END AS accept_rule FROM l""", "cm"),
    "reasons": with_ctes("SELECT cms_code_enc, reason_1, reason_2, reason_3, 'Feature: no_such_feature' AS reason_4 FROM risk", "risk"),
    "write_risk_table": with_ctes(
        f"SELECT cms_code_enc, churn_probability, churn_flag, {r('threshold_used')} AS threshold, '0107' AS window_end, 3 AS w_star, 2 AS horizon, reason_1, reason_2, reason_3 FROM risk WHERE churn_flag = 1", "risk"),
    "top_risk": with_ctes(
        f"SELECT cms_code_enc, round(churn_rate, 2) AS churn_rate, {r('revenue_last / 1000000.0')} AS revenue_last_m, item_last, complaint_last, delay_last, nodone_last, reason_1, reason_2, reason_3 FROM risk ORDER BY risk.churn_rate DESC, cms_code_enc LIMIT 20", "risk"),
    "risk_distribution": with_ctes(
        f"""SELECT CASE WHEN churn_rate >= 90 THEN '90-100%' WHEN churn_rate >= 80 THEN '80-90%' WHEN churn_rate >= 70 THEN '70-80%' ELSE '<70%' END AS risk_bucket, count(*) AS num_customers,
  round(avg(churn_rate), 2) AS avg_churn_rate, {r('min(churn_rate)')} AS min_rate, {r('max(churn_rate)')} AS max_rate FROM risk GROUP BY 1""", "risk"),
    "reason_frequency": with_ctes("SELECT reason_1, count(*) AS frequency, round(count(*) * 100.0 / (SELECT count(*) FROM risk), 2)::DOUBLE AS pct FROM risk WHERE reason_1 IS NOT NULL GROUP BY 1", "risk"),
    "reason_frequency_all": with_ctes("SELECT reason, count(*) AS frequency FROM (SELECT reason_1 AS reason FROM risk UNION ALL SELECT reason_2 FROM risk UNION ALL SELECT reason_3 FROM risk) WHERE reason IS NOT NULL GROUP BY 1", "risk"),
    "risk_by_reason": with_ctes(f"SELECT cms_code_enc, {r('churn_rate')} AS churn_rate, item_last, reason_1, reason_2, reason_3 FROM risk WHERE reason_1 = 'Low item_sum' ORDER BY risk.churn_rate DESC, cms_code_enc LIMIT 20", "risk"),
    "export_risk_campaign": with_ctes(
        "SELECT cms_code_enc, round(churn_rate, 2) AS churn_rate, item_last, round(revenue_last / 1000000.0, 2)::DOUBLE AS revenue_last_m, complaint_last, reason_1, reason_2, reason_3 FROM risk WHERE churn_rate >= 75", "risk"),
    "risk_summary": with_ctes(
        """SELECT 'Total Customers' AS metric, count(*)::DOUBLE AS value FROM risk UNION ALL SELECT 'Avg Churn Rate (%)', round(avg(churn_rate), 2) FROM risk
UNION ALL SELECT 'Median Churn Rate (%)', round(quantile_cont(churn_rate, 0.5), 2) FROM risk UNION ALL SELECT 'Max Churn Rate (%)', round(max(churn_rate), 2) FROM risk
UNION ALL SELECT 'Min Churn Rate (%)', round(min(churn_rate), 2) FROM risk UNION ALL SELECT 'Std Dev Churn Rate', round(stddev_samp(churn_rate), 2) FROM risk
UNION ALL SELECT 'Customers with reason_1', count(reason_1) FROM risk UNION ALL SELECT 'Customers with reason_2', count(reason_2) FROM risk UNION ALL SELECT 'Customers with reason_3', count(reason_3) FROM risk""", "risk"),
    "threshold_comparison": with_ctes(
        "SELECT t || '% Threshold' AS threshold, (SELECT count(*) FROM risk WHERE churn_rate >= t) AS num_customers FROM (SELECT unnest([70, 75, 80]) AS t)", "risk"),
    "confusion_by_list": with_ctes(
        """SELECT CASE WHEN label = 1 AND churn_rate >= 70 THEN 'True Positive' WHEN label = 1 THEN 'False Negative' WHEN churn_rate >= 70 THEN 'False Positive' ELSE 'True Negative' END AS prediction_type, count(*) AS count FROM risk GROUP BY 1""", "risk"),
}
_LEVEL = "CASE WHEN churn_rate >= 90 THEN 'Critical' WHEN churn_rate >= 80 THEN 'High' WHEN churn_rate >= 70 THEN 'Medium' ELSE 'Low' END"
_VIEW = f"SELECT cms_code_enc, {r('churn_rate')} AS churn_rate, {_LEVEL} AS risk_level, item_last, revenue_last, complaint_last, delay_last, nodone_last, reason_1 FROM risk"
ORACLE["risk_summary_view"] = with_ctes(_VIEW, "risk")
ORACLE["critical_and_high"] = with_ctes(f"{_VIEW} WHERE churn_rate >= 80 ORDER BY risk.churn_rate DESC, cms_code_enc LIMIT 30", "risk")
