"""Roll-up, window and lifetime queries with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql as S
from catalog.inputs import ALPHA, END_KEY, FUTURE, HISTORY, MAX_SIZE, SIZES, T_OBS, W, Inputs, tidy
from catalog.sql import SERVICES, feature_list, r, with_ctes
from catalog.sql import ewma_sql as _ewma_sql
from parcelwise.functions import columns as C
from parcelwise.operators import features as X
from parcelwise.operators import rollup as R
from parcelwise.functions.lineage import scratch_path
from parcelwise.plans import refresh as RF
from parcelwise.plans import windows as P
from parcelwise.sources import tables as T
from parcelwise.schemas import PIVOT_METRICS, SERVICE_COLUMNS, WINDOW_KEYS

KEYS = "cms_code_enc, window_size::BIGINT AS window_size, window_start, window_end"
KEYS3 = "cms_code_enc, window_size::BIGINT AS window_size, window_end"

# Means of half points often end in an exact half at the sixth digit, so they keep two more.
FINE = {"lifetime_avg_order_score": 8, "lifetime_avg_satisfaction": 8}

MONTHLY_INTS = (
    "item_count total_fee total_complaint delay_count delay_day nodone refunded noaccepted lost_order "
    "intra_province international"
).split() + SERVICE_COLUMNS
MONTHLY_DOUBLES = "order_score satisfaction_score weight_kg lastday".split()
BASE_DOUBLES = (
    "item_avg item_std revenue_avg revenue_std complaint_avg complaint_std weight_sum weight_avg weight_std "
    "order_score_avg order_score_std satisfaction_avg satisfaction_std avg_lastday"
).split()
BASE_INTS = ["month_count", "item_sum", "revenue_sum", "complaint_sum", "active_months", *[f"{s}_sum" for s in SERVICE_COLUMNS]]


def q_monthly_rollup(i: Inputs):
    return tidy(R.monthly_rollup(i.shipments, HISTORY, FUTURE))


def q_monthly_sums(i: Inputs):
    return tidy(R.monthly_sums(i.customer_month))


def q_date_range(i: Inputs):
    rows = R.date_range(i.shipments, "sending_time", "2000-01-01", "2000-06-30")
    whole = R.date_range(i.shipments, "sending_time", "2000-01-01", "2000-06-30", inclusive_end_day=True)
    count = lambda df, k: df.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum("total_fee").alias("fee")).withColumn("kind", F.lit(k))
    return tidy(count(rows, "midnight").unionByName(count(whole, "whole_day")))


def q_window_base(i: Inputs):
    medians = [X._median(m, MAX_SIZE).alias(f"{m}_median") for m in ("item", "revenue", "complaint")]
    return tidy(i.base.select(*WINDOW_KEYS, *BASE_INTS, *BASE_DOUBLES, *medians))


def q_window_features(i: Inputs):
    return tidy(i.features)


def q_window_features_one(i: Inputs):
    """One window alone, to show that the joint build changes nothing."""
    specs = i.specs.filter((F.col("window_size") == W) & (F.col("window_end") == END_KEY))
    monthly = R.monthly_rollup(i.shipments, "2001-05-01", "2001-07-31", with_days=True)
    wide = X.window_features(monthly, i.complaints, specs, W)
    return tidy(wide)


def q_month_extremes(i: Inputs):
    return tidy(X.month_extremes(i.base, MAX_SIZE))


def q_pivot_months(i: Inputs):
    return tidy(X.pivot_months(i.base, MAX_SIZE))


def q_complaint_stats(i: Inputs):
    return tidy(X.complaint_stats(i.complaints, i.specs, MAX_SIZE))


def _feature_part(names: list[str]):
    return lambda i: tidy(i.features.select(*WINDOW_KEYS, *names))


PARTS = {
    "shipment_activity": ["active_days", "inactive_days", "recency"],
    "trend_slopes": ["item_slope", "revenue_slope", "satisfy_slope", "complaint_slope"],
    "window_ratios": (
        "avg_revenue_per_item avg_weight_per_item pct_delay pct_refund pct_noaccepted pct_lost_order pct_complaint "
        "pct_complaint_per_item pct_successful_item pct_intra_province pct_international avg_delayday "
        "inactive_months avg_noservice_days cv_item cv_revenue item_range revenue_range dominant_service_ratio"
    ).split(),
    "service_mix": ["service_types_used", "dominant_service", "dominant_service_ratio"],
    "rfm": ["recency", "frequency", "monetary"],
}


def q_trend_slopes_by_month_index(i: Inputs):
    base = X.window_base(i.monthly, i.specs, MAX_SIZE, slopes="month_index")
    return tidy(base.select(*WINDOW_KEYS, "item_slope", "revenue_slope", "satisfy_slope", "complaint_slope"))


def q_max_idle_run(i: Inputs):
    return tidy(X.max_idle_run(i.monthly, i.specs, MAX_SIZE))


def q_ewma(i: Inputs):
    rows = i.features.filter(F.col("window_size") == W)
    cols = [c for c in X.ewma(rows.limit(0), W, ALPHA).columns if "ewma" in c]
    return tidy(X.ewma(rows, W, ALPHA).select("cms_code_enc", "window_end", *cols))


def q_ewma_order_parity(i: Inputs):
    rows = X.ewma(i.features.filter(F.col("window_size") == W), W, ALPHA, ["item", "order"], order_parity=True)
    return tidy(rows.select("cms_code_enc", "window_end", "ewma_item", "delta_ewma_item", "ewma_order", "delta_ewma_order"))


def q_lifetime_activity(i: Inputs):
    return tidy(X.lifetime_activity(i.customer_month, HISTORY), **FINE)


def q_lifetime_shipments(i: Inputs):
    return tidy(X.lifetime_shipments(i.shipments, HISTORY))


def q_customer_lifetime(i: Inputs):
    return tidy(X.customer_lifetime(i.customer_month, i.info, i.shipments, HISTORY, T_OBS), 3)


def q_latest_per_key(i: Inputs):
    return tidy(X.latest_info(i.info))


def q_lifetime_asof(i: Inputs):
    return tidy(X.lifetime_asof(i.customer_month, HISTORY, FUTURE), **FINE)


def q_lifetime_asof_all(i: Inputs):
    return tidy(X.lifetime_asof_all(i.customer_month, i.specs, HISTORY), **FINE)


def q_month_plan(i: Inputs):
    bounds = i.shipments.agg(F.min("sending_time").cast("date").alias("start_date"), F.max("sending_time").cast("date").alias("end_date"))
    return tidy(P.month_plan(bounds, 3, 12))


def q_window_specs(i: Inputs):
    return tidy(i.specs)


def q_valid_training_ends(i: Inputs):
    return tidy(P.valid_training_ends(i.months, W, 2))


def _existing(i: Inputs):
    """Windows built so far: all ends before 2001-06, one of them empty."""
    rows = i.features.filter("window_end < '0106'").groupBy("window_size", "window_end").agg(F.count(F.lit(1)).alias("row_count"))
    return rows.withColumn("row_count", F.when((F.col("window_size") == 4) & (F.col("window_end") == "0001"), 0).otherwise(F.col("row_count")))


def q_refresh_plan(i: Inputs):
    return tidy(P.refresh_plan(_existing(i), i.specs, 2))


def q_refresh_counts(i: Inputs):
    return tidy(P.refresh_counts(P.refresh_plan(_existing(i), i.specs, 2)))


def q_chunked_refresh(i: Inputs):
    plan = P.refresh_plan(_existing(i), i.specs, 2).filter("action <> 'keep'")
    done = P.chunk_plan(i.specs, 2, 2).filter("month_group = 0 and size_group = 0")
    return tidy(P.chunk_plan(plan, 2, 2, done))


def q_refresh_run(i: Inputs):
    """All months in two refreshes, the second one two months later: per window what is stored, and the second plan."""
    shipments, root = scratch_path(i.spark, "shipments"), scratch_path(i.spark, "refreshed")
    T.write_month_partitions(i.shipments, shipments, "sending_time")
    stored = i.spark.read.parquet(shipments)
    first, early, last = i.shipments.agg(
        F.trunc(F.min("sending_time"), "MM").cast("string"), F.last_day(F.add_months(F.max("sending_time"), -2)).cast("string"), F.last_day(F.max("sending_time")).cast("string")
    ).first()
    RF.run_refresh(i.spark, root, stored, i.complaints, start=first, end=early, sizes=SIZES)
    plan = RF.run_refresh(i.spark, root, stored, i.complaints, start=first, end=last, sizes=SIZES)
    windows = T.read_windows(i.spark, f"{root}/windows").groupBy("window_size", "window_end").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("item_sum").alias("items"), F.sum("revenue_sum").alias("revenue"),
        F.sum("active_days").alias("days"), F.sum("complaint_diversity").alias("codes"),
    )
    asof = RF.read_asof(i.spark, root).groupBy(F.date_format("lifetime_asof_date", "yyMM").alias("window_end")).agg(
        F.count(F.lit(1)).alias("known"), F.sum("lifetime_total_items").alias("all_items"), F.sum("lifetime_months_active").alias("months_active")
    )
    return tidy(plan.join(windows, ["window_size", "window_end"], "left").join(asof, "window_end", "left"))


def q_observation_month(i: Inputs):
    return tidy(P.observation_month(i.shipments))


def q_scan_months(i: Inputs):
    """Monthly parts between two dates, read back as one table."""
    from parcelwise.sources.tables import scan_months

    keyed = i.shipments.withColumn("yymm", C.month_key(F.col("sending_time")))
    rows = scan_months(keyed, "1999-11-15", "2000-02-10")
    return tidy(rows.groupBy("yymm").agg(F.count(F.lit(1)).alias("n"), F.sum("total_fee").alias("fee")))


QUERIES = {
    "monthly_rollup": q_monthly_rollup,
    "monthly_sums": q_monthly_sums,
    "date_range": q_date_range,
    "window_base": q_window_base,
    "window_features": q_window_features,
    "window_features_one": q_window_features_one,
    "month_extremes": q_month_extremes,
    "pivot_months": q_pivot_months,
    "complaint_stats": q_complaint_stats,
    **{k: _feature_part(v) for k, v in PARTS.items()},
    "trend_slopes_by_month_index": q_trend_slopes_by_month_index,
    "max_idle_run": q_max_idle_run,
    "ewma": q_ewma,
    "ewma_order_parity": q_ewma_order_parity,
    "lifetime_activity": q_lifetime_activity,
    "lifetime_shipments": q_lifetime_shipments,
    "customer_lifetime": q_customer_lifetime,
    "latest_per_key": q_latest_per_key,
    "lifetime_asof": q_lifetime_asof,
    "lifetime_asof_all": q_lifetime_asof_all,
    "month_plan": q_month_plan,
    "window_specs": q_window_specs,
    "valid_training_ends": q_valid_training_ends,
    "refresh_plan": q_refresh_plan,
    "refresh_counts": q_refresh_counts,
    "refresh_run": q_refresh_run,
    "chunked_refresh": q_chunked_refresh,
    "observation_month": q_observation_month,
    "scan_months": q_scan_months,
}

# --------------------------------------------------------------------------

_MONTHLY_OUT = ", ".join([*MONTHLY_INTS, *[f"{r(c)} AS {c}" for c in MONTHLY_DOUBLES]])


def _slopes(x: str) -> str:
    pairs = {"item_slope": "item_count", "revenue_slope": "total_fee", "satisfy_slope": "satisfaction_score", "complaint_slope": "total_complaint"}
    return ", ".join(f"{r(f'coalesce(CASE WHEN count(*) > 1 THEN regr_slope({y}, {x}) END, 0)')} AS {n}" for n, y in pairs.items())


def _ewma_cols() -> str:
    cols = []
    for m in ("item", "revenue", "complaint", "delay", "nodone", "order", "satisfaction"):
        level, change = _ewma_sql("order_score" if m == "order" else m)
        cols += [f"{r(level)} AS ewma_{m}", f"{r(change)} AS delta_ewma_{m}"]
    level, change = _ewma_sql("item")
    cols += [f"{r(level)} AS ewma", f"{r(change)} AS delta_ewma"]
    return ", ".join(cols)


def lifetime_cols(weight: str = "sum(weight_kg)") -> dict[str, str]:
    items = "sum(item_count)"
    return {
        "lifetime_total_items": "sum(item_count)::BIGINT",
        "lifetime_total_revenue": "sum(total_fee)::BIGINT",
        "lifetime_total_weight": weight,
        "lifetime_total_complaint": "sum(total_complaint)::BIGINT",
        "lifetime_avg_revenue_per_item": S.ratio("sum(total_fee)", items),
        "lifetime_avg_weight_per_item": S.ratio("sum(weight_kg)", items),
        "lifetime_months_active": "count(DISTINCT report_month)",
        "lifetime_pct_delay": S.ratio("sum(delay_count)", items),
        "lifetime_pct_refund": S.ratio("sum(refunded)", items),
        "lifetime_pct_noaccepted": S.ratio("sum(noaccepted)", items),
        "lifetime_pct_lost_order": S.ratio("sum(lost_order)", items),
        "lifetime_pct_complaint": S.ratio("sum(total_complaint)", items),
        "lifetime_pct_successful_item": S.ratio("sum(item_count)::DOUBLE - sum(nodone)", items),
        "lifetime_avg_delayday": S.ratio("sum(CASE WHEN delay_count > 0 THEN delay_day ELSE 0 END)", "sum(CASE WHEN delay_count > 0 THEN 1 ELSE 0 END)"),
        "lifetime_avg_order_score": "coalesce(avg(order_score), 0)",
        "lifetime_avg_satisfaction": "coalesce(avg(satisfaction_score), 0)",
        "lifetime_pct_international": S.ratio("sum(international)", items),
        "lifetime_pct_intra_province": S.ratio("sum(CASE WHEN intra_province = 1 THEN 1 ELSE 0 END)", items),
    }


_LIFE_INT = {"lifetime_total_items", "lifetime_total_revenue", "lifetime_total_complaint", "lifetime_months_active"}
_LIFE_OUT = ", ".join(f"{e if n in _LIFE_INT else r(e, FINE.get(n, 6))} AS {n}" for n, e in lifetime_cols().items())
_SER = ", ".join(f"sum(coalesce(ser_{s}, 0))::BIGINT AS ser_{s}" for s in SERVICES)
def _mode(src: str) -> str:
    return f"(SELECT cms_code_enc, {src} AS v FROM s2 GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY cms_code_enc ORDER BY count(*) DESC, {src}) = 1)"


def _life_shipments() -> str:
    return f"""s2 AS (SELECT * FROM shipments WHERE sending_time >= TIMESTAMP '{HISTORY}'),
life_ship AS (
  SELECT b.cms_code_enc, b.lifetime_days_active, b.lifetime_pct_complaint_per_item,
         p.v::BIGINT AS most_common_rec_province, d.v::BIGINT AS most_common_rec_district,
         c.v::BIGINT AS most_common_rec_commune, g.v AS most_common_region
  FROM (SELECT cms_code_enc, count(DISTINCT sending_time::DATE) AS lifetime_days_active,
               {S.ratio("sum(CASE WHEN total_complaint > 0 THEN 1 ELSE 0 END)", "count(*)")} AS lifetime_pct_complaint_per_item
        FROM s2 GROUP BY 1) b
  JOIN {_mode('rec_province_code')} p USING (cms_code_enc) JOIN {_mode('rec_district_code')} d USING (cms_code_enc)
  JOIN {_mode('rec_commune_code')} c USING (cms_code_enc) JOIN {_mode('region')} g USING (cms_code_enc))"""


def _life_sql() -> str:
    sig = "coalesce(i.contract_sig_first, a.first_month)"
    three = lambda e, n: f"{r(f'round({e}, 9)', 3)} AS {n}"
    cols = lifetime_cols()
    inner = ", ".join(f"{e} AS {n}" for n, e in {**cols, "lifetime_months_active": "count(report_month)"}.items())
    outs = [three(f"a.{n}", n) if n not in _LIFE_INT else f"a.{n}" for n in cols]
    sers = [f"a.ser_{s}" for s in SERVICES]
    body = f""", {_life_shipments()},
act AS (SELECT cms_code_enc, min(report_month) AS first_month, {inner}, {_SER} FROM cm WHERE report_month >= DATE '{HISTORY}' GROUP BY 1)
SELECT a.cms_code_enc, a.cms_code_enc LIKE 'T%' AS is_corporate,
  coalesce(i.contract_classify, 1)::BIGINT AS contract_classify, coalesce(i.contract_service, 62)::BIGINT AS contract_service,
  coalesce(i.custype, 1)::BIGINT AS custype, strftime({sig}, '%Y-%m-%d') AS contract_sig_first,
  coalesce(i.tenure, {S.age_months(f"DATE '{T_OBS}'", sig)})::BIGINT AS tenure,
  i.contract_mgr_org::BIGINT AS contract_mgr_org, i.cus_poscode::BIGINT AS cus_poscode, i.cus_province::BIGINT AS cus_province,
  {', '.join(outs)},
  coalesce(b.lifetime_days_active, 0) AS lifetime_days_active,
  {three('coalesce(b.lifetime_pct_complaint_per_item, 0)', 'lifetime_pct_complaint_per_item')},
  {S.positive(sers)}::BIGINT AS lifetime_service_types_count, {S.dominant(sers, 'U', 'U')} AS lifetime_dominant_service,
  coalesce(b.most_common_rec_province, 0) AS most_common_rec_province, coalesce(b.most_common_rec_district, 0) AS most_common_rec_district,
  coalesce(b.most_common_rec_commune, 0) AS most_common_rec_commune, coalesce(b.most_common_region, 'N/A') AS most_common_region
FROM act a LEFT JOIN latest_info i ON i.cms_code_enc = a.cms_code_enc LEFT JOIN life_ship b ON b.cms_code_enc = a.cms_code_enc"""
    return with_ctes(body, "cm", "latest_info", "shipments")


_EXISTING = """existing AS (
  SELECT window_size, window_end, CASE WHEN window_size = 4 AND window_end = '0001' THEN 0 ELSE count(*) END AS row_count
  FROM rows_w WHERE window_end < '0106' GROUP BY window_size, window_end),
plan AS (
  SELECT s.window_size, s.window_start, s.window_end,
         CASE WHEN e.window_end IS NULL THEN 'new' WHEN e.redo THEN 'recompute' ELSE 'keep' END AS action
  FROM specs s LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY window_size ORDER BY window_end DESC) <= 2 OR row_count = 0 AS redo FROM existing) e
    ON e.window_size = s.window_size AND e.window_end = s.window_end)"""

_CHUNK = """
  SELECT m.g AS month_group, z.g AS size_group, count(*) AS windows,
         'months:' || any_value(m.lab) || '|sizes:' || any_value(z.lab) AS chunk_id
  FROM {src} p
  JOIN (SELECT window_end, g, '20' || substr(min(window_end) OVER (PARTITION BY g), 1, 2) || '-' || substr(min(window_end) OVER (PARTITION BY g), 3, 2)
          || '..20' || substr(max(window_end) OVER (PARTITION BY g), 1, 2) || '-' || substr(max(window_end) OVER (PARTITION BY g), 3, 2) AS lab
        FROM (SELECT window_end, ((row_number() OVER (ORDER BY window_end) - 1) // 2) AS g FROM (SELECT DISTINCT window_end FROM {src}))) m ON m.window_end = p.window_end
  JOIN (SELECT window_size, g, min(window_size) OVER (PARTITION BY g) || '..' || max(window_size) OVER (PARTITION BY g) AS lab
        FROM (SELECT window_size, ((row_number() OVER (ORDER BY window_size) - 1) // 2) AS g FROM (SELECT DISTINCT window_size FROM {src}))) z ON z.window_size = p.window_size
  GROUP BY m.g, z.g"""

ORACLE = {
    "monthly_rollup": with_ctes(f"SELECT cms_code_enc, strftime(report_month, '%Y-%m-%d') AS report_month, month_key, month_key_num, {_MONTHLY_OUT} FROM cm", "cm"),
    "monthly_sums": with_ctes(
        f"""SELECT cms_code_enc, month_key_num, sum(item_count)::BIGINT AS item_sum, sum(total_fee)::BIGINT AS revenue_sum,
  sum(total_complaint)::BIGINT AS complaint_sum, sum(delay_count)::BIGINT AS delay_sum, sum(nodone)::BIGINT AS nodone_sum,
  {r('avg(order_score)')} AS order_score_avg, {r('avg(satisfaction_score)')} AS satisfaction_avg,
  count(*) AS month_record_count, count(CASE WHEN total_complaint > 0 THEN 1 END) AS months_with_complaint
FROM cm GROUP BY cms_code_enc, month_key_num""", "cm"),
    "date_range": with_ctes(
        """SELECT 'midnight' AS kind, region, count(*) AS n, sum(total_fee)::BIGINT AS fee FROM shipments
WHERE sending_time >= TIMESTAMP '2000-01-01' AND sending_time <= TIMESTAMP '2000-06-30' GROUP BY region
UNION ALL SELECT 'whole_day', region, count(*), sum(total_fee)::BIGINT FROM shipments
WHERE sending_time >= TIMESTAMP '2000-01-01' AND sending_time < TIMESTAMP '2000-07-01' GROUP BY region""", "shipments"),
    "window_base": with_ctes(
        f"SELECT {KEYS3}, " + ", ".join(BASE_INTS) + ", " + ", ".join(f"{r(c)} AS {c}" for c in [*BASE_DOUBLES, "item_median", "revenue_median", "complaint_median"])
        + " FROM base", "base"),
    "window_features": with_ctes(f"SELECT {KEYS}, {feature_list()} FROM features", "features"),
    "window_features_one": with_ctes(
        f"SELECT {KEYS}, {feature_list([n for n in S.FEATURE_COLS if not any(n.endswith(f'_{k}m_ago') for k in (3, 4, 5))])} FROM features WHERE window_size = {W} AND window_end = '{END_KEY}'",
        "features"),
    "month_extremes": with_ctes(f"SELECT {KEYS3}, " + ", ".join(S.EXTREME_COLS) + " FROM base", "base"),
    "pivot_months": with_ctes(f"SELECT {KEYS3}, {feature_list(S.PIVOTS)} FROM base", "base"),
    "complaint_stats": with_ctes(f"SELECT {KEYS3}, complaint_diversity, most_common_complaint::BIGINT AS most_common_complaint FROM codes", "codes"),
    **{k: with_ctes(f"SELECT {KEYS3}, {feature_list(v)} FROM features", "features") for k, v in PARTS.items()},
    "trend_slopes_by_month_index": with_ctes(f"SELECT {KEYS3}, {_slopes('month_idx')} FROM rows_w GROUP BY cms_code_enc, window_size, window_end", "rows_w"),
    "max_idle_run": with_ctes(
        f"""SELECT {KEYS3}, max(gap)::BIGINT AS max_idle_run FROM (
  SELECT cms_code_enc, window_size, window_end, month_idx - coalesce(lag(month_idx) OVER w, end_idx - window_size) - 1 AS gap FROM rows_w
  WINDOW w AS (PARTITION BY cms_code_enc, window_size, window_end ORDER BY month_idx)
  UNION ALL SELECT cms_code_enc, window_size, window_end, min(off) FROM rows_w GROUP BY ALL)
GROUP BY cms_code_enc, window_size, window_end""", "rows_w"),
    "ewma": with_ctes(f"SELECT cms_code_enc, window_end, {_ewma_cols()} FROM features WHERE window_size = {W}", "features"),
    "ewma_order_parity": with_ctes(
        f"SELECT cms_code_enc, window_end, {r(_ewma_sql('item')[0])} AS ewma_item, {r(_ewma_sql('item')[1])} AS delta_ewma_item, 0.0::DOUBLE AS ewma_order, 0.0::DOUBLE AS delta_ewma_order FROM features WHERE window_size = {W}",
        "features"),
    "lifetime_activity": with_ctes(
        f"SELECT cms_code_enc, strftime(min(report_month), '%Y-%m-%d') AS first_month, {_LIFE_OUT}, {_SER} FROM cm WHERE report_month >= DATE '{HISTORY}' GROUP BY cms_code_enc", "cm"),
    "lifetime_shipments": with_ctes(
        f""", {_life_shipments()}
SELECT cms_code_enc, lifetime_days_active, {r('lifetime_pct_complaint_per_item')} AS lifetime_pct_complaint_per_item,
  most_common_rec_province, most_common_rec_district, most_common_rec_commune, most_common_region FROM life_ship""", "shipments"),
    "customer_lifetime": _life_sql(),
    "latest_per_key": with_ctes(
        """SELECT cms_code_enc, strftime(contract_sig_first, '%Y-%m-%d') AS contract_sig_first, coalesce(contract_classify, 1)::BIGINT AS contract_classify,
  coalesce(contract_service, 62)::BIGINT AS contract_service, coalesce(custype, 1)::BIGINT AS custype, tenure::BIGINT AS tenure,
  contract_mgr_org::BIGINT AS contract_mgr_org, cus_poscode::BIGINT AS cus_poscode, cus_province::BIGINT AS cus_province FROM latest_info""", "latest_info"),
    "lifetime_asof": with_ctes(
        f"SELECT cms_code_enc, '{FUTURE}' AS lifetime_asof_date, {_LIFE_OUT} FROM cm WHERE report_month >= DATE '{HISTORY}' AND report_month <= DATE '{FUTURE}' GROUP BY cms_code_enc", "cm"),
    "lifetime_asof_all": with_ctes(
        f"""SELECT cms_code_enc, strftime(end_date, '%Y-%m-%d') AS lifetime_asof_date, {_LIFE_OUT}
FROM cm JOIN (SELECT DISTINCT end_date FROM specs) e ON cm.report_month <= e.end_date
WHERE report_month >= DATE '{HISTORY}' GROUP BY cms_code_enc, end_date""", "cm", "specs"),
    "month_plan": with_ctes(
        """, b AS (SELECT date_trunc('month', min(sending_time)) AS lo, date_trunc('month', max(sending_time)) AS hi FROM shipments),
m AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS month FROM b)
SELECT 'month' AS kind, strftime(month, '%Y-%m-%d') AS month, NULL::BIGINT AS window_size FROM m
UNION ALL SELECT 'size', NULL, unnest(generate_series(3, least(12, greatest(1, (SELECT count(*) FROM m) - 2))))""", "shipments"),
    "window_specs": with_ctes("SELECT window_size::BIGINT AS window_size, strftime(start_date, '%Y-%m-%d') AS start_date, strftime(end_date, '%Y-%m-%d') AS end_date, window_start, window_end, end_idx::BIGINT AS end_idx FROM specs", "specs"),
    "valid_training_ends": with_ctes(f"SELECT month_no, strftime(month, '%Y-%m-%d') AS month FROM months WHERE month_no >= {W} AND month_no <= (SELECT max(month_no) FROM months) - 3", "months"),
    "refresh_plan": with_ctes(f", {_EXISTING} SELECT window_size::BIGINT AS window_size, window_start, window_end, action FROM plan", "specs", "rows_w"),
    "refresh_counts": with_ctes(
        f""", {_EXISTING} SELECT count(*) AS total_possible, count(*) FILTER (action <> 'keep') AS to_compute, count(*) FILTER (action = 'recompute') AS recomputed,
  count(*) FILTER (action = 'new') AS new_tables, count(*) FILTER (action = 'keep') AS kept_tables FROM plan""", "specs", "rows_w"),
    "refresh_run": with_ctes(
        f"""SELECT w.window_size::BIGINT AS window_size, w.window_start, w.window_end, CASE WHEN w.end_idx > b.high - 2 THEN 'new' WHEN w.end_idx > b.high - 4 THEN 'recompute' ELSE 'keep' END AS action,
  x.customers, x.items, x.revenue, x.days, coalesce(z.codes, 0) AS codes, a.known, a.all_items, a.months_active
FROM span w CROSS JOIN (SELECT max(end_idx) AS high FROM span) b
JOIN (SELECT window_size, window_end, count(DISTINCT cms_code_enc) AS customers, count(*) AS items, sum(total_fee)::BIGINT AS revenue, count(DISTINCT (cms_code_enc, sending_time::DATE)) AS days
  FROM span JOIN shipments s ON s.sending_time >= start_date AND s.sending_time <= end_date GROUP BY ALL) x ON x.window_size = w.window_size AND x.window_end = w.window_end
LEFT JOIN (SELECT window_size, window_end, count(*) AS codes FROM (SELECT DISTINCT window_size, window_end, c.cms_code_enc, complaint_code FROM span JOIN complaints c ON create_complaint_date >= start_date AND create_complaint_date <= end_date
    JOIN shipments s ON s.cms_code_enc = c.cms_code_enc AND s.sending_time >= start_date AND s.sending_time <= end_date) GROUP BY ALL) z ON z.window_size = w.window_size AND z.window_end = w.window_end
LEFT JOIN (SELECT window_end, count(DISTINCT cms_code_enc) AS known, sum(item_count)::BIGINT AS all_items, count(*) AS months_active FROM (SELECT DISTINCT window_end, end_date FROM span) e
  JOIN cm ON cm.report_month <= e.end_date GROUP BY ALL) a ON a.window_end = w.window_end""", "cm", "complaints", "span"),
    "chunked_refresh": with_ctes(
        f""", {_EXISTING}, todo AS (SELECT * FROM plan WHERE action <> 'keep'), done AS ({_CHUNK.format(src='specs')})
SELECT * FROM ({_CHUNK.format(src='todo')}) WHERE chunk_id NOT IN (SELECT chunk_id FROM done WHERE month_group = 0 AND size_group = 0)""", "specs", "rows_w"),
    "observation_month": with_ctes("SELECT strftime(date_trunc('month', max(sending_time)), '%Y-%m-%d') AS t_obs FROM shipments", "shipments"),
    "scan_months": with_ctes(
        """SELECT strftime(sending_time, '%y%m') AS yymm, count(*) AS n, sum(total_fee)::BIGINT AS fee FROM shipments
WHERE strftime(sending_time, '%y%m') IN ('9911', '9912', '0001', '0002') GROUP BY 1""", "shipments"),
}
