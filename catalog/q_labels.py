"""Scope, label, weight, split and scaling queries with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sql as S
from catalog.inputs import ALPHA, END_MONTH, HISTORY, HORIZON, SEED, T_OBS, W, Inputs, tidy
from catalog.q_features import _LIFE_OUT, FINE, _ewma_sql
from catalog.sql import r, with_ctes
from parcelwise.operators import features as X
from parcelwise.operators import labels as L
from parcelwise.plans import windows as P
from parcelwise.schemas import CUSTOMER

SCALED = ["item_sum", "item_avg", "pct_delay", "recency", "frequency", "max_consecutive_inactive"]


def remember(fn):
    """Compute a shared small frame once per data directory."""

    def run(i: Inputs):
        if fn.__name__ not in i.memo:
            i.memo[fn.__name__] = fn(i)
        return i.memo[fn.__name__]

    return run


@remember
def active_labelled(i: Inputs):
    """Active customers with smoothed signals, a made similarity, labels and weights."""
    rows = X.ewma(i.current, W, ALPHA, ["item"])
    active = L.active_only(rows, i.working)
    key = F.substring(CUSTOMER, 2, 8).cast("bigint")
    scored = active.withColumn("sim_score", ((key * 31) % 100) / 100.0)
    train, hold = confirmed_split(i)
    labelled = L.pseudo_labels(scored, train, hold)
    return L.weights_and_smoothing(labelled, 0.05).persist()


@remember
def confirmed_split(i: Inputs):
    known = L.restrict_to_ids(i.confirmed, i.working)
    split = L.split_confirmed(known, 0.2, SEED).persist()
    return split.filter(~F.col("is_holdout")), split.filter("is_holdout")


def q_working_set(i: Inputs):
    life = X.lifetime_activity(i.customer_month, HISTORY)
    return tidy(L.working_set(life, 40), **FINE)


def q_working_set_asof(i: Inputs):
    return tidy(L.working_set_asof(i.customer_month, i.info, HISTORY, T_OBS, 3))


def q_scope_counts(i: Inputs):
    return tidy(L.scope_counts(i.confirmed, i.working))


def q_confirmed_inside(i: Inputs):
    return L.restrict_to_ids(i.confirmed, i.working)


def q_confirmed_outside(i: Inputs):
    active = i.working.filter("tier = 'active'")
    return L.restrict_to_ids(i.confirmed, active, inside=False)


def q_set_operations(i: Inputs):
    """Intersection, difference and subset test of two id sets."""
    a, b = i.confirmed.select(CUSTOMER), i.current.select(CUSTOMER)
    both = a.intersect(b).withColumn("part", F.lit("both"))
    only = a.subtract(b).withColumn("part", F.lit("only_confirmed"))
    parts = both.unionByName(only)
    return tidy(parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min(CUSTOMER).alias("first_id"), F.max(CUSTOMER).alias("last_id")))


def q_distinct_ids(i: Inputs):
    return i.info.select(CUSTOMER).distinct()


def q_drop_low_volume(i: Inputs):
    return tidy(L.drop_low_volume(i.features, 5).select(CUSTOMER, "window_size", "window_end", "item_sum"))


def q_recency(i: Inputs):
    return tidy(L.recency(i.customer_month, T_OBS, HISTORY))


def q_recency_attach(i: Inputs):
    everyone = i.table("customer").select(F.concat(F.when(F.col("c_custkey") % 5 == 0, "T").otherwise("C"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias(CUSTOMER))
    attached = L.attach_recency(everyone, i.customer_month, "2000-06-01", "2000-01-01")
    return tidy(attached.select(CUSTOMER, "recency_days"))


def q_assign_tiers(i: Inputs):
    return tidy(i.working.select(CUSTOMER, "recency_days", "tier"))


def q_tier_counts(i: Inputs):
    return tidy(L.value_counts(i.working, "tier"))


def q_active_only(i: Inputs):
    return tidy(L.active_only(i.current, i.working).select(CUSTOMER, "item_sum", "tier", "recency_days"))


def q_horizon_activity(i: Inputs):
    return tidy(L.horizon_activity(i.customer_month, END_MONTH, HORIZON))


def q_build_label(i: Inputs):
    return tidy(i.current.select(CUSTOMER, "item_sum", "item_in_horizon", "rev_in_horizon", "y_raw"))


def q_training_windows(i: Inputs):
    ends = P.valid_training_ends(i.months, W, HORIZON)
    rows = L.training_windows(i.features, i.customer_month, ends, W, HORIZON, ALPHA, 1)
    return tidy(rows.select(CUSTOMER, "window_end", "_end_month", "_W", "item_sum", "ewma_item", "delta_ewma_item", "item_in_horizon", "rev_in_horizon", "y_raw"))


def q_split_confirmed(i: Inputs):
    return L.split_confirmed(i.confirmed, 0.2, SEED)


def q_pu_weight(i: Inputs):
    return tidy(L.pu_weight(i.confirmed, i.working))


def q_pseudo_labels(i: Inputs):
    cols = [CUSTOMER, "recency_days", "item_last", "item_avg", "delta_ewma", "sim_score", "label_source"]
    return tidy(active_labelled(i).select(*cols))


def q_label_counts(i: Inputs):
    return tidy(L.value_counts(active_labelled(i), "label_source"))


def q_weights_and_smoothing(i: Inputs):
    return tidy(active_labelled(i).select(CUSTOMER, "label_source", "y_label", "sample_weight", "y_smooth"))


def q_sample_eval(i: Inputs):
    return L.sample_eval(i.current.withColumn("y_label", F.col("y_raw").cast("double")), 0.2, SEED).select(CUSTOMER, "y_raw")


@remember
def _split(i: Inputs):
    return L.split_active(active_labelled(i), confirmed_split(i)[1], 0.2, SEED).persist()


def q_dataset_split(i: Inputs):
    return tidy(_split(i).select(CUSTOMER, "label_source", "_dataset_split"))


def q_feature_projection(i: Inputs):
    names = ["item_sum", "known_delay", "known_ratio", "not_there"]
    return tidy(L.feature_projection(i.eda, names, [CUSTOMER, "window_end"]))


def q_union_history(i: Inputs):
    history = i.features.filter("window_size = 3 and window_end < '0001'").withColumn("y_raw", (F.col("item_sum") < 3).cast("int"))
    rows = L.training_rows(_split(i), history, ["item_sum", "pct_delay"])
    return tidy(rows)


def q_fit_scaler(i: Inputs):
    return tidy(L.scaler_stats(i.features.filter("window_size = 3"), SCALED))


def q_apply_scaler(i: Inputs):
    rows = i.features.filter("window_size = 3")
    scaler = L.fit_scaler(rows, SCALED)
    return tidy(L.apply_scaler(rows.select(CUSTOMER, "window_end", *SCALED), scaler))


def q_sanity_report(i: Inputs):
    ds = L.final_dataset(active_labelled(i), None, confirmed_split(i)[1], SCALED)
    return tidy(L.sanity_report(ds, confirmed_split(i)[1]))


QUERIES = {
    "working_set": q_working_set,
    "working_set_asof": q_working_set_asof,
    "scope_counts": q_scope_counts,
    "restrict_to_ids": q_confirmed_inside,
    "restrict_to_ids_outside": q_confirmed_outside,
    "set_operations": q_set_operations,
    "distinct_ids": q_distinct_ids,
    "drop_low_volume": q_drop_low_volume,
    "recency": q_recency,
    "recency_attach": q_recency_attach,
    "assign_tiers": q_assign_tiers,
    "tier_counts": q_tier_counts,
    "active_only": q_active_only,
    "horizon_activity": q_horizon_activity,
    "build_label": q_build_label,
    "training_windows": q_training_windows,
    "split_confirmed": q_split_confirmed,
    "pu_weight": q_pu_weight,
    "pseudo_labels": q_pseudo_labels,
    "label_counts": q_label_counts,
    "weights_and_smoothing": q_weights_and_smoothing,
    "sample_eval": q_sample_eval,
    "dataset_split": q_dataset_split,
    "feature_projection": q_feature_projection,
    "union_history": q_union_history,
    "fit_scaler": q_fit_scaler,
    "apply_scaler": q_apply_scaler,
    "sanity_report": q_sanity_report,
}

# --------------------------------------------------------------------------

_LEVEL, _CHANGE = _ewma_sql("item")
_HASH = "md5(cms_code_enc || ':' || '42')"

# One chain of blocks: confirmed split, labelled active rows, dataset split.
CHAIN = f"""
known AS (SELECT DISTINCT cms_code_enc FROM confirmed WHERE cms_code_enc IN (SELECT cms_code_enc FROM tiers)),
csplit AS (SELECT cms_code_enc, row_number() OVER (ORDER BY {_HASH}, cms_code_enc) <=
             CASE WHEN count(*) OVER () > 1 THEN least(greatest(1, round_even(count(*) OVER () * 0.2, 0)::BIGINT), count(*) OVER () - 1) ELSE 0 END AS is_holdout FROM known),
active AS (SELECT c.*, t.tier, t.recency_days, {_LEVEL} AS ewma, {_CHANGE} AS delta_ewma,
             ((substr(c.cms_code_enc, 2, 8)::BIGINT * 31) % 100) / 100.0::DOUBLE AS sim_score
           FROM current c JOIN tiers t ON t.cms_code_enc = c.cms_code_enc WHERE t.tier = 'active'),
lab AS (SELECT a.*, CASE WHEN s.is_holdout THEN 'confirmed_eval' WHEN s.is_holdout IS NOT NULL THEN 'confirmed'
             WHEN a.recency_days <= 30 AND delta_ewma >= 0 THEN 'reliable_neg'
             WHEN sim_score > 0.8 AND delta_ewma < 0 AND item_avg > 0 AND item_last < item_avg * 0.85 THEN 'pseudo_churn'
             ELSE 'pu_unlabeled' END AS label_source
        FROM active a LEFT JOIN csplit s ON s.cms_code_enc = a.cms_code_enc),
wt AS (SELECT *, CASE WHEN label_source IN ('confirmed', 'confirmed_eval', 'pseudo_churn') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y_label,
         CASE label_source WHEN 'confirmed' THEN 1.0::DOUBLE WHEN 'confirmed_eval' THEN 0.0::DOUBLE WHEN 'pseudo_churn' THEN 0.5::DOUBLE
           WHEN 'reliable_neg' THEN 0.8::DOUBLE ELSE 0.05::DOUBLE END AS sample_weight,
         CASE WHEN label_source LIKE 'confirmed%' THEN 0.0::DOUBLE ELSE 0.1::DOUBLE END AS eps FROM lab),
sm AS (SELECT *, (1 - eps) * y_label + eps * 0.5 AS y_smooth FROM wt),
cls AS (SELECT y_label, count(*) AS n FROM sm WHERE label_source <> 'confirmed_eval' GROUP BY 1),
pool AS (SELECT *, CASE WHEN (SELECT count(*) > 1 AND min(n) >= 2 FROM cls) THEN y_label ELSE -1 END AS stratum
         FROM sm WHERE label_source <> 'confirmed_eval'),
picked AS (SELECT cms_code_enc FROM pool QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY {_HASH}, cms_code_enc)
           <= CASE WHEN count(*) OVER (PARTITION BY stratum) >= 2 THEN ceil(count(*) OVER (PARTITION BY stratum) * 0.2) ELSE 0 END),
split AS (SELECT *, CASE WHEN label_source = 'confirmed_eval' OR cms_code_enc IN (SELECT cms_code_enc FROM picked) THEN 'eval' ELSE 'train' END AS _dataset_split FROM sm)
"""


def chain(body: str) -> str:
    return with_ctes(f", {CHAIN} {body}", "current", "tiers", "confirmed")


_SIG = "coalesce(sig, first_month)"
_SCALER = "(SELECT " + ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in SCALED) + " FROM features WHERE window_size = 3)"

ORACLE = {
    "working_set": with_ctes(
        f"""SELECT * FROM (SELECT cms_code_enc, strftime(min(report_month), '%Y-%m-%d') AS first_month, {_LIFE_OUT},
  {", ".join(f"sum(ser_{s})::BIGINT AS ser_{s}" for s in S.SERVICES)} FROM cm WHERE report_month >= DATE '{HISTORY}' GROUP BY cms_code_enc) WHERE lifetime_total_items >= 40""", "cm"),
    "working_set_asof": with_ctes(
        f"""SELECT cms_code_enc, cms_code_enc LIKE 'T%' AS is_corporate,
  CASE WHEN cus_poscode IS NOT NULL THEN coalesce(contract_classify, 1) END::BIGINT AS contract_classify,
  CASE WHEN cus_poscode IS NOT NULL THEN coalesce(contract_service, 62) END::BIGINT AS contract_service,
  CASE WHEN cus_poscode IS NOT NULL THEN coalesce(custype, 1) END::BIGINT AS custype,
  strftime({_SIG}, '%Y-%m-%d') AS contract_sig_first,
  coalesce(raw_tenure, {S.age_months(f"DATE '{T_OBS}'", _SIG)})::BIGINT AS tenure, contract_mgr_org::BIGINT AS contract_mgr_org,
  cus_poscode::BIGINT AS cus_poscode, cus_province::BIGINT AS cus_province, lifetime_total_items, lifetime_total_revenue,
  {r('lifetime_total_weight')} AS lifetime_total_weight, lifetime_total_complaint, lifetime_months_active FROM working""", "working"),
    "scope_counts": with_ctes(
        """SELECT count(*) AS total_ids, count(*) FILTER (inside) AS inside_scope, count(*) FILTER (NOT inside) AS outside_scope
FROM (SELECT DISTINCT cms_code_enc, cms_code_enc IN (SELECT cms_code_enc FROM tiers) AS inside FROM confirmed)""", "tiers", "confirmed"),
    "restrict_to_ids": with_ctes("SELECT DISTINCT cms_code_enc FROM confirmed WHERE cms_code_enc IN (SELECT cms_code_enc FROM tiers)", "tiers", "confirmed"),
    "restrict_to_ids_outside": with_ctes("SELECT DISTINCT cms_code_enc FROM confirmed WHERE cms_code_enc NOT IN (SELECT cms_code_enc FROM tiers WHERE tier = 'active')", "tiers", "confirmed"),
    "set_operations": with_ctes(
        """SELECT part, count(*) AS n, min(cms_code_enc) AS first_id, max(cms_code_enc) AS last_id FROM (
  SELECT DISTINCT cms_code_enc, CASE WHEN cms_code_enc IN (SELECT cms_code_enc FROM current) THEN 'both' ELSE 'only_confirmed' END AS part FROM confirmed) GROUP BY part""",
        "current", "confirmed"),
    "distinct_ids": with_ctes("SELECT DISTINCT cms_code_enc FROM info", "info"),
    "drop_low_volume": with_ctes("SELECT cms_code_enc, window_size::BIGINT AS window_size, window_end, item_sum FROM features WHERE item_sum >= 5", "features"),
    "recency": with_ctes("SELECT cms_code_enc, strftime(last_active_month, '%Y-%m-%d') AS last_active_month, recency_days::BIGINT AS recency_days FROM recency_t", "recency_t"),
    "recency_attach": with_ctes(
        f"""SELECT c.code AS cms_code_enc, coalesce(DATE '2000-06-01' - m.last, 9999)::BIGINT AS recency_days
FROM (SELECT {S.CODE.format(k='c_custkey')} AS code FROM customer) c
LEFT JOIN (SELECT cms_code_enc, max(report_month) AS last FROM cm WHERE report_month BETWEEN DATE '2000-01-01' AND DATE '2000-06-01' GROUP BY 1) m ON m.cms_code_enc = c.code""", "cm"),
    "assign_tiers": with_ctes("SELECT cms_code_enc, recency_days::BIGINT AS recency_days, tier FROM tiers", "tiers"),
    "tier_counts": with_ctes("SELECT tier, count(*) AS n FROM tiers GROUP BY tier", "tiers"),
    "active_only": with_ctes("SELECT c.cms_code_enc, c.item_sum, t.tier, t.recency_days::BIGINT AS recency_days FROM current c JOIN tiers t ON t.cms_code_enc = c.cms_code_enc WHERE t.tier = 'active'", "current", "tiers"),
    "horizon_activity": with_ctes("SELECT * FROM horizon", "horizon"),
    "build_label": with_ctes("SELECT cms_code_enc, item_sum, item_in_horizon, rev_in_horizon, y_raw::BIGINT AS y_raw FROM current", "current"),
    "training_windows": with_ctes(
        f""", ends AS (SELECT month FROM months WHERE month_no >= {W} AND month_no <= (SELECT max(month_no) FROM months) - 3),
h AS (SELECT cm.cms_code_enc, e.month, sum(item_count)::BIGINT AS items, sum(total_fee)::BIGINT AS rev FROM cm JOIN ends e
      ON cm.report_month > e.month AND cm.report_month <= e.month + INTERVAL {HORIZON} MONTH WHERE item_count > 0 OR total_fee > 0 GROUP BY 1, 2)
SELECT f.cms_code_enc, f.window_end, strftime(e.month, '%Y-%m-%d') AS _end_month, 3::BIGINT AS _W, f.item_sum, {r(_LEVEL)} AS ewma_item, {r(_CHANGE)} AS delta_ewma_item,
  coalesce(h.items, 0) AS item_in_horizon, coalesce(h.rev, 0) AS rev_in_horizon,
  CASE WHEN coalesce(h.items, 0) = 0 AND coalesce(h.rev, 0) = 0 THEN 1 ELSE 0 END::BIGINT AS y_raw
FROM features f JOIN ends e ON strftime(e.month, '%y%m') = f.window_end LEFT JOIN h ON h.cms_code_enc = f.cms_code_enc AND h.month = e.month
WHERE f.window_size = {W} AND f.item_sum >= 1""", "features", "months", "cm"),
    "split_confirmed": with_ctes(
        f"""SELECT cms_code_enc, row_number() OVER (ORDER BY {_HASH}, cms_code_enc) <=
  CASE WHEN count(*) OVER () > 1 THEN least(greatest(1, round_even(count(*) OVER () * 0.2, 0)::BIGINT), count(*) OVER () - 1) ELSE 0 END AS is_holdout
FROM (SELECT DISTINCT cms_code_enc FROM confirmed)""", "confirmed"),
    "pu_weight": with_ctes(
        f"""SELECT n_confirmed, n_active, {r('CASE WHEN n_confirmed > 0 THEN greatest(n_confirmed / greatest(n_active - n_confirmed, 1), 0.01) ELSE 0.05 END')} AS pu_weight
FROM (SELECT (SELECT count(DISTINCT cms_code_enc) FROM confirmed) AS n_confirmed, (SELECT count(*) FROM tiers WHERE tier = 'active') AS n_active)""", "confirmed", "tiers"),
    "pseudo_labels": chain(f"SELECT cms_code_enc, recency_days::BIGINT AS recency_days, item_last, {r('item_avg')} AS item_avg, {r('delta_ewma')} AS delta_ewma, {r('sim_score')} AS sim_score, label_source FROM lab"),
    "label_counts": chain("SELECT label_source, count(*) AS n FROM lab GROUP BY 1"),
    "weights_and_smoothing": chain(f"SELECT cms_code_enc, label_source, y_label, {r('sample_weight')} AS sample_weight, {r('y_smooth')} AS y_smooth FROM sm"),
    "sample_eval": with_ctes(
        f"""SELECT cms_code_enc, y_raw FROM current
QUALIFY row_number() OVER (PARTITION BY CASE WHEN (SELECT count(*) > 1 AND min(n) >= 2 FROM (SELECT y_raw, count(*) AS n FROM current GROUP BY 1)) THEN y_raw ELSE -1 END ORDER BY {_HASH}, cms_code_enc)
  <= ceil(count(*) OVER (PARTITION BY CASE WHEN (SELECT count(*) > 1 AND min(n) >= 2 FROM (SELECT y_raw, count(*) AS n FROM current GROUP BY 1)) THEN y_raw ELSE -1 END) * 0.2)""", "current"),
    "dataset_split": chain("SELECT cms_code_enc, label_source, _dataset_split FROM split"),
    "feature_projection": with_ctes("SELECT cms_code_enc, window_end, item_sum::DOUBLE AS item_sum, round(coalesce(known_delay, 0), 6) + 0.0 AS known_delay, round(coalesce(known_ratio, 0), 6) + 0.0 AS known_ratio, 0.0::DOUBLE AS not_there FROM eda", "eda"),
    "union_history": chain(
        f"""SELECT cms_code_enc, {r('y_smooth')} AS y, {r('sample_weight')} AS w, item_sum::DOUBLE AS item_sum, {r('pct_delay')} AS pct_delay FROM split WHERE _dataset_split = 'train'
UNION ALL SELECT cms_code_enc, (item_sum < 3)::INT::DOUBLE, 1.0::DOUBLE, item_sum::DOUBLE, {r('pct_delay')} FROM features WHERE window_size = 3 AND window_end < '0001'"""),
    "fit_scaler": with_ctes(
        " UNION ALL ".join(f"SELECT '{c}' AS feature, {r(f'avg({c})')} AS mean, {r(f'CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END')} AS scale FROM features WHERE window_size = 3" for c in SCALED), "features"),
    "apply_scaler": with_ctes(
        "SELECT cms_code_enc, window_end, " + ", ".join(f"{r(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in SCALED) + f" FROM features, {_SCALER} WHERE window_size = 3", "features"),
    "sanity_report": chain(
        f"""SELECT * FROM (VALUES
  (1::BIGINT, 'split_overlap', 0.0::DOUBLE, true, true),
  (3, 'null_weights', (SELECT count(*) FROM split WHERE _dataset_split = 'train' AND sample_weight IS NULL)::DOUBLE, true, true),
  (4, 'null_features', 0.0::DOUBLE, true, true), (5, 'scaler_fitted', {len(SCALED)}::DOUBLE, true, true),
  (6, 'holdout_misplaced', (SELECT count(*) FROM csplit c WHERE is_holdout AND c.cms_code_enc NOT IN (SELECT cms_code_enc FROM split WHERE _dataset_split = 'eval'))::DOUBLE,
     (SELECT count(*) FROM csplit c WHERE is_holdout AND c.cms_code_enc NOT IN (SELECT cms_code_enc FROM split WHERE _dataset_split = 'eval')) = 0, true),
  (7, 'leaky_names', 0.0::DOUBLE, true, true)) v(check_no, "check", value, passed, critical)
UNION ALL SELECT 2, 'train_positive_share', {r('avg((y_smooth > 0.5)::INT)')}, avg((y_smooth > 0.5)::INT) BETWEEN 0.03 AND 0.35, false FROM split WHERE _dataset_split = 'train'"""),
}
