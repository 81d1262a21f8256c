"""Scalar functions over whole table columns, with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import Inputs, tidy
from catalog.sql import r, with_ctes
from parcelwise.functions import columns as C

col = F.col
# Loose spellings made from the order columns; the same rule is in the check SQL.
VARIANTS = 12


def loose_numbers(i: Inputs):
    """Each order with a number or truth word in one of many spellings."""
    k, p = col("o_orderkey"), F.round(col("o_totalprice"), 2)
    cents = F.round(p * 100).cast("bigint").cast("string")
    text = F.concat(F.substring(cents, 1, 4), F.lit("."), F.lit("25"))
    pick = k % VARIANTS
    raw = (
        F.when(pick == 0, F.concat(F.lit(" "), k.cast("string"), F.lit(" ")))
        .when(pick == 1, "t").when(pick == 2, "No").when(pick == 3, "N/A").when(pick == 4, "")
        .when(pick == 5, text).when(pick == 6, F.replace(text, F.lit("."), F.lit(",")))
        .when(pick == 7, F.concat(F.lit("-"), k.cast("string"), F.lit("kg")))
        .when(pick == 8, "1-2").when(pick == 9, "-").when(pick == 10, F.concat(text, F.lit(".5")))
        .otherwise("#N/A")
    )
    return i.table("orders").select("o_orderkey", raw.alias("raw"))


_LOOSE = f"""loose AS (SELECT o_orderkey, cents, CASE o_orderkey % {VARIANTS}
  WHEN 0 THEN ' ' || o_orderkey || ' ' WHEN 1 THEN 't' WHEN 2 THEN 'No' WHEN 3 THEN 'N/A' WHEN 4 THEN '' WHEN 5 THEN cents || '.25' WHEN 6 THEN cents || ',25'
  WHEN 7 THEN '-' || o_orderkey || 'kg' WHEN 8 THEN '1-2' WHEN 9 THEN '-' WHEN 10 THEN cents || '.25.5' ELSE '#N/A' END AS raw
  FROM (SELECT o_orderkey, substr(round(round(o_totalprice, 2) * 100)::BIGINT::VARCHAR, 1, 4) AS cents FROM orders))"""

DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy HH:mm:ss", "dd-MM-yyyy", "yy-MM-dd", "yy/MM/dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS"]


def loose_dates(i: Inputs):
    """Each order date in one of several layouts, some impossible."""
    k, d = col("o_orderkey"), col("o_orderdate")
    pick = k % (len(DATE_FORMATS) + 2)
    raw = F.when(pick == len(DATE_FORMATS), "2025-13-01").when(pick == len(DATE_FORMATS) + 1, "nan")
    for n, f in enumerate(DATE_FORMATS):
        raw = raw.when(pick == n, F.date_format(d, f))
    return i.table("orders").select("o_orderkey", "o_orderdate", raw.alias("raw"))


def q_clean_string(i: Inputs):
    return loose_numbers(i).select("o_orderkey", C.clean_string(col("raw")).alias("clean"))


def q_to_int(i: Inputs):
    return tidy(loose_numbers(i).select("o_orderkey", C.to_int(col("raw")).alias("value")))


def q_to_decimal(i: Inputs):
    return tidy(loose_numbers(i).select("o_orderkey", C.to_decimal(col("raw")).alias("value")))


def q_normalize_datetime(i: Inputs):
    return tidy(loose_dates(i).select("o_orderkey", C.normalize_datetime(col("raw")).alias("ts"), C.report_month(col("raw")).alias("day")))


def q_pseudonymize(i: Inputs):
    code = F.concat(F.lit(" c"), col("c_custkey").cast("string"), F.lit(" "))
    mapping = i.table("customer").select(C.pseudonymize(code, "salt").alias("hash"), F.upper(F.trim(code)).alias("code"))
    return mapping.distinct()


def q_clean_complaint_text(i: Inputs):
    """Whole texts; the long result is compared by its digest and length."""
    clean = C.clean_complaint_text(col("text"))
    return tidy(i.table("documents").select("doc_id", F.md5(clean.cast("binary")).alias("digest"), F.length(clean).alias("n")))


def q_month_functions(i: Inputs):
    d = F.to_date("l_shipdate")
    k = C.month_number(d)
    rows = i.table("lineitem").select(d.alias("d")).distinct()
    k = C.month_number(col("d"))
    return tidy(
        rows.select(
            "d", C.month_key(col("d")).alias("month_key"), k.alias("month_number"), C.yymm_diff(k, F.lit(2501)).alias("from_2501"),
            C.yymm_to_date(k).alias("as_date"), C.month_start(col("d")).alias("first_day"), C.month_end(col("d")).alias("last_day"),
        )
    )


def q_age_functions(i: Inputs):
    asof = F.lit("2001-10-31").cast("date")
    rows = i.table("orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return tidy(
        rows.select("d", C.tenure_months(asof, col("d")).alias("months"), C.tenure_months(col("d"), F.lit("1999-02-28").cast("date")).alias("months2"), C.days_between(asof, col("d")).alias("days"))
    )


def q_code_functions(i: Inputs):
    rows = i.shipments.groupBy("cms_code_enc").agg(
        *[F.sum(C.code_flag(F.lower("service_code"), s)).alias(f"n_{s.lower()}") for s in "CEMPRULQ"]
    )
    sums = [col(f"n_{s}") for s in "cemprulq"]
    return tidy(
        rows.select(
            "cms_code_enc", C.is_corporate(col("cms_code_enc")).alias("is_corporate"), C.dominant_label(sums).alias("dominant"),
            C.dominant_label([s - s for s in sums], zero="U", otherwise="U").alias("dominant_zero"),
            C.dominant_label([s - s for s in sums]).alias("dominant_zero_window"), C.count_positive(sums).alias("used"),
            C.safe_ratio(col("n_c"), col("n_e")).alias("ratio"),
        )
    )


def q_level_functions(i: Inputs):
    x = col("l_discount") * 10
    rows = i.table("lineitem").select((F.round(col("l_extendedprice")) % 101).alias("rate"), F.round(x / 4, 3).alias("x")).distinct()
    return tidy(
        rows.select(
            "rate", "x", C.rate_bucket(col("rate")).alias("bucket"), C.risk_level(col("rate")).alias("level"), C.severity(col("x")).alias("severity"),
            C.iv_strength(col("x")).alias("strength"), C.similarity(col("rate"), col("x") * 20).alias("similarity"),
            C.smooth_label(F.lit(1.0), col("x")).alias("smooth"), C.tier_label(col("rate") * 3).alias("tier"),
        )
    )


def q_json_payloads(i: Inputs):
    """Fields out of the JSON of each event, and back into a document."""
    made = F.to_json(F.struct("event_type", F.col("user_id").alias("user")))
    rows = i.table("events")
    return tidy(rows.select("event_id", made.alias("doc"), F.get_json_object(made, "$.user").cast("bigint").alias("user_back"), F.length("props").alias("n_props")))


def q_finite_double(i: Inputs):
    k = col("l_linenumber")
    raw = F.when(k == 1, "inf").when(k == 2, "NaN").when(k == 3, "x1").otherwise(col("l_quantity").cast("string"))
    raw = F.when(k == 1, "Infinity").otherwise(raw)
    v = C.finite_double(raw)
    return tidy(i.table("lineitem").groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.count(v).alias("finite"), F.sum(v).alias("total")))


QUERIES = {
    "clean_string": q_clean_string,
    "to_int": q_to_int,
    "to_decimal": q_to_decimal,
    "normalize_datetime": q_normalize_datetime,
    "pseudonymize": q_pseudonymize,
    "clean_complaint_text": q_clean_complaint_text,
    "month_functions": q_month_functions,
    "age_functions": q_age_functions,
    "code_functions": q_code_functions,
    "level_functions": q_level_functions,
    "json_payloads": q_json_payloads,
    "finite_double": q_finite_double,
}

_V = f"o_orderkey % {VARIANTS}"
_STRF = {"yyyy": "%Y", "yy": "%y", "MM": "%m", "dd": "%d", "HH": "%H", "mm": "%M", "ss": "%S", "SSSSSS": "%f"}
_N = len(DATE_FORMATS)
_AGE2 = "(12 * (year(d) - 1999) + month(d) - 2 - CASE WHEN d >= DATE '1999-02-28' AND day(d) < 28 THEN 1 ELSE 0 END + CASE WHEN d < DATE '1999-02-28' AND day(d) > 28 THEN 1 ELSE 0 END)"
_AGE = "(12 * (2001 - year(d)) + 10 - month(d) - CASE WHEN DATE '2001-10-31' >= d AND 31 < day(d) THEN 1 ELSE 0 END + CASE WHEN DATE '2001-10-31' < d AND 31 > day(d) THEN 1 ELSE 0 END)"
_COUNTS = ", ".join(f"count(*) FILTER (service_code = '{s}') AS n_{s.lower()}" for s in "CEMPRULQ")
_TOP = "greatest(" + ", ".join(f"n_{s}" for s in "cemprulq") + ")"

ORACLE = {
    "clean_string": f"WITH {_LOOSE} SELECT o_orderkey, CASE WHEN {_V} IN (3, 4, 11) THEN NULL ELSE trim(raw) END AS clean FROM loose",
    "to_int": f"""WITH {_LOOSE} SELECT o_orderkey, CASE {_V} WHEN 0 THEN o_orderkey WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 5 THEN (cents || '25')::BIGINT WHEN 6 THEN (cents || '25')::BIGINT
  WHEN 7 THEN -o_orderkey WHEN 10 THEN (cents || '255')::BIGINT END AS value FROM loose""",
    "to_decimal": f"""WITH {_LOOSE} SELECT o_orderkey, CASE {_V} WHEN 0 THEN o_orderkey::DOUBLE WHEN 5 THEN cents::DOUBLE + 0.25 WHEN 6 THEN cents::DOUBLE + 0.25 WHEN 7 THEN -o_orderkey::DOUBLE END AS value FROM loose""",
    "normalize_datetime": f"""SELECT o_orderkey, CASE WHEN o_orderkey % {_N + 2} < {_N} THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS ts,
  CASE WHEN o_orderkey % {_N + 2} < {_N} THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
    "pseudonymize": "SELECT DISTINCT 'C' || c_custkey AS code, 'ENC_' || upper(substr(md5('C' || c_custkey || 'salt'), 1, 16)) AS hash FROM customer",
    "clean_complaint_text": r"""SELECT doc_id, md5(t) AS digest, length(t) AS n FROM (SELECT doc_id, nullif(trim(regexp_replace(regexp_replace(text, '[0-9]{8}|\\n|\\r\\n|\\r|[\r\n\x{2028}\x{2029}]|\\\\', ' ', 'g'), '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')), '') AS t FROM documents)""",
    "month_functions": """SELECT strftime(d, '%Y-%m-%d') AS d, strftime(d, '%y%m') AS month_key, strftime(d, '%y%m')::BIGINT AS month_number,
  ((year(d) % 100) * 12 + month(d)) - (25 * 12 + 1) AS from_2501, ((2000 + year(d) % 100)::VARCHAR || strftime(d, '-%m-01')) AS as_date,
  strftime(date_trunc('month', d), '%Y-%m-%d') AS first_day, strftime(last_day(d), '%Y-%m-%d') AS last_day FROM (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem)""",
    "age_functions": f"SELECT strftime(d, '%Y-%m-%d') AS d, {_AGE} AS months, {_AGE2} AS months2, DATE '2001-10-31' - d AS days FROM (SELECT DISTINCT o_orderdate::DATE AS d FROM orders)",
    "code_functions": with_ctes(
        f""", n AS (SELECT cms_code_enc, {_COUNTS} FROM shipments GROUP BY 1)
SELECT cms_code_enc, left(cms_code_enc, 1) = 'T' AS is_corporate, CASE {' '.join(f"WHEN n_{s} = {_TOP} THEN '{s.upper()}'" for s in 'cemprulq')} END AS dominant, 'U' AS dominant_zero, 'C' AS dominant_zero_window,
  {' + '.join(f'(n_{s} > 0)::INT' for s in 'cemprulq')} AS used, {r('coalesce(n_c::DOUBLE / nullif(n_e, 0), 0)')} AS ratio FROM n""", "shipments"),
    "level_functions": f"""SELECT rate, x, CASE WHEN rate >= 90 THEN '90-100%' WHEN rate >= 80 THEN '80-90%' WHEN rate >= 70 THEN '70-80%' ELSE '<70%' END AS bucket,
  CASE WHEN rate >= 90 THEN 'Critical' WHEN rate >= 80 THEN 'High' WHEN rate >= 70 THEN 'Medium' ELSE 'Low' END AS level, CASE WHEN x > 0.2 THEN 'ALERT' WHEN x > 0.1 THEN 'WARN' ELSE 'OK' END AS severity,
  CASE WHEN x < 0.02 THEN 'useless' WHEN x < 0.1 THEN 'weak' WHEN x < 0.3 THEN 'medium' WHEN x < 0.5 THEN 'strong' ELSE 'suspicious' END AS strength,
  {r('exp(greatest(least(-greatest(rate, 0) / (2 * greatest(x * 20, 1e-9)), 0), -700))')} AS similarity, {r('(1 - x) + x * 0.5')} AS smooth,
  CASE WHEN rate * 3 <= 90 THEN 'active' WHEN rate * 3 <= 180 THEN 'at_risk' ELSE 'churned' END AS tier
FROM (SELECT DISTINCT round(l_extendedprice) % 101 AS rate, round(l_discount * 10 / 4, 3) AS x FROM lineitem)""",
    "json_payloads": """SELECT event_id, '{"event_type":"' || event_type || '","user":' || user_id || '}' AS doc, user_id AS user_back, length(props) AS n_props FROM events""",
    "finite_double": "SELECT l_linenumber, count(*) AS n, count(*) FILTER (l_linenumber > 3) AS finite, round(sum(CASE WHEN l_linenumber > 3 THEN l_quantity END), 6) AS total FROM lineitem GROUP BY 1",
}
