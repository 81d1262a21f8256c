"""Ingestion queries over file names, lines and rows made from the tables, with check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import Inputs, tidy
from catalog.sql import r, with_ctes
from parcelwise.functions.lineage import scratch_path
from parcelwise.schemas import HEADERS
from parcelwise.plans import ingest as IN
from parcelwise.sources import adapters as A
from parcelwise.sources import landing as L
from parcelwise.sources import tables as T

col = F.col


def q_typed_shipments(i: Inputs):
    """All shipments written as loose text, then typed again."""
    s = i.shipments
    text = {
        "crm_code_enc": F.lit("N/A"), "cms_code_enc": F.concat(F.lit(" "), "cms_code_enc"), "item_code_enc": col("item_code"),
        "service_code": col("service_code"), "weight_kg": F.replace(F.format_string("%.3f", col("weight_kg").cast("double")), F.lit("."), F.lit(",")),
        "total_fee": F.concat(col("total_fee").cast("string"), F.lit(" VND")), "is_domestic": F.when(col("is_domestic") == 1, "t").otherwise("f"),
        "region": col("region"), "sending_time": F.date_format("sending_time", "dd/MM/yyyy HH:mm:ss"), "done": F.when(col("done") == 1, "Yes").otherwise("No"),
        "delay_day": col("delay_day").cast("string"), "order_score": F.coalesce(col("order_score").cast("string"), F.lit("NULL")),
    }
    raw = s.select(*[text.get(h, F.lit("")).alias(f"c{n}") for n, h in enumerate(HEADERS["bccp_orderitem"])])
    typed = L.typed_shipments(L.apply_header_contract(raw, "bccp_orderitem"))
    cols = ["crm_code_enc", "cms_code_enc", "item_code", "service_code", "region", "weight_kg", "total_fee", "is_domestic", "done", "delay_day", "order_score", "sending_time", "ending_time", "length_size", "complaint114"]
    return tidy(typed.select(*cols))


def q_typed_customer_month(i: Inputs):
    c = i.customer_month
    text = {"cms_code_enc": col("cms_code_enc"), "report_month": F.date_format("report_month", "yyyy/MM/dd"), "updated_at": F.date_format("report_month", "dd-MM-yyyy")}
    numbers = {h: col(h).cast("string") for h in ("item_count", "total_fee", "ser_c", "ser_q", "nodone")}
    raw = c.select(*[{**text, **numbers}.get(h, F.lit("none")).alias(f"c{n}") for n, h in enumerate(HEADERS["cas_customer"])])
    typed = L.typed_customer_month(L.apply_header_contract(raw, "cas_customer"))
    return tidy(typed.select("cms_code_enc", "report_month", "item_count", "total_fee", "ser_c", "ser_q", "nodone", "order_score", "updated_at"))


def q_typed_customer_info(i: Inputs):
    c = i.info
    text = {"cms_code_enc": col("cms_code_enc"), "contract_sig_first": F.coalesce(F.date_format("contract_sig_first", "yyyy-MM-dd"), F.lit("nan"))}
    numbers = {h: col(h).cast("string") for h in ("contract_classify", "contract_service", "tenure", "cus_poscode", "cus_province")}
    raw = c.select(*[{**text, **numbers}.get(h, F.lit("N/A")).alias(f"c{n}") for n, h in enumerate(HEADERS["cas_info"])])
    return tidy(L.typed_customer_info(L.apply_header_contract(raw, "cas_info")).drop("customer_update_date"))


def q_typed_complaints(i: Inputs):
    c = i.complaints
    text = {"cms_code_enc": col("cms_code_enc"), "create_complaint_date": F.date_format("create_complaint_date", "dd/MM/yyyy"), "complaint_code": col("complaint_code").cast("string"), "complaint_content": F.concat(F.lit(" late "), "cms_code_enc")}
    raw = c.select(*[text.get(h, F.lit("")).alias(f"c{n}") for n, h in enumerate(HEADERS["cms_complaint"])])
    typed = L.typed_complaints(L.apply_header_contract(raw, "cms_complaint"))
    return tidy(typed.select("cms_code_enc", "create_complaint_date", "complaint_code", "complaint_content", "item_code", "etl_date"))


def files(i: Inputs):
    """Archive names made from the orders: months, snapshots and invalid names."""
    k = col("o_orderkey")
    d = col("o_orderdate")
    base = F.when(k % 2 == 0, "bccp_orderitem").otherwise("cas_info")
    name = (
        F.when(k % 3 == 0, F.concat(base, F.lit("_"), F.date_format(d, "yyMM"), F.lit(".zip")))
        .when(k % 3 == 1, F.concat(F.lit("cas_customer_update_"), F.date_format(d, "ddMMyy"), F.lit(".zip")))
        .otherwise(F.concat(F.lit("cas_info_"), F.date_format(d, "ddMMyy"), F.lit(".zip")))
    )
    return i.table("orders").groupBy(name.alias("name")).agg(F.max("o_orderkey").cast("double").alias("file_mtime"))


def log(i: Inputs):
    """A log with success and failure rows for part of the archives."""
    seen = files(i).withColumn("_h", F.ascii(F.substring(F.md5(col("name").cast("binary")), 1, 1)))
    return seen.select(
        col("name").alias("zip_name"), F.when(col("_h") % 3 == 0, "failed").otherwise("success").alias("status"),
        F.when(col("_h") % 2 == 0, col("file_mtime")).otherwise(col("file_mtime") - 1).alias("file_mtime"), col("_h").alias("finished_at"),
    ).filter("finished_at % 5 <> 0")


def q_archive_inventory(i: Inputs):
    return tidy(L.archive_inventory(files(i)))


def q_select_archives(i: Inputs):
    return tidy(L.select_archives(L.archive_inventory(files(i)), log(i)).select("name", "base", "mode", "period_key"))


def q_changed_archives(i: Inputs):
    return tidy(L.changed_archives(files(i), log(i)).select("name", "file_mtime"))


def q_order_csv_parts(i: Inputs):
    day = F.date_format("o_orderdate", "MMdd")
    name = F.concat(F.when(col("o_orderkey") % 5 == 0, "other").otherwise("bccp_orderitem"), F.lit("_"), day, F.lit("_"), day, F.lit("_"), F.date_format("o_orderdate", "yyyy"), F.lit(".csv"))
    names = i.table("orders").select(name.alias("name")).distinct()
    return tidy(L.order_csv_parts(names, "bccp_orderitem", 2000, 2))


def q_sniff_delimiter(i: Inputs):
    """Every order as a line of its customer's file; the separator depends on the customer."""
    sep = F.get(F.array(*[F.lit(d) for d in L.DELIMITERS]), (col("o_custkey") % 4).cast("int"))
    line = F.concat(col("o_orderkey").cast("string"), sep, "o_orderstatus", sep, "o_orderpriority")
    lines = i.table("orders").select(col("o_custkey").cast("string").alias("file"), F.lit(1).alias("line_no"), line.alias("line"))
    return L.sniff_delimiter(lines).withColumn("delimiter", F.replace("delimiter", F.lit("\t"), F.lit("TAB")))


def q_check_csv_rows(i: Inputs):
    """All orders in files with a header each; every seventh has a cell too many."""
    head = HEADERS["cas_info"]
    cells = {0: col("o_orderkey").cast("string"), len(head) - 1: F.when(col("o_orderkey") % 7 == 0, "a,b").otherwise("a")}
    path = scratch_path(i.spark, "rows")
    i.table("orders").repartition(4).select(*[cells.get(n, F.lit("x")).alias(h) for n, h in enumerate(head)]).write.csv(path, header=True, quote="")
    good, ragged = L.check_csv_rows(i.spark, path, "cas_info")
    key = F.split("line", ",")[0].cast("bigint").alias("o_orderkey")
    rows = good.select(col(head[0]).cast("bigint").alias("o_orderkey"), F.lit("good").alias("kind"))
    return rows.unionByName(ragged.select(key, F.lit("ragged").alias("kind")))


def q_scan_months_stored(i: Inputs):
    """Months around 2000 from a stored table, whose reader takes 0001 for a number."""
    path = scratch_path(i.spark, "months")
    T.write_month_partitions(i.table("orders").select("o_orderkey", "o_orderdate"), path, "o_orderdate")
    rows = T.scan_months(i.spark.read.parquet(path), "1999-11-15", "2000-02-10")
    return tidy(rows.select("o_orderkey", "o_orderdate", col("yymm").cast("bigint").alias("yymm")))


def q_guard_csv_injection(i: Inputs):
    k = col("o_orderkey")
    cell = F.concat(F.when(k % 5 == 0, "=").when(k % 5 == 1, "@").when(k % 5 == 2, "+").when(k % 5 == 3, "-").otherwise(""), "o_orderpriority")
    return L.guard_csv_injection(i.table("orders").select("o_orderkey", cell.alias("cell")), ["cell"])


def q_load_confirmed(i: Inputs):
    k = col("o_orderkey")
    source = F.when(k % 10 == 0, "other.csv").otherwise(F.concat(F.lit("Roi_bo_"), F.date_format("o_orderdate", "MM_yy"), F.lit(".csv")))
    rows = i.table("orders").select(F.concat(F.lit(" "), col("o_custkey").cast("string"), F.lit(" ")).alias("cms_code_enc"), source.alias("source_file"))
    loaded = i.table("orders").select(F.month("o_orderdate").alias("file_month"), (F.year("o_orderdate") % 100).alias("file_year")).filter("file_year = 0")
    return tidy(L.parse_confirmed(rows, loaded))


def complaint_lines(i: Inputs, resent: bool):
    """The orders of each month as an archive with two members of complaint records.

    Months are numbers YYMM: the smallest one's archive is broken at first, the largest one is sent again
    without a third of its rows. The newest month has a wrong header, every eleventh order a cell too many.
    """
    head = HEADERS["cms_complaint"]
    k, yymm = col("o_orderkey"), F.date_format("o_orderdate", "yyMM")
    months = i.table("orders").agg(F.min(yymm).alias("_first"), F.max(yymm).alias("_last"), F.max_by(yymm, "o_orderdate").alias("_wrong"))
    orders = i.table("orders").join(F.broadcast(months), F.lit(True))
    first, last = yymm == col("_first"), yymm == col("_last")
    orders = orders.filter(last & (k % 3 != 0) | first) if resent else orders.filter(~first)
    cells = [F.concat(F.lit("C"), col("o_custkey").cast("string")), F.lit("N/A"), F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(""), F.lit(""), F.lit("f"), k.cast("string"),
             F.concat(F.lit('"=late; '), "o_orderpriority", F.lit('"')), F.lit("1"), F.lit(""), F.when(k % 11 == 0, ";").otherwise("")]
    member = F.concat(F.lit("cms_complaint_"), yymm, F.when(k % 2 == 0, "_a.csv").otherwise("_b.csv"))
    lines = orders.select(F.concat(F.lit("cms_complaint_"), yymm, F.lit(".zip")).alias("archive"), member.alias("member"), k.cast("bigint").alias("line_no"), F.concat_ws(";", *cells).alias("line"),
                          (yymm == col("_wrong")).alias("wrong"))
    header = F.when(col("wrong"), F.lit(";".join(head[:-1]))).otherwise(F.lit(";".join(head)))
    heads = lines.groupBy("archive", "member", "wrong").agg(F.lit(-1).cast("bigint").alias("line_no")).withColumn("line", header)
    return lines.drop("wrong").unionByName(heads.drop("wrong"))


def q_ingest_run(i: Inputs):
    """Three runs over a landing folder: all months, a corrected and a re-sent one, and one with nothing new."""
    landing, root = scratch_path(i.spark, "landing"), scratch_path(i.spark, "ingested")
    A.write_archives(complaint_lines(i, resent=False), landing)
    first = i.table("orders").agg(F.min(F.date_format("o_orderdate", "yyMM")).alias("m"))
    broken = first.select(F.concat(F.lit("cms_complaint_"), "m", F.lit(".zip")).alias("archive"))
    A.write_broken(broken, landing)
    IN.run_ingest(i.spark, landing, root)
    A.write_archives(complaint_lines(i, resent=True), landing)
    IN.run_ingest(i.spark, landing, root)
    IN.run_ingest(i.spark, landing, root)
    rows = IN.read_ingested(i.spark, root, "cms_complaint")
    loaded = rows.groupBy("period").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("complaint_code").alias("codes"), F.countDistinct("cms_code_enc").alias("customers"),
        F.count_if(col("complaint_content").startswith("'=late; ")).alias("guarded"), F.min("create_complaint_date").alias("first_date"),
    )
    n = lambda s: F.count_if(col("status") == s)
    runs = IN.read_log(i.spark, root).groupBy(col("period_key").cast("int").alias("period")).agg(
        n("success").alias("successes"), n("failed").alias("failures"), F.sum("rows").alias("logged"), F.sum("rejected").alias("rejected")
    )
    return tidy(runs.join(loaded, "period", "left"))


QUERIES = {
    "ingest_run": q_ingest_run,
    "typed_shipments": q_typed_shipments,
    "typed_customer_month": q_typed_customer_month,
    "typed_customer_info": q_typed_customer_info,
    "typed_complaints": q_typed_complaints,
    "archive_inventory": q_archive_inventory,
    "select_archives": q_select_archives,
    "changed_archives": q_changed_archives,
    "order_csv_parts": q_order_csv_parts,
    "sniff_delimiter": q_sniff_delimiter,
    "check_csv_rows": q_check_csv_rows,
    "scan_months_stored": q_scan_months_stored,
    "guard_csv_injection": q_guard_csv_injection,
    "load_confirmed": q_load_confirmed,
}

_FILES = """files AS (SELECT name, max(o_orderkey)::DOUBLE AS file_mtime, any_value(k3) AS k3 FROM (SELECT o_orderkey, o_orderkey % 3 AS k3, CASE o_orderkey % 3
  WHEN 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'bccp_orderitem' ELSE 'cas_info' END || strftime(o_orderdate, '_%y%m.zip')
  WHEN 1 THEN 'cas_customer_update_' || strftime(o_orderdate, '%d%m%y.zip') ELSE 'cas_info_' || strftime(o_orderdate, '%d%m%y.zip') END AS name FROM orders) GROUP BY name),
inv AS (SELECT name, file_mtime, CASE k3 WHEN 0 THEN substr(name, 1, length(name) - 9) WHEN 1 THEN 'cas_customer' END AS base, CASE k3 WHEN 0 THEN 'monthly' WHEN 1 THEN 'snapshot' END AS mode,
  CASE k3 WHEN 0 THEN '20' || substr(name, length(name) - 7, 4) WHEN 1 THEN '20' || substr(name, 25, 2) || substr(name, 23, 2) || substr(name, 21, 2) END AS period_key,
  CASE k3 WHEN 0 THEN substr(name, 1, length(name) - 4) WHEN 1 THEN 'cas_customer' END AS table_name FROM files),
log AS (SELECT * FROM (SELECT name AS zip_name, h AS finished_at, CASE WHEN h % 3 = 0 THEN 'failed' ELSE 'success' END AS status, CASE WHEN h % 2 = 0 THEN file_mtime ELSE file_mtime - 1 END AS file_mtime
  FROM (SELECT *, ascii(substr(md5(name), 1, 1)) AS h FROM files)) WHERE finished_at % 5 <> 0)"""

ORACLE = {
    "ingest_run": """WITH o AS (SELECT *, strftime(o_orderdate, '%y%m') AS m, ('20' || strftime(o_orderdate, '%y%m'))::BIGINT AS period, o_orderkey % 11 = 0 AS bad FROM orders),
b AS (SELECT min(m) AS first, max(m) AS last, max_by(m, o_orderdate) AS wrong FROM o),
f AS (SELECT o.*, m = first AS broken, m = wrong AS wrong, m = last AS again, o_orderkey % 3 <> 0 AS stays FROM o, b),
sent AS (SELECT period, bool_or(wrong) AS wrong, bool_or(broken) AS broken, bool_or(again) AS again, count(DISTINCT o_orderkey % 2) AS members, count(*) AS n,
  count(*) FILTER (NOT bad) AS good, count(*) FILTER (bad) AS bad, count(*) FILTER (NOT bad AND stays) AS good2, count(*) FILTER (bad AND stays) AS bad2 FROM f GROUP BY period),
loaded AS (SELECT period, count(*) AS n_rows, sum(o_orderkey)::BIGINT AS codes, count(DISTINCT o_custkey) AS customers, count(*) AS guarded, strftime(min(o_orderdate), '%Y-%m-%d 00:00:00') AS first_date
  FROM f WHERE NOT bad AND NOT wrong AND (NOT again OR stays) GROUP BY period)
SELECT sent.period, (CASE WHEN wrong THEN 0 WHEN again THEN 2 ELSE 1 END)::BIGINT AS successes, (CASE WHEN wrong THEN 3 WHEN broken THEN 1 ELSE 0 END)::BIGINT AS failures,
  (CASE WHEN wrong THEN 0 WHEN again THEN good + good2 ELSE good END)::BIGINT AS logged,
  (CASE WHEN wrong THEN 3 * (n + members) WHEN again THEN bad + bad2 WHEN broken THEN bad + 1 ELSE bad END)::BIGINT AS rejected,
  n_rows, codes, customers, guarded, first_date
FROM sent LEFT JOIN loaded ON loaded.period = sent.period""",
    "check_csv_rows": "SELECT o_orderkey::BIGINT AS o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'ragged' ELSE 'good' END AS kind FROM orders",
    "scan_months_stored": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS o_orderdate, (year(o_orderdate) % 100 * 100 + month(o_orderdate))::BIGINT AS yymm
FROM orders WHERE o_orderdate >= '1999-11-01' AND o_orderdate < '2000-03-01'""",
    "typed_shipments": with_ctes(
        f"""SELECT NULL::VARCHAR AS crm_code_enc, cms_code_enc, item_code, service_code, region, {r('weight_kg')} AS weight_kg, total_fee::BIGINT AS total_fee, is_domestic::BIGINT AS is_domestic,
  done::BIGINT AS done, delay_day::BIGINT AS delay_day, {r('order_score')} AS order_score, strftime(sending_time, '%Y-%m-%d %H:%M:%S') AS sending_time, NULL::VARCHAR AS ending_time, NULL::BIGINT AS length_size, NULL::BIGINT AS complaint114 FROM shipments""", "shipments"),
    "typed_customer_month": with_ctes(
        "SELECT cms_code_enc, strftime(report_month, '%Y-%m-%d') AS report_month, item_count, total_fee, ser_c, ser_q, nodone, NULL::DOUBLE AS order_score, strftime(report_month, '%Y-%m-%d 00:00:00') AS updated_at FROM cm", "cm"),
    "typed_customer_info": with_ctes(
        """SELECT cms_code_enc, NULL::VARCHAR AS crm_code_enc, cus_province::BIGINT AS cus_province, contract_service::BIGINT AS contract_service, tenure::BIGINT AS tenure, NULL::BIGINT AS custype,
  contract_classify::BIGINT AS contract_classify, NULL::BIGINT AS contract_mgr_org, cus_poscode::BIGINT AS cus_poscode, strftime(contract_sig_first, '%Y-%m-%d 00:00:00') AS contract_sig_first FROM info""", "info"),
    "typed_complaints": with_ctes(
        "SELECT cms_code_enc, strftime(create_complaint_date, '%Y-%m-%d 00:00:00') AS create_complaint_date, complaint_code::BIGINT AS complaint_code, 'late ' || cms_code_enc AS complaint_content, NULL::VARCHAR AS item_code, NULL::VARCHAR AS etl_date FROM complaints", "complaints"),
    "archive_inventory": f"WITH {_FILES} SELECT name, file_mtime, base, mode, period_key, table_name FROM inv",
    "select_archives": f"""WITH {_FILES}, rk AS (SELECT *, row_number() OVER (PARTITION BY base, mode ORDER BY period_key DESC, name DESC) AS rn FROM inv WHERE mode IS NOT NULL)
SELECT name, base, mode, period_key FROM rk WHERE (mode = 'snapshot' AND rn = 1) OR (mode = 'monthly' AND (rn <= 2 OR name NOT IN (SELECT zip_name FROM log WHERE status = 'success')))""",
    "changed_archives": f"""WITH {_FILES} SELECT f.name, f.file_mtime FROM files f LEFT JOIN (SELECT zip_name, file_mtime FROM log WHERE status = 'success') l ON l.zip_name = f.name
WHERE l.file_mtime IS DISTINCT FROM f.file_mtime""",
    "order_csv_parts": """SELECT name, valid, start, row_number() OVER (ORDER BY valid DESC, start, name) AS position FROM (
  SELECT name, name LIKE 'bccp%' AND name LIKE '%\\_02__\\_02__\\_2000.csv' ESCAPE '\\' AS valid, CASE WHEN name LIKE 'bccp%' AND name LIKE '%\\_02__\\_02__\\_2000.csv' ESCAPE '\\' THEN md::BIGINT END AS start
  FROM (SELECT DISTINCT CASE WHEN o_orderkey % 5 = 0 THEN 'other' ELSE 'bccp_orderitem' END || strftime(o_orderdate, '_%m%d_%m%d_%Y.csv') AS name, strftime(o_orderdate, '%m%d') AS md FROM orders))""",
    "sniff_delimiter": "SELECT DISTINCT o_custkey::VARCHAR AS file, ([',', ';', 'TAB', '|'])[(o_custkey % 4)::INT + 1] AS delimiter FROM orders",
    "guard_csv_injection": "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '''=' WHEN 1 THEN '''@' WHEN 2 THEN '+' WHEN 3 THEN '-' ELSE '' END || o_orderpriority AS cell FROM orders",
    "load_confirmed": """SELECT DISTINCT o_custkey::VARCHAR AS cms_code_enc, month(o_orderdate) AS file_month, year(o_orderdate) % 100 AS file_year, strftime(o_orderdate, 'Roi_bo_%m_%y.csv') AS source_file
FROM orders WHERE o_orderkey % 10 <> 0 AND year(o_orderdate) % 100 <> 0""",
}
