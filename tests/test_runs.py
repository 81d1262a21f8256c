"""The ingestion run and the window refresh: repeated, interrupted, and against full builds."""

import zipfile

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import features as X
from parcelwise.operators import rollup as R
from parcelwise.plans import ingest as IN
from parcelwise.plans import refresh as RF
from parcelwise.plans import windows as P
from parcelwise.schemas import HEADERS
from parcelwise.sources import tables as T

HEAD = HEADERS["cas_info"]


def archive(folder, name, codes, head=HEAD, extra=()):
    lines = [";".join(head), *(";".join([c, *["1"] * (len(HEAD) - 1)]) for c in codes), *extra]
    with zipfile.ZipFile(folder / name, "w") as z:
        z.writestr("deep/part_a.csv", "﻿" + "\n".join(lines) + "\n")
        z.writestr("part_b.csv", ";".join(head) + "\n")
        z.writestr("readme.txt", "no table")


def seen(spark, root, base="cas_info"):
    return sorted((r["period"], r["cms_code_enc"]) for r in IN.read_ingested(spark, root, base).collect())


def statuses(rows):
    return sorted((r["zip_name"], r["status"], r["rows"], r["rejected"], (r["reason"] or "").split(":")[0]) for r in rows.collect())


def test_ingest_repeated_failed_and_resent(spark, tmp_path):
    landing, root = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    assert IN.run_ingest(spark, f"file://{landing}", root).count() == 0 and seen(spark, root) == []
    for month in ("2501", "2502", "2503"):
        archive(landing, f"cas_info_{month}.zip", [f"a{month}", "b"], extra=["too;short"] if month == "2502" else ())
    archive(landing, "cas_info_2504.zip", ["x"], head=HEAD[:-1])
    (landing / "cas_info_2505.zip").write_bytes(b"broken")
    with zipfile.ZipFile(landing / "cas_info_2506.zip", "w") as z:
        z.writestr("a.txt", "nothing")
    archive(landing, "cas_info_2513.zip", ["no such month"])
    archive(landing, "unknown_2501.zip", ["no such table"])
    for day, code in (("010125", "old"), ("310125", "new")):
        archive(landing, f"cas_customer_update_{day}.zip", [], head=HEADERS["cas_customer"], extra=[";".join([code, "2025-01-01", *["1"] * (len(HEADERS["cas_customer"]) - 2)])])
    first = statuses(IN.run_ingest(spark, f"file://{landing}", root))
    assert first == [
        ("cas_customer_update_310125.zip", "success", 1, 0, ""), ("cas_info_2501.zip", "success", 2, 0, ""), ("cas_info_2502.zip", "success", 2, 1, ""),
        ("cas_info_2503.zip", "success", 2, 0, ""), ("cas_info_2504.zip", "failed", 0, 3, "header"), ("cas_info_2505.zip", "failed", 0, 1, "unreadable"), ("cas_info_2506.zip", "skipped", 0, 0, "no csv"),
    ]
    loaded = [(202501, "a2501"), (202501, "b"), (202502, "a2502"), (202502, "b"), (202503, "a2503"), (202503, "b")]
    assert seen(spark, root) == loaded and seen(spark, root, "cas_customer") == [(20250131, "new")]
    assert spark.read.parquet(f"{root}/rejects").filter("reason = 'cells'").count() == 1
    # Nothing new: the failed ones are tried again, the loaded ones are not.
    again = statuses(IN.run_ingest(spark, f"file://{landing}", root))
    assert [(n, s) for n, s, *_ in again] == [("cas_info_2504.zip", "failed"), ("cas_info_2505.zip", "failed"), ("cas_info_2506.zip", "skipped")]
    assert seen(spark, root) == loaded
    # A corrected older month and a newer snapshot, which replaces the whole table.
    archive(landing, "cas_info_2505.zip", ["five"])
    archive(landing, "cas_info_2506.zip", ["six"])
    archive(landing, "cas_customer_update_010225.zip", [], head=HEADERS["cas_customer"], extra=[";".join(["newest", "2025-02-01", *["1"] * (len(HEADERS["cas_customer"]) - 2)])])
    IN.run_ingest(spark, f"file://{landing}", root)
    assert seen(spark, root) == [*loaded, (202505, "five"), (202506, "six")] and seen(spark, root, "cas_customer") == [(20250201, "newest")]
    archive(landing, "cas_info_2506.zip", ["six again", "seven"])
    IN.run_ingest(spark, f"file://{landing}", root)
    assert seen(spark, root) == [*loaded, (202505, "five"), (202506, "seven"), (202506, "six again")]


def test_a_run_that_dies_changes_nothing_and_is_made_good(spark, tmp_path, monkeypatch):
    landing, root = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    archive(landing, "cas_info_2501.zip", ["a", "b"])
    IN.run_ingest(spark, f"file://{landing}", root)
    archive(landing, "cas_info_2501.zip", ["a", "c", "d"])
    archive(landing, "cas_info_2502.zip", ["e"])
    real = T.append_ingest_log

    def dies(row, path):
        if "zip_name" in row.columns and not row.isEmpty():
            raise RuntimeError("lost the driver")
        real(row, path)

    monkeypatch.setattr(T, "append_ingest_log", dies)
    with pytest.raises(RuntimeError):
        IN.run_ingest(spark, f"file://{landing}", root)
    assert seen(spark, root) == [(202501, "a"), (202501, "b")]
    monkeypatch.setattr(T, "append_ingest_log", real)
    IN.run_ingest(spark, f"file://{landing}", root)
    assert seen(spark, root) == [(202501, "a"), (202501, "c"), (202501, "d"), (202502, "e")]


def sample(spark):
    rows = [(f"C{c}", f"2025-{m:02d}-{1 + (c * m) % 27:02d} 0{c % 9}:00:00", 100 * m + c) for c in range(1, 9) for m in range(1, 9) if (c + m) % 3]
    rows = spark.createDataFrame(rows, "cms_code_enc string, t string, total_fee int").withColumn("sending_time", F.col("t").cast("timestamp_ntz")).drop("t")
    ones = ["total_complaint", "delay_day", "done", "refunded", "no_accepted", "lost_order", "is_domestic", "rec_success"]
    rows = rows.withColumns({c: (F.col("total_fee") % (k + 2)).cast("int") for k, c in enumerate(ones)}).withColumns({"order_score": F.lit(2.5), "weight_kg": F.lit(1.5), "service_code": F.lit("C")})
    complaints = rows.filter("total_complaint = 1").select("cms_code_enc", F.lit(114).alias("complaint_code"), F.col("sending_time").alias("create_complaint_date"))
    return rows, complaints


def test_refresh_equals_a_full_build(spark, tmp_path):
    rows, complaints = sample(spark)
    shipments, root = str(tmp_path / "shipments"), str(tmp_path / "out")
    T.write_month_partitions(rows, shipments, "sending_time")
    table = spark.read.parquet(shipments)
    run = dict(start="2025-01-01", sizes=[2, 3], last_n=1)
    first = RF.run_refresh(spark, root, table, complaints, end="2025-06-30", **run)
    assert {r["action"] for r in first.collect()} == {"new"}
    second = RF.run_refresh(spark, root, table, complaints, end="2025-08-31", **run)
    assert sorted((r["window_size"], r["window_end"], r["action"]) for r in second.filter("action <> 'keep'").collect()) == [(w, f"250{m}", "recompute" if m == 6 else "new") for w in (2, 3) for m in (6, 7, 8)]
    specs = P.specs_between(spark, "2025-01-01", "2025-08-31", [2, 3])
    monthly = R.monthly_rollup(rows, "2025-01-01", "2025-08-31", with_days=True)
    whole = X.window_features(monthly, complaints, specs, 3)
    show = lambda df, cols: sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.select(*cols).collect())
    assert show(T.read_windows(spark, f"{root}/windows"), whole.columns) == show(whole, whole.columns)
    asof = X.lifetime_asof_all(monthly, specs, "2025-01-01")
    ends = specs.select("end_date").distinct()
    assert show(RF.read_asof(spark, root), asof.columns) == show(asof.join(ends, F.col("lifetime_asof_date") == F.col("end_date")), asof.columns)
    assert RF.run_refresh(spark, root, table, complaints, end="2025-08-31", **run | {"last_n": 0}).filter("action <> 'keep'").count() == 0


def test_refresh_reads_only_the_months_it_needs(spark, tmp_path):
    rows, _ = sample(spark)
    T.write_month_partitions(rows, str(tmp_path / "s"), "sending_time")
    known = spark.createDataFrame([(m,) for m in (2501, 2502, 2503, 2504)], "yymm int")
    months = RF.months_to_roll(known, "2025-01-01", "2025-06-30", 1)
    assert months == [2504, 2505, 2506] and RF.months_to_roll(None, "2025-05-01", "2025-06-30", 1) == [2505, 2506]
    assert RF.months_to_roll(known.limit(2), "2024-12-01", "2025-02-28", 0) == [2412, 2502]
    scan = T.scan_month_list(spark.read.parquet(str(tmp_path / "s")), months)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and all(str(m) in plan for m in months) and "2503" not in plan.split("PartitionFilters")[1]
    assert {r["yymm"] for r in scan.select("yymm").distinct().collect()} == set(months)


def test_a_dead_refresh_is_repeated(spark, tmp_path, monkeypatch):
    rows, complaints = sample(spark)
    T.write_month_partitions(rows, str(tmp_path / "s"), "sending_time")
    table, run = spark.read.parquet(str(tmp_path / "s")), dict(start="2025-01-01", end="2025-08-31", sizes=[3])
    real = T.write_window_tables
    monkeypatch.setattr(T, "write_window_tables", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        RF.run_refresh(spark, str(tmp_path / "o"), table, complaints, **run)
    monkeypatch.setattr(T, "write_window_tables", real)
    plan = RF.run_refresh(spark, str(tmp_path / "o"), table, complaints, **run)
    assert {r["action"] for r in plan.collect()} == {"new"} and RF.built_windows(spark, str(tmp_path / "o")).count() == 6
