import zipfile

import pytest
from pyspark.sql import functions as F

from parcelwise.schemas import HEADERS
from parcelwise.sources import landing as L
from parcelwise.sources import tables as T
from parcelwise.streaming import landing as ST


def shipment_csv(rows, bom=True):
    """Landing text: ``rows`` are dicts of the columns that matter."""
    head = HEADERS["bccp_orderitem"]
    lines = [";".join(head)] + [";".join(str(r.get(h, "")) for h in head) for r in rows]
    return ("﻿" if bom else "") + "\n".join(lines) + "\n"


def row(code, item, sent, fee="100", **kw):
    return {"cms_code_enc": code, "item_code_enc": item, "sending_time": sent, "total_fee": fee, "done": "t", "service_code": "C", "is_domestic": "t", "weight_kg": "1,5", **kw}


def test_read_typed(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text(shipment_csv([row(" T1 ", "i1", "01/02/2025 10:00:00", "1.200 d"), row("null", "i2", "bad", "x")]), encoding="utf-8")
    raw = L.read_landing_csv(spark, str(f))
    assert raw.columns[0] == "crm_code_enc" and L.renamed_columns(raw, "bccp_orderitem") == []
    got = L.read_typed(spark, str(f), "bccp_orderitem").orderBy("item_code").collect()
    assert got[0]["cms_code_enc"] == "T1" and got[0]["total_fee"] == 1200 and float(got[0]["weight_kg"]) == 1.5 and got[0]["done"] == 1
    assert str(got[0]["sending_time"]) == "2025-02-01 10:00:00"
    assert got[1]["cms_code_enc"] is None and got[1]["sending_time"] is None and got[1]["total_fee"] is None
    with pytest.raises(ValueError, match="columns"):
        L.apply_header_contract(raw.drop("region"), "bccp_orderitem")


def test_header_renames(spark):
    raw = spark.createDataFrame([tuple("abcdefghijk")], [f"x{i}" for i in range(11)])
    assert len(L.renamed_columns(raw, "cas_info")) == 11
    assert L.apply_header_contract(raw, "cas_info").columns == HEADERS["cas_info"]
    assert L.apply_header_contract(raw, "other").columns == raw.columns


def test_ragged_rows(spark, tmp_path):
    head = HEADERS["cas_info"]
    good, bad = ",".join("a" * len(head)), ",".join("a" * (len(head) + 1))
    f = tmp_path / "b.csv"
    f.write_text("\n".join([",".join(head), good, bad, good]) + "\n")
    ok, ragged = L.check_csv_rows(spark, str(f), "cas_info")
    assert ok.count() == 2 and ragged.count() == 1
    (tmp_path / "dir").mkdir()
    for k, head_line in enumerate([",".join(head), '"' + '","'.join(head) + '"']):
        (tmp_path / "dir" / f"{k}.csv").write_text("\n".join([head_line, good, ",".join(head)] if k else [head_line, bad]) + "\n")
    ok, ragged = L.check_csv_rows(spark, str(tmp_path / "dir"), "cas_info")
    assert ok.count() == 1 and sorted(r.line for r in ragged.collect()) in ([bad, ",".join(head)], sorted([bad, '"' + '","'.join(head) + '"']))
    f2 = tmp_path / "c.csv"
    f2.write_text("x,y\n1,2\n")
    with pytest.raises(ValueError, match="expected names"):
        L.check_csv_rows(spark, str(f2), "cas_info")


def test_injection_modes(spark):
    df = spark.createDataFrame([("=1",), ("@x",), ("+1",), ("ok",), (None,)], "t string")
    assert [r[0] for r in L.guard_csv_injection(df, ["t"]).collect()] == ["'=1", "'@x", "+1", "ok", None]
    assert L.guard_csv_injection(df, ["t"], "off").collect() == df.collect()
    with pytest.raises(Exception, match="formula"):
        L.guard_csv_injection(df, ["t"], "text_only").collect()
    plus = df.filter("t = '+1'")
    assert L.guard_csv_injection(plus, ["t"], "text_only").count() == 1
    with pytest.raises(Exception, match="formula"):
        L.guard_csv_injection(plus, ["t"], "strict").collect()


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "bccp_orderitem_2501.zip", "w") as z:
        z.writestr("in/bccp_orderitem_0101_0110_2025.csv", shipment_csv([row("T1", f"i{k}", "05/01/2025") for k in range(3)]))
        z.writestr("notes.txt", "no")
    (tmp_path / "cas_info_update_250125.zip").write_bytes(b"not a zip")
    inv = {r["name"]: r for r in L.archive_inventory(L.list_files(spark, str(tmp_path))).collect()}
    assert inv["bccp_orderitem_2501.zip"]["mode"] == "monthly" and inv["cas_info_update_250125.zip"]["period_key"] == "20250125"
    rows = L.extract_archives(spark, str(tmp_path)).persist()
    errors = rows.filter("error is not null").collect()
    assert [e["archive"] for e in errors] == ["cas_info_update_250125.zip"]
    good, rejected = L.parse_rows(rows, "bccp_orderitem")
    typed = L.typed_shipments(good)
    assert typed.count() == 3 and typed.first()["cms_code_enc"] == "T1"
    assert [r["reason"] for r in rejected.collect()] == ["unreadable"]


def test_archive_rejects(spark, tmp_path):
    head = HEADERS["cas_info"]
    fine = ["x"] * (len(head) - 1)
    members = {
        "a.csv": [head, ["one", *fine], ["a", "b"], ["y"] * (len(head) + 2), ['"two\nlines"', *fine]],
        "b.csv": [head[:-1], ["z", *fine]],
        "c.csv": [["three", *fine]],
    }
    with zipfile.ZipFile(tmp_path / "cas_info_2501.zip", "w") as z:
        for name, rows in members.items():
            z.writestr(name, "\n".join(";".join(r) for r in rows) + "\n\n")
        z.writestr("d.csv", b"\xff\xfe\n")
    good, rejected = L.parse_rows(L.extract_archives(spark, str(tmp_path)), "cas_info")
    assert sorted(r[2] for r in good.collect()) == ["one", "three", "two\nlines"]
    assert sorted((r.member, r.reason) for r in rejected.collect()) == [("a.csv", "cells"), ("a.csv", "cells"), ("b.csv", "header"), ("b.csv", "header"), ("d.csv", "unreadable")]


def test_confirmed(spark, tmp_path):
    for name, body in {"Roi_bo_01_25.csv": "cms_code_enc\n a \na\nb\n", "Roi_bo_02_25.csv": "cms_code_enc\na\n", "else.csv": "cms_code_enc\nz\n"}.items():
        (tmp_path / name).write_text(body)
    first = L.load_confirmed(spark, str(tmp_path))
    assert sorted((r[0], r[1], r[2]) for r in first.collect()) == [("a", 1, 25), ("a", 2, 25), ("b", 1, 25)]
    assert L.load_confirmed(spark, str(tmp_path), first.filter("file_month = 1")).count() == 1
    with pytest.raises(ValueError, match="cms_code_enc"):
        L.parse_confirmed(first.drop("cms_code_enc"))


def test_month_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,), (2,)], "v int")
    T.load_month(df, path, "2501")
    T.load_month(df, path, "2502")
    T.load_month(df.limit(1), path, "2501")
    back = spark.read.parquet(path)
    assert back.count() == 3
    assert T.scan_months(back, "2025-02-01", "2025-03-31").count() == 2
    plan = T.scan_months(back, "2025-02-01", "2025-03-31")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2502" in plan
    old = str(tmp_path / "old")
    T.load_month(df, old, "0001")
    T.load_month(df, old, "0012")
    assert T.scan_months(spark.read.parquet(old), "2000-01-01", "2000-02-01").count() == 2
    T.load_snapshot(df, str(tmp_path / "s"))
    T.load_snapshot(df.limit(1), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1


def test_window_tables(spark, tmp_path):
    path = str(tmp_path / "w")
    df = spark.createDataFrame([("a", 3, "0012", 1.0), ("b", 3, "0101", 2.0)], "cms_code_enc string, window_size int, window_end string, x double")
    T.write_window_tables(df, path)
    T.write_window_tables(df.filter("window_end = '0101'").withColumn("x", F.lit(5.0)), path)
    assert {r["window_end"]: r["x"] for r in T.read_windows(spark, path).collect()} == {"0012": 1.0, "0101": 5.0}
    assert T.read_window(spark, path, 3, "0012").count() == 1


def test_validate_and_status(spark):
    df = spark.createDataFrame([("a",)], "cms_code_enc string")
    tables = {"bccp_orderitem_2501": df.withColumn("sending_time", F.current_timestamp()), "cas_info": df, "cas_customer": df, "cms_complaint": None}
    rows = {(r["table_name"], r["column_name"]) for r in T.validate_sources(tables).collect()}
    assert rows == {("cas_customer", "report_month"), ("cms_complaint", None)}
    with pytest.raises(ValueError, match="report_month"):
        T.require_sources(tables)
    status = {r["table_name"]: r["status"] for r in T.table_status({"x": df, "y": df.limit(0), "z": None}).collect()}
    assert status == {"x": "HAS DATA", "y": "EMPTY", "z": "MISSING"}


def test_stream_equals_batch(spark, tmp_path):
    from parcelwise.operators.rollup import monthly_rollup

    landing, store, out, check = (str(tmp_path / d) for d in ("in", "store", "out", "chk"))
    (tmp_path / "in").mkdir()
    first = [row(f"T{k % 3}", f"a{k}", f"{k % 28 + 1:02d}/01/2025") for k in range(40)]
    second = [row(f"T{k % 4}", f"b{k}", f"{k % 28 + 1:02d}/0{k % 2 + 1}/2025", "7") for k in range(40)]
    for n, rows in enumerate((first, second)):
        (tmp_path / "in" / f"f{n}.csv").write_text(shipment_csv(rows))
        ST.stream_monthly_rollup(ST.stream_landing(spark, landing, "bccp_orderitem"), store, out, check)
    batch = monthly_rollup(L.read_typed(spark, landing, "bccp_orderitem"), *ST.EVER)
    got = spark.read.parquet(out).select(*batch.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect())) and got.count() > 4


def test_stream_dedup_and_late_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [row("T1", "same", "01/03/2025"), row("T1", "same", "01/03/2025"), row("T1", "x", "01/02/2025"), row("T1", "y", "05/01/2025"), row("T1", "z", "05/12/2024")]
    (tmp_path / "in" / "f.csv").write_text(shipment_csv(rows))
    done = spark.createDataFrame([("2501",)], "yymm string")
    stream = ST.stream_dedup_shipments(ST.stream_landing(spark, str(tmp_path / "in"), "bccp_orderitem"))
    sink = ST.late_policy_sink(str(tmp_path / "ok"), str(tmp_path / "late"), lambda: done)
    ST.run_available(stream, sink, str(tmp_path / "chk"))
    items = lambda d: sorted(r["item_code"] for r in spark.read.parquet(str(tmp_path / d)).collect())
    assert items("ok") == ["same", "x", "z"]  # newest two months, and a month never completed
    assert items("late") == ["y"]


def test_each_member_is_a_task(spark, tmp_path):
    for k in range(6):
        with zipfile.ZipFile(tmp_path / f"cas_info_250{k + 1}.zip", "w") as z:
            z.writestr("a.csv", "\n".join(f"a{k};{n}" for n in range(20_001)))
            z.writestr("b.csv", b"b;1\nb;\xff\n")
    rows = L.extract_archives(spark, f"file://{tmp_path}").withColumn("task", F.spark_partition_id())
    got = rows.groupBy("archive", "member").agg(F.min("task").alias("task"), F.count_if(F.expr("error is null")).alias("n"), F.max("row_no").alias("last"), F.count("error").alias("errors")).collect()
    assert len({r["task"] for r in got}) > 6  # no more than shuffle partitions before, here 4
    assert {(r["n"], r["last"], r["errors"]) for r in got if r["member"] == "a.csv"} == {(20_001, 20_001, 0)}
    assert {r["errors"] for r in got if r["member"] == "b.csv"} == {1}
    assert rows.filter("row_no = 20001").select("archive", "cells").orderBy("archive").first()["cells"] == ["a0", "20000"]
