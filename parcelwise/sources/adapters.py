"""Test-table adapters: TPC-H-like tables in the shape of the source tables.

Only used by the query catalogue, the benchmark and the tests.
"""

from __future__ import annotations

import itertools
import operator
import uuid
import zipfile

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.schemas import COMPLAINT_CODES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_code(key: str):
    k = F.col(key)
    return F.concat(F.when(k % 5 == 0, "T").otherwise("C"), F.lpad(k.cast("string"), 8, "0"))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    place = (
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("region"))
    )
    col = F.col
    services = F.split(F.lit("C,E,M,P,R,U,L,Q"), ",")
    flag = lambda cond: F.when(cond, 1).otherwise(0)
    returned = col("l_returnflag") == "R"
    return (
        line.join(orders, col("l_orderkey") == col("o_orderkey"))
        .join(place, col("l_suppkey") == col("s_suppkey"))
        .select(
            customer_code("o_custkey").alias("cms_code_enc"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("item_code"),
            F.get(services, (col("l_partkey") % 8).cast("int")).alias("service_code"),
            col("l_quantity").cast("decimal(10,3)").alias("weight_kg"),
            F.floor("l_extendedprice").cast("int").alias("total_fee"),
            flag(col("l_linestatus") == "F").alias("is_domestic"),
            (col("l_suppkey") % 63).cast("int").alias("rec_province_code"),
            (col("l_suppkey") % 17).cast("int").alias("rec_district_code"),
            (col("l_suppkey") % 7).cast("int").alias("rec_commune_code"),
            "region",
            col("l_shipdate").alias("sending_time"),
            F.when(col("l_linenumber") > 5, col("l_linenumber") - 5).otherwise(0).alias("delay_day"),
            flag(~returned).alias("done"),
            flag(~returned).alias("rec_success"),
            flag(returned).alias("refunded"),
            flag(col("l_partkey") % 41 == 0).alias("no_accepted"),
            flag(col("l_partkey") % 97 == 0).alias("lost_order"),
            flag(col("l_partkey") % 17 == 0).alias("total_complaint"),
            F.when(col("l_discount") != 0, (col("l_discount") * 50).cast("decimal(10,3)")).alias("order_score"),
        )
    )


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.array(*[F.lit(c) for c in COMPLAINT_CODES])
    return (
        table(spark, sf_dir, "orders")
        .filter("o_orderpriority = '1-URGENT'")
        .select(
            customer_code("o_custkey").alias("cms_code_enc"),
            F.get(codes, (F.col("o_orderkey") % 14).cast("int")).alias("complaint_code"),
            F.col("o_orderdate").alias("create_complaint_date"),
        )
    )


def customer_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_custkey")
    value = lambda cond, v: F.when(~cond, v).cast("int")
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", "o_orderstatus")
        .agg(F.min("o_orderdate").alias("_first"))
        .select(
            customer_code("o_custkey").alias("cms_code_enc"),
            F.when(k % 11 != 0, F.to_date("_first")).alias("contract_sig_first"),
            value(k % 7 == 0, k % 3).alias("contract_classify"),
            value(k % 13 == 0, 60 + k % 5).alias("contract_service"),
            F.lit(None).cast("int").alias("custype"),
            value(k % 2 == 0, k % 60).alias("tenure"),
            F.lit(None).cast("int").alias("contract_mgr_org"),
            F.ascii("o_orderstatus").alias("cus_poscode"),
            (k % 63).cast("int").alias("cus_province"),
        )
    )


def confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .filter("c_custkey % 29 = 0")
        .select(customer_code("c_custkey").alias("cms_code_enc"), F.lit(1).alias("file_month"), F.lit(1).alias("file_year"))
    )


def write_archives(rows: DataFrame, landing: str, sep: str = ";") -> None:
    """Zip archives from ``rows(archive, member, line)``, in the order of ``line_no`` inside a member.

    One task streams an archive; it appears under its name when it is whole.
    """

    def run(batches):
        target, at, name, part, raw, zipped, data = None, None, None, None, None, None, None
        system, folder = fs.FileSystem.from_uri(landing)
        system.create_dir(folder, recursive=True)

        def close():
            data.close()
            zipped.close()
            raw.close()
            system.move(part, target)

        for batch in batches:
            records = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
            for (archive, member), lines in itertools.groupby(records, key=operator.itemgetter(0, 1)):
                if archive != name:
                    if name is not None:
                        close()
                    name, at = archive, None
                    target, part = f"{folder}/{archive}", f"{folder}/_{uuid.uuid4().hex}"
                    raw = system.open_output_stream(part)
                    zipped = zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED)
                if member != at:
                    if at is not None:
                        data.close()
                    at, data = member, zipped.open(member, "w")
                data.write("".join(line + "\n" for _, _, line in lines).encode())  # of one batch at most
            yield pa.RecordBatch.from_arrays([pa.array([], pa.string())], ["archive"])
        if name is not None:
            close()

    ordered = rows.repartition("archive").sortWithinPartitions("archive", "member", "line_no").select("archive", "member", "line")
    ordered.mapInArrow(run, "archive string").write.format("noop").mode("overwrite").save()


def write_broken(names: DataFrame, landing: str) -> None:
    """Files ``names(archive)`` that are no archives."""

    def run(batches):
        system, folder = fs.FileSystem.from_uri(landing)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_output_stream(f"{folder}/{name}") as out:
                    out.write(b"no archive")
            yield batch

    names.select("archive").mapInArrow(run, "archive string").write.format("noop").mode("overwrite").save()
