"""The ingestion run: new archives of a landing folder into versioned tables, with the log as commit record.

Below the root lie ``staged`` (records as read, by run), ``tables/<base>`` (typed rows by period and
run), ``rejects`` and ``log``. A run only adds files. The rows of a period are those of the run that
its newest success row names, so data without a log row is never seen: a run that dies anywhere
leaves the tables as they were, the next one loads the same archives, and a re-sent archive
replaces its period the moment its log row is there.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.functions.lineage import cut
from parcelwise.schemas import HEADERS, TEXT_COLUMNS
from parcelwise.sources import landing as L
from parcelwise.sources import tables as T

LOG = (
    "run_id string, zip_name string, base string, mode string, table_name string, period_key string, rows bigint, "
    "rejected bigint, file_size bigint, file_mtime double, status string, reason string, finished_at timestamp"
)


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """All log rows; an empty log is created where there is none."""
    T.append_ingest_log(spark.createDataFrame([], LOG), f"{root}/log")
    return spark.read.schema(LOG).parquet(f"{root}/log")


def committed(log: DataFrame, base: str) -> DataFrame:
    """``(period, run)`` of every loaded period of a base: one row per month, or the newest snapshot."""
    done = log.filter((F.col("status") == "success") & (F.col("base") == base))
    newest = done.groupBy("mode", "period_key").agg(F.max(F.struct("finished_at", "run_id"))["run_id"].alias("run"))
    rows = newest.select("mode", F.col("period_key").cast("int").alias("period"), "run")
    last = rows.filter("mode = 'snapshot'").agg(F.max("period").alias("_last"))
    # One row per calendar month at most.
    return rows.join(last, F.lit(True), "left").filter("mode = 'monthly' or period = _last").select("period", "run")


def read_ingested(spark: SparkSession, root: str, base: str) -> DataFrame:
    """The committed rows of a table with their ``period`` (YYYYMM, or YYYYMMDD of a snapshot)."""
    empty = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in HEADERS[base]))
    typed = L.TRANSFORMS[base](empty).withColumn("period", F.lit(None).cast("int"))
    valid = cut(committed(read_log(spark, root), base))
    if valid.isEmpty():
        return typed
    rows = spark.read.schema(typed.withColumn("run", F.lit("")).schema).parquet(f"{root}/tables/{base}")
    # Both join columns are partitions: other runs' files are not opened.
    return rows.join(F.broadcast(valid), ["period", "run"]).select(*typed.columns)


def _outcomes(marked: DataFrame, todo: DataFrame) -> DataFrame:
    """One row per archive: counts, status and reason, in one pass. Unreadable parts and wrong headers fail a whole archive."""
    data, rejected = F.col("is_data"), F.col("reason").isNotNull()
    fatal = F.when(data & (F.col("reason") != "cells"), F.struct("reason", F.coalesce("error", "member").alias("detail")))
    found = marked.groupBy("archive").agg(
        F.count("member").alias("records"), F.count_if(data & ~rejected).alias("rows"), F.count_if(data & rejected).alias("rejected"), F.min(fatal).alias("fatal")
    )
    joined = todo.withColumnRenamed("name", "archive").join(found, "archive", "left")
    failed = F.col("fatal").isNotNull()
    none = F.coalesce(F.col("records"), F.lit(0)) == 0
    return joined.select(
        F.col("archive").alias("zip_name"), "base", "mode", "table_name", "period_key",
        F.when(failed, 0).otherwise(F.coalesce("rows", F.lit(0))).cast("bigint").alias("rows"),
        F.coalesce("rejected", F.lit(0)).cast("bigint").alias("rejected"), F.col("file_size").cast("bigint").alias("file_size"), "file_mtime",
        F.when(failed, "failed").when(none, "skipped").otherwise("success").alias("status"),
        F.when(failed, F.concat_ws(": ", "fatal.reason", "fatal.detail")).when(none, "no csv").alias("reason"),
    )


def _load_base(spark: SparkSession, root: str, run: str, base: str, todo: DataFrame, injection: str) -> None:
    mine = todo.filter(F.col("base") == base)
    names = mine.select(F.col("name").alias("archive"))
    rows = spark.read.schema(L.ARCHIVE_ROWS).parquet(f"{root}/staged/{run}").join(F.broadcast(names), "archive")
    good, bad = L.parse_rows(rows, base)
    outcome = cut(_outcomes(L.mark_rows(rows, base), mine))
    fine = outcome.filter("status = 'success'").select(F.col("zip_name").alias("archive"), F.col("period_key").cast("int").alias("period"))
    guarded = L.guard_csv_injection(good.join(F.broadcast(fine), "archive"), TEXT_COLUMNS[base], injection)
    typed = L.TRANSFORMS[base](guarded, keep=["period"]).withColumn("run", F.lit(run))
    typed.hint("rebalance", "period").write.mode("append").partitionBy("period", "run").parquet(f"{root}/tables/{base}")
    bad.withColumns({"base": F.lit(base), "run": F.lit(run)}).write.mode("append").partitionBy("base", "run").parquet(f"{root}/rejects")
    # From here on the run's periods are visible.
    log = outcome.select(F.lit(run).alias("run_id"), "*", F.current_timestamp().alias("finished_at"))
    T.append_ingest_log(log, f"{root}/log")


def run_ingest(spark: SparkSession, landing: str, root: str, *, sep: str = ";", newest: int = 2, injection: str = "sanitize") -> DataFrame:
    """Load what is new in ``landing``; returns the log rows of this run.

    Per base the newest snapshot, the ``newest`` months and every older month without a success
    are candidates; those whose file is the one loaded last are left out. An archive is loaded
    whole or not at all: broken archives and wrong headers give a ``failed`` log row and are tried
    again by the next run, rows of a wrong length go to ``rejects``. Archives of unknown bases or
    with other names are not touched. All archives are read in one job; each base is
    committed by one append to the log.
    """
    run = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    log = read_log(spark, root)
    known = L.archive_inventory(L.list_files(spark, landing)).filter(F.col("base").isin(list(L.TRANSFORMS)))
    # One row per archive.
    todo = cut(L.changed_archives(L.select_archives(known, log, newest), log))
    bases = sorted(r["base"] for r in todo.select("base").distinct().collect())  # at most one per known header
    if bases:
        L.read_archives(todo, sep=sep).write.parquet(f"{root}/staged/{run}")
    for base in bases:
        _load_base(spark, root, run, base, todo, injection)
    return read_log(spark, root).filter(F.col("run_id") == run)
