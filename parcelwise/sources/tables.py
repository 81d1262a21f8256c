"""Feature-table and report-table readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.functions import columns as C
from parcelwise.schemas import REQUIRED_SOURCES


def load_snapshot(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").parquet(path)


def load_month(df: DataFrame, path: str, yymm: str) -> None:
    """Replace one month of a table partitioned by ``yymm``; other months stay."""
    (
        df.withColumn("yymm", F.lit(yymm))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("yymm")
        .parquet(path)
    )


def append_ingest_log(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)


def scan_months(table: DataFrame, start: str, end: str) -> DataFrame:
    """Whole months between two dates of a table partitioned by ``yymm``.

    The list of months is a literal, so only those partitions are read. Months are
    compared as numbers: readers infer ``0001`` as 1.
    """
    first, last = (int(d[:4]) * 12 + int(d[5:7]) - 1 for d in (start, end))
    return scan_month_list(table, [m // 12 % 100 * 100 + m % 12 + 1 for m in range(first, last + 1)])


def scan_month_list(table: DataFrame, months: Sequence[int]) -> DataFrame:
    """The given months (``YYMM`` numbers) of a table partitioned by ``yymm``; no others are read."""
    return table.filter(F.col("yymm").cast("int").isin(list(months)))


def scan_month_paths(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Monthly tables kept in separate paths as one table; absent columns are NULL."""
    parts = [spark.read.parquet(p) for p in paths]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, *, column: str, lower: str, upper: str, partitions: int, properties: dict | None = None
) -> DataFrame:
    """Read a database table in parallel ranges of ``column``."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=properties or {}
    )


def write_window_tables(features: DataFrame, path: str) -> None:
    """Write windows as partitions; a rewritten window replaces only itself.

    Rows are rebalanced by their window: adaptive execution splits a large window into tasks
    of the advised size and joins small ones, so files follow the data and no bucket count is set.
    """
    (
        features.hint("rebalance", "window_size", "window_end")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("window_size", "window_end")
        .parquet(path)
    )


def read_window(spark: SparkSession, path: str, window_size: int, window_end: str) -> DataFrame:
    """One window; partition values keep their text form."""
    rows = read_windows(spark, path)
    return rows.filter((F.col("window_size") == window_size) & (F.col("window_end") == window_end))


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """All windows. ``window_end`` is four digits of text, whatever the reader infers."""
    rows = spark.read.parquet(path)
    return rows.withColumn("window_end", F.lpad(F.col("window_end").cast("string"), 4, "0"))


def write_csv_with_header(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def validate_sources(tables: dict[str, DataFrame | None], required: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per failed requirement ``(table_name, column_name, problem)``.

    ``bccp_orderitem`` is also satisfied by any of its month tables.
    """
    spark = next(df for df in tables.values() if df is not None).sparkSession
    problems: list[tuple[str, str | None, str]] = []
    for name, columns in (required or REQUIRED_SOURCES).items():
        found = tables.get(name)
        if found is None and name == "bccp_orderitem":
            found = next((d for n, d in sorted(tables.items()) if n.startswith("bccp_orderitem_") and d is not None), None)
        if found is None:
            problems.append((name, None, "missing table"))
            continue
        problems += [(name, c, "missing column") for c in columns if c not in found.columns]
    return spark.createDataFrame(problems, "table_name string, column_name string, problem string")


def require_sources(tables: dict[str, DataFrame | None], required: dict[str, list[str]] | None = None) -> None:
    """Raise with every failure listed."""
    rows = validate_sources(tables, required).collect()  # one row per declared column at most
    if rows:
        raise ValueError("; ".join(f"{r.problem}: {r.table_name}" + (f".{r.column_name}" if r.column_name else "") for r in rows))


def table_status(tables: dict[str, DataFrame | None]) -> DataFrame:
    """HAS DATA, EMPTY or MISSING and the row count per table."""
    spark = next(df for df in tables.values() if df is not None).sparkSession
    parts = []
    for name, df in sorted(tables.items()):
        if df is None:
            parts.append(spark.range(1).select(F.lit(name).alias("table_name"), F.lit("MISSING").alias("status"), F.lit(None).cast("bigint").alias("row_count")))
            continue
        n = df.agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(n.select(F.lit(name).alias("table_name"), F.when(F.col("row_count") > 0, "HAS DATA").otherwise("EMPTY").alias("status"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_month_partitions(df: DataFrame, path: str, time_column: str) -> None:
    """Write rows into ``yymm`` partitions by a time column, replacing those months."""
    (
        df.withColumn("yymm", C.month_key(F.col(time_column)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("yymm")
        .parquet(path)
    )


def empty_windows(specs: DataFrame, features: DataFrame) -> DataFrame:
    """Planned windows without rows."""
    built = features.select("window_size", "window_end").distinct()
    return specs.select("window_size", "window_start", "window_end").join(built, ["window_size", "window_end"], "left_anti")
