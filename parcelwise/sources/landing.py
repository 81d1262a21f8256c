"""Landing files: archives, CSV reading, header contract, typing and row checks."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelwise.functions import columns as C
from parcelwise.functions.lineage import cut
from parcelwise.schemas import CUSTOMER, HEADERS, TYPED_KINDS

# --- fixed values: file name patterns
MONTHLY_ARCHIVE = r"^([A-Za-z_][A-Za-z0-9_]*)_(\d{4})\.zip$"
SNAPSHOT_ARCHIVE = r"^([A-Za-z_][A-Za-z0-9_]*)_update_(\d{6})\.zip$"
CSV_PART = r"^([A-Za-z_][A-Za-z0-9_]*)_(\d{4})_(\d{4})_(\d{4})\.csv$"
CONFIRMED_FILE = r"^Roi_bo_(\d{2})_(\d{2})\.csv$"
DELIMITERS = [",", ";", "\t", "|"]


# --------------------------------------------------------------------------
# reading and typing


def read_landing_csv(spark: SparkSession, path: str | list[str], *, sep: str = ";") -> DataFrame:
    """All columns as text, no inference. The byte-order mark is not part of the first name."""
    return spark.read.csv(path, sep=sep, header=True, encoding="UTF-8", quote='"', escape='"', multiLine=False)


def apply_header_contract(df: DataFrame, base: str) -> DataFrame:
    """Rename by position to the canonical header; a different column count fails."""
    expected = HEADERS.get(base)
    if expected is None:
        return df
    if len(df.columns) != len(expected):
        raise ValueError(f"{base}: {len(df.columns)} columns, expected {len(expected)}")
    return df.toDF(*expected)


def renamed_columns(df: DataFrame, base: str) -> list[tuple[int, str, str]]:
    """Positions whose file name differs from the canonical one."""
    return [(i, got, want) for i, (got, want) in enumerate(zip(df.columns, HEADERS[base])) if got != want]


def _typed(df: DataFrame, base: str, fallback: dict[str, list[str]] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    build = {
        "s": C.clean_string,
        "i": C.to_int,
        "d": C.to_decimal,
        "t": C.normalize_datetime,
        "m": C.report_month,
    }
    cols = []
    for name, kind in TYPED_KINDS[base].items():
        sources = [c for c in (fallback or {}).get(name, [name]) if c in df.columns]
        # The first source that is not empty counts.
        picked = [F.when(F.col(c) != "", F.col(c)) for c in sources[:-1]] + [F.col(c) for c in sources[-1:]]
        raw = F.coalesce(*picked) if picked else F.lit(None).cast("string")
        cols.append(build[kind](raw).alias(name))
    return df.select(*keep, *cols)


def typed_shipments(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _typed(df, "bccp_orderitem", {"item_code": ["item_code_enc", "item_code"]}, keep)


def typed_customer_month(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _typed(df, "cas_customer", keep=keep)


def typed_customer_info(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _typed(df, "cas_info", keep=keep)


def typed_complaints(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _typed(df, "cms_complaint", {"item_code": ["item_code", "item_code_enc"]}, keep)


TRANSFORMS = {
    "bccp_orderitem": typed_shipments,
    "cas_customer": typed_customer_month,
    "cas_info": typed_customer_info,
    "cms_complaint": typed_complaints,
}


def read_typed(spark: SparkSession, path: str | list[str], base: str) -> DataFrame:
    """Landing file to typed table."""
    return TRANSFORMS[base](apply_header_contract(read_landing_csv(spark, path), base))


# --------------------------------------------------------------------------
# row checks


def sniff_delimiter(lines: DataFrame, head: int | None = None) -> DataFrame:
    """Delimiter per file: the candidate whose smallest count over the lines is highest;
    the earlier candidate wins ties.

    ``lines`` has ``file, line_no, line``. All lines of a file count, or the first
    ``head`` ones where that is asked for; blank ones are skipped.
    """
    used = lines.filter(F.trim("line") != "")
    if head is not None:
        used = used.filter(F.col("line_no") <= head)
    counts = [(F.length("line") - F.length(F.replace(F.col("line"), F.lit(d), F.lit("")))).alias(f"d{i}") for i, d in enumerate(DELIMITERS)]
    smallest = used.select("file", *counts).groupBy("file").agg(*[F.min(f"d{i}").alias(f"d{i}") for i in range(len(DELIMITERS))])
    best = F.greatest(*[F.struct(F.col(f"d{i}").alias("n"), F.lit(-i).alias("o"), F.lit(d).alias("delimiter")) for i, d in enumerate(DELIMITERS)])
    found = smallest.select("file", best.alias("b"))
    names = lines.select("file").distinct()
    return names.join(found, "file", "left").select("file", F.coalesce("b.delimiter", F.lit(",")).alias("delimiter"))


def check_csv_rows(spark: SparkSession, path: str, base: str, *, sep: str = ",", has_header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Good rows, and ragged rows with their file, of a file or folder.

    With ``has_header`` every file must have a line of the canonical names; a file without
    one fails. A second such line of a file is a ragged row.
    """
    header = HEADERS[base]
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.ltrim(F.col("value"), F.lit("\ufeff")).alias("line"))
    lines = lines.filter(F.col("line") != "")
    repeated = lines.select("file", "line").limit(0)
    if has_header:
        named = F.replace(F.col("line"), F.lit('"'), F.lit("")) == sep.join(header)
        heads = lines.groupBy("file").agg(F.count_if(named).alias("n"), F.min(F.when(named, F.col("line"))).alias("line"))
        bad = heads.filter("n = 0").select("file").limit(3).collect()
        if bad:
            raise ValueError(f"{base}: no line with the expected names in {', '.join(r[0] for r in bad)}")
        repeated = heads.select("file", F.explode(F.array_repeat("line", (F.col("n") - 1).cast("int"))).alias("line"))
        lines = lines.filter(~named)
    ddl = ", ".join(f"`{c}` string" for c in [*header, "_bad"])
    options = {"sep": sep, "quote": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    rows = lines.select("file", "line", F.from_csv("line", ddl, options).alias("r"))
    ragged = rows.filter("r._bad is not null").select("file", "line")
    return rows.filter("r._bad is null").select(*[f"r.{c}" for c in header]), ragged.unionByName(repeated)


def guard_csv_injection(df: DataFrame, columns: Sequence[str], mode: str = "sanitize") -> DataFrame:
    """Defuse or reject text cells that a spreadsheet would run as a formula.

    ``sanitize`` puts a quote in front, ``text_only`` and ``strict`` fail on the
    first such cell (``strict`` also on ``+`` and ``-``), ``off`` does nothing.
    """
    if mode == "off":
        return df
    present = [c for c in columns if c in df.columns]
    pattern = "^[=@]" if mode in ("sanitize", "text_only") else "^[=@+-]"

    def guarded(c: str) -> Column:
        hit = F.col(c).rlike(pattern)
        if mode == "sanitize":
            return F.when(hit, F.concat(F.lit("'"), F.col(c))).otherwise(F.col(c))
        return F.when(hit, F.raise_error(F.lit("a text cell begins like a formula")).cast("string")).otherwise(F.col(c))

    return df.withColumns({c: guarded(c) for c in present})


# --------------------------------------------------------------------------
# archives


def list_files(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """Name, path, size and modification time, without reading contents."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "path", F.col("length").alias("file_size"),
        F.col("modificationTime").cast("double").alias("file_mtime"),
    )


def archive_inventory(files: DataFrame) -> DataFrame:
    """Base, mode, period and table of each archive name (``name``); NULL mode when invalid."""
    name = F.col("name")
    part = lambda p, i: F.regexp_extract(name, p, i)
    snapshot = name.rlike(SNAPSHOT_ARCHIVE)
    yymm = part(MONTHLY_ARCHIVE, 2)
    monthly = name.rlike(MONTHLY_ARCHIVE) & F.substring(yymm, 3, 2).try_cast("int").between(1, 12)
    stamp = part(SNAPSHOT_ARCHIVE, 2)
    base = F.when(snapshot, part(SNAPSHOT_ARCHIVE, 1)).when(monthly, part(MONTHLY_ARCHIVE, 1))
    key = F.when(
        snapshot, F.concat(F.lit("20"), F.substring(stamp, 5, 2), F.substring(stamp, 3, 2), F.substring(stamp, 1, 2))
    ).when(monthly, F.concat(F.lit("20"), yymm))
    return files.select(
        "*",
        base.alias("base"),
        F.when(snapshot, "snapshot").when(monthly, "monthly").alias("mode"),
        key.alias("period_key"),
        F.when(snapshot, base).when(monthly, F.concat_ws("_", base, yymm)).alias("table_name"),
    )


def order_csv_parts(files: DataFrame, base: str, year: int, month: int) -> DataFrame:
    """Parts with their position: valid ones by start day, the others last by name."""
    name = F.col("name")
    lower = F.lower(name)
    part = lambda i: F.regexp_extract(lower, CSV_PART.lower().replace("a-za-z", "a-z"), i)
    start, end = part(2), part(3)

    def day(c: Column) -> Column:
        return F.try_to_date(F.concat(part(4), c), "yyyyMMdd")

    inside = lambda d: (F.year(d) == year) & (F.month(d) == month)
    valid = F.coalesce((part(1) == base.lower()) & inside(day(start)) & inside(day(end)), F.lit(False))
    keyed = files.withColumn("valid", valid).withColumn("start", F.when(valid, start.try_cast("int")))
    # One month of one table: a handful of files.
    order = Window.partitionBy(F.lit(base)).orderBy(F.col("valid").desc(), "start", "name")
    return keyed.withColumn("position", F.row_number().over(order))


def select_archives(inventory: DataFrame, log: DataFrame, newest: int = 2) -> DataFrame:
    """Archives to load: the newest snapshot per base, the newest months, and every older
    month without a success in the log."""
    known = inventory.filter("mode is not null")
    recent = Window.partitionBy("base", "mode").orderBy(F.col("period_key").desc(), F.col("name").desc())
    ranked = known.withColumn("_rn", F.row_number().over(recent))
    done = log.filter("status = 'success'").select(F.col("zip_name").alias("name")).distinct().withColumn("_done", F.lit(True))
    joined = ranked.join(done, "name", "left")
    snapshot = (F.col("mode") == "snapshot") & (F.col("_rn") == 1)
    monthly = (F.col("mode") == "monthly") & ((F.col("_rn") <= newest) | F.col("_done").isNull())
    return joined.filter(snapshot | monthly).drop("_rn", "_done")


def changed_archives(inventory: DataFrame, log: DataFrame) -> DataFrame:
    """Archives that were never loaded or whose file changed since the last success."""
    latest = (
        log.filter("status = 'success'")
        .groupBy(F.col("zip_name").alias("name"))
        .agg(F.max(F.struct("finished_at", "file_mtime"))["file_mtime"].alias("_seen"))
    )
    return inventory.join(latest, "name", "left").filter(~F.col("file_mtime").eqNullSafe(F.col("_seen"))).drop("_seen")


ARCHIVE_ROWS = "archive string, member string, row_no bigint, cells array<string>, error string"


def extract_archives(spark: SparkSession, path: str, *, sep: str = ";") -> DataFrame:
    """CSV records of all archives of a folder; see :func:`read_archives`."""
    return read_archives(list_files(spark, path), sep=sep)


def read_archives(files: DataFrame, *, sep: str = ";") -> DataFrame:
    """CSV records of all members of the archives ``files(path)``: ``archive, member, row_no, cells, error``.

    Only paths are shuffled. One step reads the directory of each archive, the next one streams
    every member where it lies, so members of one large archive are read by several tasks and
    neither an archive nor a member is held in memory. There is a task per member: adaptive execution
    judges by the few bytes of the paths and would join members into a few tasks, so their number is given.
    Quoted line breaks stay inside their cell.
    What cannot be read (a broken archive, bytes that are no UTF-8) becomes a row with ``error``
    after the rows read before it. An archive without CSV members has one row without a member.
    """
    members = cut(files.select("path").repartition("path").mapInPandas(_members, "path string, member string, error string"))
    return members.repartition(max(1, members.count())).mapInArrow(lambda batches: _unzip(batches, sep), ARCHIVE_ROWS)


_READ_ERRORS = (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError, ValueError, csv.Error)


def _open(path: str):
    system, place = fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path in pdf["path"]:
            try:
                with _open(path) as raw, zipfile.ZipFile(raw) as z:
                    found = sorted({n for n in z.namelist() if n.lower().endswith(".csv")})
                rows = [(path, name, None) for name in found] or [(path, None, None)]
            except _READ_ERRORS as error:
                rows = [(path, None, f"{type(error).__name__}: {error}")]
            yield pd.DataFrame(rows, columns=["path", "member", "error"], dtype=object)


def _unzip(batches: Iterator[pa.RecordBatch], sep: str, chunk: int = 20_000) -> Iterator[pa.RecordBatch]:
    names, text = ["archive", "member", "row_no", "cells", "error"], pa.string()

    def rows(archive: str, member: str | None, first: int | None, cells: list, error: str | None = None) -> pa.RecordBatch:
        n = len(cells)
        numbers = range(first, first + n) if first is not None else [None] * n
        columns = [pa.array([archive] * n, text), pa.array([member] * n, text), pa.array(numbers, pa.int64()), pa.array(cells, pa.list_(text)), pa.array([error] * n, text)]
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        for path, member, broken in zip(*(batch.column(k).to_pylist() for k in ("path", "member", "error")), strict=True):
            archive, first, buffer, failed = unquote(path.rsplit("/", 1)[-1]), 1, [], None
            if member is None:
                yield rows(archive, None, None, [None], broken)
                continue
            try:
                with _open(path) as raw, zipfile.ZipFile(raw) as z:
                    with z.open(member) as data, io.TextIOWrapper(data, "utf-8-sig", newline="") as lines:
                        for cells in csv.reader(lines, delimiter=sep):
                            buffer.append(cells)
                            if len(buffer) >= chunk:
                                yield rows(archive, member, first, buffer)
                                first, buffer = first + len(buffer), []
            except _READ_ERRORS as error:
                failed = f"{type(error).__name__}: {error}"
            if buffer:
                yield rows(archive, member, first, buffer)
            if failed is not None:
                yield rows(archive, member, None, [None], failed)


def mark_rows(rows: DataFrame, base: str) -> DataFrame:
    """``rows`` with ``is_data`` (neither header nor blank) and the ``reason`` for which a record is rejected; see :func:`parse_rows`."""
    expected = HEADERS[base]
    known = F.array(*[F.lit(c.lower()) for c in expected])
    names = F.transform("cells", lambda c: F.lower(F.trim(c)))
    head = (F.col("row_no") == 1) & F.arrays_overlap(names, known)
    fits = F.size("cells") == len(expected)
    wrong = rows.filter(head & ~fits).select("archive", "member", F.lit(True).alias("_wrong"))  # one row per member at most
    blank = (F.size("cells") == 0) | F.coalesce((F.size("cells") == 1) & (F.trim(F.get("cells", F.lit(0))) == ""), F.lit(False))
    read = F.col("error").isNotNull() | F.col("cells").isNotNull()
    data = read & (F.col("error").isNotNull() | ~(F.coalesce(head & fits, F.lit(False)) | blank))
    reason = (
        F.when(F.col("error").isNotNull(), "unreadable").when(F.col("_wrong"), "header").when(~fits, "cells")
    )
    # The records stay where they are: no shuffle of them for a flag per member.
    joined = rows.join(F.broadcast(wrong), ["archive", "member"], "left")
    return joined.select(*rows.columns, F.coalesce(data, F.lit(False)).alias("is_data"), reason.alias("reason"))


def parse_rows(rows: DataFrame, base: str) -> tuple[DataFrame, DataFrame]:
    """Good rows in canonical columns, and rejected rows with ``reason``.

    The first record of a member is its header if one of its cells is a canonical name. A
    header with another number of cells rejects its whole member (``header``), other records
    of a wrong length are rejected one by one (``cells``), unreadable parts as ``unreadable``.
    Blank records are skipped.
    """
    marked = mark_rows(rows, base).filter("is_data")
    good = marked.filter("reason is null").select("archive", "member", *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(HEADERS[base])])
    return good, marked.filter("reason is not null").select("archive", "member", "row_no", "cells", "error", "reason")


# --------------------------------------------------------------------------
# confirmed churners


def parse_confirmed(rows: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """Unique trimmed ids per file month from rows with ``cms_code_enc`` and ``source_file``.

    Months already loaded are skipped; files with another name are ignored.
    """
    if CUSTOMER not in rows.columns:
        raise ValueError(f"confirmed files must contain '{CUSTOMER}'; found {rows.columns}")
    month, year = (F.regexp_extract("source_file", CONFIRMED_FILE, i).try_cast("int") for i in (1, 2))
    ids = rows.select(F.trim(CUSTOMER).alias(CUSTOMER), month.alias("file_month"), year.alias("file_year"), "source_file")
    keyed = ids.filter("file_month is not null").groupBy(CUSTOMER, "file_month", "file_year").agg(F.min("source_file").alias("source_file"))
    if loaded is None:
        return keyed
    return keyed.join(loaded.select("file_month", "file_year").distinct(), ["file_month", "file_year"], "left_anti").select(*keyed.columns)


def load_confirmed(spark: SparkSession, path: str, loaded: DataFrame | None = None) -> DataFrame:
    """New confirmed ids of all ``Roi_bo_MM_YY.csv`` files in a folder."""
    rows = spark.read.option("pathGlobFilter", "*.csv").csv(path, header=True)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return parse_confirmed(rows.withColumn("source_file", name), loaded)
