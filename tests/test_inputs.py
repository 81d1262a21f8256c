"""Shared inputs of the catalogue: what is stored, and that one window alone equals its part of all windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog.inputs import Inputs
from parcelwise.operators import features as X

FIRST, LAST = "2000-11-01", "2001-07-31"


@pytest.fixture(scope="module")
def own(spark):
    rows, codes = [], []
    for n in range(240):
        sent = dt.datetime(2000, 11, 1) + dt.timedelta(days=(n * 37) % 273, hours=13 * (n % 3 == 0))
        who = None if n % 60 == 7 else f"{'T' if n % 5 == 0 else 'C'}{n % 11:08d}"
        rows.append((who, f"i{n}", "CEMPRULQ"[n % 8], float(n % 9) + 0.5, n * 13 % 400, n % 2, sent, n % 4, n % 3 % 2, n % 3 % 2, n % 7 % 2, 0, n % 17 % 2, n % 6 % 2, float(n % 5) if n % 4 else None))
        codes.append((who, 114 + n % 3, sent))
    # The edges of a window's months: its first moment, its last one and the first of the next month.
    for k, edge in enumerate([dt.datetime(2001, 3, 1), dt.datetime(2001, 5, 31), dt.datetime(2001, 5, 31, 23, 59), dt.datetime(2001, 6, 1), dt.datetime(2001, 7, 31), dt.datetime(2001, 7, 31, 9)]):
        rows.append(("C00000001", f"e{k}", "C", 1.0, 5, 1, edge, 0, 1, 1, 0, 0, 0, 1, 2.0))
        codes.append(("C00000001", 115, edge))
    ddl = (
        "cms_code_enc string, item_code string, service_code string, weight_kg double, total_fee int, is_domestic int, sending_time timestamp_ntz, delay_day int, "
        "done int, rec_success int, refunded int, no_accepted int, lost_order int, total_complaint int, order_score double"
    )
    i = Inputs(spark, "no folder", keep=True, first=FIRST, last=LAST)
    i.__dict__["shipments"] = spark.createDataFrame(rows, ddl)
    i.__dict__["complaints"] = spark.createDataFrame(codes, "cms_code_enc string, complaint_code int, create_complaint_date timestamp_ntz")
    return i


def test_wide_frames_are_not_stored(own):
    """All customer-months and windows stored for one column or one window filled the disks."""
    for name in ("customer_month", "monthly", "base", "features"):
        level = getattr(own, name).storageLevel
        assert not (level.useMemory or level.useDisk), name


def test_one_window_equals_its_part_of_all(own):
    for end in ("0105", "0107"):
        alone, part = own.window(end), own.features.filter((F.col("window_size") == 3) & (F.col("window_end") == end))
        assert alone.columns == part.columns and alone.count() == part.count() > 5
        rounded = lambda df: df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
        assert rounded(alone).exceptAll(rounded(part)).isEmpty() and rounded(part).exceptAll(rounded(alone)).isEmpty()


def test_tasks_get_bounded_parts(spark, own):
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert own.shipments.transform(X.by_customer).rdd.getNumPartitions() > usual
