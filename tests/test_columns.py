import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelwise.functions import columns as C
from parcelwise.functions.tdist import two_sided_p


def apply(spark, values, build, ddl="s string"):
    rows = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in rows.select(build(F.col("s"))).collect()]


def test_clean_string(spark):
    assert apply(spark, [" x ", "", "null", "N/A", "none", "#N/A", None], C.clean_string) == ["x"] + [None] * 6


def test_to_int(spark):
    got = apply(spark, ["t", "F", "yes", "1,234", "12.5", "-7", "1-2", "-", "N/A"], C.to_int)
    assert got == [1, 0, 1, 1234, 125, -7, None, None, None]


def test_to_decimal(spark):
    got = apply(spark, ["1,5", "1.234.5", "abc", "12kg", "-0,0005"], lambda c: C.to_decimal(c).cast("double"))
    assert got == [1.5, None, None, 12.0, -0.001]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2025-11-20 11:40:30.209324", dt.datetime(2025, 11, 20, 11, 40, 30)),
        ("20-01-01 00:00:00", dt.datetime(2020, 1, 1)),
        ("31-12-24", dt.datetime(2031, 12, 24)),
        ("70-01-01", dt.datetime(1970, 1, 1)),
        ("68-01-01", dt.datetime(2068, 1, 1)),
        ("01/13/20", None),
        ("25/01/20", dt.datetime(2025, 1, 20)),
        ("32/01/20", dt.datetime(2032, 1, 20)),
        ("31/02/20", dt.datetime(2031, 2, 20)),
        ("31-02-2020", None),
        ("01-12-2025 1:2:3", dt.datetime(2025, 12, 1, 1, 2, 3)),
        ("2025/1/2", dt.datetime(2025, 1, 2)),
        ("2025-13-01", None),
        ("2025-01-01 24:00:00", None),
        ("2025/01/01 10:00:00.5", None),
        ("nan", None),
    ],
)
def test_normalize_datetime(spark, text, want):
    assert apply(spark, [text], C.normalize_datetime) == [want]


def test_pseudonymize(spark):
    a, b, c, blank = apply(spark, ["ab1", " AB1 ", "ab2", "  "], lambda x: C.pseudonymize(x, "salt"))
    assert a == b != c and a.startswith("ENC_") and len(a) == 20 and blank is None


def test_clean_complaint_text(spark):
    got = apply(spark, ["a 12345678 b", "123456789", "x\r\ny", "x\\ny", "a b", "   ", None], C.clean_complaint_text)
    assert got == ["a b", "9", "x y", "x y", "a b", None, None]


def test_months(spark):
    row = spark.sql("select 2501 a, 2412 b, date'2024-01-31' s, date'2024-02-28' e1, date'2024-02-29' e2").select(
        C.yymm_diff(F.col("a"), F.col("b")), C.yymm_to_date(F.col("a")), C.tenure_months(F.col("e1"), F.col("s")),
        C.tenure_months(F.col("e2"), F.col("s")), C.tenure_months(F.col("s"), F.col("s")),
        C.index_to_number(C.month_index(F.col("e1"))), C.index_to_date(C.month_index(F.col("e1"))),
    ).first()
    assert tuple(row) == (1, dt.date(2025, 1, 1), 0, 0, 0, 2402, dt.date(2024, 2, 1))


def test_dominant_and_counts(spark):
    rows = spark.createDataFrame([(0,) * 8, (1, 3, 3, 0, 0, 0, 0, 0), (None,) * 8], ", ".join(f"c{i} long" for i in range(8)))
    cols = [F.col(f"c{i}") for i in range(8)]
    got = rows.select(C.dominant_label(cols), C.dominant_label(cols, zero="U", otherwise="U"), C.count_positive(cols)).collect()
    assert [tuple(r) for r in got] == [("C", "U", 0), ("E", "E", 3), ("E", "U", 0)]


def test_levels(spark):
    row = spark.range(1).select(
        C.severity(F.lit(0.2)), C.severity(F.lit(0.21)), C.severity(F.lit(None).cast("double")), C.iv_strength(F.lit(0.5)),
        C.rate_bucket(F.lit(80)), C.similarity(F.lit(0.0), F.lit(1.0)), C.smooth_label(F.lit(1.0), F.lit(0.1)),
        C.safe_ratio(F.lit(1), F.lit(0)),
    ).first()
    assert tuple(row) == ("WARN", "ALERT", "ALERT", "suspicious", "80-90%", 1.0, pytest.approx(0.95), 0.0)


def test_student_t_tail():
    # Known two-sided tail areas.
    assert two_sided_p(0.0, 5) == pytest.approx(1.0)
    assert two_sided_p(2.228138852, 10) == pytest.approx(0.05, abs=1e-9)
    assert two_sided_p(12.7062047, 1) == pytest.approx(0.05, abs=1e-8)
    assert two_sided_p(1.959963985, 1e7) == pytest.approx(0.05, abs=1e-6)


ODD_TEXTS = [
    "2001/02/03", "03-02-2001", "2001-2-3 4:5:6", " 2001-02-03\t", "2001-02-03 ", "2001-02-03 \u0085", "2001-02-03\u2028", "x 2001-02-03", "2001-02/03", "\x012001\x01-\x012",
    "2001-02-03 04:05", "2001-02-03 24:00:00", "2001-02-03 04:05:06.", "2001-02-03 04:05:06.7", "", " ", "nan", None,
]


def test_dates_are_matched_once_and_absent_times_not_cast(spark):
    """Eight matches of a text, and an exception for each absent hour, minute and second, took most of the typing time."""
    fields = [F.regexp_extract(F.regexp_replace("s", r"^\s+|\s+$", ""), C.DATE_SHAPE, k) for k in range(1, 9)]
    rows = spark.createDataFrame([(v,) for v in ODD_TEXTS], "s string")
    typed = rows.select("s", C.normalize_datetime(F.col("s")).alias("got"), C._stamp(*fields).alias("want"))
    assert [r for r in typed.collect() if r["got"] != r["want"]] == []
    plan = rows.select(C.normalize_datetime(F.col("s")).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan


def test_plain_texts_are_trimmed_without_a_pattern(spark):
    rows = spark.createDataFrame([(v,) for v in [*ODD_TEXTS, "a \u2029", " \x0b a\f\r\n", "a\u0085 ", "\u0085", " \u0085", "\u00a0a "]], "s string")
    both = rows.select(C._strip(F.col("s")).alias("got"), F.regexp_replace("s", r"^\s+|\s+$", "").alias("want"))
    assert [r for r in both.collect() if r["got"] != r["want"]] == []
    assert "trim(" in rows.select(C._strip(F.col("s")))._jdf.queryExecution().optimizedPlan().toString()
