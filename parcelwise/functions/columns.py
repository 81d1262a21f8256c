"""Scalar column builders: cleaning, casting, calendar and label helpers.

All builders return native Spark columns, so they stay inside code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelwise.schemas import SERVICES

# --- fixed values: words that mean "no value"
NULL_WORDS_TEXT = ["", "NULL", "NAN", "N/A", "NONE", "#N/A"]
NULL_WORDS_INT = ["", "NULL", "NAN", "N/A", "NONE"]
NULL_WORDS_DECIMAL = ["", "NULL", "NAN", "N/A"]
TRUE_WORDS = ["T", "TRUE", "Y", "YES", "1"]
FALSE_WORDS = ["F", "FALSE", "N", "NO", "0"]

# Any accepted date: three number fields with one separator, then perhaps a time.
DATE_SHAPE = r"^(\d{1,4})([-/])(\d{1,2})\2(\d{1,4})(?:\s+(\d{1,2}):(\d{1,2}):(\d{1,2})(\.\d{1,6})?)?$"


def clean_string(c: Column) -> Column:
    """Trimmed text; NULL when blank or a null word."""
    t = _strip(c)
    return F.when(~F.upper(t).isin(NULL_WORDS_TEXT), t)


def to_int(c: Column) -> Column:
    """Integer from loose text: truth words become 1 or 0, other marks are stripped."""
    t = F.upper(_strip(c))
    digits = F.regexp_replace(t, r"[^0-9\-]", "")
    return (
        F.when(t.isin(NULL_WORDS_INT), None)
        .when(t.isin(TRUE_WORDS), F.lit(1).cast("bigint"))
        .when(t.isin(FALSE_WORDS), F.lit(0).cast("bigint"))
        .otherwise(digits.try_cast("bigint"))
    )


def to_decimal(c: Column, scale: int = 3) -> Column:
    """Decimal of fixed scale from loose text; a comma counts as decimal point."""
    t = F.upper(_strip(c))
    digits = F.regexp_replace(F.replace(t, F.lit(","), F.lit(".")), r"[^0-9.\-]", "")
    return F.when(~t.isin(NULL_WORDS_DECIMAL), digits.try_cast("double").try_cast(f"decimal(38,{scale})"))


def normalize_datetime(c: Column) -> Column:
    """Timestamp (no zone) from loosely written text; else NULL.

    Fields are year-month-day or day-month-year, with ``-`` or ``/`` and an
    optional time. A four-digit year decides the order; with two-digit years the
    year-first reading wins when it is a real date. Two-digit years 69..99 belong
    to 19xx. A fraction of a second is only read after ``yyyy-m-d`` and dropped.
    """
    t = _strip(c)
    # One match cuts a text into its eight fields; a ninth takes what ``$`` leaves behind.
    fields = F.split(F.regexp_replace(t, DATE_SHAPE, "".join(f"${i}\u0001" for i in range(1, 9))), "\u0001")
    # One bound value: every field is matched once, and the code of a wide table stays small.
    return F.get(F.transform(F.array(F.when(t.rlike(DATE_SHAPE), fields)), lambda p: _stamp(*[F.get(p, F.lit(i)) for i in range(8)])), F.lit(0))


def _stamp(a: Column, sep: Column, b: Column, z: Column, hour: Column, minute: Column, second: Column, fraction: Column) -> Column:
    def stamp(year: Column, month: Column, day: Column) -> Column:
        # A text that is no number costs an exception, so an absent time is not cast.
        time = [F.when(x == "", 0).otherwise(x.try_cast("int")) for x in (hour, minute, second)]
        day = F.when(F.length(day) <= 2, day.try_cast("int"))
        return F.try_make_timestamp_ntz(year, month.try_cast("int"), day, time[0], time[1], time[2])

    def century(year: Column) -> Column:
        y = F.when(F.length(year) == 2, year.try_cast("int"))
        return F.when(y >= 69, y + 1900).otherwise(y + 2000)

    full_year_first = F.when((fraction == "") | (sep == "-"), stamp(a.try_cast("int"), b, z))
    plain = F.when(F.length(z) == 4, stamp(z.try_cast("int"), b, a)).otherwise(
        F.coalesce(stamp(century(a), b, z), stamp(century(z), b, a))
    )
    parsed = F.when(F.length(a) == 4, full_year_first).when(fraction == "", plain)
    return F.when((F.length(a) > 0) & (~hour.isin("24") & ~second.isin("60")), parsed)


def report_month(c: Column) -> Column:
    """Date part of a loose timestamp."""
    return F.to_date(normalize_datetime(c))


def pseudonymize(c: Column, salt: str) -> Column:
    """Stable one-way code of an identifier; case and outer blanks do not matter."""
    t = F.upper(_strip(c))
    digest = F.substring(F.md5(F.concat(t, F.lit(salt)).cast("binary")), 1, 16)
    return F.when(F.length(t) > 0, F.concat(F.lit("ENC_"), F.upper(digest)))


def clean_complaint_text(c: Column) -> Column:
    """Complaint text without 8-digit runs, line breaks and doubled backslashes."""
    blanked = F.regexp_replace(c, r"\d{8}|\\n|\\r\\n|\\r|[\r\n  ]|\\\\", " ")
    squeezed = _strip(F.regexp_replace(blanked, r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+", " "))
    return F.when(F.length(squeezed) > 0, squeezed)


def month_key(d: Column) -> Column:
    """``YYMM`` text of a date."""
    return F.date_format(d, "yyMM")


def month_number(d: Column) -> Column:
    """``YYMM`` of a date as a number."""
    return ((F.year(d) % 100) * 100 + F.month(d)).cast("bigint")


def month_index(d: Column) -> Column:
    """Months since year 0, so that differences count calendar months."""
    return F.year(d) * 12 + F.month(d) - 1


def index_to_date(i: Column) -> Column:
    """First day of the month with this month index."""
    return F.make_date(F.floor(i / 12).cast("int"), (i % 12 + 1).cast("int"), F.lit(1))


def index_to_number(i: Column) -> Column:
    """``YYMM`` number of a month index."""
    return ((F.floor(i / 12) % 100) * 100 + i % 12 + 1).cast("bigint")


def yymm_diff(a: Column, b: Column) -> Column:
    """Months from ``b`` to ``a``, both ``YYMM`` numbers."""
    months = lambda k: F.floor(k / 100) * 12 + k % 100
    return (months(a) - months(b)).cast("int")


def yymm_to_date(k: Column) -> Column:
    """First day of a ``YYMM`` month in this century."""
    k = k.cast("int")
    return F.make_date(F.floor(k / 100).cast("int") + 2000, k % 100, F.lit(1))


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def month_end(d: Column) -> Column:
    return F.last_day(d)


def tenure_months(asof: Column, start: Column) -> Column:
    """Whole months between two dates, counted on the calendar day."""
    months = 12 * (F.year(asof) - F.year(start)) + F.month(asof) - F.month(start)
    short = F.dayofmonth(asof) < F.dayofmonth(start)
    # Negative spans round towards zero, like a calendar age.
    late = F.dayofmonth(asof) > F.dayofmonth(start)
    return F.when((asof >= start) & short, months - 1).when((asof < start) & late, months + 1).otherwise(months).cast("int")


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def is_corporate(code: Column) -> Column:
    return code.startswith("T")


def safe_ratio(n: Column, d: Column) -> Column:
    """``n / d`` as double, 0 where undefined."""
    return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))


def dominant_label(cols: Sequence[Column], *, zero: str | None = None, otherwise: str = "E") -> Column:
    """Letter of the largest service total; ties go to the earlier letter.

    ``zero`` is the letter when the largest total is 0, ``otherwise`` the one
    when all totals are NULL.
    """
    top = F.greatest(*cols)
    chain = F.when(top == 0, F.lit(zero)) if zero is not None else None
    for letter, c in zip(SERVICES, cols):
        hit, label = c == top, F.lit(letter.upper())
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(F.lit(otherwise))


def count_positive(cols: Sequence[Column]) -> Column:
    total = F.lit(0)
    for c in cols:
        total = total + F.when(c > 0, 1).otherwise(0)
    return total.cast("int")


def code_flag(c: Column, value: str) -> Column:
    """1 where the code equals ``value`` regardless of case, else 0."""
    return F.when(F.upper(F.coalesce(c, F.lit(""))) == value, 1).otherwise(0)


def rate_bucket(rate: Column) -> Column:
    return F.when(rate >= 90, "90-100%").when(rate >= 80, "80-90%").when(rate >= 70, "70-80%").otherwise("<70%")


def risk_level(rate: Column) -> Column:
    return F.when(rate >= 90, "Critical").when(rate >= 80, "High").when(rate >= 70, "Medium").otherwise("Low")


def severity(psi: Column) -> Column:
    """Stability label; an unknown index is an alert."""
    return F.when(psi.isNull() | (psi > 0.2), "ALERT").when(psi > 0.1, "WARN").otherwise("OK")


def iv_strength(iv: Column) -> Column:
    return (
        F.when(iv < 0.02, "useless")
        .when(iv < 0.10, "weak")
        .when(iv < 0.30, "medium")
        .when(iv < 0.50, "strong")
        .otherwise("suspicious")
    )


def similarity(d2: Column, s2: Column) -> Column:
    """Gaussian similarity of a squared distance."""
    x = -F.greatest(d2, F.lit(0.0)) / (F.greatest(s2, F.lit(1e-9)) * 2)
    return F.exp(F.greatest(F.least(x, F.lit(0.0)), F.lit(-700.0)))


def smooth_label(y: Column, eps: Column) -> Column:
    return (F.lit(1.0) - eps) * y + eps * 0.5


def finite_double(c: Column) -> Column:
    """Double, with text that is no number, NaN and infinities as NULL."""
    d = c.try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def tier_label(recency_days: Column, active: int = 90, at_risk: int = 180) -> Column:
    return F.when(recency_days <= active, "active").when(recency_days <= at_risk, "at_risk").otherwise("churned")


def hash_order(id_col: Column, seed: int | str) -> Column:
    """Text whose order shuffles ids reproducibly."""
    return F.md5(F.concat(id_col.cast("string"), F.lit(f":{seed}")).cast("binary"))


def _strip(c: Column) -> Column:
    """Trim all white space, not only blanks."""
    # Behind a line end that is no white space the pattern trims before it, too; all else is a plain trim.
    odd = F.right(c, F.lit(1)).isin("\u0085", "\u2028", "\u2029")
    return F.when(odd, F.regexp_replace(c, r"^\s+|\s+$", "")).otherwise(F.trim(c, F.lit(" \t\n\x0b\f\r")))
