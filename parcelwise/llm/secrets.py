"""Secrets by pattern and by a battery of randomness tests, as DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parcelwise.llm.common import empty, store
from parcelwise.llm.spans import SPAN, add_matches, by_start, written

KINDS = ["assign", "access", "hex"]
# The contract's patterns; possessive tails keep each scan linear.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++"""
ASSIGN_HEAD = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
#: Tokens that the battery tests.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"

HEX_DIGITS = "0123456789abcdef"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
LOWER, UPPER, DIGITS = BASE64[26:52], BASE64[:26], BASE64[52:62]
#: Alphabets by name; the narrowest that holds a token is tested.
ENCODINGS = {
    "hex": HEX_DIGITS,
    "lower": LOWER,
    "upper": UPPER,
    "base32": BASE32,
    "lower36": DIGITS + LOWER,
    "upper36": DIGITS + UPPER,
    "letters": UPPER + LOWER,
    "base62": UPPER + LOWER + DIGITS,
    "base64": BASE64,
}
#: Shares of lower case, capitals, digits and the rest in ordinary tokens, where the corpus has few; they weigh as PRIOR_SYMBOLS symbols.
PRIOR = {"a-z": 0.90, "A-Z": 0.05, "0-9": 0.04, "+/": 0.01}
PRIOR_SYMBOLS = 64
#: Percent of the letters a to z in English text, which deals out the shares of letters.
ENGLISH = [8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074]
#: A test of the battery rejects randomness below this probability, shared among its three tests.
ALPHA = 0.003
#: Share of ordinary tokens that may be among the findings of a length band.
FALSE_DISCOVERIES = 0.01
#: Lower ends of the length bands in which false discoveries are controlled.
BANDS = [20, 24, 32, 48, 64]


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal; the rational approximation 26.2.17 of Abramowitz and Stegun (fixed values)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-z * z / 2) * 0.3989422804014327 * series
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def _encoding(value: Column) -> Column:
    """The narrowest alphabet that holds a token; NULL for tokens without letters."""
    narrow = F.when(_mixed(value) & value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "hex")
    forms = {"lower": "[a-z]", "upper": "[A-Z]", "base32": "[A-Z2-7]", "lower36": "[0-9a-z]", "upper36": "[0-9A-Z]", "letters": "[A-Za-z]", "base62": "[0-9A-Za-z]"}
    for name, symbols in forms.items():
        narrow = narrow.when(value.rlike(f"^{symbols}+=*$"), name)
    return F.when(value.rlike("[A-Za-z]"), narrow.otherwise("base64"))


def _by_encoding(values: dict[str, object]) -> Column:
    out = F.lit(values["base64"])
    for name, value in values.items():
        out = F.when(F.col("encoding") == name, F.lit(value)).otherwise(out)
    return out


def battery(tokens: DataFrame) -> DataFrame:
    """Adds ``p_uniform``, ``p_runs`` and ``p_serial`` to rows with ``value`` and ``encoding``.

    Chi-squared against the uniform distribution over the alphabet (Wilson-Hilferty), runs
    above and below its middle, and lag-one serial correlation of the symbol numbers. Each
    is the probability of so large a deviation in random symbols; 0 where all symbols lie on
    one side of the middle or are the same, so that runs or correlation are not defined.
    """
    alphabet = _by_encoding(ENCODINGS)
    plain = F.translate(F.rtrim(F.col("value"), F.lit("=")), "-_", "+/")
    plain = F.when(F.col("encoding") == "hex", F.lower(plain)).otherwise(plain)
    rows = tokens.withColumns({"_alphabet": alphabet, "_plain": plain})
    place = F.transform(F.filter(F.split("_plain", ""), lambda c: c != ""), lambda c: F.position(c, F.col("_alphabet")))
    rows = rows.withColumn("_at", place).withColumns({"_n": F.length("_plain").cast("double"), "_k": F.length("_alphabet").cast("double")})
    at, n, k = F.col("_at"), F.col("_n"), F.col("_k")
    zero = F.lit(0.0)
    squares = F.aggregate(F.array_distinct(at), zero, lambda acc, s: acc + F.pow(F.size(F.filter(at, lambda x: x == s)).cast("double"), F.lit(2.0)))
    mean = F.aggregate(at, zero, lambda acc, x: acc + x) / n
    rows = rows.withColumns({"_squares": squares, "_mean": mean})
    high = F.transform(at, lambda x: (x > k / 2).cast("int"))
    rows = rows.withColumn("_high", high).withColumn("_ones", F.aggregate("_high", F.lit(0), lambda acc, x: acc + x).cast("double"))
    changes = F.aggregate(F.zip_with(F.slice("_high", F.lit(2), F.size("_high")), F.slice("_high", F.lit(1), F.size("_high") - 1), lambda x, y: F.abs(x - y)), F.lit(0), lambda acc, x: acc + x)
    m = F.col("_mean")
    centred = F.transform(at, lambda x: x - m)
    rows = rows.withColumns({"_runs": (changes + 1).cast("double"), "_c": centred})
    products = F.aggregate(F.zip_with(F.slice("_c", F.lit(2), F.size("_c")), F.slice("_c", F.lit(1), F.size("_c") - 1), lambda x, y: x * y), zero, lambda acc, x: acc + x)
    power = F.aggregate("_c", zero, lambda acc, x: acc + x * x)
    rows = rows.withColumns({"_products": products, "_power": power})
    chi, df = F.col("_squares") * k / n - n, k - 1
    z_chi = (F.pow(F.greatest(chi, zero) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    ones, zeros = F.col("_ones"), n - F.col("_ones")
    expected = 2 * ones * zeros / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    z_runs = F.when(variance > 0, F.abs(F.col("_runs") - expected) / F.sqrt(F.greatest(variance, F.lit(1e-9))))
    z_serial = F.when(F.col("_power") > 0, F.abs(F.col("_products") / F.greatest(F.col("_power"), F.lit(1e-9)) * F.sqrt(n) + 1 / F.sqrt(n)))
    p = {"p_uniform": _upper_tail(z_chi), "p_runs": F.coalesce(2 * _upper_tail(z_runs), zero), "p_serial": F.coalesce(2 * _upper_tail(z_serial), zero)}
    return rows.withColumns(p).drop("_alphabet", "_plain", "_at", "_n", "_k", "_squares", "_mean", "_high", "_ones", "_runs", "_c", "_products", "_power")


def _log_shares(tokens: DataFrame) -> list[float]:
    """Log share of each of the 64 symbols in ordinary tokens (plain words that fail the battery), smoothed by the prior."""
    plain = tokens.where(~_mixed(F.col("value")) & ~F.coalesce("random", F.lit(False))).select(F.translate(F.rtrim(F.col("value"), F.lit("=")), "-_", "+/").alias("v"))
    symbols = plain.select(F.explode_outer(F.split("v", "")).alias("c")).where("c <> ''").groupBy("c").count()
    found = {r["c"]: r["count"] for r in symbols.collect()}  # at most 64 rows

    def prior(c: str) -> float:
        kind, size = ("a-z", 26) if c.islower() else ("A-Z", 26) if c.isupper() else ("0-9", 10) if c.isdigit() else ("+/", 2)
        share = ENGLISH[ord(c.lower()) - 97] / sum(ENGLISH) if c.isalpha() else 1 / size
        return PRIOR[kind] * share * PRIOR_SYMBOLS

    total = sum(found.values()) + PRIOR_SYMBOLS
    return [math.log((found.get(c, 0) + prior(c)) / total) for c in BASE64]


def judge_tokens(values: DataFrame) -> DataFrame:
    """``(value, encoding)`` of the distinct ``value`` rows that are random.

    A finding passes every test of the battery at ALPHA / 3 under its encoding, and is not an
    ordinary token: the likelihood ratio of uniform symbols against the symbol shares of the
    corpus's plain words gives the p-value ``1 / ratio`` (Markov's bound), which shrinks with
    length. Within each length band the Benjamini-Hochberg rule keeps the expected share of
    ordinary tokens among the findings under FALSE_DISCOVERIES; p-values are rounded up to
    tenths of a decade, so the rule needs only a table of bands and tenths.
    """
    passed = F.least("p_uniform", "p_runs", "p_serial") >= ALPHA / 3
    tokens = battery(values.select("value", _encoding(F.col("value")).alias("encoding"))).select("value", "encoding", passed.alias("random"))
    tokens = store(tokens, "tokens")
    shares = F.array(*[F.lit(x) for x in _log_shares(tokens)])
    tested = tokens.where("encoding is not null")
    plain = F.translate(F.rtrim(F.col("value"), F.lit("=")), "-_", "+/")
    plain = F.when(F.col("encoding") == "hex", F.lower(plain)).otherwise(plain)
    chars = F.filter(F.split(plain, ""), lambda c: c != "")
    ordinary = F.aggregate(chars, F.lit(0.0), lambda acc, c: acc + F.get(shares, F.position(c, F.lit(BASE64)) - 1))
    size = _by_encoding({name: float(len(symbols)) for name, symbols in ENCODINGS.items()})
    decades = (-F.length(plain) * F.log(size) - ordinary) / math.log(10)
    band = sum(((F.length("value") >= b).cast("int") for b in BANDS[1:]), F.lit(0))
    judged = tested.select("value", "encoding", "random", F.floor(F.least(F.greatest(decades, F.lit(0.0)), F.lit(300.0)) * 10).cast("int").alias("tenth"), band.alias("band"))
    judged = store(judged, "judged")
    table = judged.groupBy("band", "tenth").agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy("band").orderBy(F.desc("tenth"))
    ranked = table.select("band", "tenth", F.sum("n").over(down).alias("rank"), F.sum("n").over(Window.partitionBy("band")).alias("m"))
    allowed = ranked.where(F.pow(F.lit(10.0), -F.col("tenth") / 10) <= F.lit(FALSE_DISCOVERIES) * F.col("rank") / F.col("m"))
    least = allowed.groupBy("band").agg(F.min("tenth").alias("least"))
    return judged.join(F.broadcast(least), "band").where(F.col("random") & (F.col("tenth") >= F.col("least"))).select("value", "encoding")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, assign, access, hex, random)``: one row per row of ``docs`` with its spans by kind.

    ``random`` holds the battery's findings outside the base spans. NULL and empty texts
    have none; repeated rows, ties and NULL ids are rows like any other; further columns are
    not read. Texts are scanned once; only distinct tokens and narrow rows are shuffled, and
    a token that many documents share is judged once.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    rows = add_matches(rows, "_assign", "assign", "_text", ASSIGN, F.col("_text").rlike("[:=]"))
    rows = add_matches(rows, "access", "access", "_text", ACCESS, F.contains("_text", F.lit("AKIA")))
    rows = add_matches(rows, "hex", "hex", "_text", HEX, F.length("_text") >= 24)
    rows = add_matches(rows, "_token", "random", "_text", TOKEN, F.length("_text") >= 20)
    rows = rows.withColumn("assign", F.filter("_assign", lambda s: F.length(F.regexp_replace(s["value"], ASSIGN_HEAD, "")) >= 6))
    base = F.concat("assign", "access", "hex")
    free = F.filter("_token", lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    held = store(rows.select(F.monotonically_increasing_id().alias("_at"), "doc_id", "assign", "access", "hex", free.alias("_token")), "spans")
    tokens = held.select("_at", F.explode("_token").alias("span"))
    secret = judge_tokens(tokens.select(F.col("span.value").alias("value")).distinct())
    chosen = store(tokens.join(secret, F.col("span")["value"] == F.col("value")).groupBy("_at").agg(F.sort_array(F.collect_list("span")).alias("random")), "chosen")
    return held.join(chosen, "_at", "left").select("doc_id", "assign", "access", "hex", F.coalesce("random", empty(SPAN)).alias("random"))


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts per kind, the digest of the base spans and all spans of every row."""
    found = find_secrets(docs, id_col, text_col)
    rows = found.withColumn("_base", by_start(F.concat(*KINDS), KINDS))
    return rows.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(written(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        written(by_start(F.concat("_base", "random"), [*KINDS, "random"])).alias("spans"),
    )
