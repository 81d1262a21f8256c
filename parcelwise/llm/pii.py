"""Personal data and the terms that reveal it, as DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import empty, small_enough, split_words, store
from parcelwise.llm.spans import add_matches, by_start, redact, written

KINDS = ["email", "ip", "card", "phone"]
# The contract's patterns. Lookbehinds and possessive quantifiers keep each scan linear:
# a match can begin only at the start of a run or where the previous match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Runs of 16 to 19 digits; other runs fail the count anyway.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = "0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"

#: A term counts for an entity if fewer terms as frequent are expected to share so many texts with it by chance.
EXPECTED = 0.25
#: Bits of the entity that remain unknown given the term: at most the first, the term is removed; the second, generalised.
REMOVE_BITS, GENERALISE_BITS = 0.15, 1.0
#: Up to so many rows (terms, or documents with such terms) are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.translate(value, " -", ""))
    at = F.sequence(F.lit(1), F.length(digits))

    def add(acc, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(i % 2 == 0, doubled).otherwise(d)

    return F.aggregate(at, F.lit(0), add) % 10 == 0


def _n_digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def add_entities(docs: DataFrame, text_col: str) -> DataFrame:
    """``_row``, ``_text`` and one span array per kind."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("_row"), text.alias("_text"))
    rows = add_matches(rows, "_email", "email", "_text", EMAIL, F.contains("_text", F.lit("@")))
    rows = add_matches(rows, "_ip", "ip", "_text", IP, F.contains("_text", F.lit(".")))
    rows = add_matches(rows, "_card", "card", "_text", CARD, F.length("_text") > 15)
    rows = add_matches(rows, "_phone", "phone", "_text", PHONE, F.contains("_text", F.lit("+")))
    ip = F.filter("_ip", lambda s: s["value"].rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
    card = F.filter("_card", lambda s: _luhn(s["value"]))
    phone = F.filter("_phone", lambda s: _n_digits(s["value"]).between(8, 15))
    return rows.withColumns({"_ip": ip, "_card": card, "_phone": phone})


def _term(word: Column) -> Column:
    return F.lower(F.btrim(word, F.lit(".,;:!?()[]{}\"'")))


def _text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def _words_of(text: Column) -> Column:
    return F.array_distinct(split_words(F.coalesce(text.cast("string"), F.lit(""))))


def _terms_of(text: Column) -> Column:
    """The distinct terms of a whole text."""
    words = F.array_distinct(F.transform(split_words(F.coalesce(text.cast("string"), F.lit(""))), _term))
    return F.filter(words, lambda t: t.rlike(r"^\p{L}[\p{L}\p{N}_-]{2,}$"))


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series at n + 7 (fixed values; error below 1e-9)."""
    x = n.cast("double") + 7
    series = (x - 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3.0))) + 1 / (1260 * F.pow(x, F.lit(5.0)))
    return series - sum((F.log(x - d) for d in range(2, 7)), F.log(x - 1))


def _log_expected(n_pair: Column, n_term: Column, n_entity: Column, texts: int, held: int) -> Column:
    """ln of the number of terms in ``n_term`` texts that share ``n_pair`` with an entity by chance, at most.

    ``held`` (text, term) rows leave at most ``held / n_term`` such terms; a set of ``n_pair``
    of a term's texts lies within the entity's by the hypergeometric law.
    """
    f = _log_factorial
    sets = f(n_term) - f(n_pair) - f(n_term - n_pair)
    within = f(n_entity) - f(n_entity - n_pair) - f(F.lit(texts)) + f(F.lit(texts) - n_pair)
    return F.log(F.lit(float(max(held, 1))) / n_term) + sets + within


def strong_terms(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(term, action)``: the terms that reveal an entity.

    A term's strength is its pointwise mutual information with the entity over whole
    distinct texts; the entity's own information minus it is what stays unknown,
    ``-log2 p(entity | term)``. Copies of a text add nothing, and the co-occurrence must be
    more than chance (EXPECTED) instead of reaching a fixed count. Before the corpus count,
    entities and terms go whose counts alone rule that out; no result changes. All counts
    combine map-side.
    """
    limit = math.log(EXPECTED)
    sizes = docs.select(_text_key(F.col(text_col)).alias("key"), F.size(_words_of(F.col(text_col))).alias("n"))
    texts, held = sizes.groupBy("key").agg(F.first("n").alias("n")).agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    rows = add_entities(docs, text_col)
    spans = F.concat(*[F.col(f"_{k}") for k in KINDS])
    # The outer form keeps the filter above the matching; as a pushed filter it would be computed twice.
    near = rows.select("_text", F.explode_outer(spans).alias("s")).where("s is not null")
    near = near.select(_text_key(F.col("_text")).alias("key"), "_text", F.concat_ws(":", "s.kind", F.lower("s.value")).alias("entity"))
    near = near.groupBy("key").agg(F.collect_set("entity").alias("entities"), F.first("_text").alias("_text"))
    near = near.select("key", "entities", _terms_of(F.col("_text")).alias("terms"))
    near = store(near, "entity_texts")
    entity = near.select("key", F.explode("entities").alias("entity"))
    n = F.col("n_entity")
    often = entity.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).where(_log_expected(n, n, n, texts, held) <= limit)
    often = store(often, "entities")
    seen = near.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("seen"))
    of = entity.join(small_enough(often, BROADCAST_ROWS), "entity")
    pairs = of.groupBy("key").agg(F.collect_list("entity").alias("entity")).join(near.select("key", "terms"), "key")
    pairs = pairs.select(F.explode("entity").alias("entity"), "terms").select("entity", F.explode("terms").alias("term"))
    pair = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_pair"))
    # A term stands in at least as many texts as have it beside any entity.
    likely = F.col("n_pair") * 2.0**GENERALISE_BITS >= F.col("seen")
    chance = _log_expected(F.col("n_pair"), F.col("seen"), F.col("n_entity"), texts, held) <= limit
    pair = pair.join(seen, "term").where(likely).join(small_enough(often, BROADCAST_ROWS), "entity").where(chance)
    pair = store(pair.select("entity", "term", "n_pair", "n_entity"), "pairs")
    wanted = store(pair.select("term").distinct(), "terms")
    spread = docs.select(_text_key(F.col(text_col)).alias("key"), F.explode(_words_of(F.col(text_col))).alias("word")).select("key", _term(F.col("word")).alias("term"))
    counts = spread.join(small_enough(wanted, BROADCAST_ROWS), "term", "left_semi").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    unknown = -F.log2(F.col("n_pair") / F.col("n_term"))
    action = F.when(unknown <= REMOVE_BITS, "remove").when(unknown <= GENERALISE_BITS, "generalise")
    chance = _log_expected(F.col("n_pair"), F.col("n_term"), F.col("n_entity"), texts, held) <= limit
    strong = pair.join(counts, "term").where(chance).select("term", action.alias("action")).where("action is not null")
    return store(strong.groupBy("term").agg(F.max("action").alias("action")), "strong")


def _held_terms(docs: DataFrame, text_col: str) -> DataFrame:
    """``(key, terms)``: per distinct text, by its hash, the strong terms it holds."""
    strong = small_enough(strong_terms(docs, text_col), BROADCAST_ROWS)
    words = docs.select(_text_key(F.col(text_col)).alias("key"), F.explode(_words_of(F.col(text_col))).alias("word"))
    held = words.select("key", _term(F.col("word")).alias("term")).join(strong, "term").groupBy("key").agg(F.sort_array(F.collect_set(F.struct("term", "action"))).alias("terms"))
    return store(held, "disclosing")


def disclosing_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, terms)``: per document the terms it holds that reveal an entity, its own or another document's."""
    keyed = docs.select(F.col(id_col).alias("id"), _text_key(F.col(text_col)).alias("key")).where("id is not null")
    held = keyed.join(small_enough(_held_terms(docs, text_col), BROADCAST_ROWS), "key")
    return held.select("id", F.explode("terms").alias("term")).groupBy("id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_row``, ``_text``, the entity spans by kind and ``_terms``: spans of disclosing terms.

    NULL and empty texts have no spans. Terms are looked up by the text's hash, so every row
    gets those its text holds, whatever its id. Base spans do not depend on the terms. An empty table gives an empty result.
    """
    keyed = _held_terms(docs, text_col).select(F.col("key").alias("_key"), F.col("terms").alias("_known"))
    joined = docs.select(F.struct("*").alias("_in"), _text_key(F.col(text_col)).alias("_key")).join(small_enough(keyed, BROADCAST_ROWS), "_key", "left")
    rows = add_entities(joined.select("_in", "_known", F.col("_in")[text_col].alias("_t")), "_t")
    rows = rows.withColumn("_known", F.coalesce(F.col("_row")["_known"], empty("struct<term:string,action:string>")))
    quoted = F.transform("_known", lambda t: F.concat(F.lit("\\Q"), t["term"], F.lit("\\E")))
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}_-])(?:"), F.array_join(quoted, "|"), F.lit(r")(?![\p{L}\p{N}_-])"))
    rows = rows.withColumn("_pattern", pattern)
    rows = add_matches(rows, "_terms", "term", "_text", F.col("_pattern"), F.size("_known") > 0)
    return rows.withColumn("_row", F.col("_row")["_in"]).drop("_pattern")


def _label(known: str):
    """Placeholders: entities and removed terms by kind, generalised terms by their first letter."""

    def label(s: Column) -> Column:
        action = F.get(F.filter(F.col(known), lambda t: t["term"] == F.lower(s["value"])), F.lit(0))["action"]
        term = F.when(action == "generalise", F.concat(F.substring(s["value"], 1, 1), F.lit("*"))).otherwise(F.lit("<TERM>"))
        return F.when(s["kind"] == "term", term).otherwise(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))

    return label


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with entities and disclosing terms replaced in the text; all columns stay, NULL texts stay NULL."""
    rows = find_personal(docs, id_col, text_col)
    rows = rows.withColumn("_all", by_start(F.concat(*[F.col(f"_{k}") for k in [*KINDS, "terms"]]), [*KINDS, "term"]))
    rows = rows.withColumn("_clean", F.when(F.col("_row")[text_col].isNotNull(), redact(F.col("_text"), F.col("_all"), _label("_known"))))
    return rows.select(*[F.col("_clean").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])


def personal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts per kind, the digest of the base spans and all spans of every row."""
    rows = find_personal(docs, id_col, text_col)
    rows = rows.withColumn("_base", F.concat(*[F.col(f"_{k}") for k in KINDS]))
    counts = [F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select(
        F.col("_row")[id_col].alias(id_col),
        *counts,
        F.sha2(written(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        written(F.concat("_base", "_terms")).alias("spans"),
    )

