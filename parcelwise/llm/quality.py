"""Quality rules and a hashed n-gram likelihood ratio, as DataFrame operations only."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import empty, split_words, store

#: Buckets of the hashed unigrams and bigrams.
BUCKETS = 1 << 16
#: A document is kept if its mean log ratio per n-gram is at least this.
THRESHOLD = -0.3
#: Up to so many target ids are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def _hashed(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds ``_text`` and ``_hash``, the hashes of its words in order; n-grams are hashes of these."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("_row"), text.alias("_text"))
    return rows.withColumn("_hash", F.transform(split_words(F.col("_text")), lambda w: F.xxhash64(w)))


def _windows(size: int) -> Column:
    """Hashes of all windows of ``size`` words."""
    h, last = F.col("_hash"), F.size("_hash") - size
    at = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(empty("int"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))


def _ngram_buckets(buckets: int) -> Column:
    return F.transform(F.concat("_hash", _windows(2)), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def _repeat_words(rows: DataFrame) -> DataFrame:
    """Adds ``_repeat``: words covered by 3-word windows that occur twice or more.

    Windows are compared by their 64-bit hash. Those equal to a neighbour in hash order
    are repeated; their positions, in order again, cover intervals of three words.
    """
    rows = rows.withColumn("_windows", _windows(3))
    pairs = F.sort_array(F.transform(F.col("_windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = empty("struct<h:bigint,i:int>")
    rows = rows.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), pairs).otherwise(none)).drop("_windows")
    s = F.col("_sorted")
    same = F.filter(s, lambda x, k: F.coalesce((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), F.lit(False)))
    rows = rows.withColumn("_at", F.sort_array(F.transform(same, lambda x: x["i"]))).drop("_sorted")
    covered = F.aggregate(
        F.col("_at"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + p + 3 - F.greatest(p, acc["end"])).alias("n"), (p + 3).alias("end")),
        lambda acc: acc["n"],
    )
    return rows.withColumn("_repeat", covered).drop("_at")


def target_model(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, ratio)``: log of the n-gram's share in the trusted target over its share in all rows, in thousandths.

    ``targets`` has the ids of the trusted documents. Both multinomials count every n-gram
    of whole texts and are smoothed by one per bucket; without targets all ratios are 0.
    """
    ids = store(targets.select(F.col(id_col).alias("_id"), F.lit(True).alias("_target")).where("_id is not null").distinct(), "targets")
    few = ids.count() <= BROADCAST_IDS
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(F.broadcast(ids) if few else ids, "_id", "left")
    marked = _hashed(rows, "_t").select(F.col("_row")["_target"].alias("_target"), "_hash").withColumn("_grams", _ngram_buckets(buckets))
    # The outer form keeps filters above it; pushed down, they would hash the text again for every element.
    grams = marked.select(F.coalesce("_target", F.lit(False)).alias("target"), F.explode_outer("_grams").alias("bucket")).where("bucket is not null")
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count_if("target").alias("hit"))
    space = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    full = store(space.join(counts, "bucket", "left").na.fill(0), "counts")
    total = full.agg(F.sum("raw"), F.sum("hit")).first()
    raw, hit = total[0] + buckets, total[1] + buckets
    ratio = F.log((F.col("hit") + 1) / F.lit(float(hit))) - F.log((F.col("raw") + 1) / F.lit(float(raw)))
    return full.select("bucket", (F.round(ratio * 1000).cast("int") if total[1] else F.lit(0)).alias("ratio"))


def quality_rules(
    docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, buckets: int = BUCKETS
) -> DataFrame:
    """``_row`` (all columns of ``docs``) with counts, ``score``, ``base_failed`` and ``kept``.

    Rules: at least 50 words, at most half of them inside repeated 3-word windows. Method:
    the mean log ratio of the text's hashed unigrams and bigrams, trusted target against
    all rows, must reach ``threshold``. NULL and empty texts have no words, score 0 and
    fail the rules. Every row is judged by itself, so repeated rows, ties, NULL ids and
    clashing column names change nothing; an empty table gives an empty result.
    """
    model = store(target_model(docs, targets, id_col, text_col, buckets), "model")
    # One bounded list (an integer per bucket) becomes a constant of the plan.
    by_bucket = sorted((r["bucket"], r["ratio"]) for r in model.collect())
    ratios = F.from_json(F.lit(json.dumps([r for _, r in by_bucket])), "array<int>")
    rows = _repeat_words(_hashed(docs, text_col))
    text = F.col("_text")
    rows = rows.withColumn("_n", F.size("_hash")).withColumn("_grams", _ngram_buckets(buckets)).drop("_hash")
    total = F.aggregate(F.col("_grams"), F.lit(0).cast("long"), lambda acc, b: acc + F.get(ratios, b))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    rows = rows.withColumn("_lines", lines)
    score = F.when(F.size("_grams") > 0, total / (F.size("_grams") * 1000)).otherwise(F.lit(0.0))
    judged = rows.select(
        "_row",
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_repeat").alias("n_repeat_words"),
        score.alias("score"),
    )
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    judged = judged.withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def trusted(labels: DataFrame) -> DataFrame:
    """Ids labelled as good and not toxic."""
    return labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id")
