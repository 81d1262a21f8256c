"""Places of pattern matches as DataFrame expressions; positions count code points, ends are exclusive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import empty

#: Matches that one fold gathers.
BLOCK = 128
SPAN = "struct<kind:string,start:int,end:int,value:string>"


def add_matches(rows: DataFrame, name: str, kind: str, text: str, pattern: str | Column, when: Column) -> DataFrame:
    """Adds ``name``: all leftmost non-overlapping matches in column ``text`` as spans in order.

    The matches and the gaps between them come from the same scan order, so the running sum
    of their lengths gives the positions. ``when`` tells which rows can match at all.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found, gaps = f"{name}_found", f"{name}_gaps"
    rows = rows.withColumn(found, F.when(when, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(empty("string")))
    between = F.transform(F.split(F.col(text), pattern, -1), lambda x: F.length(x))
    rows = rows.withColumn(gaps, F.when(F.size(found) > 0, between).otherwise(empty("int")))
    steps = F.zip_with(F.slice(F.col(gaps), F.lit(1), F.size(found)), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["value"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def placed(parts):
        lengths = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda acc, x: acc + x["gap"] + F.length(x["value"])))
        starts = F.transform(parts, lambda p, k: F.aggregate(F.slice(lengths, F.lit(1), k), F.lit(0), lambda acc, x: acc + x))
        first = lambda at: F.struct(at.alias("at"), empty(SPAN).alias("out"))
        return F.zip_with(parts, starts, lambda p, at: F.aggregate(p, first(at), step, lambda acc: acc["out"]))

    return rows.withColumn(name, F.flatten(bind(blocks(steps), placed))).drop(found, gaps)


def bind(value: Column, use: callable) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blocks(values: Column) -> Column:
    """An array cut into arrays of BLOCK values. A fold copies what it has gathered at every step, so it gathers little."""
    starts = lambda v: F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), F.lit(BLOCK))
    return bind(values, lambda v: F.transform(starts(v), lambda i: F.slice(v, i + 1, F.lit(BLOCK))))


def by_start(spans: Column, kinds: list[str]) -> Column:
    """Spans ordered by start, then by the order of ``kinds``, then by end."""
    order = F.array(*[F.lit(k) for k in kinds])
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("k"), s["end"].alias("end"), s.alias("span"))
    )
    return F.transform(F.sort_array(keyed), lambda x: x["span"])


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, ordered: Column, label: callable) -> Column:
    """The text with every span replaced by ``label(span)``; overlapping spans leave one label each but no covered text."""

    def piece_of(part, base):
        """The text from ``base`` to the last end of a block, redacted."""
        end = F.greatest(base, F.array_max(F.transform(part, lambda s: s["end"])))

        def step(acc, s):
            keep = F.substring(acc["piece"], acc["at"] - base + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
            out = F.concat(acc["out"], F.array(F.concat(keep, label(s))))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["piece"].alias("piece"), out.alias("out"))

        first = F.struct(base.alias("at"), F.substring(text, base + 1, end - base).alias("piece"), empty("string").alias("out"))
        return F.aggregate(part, first, step, lambda acc: F.array_join(acc["out"], ""))

    def joined(parts):
        ends = F.transform(parts, lambda p: F.array_max(F.transform(p, lambda s: s["end"])))
        bases = F.transform(parts, lambda p, k: F.greatest(F.lit(0), F.coalesce(F.array_max(F.slice(ends, F.lit(1), k)), F.lit(0))))
        return F.concat(F.array_join(F.zip_with(parts, bases, piece_of), ""), F.substring(text, F.array_max(ends) + 1, F.length(text)))

    done = bind(blocks(ordered), joined)
    return F.when(F.size(ordered) > 0, done).otherwise(text)
