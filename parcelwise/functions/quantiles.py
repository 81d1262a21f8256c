"""Exact order statistics and running totals over columns of any size.

``percentile`` keeps every distinct value of a group in one task, and an ordered
window over a whole column sorts it in one task. Both fail on big columns, so:

* quantiles use a mergeable sketch to bracket each wanted rank, then count
  exactly what lies below the bracket and order only what lies inside it; those of the columns of a
  wide frame are bracketed by the leading bits of the values instead, without a long form;
* running totals and ranks are sums over value buckets of bounded size
  (:mod:`parcelwise.functions.prefix`).

Both are exact. A bracket that misses its rank raises an error instead of
returning a wrong value.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.functions import columns as C
from parcelwise.functions.lineage import cut
from parcelwise.functions.prefix import running_totals

INF = float("inf")
#: Up to so many keys are broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 100_000
#: Rows of a wide frame that a task holds at a time.
CHUNK_ROWS = 1 << 16


def linear_position(n: Column, p: float) -> Column:
    """Zero-based fractional position of quantile ``p`` among ``n`` values."""
    return (n - 1).cast("double") * F.lit(float(p))


def order_statistics(
    long: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    position: Callable[[Column, float], Column] = linear_position,
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact interpolated order statistics, one row per key and probability.

    Returns ``keys, prob_id, n, q, below`` where ``below`` counts the values
    strictly smaller than the lower neighbour. Keys must not be NULL.
    """
    asked_order = sorted(range(len(probs)), key=lambda k: float(probs[k]))
    probs = [float(probs[k]) for k in asked_order]  # brackets must ascend
    width = len(probs)
    keys = list(keys)
    data = long.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())

    # 1. One sketch per key. A bracket reaches four times the error of the sketch to either side, and two
    #    ranks further: 2 / n of the probability, rounded up to the next of a ladder of widths.
    slack = 4.0 / accuracy
    widths = [slack * 2**k for k in range(math.ceil(math.log2(1 / slack)) + 1)]
    asked = [min(max(p + sign * w, 0.0), 1.0) for p in probs for sign in (-1, 1) for w in widths]
    sketch = data.groupBy(*keys).agg(
        F.count("_v").alias("_n"),
        F.percentile_approx("_v", F.array(*[F.lit(p) for p in asked]), F.lit(accuracy)).alias("_s"),
    )
    step = F.least(F.ceil(F.log2(1 + F.lit(2.0 / slack) / F.col("_n"))), F.lit(len(widths) - 1)).cast("int")

    def border(i: int, high: bool) -> Column:
        first = (2 * i + high) * len(widths)
        outside = [asked[first + k] in (0.0, 1.0) for k in range(len(widths))]
        ends = F.array(*[F.lit(INF if high else -INF) if out else F.get("_s", F.lit(first + k)) for k, out in enumerate(outside)])
        return F.get(ends, step)

    # Stored: both are small, and every later step reads them.
    lows, highs = ([border(i, high) for i in range(width)] for high in (False, True))
    brackets = cut(sketch.select(*keys, "_n", F.array(*lows).alias("_lo"), F.array(*highs).alias("_hi")))

    # 2. Shrink the data: values inside a bracket stay, the rest become counts.
    v = F.col("_v")
    small = F.broadcast(brackets) if brackets.count() <= BROADCAST_KEYS else brackets
    joined = data.join(small, keys)
    lo = [F.get("_lo", F.lit(i)) for i in range(width)]
    hi = [F.get("_hi", F.lit(i)) for i in range(width)]
    inside = F.lit(False)
    region = F.lit(0)
    for i in range(width):
        inside = inside | ((v >= lo[i]) & (v <= hi[i]))
        region = region + F.when(v > hi[i], 1).otherwise(0)
    shrunk = cut(
        joined.groupBy(*keys, F.when(inside, v).alias("_in"), F.when(~inside, region).alias("_region"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )

    # 3. Per wanted rank: one NULL row counts everything below the bracket.
    ranked = shrunk.join(small, keys).select(
        *keys, "_n", "_in", "_region", "_c", F.posexplode(F.arrays_zip("_lo", "_hi")).alias("prob_id", "_b")
    )
    in_b = F.coalesce(F.col("_in").between(F.col("_b._lo"), F.col("_b._hi")), F.lit(False))
    under = F.when(F.col("_in").isNull(), F.col("_region") <= F.col("prob_id")).otherwise(F.col("_in") < F.col("_b._lo"))
    ranks = [*keys, "prob_id"]
    below = ranked.groupBy(*ranks).agg(F.max("_n").alias("_n"), F.coalesce(F.sum(F.when(~in_b & under, F.col("_c"))), F.lit(0)).alias("_under"))
    inside_b = ranked.filter(in_b).select(*ranks, F.col("_in").alias("_v"), "_c")
    # The values of a bracket are summed up bucket by bucket, so no task orders a whole bracket.
    ladder = running_totals(inside_b, ranks, "_v", ["_c"]).join(below, ranks).withColumn("_cum", F.col("cum__c") + F.col("_under"))
    pos = F.coalesce(*[F.when(F.col("prob_id") == i, position(F.col("_n"), p)) for i, p in enumerate(probs)])
    low_k, high_k = F.floor(pos), F.ceil(pos)
    found = (
        ladder.withColumn("_pos", pos)
        .groupBy(*keys, "prob_id")
        .agg(
            F.max("_n").alias("n"),
            F.max("_pos").alias("_pos"),
            F.min(F.when(F.col("_cum") > low_k, F.col("_v"))).alias("_q0"),
            F.min(F.when(F.col("_cum") > high_k, F.col("_v"))).alias("_q1"),
            F.min(F.when(F.col("_cum") > low_k, F.col("_cum") - F.col("_c"))).alias("below"),
            F.max(F.col("_under") > low_k).alias("_missed"),
        )
    )
    miss = F.col("_missed") | F.col("_q1").isNull()
    frac = F.col("_pos") - F.floor("_pos")
    q = F.when(miss, F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")).otherwise(
        F.col("_q0") + (F.col("_q1") - F.col("_q0")) * frac
    )
    original = F.get(F.array(*[F.lit(k) for k in asked_order]), F.col("prob_id"))
    return found.select(*keys, original.alias("prob_id"), "n", q.alias("q"), "below")


def exact_quantiles(long: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Exact linear quantiles, one row per key: ``keys, n, quantiles array<double>``."""
    keys = list(keys)
    stats = order_statistics(long, keys, value, probs)
    return stats.groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.transform(F.sort_array(F.collect_list(F.struct("prob_id", "q"))), lambda s: s["q"]).alias("quantiles"),
    )


def _chunks(batches: Iterator[pd.DataFrame], keys: list[str], names: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Rows of a task in bounded chunks: the key rows that occur, the number of each row's key, and the values."""
    parts, n = [], 0

    def whole():
        at = pd.concat([p[keys] for p in parts], ignore_index=True)
        if keys:
            place = at.groupby(keys, sort=False).ngroup().to_numpy(np.int64)
            found = at.groupby(keys, sort=False).head(1).reset_index(drop=True)
        else:
            place, found = np.zeros(n, np.int64), pd.DataFrame(index=[0])
        return found, place, np.concatenate([p[names].to_numpy(float) for p in parts]) + 0.0  # no negative zero

    for batch in batches:
        parts.append(batch)
        n += len(batch)
        if n >= CHUNK_ROWS:
            yield whole()
            parts, n = [], 0
    if n:
        yield whole()


def _cells(v: np.ndarray, bits: int) -> np.ndarray:
    """The first ``bits`` bits of doubles as integers that ascend with them."""
    raw = v.view(np.int64)
    return (raw ^ ((raw >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))) >> np.int64(64 - bits)


def column_quantiles(df: DataFrame, names: Sequence[str], probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact linear quantiles of many columns, one row per key and column: ``keys, feature, n, quantiles``.

    The same values as ``exact_quantiles`` of the long form, without building it: tasks count the values of
    whole columns by their leading bits (sign, exponent and some of the fraction). That tells in which cell of values each wanted
    rank lies and how many come before it; a second pass counts the distinct values of these cells only.
    Values that are no finite numbers are left out, and so are rows whose key is NULL.
    """
    names, keys, probs = list(names), list(keys), [float(p) for p in probs]
    bits = 18 if keys else 20  # the cells of a key hold fewer values
    wide = df.select(*keys, *[C.finite_double(F.col(f)).alias(f"_c{k}") for k, f in enumerate(names)])
    for key in keys:
        wide = wide.filter(F.col(key).isNotNull())
    columns = [f"_c{k}" for k in range(len(names))]
    key_ddl = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)

    def tally(found: pd.DataFrame, place: np.ndarray, k: int, values: np.ndarray, name: str) -> pd.DataFrame:
        # Distinct values per key: order by value, then by key.
        order = np.lexsort((values, place)) if keys else np.argsort(values, kind="stable")
        place, values = place[order], values[order]
        first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (values[1:] != values[:-1])])
        out = found.iloc[place[first]].reset_index(drop=True)
        out["c"], out[name], out["n"] = np.int32(k), values[first], np.diff(np.r_[first, len(values)])
        return out

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for found, place, x in _chunks(batches, keys, columns):
            for k in range(len(columns)):
                known = ~np.isnan(x[:, k])
                if known.any():
                    yield tally(found, place[known], k, _cells(np.ascontiguousarray(x[known, k]), bits), "cell")

    # 1. Values per cell, stored: ranks are looked up in it. A key and column has at most 2 ** bits of them.
    at = [*keys, "c"]
    counted = cut(wide.mapInPandas(cells, f"{key_ddl}c int, cell bigint, n bigint").groupBy(*at, "cell").agg(F.sum("n").alias("n")))
    upto = Window.partitionBy(*at).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    ladder = counted.withColumn("_cum", F.sum("n").over(upto)).withColumn("_before", F.col("_cum") - F.col("n"))
    totals = counted.groupBy(*at).agg(F.sum("n").alias("_n"))
    asked = F.array(*[F.struct(F.lit(i).alias("prob_id"), linear_position(F.col("_n"), p).alias("pos")) for i, p in enumerate(probs)])
    ends = F.array(*[F.struct(F.lit(high).alias("high"), (F.ceil("pos") if high else F.floor("pos")).alias("rank")) for high in (False, True)])
    ranks = totals.select(*at, "_n", F.inline(asked)).select(*at, "_n", "prob_id", "pos", F.inline(ends))
    hit = (F.col("_before") <= F.col("rank")) & (F.col("rank") < F.col("_cum"))
    wanted = cut(ranks.join(ladder.drop("n"), at).filter(hit).select(*at, "cell", "_n", "prob_id", "pos", "high", "rank", "_before"))

    # 2. The distinct values of the cells that hold a wanted rank. As many cells as ranks: columns x probabilities (x keys).
    marked = wanted.select(*at, "cell").distinct().toPandas()
    here: dict[int, pd.DataFrame] = dict(tuple(marked.groupby("c")))

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for found, place, x in _chunks(batches, keys, columns):
            found["_place"] = np.arange(len(found))
            for k, cells_of in here.items():
                codes = cells_of.merge(found, on=keys) if keys else cells_of.assign(_place=0)
                codes = np.sort((codes["_place"].to_numpy(np.int64) << bits) + codes["cell"].to_numpy(np.int64))
                known = np.flatnonzero(~np.isnan(x[:, k]))
                v = np.ascontiguousarray(x[known, k])
                code = (place[known] << bits) + _cells(v, bits)
                spot = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
                mine = codes[spot] == code if len(codes) else np.full(len(code), False)
                if mine.any():
                    out = tally(found.drop(columns="_place"), place[known][mine], k, v[mine], "v")
                    yield out.assign(cell=_cells(out["v"].to_numpy(), bits))

    values = cut(wide.mapInPandas(inside, f"{key_ddl}c int, v double, n bigint, cell bigint").groupBy(*at, "cell", "v").agg(F.sum("n").alias("n")))
    # A cell is summed up bucket by bucket, so no task orders the whole of a large one.
    summed = running_totals(values, [*at, "cell"], "v", ["n"]).select(*at, "cell", "v", "cum_n")
    reached = F.min(F.when(F.col("_before") + F.col("cum_n") > F.col("rank"), F.col("v")))
    found = wanted.join(summed, [*at, "cell"]).groupBy(*at, "prob_id", "high").agg(reached.alias("v"), F.max("pos").alias("pos"), F.max("_n").alias("n"))
    low, high = (F.max(F.when(F.col("high") == h, F.col("v"))) for h in (False, True))
    part = F.max(F.col("pos") - F.floor("pos"))
    q = found.groupBy(*at, "prob_id").agg(F.max("n").alias("n"), (low + (high - low) * part).alias("q"))
    name = F.get(F.array(*[F.lit(f) for f in names]), F.col("c")).alias("feature")
    return (
        q.groupBy(*at)
        .agg(F.max("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("prob_id", "q"))), lambda s: s["q"]).alias("quantiles"))
        .select(*keys, name, "n", "quantiles")
    )


def average_ranks(long: DataFrame, keys: Sequence[str], value: str, among: Sequence[str] = ()) -> DataFrame:
    """Average rank of every distinct value per key: ``keys, value, cnt, avg_rank``.

    ``among`` names boolean columns; ``avg_rank_{name}`` is the rank among the rows where it holds.
    All come from one counting and one order.
    """
    keys = list(keys)
    counters = {"": F.count(F.lit(1))} | {f"_{a}": F.count_if(a) for a in among}
    # Stored: the running totals read the counts several times.
    counts = cut(long.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(*[c.alias(f"cnt{a}") for a, c in counters.items()]))
    ranked = running_totals(counts, keys, value, [f"cnt{a}" for a in counters])
    ranks = [(F.col(f"cum_cnt{a}") - (F.col(f"cnt{a}") - 1) / F.lit(2.0)).cast("double").alias(f"avg_rank{a}") for a in counters]
    return ranked.select(*keys, value, "cnt", *ranks)


def hash_sample(
    df: DataFrame,
    id_col: str,
    size: Callable[[Column], Column],
    frac: float,
    seed: int | str,
    strata: Sequence[str] = (),
) -> DataFrame:
    """Reproducible sample of exact size per stratum.

    Rows are ordered by the md5 of ``id:seed`` and the first ``size(n)`` of a
    stratum with ``n`` rows are kept; ``frac`` says about where that rank lies.
    Ids must be unique.
    """
    keys = [f"_k{i}" for i in range(max(1, len(strata)))]
    key_cols = [F.col(s).cast("string") for s in strata] or [F.lit("")]
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")).cast("binary"))
    hashed = F.conv(F.substring("_d", 1, 13), 16, 10).cast("double")  # 52 bits
    # Only id, stratum and hash are stored; the rest of the row joins back at the end.
    tagged = cut(
        df.select(F.col(id_col), digest.alias("_d"), *[F.coalesce(c, F.lit("")).alias(k) for c, k in zip(key_cols, keys)])
        .withColumn("_h", hashed)
    )
    last = lambda n, _p: F.greatest(size(n) - 1, F.lit(0)).cast("double")
    border = order_statistics(tagged, keys, "_h", [frac], position=last).select(
        *keys, F.col("q").alias("_cut"), "below", size(F.col("n")).cast("bigint").alias("_size")
    )
    border = cut(border.filter("_size > 0"))
    # One row per stratum; strata are label classes.
    kept = tagged.join(F.broadcast(border), keys)
    sure = kept.filter(F.col("_h") < F.col("_cut")).select(id_col)
    order = Window.partitionBy(*keys).orderBy("_d", id_col)
    ties = (
        kept.filter(F.col("_h") == F.col("_cut"))  # two rows only if 52 hash bits agree
        .withColumn("_rn", F.row_number().over(order))
        .filter(F.col("_rn") <= F.col("_size") - F.col("below"))
        .select(id_col)
    )
    return df.join(sure.unionByName(ties), id_col, "left_semi")

