"""Mixing sources to target weights by the cube method of balanced sampling."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.prefix import positions
from parcelwise.llm.common import split_words, store

WEIGHTS = (5, 2, 1)
SHARE, CEILING, SEED = 1.5, 2.0, 42
#: Units of one source that one task moves; the few it leaves open go on to the next round.
BLOCK = 50_000
#: Units of a source that wait for the landing, besides the two that the flight leaves open.
LANDING = 12
#: A probability this near to 0 or 1 is one of them.
EPS = 1e-9


def _uniform(key: int, step: int) -> float:
    """A reproducible number in [0, 1) (splitmix64)."""
    z = (key + 0x9E3779B97F4A7C15 * (step + 1)) & 0xFFFFFFFFFFFFFFFF
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return ((z ^ (z >> 31)) >> 11) / (1 << 53)


def null_vector(sizes: list[float]) -> tuple[float, ...]:
    """A direction that changes neither the sum of ``sizes`` nor the number of units (three units)."""
    a, b, c = sizes
    u = (b - c, c - a, a - b)
    return u if any(u) else (1.0, -1.0, 0.0)


def flight(sizes: list[int], probs: list[float], keys: list[int]) -> list[float]:
    """Moves probabilities to 0 or 1, keeping the sums of sizes and of probabilities; at most two stay open.

    Three open units have a direction in the null space of both constraints. The step to either
    side is as long as the probabilities allow, taken with the chance that keeps each unit's
    probability its expectation; it settles one unit at least, and the next unit takes its place.
    """
    out = list(probs)
    held: list[int] = []
    step = 0
    for k, p in enumerate(probs):
        if p <= EPS or p >= 1 - EPS:
            out[k] = float(round(p))
            continue
        held.append(k)
        while len(held) == 3:
            u = null_vector([sizes[j] for j in held])
            up = min(((1 - out[j]) / d if d > 0 else -out[j] / d) for j, d in zip(held, u, strict=True) if d)
            down = min((out[j] / d if d > 0 else (out[j] - 1) / d) for j, d in zip(held, u, strict=True) if d)
            step += 1
            move = up if _uniform(keys[k], step) * (up + down) < down else -down
            for j, d in zip(held, u, strict=True):
                q = out[j] + move * d
                out[j] = 0.0 if q <= EPS else 1.0 if q >= 1 - EPS else q
            held = [j for j in held if 0.0 < out[j] < 1.0]
    return out


def landing(sizes: list[int], probs: list[float]) -> list[float]:
    """Settles the few open units at once: the subset nearest to their totals of words and documents.

    All subsets are looked at. An error of one document counts as much as a twentieth of the
    mean size; of equally near subsets the first in binary order is taken.
    """
    open_ = [k for k, p in enumerate(probs) if 0.0 < p < 1.0]
    out = list(probs)
    if open_:
        z, p = np.array([sizes[k] for k in open_], float), np.array([probs[k] for k in open_])
        subsets = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
        off = subsets - p
        best = int(np.argmin(np.abs(off @ z) / max(z.mean(), 1.0) + np.abs(off.sum(axis=1)) / 20))
        for k, taken in zip(open_, subsets[best].tolist(), strict=True):
            out[k] = float(taken)
    return out


def settle_source(sizes: list[int], probs: list[float], keys: list[int]) -> list[float]:
    """Flight and landing of one source. A few units, spread over all sizes, wait for the landing, so that it can close any gap."""
    open_ = [k for k, p in enumerate(probs) if EPS < p < 1 - EPS]
    wait = {open_[round(x)] for x in np.linspace(0, len(open_) - 1, min(LANDING, len(open_)))} if open_ else set()
    go = [k for k in range(len(probs)) if k not in wait]
    out = list(probs)
    for k, p in zip(go, flight([sizes[k] for k in go], [probs[k] for k in go], [keys[k] for k in go]), strict=True):
        out[k] = p
    return landing(sizes, out)


def _settle(last: bool):
    def run(table: pa.Table) -> pa.Table:
        size, prob, key = (table.column(c).to_numpy() for c in ("size", "prob", "key"))
        # Long documents first, so that what stays open at the end is short.
        order = np.lexsort((key, -size)).tolist()
        z, p, h = ([x[k].item() for k in order] for x in (size, prob, key))
        p = settle_source(z, p, h) if last else flight(z, p, h)
        out = np.empty(len(order))
        out[order] = p
        return table.set_column(table.schema.get_field_index("prob"), "prob", pa.array(out))

    return run


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """``(source, position, source_size, documents, target)`` of ``sizes(source, size)``.

    Sources take ``weights`` in turn, in code-point order with NULL last, and share ``share`` times
    the size of all by weight. No target exceeds ``ceiling`` times its source; the excess goes to
    the others by weight until none exceeds it. That fixes one level: each source gets the smaller
    of its ceiling and its weight times the level. The driver sees one row of sums per round.
    """
    if share > ceiling:
        raise ValueError("the ceilings of all sources together are less than the share")
    totals = store(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents")), "sources")
    placed = positions(totals, [F.col("source").asc_nulls_last()], "position")
    cycle = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("position") - 1, F.lit(len(weights))).cast("int"))
    rows = store(placed.withColumn("weight", cycle).withColumn("cap", F.col("source_size") * F.lit(float(ceiling))), "weighted")
    total = share * (rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("s")).first()["s"])
    level, stopped = 0.0, -1
    while True:
        above = F.col("cap") <= F.lit(level) * F.col("weight")
        s = rows.agg(
            F.count_if(above).alias("stopped"), F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)).alias("full"), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight")
        ).first()
        if s["stopped"] == stopped or not s["weight"]:
            break
        stopped, level = s["stopped"], (total - ceiling * s["full"]) / s["weight"]
    open_level = F.lit(level) * F.col("weight")
    target = F.when(F.col("cap") <= open_level, F.col("cap")).otherwise(open_level)
    if not total:
        target = F.lit(0.0)
    return rows.select("source", "position", "source_size", "documents", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    size: Column | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    ceiling: float = CEILING,
    seed: int = SEED,
    block: int = BLOCK,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies)``, one row per row of ``docs``.

    ``copies`` says how often the mix takes a document, never more than ``ceiling`` times. Each
    document of a source is expected ``target / source_size`` times; the whole part is sure, the
    rest is a probability that the cube method settles, balancing words and documents of each
    source. The last units of a source (14 at most) are settled together by the best of all subsets. ``size`` is any length column (words between the six ASCII white-space characters
    without it); NULL texts have size 0, NULL sources are a source of their own, NULL ids and
    repeated rows are units like any other. A source without words takes nothing; an empty table
    gives an empty result; other columns are not read.

    Units are dealt to blocks by a hash of id and text, so the result depends on neither file
    layout nor cluster; a source of any size is as many tasks as it has blocks, each block leaves
    at most two units, and rounds go on until a source has one block. Rows of which more than
    a block are equal in id, text and source stay in one block.
    """
    length = F.coalesce(F.size(split_words(F.col(text_col))) if size is None else size, F.lit(0)).cast("long")
    words = F.when(F.col(text_col).isNull() & F.lit(size is None), F.lit(0).cast("long")).otherwise(length)
    key = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(text_col))
    units = store(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.alias("size"), key.alias("key")), "units")
    targets = store(source_targets(units, weights, share, ceiling), "targets")
    rate = F.least(F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)), F.lit(float(ceiling)))
    near = F.when(F.abs(rate - F.round(rate)) < EPS, F.round(rate)).otherwise(rate)
    rates = targets.select("source", "position", "documents", F.floor(near).cast("int").alias("sure"), (near - F.floor(near)).alias("prob"))
    same = units["source"].eqNullSafe(rates["source"])
    rows = units.join(rates, same).select("doc_id", "size", "key", "position", "sure", "prob", "documents")
    settled: list[DataFrame] = []
    while True:
        blocks = F.ceil(F.col("documents") / block).cast("int")
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", F.lit(len(settled))), blocks).cast("int"))
        single = dealt.where("documents <= {0}".format(block)).groupBy("position").applyInArrow(_settle(True), dealt.schema)
        many = dealt.where("documents > {0}".format(block)).groupBy("position", "block").applyInArrow(_settle(False), dealt.schema)
        moved = store(single.unionByName(many), "moved")
        settled.append(moved.where("prob in (0, 1)"))
        left = moved.where("prob > 0 and prob < 1")
        if left.isEmpty():
            break
        rows = left.drop("documents", "block").join(left.groupBy("position").agg(F.count(F.lit(1)).alias("documents")), "position")
        rows = rows.select("doc_id", "size", "key", "position", "sure", "prob", "documents")
    done = settled[0]
    for part in settled[1:]:
        done = done.unionByName(part)
    copies = (F.col("sure") + F.col("prob")).cast("int").alias("copies")
    return done.join(targets.drop("documents"), "position").select("doc_id", "source", "size", "source_size", "target", copies)
