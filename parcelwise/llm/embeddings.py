"""Embedding near-duplicates: int8 tile products with error bounds, doubtful pairs in double precision."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import store
from parcelwise.llm.components import components, stars

THRESHOLD = 0.9
#: Vector components of a tile's side (16,384 vectors of 64), and rows of it that are multiplied at once.
TILE, STRIP = 1 << 20, 256
#: Products of int8 values are exact in single precision up to so many components; longer vectors are multiplied in double.
EXACT_DIM = (1 << 24) // (127 * 127)
#: Rounding of the double-precision steps around the exact integer products.
SLACK = 1e-9


def quantise(unit: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Int8 values (kept in a float type that multiplies them exactly), their scale, and each vector's error norm."""
    scale = float(np.abs(unit).max(initial=0.0)) / 127 or 1.0
    codes = np.rint(unit / scale)
    error = np.linalg.norm(unit - codes * scale, axis=1)
    return codes.astype(np.float32 if unit.shape[1] <= EXACT_DIM else np.float64), scale, error


def near_pairs(x: np.ndarray, y: np.ndarray, threshold: float, same: bool):
    """Index arrays of the pairs of unit vectors with a product of at least ``threshold``, strip by strip.

    With ``x = q + d`` the exact product is ``q.q' + d.y + q.d'``; it exceeds the quantised one by
    at most ``|d| + |q| |d'|`` with ``|q| <= 1 + |d|``. Only pairs that this bound leaves possible
    are multiplied in double precision.
    """
    (a, sa, ea), (b, sb, eb) = quantise(x), quantise(y)
    most = float(eb.max(initial=0.0))
    floor = (threshold - ea - (1 + ea) * most - SLACK) / (sa * sb)
    limit = (np.floor(floor) - 2).astype(a.dtype)  # products are integers; two less covers the rounding to single precision
    for at in range(0, len(x), STRIP):
        part = slice(at, at + STRIP)
        i, j = np.nonzero(a[part] @ b.T >= limit[part, None])
        i = i + at
        if same:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        rows, cols = np.unique(i), np.unique(j)
        if len(i) * 8 > len(rows) * len(cols):  # a dense group: one block product
            exact = (x[rows] @ y[cols].T)[np.searchsorted(rows, i), np.searchsorted(cols, j)]
        else:
            exact = np.concatenate([np.einsum("ij,ij->i", x[i[k : k + 50_000]], y[j[k : k + 50_000]]) for k in range(0, len(i), 50_000)])
        true = exact >= threshold
        yield i[true], j[true]


def _tile(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        block = table.column("block").to_numpy()
        ids = table.column("id").to_numpy()
        column = table.column("v").combine_chunks()
        v = column.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1).astype(np.float64)
        v = np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])  # by a power of two: exact, and squares stay finite
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        first, last = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        same, i, j = first == last, block == first, block == last
        x, y, ix, iy = v[i], v[j], ids[i], ids[j]
        nx, ny = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        a, b = np.array([], np.int64), np.array([], np.int64)
        for p, q in near_pairs(x, y, threshold, same):
            nx += np.bincount(p, minlength=len(x))
            ny += np.bincount(q, minlength=len(y))
            a, b = np.concatenate([a, ix[p]]), np.concatenate([b, iy[q]])
            if len(a) > 200_000:
                a, b = stars(a, b)
        a, b = stars(a, b) if len(a) else (a, b)
        if same:
            nx, ny = nx + ny, ny[:0]
            iy = iy[:0]
        every, n = np.concatenate([ix, iy]), np.concatenate([nx, ny])
        linked = n > 0
        every, n = every[linked], n[linked]
        order = np.argsort(a)
        at = np.searchsorted(a[order], every)
        hub = every.copy()
        if len(a):
            at = np.minimum(at, len(a) - 1)
            member = a[order][at] == every
            hub[member] = b[order][at[member]]
        return pa.table({"id": every, "n": n, "hub": hub})

    return run


def embedding_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``.

    Links have a cosine of at least ``threshold`` in double precision. A vector that is
    NULL, empty, zero or holds a NULL or non-finite component links with nothing, and so do
    vectors of different lengths. Rows that repeat an id are vectors of their own, linked like
    any other; a row with a NULL id is linked too but names no component (``component_id`` is
    the smallest id of the component, NULL without any). An empty table gives an empty result;
    further columns are not read.

    All rows are numbered and dealt to blocks of about ``tile`` components, and every pair of
    blocks of one length is a task of bounded size. A task returns each linked vector once, with
    its count and the smallest member of its group in the tile: groups of copies never give their pairs.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0)
    rows = store(rows.select("vec_id", F.when(good, F.col("v")).alias("v"), F.monotonically_increasing_id().alias("row")), "vectors")
    fit = rows.where("v is not null").withColumn("dim", F.size("v"))
    sizes = fit.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) * F.first("dim") / tile).cast("int").alias("blocks"))
    sizes = store(sizes, "sizes")
    placed = fit.join(sizes, "dim").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    copies = placed.select("dim", "row", "v", "block", other.alias("other"))
    tiles = copies.select("dim", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", F.col("row").alias("id"), "v")
    found = store(tiles.groupBy("dim", "i", "j").applyInArrow(_tile(threshold), "id long, n long, hub long"), "tiles")
    counts = found.groupBy("id").agg(F.sum("n").alias("n_links"))
    root = components(found.select(F.col("id").alias("a"), F.col("hub").alias("b")))
    linked = rows.select("vec_id", "row").join(root.withColumnRenamed("node", "row"), "row")
    names = linked.groupBy("component").agg(F.min("vec_id").alias("name"))
    linked = store(linked.select("row", "component").join(names, "component").select("row", "name"), "named")
    named = rows.select("vec_id", "row").join(counts.withColumnRenamed("id", "row"), "row", "left").join(linked.withColumn("in", F.lit(True)), "row", "left")
    component = F.when(F.col("in"), F.col("name")).otherwise(F.col("vec_id"))
    out = named.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
