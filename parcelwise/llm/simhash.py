"""SimHash near-duplicates: bit counts of segments, a grid join and exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import store
from parcelwise.llm.components import components, stars

SHINGLE, SEED, DISTANCE = 4, 42, 4
LOW_BITS = 0x5555555555555555
#: Cells of up to so many fingerprints are compared by the task that reads them; larger ones are split into tiles.
CELL_ROWS = 4096
#: Links kept in memory before they are reduced to a forest.
LINKS = 1_000_000


def hash_shingles(data: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of all word shingles, repeats included; fewer words than ``size`` make one shingle."""
    words = data.lower().split()
    n = len(words)
    if n <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if n else [], np.uint64)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    first, last = (ends - lengths)[: n - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[i:j], SEED) for i, j in zip(first, last, strict=True)), np.uint64, n - size + 1)


def fingerprint(data: bytes | None, size: int = SHINGLE) -> int:
    """64 majority bits of the shingle hashes, as a signed integer; 0 without words."""
    hashes = hash_shingles(data or b"", size)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].astype("<u8", copy=False)
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little") if len(hashes) else np.zeros(8, np.uint8)
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` of every row; a NULL text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(x.as_py(), size) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def segment_counts(fp: Column) -> Column:
    """The number of set bits (0, 1 or 2) of each of the 32 two-bit segments, in unary.

    In unary, the Manhattan distance of two count vectors is the number of differing bits;
    it never exceeds the Hamming distance of the fingerprints.
    """
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW_BITS)), fp.bitwiseAND(F.lit(LOW_BITS))
    return high.bitwiseOR(low).bitwiseOR(F.shiftleft(high.bitwiseAND(low), 1))


def grids(distance: int, exact: int = 3) -> list[int]:
    """Masks of the subspaces whose cells are joined.

    The 32 counts are dealt to ``distance + exact`` groups. Two vectors within ``distance``
    differ in at most ``distance`` groups, so they share their cell (width one, range zero)
    in at least one of the subspaces of ``exact`` groups. More groups: more, finer grids.
    """
    n = distance + exact
    masks = [sum(3 << (2 * s) for s in range(g, 32, n)) for g in range(n)]
    signed = [sum(c) for c in combinations(masks, exact)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in signed]


def _unary(x: np.ndarray) -> np.ndarray:
    high, low = (x >> np.uint64(1)) & np.uint64(LOW_BITS), x & np.uint64(LOW_BITS)
    return high | low | ((high & low) << np.uint64(1))


class _Links:
    """Verified links, kept as a forest whenever there are many."""

    def __init__(self, distance: int):
        self.distance, self.a, self.b, self.n = distance, [], [], 0

    def add(self, x: np.ndarray, y: np.ndarray, ux: np.ndarray, uy: np.ndarray) -> None:
        near = np.bitwise_count(ux ^ uy) <= self.distance
        x, y = x[near], y[near]
        true = np.bitwise_count(x ^ y) <= self.distance
        if true.any():
            self.a.append(x[true])
            self.b.append(y[true])
            self.n += int(true.sum())
            if self.n > LINKS:
                self.a, self.b = ([v] for v in self.forest())
                self.n = len(self.a[0])

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.a:
            return np.array([], np.uint64), np.array([], np.uint64)
        return stars(np.concatenate(self.a), np.concatenate(self.b))


ROWS = "a long, b long, grid int, cell long, block int"


def _edge_rows(links: _Links) -> Iterator[pa.RecordBatch]:
    a, b = links.forest()
    if len(a):
        none, blank = pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), none, blank, none], ["a", "b", "grid", "cell", "block"])


def _deferred(key: tuple[int, int], fps: np.ndarray, seen: int) -> pa.RecordBatch:
    """Rows of a cell for the tiles; ``block`` numbers every CELL_ROWS of them."""
    n = len(fps)
    block = ((seen + np.arange(n)) // CELL_ROWS).astype(np.int32)
    columns = [fps.view(np.int64), np.full(n, key[0], np.int32), np.full(n, key[1], np.int64), block]
    a, grid, cell, block = map(pa.array, columns)
    return pa.RecordBatch.from_arrays([a, pa.nulls(n, pa.int64()), grid, cell, block], ["a", "b", "grid", "cell", "block"])


def _join_cells(distance: int):
    """Over rows sorted by cell: links inside cells, and the rows of cells too large for one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.array([], np.int32), np.array([], np.int64), np.array([], np.uint64))
        held, key, seen = none, None, 0
        for batch in chain(batches, (None,)):
            rows = held
            if batch is not None:
                grid, cell, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                rows = tuple(np.concatenate(x) for x in zip(held, (grid, cell, fp.view(np.uint64)), strict=True))
            if key is not None:  # a large cell that began in an earlier batch
                n = int(((rows[0] == key[0]) & (rows[1] == key[1])).sum())
                if n:
                    yield _deferred(key, rows[2][:n], seen)
                    seen += n
                rows = tuple(x[n:] for x in rows)
                key = None if len(rows[2]) else key
            grid, cell, fp = rows
            held = none
            if not len(fp):
                continue
            start = np.flatnonzero(np.r_[True, (grid[1:] != grid[:-1]) | (cell[1:] != cell[:-1])])
            size = np.diff(np.r_[start, len(fp)])
            end = len(fp) if batch is None else int(start[-1])  # the last cell may go on in the next batch
            for k in np.flatnonzero(size > CELL_ROWS):
                at = (int(grid[start[k]]), int(cell[start[k]]))
                yield _deferred(at, fp[start[k] : start[k] + size[k]], 0)
                if start[k] == end:
                    key, seen = at, int(size[k])
            if key is None:
                held = tuple(x[end:] for x in rows)
            cell_of = np.repeat(np.arange(len(size)), size)[:end]
            keep = (size <= CELL_ROWS)[cell_of]
            cell_of, x = cell_of[keep], fp[:end][keep]
            u, links, at, step = _unary(x), _Links(distance), np.arange(len(x)), 1
            while True:
                at = at[: np.searchsorted(at, len(x) - step)]
                at = at[cell_of[at] == cell_of[at + step]]
                if not len(at):
                    break
                links.add(x[at], x[at + step], u[at], u[at + step])
                step += 1
            yield from _edge_rows(links)

    return run


def _join_tile(distance: int):
    """Links between two blocks of one large cell, or within one."""

    def run(table: pa.Table) -> pa.Table:
        block, fp = table.column("block").to_numpy(), table.column("a").to_numpy().view(np.uint64)
        i = block == table.column("i")[0].as_py()
        x, y = fp[i], fp[i] if i.all() else fp[~i]
        ux, uy, links = _unary(x), _unary(y), _Links(distance)
        for at in range(len(x)):
            first = at + 1 if i.all() else 0
            rest = y[first:]
            links.add(np.full(len(rest), x[at]), rest, np.full(len(rest), ux[at]), uy[first:])
        a, b = links.forest()
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return run


def fingerprint_links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges ``(a, b)`` that connect all distinct fingerprints ``fp`` within ``distance`` bits.

    Links inside a cell are returned as a forest with the same components, so a group of
    near copies gives as many rows as it has members, not its pairs. A cell of more than
    CELL_ROWS fingerprints is cut into blocks, and each pair of blocks is a task of its own.
    """
    cells = fps.select(
        F.col("fp"),
        F.posexplode(F.array(*[segment_counts(F.col("fp")).bitwiseAND(F.lit(m)) for m in grids(distance)])).alias("grid", "cell"),
    )
    dealt = cells.select("grid", "cell", "fp").repartition("grid", "cell").sortWithinPartitions("grid", "cell")
    found = store(dealt.mapInArrow(_join_cells(distance), ROWS), "links")
    edges = found.where(F.col("grid").isNull()).select("a", "b")
    rest = found.where(F.col("grid").isNotNull()).select("grid", "cell", "a", "block")
    if rest.isEmpty():
        return edges
    last = store(rest.groupBy("grid", "cell").agg(F.max("block").alias("last")), "cells")
    pairs = rest.join(last, ["grid", "cell"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    tiles = pairs.select("grid", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "a")
    return edges.union(tiles.groupBy("grid", "cell", "i", "j").applyInArrow(_join_tile(distance), "a long, b long"))


def text_key(text: Column) -> Column:
    """A hash that tells texts apart; NULL is an empty text."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def _placed(fps: DataFrame, distance: int) -> DataFrame:
    """``(fp, root)`` for the distinct fingerprints ``fp``: the smallest fingerprint that links reach."""
    root = components(fingerprint_links(fps, distance)).withColumnRenamed("node", "fp")
    return store(fps.join(root, "fp", "left").select("fp", F.coalesce("component", "fp").alias("root")), "placed")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``(doc_id, fp, component_id, class_size)`` of every row of ``docs``.

    ``component_id`` is the smallest id that links reach. NULL texts and texts without words
    have fingerprint 0 and are linked like any other; a row with a NULL id belongs to its
    component but does not name it (NULL if no member has an id). Repeated rows stay rows.
    An empty table gives an empty result; further columns are not read.
    """
    rows = store(fingerprints(docs, id_col, text_col, size), "fingerprints")
    classes = store(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")), "classes")
    placed = classes.join(_placed(classes.select("fp"), distance), "fp")
    named = store(placed.groupBy("root").agg(F.min("low").alias("component_id"), F.sum("n").alias("class_size")), "named")
    of = store(placed.join(named, "root").select("fp", "component_id", "class_size"), "of")
    return rows.join(of, "fp").select("doc_id", "fp", "component_id", "class_size")
