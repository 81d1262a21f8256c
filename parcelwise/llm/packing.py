"""Best-fit packing of texts into sequences of several permitted lengths."""

from __future__ import annotations

from collections.abc import Callable
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import split_words, store

CAPACITIES = (512, 1024, 2048, 4096)
#: Pieces that are packed together by one task.
SHARD_ROWS = 20_000


def sequence_cost(capacity: int) -> float:
    """Cost of a sequence: its tokens, plus attention that grows with their square (equal at 8,192)."""
    return capacity + capacity * capacity / 8192


def best_fit(lengths: np.ndarray, opened: Callable[[int], int], top: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece, taken in the given order.

    A piece goes to the open bin whose room it fills best (the one opened first of equal ones);
    otherwise ``opened(length)`` tells the size of its new bin. ``room`` is a bit set of the
    free sizes that some bin has, so each step is one shift and one lowest-bit test.
    """
    bins: list[list[int]] = [[] for _ in range(top + 1)]
    used: list[int] = []
    size: list[int] = []
    room = 0
    at, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, n in enumerate(lengths.tolist()):
        fit = room >> n
        if fit:
            free = n + (fit & -fit).bit_length() - 1
            b = heappop(bins[free])
            if not bins[free]:
                room &= ~(1 << free)
        else:
            b = len(size)
            size.append(opened(n))
            used.append(0)
        at[k], offset[k] = b, used[b]
        used[b] += n
        left = size[b] - used[b]
        if left:
            heappush(bins[left], b)
            room |= 1 << left
    return at, offset


def pack(lengths: np.ndarray, capacities: tuple[int, ...], cost: Callable[[int], float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and final capacity of every piece; lengths are 1 .. max(capacities), longest first.

    The permitted sizes are optimised jointly: each rule for the size of a new bin (the
    smallest that fits, every single size as a floor, the least cost per token that the
    piece could share) packs all pieces, every bin is downsized to the least size that holds
    its contents, and the plan of least total cost stays; ties go to the earlier rule.
    """
    sizes = np.array(sorted(capacities))

    def smallest(n: int, floor: int = 0) -> int:
        return int(sizes[np.searchsorted(sizes, max(n, floor))])

    def cheapest(n: int) -> int:
        fits = sizes[sizes >= n]
        return int(min(fits, key=lambda c: (cost(int(c)) / min(c, c // n * n), c)))

    fixed = {n: {r: f(n) for r, f in enumerate([smallest, cheapest, *[lambda n, c=c: smallest(n, c) for c in sizes.tolist()]])} for n in np.unique(lengths).tolist()}
    best = None
    for rule in range(len(sizes) + 2):
        at, offset = best_fit(lengths, lambda n, r=rule: fixed[n][r], int(sizes[-1]))
        filled = np.bincount(at, weights=lengths).astype(np.int64)
        final = sizes[np.searchsorted(sizes, filled)]
        total = float(sum(cost(c) * n for c, n in zip(*(x.tolist() for x in np.unique(final, return_counts=True)), strict=True)))
        if best is None or total < best[0] - 1e-9:
            best = (total, at, offset, final[at])
    return best[1:]


def pack_documents(
    docs: DataFrame, length: Column, capacities: tuple[int, ...] = CAPACITIES, cost: Callable[[int], float] = sequence_cost, id_col: str = "doc_id", shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """``(doc_id, piece, start, n_tokens, bin_id, capacity, offset)``: where every piece of every document goes.

    ``length`` is a document's number of tokens. Documents longer than the largest capacity
    are cut into pieces of that size and a rest, so no token is dropped. Documents without
    tokens (NULL, empty) have one row with ``n_tokens`` 0 and no bin. Rows that repeat an id
    are packed one by one; NULL ids are packed too. An empty table gives an empty result;
    further columns are not read.

    Pieces are dealt by hash to shards of about ``shard_rows``; only ids and numbers travel.
    A bin belongs to one shard (``bin_id`` is shard:number), so the loss against one global
    packing is at most a few open bins a shard.
    """
    top = max(capacities)
    n = F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0).cast("long"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), n.alias("n"))
    last = F.greatest(F.ceil(F.col("n") / top) - 1, F.lit(0))
    pieces = rows.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * top
    cut = pieces.select(F.monotonically_increasing_id().alias("at"), "doc_id", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(top)).cast("long").alias("n_tokens"))
    cut = store(cut, "pieces")
    shards = max(1, -(-cut.where("n_tokens > 0").count() // shard_rows))
    shard = F.pmod(F.xxhash64("doc_id", "piece", "at"), F.lit(shards)).cast("int")

    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("at").to_numpy(), -table.column("n_tokens").to_numpy()))
        table = table.take(pa.array(order))
        lengths = table.column("n_tokens").to_numpy()
        at, offset, size = pack(lengths, capacities, cost)
        name = f"{table.column('shard')[0].as_py()}:"
        columns = {k: table.column(k) for k in ("doc_id", "piece", "start", "n_tokens")}
        return pa.table(columns | {"bin_id": pa.array([name + str(b) for b in at.tolist()], pa.string()), "capacity": size.astype(np.int32), "offset": offset.astype(np.int64)})

    schema = "doc_id long, piece long, start long, n_tokens long, bin_id string, capacity int, offset long"
    packed = cut.where("n_tokens > 0").withColumn("shard", shard).groupBy("shard").applyInArrow(run, schema)
    none = cut.where("n_tokens = 0").select("doc_id", "piece", "start", "n_tokens", F.lit(None).cast("string").alias("bin_id"), F.lit(None).cast("int").alias("capacity"), F.lit(None).cast("long").alias("offset"))
    return packed.union(none)


def words(text_col: str = "text") -> Column:
    """The production length: words between white space."""
    return F.size(split_words(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
