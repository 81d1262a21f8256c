"""Divergence of every source from its peers in one language, by Gustavson's row accumulation."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import store

SCALE, SMOOTH = 1_000_000_000, 2
MIN_DOCUMENTS, TOP_TERMS = 10, 10
#: Groups of one block; a tile's accumulator has the square of it.
BLOCK = 1024
#: Postings of one shard of terms, and pairs of postings that are gathered at once.
SHARD, GATHER = 2_000_000, 2_000_000
#: Distinct entries that a task holds before it passes its counts on, and bytes of text it splits at once.
HELD, PIECE = 500_000, 1 << 22

#: Bytes outside terms become blanks; A-Z are lower-cased; letters and all bytes of other code points stay.
_TERM_BYTES = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def term_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of one text, some megabytes of it at a time; no term is cut."""
    at = 0
    while at < len(text):
        piece = text[at : at + PIECE].translate(_TERM_BYTES)
        end = len(piece)
        if at + PIECE < len(text):
            end = piece.rfind(b" ") + 1
            if end == 0:  # a term longer than a piece: take it whole
                rest = text[at:].translate(_TERM_BYTES)
                blank = rest.find(b" ")
                end = len(rest) if blank < 0 else blank
                piece = rest
        yield piece[:end].split()
        at += end


class _Held:
    """Counts of terms by (lang, source), passed on when they become many."""

    def __init__(self):
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def add(self, lang: str, source: str, text: bytes | None) -> None:
        n, docs = self.groups.setdefault((lang, source), (Counter(), Counter()))
        distinct: set[bytes] = set()
        for terms in term_pieces(text or b""):
            n.update(terms)
            distinct.update(terms)
        docs.update(distinct)

    def size(self) -> int:
        return sum(len(n) for n, _ in self.groups.values())

    def flush(self) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in self.groups.items():
            terms: list[str | None] = [None, *(t.decode("utf-8", "replace") for t in n)]
            columns = [
                pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.string()),
                pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[t] for t in n)], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
        self.groups = {}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Held()
    for batch in batches:
        for k in range(batch.num_rows):
            held.add(batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), batch.column(2)[k].as_py())
            if k % 256 == 255 and held.size() > HELD:
                yield from held.flush()
        if held.size() > HELD:
            yield from held.flush()
    yield from held.flush()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of every term of every group.

    Each group also has one row with a NULL term. NULL texts, languages and sources are empty.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(blank(lang_col).alias("lang"), blank(source_col).alias("source"), F.col(text_col).cast("binary").alias("text"))
    found = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE * (n + 2) / (total + 2 * kept))`` in exact integers; NULL without kept terms."""
    wide = lambda c: c.cast("decimal(27,0)")
    return F.call_function("div", wide(n + F.lit(SMOOTH)) * F.lit(SCALE).cast("decimal(10,0)"), wide(total + F.lit(SMOOTH) * kept)) + F.lit(1)


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``; shares of at most SCALE + 1 keep the square within 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def scatter_row(acc: np.ndarray, p: np.ndarray, terms: np.ndarray, p0: int, start: np.ndarray, peer: np.ndarray, q: np.ndarray, q0: np.ndarray) -> None:
    """Adds one group's shared terms to its accumulator over the peers.

    ``start`` is the term-major index: postings ``start[t] : start[t + 1]`` of ``peer`` and ``q``
    belong to term ``t``. Each posting replaces what the two one-sided sums and the zero baseline
    count for this term and peer.
    """
    sizes = start[terms + 1] - start[terms]
    some = sizes > 0
    p, terms, sizes = p[some], terms[some], sizes[some]
    ends = np.cumsum(sizes)
    at = 0
    while at < len(terms):
        done = int(ends[at - 1]) if at else 0
        to = max(int(np.searchsorted(ends, done + GATHER, "right")), at + 1)
        n = sizes[at:to]
        places = np.repeat(start[terms[at:to]] - (ends[at:to] - n - done), n) + np.arange(int(n.sum()))
        h, theirs, mine = peer[places], q[places], np.repeat(p[at:to], n)
        value = _gap(mine, theirs) - _gap(mine, q0[h]) - _gap(np.int64(p0), theirs) + _gap(np.int64(p0), q0[h])
        np.add.at(acc, h, value)
        at = to


def _one_sided(values: np.ndarray, own0: int, zeros: np.ndarray) -> np.ndarray:
    """Over all terms of a group: its gaps to the zero shares of the peers, less the zero baseline."""
    out = np.zeros(len(zeros), np.int64)
    distinct, times = np.unique(values, return_counts=True)
    for at in range(0, len(distinct), 256):
        part = _gap(distinct[at : at + 256, None], zeros[None, :]) * times[at : at + 256, None]
        out += part.sum(axis=0)
    return out - _gap(np.int64(own0), zeros) * len(values)


def _tile(table: pa.Table) -> pa.Table:
    """Partial sums between the groups of two blocks over one shard of terms."""
    block, group = table.column("block").to_numpy(), table.column("gid").to_numpy()
    p, p0 = table.column("p").to_numpy(), table.column("p0").to_numpy()
    first, last, shard = (table.column(c)[0].as_py() for c in ("i", "j", "shard"))
    kept = table.column("v")[0].as_py()
    term = table.column("term").combine_chunks().dictionary_encode().indices
    heads = np.asarray(term.is_null())
    code = term.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    n_terms = int(code.max(initial=0)) + 1

    def side(b: int):
        head = heads & (block == b)
        order = np.argsort(group[head])
        ids, zeros = group[head][order], p0[head][order]
        mine = ~heads & (block == b)
        return ids, zeros, np.searchsorted(ids, group[mine]), code[mine], p[mine]

    ids_x, zero_x, row_x, term_x, p_x = side(first)
    ids_y, zero_y, row_y, term_y, p_y = side(last)
    by_term = np.argsort(term_y, kind="stable")
    start = np.concatenate([[0], np.cumsum(np.bincount(term_y, minlength=n_terms))])
    peer, q = row_y[by_term], p_y[by_term]
    acc = np.zeros((len(ids_x), len(ids_y)), np.int64)
    by_row = np.argsort(row_x, kind="stable")
    row_start = np.searchsorted(row_x[by_row], np.arange(len(ids_x) + 1))
    for x in range(len(ids_x)):
        mine = by_row[row_start[x] : row_start[x + 1]]
        scatter_row(acc[x], p_x[mine], term_x[mine], zero_x[x], start, peer, q, zero_y)
        acc[x] += _one_sided(p_x[mine], zero_x[x], zero_y)
        if shard == 0 and kept:
            acc[x] += kept * _gap(np.int64(zero_x[x]), zero_y)
    by_row = np.argsort(row_y, kind="stable")
    row_start = np.searchsorted(row_y[by_row], np.arange(len(ids_y) + 1))
    for y in range(len(ids_y)):
        acc[:, y] += _one_sided(p_y[by_row[row_start[y] : row_start[y + 1]]], zero_y[y], zero_x)
    x, y = (np.triu_indices(len(ids_x), 1)) if first == last else (k.ravel() for k in np.indices(acc.shape))
    return pa.table({"a": ids_x[x], "b": ids_y[y], "value": acc[x, y]})


def audit_sources(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    top: int = TOP_TERMS,
    block: int = BLOCK,
    shard: int = SHARD,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far each source is from every other, and its own terms.

    Part ``pair`` compares a group with each other source of its language over all kept terms
    (those in at least ``min_documents`` documents of the language); part ``term`` lists the ``top``
    kept terms that the group has more often than its language. Ranks follow the value, then the
    item's bytes. NULL texts, languages and sources count as empty ones; a group without terms is
    compared too; repeated rows count each time; an empty table gives an empty result; other
    columns are not read. Counts are exact up to 10^27 / SCALE.

    Counts are combined per task, so a source with a third of all rows sends its vocabulary, not
    its words. Groups are dealt to blocks and terms to shards; a task holds the postings of two
    blocks and one shard, and a dense accumulator per row. Only accumulators leave a task, never
    pairs of postings. What a group without a term contributes is a baseline of the zero shares.
    """
    counts = store(term_counts(docs, text_col, lang_col, source_col), "counts")
    kept = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = store(kept.where(F.col("docs") >= min_documents).drop("docs"), "kept")
    index = store(counts.where("term is not null").drop("docs").join(kept, ["lang", "term"]), "index")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = index.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    names = counts.where("term is null").select("lang", "source")
    sizes = names.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    shards = index.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    group = names.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang").join(shards, "lang", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    group = group.select("lang", "source", zero(F.col("total")).alias("total"), zero(F.col("v")).alias("v"), zero(F.col("lang_total")).alias("lang_total"), "blocks", F.coalesce("shards", F.lit(1)).alias("shards"))
    gid = F.monotonically_increasing_id()
    own_zero = F.coalesce(F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("v"))), F.lit(1)).cast("long")
    group = store(group.withColumn("gid", gid).withColumn("block", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int")).withColumn("p0", own_zero), "groups")

    shared = index.join(group, ["lang", "source"])
    shared = store(
        shared.select(
            "lang", "source", "term", "gid", "block", "blocks", "p0", "v", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"),
            share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"),
        ),
        "postings",
    )
    columns = ["lang", "term", "gid", "block", "blocks", "p0", "v", "shard", "p"]
    every = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    heads = group.select("lang", F.lit(None).cast("string").alias("term"), "gid", "block", "blocks", "p0", "v", every, F.lit(0).cast("long").alias("p"))
    rows = shared.select(*columns).unionByName(heads).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = rows.select("lang", "shard", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "gid", "term", "p", "p0", "v")
    found = tiles.groupBy("lang", "shard", "i", "j").applyInArrow(_tile, "a long, b long, value long")
    sums = store(found.groupBy("a", "b").agg(F.sum("value").alias("value")), "sums")
    both = sums.union(sums.select("b", "a", "value"))
    mine = group.select(F.col("gid").alias("a"), "lang", "source")
    peers = group.select(F.col("gid").alias("b"), F.col("source").alias("item"))
    pairs = both.join(mine, "a").join(peers, "b").select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = shared.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    place = F.row_number().over(order)
    return pairs.withColumn("rank", place).unionByName(terms.withColumn("rank", place).where(F.col("rank") <= top))
