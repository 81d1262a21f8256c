"""Spelling variants: dense tiles of code-point matrices find all single edits between words."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import store

MIN_LENGTH, MIN_COUNT, RATIO, NOISE = 7, 2, 10, 31
#: Words of a bin on average, of one side of a tile, and rows of it that are compared at once.
BIN, SIDE, STRIP = 512, 2048, 128
#: Code points of one side of a tile; longer words make tiles of fewer words.
SIDE_POINTS = 1 << 22
#: Distinct words that a task holds before it passes its counts on, and characters of text it splits at once.
HELD, PIECE = 500_000, 1 << 22

#: In Latin-1, letters and 0xC0-0xFF stay, A-Z are lower-cased, all else becomes a blank.
_RUN_BYTES = bytes(c if 97 <= c <= 122 or c >= 0xC0 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def run_pieces(text: str) -> Iterator[list[bytes]]:
    """Lower-cased letter runs of one text as Latin-1, some megabytes at a time; no run is cut."""
    at = 0
    while at < len(text):
        piece = text[at : at + PIECE].encode("latin-1", "replace").translate(_RUN_BYTES)
        end = len(piece)
        if at + PIECE < len(text):
            end = piece.rfind(b" ") + 1
            if end == 0:  # a run longer than a piece: take it whole
                piece = text[at:].encode("latin-1", "replace").translate(_RUN_BYTES)
                blank = piece.find(b" ")
                end = len(piece) if blank < 0 else blank
        yield piece[:end].split()
        at += end


def noisy_words(doc_id: int | None, text: str, least: int, noise: int, into: Counter) -> None:
    """Adds the words of one text; ``noise`` deletes a letter of every so many-th run by its checksum with the id."""
    runs: Counter[bytes] = Counter()
    for found in run_pieces(text):
        runs.update(found)
    salt = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        if len(run) < least:
            continue
        if noise:
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), salt)
            if h % noise == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
                if len(run) < least:
                    continue
        into[run] += n


def document_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, noise: int = 0) -> DataFrame:
    """``(word, n)``: letter runs of whole texts with at least ``min_length`` code points and ``min_count`` occurrences.

    NULL texts have no words; a NULL id is an empty string in the checksum of ``noise``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py()
                if text:
                    noisy_words(batch.column(0)[k].as_py(), text.decode("utf-8", "replace"), min_length, noise, held)
                if len(held) > HELD:
                    yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text"))
    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def _matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and the code points of the words from the front and from the back, padded with 0 to ``width`` columns."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    known, codes = np.unique(points, return_inverse=True)
    kind = np.uint8 if len(known) < 256 else np.uint16 if len(known) < 65536 else np.uint32
    row = np.repeat(np.arange(len(words)), lengths)
    ends = np.cumsum(lengths)
    column = np.arange(len(points)) - np.repeat(ends - lengths, lengths)
    front, back = np.zeros((2, len(words), width), kind)
    front[row, column] = codes + 1
    back[row, np.repeat(lengths, lengths) - 1 - column] = codes + 1
    return lengths, front, back


def common_length(x: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """Length of the common start of every row of ``x`` with every row of ``y``, over ``width`` columns."""
    same = np.ones((len(x), len(y)), bool)
    out = np.zeros((len(x), len(y)), np.int32)
    for c in range(width):
        same &= x[:, c, None] == y[None, :, c]
        if not same.any():
            break
        out += same
    return out


def _tile(table: pa.Table) -> pa.Table:
    """Near words between two blocks of a bin: per word their number and the best of them.

    The bin holds words of ``l`` and ``l + 1`` code points; two of the longer ones belong to another
    bin. Common start plus common end reach the longer length less one exactly for single edits. A
    pair with a common start of at least half is counted where starts agree, any other where ends do.
    """
    l, by_end = table.column("l")[0].as_py(), table.column("side")[0].as_py()
    block, n = table.column("block").to_numpy(), table.column("n").to_numpy()
    words = table.column("word").to_pylist()
    size, front, back = _matrices(words, l + 1)
    order = np.array(sorted(range(len(words)), key=lambda k: (-n[k], words[k])), np.int64)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    first, last = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    same, x, y = first == last, np.flatnonzero(block == first), np.flatnonzero(block == last)
    count = np.zeros(len(words), np.int64)
    best = np.full(len(words), len(words), np.int64)
    for at in range(0, len(x), STRIP):
        p = x[at : at + STRIP]
        start = common_length(front[p], front[y], l)
        near = (start >= l // 2) != bool(by_end)
        if not near.any():
            continue
        longer = np.maximum(size[p][:, None], size[y][None, :])
        near &= start + common_length(back[p], back[y], l) >= longer - 1
        near &= ~((size[p] > l)[:, None] & (size[y] > l)[None, :])
        if same:
            near &= p[:, None] < y[None, :]
        a, b = np.nonzero(near)
        a, b = p[a], y[b]
        count += np.bincount(a, minlength=len(words)) + np.bincount(b, minlength=len(words))
        np.minimum.at(best, a, place[b])
        np.minimum.at(best, b, place[a])
    hit = np.flatnonzero(count)
    top = order[best[hit]]
    return pa.table({"word": pa.array([words[k] for k in hit], pa.string()), "near": count[hit], "best_n": n[top], "best": pa.array([words[k] for k in top], pa.string())})


def near_words(words: DataFrame, bin_words: int = BIN, side: int = SIDE) -> DataFrame:
    """``(word, n_near, best, best_n)`` of all words of ``words(word, n)`` that have a word one edit away.

    ``best`` is the near word of largest ``n``, the smallest in code-point order of equal ones. A
    single edit leaves at least half of the shorter word untouched at its start or its end, so words
    are dealt to bins by these halves; a bin is compared in dense tiles of bounded size, and a half
    that very many words share is cut into blocks whose pairs are tasks of their own.
    """
    size = F.length("word")
    lengths = F.explode(F.array(size, size - 1)).alias("l")
    rows = words.select("word", "n", lengths).where("l >= 1").withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    half = F.floor(F.col("l") / 2).cast("int")
    gram = F.when(F.col("side") == 0, F.substring(F.col("word"), F.lit(1), half)).otherwise(F.substring(F.col("word"), F.length("word") - half + 1, half))
    rows = rows.withColumn("key", F.xxhash64(gram))
    bins = store(rows.groupBy("l", "side").agg(F.ceil(F.count(F.lit(1)) / bin_words).cast("int").alias("bins")), "bins")
    dealt = store(rows.join(bins, ["l", "side"]).select("word", "n", "l", "side", F.pmod("key", "bins").cast("int").alias("bin")), "dealt")
    room = F.greatest(F.least(F.lit(side), F.floor(F.lit(SIDE_POINTS) / (F.col("l") + 1))), F.lit(1))
    full = store(dealt.groupBy("l", "side", "bin").agg(F.ceil(F.count(F.lit(1)) / F.first(room)).cast("int").alias("blocks")), "blocks")
    placed = dealt.join(full, ["l", "side", "bin"]).withColumn("block", F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = placed.select("l", "side", "bin", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "word", "n")
    found = tiles.groupBy("l", "side", "bin", "i", "j").applyInArrow(_tile, "word string, near long, best_n long, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("k"), F.col("best")))
    merged = found.groupBy("word").agg(F.sum("near").alias("n_near"), top.alias("m"))
    return merged.select("word", "n_near", F.col("m")["best"].alias("best"), (-F.col("m")["k"]).alias("best_n"))


def follow(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``forms(word, form)`` without cycles: the end of each chain, by doubling."""
    roots = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = store(roots.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        roots = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return roots


def spelling_variants(words: DataFrame, ratio: Column | int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per word of ``words(word, n)`` (distinct, not NULL).

    A word's ``form`` is its most frequent near word (one inserted, deleted or replaced code point;
    ties: the smallest), if that occurs at least ``ratio`` times as often; ``root`` is the end of the
    chain of forms. An empty table gives an empty result.
    """
    words = store(words.select("word", "n"), "words")
    near = near_words(words)
    enough = F.col("best_n") >= F.col("n") * F.lit(ratio)
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n")
    )
    found = store(found, "forms")
    roots = follow(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
