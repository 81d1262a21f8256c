"""Byte-level BPE through a sentencepiece model that is written directly from the vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

#: Pre-tokens whose ids a task remembers; beyond them it starts anew.
REMEMBERED = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 token and rank per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def byte_letters() -> list[str]:
    """One printable letter per byte: printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b if b in kept else next(free)) for b in range(256)]


def build_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model: piece ``rank`` is the token's letters with score ``-rank``.

    Normalisation is the identity, nothing is added or trimmed, and one unknown piece, which
    no text reaches because every byte is a piece, comes last. Ranks must be 0 .. n-1.
    """
    letters = byte_letters()
    model = proto.ModelProto()
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if rank != len(model.pieces):
            raise ValueError(f"rank {rank} of {token!r}: ranks must count up from 0")
        model.pieces.add(piece="".join(letters[b] for b in token), score=float(-rank), type=proto.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    t, n = model.trainer_spec, model.normalizer_spec
    t.model_type, t.vocab_size, t.unk_id = proto.TrainerSpec.BPE, len(model.pieces), len(model.pieces) - 1
    t.bos_id = t.eos_id = t.pad_id = -1
    n.name, n.precompiled_charsmap = "identity", b""
    n.add_dummy_prefix = n.remove_extra_whitespaces = n.escape_whitespaces = False
    return model.SerializeToString()


class Encoder:
    """Encodes and decodes with the serialised model; made once per task."""

    def __init__(self, model: bytes, ranks: dict[bytes, int], pattern: str):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.letters = {b: ord(c) for b, c in enumerate(byte_letters())}
        # A pre-token that is a token as a whole is not split, even where no merges lead to it.
        self.whole = ranks
        self.known: dict[str, list[int]] = {}

    def _encode(self, piece: str) -> list[int]:
        raw = piece.encode()
        rank = self.whole.get(raw)
        return [rank] if rank is not None else self.model.encode(raw.decode("latin-1").translate(self.letters))

    def encode(self, text: str) -> np.ndarray:
        known, out = self.known, []
        for piece in self.split(text):
            ids = known.get(piece)
            if ids is None:
                ids = self._encode(piece)
                if len(piece) <= 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = ids
            out += ids
        return np.array(out, np.int32)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: token ids of every whole text, each match of ``pattern`` encoded by itself.

    NULL and empty texts have no ids. Rows are independent: repeated rows, NULL ids and
    further columns change nothing; an empty table gives an empty result. The rank file must
    be readable where the job is planned; its ranks travel with the job.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))  # one vocabulary, about 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in batches:
            if coder is None:
                coder = Encoder(build_model(ranks.value), ranks.value, pattern)
            ids = [coder.encode(x.as_py() or "") for x in batch.column(1)]
            ends = np.cumsum([0, *map(len, ids)])
            values = pa.array(np.concatenate(ids) if ids else np.array([], np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds ``decoded``: the bytes of ``ids`` by the inverse mapping of the vocabulary. NULL ids are no bytes."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = [t for t, _ in sorted(ranks.value.items(), key=lambda x: x[1])]
        for batch in batches:
            column = batch.column("ids")
            out = [b"".join(map(tokens.__getitem__, ids.tolist())) for ids in _lists(column)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
        values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            yield values[a:b]

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")


def token_report(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` after encoding and decoding every text."""
    both = decode(encode(docs, ranks_path, pattern, id_col, text_col), ranks_path)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
