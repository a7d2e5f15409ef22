"""Byte-level BPE by a sentencepiece model that is serialised from a rank file.

Every byte becomes one character (U+0100 + byte), every token of the rank file a piece whose score is its
negative rank, so that sentencepiece's best-score-first merging is lowest-rank-first merging. Normalisation is
the identity, without dummy prefix or white-space handling. Pre-tokens are matched beforehand; as in the
reference library for rank files, a pre-token that is itself a token gets its id without merging. Decoding maps
ids to pieces and the pieces' characters back to bytes.

Defined results: null text counts as empty and gets no ids; texts of any length are encoded whole; rows are
independent, so repeated rows, ties and null doc_ids get equal results; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from freshet.llm.common import library_threads_off, table, tidy
from freshet.llm.segments import Kept, TextEncoder, slices, split_at

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Cached parts of texts and pre-tokens of a worker: some 40 MB, as workers outlive this operator in a pipeline.
PARTS, MATCHES = 100_000, 60_000
#: Text bytes that are encoded at a time.
SLICE_BYTES = 1 << 20
FIRST_CHAR = 0x100
SEPARATOR = "\u2028"
_TO_CHARS = {b: FIRST_CHAR + b for b in range(256)}
_TO_BYTES = {FIRST_CHAR + b: b for b in range(256)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def mapped(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_CHARS)


def unmapped(piece: str) -> bytes:
    return piece.translate(_TO_BYTES).encode("latin-1")


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _float(field: int, x: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", x)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model; piece i is the token with the i-th lowest rank, the last piece is the unknown one."""
    tokens = sorted(ranks, key=ranks.get)
    # fixed numbers of the public sentencepiece_model.proto: piece type 1 normal, 2 unknown; model type 2 BPE
    pieces = [_bytes(1, _bytes(1, mapped(t).encode()) + _float(2, -float(ranks[t])) + _number(3, 1)) for t in tokens]
    pieces.append(_bytes(1, _bytes(1, b"<unk>") + _float(2, 0.0) + _number(3, 2)))
    trainer = _number(3, 2) + _number(4, len(pieces)) + _number(40, len(tokens)) + b"".join(_number(k, -1) for k in (41, 42, 43))
    normalizer = _bytes(1, b"identity") + _bytes(2, b"") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _bytes(2, trainer) + _bytes(3, normalizer)


class ByteBpe:
    """Encodes texts to ids and ids to bytes."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        self.tokens = sorted(self.ranks, key=self.ranks.get)
        self.ids = np.array([self.ranks[t] for t in self.tokens], dtype="<u4")
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        self.pieces = {self.ranks[t]: unmapped(self.model.id_to_piece(i)) for i, t in enumerate(self.tokens)}
        self.find = regex.compile(pattern).findall
        self.matched = Kept(self._matches, MATCHES)
        self.encode = TextEncoder(self._parts, PARTS)

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that may be joined (see TextEncoder)."""
        matches = self.find("".join(parts))
        self.matched.learn(set(matches))
        made = list(map(self.matched.__getitem__, matches))
        ends = split_at(np.fromiter(map(len, matches), "i8", len(matches)), [len(p) for p in parts]) if matches else []
        return [b"".join(made[a:b]) for a, b in zip([0, *ends], ends, strict=False)] if matches else [b""] * len(parts)

    def _matches(self, matches: list[str]) -> list[bytes]:
        data = [m.encode() for m in matches]
        new = [m for m in data if m not in self.ranks]
        known = {}
        if new:  # the separator is no piece's character: nothing merges across it, and it comes out as the unknown id
            ids = np.array(self.model.encode(SEPARATOR.join(map(mapped, new))), "i8")
            ends = np.append(np.flatnonzero(ids == len(self.tokens)), len(ids)).tolist()
            known = {m: self.ids[ids[a:b]].tobytes() for m, a, b in zip(new, [0, *(e + 1 for e in ends)], ends, strict=False)}
        return [known[m] if m in known else self.ranks[m].to_bytes(4, "little") for m in data]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def vocabulary_path(path: str | None = None) -> tuple[str, str]:
    """The rank file and the pre-token pattern; by default those of the installed public vocabularies."""
    import public_tokenizers

    return path or public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


@functools.lru_cache(1)
def encoder(path: str | None = None) -> ByteBpe:
    """One for each worker process, so that its caches outlive a task."""
    library_threads_off()
    return ByteBpe(*vocabulary_path(path))


def encode_documents(docs: DataFrame, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; with ``keep_ids`` also ids as array<int>. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            for a, b in slices(texts, SLICE_BYTES):
                made = bpe.encode(texts.slice(a, b - a))
                cols = [doc_ids.slice(a, b - a), pa.array([len(x) // 4 for x in made], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in made]), pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in made])]
                if keep_ids:
                    cols.append(pa.array([np.frombuffer(x, "<u4").astype("i4") for x in made], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(tidy(run), schema)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
