"""Token ids as length-delimited binary records with masked checksums and a separate offset index.

Data file (``.rec``), for each document in ascending doc_id order:
    u64 length of the payload | u32 masked CRC-32 of those 8 bytes | payload | u32 masked CRC-32 of the payload
Payload: i64 doc_id | u8 flags (1: doc_id is null) | u8 bytes of an id (2 or 4) | ids, all little-endian.
Index file (``.idx``) beside it: for each record i64 doc_id | u64 offset of the record | u64 number of ids, so that a
trainer can read records in any order. The mask is the rotation and addition that public record formats use.

Documents are range-partitioned and sorted by doc_id, tokenised where they land, and written by the same task
under a name that depends on the partition only; a file appears when whole, so repeated tasks are harmless.
Files are read as streams, record by record.

Defined results: null text counts as empty, its record holds the end id only; null doc_ids come first; rows with
equal doc_ids are all written, one after the other; an empty table gives no files and no rows; extra columns are
ignored; a text that is longer than a file is meant to be becomes one record in one file. The string of a special token within a text
gets that token's id, as the library gives it.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.llm.common import library_threads_off, shared_dir, stored, table, tidy
from freshet.llm.files import random_access, reading, writing
from freshet.llm.segments import TextEncoder, slices, split_at

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
#: A file is closed when it has so many bytes.
FILE_BYTES = 64 << 20
MASK_DELTA = 0xA282EAD8
HEAD, INDEX = struct.Struct("<qBB"), struct.Struct("<qQQ")
#: Parts of texts that the library encodes at a time.
JOINED = 500


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def read_frame(f) -> bytes | None:
    """The next payload of a stream, None at its end; raises ValueError where a checksum or a length is wrong."""
    if not (head := f.read(12)):
        return None
    if len(head) < 12 or masked(head[:8]) != struct.unpack("<I", head[8:])[0]:
        raise ValueError("record length is damaged")
    (n,) = struct.unpack("<Q", head[:8])
    payload, tail = f.read(n), f.read(4)
    if len(payload) < n or len(tail) < 4 or masked(payload) != struct.unpack("<I", tail)[0]:
        raise ValueError("record is damaged")
    return payload


def to_payload(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return HEAD.pack(doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()


def from_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, null, width = HEAD.unpack_from(payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=HEAD.size).astype("<u4")


def index_entry(doc_id: int | None, offset: int, n_ids: int) -> bytes:
    return INDEX.pack(doc_id or 0, offset, n_ids)


def read_index(uri: str) -> list[tuple[int, int, int]]:
    with reading(uri) as f:
        return list(INDEX.iter_unpack(f.read()))


def read_at(uri: str, offset: int) -> tuple[int | None, np.ndarray]:
    """One record by its offset from the index: the shuffled read."""
    with random_access(uri) as f:
        f.seek(offset)
        return from_payload(read_frame(f))


class LibraryEncoder:
    """Texts -> ids by the tokenizers library, parts of texts joined and cached."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        byte_of = {c: b for b, c in enumerate(_byte_chars())}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = "|".join(map(re.escape, sorted(special)))
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4
        self.sizes = np.zeros(max(vocabulary.values()) + 1, "i8")
        for token, i in vocabulary.items():
            self.sizes[i] = len(token.encode()) if token in special or any(c not in byte_of for c in token) else len(token)
        self.by_parts = TextEncoder(self._parts)

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of whole texts. Texts that hold the string of an added token go to the library as they are, since such a string is a match of its own."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        marked = pc.match_substring_regex(texts, self.special).to_numpy(zero_copy_only=False) if self.special else np.zeros(len(texts), bool)
        if not marked.any():
            return self.by_parts(texts)
        plain = iter(self.by_parts(texts.filter(pa.array(~marked))))
        whole = (np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts.filter(pa.array(marked)).to_pylist())
        return [next(whole) if m else next(plain) for m in marked.tolist()]

    def _parts(self, parts: list[str]) -> list[bytes]:
        out = []
        joined = [parts[i : i + JOINED] for i in range(0, len(parts), JOINED)]
        made = self.tokenizer.encode_batch_fast(["".join(x) for x in joined], add_special_tokens=False)
        for group, encoding in zip(joined, made, strict=True):
            ids = np.array(encoding.ids, "<u4")
            ends = (4 * split_at(self.sizes[ids], [len(p) if p.isascii() else len(p.encode()) for p in group])).tolist() if len(ids) else [0] * len(group)
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return out


def _byte_chars() -> list[str]:
    """The character that byte-level vocabularies use for each byte: itself if printable, else the next one from U+0100."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in keep else next(free)) for b in range(256)]


@functools.lru_cache(1)
def encoder(path: str | None = None) -> LibraryEncoder:
    library_threads_off()
    import public_tokenizers

    return LibraryEncoder(path or public_tokenizers.path(VOCABULARY))


def write_records(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the documents' records; one row a file: part, seq (ascending doc_id order), data, index, n_records, n_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, rows = TaskContext.get().partitionId(), 0, documents(batches)
        row = next(rows, None)
        while row is not None:
            data = f"{folder}/part-{part:06d}-{seq:04d}.rec"
            index, at, n_records, n_ids = bytearray(), 0, 0, 0
            with writing(data) as f:
                while row is not None and (not at or at < file_bytes):
                    doc_id, ids = row
                    f.write(record := frame(to_payload(doc_id, ids, encoder(path).width)))
                    index += index_entry(doc_id, at, len(ids))
                    at, n_records, n_ids = at + len(record), n_records + 1, n_ids + len(ids)
                    row = next(rows, None)
            with writing(data[:-3] + "idx") as f:
                f.write(bytes(index))
            yield pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "data": data, "index": data[:-3] + "idx", "n_records": n_records, "n_ids": n_ids}], schema=arrow)
            seq += 1

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, np.ndarray]]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in slices(texts):
                for doc_id, ids in zip(doc_ids[a:b], encoder(path).encode(texts.slice(a, b - a)), strict=True):
                    yield doc_id, np.frombuffer(ids + end, "<u4")

    arrow = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("data", pa.string()), ("index", pa.string()), ("n_records", pa.int64()), ("n_ids", pa.int64())])
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    # the second key deals rows of one doc_id to more than one partition
    ordered = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return ordered.select("doc_id", "text").mapInArrow(tidy(run), "part int, seq int, data string, index string, n_records long, n_ids long")


def read_records(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Reads the files back: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                with reading(data) as f:
                    while (payload := read_frame(f)) is not None:
                        doc_id, ids = from_payload(payload)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield to_batch(rows)
                            rows = []
                yield to_batch(rows)

    def to_batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 4)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # one row a file of many MB goes through this window, no document
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("data", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    tasks = max(1, min(10_000, files.count()))
    return starts.repartition(tasks).mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = stored(spark, write_records(table(spark, sf_dir, "documents"), shared_dir(spark, "records")), "record-files")
    return read_records(spark, files)


def manifest(files: DataFrame) -> str:
    """A small JSON description of the data set for trainers; the files themselves are listed in the table."""
    n, ids = files.agg(F.sum("n_records"), F.sum("n_ids")).first()
    return json.dumps({"records": n or 0, "ids": ids or 0, "end_id": END_ID, "format": "u64 length, masked crc, payload, masked crc"})
