"""Scores of whole texts under a unigram base and a log-bilinear neural model.

Tokens are a text's words (A-Z lower-cased, split at ASCII blanks) and one end. Training tokens are those of the documents whose
crc32 of the id modulo 7 is not 2.

The base needs every word's training count. Words go by 64-bit hashes. A first pass counts them within each task and deals the
counts to buckets by hash, where sorted arrays are merged batch by batch, so that memory follows a bucket's distinct words. The most frequent words
(``FREQUENT`` at most, 16 bytes each) are shipped to all executors; only the other words' occurrences are dealt to the buckets, with
the number of their block of documents, and come back summed. No word or document is a key that gathers rows.

The neural model knows every word that training holds at least ``least_count`` times; that count grows with the square root of the training
tokens, so that the vocabulary grows with the corpus while its vectors (136 bytes a word) fit in an executor. All rarer words are one symbol;
the end and the beginning are two more. Each task trains its own copy on all tokens of all its training documents, each
used once, in random order within a chunk; the copies' changes are averaged vector by vector, over the tasks that met the vector. The model therefore depends on how the input is split into tasks. A text's
score is the sum of its symbols' normalised log-probabilities, and for rarer words also that of the word among them (add-one unigram).

Defined results: null text counts as empty, with the end as its only token; a null doc_id is not held out; rows with
equal doc_ids are scored each; without training documents the base gives 0 and the neural model is uniform; texts are scored whole; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import log_bilinear
from freshet.llm.common import LOWER_BYTES, id_residue, stored, table, tidy
from freshet.llm.segments import slices

MODULUS, HELD_OUT = 7, 2
#: Training counts that a word of the model needs: this at least, and a SPARSE-th of the square root of the training tokens.
LEAST_COUNT, SPARSE = 3, 512
#: Words whose counts are shipped to the executors, at most.
FREQUENT = 1 << 18
#: Entries of distinct words that a task gathers before it adds them up; if half as many are left, it hands them on.
FLUSH = 2_000_000
#: Text bytes for each bucket of words; between LEAST and MOST buckets.
BUCKET_BYTES, LEAST_BUCKETS, MOST_BUCKETS = 8 << 20, 8, 4096
CHUNK_BYTES = 2_000_000


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LOWER_BYTES).split()


def hashed(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def packed(x: np.ndarray, kind: str) -> bytes:
    return x.astype(kind).tobytes()


def by_bucket(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """The non-empty buckets of sorted hashes."""
    bounds = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    for b, (x, y) in enumerate(zip(bounds.tolist(), [*bounds.tolist()[1:], len(hashes)], strict=True)):
        if x < y:
            yield b, slice(x, y)


# ---- counts


def _added(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of several parts by hash: sorted hashes, sums of training counts and of all counts."""
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    h = np.concatenate([x[0] for x in parts])
    order = np.argsort(h)
    h = h[order]
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.empty(0, np.int64)
    sums = (np.add.reduceat(np.concatenate([x[k] for x in parts])[order], first) if len(h) else np.empty(0, np.int64) for k in (1, 2))
    return h[first], *sums


def _counts(docs: DataFrame, bits: int) -> DataFrame:
    """Counts of each bucket's words as one row: bucket, hashes (sorted), train, seen (in all documents)."""
    arrow = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("train", pa.binary()), ("seen", pa.binary())])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            h, train, seen = _added(parts)
            rows = [{"bucket": b, "hashes": h[s].tobytes(), "train": packed(train[s], "<i8"), "seen": packed(seen[s], "<i8")} for b, s in by_bucket(h, bits)]
            parts.clear()
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

        for batch in batches:
            trains = (batch.column(1).to_numpy(zero_copy_only=False) != HELD_OUT).astype(float)
            for a, b in slices(batch.column(0), CHUNK_BYTES):
                h, word, lengths = _chunk(batch.column(0).slice(a, b - a))
                parts.append((h, np.bincount(word, np.repeat(trains[a:b], lengths), len(h)).astype(np.int64), np.bincount(word, minlength=len(h)).astype(np.int64)))
                held += len(h)
                if held >= FLUSH:
                    parts[:] = [_added(parts)]
                    held = len(parts[0][0])
                    if held >= FLUSH // 2:
                        yield from flush()
                        held = 0
        yield from flush()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, waiting, size = None, [], 0

        def done() -> pa.RecordBatch:
            h, train, seen = _added(waiting)
            return pa.RecordBatch.from_pylist([{"bucket": bucket, "hashes": h.tobytes(), "train": train.tobytes(), "seen": seen.tobytes()}], schema=arrow)

        for batch in batches:
            for b, *arrays in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket and waiting:
                    yield done()
                    waiting, size = [], 0
                bucket = b
                waiting.append((np.frombuffer(arrays[0], np.uint64), np.frombuffer(arrays[1], "<i8"), np.frombuffer(arrays[2], "<i8")))
                size += len(waiting[-1][0])
                if size > 2_000_000 and size > 2 * len(waiting[0][0]):
                    waiting = [_added(waiting)]
                    size = len(waiting[0][0])
        if waiting:
            yield done()

    fields = "bucket int, hashes binary, train binary, seen binary"
    return docs.select("text", "residue").mapInArrow(tidy(local), fields).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(merged), fields)


@dataclass
class Corpus:
    """What scoring needs of all documents' counts."""

    bits: int
    frequent: np.ndarray  # sorted hashes, the model's words among them
    frequent_train: np.ndarray
    frequent_symbols: np.ndarray
    symbols: np.ndarray  # sorted hashes of the model's words
    numbers: np.ndarray  # their symbols
    vocabulary: log_bilinear.Vocabulary
    other: int  # symbol of all other words
    end: int
    train_docs: int
    train_words: int
    train_types: int
    symbol_words: int  # training occurrences of the model's words

    @property
    def begin(self) -> int:
        return len(self.vocabulary.counts)

    @property
    def n(self) -> int:
        return self.train_words + self.train_docs

    @property
    def v(self) -> int:
        return self.train_types + (self.train_docs > 0)


def least_count(tokens: int) -> int:
    return max(LEAST_COUNT, math.isqrt(tokens) // SPARSE)


def corpus_of(docs: DataFrame, counts: DataFrame, bits: int) -> Corpus:
    share = max(16, 2 * FREQUENT >> bits)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(np.frombuffer(x, "<i8").sum()) for x in batch.column(0).to_pylist()], pa.int64())], names=["words"])

    least = least_count(counts.select("train").mapInArrow(tidy(added), "words long").agg(F.sum("words")).first()[0] or 0)

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, train, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h, train, seen = np.frombuffer(h, np.uint64), np.frombuffer(train, "<i8"), np.frombuffer(seen, "<i8")
                top = np.union1d(np.lexsort((h, -seen))[:share], np.flatnonzero(train >= least))
                cols = [[len(h[train > 0])], [int(train.sum())], [h[top].tobytes()], [train[top].tobytes()], [seen[top].tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["types", "words", "h", "train", "seen"])

    rows = counts.select("hashes", "train", "seen").mapInArrow(tidy(summary), "types long, words long, h binary, train binary, seen binary").collect()
    h, train, seen = (np.concatenate([np.frombuffer(r[k], t) for r in rows] or [np.empty(0, t)]) for k, t in ((2, np.uint64), (3, np.dtype("<i8")), (4, np.dtype("<i8"))))
    best = np.lexsort((h, -train))
    best = best[train[best] >= least]
    top = np.union1d(np.lexsort((h, -seen))[:FREQUENT], best)  # the model's words are always settled on the spot
    top = top[np.argsort(h[top])]
    train_docs, train_words, symbol_words = docs.where(F.col("residue") != HELD_OUT).count(), sum(r[1] for r in rows), int(train[best].sum())
    # symbols by falling count: the words, all other words, the end
    of_all = np.concatenate([train[best], [train_words - symbol_words, train_docs]])
    order = np.argsort(-of_all, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    sorted_ = np.argsort(h[best])
    vocabulary, symbols, numbers = log_bilinear.Vocabulary(of_all[order]), h[best][sorted_], number[:-2][sorted_]
    at, found = looked_up(symbols, h[top])
    of_frequent = np.where(found, numbers[at], number[-2]) if len(symbols) else np.full(len(top), number[-2])
    return Corpus(bits, h[top], train[top], of_frequent, symbols, numbers, vocabulary, int(number[-2]), int(number[-1]), train_docs, train_words, sum(r[0] for r in rows), symbol_words)


# ---- the neural model


def symbol_sequence(symbols: np.ndarray, lengths: np.ndarray, end: int, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word symbols of documents, one after the other -> second last, last and own symbol of each token, and its document."""
    ends = np.cumsum(lengths)
    own = np.insert(symbols, ends, end)
    doc = np.repeat(np.arange(len(lengths)), lengths + 1)
    at = np.arange(len(own)) - np.repeat(ends + np.arange(len(lengths)) - lengths, lengths + 1)
    last = np.where(at >= 1, np.roll(own, 1), begin)
    return np.where(at >= 2, np.roll(own, 2), begin), last, own, doc


def looked_up(keys: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each hash among the sorted keys, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, hashes), max(0, len(keys) - 1))
    return at, keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)


def _chunk(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct words, each word's number among them, and the documents' lengths. Words are split and numbered in Arrow."""
    plain = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    split = pc.ascii_split_whitespace(plain)
    words, lengths = split.flatten().cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()), pc.list_value_length(split).to_numpy().astype(np.int64)
    empty = pc.equal(plain, "").to_numpy(zero_copy_only=False)  # an empty text is one empty word here
    if empty.any():
        words, lengths = words.filter(pc.not_equal(pc.binary_length(words), 0)), np.where(empty, 0, lengths)
    numbered = words.dictionary_encode()
    hashes = hashed(numbered.dictionary.to_numpy(zero_copy_only=False))
    order, rank = np.argsort(hashes), np.empty(len(hashes), np.int64)
    rank[order] = np.arange(len(order))
    return hashes[order], rank[numbered.indices.to_numpy()], lengths


def _symbols(corpus: Corpus, h: np.ndarray) -> np.ndarray:
    at, found = looked_up(corpus.symbols, h)
    return np.where(found, corpus.numbers[at], corpus.other) if len(corpus.symbols) else np.full(len(h), corpus.other)


_PART = "block int, part int, change binary, weights binary"
_PART_ARROW = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("change", pa.binary()), ("weights", pa.binary())])


def _summed(parts: DataFrame, *keys: str) -> DataFrame:
    """Adds up the changes and weights of each block (and part), one row after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, change, weights = None, np.empty(0), np.empty(0)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"block": at[0], "part": at[1], "change": packed(change, "<f4"), "weights": packed(weights, "<f4")}], schema=_PART_ARROW)

        for batch in batches:
            for block, part, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                here, x, y = (block, part if "part" in keys else 0), np.frombuffer(x, "<f4").astype(float), np.frombuffer(y, "<f4").astype(float)
                if here != at:
                    if at is not None:
                        yield done()
                    at, change, weights = here, x, y
                else:
                    change, weights = change + x, weights + y
        if at is not None:
            yield done()

    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidy(run), _PART)


def trained(docs: DataFrame, corpus: Corpus) -> log_bilinear.Weights:
    """Trains on all tokens of all training documents."""
    shipped, own = docs.sparkSession.sparkContext.broadcast(corpus), docs.where(F.col("residue") != HELD_OUT).select("text")
    groups = max(1, math.isqrt(own.rdd.getNumPartitions()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, trainer = shipped.value, None
        for batch in batches:
            trainer = trainer or log_bilinear.Trainer(corpus.vocabulary)
            for a, b in slices(batch.column(0), CHUNK_BYTES):
                h, word, lengths = _chunk(batch.column(0).slice(a, b - a))
                x, y, z, _ = symbol_sequence(_symbols(corpus, h)[word], lengths, corpus.end, corpus.begin)
                trainer.feed(x, y, z)
        for block, change, weights in trainer.parts() if trainer else ():
            row = {"block": block, "part": TaskContext.get().partitionId() % groups, "change": packed(change * log_bilinear.spread(weights), "<f4"), "weights": packed(weights, "<f4")}
            yield pa.RecordBatch.from_pylist([row], schema=_PART_ARROW)

    # copies are added up in two rounds, so that no block gathers all tasks' copies at once
    got = _summed(_summed(own.mapInArrow(tidy(run), _PART), "block", "part"), "block").select("block", "change", "weights").collect()
    means = [(b, np.frombuffer(x, "<f4") / np.maximum(log_bilinear.spread(np.frombuffer(y, "<f4")), 1)) for b, x, y in got]
    return log_bilinear.averaged(corpus.vocabulary, means)


# ---- scores

_PACK = "chunk long, bucket int, x binary, y binary, z binary"
_PACK_ARROW = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("x", pa.binary()), ("y", pa.binary()), ("z", pa.binary())])
#: Bucket of a chunk's documents themselves.
OWN = -1
DOC = np.dtype([("doc_id", "<i8"), ("null", "?"), ("held", "?"), ("tokens", "<i8"), ("known", "<i8"), ("logs", "<f8"), ("others", "<i8"), ("other_logs", "<f8"), ("model", "<f8")])


def _score_chunks(docs: DataFrame, corpus: Corpus, model: log_bilinear.Weights) -> DataFrame:
    """A row for each chunk's documents, with all that is known on the spot, and one for each bucket of its rarer words."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast((corpus, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, model = shipped.value
        logs = np.log10(corpus.frequent_train + 1.0)
        for batch in batches:
            doc_ids, residues, rows = (batch.column(k).to_pylist() for k in (0, 2, 3))
            for a, b in slices(batch.column(1), CHUNK_BYTES):
                h, word, lengths = _chunk(batch.column(1).slice(a, b - a))
                n, doc = b - a, np.repeat(np.arange(b - a), lengths)
                at, common = looked_up(corpus.frequent, h)
                known = common & (corpus.frequent_train[at] > 0) if len(at) and len(logs) else np.zeros(len(h), bool)
                log = np.where(common, logs[at], 0.0) if len(logs) else np.zeros(len(h))
                symbol = np.where(common, corpus.frequent_symbols[at], corpus.other) if len(logs) else np.full(len(h), corpus.other)
                x, y, z, of = symbol_sequence(symbol[word], lengths, corpus.end, corpus.begin)
                other = symbol[word] == corpus.other
                out = np.zeros(n, DOC)
                out["doc_id"], out["null"] = [i or 0 for i in doc_ids[a:b]], [i is None for i in doc_ids[a:b]]
                out["held"], out["tokens"] = [r == HELD_OUT for r in residues[a:b]], lengths + 1
                out["known"] = np.bincount(doc, known[word], n).astype(np.int64) + (corpus.train_docs > 0)
                out["logs"] = np.bincount(doc, log[word], n) + math.log10(corpus.train_docs + 1)
                out["others"] = np.bincount(doc[other], minlength=n)
                out["other_logs"] = np.bincount(doc[other], log[word][other], n)
                out["model"] = np.bincount(of, model.log_probabilities(corpus.vocabulary, x, y, z) / math.log(10), n)
                made = [{"chunk": rows[a], "bucket": OWN, "x": out.tobytes(), "y": b"", "z": b""}]
                rare = ~common[word]
                # distinct (word, document), words in the order of their hashes
                pair, times = np.unique(word[rare] * n + doc[rare], return_counts=True)
                of_word = h[pair // n]
                for bucket, s in by_bucket(of_word, corpus.bits):
                    made.append({"chunk": rows[a], "bucket": bucket, "x": of_word[s].tobytes(), "y": packed((pair % n)[s], "<u4"), "z": packed(times[s], "<u4")})
                yield pa.RecordBatch.from_pylist(made, schema=_PACK_ARROW)

    return docs.select("doc_id", "text", "residue", "row").mapInArrow(tidy(run), _PACK)


def _rare_sums(spark: SparkSession, dealt: DataFrame, counts: DataFrame) -> DataFrame:
    """For each chunk and bucket: documents, sums of log10(count + 1), and known occurrences of its rarer words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, keys, train = None, np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            made = []
            for chunk, b, x, y, z in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if chunk is None:  # the bucket's counts come first
                    bucket, keys, train = b, np.frombuffer(x, np.uint64), np.frombuffer(y, "<i8")
                    continue
                if b != bucket:
                    raise ValueError("a bucket without counts")
                at, found = looked_up(keys, np.frombuffer(x, np.uint64))
                count, times = np.where(found, train[at], 0), np.frombuffer(z, "<u4")
                docs, of = np.unique(np.frombuffer(y, "<u4"), return_inverse=True)
                made.append({"chunk": chunk, "bucket": b, "x": docs.tobytes(), "y": np.bincount(of, times * np.log10(count + 1.0)).tobytes(), "z": packed(np.bincount(of, times * (count > 0)), "<i8")})
            yield pa.RecordBatch.from_pylist(made, schema=_PACK_ARROW)

    tables = counts.select(F.lit(None).cast("long").alias("chunk"), "bucket", F.col("hashes").alias("x"), F.col("train").alias("y"), F.lit(b"").alias("z"))
    both = dealt.where(F.col("bucket") != OWN).unionByName(tables)
    return both.repartition("bucket").sortWithinPartitions("bucket", F.col("chunk").asc_nulls_first()).mapInArrow(tidy(run), _PACK)


def _finished(parts: DataFrame, corpus: Corpus) -> DataFrame:
    """Adds up each chunk's rows, buckets in order, and gives a row a document."""
    whole, other = math.log10(corpus.n + corpus.v + 1), math.log10(corpus.train_words - corpus.symbol_words + corpus.train_types - len(corpus.symbols) + 1)
    total = corpus.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for chunk, bucket, x, y, z in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket == OWN:
                    if out is not None:
                        yield rows(out)
                    out = np.frombuffer(x, DOC).copy()
                    continue
                docs, logs, known = np.frombuffer(x, "<u4"), np.frombuffer(y, "<f8"), np.frombuffer(z, "<i8")
                out["logs"][docs] += logs
                out["other_logs"][docs] += logs
                out["known"][docs] += known
        if out is not None:
            yield rows(out)

    def rows(out: np.ndarray) -> pa.RecordBatch:
        base = out["logs"] - out["tokens"] * whole
        score = out["model"] + out["other_logs"] - out["others"] * other
        cols = [pa.array(out["doc_id"], pa.int64(), mask=out["null"]), pa.array(out["held"]), pa.array(out["tokens"]), pa.array(out["known"]), pa.array(np.full(len(out), total)), pa.array(base), pa.array(score)]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return parts.repartition("chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(tidy(run), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    own = own.withColumn("residue", id_residue(F.col("doc_id"), MODULUS)).withColumn("row", F.monotonically_increasing_id())
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = math.ceil(math.log2(min(MOST_BUCKETS, max(LEAST_BUCKETS, size / BUCKET_BYTES))))
    counts = stored(spark, _counts(own, bits), "word-counts")
    corpus = corpus_of(own, counts, bits)
    model = trained(own, corpus)
    dealt = stored(spark, _score_chunks(own, corpus, model), "scored-chunks")
    return _finished(dealt.where(F.col("bucket") == OWN).unionByName(_rare_sums(spark, dealt, counts)), corpus)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark, table(spark, sf_dir, "documents"))
