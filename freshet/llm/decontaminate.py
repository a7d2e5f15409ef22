"""Benchmark decontamination: documents that hold a benchmark item, give or take a fifth of its words.

Items and documents are sequences of words (A-Z lower-cased; all other ASCII but digits separates). A document leaks an item of m
words if some stretch of it is at most floor(m / 5) word edits away from the whole item.

1. An item is taken whole, or, if it has more than ``LONGEST`` words, in even parts of at most so many: of d edits in all, some part
   has no more than a fifth of its own words. Windows of a part's size are placed where the document shares enough runs of three words
   with it (of two or one for the shortest items) at about the same alignment. This loses nothing: d edits touch at most 3 d of a part's
   runs and move the others by d words at most against each other.
2. Each window is embedded by CGK random walks: step by step the walk emits the word it stands on and moves on or
   stays by a random bit of (walk, step, word), so that sequences at a small edit distance agree in most steps.
3. Bit-sampling LSH: each table hashes a few sampled steps of one walk; a window is a candidate for the parts of its size
   that share its key in any table. ``WALKS`` and ``TABLES`` are set for a recall of over 0.99 at the full number of edits; longer
   walks would lose step, hence the parts.
4. Candidate places of an item that are close to each other are verified together: exact edit distance of the whole item against the
   best stretch around them.

The benchmark is read in blocks whose index takes about ``BLOCK_BYTES`` in a worker, whatever the items' sizes; the index is a few sorted arrays. Each
block is collected, shipped to the executors, held against all documents in one pass without a shuffle and dropped again, so a larger benchmark
costs passes, not memory. Repeated items are dealt to the blocks like others.

Defined results: null text and text without words leak nothing; items without words are leaked by nothing; items with equal texts and rows
with equal doc_ids are reported each; empty tables give no rows; texts are searched whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import discarded, free_name, small_or_not, stored, table, tidy
from freshet.llm.licenses import words
from freshet.llm.shingles import mix

#: One edit for each so many words of the item: a similarity of 0.8.
WORDS_AN_EDIT = 5
WALKS, TABLES, SAMPLED = 12, 8, 2
#: Words of a part of an item.
LONGEST = 200
#: Bytes of a block's index: of a part with its keys and their numbers, and of a word with its run and its entry among the known words.
BLOCK_BYTES = 96 << 20
PART_BYTES, WORD_BYTES = 12 * WALKS * TABLES + 100, 200
#: Bytes that a digest takes once it is broadcast, about.
DIGEST_BYTES = 160
RUN = 3
_FILTER_BITS = 20
_RUN_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
PAD = np.uint64(0)


class Leak(NamedTuple):
    item: int  # number in the block
    distance: int
    start: int  # first word
    end: int  # one past the last word


def runs(h: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of ``size`` words."""
    if len(h) < size:
        return h[:0]
    n = len(h) - size + 1
    return mix(sum(h[k : n + k] * _RUN_FACTORS[k] for k in range(size)) + np.uint64(size))


def edit_distance(item: np.ndarray, part: np.ndarray) -> tuple[int, int, int]:
    """Least distance of the item to any stretch of the part, and that stretch (the first to end, the shortest)."""
    steps = np.arange(len(part) + 1)
    cost, start = np.zeros(len(part) + 1, np.int64), steps.copy()
    for i, w in enumerate(item, 1):
        swap, drop = cost[:-1] + (part != w), cost[1:] + 1
        best = np.concatenate(([i], np.minimum(swap, drop)))
        origin = np.concatenate(([0], np.where(swap <= drop, start[:-1], start[1:])))
        # inserting words: the running minimum of cost less position, and where it came from
        least = np.minimum.accumulate(best - steps)
        came = np.maximum.accumulate(np.where(best - steps == least, steps, 0))
        cost, start = least + steps, origin[came]
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


class Walks:
    """CGK embeddings of windows of one size, at the sampled steps only."""

    def __init__(self, size: int):
        self.size = size
        rng = np.random.default_rng([size, 5])
        steps = max(1, int(2 * size - 3 * size**0.5))  # before most walks reach the end
        self.sampled = rng.integers(0, steps, (WALKS, TABLES, SAMPLED))
        self.steps = int(self.sampled.max()) + 1
        self.salts = rng.integers(1, 1 << 63, (self.steps, WALKS), dtype=np.uint64)
        self.factors = rng.integers(0, 1 << 62, SAMPLED, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """windows: n by size -> n by walk by table."""
        n = len(windows)
        padded = np.hstack([windows, np.full((n, 1), PAD, np.uint64)])
        at, rows = np.zeros((n, WALKS), np.int64), np.arange(n)[:, None]
        emitted = np.empty((self.steps, n, WALKS), np.uint64)
        for j in range(self.steps):
            emitted[j] = word = padded[rows, at]
            at = np.minimum(at + (mix(word ^ self.salts[j]) & np.uint64(1)).astype(np.int64), self.size)
        out = np.empty((n, WALKS, TABLES), np.uint64)
        for w in range(WALKS):
            got = emitted[self.sampled[w], :, w]  # table, sample, window
            out[:, w, :] = mix((got * self.factors[None, :, None]).sum(axis=1, dtype=np.uint64)).T
        return out

    def all_keys(self, windows: np.ndarray) -> np.ndarray:
        """windows: n by size -> n by (walk, table); equal keys of different tables differ."""
        return mix(self.keys(windows).reshape(len(windows), -1) + np.arange(WALKS * TABLES, dtype=np.uint64))


class Index:
    """A block of items, ready to be held against documents."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        split = [words(t) for _, t in items]
        #: Only the items' words are told apart; every other word is 0.
        self.known = {w: k for k, w in enumerate(sorted({w for s in split for w in s}), 1)}
        self.hashes = np.array([0, *map(xxhash.xxh3_64_intdigest, self.known)], np.uint64)
        self.items = [self.numbered(s) for s in split]
        self.edits = np.array([len(h) // WORDS_AN_EDIT for h in self.items], np.int64)
        cuts = [(i, len(h) * k // n, len(h) * (k + 1) // n) for i, h in enumerate(self.items) if len(h) for n in [-(-len(h) // LONGEST)] for k in range(n)]
        #: By part: its item, its first word there, its size, and the runs that it must share with a document.
        self.item_of, self.offset, end = np.array(cuts, np.int64).reshape(-1, 3).T
        self.sizes = end - self.offset
        self.part_edits = self.sizes // WORDS_AN_EDIT
        size = np.array([self.run_size(m) for m in self.sizes.tolist()], np.int64)
        self.least_runs = np.maximum(1, self.sizes - size + 1 - size * self.part_edits)

    def part(self, p: int) -> np.ndarray:
        return self.items[self.item_of[p]][self.offset[p] : self.offset[p] + self.sizes[p]]

    def numbered(self, split: list[bytes]) -> np.ndarray:
        return self.hashes[np.fromiter(map(self.known.get, split, repeat(0)), np.int64, len(split))]

    def run_size(self, m: int) -> int:
        """A stretch with d of m words edited keeps a run of at least ceil((m - d) / (d + 1)) words."""
        d = m // WORDS_AN_EDIT
        return min(RUN, -(-(m - d) // (d + 1)))

    @cached_property
    def found_at(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By run size: a small filter, the sorted runs, their parts and offsets."""
        out = {}
        for size in range(1, RUN + 1):
            own = [(p, runs(self.part(p), size)) for p, m in enumerate(self.sizes.tolist()) if self.run_size(m) == size]
            if own:
                values = np.concatenate([r for _, r in own])
                order = np.argsort(values, kind="stable")
                seen = np.zeros(1 << _FILTER_BITS, bool)
                seen[values >> np.uint64(64 - _FILTER_BITS)] = True
                out[size] = seen, values[order], np.concatenate([np.full(len(r), p, np.int32) for p, r in own])[order], np.concatenate([np.arange(len(r), dtype=np.int32) for _, r in own])[order]
        return out

    @cached_property
    def tables(self) -> dict[int, tuple[Walks, np.ndarray, np.ndarray]]:
        """By size of parts: the walks, the sorted keys of all tables, and the part of each."""
        out = {}
        for m in np.unique(self.sizes).tolist():
            walks, own = Walks(m), np.flatnonzero(self.sizes == m)
            keys = np.concatenate([walks.all_keys(np.stack([self.part(p) for p in own[a : a + 512].tolist()])) for a in range(0, len(own), 512)]).ravel()
            order = np.argsort(keys)
            out[m] = walks, keys[order], np.repeat(own.astype(np.int32), WALKS * TABLES)[order]
        return out

    def windows(self, h: np.ndarray) -> dict[int, np.ndarray]:
        """By size: the sorted starts of windows worth a look."""
        starts: dict[int, list[int]] = {}
        for size, (seen, values, parts, offsets) in self.found_at.items():
            r = runs(h, size)
            at = np.flatnonzero(seen[r >> np.uint64(64 - _FILTER_BITS)])
            low, high = np.searchsorted(values, r[at], "left"), np.searchsorted(values, r[at], "right")
            n = high - low
            if not n.sum():
                continue
            entry = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            part, start = parts[entry], np.repeat(at, n) - offsets[entry]
            order = np.lexsort((start, part))
            part, start = part[order], start[order]
            own, first, count = np.unique(part, return_index=True, return_counts=True)
            enough = count >= self.least_runs[own]
            for p, a, k in zip(own[enough].tolist(), first[enough].tolist(), count[enough].tolist(), strict=True):
                mine, least = start[a : a + k], int(self.least_runs[p])
                close = mine[least - 1 :] - mine[: k - least + 1] <= self.part_edits[p]
                inside = np.cumsum(np.bincount(np.flatnonzero(close), minlength=k + 1) - np.bincount(np.flatnonzero(close) + least, minlength=k + 1))[:k] > 0
                starts.setdefault(int(self.sizes[p]), []).extend(np.unique(mine[inside]).tolist())
        return {m: np.unique(x) for m, x in starts.items()}

    def candidates(self, h: np.ndarray) -> dict[int, list[int]]:
        """By item: the sorted places in the document where it may begin, as far as its parts show."""
        places: dict[int, set[int]] = {}
        for m, starts in self.windows(h).items():
            walks, values, parts = self.tables[m]
            for a in range(0, len(starts), 256):
                at = starts[a : a + 256, None] + np.arange(m)
                inside = (at >= 0) & (at < len(h))
                keys = walks.all_keys(np.where(inside, h[np.clip(at, 0, len(h) - 1)], PAD))
                low, high = np.searchsorted(values, keys, "left"), np.searchsorted(values, keys, "right")
                for k, t in zip(*(x.tolist() for x in np.nonzero(high > low)), strict=True):
                    for p in set(parts[low[k, t] : high[k, t]].tolist()):
                        places.setdefault(int(self.item_of[p]), set()).add(int(starts[a + k] - self.offset[p]))
        return {i: sorted(x) for i, x in places.items()}

    def leaks(self, text: str | None) -> list[Leak]:
        """For each item that leaks, the stretch at the least distance."""
        h = self.numbered(words(text))
        best: dict[int, Leak] = {}
        for i, places in (self.candidates(h) if len(h) else {}).items():
            m, edits = len(self.items[i]), int(self.edits[i])
            around = edits if m <= LONGEST else 2 * edits  # a part may stand so far from its place in the item
            gaps = [k for k in range(1, len(places)) if places[k] - places[k - 1] > edits]
            for a, b in zip([0, *gaps], [*gaps, len(places)], strict=True):
                low = max(0, places[a] - around)
                d, start, end = edit_distance(self.items[i], h[low : max(0, places[b - 1] + m + around)])
                if d <= edits and (i not in best or (d, low + start) < (best[i].distance, best[i].start)):
                    best[i] = Leak(i, d, low + start, low + end)
        return sorted(best.values())


def blocks(spark: SparkSession, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Index]:
    """The benchmark's items, one block after the other."""
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text"), F.monotonically_increasing_id().alias("tie")).where("text IS NOT NULL")
    items = stored(spark, items, "items")
    # a word has a blank after it: no more words than half of the bytes, and one in about five
    total = items.agg(F.sum(PART_BYTES + F.octet_length("text").cast("long") * (WORD_BYTES // 5))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        if rows := items.where(F.pmod(F.xxhash64("tie"), F.lit(n)) == k).select("item_id", "text").collect():
            yield Index(sorted(((r[0], r[1]) for r in rows), key=lambda x: (x[0] is None, x)))
    discarded(spark, items)


_LEAK = "doc_id long, item_id long, first_word long, n_words long, distance long, similarity double"


def _leaks_of(docs: DataFrame, shipped: Broadcast) -> DataFrame:
    """One row for each row (doc_id, text) and item of one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            got = [(i, own.ids[x.item], x.start, x.end - x.start, x.distance, 1 - x.distance / len(own.items[x.item])) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for x in own.leaks(t)]
            cols = list(zip(*got, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if k == 5 else pa.int64()) for k, c in enumerate(cols)], names=["doc_id", "item_id", "first_word", "n_words", "distance", "similarity"])

    return docs.mapInArrow(tidy(run), _LEAK)


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each document and item that it holds: doc_id, item_id, first_word, n_words, distance, similarity."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    out = spark.createDataFrame([], _LEAK)
    for index in blocks(spark, benchmark, block_bytes):
        shipped = spark.sparkContext.broadcast(index)
        out = out.unionByName(stored(spark, _leaks_of(rows, shipped), "leaks"))
        shipped.unpersist()
    return out


def decontaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that hold no item, with all their columns. Whether a document goes depends on its text alone, so digests of such texts say which."""
    digest, gone = free_name(docs, "digest"), None
    text = docs["text"].cast("string")
    for index in blocks(spark, benchmark, block_bytes):
        shipped = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts if shipped.value.leaks(t)], pa.string())], names=["digest"])

        found = stored(spark, docs.select(text.alias("text")).where("text IS NOT NULL").mapInArrow(tidy(run), "digest string").distinct(), "leaking")
        shipped.unpersist()
        gone = found if gone is None else gone.unionByName(found)
    if gone is None:
        return docs
    gone = small_or_not(gone.withColumnRenamed("digest", digest), DIGEST_BYTES)
    left = docs.withColumn(digest, F.coalesce(F.sha2(text, 256), F.lit(""))).join(gone, digest, "left_anti")
    return left.select(*(F.col(f"`{c}`") for c in docs.columns))


def op3_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
