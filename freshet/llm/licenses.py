"""License scan: ordered signature rules with a keyword gate, priorities and suppression of contained intervals.

A text is lower-cased (A-Z) and cut into words; all other ASCII characters separate. The rules' regular
expressions run over the words joined by single spaces, each only where its keyword occurs. Of the detections, those are
dropped whose interval of words lies within that of another one with a higher priority, or with the same priority and a
longer interval, or the same interval and an earlier rule. Base phrases are counted at all their places and are never dropped.

Score: 0 without a detection; 0.4 for a base phrase alone; else 0.5, 0.8 or 1 by the highest priority that is left.

Defined results: null text counts as empty, with no words and empty labels; texts of any length are scanned whole;
rows are independent, so repeated rows and null doc_ids get what their text gives; extra columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from freshet.llm.common import table, tidy
from freshet.llm.license_rules import BASE, RULES

_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Lower-cases A-Z and makes every byte that is in no word a space.
_TO_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 32 for b in range(256))
SCORES = {0: 0.4, 1: 0.5, 2: 0.8, 3: 1.0}


class Detection(NamedTuple):
    start: int  # first word
    end: int  # one past the last word
    label: str
    priority: int  # 0: base phrase
    rule: int


@functools.cache
def compiled(rules: tuple = tuple(RULES), base: tuple = BASE) -> tuple[list, dict[bytes, list]]:
    phrases = [(label, phrase.split()[0].encode(), re.compile(b" " + phrase.encode() + b"(?= )")) for phrase, label in base]
    by_keyword: dict[bytes, list] = {}
    for i, (priority, label, keyword, pattern) in enumerate(rules):
        by_keyword.setdefault(keyword.encode(), []).append((priority, label, i, re.compile(b" (?:" + pattern.encode() + b")(?= )")))
    return phrases, by_keyword


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


def places(pattern: re.Pattern, joined: bytes) -> Iterator[tuple[int, int]]:
    """First and one past the last word of each match; the spaces before a place number it."""
    at = word = 0
    for m in pattern.finditer(joined):
        word += joined.count(b" ", at, m.start())
        at = m.start()
        yield word, word + m.group().count(b" ")


def outermost(found: list[Detection]) -> list[Detection]:
    """Drops what lies within a stronger detection. Sorted by start, an interval is contained if an earlier one ends as late."""
    kept: list[Detection] = []
    for priority in (3, 2, 1):
        own, spans = sorted((d for d in found if d.priority == priority), key=lambda d: (d.start, -d.end, d.rule)), sorted((d.start, d.end) for d in kept)
        reach = last = at = 0
        left = []
        for d in own:
            while at < len(spans) and spans[at][0] <= d.start:
                reach, at = max(reach, spans[at][1]), at + 1
            if d.end > reach and d.end > last:
                left.append(d)
                last = d.end
        kept += left
    return sorted(kept)


def scan(text: str | None) -> tuple[int, list[Detection], list[Detection]]:
    """Number of words, base places, and the detections of the rules that are left."""
    phrases, by_keyword = compiled()
    split = words(text)
    joined = b" " + b" ".join(split) + b" "
    base = [Detection(a, b, label, 0, i) for i, (label, keyword, p) in enumerate(phrases) if keyword in joined for a, b in places(p, joined)]
    found = [Detection(a, b, label, priority, i) for keyword, rules in by_keyword.items() if keyword in joined for priority, label, i, p in rules for a, b in places(p, joined)]
    return len(split), base, outermost(found)


def detections(docs: DataFrame) -> DataFrame:
    """One row a detection: doc_id, label, priority, rule (-1: base), first_word, last_word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, d.label, d.priority, d.rule if d.priority else -1, d.start, d.end - 1) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for found in scan(t)[1:] for d in found]
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "label", "priority", "rule", "first_word", "last_word"])

    return _read(docs).mapInArrow(tidy(run), "doc_id long, label string, priority int, rule int, first_word long, last_word long")


def summaries(docs: DataFrame) -> DataFrame:
    """One row a document: counts, base places, labels and score. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, base, found = scan(text)
                labels = {d.label for d in base}
                score = max([0.0, *(SCORES[d.priority] for d in (*base, *found))])
                rows.append((doc_id, n, len(base), min((d.start for d in base), default=None), max((d.start for d in base), default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {d.label for d in found})), score))
            cols = list(zip(*rows, strict=True)) or [[]] * 8
            i, s = pa.int64(), pa.string()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (i, i, i, i, i, s, s, pa.float64()), strict=True)], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return _read(docs).mapInArrow(tidy(run), "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries(table(spark, sf_dir, "documents"))
