"""Exact deduplication by sorting whole contents.

Spark samples splitters and range-partitions by (first ``HEAD`` characters and 64-bit hash of the normalised text, doc_id, tie); each
partition is sorted externally by first characters, hash, whole text, doc_id and tie, so that equal texts lie next to each
other. As doc_id and tie are part of the key, a group of copies of any size spreads over as many partitions as its bytes
need. Whole texts are not: Spark keeps about 100 splitter rows a partition in the driver, so whole texts would make it grow with their length
(of 30 GB in texts of 2 kB, some 600 MB; a few texts of many MB are enough to end it). Among texts that begin alike the hash
decides the order, so that no common beginning gathers in one partition; equality is always that of whole texts. One pass over a sorted partition
compares whole neighbouring texts. Groups that lie inside a partition are settled there. Those with the hash of the
partition's first or last row may go on in a neighbour: for each of them the partition adds one summary row (digest, count, row that
stays), in general two a partition, and the summaries of one text are merged.

Defined results: null text counts as empty, so nulls and empty texts form one group; a null doc_id is smaller
than any other; of rows with equal text and equal doc_id one stays (``exact_kept`` says which); an empty table gives no rows; extra columns are
ignored, whatever their names; texts are compared whole, whatever their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import LOWER, UPPER, free_name, lower_ascii, small_or_not, stored, table, tidy

#: Characters of a text that its splitters see.
HEAD = 64
#: Bytes that a row of digest and ids takes once it is broadcast, about.
ROW_BYTES = 240

_ROWS = "doc_id long, tie long, text_sha256 string, keep_id long, keep_tie long, group_size long, edge boolean, summary boolean"
_ARROW = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[c.split()[1]]) for c in _ROWS.split(", ")])


def _runs(batches: Iterator[pa.RecordBatch], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, tie, hash, text) of a sorted partition -> rows with their group's result, or with ``edge`` where
    neighbouring partitions may add to it."""
    out: list[tuple] = []
    groups: list[tuple[str, list, list]] = []  # of the current hash: digest, ids, ties
    text = mark = None
    first = True

    def close(edge: bool) -> None:
        """Ends the current hash's groups."""
        for digest, ids, ties in groups:
            n = len(ids)
            kept = (None, None, None) if edge else (ids[-1], ties[-1], n)
            out.extend((i, t, digest, *kept, edge, False) for i, t in zip(ids, ties, strict=True))
            if edge:
                out.append((None, None, digest, ids[-1], ties[-1], n, True, True))
        groups.clear()

    def full() -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[]] * len(_ARROW)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)
        out.clear()
        return batch

    for batch in batches:
        for doc_id, tie, own, new in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if text != new:
                if text is not None and own != mark:
                    close(edge=first)
                    first = False
                text, mark = new, own
                groups.append((hashlib.sha256(new.encode()).hexdigest(), [], []))
            groups[-1][1].append(doc_id)
            groups[-1][2].append(tie)
            if len(out) >= size:
                yield full()
    close(edge=True)
    yield full()


def exact_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, tie: the largest doc_id of each text stays."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("tie"), lower_ascii(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("norm"))
    rows = rows.withColumn("head", F.substring("norm", 1, HEAD)).withColumn("mark", F.xxhash64("norm"))
    ordered = rows.repartitionByRange("head", "mark", "doc_id", "tie").sortWithinPartitions("head", "mark", "norm", "doc_id", "tie")
    found = stored(spark, ordered.select("doc_id", "tie", "mark", "norm").mapInArrow(tidy(_runs), _ROWS), "content-sort")
    sums = found.where("summary").groupBy("text_sha256").agg(F.sum("group_size").alias("all_size"), F.max(F.struct("keep_id", "keep_tie")).alias("stays"))
    sums = stored(spark, sums, "content-sort-edges")
    sums = small_or_not(sums, ROW_BYTES)
    inner = found.where("NOT edge").select("doc_id", "keep_id", "group_size", (F.col("tie") == F.col("keep_tie")).alias("kept"), "text_sha256", "tie")
    outer = (
        found.where("edge AND NOT summary")
        .join(sums, "text_sha256")
        .select("doc_id", F.col("stays.keep_id").alias("keep_id"), F.col("all_size").alias("group_size"), (F.col("tie") == F.col("stays.keep_tie")).alias("kept"), "text_sha256", "tie")
    )
    return inner.unionByName(outer)


def exact_kept(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns. Only ids and digests are sorted out; texts are read again and stay where they are.

    Of rows that share both text and doc_id, that with the least hash of all its columns stays.
    """
    digest, id_, of = (free_name(docs, c) for c in ("digest", "id", "of"))
    found = stored(spark, exact_groups(spark, docs).select("doc_id", "keep_id", "text_sha256"), "content-sort-rows")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    gone = stored(spark, found.where(~stays).select(F.col("doc_id").alias(id_), F.col("text_sha256").alias(of)).distinct(), "content-sort-gone")
    twice = stored(spark, found.where(stays).groupBy("text_sha256").count().where("count > 1").select(F.col("text_sha256").alias(digest)), "content-sort-twice")
    own = docs.withColumn(digest, F.sha2(lower_ascii(F.coalesce(docs["text"].cast("string"), F.lit(""))), 256))
    left = own.join(small_or_not(gone, ROW_BYTES), (F.col(digest) == F.col(of)) & own["doc_id"].cast("long").eqNullSafe(F.col(id_)), "left_anti")
    if twice.limit(1).count():
        twice, whole = small_or_not(twice, ROW_BYTES), F.struct(*(F.col(f"`{c}`") for c in docs.columns))
        one = left.join(twice, digest, "left_semi").groupBy(digest).agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias(of)).select(digest, f"{of}.*")
        left = left.join(twice, digest, "left_anti").select(digest, *(F.col(f"`{c}`") for c in docs.columns)).unionByName(one)
    return left.select(*(F.col(f"`{c}`") for c in docs.columns))


def op8_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(spark, table(spark, sf_dir, "documents")).drop("tie")


ORACLE_SQL = {
    "op8_content_sort": f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
        FROM d"""
}
