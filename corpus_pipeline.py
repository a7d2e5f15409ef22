"""A corpus pipeline of five stages, from raw documents to token digests.

language ID (documents without a language go) -> exact dedup (of equal texts the largest doc_id stays) -> near-duplicate groups
of a similarity of 0.8 or more (the smallest doc_id of each stays) -> benchmark decontamination (documents that hold an item go) -> byte-level BPE.

Each stage works on all that its predecessor kept. Its table is written to the shared folder and read again.
Empty tables, null texts and repeated rows have the results that the operators' modules define; where rows share a
doc_id, near dedup drops them only together, and never drops rows with a null doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import bpe, content_sort, decontaminate, language_id, minhash
from freshet.llm.common import id_residue, lean, small_or_not, stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Predicts every document's language and keeps those that get one."""
    lean(spark)
    decoder = language_id.train(docs.where(id_residue(F.col("doc_id"), 4) != 2))
    return language_id.accepted(spark, docs, decoder)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    return content_sort.exact_kept(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    found = stored(spark, minhash.near_duplicates(spark, docs, *minhash.LOOSE), "near-duplicates")
    gone = found.where("NOT kept").select("doc_id").join(found.where("kept").select("doc_id"), "doc_id", "left_anti").distinct()
    gone = small_or_not(stored(spark, gone, "near-duplicates-gone"), minhash.KEY_BYTES)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    return decontaminate.decontaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lean(spark)
    return bpe.encode_documents(docs)


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte-level BPE", tokens),
]

#: The language, near-duplicate and tokenizer stages have no SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    lean(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
