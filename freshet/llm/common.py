"""What the operators of this subpackage share: tables, stored steps and byte-level text helpers."""

from __future__ import annotations

import ctypes
import os
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.session import shared_folder as shared_dir
from freshet.session import ship as ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lower-cases A-Z in UTF-8 bytes and leaves all other bytes.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


#: Rows and bytes that go to Python at once, where the session has Spark's own settings: whole texts make large batches, whose buffers
#: stay with the executor as native memory.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", f"{8 << 20}b")}


def ship(spark: SparkSession) -> None:
    """Lets Python workers import the package, and keeps batches of whole texts small: where the session has Spark's own
    settings for batches, it gets smaller ones; settings of the caller's stay."""
    for name, (given, smaller) in BATCHES.items():
        if spark.conf.get(name, None) == given:
            spark.conf.set(name, smaller)
    ship_package(spark)


#: Settings of Python workers' allocators: large buffers go back to the system when they are freed. This costs a tenth of the CPU time.
LEAN = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": str(1 << 20)}


def lean(spark: SparkSession) -> None:
    """For runs of several operators, whose workers live on beside each other's data: ``ship``, and workers that keep less memory."""
    ship(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == BATCHES["spark.sql.execution.arrow.maxRecordsPerBatch"][1]:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    for name, value in LEAN.items():
        spark.sparkContext.environment.setdefault(name, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = shared_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


#: Where stored tables are, as long as their frames are in use.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def discarded(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more: all that was made from them is stored too."""
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(_PATHS.pop(t))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def few_files(df: DataFrame, rows: int, rows_a_file: int = 1_000_000) -> DataFrame:
    """A table of at most so many short rows, to be written as few files."""
    return df.coalesce(max(4, rows // rows_a_file))


def give_back() -> None:
    """Returns freed memory to the system: Python workers live on after a task and share their machine with others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(f: Callable) -> Callable:
    """A batch function that gives memory back when its task's batches are done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        give_back()

    return run


#: Tables up to so many bytes in memory are broadcast.
SMALL_BYTES = 32 << 20


def small_or_not(table_: DataFrame, row_bytes: int) -> DataFrame:
    """A written table, to be broadcast if its rows take no more than ``SMALL_BYTES``; else joins shuffle it."""
    return F.broadcast(table_) if table_.count() * row_bytes <= SMALL_BYTES else table_


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def place_of(df: DataFrame, name: str) -> int:
    """Number of a column, whose name may be written in another case."""
    return next(k for k, c in enumerate(df.columns) if c.lower() == name.lower())


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def id_residue(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo; null ids get -1 and so are never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))


def in_shuffle(spark: SparkSession, least: int = 8) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def library_threads_off() -> None:
    """Executors give one core to a task; libraries with thread pools of their own must not take more."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ.setdefault("OMP_NUM_THREADS", "1")
