"""Joins, de-duplication and set reports whose semantics plain Spark calls don't give directly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_ordinal(df: DataFrame, *order: str, name: str = "ord") -> DataFrame:
    """Numbers rows 1.. in a total order. For small result tables: the order needs one task."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def one_by(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row for each key: the first in an order of several columns."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def first_by(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """First row wins, by an ordinal that is unique within its key. One partial aggregation instead of a sort."""
    rest = [c for c in df.columns if c not in keys]
    got = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(ordinal)).alias("_row"))
    return got.select(*keys, *(F.col(f"_row.`{c}`").alias(c) for c in rest)).select(*df.columns)


def last_by(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """Last row wins, as where a dictionary is filled row by row."""
    rest = [c for c in df.columns if c not in keys]
    got = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(ordinal)).alias("_row"))
    return got.select(*keys, *(F.col(f"_row.`{c}`").alias(c) for c in rest)).select(*df.columns)


def looked_up(df: DataFrame, key: str, table: DataFrame, table_key: str, value: str, ordinal: str, name: str, how: str = "left") -> DataFrame:
    """Dictionary lookup: the table's last row for a key answers, so rows never fan out."""
    answers = last_by(table.select(table_key, value, ordinal), [table_key], ordinal).select(F.col(table_key).alias("_k"), F.col(value).alias(name))
    return df.join(answers, F.col(key) == F.col("_k"), how).drop("_k")


def chained(divides: DataFrame, nexus: DataFrame, flowpaths: DataFrame) -> DataFrame:
    """divide -> nexus -> flowpath -> divide by three lookups: the edges (up, down). Each table has an ``ord``."""
    step = looked_up(divides, "toid", nexus, "id", "toid", "ord", "path", "inner").where("path IS NOT NULL")
    return looked_up(step, "path", flowpaths, "id", "divide_id", "ord", "down", "inner").where("down IS NOT NULL").select(F.col("divide_id").alias("up"), "down")


def subset(df: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is wanted, and the wanted keys without a row."""
    return df.join(wanted.select(key), key, "left_semi"), wanted.select(key).distinct().join(df.select(key), key, "left_anti")


def matched(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The inner join, and both sides' keys without a partner."""
    return left.join(right, key), left.select(key).distinct().join(right.select(key), key, "left_anti"), right.select(key).distinct().join(left.select(key), key, "left_anti")


def either_join(left: DataFrame, right: DataFrame, first: Column, second: Column, columns: Sequence[Column]) -> DataFrame:
    """A join on (first OR second) as the union of two equi-joins: an OR alone would compare all pairs."""
    return left.join(right, first).select(*columns).union(left.join(right, second).select(*columns)).distinct()


def without_ends(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Drops the first and the last row of each key with more than two rows; the order is unique within a key."""
    ends = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(order).alias("_a"), F.max(order).alias("_b"))
    return df.join(ends, list(keys)).where(~((F.col("_n") > 2) & ((F.col(order) == F.col("_a")) | (F.col(order) == F.col("_b"))))).select(*df.columns)


def pending(wanted: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a resumed run still has to do."""
    return wanted.join(done.select(*keys), list(keys), "left_anti")


def shared_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().join(b.select(key), key, "left_semi")
