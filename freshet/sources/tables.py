"""Readers with fixed schemas, and writers."""

from __future__ import annotations

import gzip
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.ids import clean_headers
from freshet.session import ship

FORMATS = {".parquet": "parquet", ".csv": "csv", ".json": "json", ".orc": "orc"}


def service_schema() -> str:
    place = "geoLocation: struct<geogLocation: struct<latitude: double, longitude: double>>"
    source = f"sourceInfo: struct<siteName: string, siteCode: array<struct<value: string>>, {place}>"
    value = "value: array<struct<value: string, dateTime: string, qualifiers: array<string>>>"
    return f"value struct<timeSeries: array<struct<{source}, variable: struct<unit: struct<unitCode: string>>, values: array<struct<{value}>>>>>"


def csv(spark: SparkSession, path: str, schema: str, time_format: str | None = None, comment: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True)
    if time_format:
        reader = reader.option("timestampFormat", time_format)
    return (reader.option("comment", comment) if comment else reader).csv(path)


def csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Types are found by a pass over the file; pipelines give a schema instead."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def stations(spark: SparkSession, path: str) -> DataFrame:
    """A station list: comments, all columns text, headers cleaned."""
    return clean_headers(spark.read.option("header", True).option("comment", "#").option("inferSchema", False).csv(path))


def by_suffix(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    suffix = path[path.rindex(".") :]
    if suffix not in FORMATS:
        raise ValueError(f"{suffix} is none of {sorted(FORMATS)}")
    reader = spark.read.format(FORMATS[suffix]).option("header", True)
    return (reader.schema(schema) if schema else reader).load(path)


def days(spark: SparkSession, base: str, first: str, last: str) -> DataFrame:
    """Day shards (folders day=yyyyMMdd) of a period; other days are not opened."""
    return spark.read.option("basePath", base).parquet(base).where(F.col("day").between(int(first), int(last)))


def with_file_id(df: DataFrame, pattern: str, name: str = "storm_id", kind: str = "long", wanted: Sequence[int] | None = None) -> DataFrame:
    """Adds the id in each row's file name; rows of files that don't match, or aren't wanted, go."""
    got = df.withColumn(name, F.nullif(F.regexp_extract(F.input_file_name(), pattern, 1), F.lit("")).cast(kind)).where(F.col(name).isNotNull())
    return got if wanted is None else got.where(F.col(name).isin(list(wanted)))


def service_rows(documents: DataFrame, column: str = "body") -> DataFrame:
    """Landed web-service answers, one JSON text a row, as (STAID, site_name, datetime, discharge_cfs, qualifiers, units, latitude, longitude)."""
    parsed = documents.select(F.from_json(column, service_schema()).alias("d")).select(F.explode("d.value.timeSeries").alias("s"))
    rows = parsed.select("s", F.explode(F.col("s.values")[0]["value"]).alias("v"))
    at = "s.sourceInfo.geoLocation.geogLocation"
    return rows.select(
        F.col("s.sourceInfo.siteCode")[0]["value"].alias("STAID"), F.col("s.sourceInfo.siteName").alias("site_name"), F.try_to_timestamp("v.dateTime").alias("datetime"),
        F.nullif("v.value", F.lit("")).try_cast("double").alias("discharge_cfs"), F.array_join(F.coalesce("v.qualifiers", F.array().cast("array<string>")), ",").alias("qualifiers"),
        F.col("s.variable.unit.unitCode").alias("units"), F.col(f"{at}.latitude").alias("latitude"), F.col(f"{at}.longitude").alias("longitude"),
    )


def raw_grid(data: bytes) -> np.ndarray:
    """The plain decoder: gzipped little-endian float32 behind two int32 for rows and columns. Others can be plugged in."""
    body = gzip.decompress(data)
    rows, columns = np.frombuffer(body, "<i4", 2)
    return np.frombuffer(body, "<f4", offset=8).reshape(rows, columns)


def grids(spark: SparkSession, path: str, decode: Callable[[bytes], np.ndarray] = raw_grid, columns: int | None = None) -> DataFrame:
    """Binary grid files as (path, cell_id, rate); negative rates mean no data and are left out."""
    ship(spark)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                grid = decode(content)
                r, c = np.nonzero(grid >= 0)
                yield pd.DataFrame({"path": name, "cell_id": r.astype("i8") * (columns or grid.shape[1]) + c, "rate": grid[r, c].astype("f8")})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, cell_id long, rate double")


# ---- sinks


def write_partitioned(df: DataFrame, path: str, *keys: str, mode: str = "overwrite") -> None:
    """Parquet by partition; rows of a partition come from few tasks, and skewed ones are split."""
    (df.hint("rebalance", *keys) if keys else df).write.mode(mode).partitionBy(*keys).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file, for result tables of report size."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_document(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").text(path)


def write_resumed(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Appends the rows whose keys the target doesn't have, and returns (keys.., status)."""
    spark = df.sparkSession
    try:
        done = spark.read.schema(df.schema).parquet(path).select(*keys).distinct()
        done.limit(1).collect()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        done = spark.createDataFrame([], df.select(*keys).schema)
    status = df.select(*keys).distinct().join(done.withColumn("_d", F.lit(True)), list(keys), "left").select(*keys, F.when(F.col("_d"), "skipped").otherwise("written").alias("status"))
    report = [tuple(r) for r in status.collect()]  # one row a key of a manifest
    df.join(done, list(keys), "left_anti").write.mode("append").parquet(path)
    return spark.createDataFrame(report, status.schema)
