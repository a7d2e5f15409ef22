"""Tumbling bins over a stream or a table, late rows dropped after the watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def streamed_bins(df: DataFrame, keys: Sequence[str], minutes: int, *aggregates: Column, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """The same bins as the batch operator; on a stream, state of closed bins is freed."""
    source = df.withWatermark(ts, late) if df.isStreaming else df
    got = source.groupBy(*keys, F.window(ts, f"{minutes} minutes").alias("w")).agg(*aggregates)
    return got.withColumn("bin", F.col("w.start")).drop("w").select(*keys, "bin", *(c for c in got.columns if c not in (*keys, "w")))
