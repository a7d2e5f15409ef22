"""Irregular series to regular bins, filling, interpolation, gaps and coverage.

Series are long: key columns, a time ``ts`` and a value. Missing values are null, never NaN.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions import times


def nan_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """Spark's aggregates count NaN as a value; readers of series drop it first."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})


def binned(df: DataFrame, keys: Sequence[str], minutes: int, *aggregates: Column, ts: str = "ts", name: str = "bin") -> DataFrame:
    """Tumbling bins, closed and labelled on the left. Bins without rows are absent; see ``densified``."""
    return df.groupBy(*keys, times.floored(F.col(ts), minutes).alias(name)).agg(*aggregates)


def first_in_bin(value: str, ts: str = "ts") -> Column:
    """The first value of a bin that is not null."""
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(ts)))


def densified(df: DataFrame, keys: Sequence[str], minutes: int, ts: str = "bin") -> DataFrame:
    """Adds the absent bins between each key's first and last one, with nulls."""
    span = df.groupBy(*keys).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    grid = span.select(*keys, F.explode(times.grid(F.col("_a"), F.col("_b"), minutes)).alias(ts))
    return grid.join(df, [*keys, ts], "left")


def forward_filled(df: DataFrame, keys: Sequence[str], value: str, ts: str = "bin") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(w))


def filled_both_ways(df: DataFrame, keys: Sequence[str], value: str, ts: str = "bin") -> DataFrame:
    """Linear in time between known values; the first and the last known value are held outwards."""
    known = F.when(F.col(value).isNotNull(), F.struct(F.unix_micros(ts).alias("t"), F.col(value).alias("v")))
    back, on = Window.partitionBy(*keys).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*keys).orderBy(ts).rowsBetween(0, Window.unboundedFollowing)
    both = df.withColumn("_p", F.last(known, ignorenulls=True).over(back)).withColumn("_n", F.first(known, ignorenulls=True).over(on))
    share = (F.unix_micros(ts) - F.col("_p.t")) / F.nullif(F.col("_n.t") - F.col("_p.t"), F.lit(0)).cast("double")
    between = F.col("_p.v") + (F.col("_n.v") - F.col("_p.v")) * share
    return both.withColumn(value, F.coalesce(F.col(value), between, F.col("_p.v"), F.col("_n.v"))).drop("_p", "_n")


def quarter_hours(df: DataFrame, keys: Sequence[str], sums: Sequence[str], levels: Sequence[str], ts: str = "ts") -> DataFrame:
    """Hourly rows to four rows each: sums are split evenly, levels interpolated towards the next row (the last is held)."""
    w = Window.partitionBy(*keys).orderBy(ts)
    ahead = df.withColumns({f"_{c}": F.lead(c, 1).over(w) for c in levels} | {"_last": F.lead(ts, 1).over(w).isNull()}) if levels else df
    four = ahead.withColumn("_k", F.explode(F.array(*(F.lit(k) for k in range(4)))))
    values = {c: F.col(c) / 4.0 for c in sums} | {c: F.when(F.col("_last"), F.col(c)).otherwise(F.col(c) * (1 - F.col("_k") / 4.0) + F.col(f"_{c}") * (F.col("_k") / 4.0)) for c in levels}
    return four.withColumns(values).withColumn(ts, times.plus_minutes(F.col(ts), F.col("_k") * 15)).select(*df.columns)


def differenced(df: DataFrame, keys: Sequence[str], value: str, name: str, ts: str = "bin") -> DataFrame:
    return df.withColumn(name, F.col(value) - F.lag(value).over(Window.partitionBy(*keys).orderBy(ts)))


def islands(df: DataFrame, keys: Sequence[str], flag: Column, ts: str = "bin") -> DataFrame:
    """Runs of equal flags: keys, flag, start, end, n."""
    w = Window.partitionBy(*keys).orderBy(ts)
    changed = df.withColumn("flag", flag).withColumn("_new", F.coalesce((F.col("flag") != F.lag("flag").over(w)).cast("int"), F.lit(1)))
    numbered = changed.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_run").agg(F.first("flag").alias("flag"), F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("n")).drop("_run")


def longest_gap(df: DataFrame, keys: Sequence[str], value: str, ts: str = "bin") -> DataFrame:
    """Length of the longest run of missing bins of a dense series; 0 without any."""
    return islands(df, keys, F.col(value).isNull(), ts).groupBy(*keys).agg(F.coalesce(F.max(F.when(F.col("flag"), F.col("n"))), F.lit(0)).alias("longest_gap"))


def coverage(df: DataFrame, keys: Sequence[str], minutes: int, start: Column, end: Column, value: str = "value", ts: str = "ts") -> DataFrame:
    """Non-empty bins, expected bins and their ratio over a period, both ends included."""
    step = minutes * times.MINUTE
    expected = F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(step)).cast("long") + 1
    inside = df.where(F.col(ts).between(start, end) & F.col(value).isNotNull())
    # bins are counted by partial aggregation on the bin before the key
    bins = inside.groupBy(*keys, times.floored(F.col(ts), minutes).alias("_bin")).agg(F.count("*").alias("_n"))
    return bins.groupBy(*keys).agg(F.count("*").alias("bins")).withColumn("expected", expected).withColumn("coverage", F.col("bins") / F.col("expected").cast("double"))
