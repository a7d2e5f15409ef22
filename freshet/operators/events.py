"""Event windows, range joins with observations, manifests and download plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions import times

HALF_MINUTES, WARMUP_MINUTES, STEPS = 3600, 43_200, 480


def event_windows(events: DataFrame, begin: str = "begin", end: str = "end", half: int = HALF_MINUTES, warmup: int = WARMUP_MINUTES) -> DataFrame:
    """centre, warm_start, start, stop, n_steps: warm-up [warm_start, start), event [start, stop], quarter-hour steps."""
    c = times.midpoint(F.col(begin), F.col(end))
    own = events.withColumn("centre", c)
    start = times.floored(times.plus_minutes(F.col("centre"), -half), 60)
    stop = times.plus_minutes(times.floored(times.plus_minutes(F.col("centre"), half), 60), 60)
    own = own.withColumn("start", start).withColumn("stop", stop).withColumn("warm_start", times.plus_minutes(F.col("start"), -warmup))
    n = F.floor((F.unix_micros(times.plus_minutes(F.col("centre"), half)) - F.unix_micros("start")) / F.lit(15 * times.MINUTE)).cast("long")
    return own.withColumn("n_steps", F.least(n, F.lit(2 * half // 15).cast("long")))


def deduplicated(events: DataFrame, gauge: str, centre: str = "centre", ordinal: str = "event_id") -> DataFrame:
    """First event of each gauge and hour of the centre."""
    rest = list(events.columns)
    got = events.groupBy(gauge, times.floored(F.col(centre), 60).alias("_hour")).agg(F.min_by(F.struct(*rest), F.col(ordinal)).alias("_row"))
    return got.select(*(F.col(f"_row.`{c}`").alias(c) for c in rest))


def range_join(windows: DataFrame, obs: DataFrame, start: str, stop: str, ts: str, days: int = 1, closed: bool = True, on: tuple[str, ...] = ()) -> DataFrame:
    """Windows with the observations inside them. Windows are dealt to buckets of so many days, which gives an equi-join; each pair
    meets in one bucket only. Long windows want wide buckets."""
    size = F.lit(days * 1440 * times.MINUTE)
    bucket = lambda c: F.floor(F.unix_micros(c) / size).cast("long")
    left = windows.withColumn("_bucket", F.explode(F.sequence(bucket(F.col(start)), bucket(F.col(stop)))))
    right = obs.withColumn("_bucket", bucket(F.col(ts)))
    inside = F.col(ts).between(F.col(start), F.col(stop)) if closed else (F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(stop))
    return left.where(F.col(start) <= F.col(stop)).join(right, ["_bucket", *on]).where(inside).drop("_bucket")


def peaks(inside: DataFrame, key: str, value: str, ts: str) -> DataFrame:
    """Greatest value of each window and its first time; missing values don't count."""
    best = F.max(F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), (-F.unix_micros(ts)).alias("t"))))
    return inside.groupBy(key).agg(best.alias("_b")).select(key, F.col("_b.v").alias("peak"), F.timestamp_micros(-F.col("_b.t")).alias("peak_time"))


def manifest(events: DataFrame, key: str, begin: str = "begin", end: str = "end", half: int = HALF_MINUTES) -> DataFrame:
    mid = times.midpoint(F.col(begin), F.col(end))
    own = events.select(key, mid.alias("midpoint"))
    return own.withColumn("win_start", times.plus_minutes(F.col("midpoint"), -half)).withColumn("win_end", times.plus_minutes(F.col("midpoint"), half))


def stamps(windows: DataFrame, start: str, stop: str, minutes: int = 2) -> DataFrame:
    """The distinct stamps of all windows, start floored and stop ceiled."""
    grid = times.grid(times.floored(F.col(start), minutes), times.ceiled(F.col(stop), minutes), minutes)
    return windows.select(F.explode(grid).alias("ts")).distinct()


def buffered(events: DataFrame, begin: str, end: str, before: int, after: int, minutes: int = 2) -> DataFrame:
    """Windows with so many minutes before and after, on whole stamps."""
    return events.withColumn("win_start", times.floored(times.plus_minutes(F.col(begin), -before), minutes)).withColumn("win_end", times.ceiled(times.plus_minutes(F.col(end), after), minutes))


def fixed_windows(events: DataFrame, centre: Column, minutes: int, step: int) -> DataFrame:
    """Half-open windows of one length around a centre: always minutes / step stamps."""
    own = events.withColumn("win_start", times.floored(times.plus_minutes(centre, -minutes // 2), step))
    return own.withColumn("win_end", times.plus_minutes(F.col("win_start"), minutes))


def spans(events: DataFrame, gauge: str, begin: str, end: str, tag: str) -> DataFrame:
    """For each gauge: a month before its earliest begin, a month after its latest end, the earliest event's tag."""
    got = events.groupBy(gauge).agg(F.min(begin).alias("_a"), F.max(end).alias("_b"), F.min_by(F.col(tag), F.struct(begin, tag)).alias(tag))
    return got.select(gauge, F.add_months(F.col("_a"), -1).alias("first_day"), F.add_months(F.col("_b"), 1).alias("last_day"), tag)


def archive_paths(frame: DataFrame, base: str, ts: str = "ts") -> DataFrame:
    """Where each stamp's file lies, by day."""
    name = F.date_format(ts, "yyyyMMdd-HHmmss")
    return frame.withColumn("path", F.concat(F.lit(base), F.date_format(ts, "/yyyy/MM/dd/"), F.lit("rate_"), name, F.lit(".bin.gz")))


def usable(downloads: DataFrame) -> DataFrame:
    return downloads.where(F.col("status").isin("downloaded", "exists") & (F.col("size_bytes") > 0))


def best_event(downloads: DataFrame, key: str) -> DataFrame:
    """Good and missing files of each event, best first in ``place``."""
    good = F.col("status").isin("downloaded", "exists") & (F.coalesce(F.col("size_bytes"), F.lit(0)) > 0)
    return downloads.groupBy(key).agg(F.count_if(good).alias("n_good"), F.count_if(~good).alias("n_missing"))


def tags(frame: DataFrame, names: DataFrame, key: str, gauge: str) -> DataFrame:
    got = frame.join(names, key, "left")
    return got.withColumn("tag", F.concat(F.lit("gage-"), F.col(gauge))).withColumn("first", F.date_format("win_start", "yyyy-MM-dd")).withColumn("last", F.date_format("win_end", "yyyy-MM-dd"))
