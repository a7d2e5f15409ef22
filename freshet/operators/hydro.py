"""Flow statistics: duration curves, thresholds, volumes, flashiness, event detection and tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions import times
from freshet.functions.physics import CUBIC_FEET_AN_ACRE_FOOT
from freshet.session import ship


def duration_curve(flows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exceedance in percent, 100 * rank / (n + 1), over positive flows in descending order."""
    own = flows.where(F.col(value) > 0)
    counts = own.groupBy(*keys).agg(F.count("*").alias("n"))
    # equal flows are numbered by aggregation first: the window sorts distinct values only
    steps = own.groupBy(*keys, value).agg(F.count("*").alias("_ties"))
    above = F.coalesce(F.sum("_ties").over(Window.partitionBy(*keys).orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = steps.withColumn("_above", above).withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), "_ties")))
    return ranked.join(counts, list(keys)).select(*keys, value, ((F.col("_above") + F.col("_k")) * 100.0 / (F.col("n") + 1)).alias("exceedance"))


def exceeded(flows: DataFrame, keys: Sequence[str], value: str, percent: float) -> DataFrame:
    """The flow that is exceeded so many percent of the time: linear between ranks, clamped at both ends."""
    curve = duration_curve(flows, keys, value)
    below, above = F.col("exceedance") <= percent, F.col("exceedance") >= percent
    got = curve.groupBy(*keys).agg(
        F.max(F.when(below, F.struct(F.col("exceedance").alias("x"), (-F.col(value)).alias("v")))).alias("a"),
        F.min(F.when(above, F.struct(F.col("exceedance").alias("x"), F.col(value).alias("v")))).alias("b"),
    )
    x0, x1, y0, y1 = F.col("a.x"), F.col("b.x"), -F.col("a.v"), F.col("b.v")
    between = y0 + (y1 - y0) * F.coalesce(F.try_divide(F.lit(percent) - x0, x1 - x0), F.lit(0.0))
    return got.select(*keys, F.coalesce(between, y0, y1).alias("threshold"))


def event_metrics(inside: DataFrame, keys: Sequence[str], value: str, ts: str) -> DataFrame:
    """Of each event's rows: peak and its first time, volume in acre-feet, flashiness, duration and time to peak in hours."""
    w = Window.partitionBy(*keys).orderBy(ts)
    own = inside.where(F.col(value).isNotNull()).withColumn("_q", F.lag(value).over(w)).withColumn("_t", F.lag(ts).over(w))
    seconds = (F.unix_micros(ts) - F.unix_micros("_t")) / F.lit(1e6)
    best = F.max(F.struct(F.col(value).alias("v"), (-F.unix_micros(ts)).alias("t")))
    got = own.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min(ts).alias("start"), F.max(ts).alias("end"), best.alias("_b"),
        (F.coalesce(F.sum((F.col(value) + F.col("_q")) / 2 * seconds), F.lit(0.0)) / CUBIC_FEET_AN_ACRE_FOOT).alias("volume_acreft"),
        F.sum(F.abs(F.col(value) - F.col("_q"))).alias("_change"), F.sum(value).alias("_total"),
    )
    flash = F.when(F.col("_total") > 0, F.coalesce("_change", F.lit(0.0)) / F.col("_total"))
    peak_time = F.timestamp_micros(-F.col("_b.t"))
    return got.select(*keys, "start", "end", F.col("_b.v").alias("peak"), peak_time.alias("peak_time"), "volume_acreft", flash.alias("flashiness"), times.hours_between(F.col("start"), F.col("end")).alias("duration_hours"), times.hours_between(F.col("start"), peak_time).alias("time_to_peak_h"))


def event_table(metrics: DataFrame, site: str) -> DataFrame:
    """The event table's columns, one row an event (site, begin, end and ``event_metrics``), with calendar columns of
    the begin and an id 1.. by site and begin."""
    begin, end = F.col("begin"), F.col("end")
    own = metrics.select(
        site, begin.alias("BEGIN_DATE_TIME"), end.alias("END_DATE_TIME"), "peak_time", F.col("peak").alias("peak_flow_cfs"), "volume_acreft", F.col("flashiness").alias("flashiness_index"),
        F.year(begin).alias("YEAR"), F.month(begin).alias("month"), F.dayofmonth(begin).alias("day"), times.water_year(begin).alias("water_year"),
        times.hours_between(begin, end).alias("duration_hours"), times.hours_between(begin, F.col("peak_time")).alias("time_to_peak_h"),
    )
    # sites are numbered apart and moved on by the sites before them: only a row a site meets in one task
    before = Window.orderBy(site).rowsBetween(Window.unboundedPreceding, -1)
    sites = own.groupBy(site).agg(F.count("*").alias("_n")).select(site, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = own.withColumn("_k", F.row_number().over(Window.partitionBy(site).orderBy("BEGIN_DATE_TIME", "END_DATE_TIME")))
    return numbered.join(sites, site).withColumn("event_id", F.col("_before") + F.col("_k")).drop("_before", "_k")


@dataclass(frozen=True)
class Detection:
    """Parameters of the event detector: half life and window of hours, least hours of an event, radius of hours in which a
    start may move, and the flow above the baseline that makes an event."""

    halflife: float = 6.0
    window: int = 168
    minimum: float = 6.0
    radius: float = 6.0
    residual: float = 0.0


def smoothed(x: np.ndarray, alpha: float) -> np.ndarray:
    """Exponential smoothing forwards and backwards."""
    def one_way(v: np.ndarray) -> np.ndarray:
        out, level = np.empty_like(v), v[0]
        for i, y in enumerate(v):
            level += alpha * (y - level)
            out[i] = level
        return out

    return (one_way(x) + one_way(x[::-1])[::-1]) / 2 if len(x) else x


def rising_runs(ts: np.ndarray, q: np.ndarray, p: Detection) -> list[tuple[int, int]]:
    """Positions (first, last) of the events in a regular series without gaps."""
    if len(q) < 3 or np.isnan(q).any():
        return []
    hours = np.median(np.diff(ts).astype("timedelta64[s]").astype(float)) / 3600
    s = smoothed(q, 1 - 0.5 ** (hours / p.halflife))
    back = max(1, round(p.window / hours))
    base = pd.Series(s).rolling(back, min_periods=1, center=True).min().to_numpy()
    over = np.concatenate(([False], s - base > p.residual, [False])).astype(int)
    runs = zip(np.flatnonzero(np.diff(over) == 1), np.flatnonzero(np.diff(over) == -1) - 1, strict=True)
    out, near = [], max(0, round(p.radius / hours))
    for a, b in runs:
        if (b - a) * hours >= p.minimum:
            low = max(0, a - near)
            out.append((low + int(np.argmin(q[low : a + 1])), int(b)))
    return out


def detected(flows: DataFrame, key: str, value: str, ts: str, p: Detection = Detection()) -> DataFrame:
    """Events of each site: key, begin, end, peak. Series with gaps are filled both ways in a second try.

    The smoothing is a recurrence over a site's whole series, hence one group a site; rows are the site's regular bins: 40 years of
    quarter hours are 1.4 million rows, 34 MB. A site without events gives no rows.
    """
    given = asdict(p)

    def run(frames: pd.DataFrame) -> pd.DataFrame:
        own = frames.sort_values("ts")
        q, t = own["value"].to_numpy(float), own["ts"].to_numpy()
        found = rising_runs(t, q, Detection(**given))
        if not found and np.isnan(q).any() and not np.isnan(q).all():
            q = own.set_index("ts")["value"].interpolate("time").ffill().bfill().to_numpy(float)
            found = rising_runs(t, q, Detection(**given))
        begin, end = (np.array([t[e[k]] for e in found], "datetime64[ns]") for k in (0, 1))  # typed, also without events
        return pd.DataFrame({"key": own["key"].iloc[:1].repeat(len(found)).reset_index(drop=True), "begin": begin, "end": end, "peak": np.array([np.nanmax(q[a : b + 1]) for a, b in found], float)})

    ship(flows.sparkSession)
    kind = flows.schema[key].dataType.simpleString()
    own = flows.select(F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(value).cast("double").alias("value"))
    return own.groupBy("key").applyInPandas(run, f"key {kind}, begin timestamp, end timestamp, peak double").withColumnRenamed("key", key)


def quality(flows: DataFrame, site: str, value: str, ts: str) -> DataFrame:
    """Per site: rows, good rows, the minutes of the hour at which it reports."""
    return flows.groupBy(site).agg(F.count("*").alias("n"), F.count(value).alias("n_good"), F.array_join(F.array_sort(F.collect_set(F.minute(ts))), ",").alias("minutes"))


def batches(sites: Sequence[str], size: int) -> Iterator[Sequence[str]]:
    for k in range(0, len(sites), size):
        yield sites[k : k + size]
