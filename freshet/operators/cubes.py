"""Event cubes in long form: (event_id, step, ts, divide_id, values). Padding is absent rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions import times


def numbered_steps(rows: DataFrame, event: str = "event_id", ts: str = "ts", minutes: int = 15) -> DataFrame:
    """Steps from 0 by the time since the event's first row."""
    first = rows.groupBy(event).agg(F.min(ts).alias("_first"))
    return rows.join(first, event).withColumn("step", ((F.unix_micros(ts) - F.unix_micros("_first")) / F.lit(minutes * times.MINUTE)).cast("long")).drop("_first")


def shape(rows: DataFrame, event: str = "event_id", ts: str = "ts") -> DataFrame:
    """Per event: first and last time and number of steps."""
    return rows.groupBy(event).agg(F.min(ts).alias("ts_start"), F.max(ts).alias("ts_end"), (F.max("step") + 1).alias("n_steps"))


def merged(a: DataFrame, b: DataFrame, a_values: Sequence[str], b_values: Sequence[str], align: str = "time", event: str = "event_id", unit: str = "divide_id") -> DataFrame:
    """Rows that both cubes have. ``time`` pairs equal times, ``step`` equal step numbers up to the shorter cube's end."""
    on = [event, unit, "ts" if align == "time" else "step"]
    right = b.select(*on, *b_values)
    if align == "time":
        return a.join(right, on).select(event, "step", "ts", unit, *a_values, *b_values)
    ends = [x.groupBy(event).agg(F.max("step").alias(f"_{k}")) for k, x in enumerate((a, b))]
    both = ends[0].join(ends[1], event).select(event, F.least("_0", "_1").alias("_end"))
    return a.join(right, on).join(both, event).where("step <= _end").select(event, "step", "ts", unit, *a_values, *b_values)


def flow_grid(windows: DataFrame, flows: DataFrame, minutes: int = 60, event: str = "event_id", gauge: str = "gauge_id", gauges: DataFrame | None = None) -> DataFrame:
    """Discharge on each event's regular times: equal stamps of a gauge are averaged, absent ones stay missing.

    ``gauges`` (event, gauge) restricts each event to its own gauges; without it the cube is dense, every event with every gauge.
    """
    own = flows.groupBy("ts", gauge).agg(F.avg("discharge").alias("streamflow"))
    grid = windows.select(event, F.posexplode(times.grid(F.col("ts_start"), F.col("ts_end"), minutes)).alias("step", "ts"))
    if gauges is None:  # a dense cube: the size of the result
        return grid.join(flows.select(gauge).distinct(), how="cross").join(own, ["ts", gauge], "left").select(event, F.col("step").cast("long").alias("step"), "ts", gauge, "streamflow")
    return grid.join(gauges.select(event, gauge).distinct(), event).join(own, ["ts", gauge], "left").select(event, F.col("step").cast("long").alias("step"), "ts", gauge, "streamflow")


def dense(rows: DataFrame, value: str, event: str = "event_id", unit: str = "divide_id") -> tuple[np.ndarray, list, list]:
    """One exported cube as an array (event, step, unit) padded with NaN. For event sets that fit the driver."""
    got = rows.select(event, "step", unit, value).toPandas()
    events, units = sorted(got[event].unique()), sorted(got[unit].unique())
    out = np.full((len(events), int(got["step"].max()) + 1 if len(got) else 0, len(units)), np.nan, np.float32)
    at = ({k: i for i, k in enumerate(events)}, {k: i for i, k in enumerate(units)})
    out[got[event].map(at[0]), got["step"], got[unit].map(at[1])] = got[value]
    return out, events, units


def nested(rows: DataFrame, values: Sequence[str], event: str = "event_id", unit: str = "divide_id") -> DataFrame:
    """A cube's long rows as one row for each event and unit, with an array a variable in the order of steps: the transposed form.
    Absent steps are null; arrays are as long as the event."""
    ends = rows.groupBy(event).agg(F.max("step").alias("_last"))
    held = rows.groupBy(event, unit).agg(*(F.map_from_entries(F.collect_list(F.struct("step", v))).alias(v) for v in values))

    def ordered(v: str):
        return F.transform(F.sequence(F.lit(0).cast("long"), F.col("_last")), lambda k: F.try_element_at(F.col(v), k)).alias(v)

    return held.join(ends, event).select(event, unit, *map(ordered, values))


def over_units(rows: DataFrame, value: str, event: str = "event_id") -> DataFrame:
    """Mean and maximum over the catchments at each time."""
    return rows.groupBy(event, "ts").agg(F.avg(value).alias("mean"), F.max(value).alias("max"))


def hourly_steps(rows: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    return rows.withColumn("step", F.row_number().over(Window.partitionBy(*keys).orderBy(ts)).cast("long") - 1)
