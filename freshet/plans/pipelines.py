"""The four end-to-end pipelines: gridded forcing, radar rainfall, gauge flood events, discharge cubes with topology."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions import ids, physics, times
from freshet.operators import cubes, events, graph, hydro, relational, spatial, timeseries, weights

FORCING = ("APCP_surface", "DSWRF_surface", "TMP_2maboveground", "DLWRF_surface", "PRES_surface", "SPFH_2maboveground", "UGRD_10maboveground", "VGRD_10maboveground")
SUMS = ("APCP_surface",)


# ---- gridded forcing


def catchment_forcing(obs: DataFrame, index: DataFrame, variables: Sequence[str] = FORCING, policy: str | None = None) -> DataFrame:
    """Hourly cells to hourly catchments: weighted and propagating if the index has weights, else the plain mean of present cells."""
    policy = policy or ("propagate" if "weight" in index.columns else "skip")
    return weights.catchment_means(timeseries.nan_to_null(obs, *variables), index, variables, policy)


def with_physics(forcing: DataFrame) -> DataFrame:
    """P in mm, T in degrees Celsius and PET in mm, hourly."""
    c = F.col
    celsius = c("TMP_2maboveground") - physics.KELVIN
    pet = physics.hourly_pet(celsius, c("SPFH_2maboveground"), c("DLWRF_surface"), c("DSWRF_surface"), c("PRES_surface"), c("UGRD_10maboveground"), c("VGRD_10maboveground"))
    return forcing.select("divide_id", "ts", c("APCP_surface").alias("P"), celsius.alias("T"), pet.alias("PET"))


def at_quarter_hours(forcing: DataFrame, variables: Sequence[str] = FORCING) -> DataFrame:
    return timeseries.quarter_hours(forcing, ["divide_id"], [v for v in variables if v in SUMS], [v for v in variables if v not in SUMS])


def event_forcing(forcing: DataFrame, flood_events: DataFrame, gauge: str = "STAID") -> tuple[DataFrame, DataFrame]:
    """Warm-up cube (hourly P, T, PET) and event cube (quarter-hourly T and PET) of each gauge's events, first event an hour."""
    own = events.deduplicated(events.event_windows(flood_events), gauge).select("event_id", "warm_start", "start", "stop", "n_steps")
    hourly = with_physics(forcing)
    warm = events.range_join(own.select("event_id", "warm_start", "start"), hourly, "warm_start", "start", "ts", days=32, closed=False)
    warm = cubes.hourly_steps(warm, ["event_id", "divide_id"]).select("event_id", "step", "ts", "divide_id", "P", "T", "PET")
    inside = events.range_join(own.select("event_id", "start", "stop", "n_steps"), hourly.drop("P"), "start", "stop", "ts", days=8)
    fine = timeseries.quarter_hours(inside, ["event_id", "divide_id"], ["PET"], ["T"])
    step = ((F.unix_micros("ts") - F.unix_micros("start")) / F.lit(15 * times.MINUTE)).cast("long")
    return warm, fine.withColumn("step", step).where("step < n_steps").select("event_id", "step", "ts", "divide_id", "T", "PET")


# ---- radar rainfall


def radar_depths(rates: DataFrame, index: DataFrame) -> DataFrame:
    """Two-minute cell rates to quarter-hour catchment depths in mm. Missing cells leave the mean to the others; a bin
    without any present rate stays missing."""
    clean = rates.withColumn("rate", physics.present_rate(F.col("rate")))
    stamps = weights.catchment_means(clean, index, ["rate"], "renormalize")
    return timeseries.binned(stamps, ["divide_id"], 15, physics.depth(F.avg("rate"), 15).alias("P"))


def storm_cube(depths: DataFrame, manifest: DataFrame) -> DataFrame:
    """event_id, step, ts, divide_id, P from a manifest (event_id, divide_id, win_start, win_end)."""
    windows = manifest.withColumn("a", times.floored(F.col("win_start"), 15))
    inside = events.range_join(windows, depths.withColumnRenamed("bin", "ts"), "a", "win_end", "ts", days=8, on=("divide_id",))
    step = ((F.unix_micros("ts") - F.unix_micros("a")) / F.lit(15 * times.MINUTE)).cast("long")
    return inside.withColumn("step", step).select("event_id", "step", "ts", "divide_id", "P")


def merged_forcing(radar: DataFrame, forcing: DataFrame, names: DataFrame | None = None, align: str = "time") -> DataFrame:
    """Radar P with the forcing cube's T and PET. ``names`` (storm_id, event_id, ord) translates the radar cube's ids, last row wins."""
    if names is not None:
        radar = relational.looked_up(radar.withColumnRenamed("event_id", "storm_id"), "storm_id", names.withColumnRenamed("storm_id", "_storm"), "_storm", "event_id", "ord", "event_id", "inner").drop("storm_id")
        radar = radar.where("event_id IS NOT NULL")
    return cubes.merged(radar, forcing, ["P"], ["T", "PET"], align)


def event_series(cube: DataFrame) -> DataFrame:
    """Mean and maximum depth over an event's catchments."""
    return cubes.over_units(cube, "P")


# ---- catchments and manifests


def catchment_master(network: DataFrame, divides: DataFrame) -> DataFrame:
    """divides with VPU of the first network row, nexus type and terminal flag. ``network`` has ``ord``."""
    first = relational.first_by(network.select("divide_id", "vpuid", "ord").where("divide_id IS NOT NULL"), ["divide_id"], "ord").drop("ord")
    kind = ids.extracted(F.col("toid"), r"^([a-z]+)-")
    return divides.join(first, "divide_id", "left").withColumn("nexus_type", kind).withColumn("is_terminal", F.coalesce(kind.isin("tnx", "cnx", "inx"), F.lit(False)))


def event_manifest(storms: DataFrame, gauges: DataFrame, edges: DataFrame, catchments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Windows of each storm (storm_index, begin, end, node) with its nearest gauge downstream, and the storm's catchments above that gauge."""
    nearest = graph.nearest_below(edges, storms.select("storm_index", "node"), gauges, "storm_index")
    windows = events.manifest(storms, "storm_index").join(nearest.select("storm_index", "STAID", "hops"), "storm_index")
    above = graph.upstream_catchments(edges, gauges.join(nearest.select("STAID").distinct(), "STAID", "left_semi"), catchments)
    return windows, windows.join(above, "STAID").withColumnRenamed("storm_index", "event_id")


# ---- gauge flood events


@dataclass(frozen=True)
class Floods:
    percent: float = 25.0
    minutes: int = 15
    detection: hydro.Detection = hydro.Detection()


def clean_flows(raw: DataFrame, minutes: int = 15) -> DataFrame:
    """STAID, bin, q: the first row of each time, the first value of each bin, filled forwards. ``raw`` has STAID, ts, q and ``ord``."""
    once = relational.first_by(timeseries.nan_to_null(raw, "q"), ["STAID", "ts"], "ord")
    bins = timeseries.binned(once, ["STAID"], minutes, timeseries.first_in_bin("q").alias("q"))
    return timeseries.forward_filled(timeseries.densified(bins, ["STAID"], minutes), ["STAID"], "q")


def flood_table(raw: DataFrame, gauges: DataFrame, options: Floods = Floods()) -> DataFrame:
    """Events whose peak reaches the flow that is exceeded ``percent`` of the time, with metrics and gauge position."""
    flows = clean_flows(raw, options.minutes)
    limits = hydro.exceeded(flows, ["STAID"], "q", options.percent)
    found = hydro.detected(flows, "STAID", "q", "bin", options.detection).select("STAID", "begin", "end")
    inside = events.range_join(found, flows, "begin", "end", "bin", days=4, on=("STAID",))
    got = hydro.event_metrics(inside.withColumnRenamed("end", "until"), ["STAID", "begin", "until"], "q", "bin").drop("start", "end").withColumnRenamed("until", "end")
    big = got.join(limits, "STAID").where("peak >= threshold")
    return hydro.event_table(big, "STAID").join(gauges.select("STAID", F.col("LAT_GAGE").alias("gage_lat"), F.col("LNG_GAGE").alias("gage_lon")), "STAID", "left")


def gauges_within(gauges: DataFrame, units: DataFrame, code: str, size: float = 0.5) -> DataFrame:
    """Gauges (STAID, LAT_GAGE, LNG_GAGE) inside one hydrologic unit (HUC8, geometry), ids cleaned, each once."""
    unit = spatial.with_bounds(units.where(F.col("HUC8") == code).select("HUC8", "geometry"))
    inside = spatial.points_within(gauges.withColumn("STAID", ids.site(F.col("STAID"))), unit, size, "LNG_GAGE", "LAT_GAGE")
    return inside.groupBy("STAID").agg(F.min("LAT_GAGE").alias("LAT_GAGE"), F.min("LNG_GAGE").alias("LNG_GAGE"))


# ---- discharge


def discharge(raw: DataFrame, first: str, last: str) -> DataFrame:
    """Service rows to quarter-hour maxima by site within a period, with site names."""
    a, b = F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")
    own = raw.withColumn("STAID", ids.site(F.col("STAID"))).where(F.col("datetime").between(a, b))
    bins = timeseries.binned(own, ["STAID"], 15, F.max("discharge_cfs").alias("discharge"), ts="datetime")
    names = own.select("STAID", "site_name", "latitude", "longitude").groupBy("STAID").agg(*(F.min(c).alias(c) for c in ("site_name", "latitude", "longitude")))
    return timeseries.densified(bins, ["STAID"], 15).join(names, "STAID", "left")


def flow_cube(cube_shape: DataFrame, flows: DataFrame) -> DataFrame:
    """The gauge cube on the forcing cube's times."""
    return cubes.flow_grid(cube_shape, flows.select(F.col("bin").alias("ts"), F.col("STAID").alias("gauge_id"), "discharge"), 15)
