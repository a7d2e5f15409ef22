"""Operators on hand-computed cases."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import math
import sqlite3
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet.functions import ids, physics, times, wkb
from freshet.operators import cubes, events, graph, grid, hydro, relational, spatial, timeseries, weights
from freshet.plans import pipelines
from freshet.sources import gpkg, grib, netcdf, shapefile, tables, zarr
from freshet.streaming.bins import streamed_bins


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def one(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


# ---- weights


def test_weight_policies(spark):
    cells = spark.createDataFrame([("c1", 2.0, 0.5), ("c1", None, 0.3), ("c1", 6.0, 0.2), ("c2", None, 1.0)], "u string, v double, w double")
    want = {"propagate": (None, None), "skip": (4.0, None), "renormalize": (2.2 / 0.7, None), "zero": (2.2, 0.0)}
    for policy, expected in want.items():
        got = dict(one(cells.groupBy("u").agg(weights.weighted("v", "w", policy).alias("x")), "u", "x"))
        assert (got["c1"], got["c2"]) == tuple(pytest.approx(x) if x is not None else None for x in expected)
    with pytest.raises(ValueError):
        weights.weighted("v", "w", "other")


def test_weights_add_up_to_one(spark):
    index = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 0.5), ("a", 3, 0.25), ("a", 4, 0.0), ("b", 1, 0.0)], "divide_id string, cell_id long, fraction double")
    got = dict(one(weights.normalised(index), "cell_id", "weight"))
    assert got == pytest.approx({1: 4 / 7, 2: 2 / 7, 3: 1 / 7})
    assert one(weights.weight_sums(weights.normalised(index)), "weight_sum") == [(pytest.approx(1.0),)]


# ---- series


HOURS = [at(f"2021-01-01 0{h}:00") for h in range(8)]


def series(spark, *values, keys="s"):
    return spark.createDataFrame([(keys, HOURS[k], v) for k, v in enumerate(values)], "k string, bin timestamp, v double")


def test_quarter_hours(spark):
    hourly = spark.createDataFrame([("a", HOURS[0], 4.0, 4.0), ("a", HOURS[1], 8.0, 8.0)], "k string, ts timestamp, p double, t double")
    got = timeseries.quarter_hours(hourly, ["k"], ["p"], ["t"]).orderBy("ts")
    assert [x[0] for x in one(got, "p")] == [1, 1, 1, 1, 2, 2, 2, 2]
    assert [x[0] for x in one(got, "t")] == [4, 5, 6, 7, 8, 8, 8, 8]
    missing = spark.createDataFrame([("a", HOURS[0], None, 4.0), ("a", HOURS[1], 8.0, None)], "k string, ts timestamp, p double, t double")
    got = timeseries.quarter_hours(missing, ["k"], ["p"], ["t"]).orderBy("ts")
    assert [x[0] for x in one(got, "p")] == [None] * 4 + [2] * 4 and all(x[0] is None for x in one(got, "t"))


def test_fills_and_gaps(spark):
    v = series(spark, 1.0, None, None, 4.0)
    assert [x[0] for x in one(timeseries.forward_filled(v, ["k"], "v").orderBy("bin"), "v")] == [1, 1, 1, 4]
    assert [x[0] for x in one(timeseries.filled_both_ways(series(spark, None, 1.0, None, None, 4.0, None), ["k"], "v").orderBy("bin"), "v")] == pytest.approx([1, 1, 2, 3, 4, 4])
    assert one(timeseries.longest_gap(series(spark, 1.0, None, None, 1.0, None, 1.0), ["k"], "v"), "longest_gap") == [(2,)]
    assert one(timeseries.longest_gap(series(spark, 1.0, 2.0), ["k"], "v"), "longest_gap") == [(0,)]
    assert [x[0] for x in one(timeseries.filled_both_ways(series(spark, None, None), ["k"], "v"), "v")] == [None, None]


def test_densified_has_no_gaps(spark):
    v = spark.createDataFrame([("a", HOURS[0], 1.0), ("a", HOURS[3], 2.0), ("b", HOURS[2], 3.0)], "k string, bin timestamp, v double")
    got = timeseries.densified(v, ["k"], 60)
    assert sorted(one(got, "k", "bin", "v"), key=repr) == sorted([("a", HOURS[0], 1.0), ("a", HOURS[1], None), ("a", HOURS[2], None), ("a", HOURS[3], 2.0), ("b", HOURS[2], 3.0)], key=repr)


def test_nan_becomes_null(spark):
    got = timeseries.nan_to_null(spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double"), "v").agg(F.avg("v"), F.count("v")).first()
    assert tuple(got) == (1.0, 1)


def test_stream_equals_batch(spark, tmp_path):
    rows = [(k % 3, at("2021-01-01 00:00") + dt.timedelta(minutes=7 * k), float(k)) for k in range(60)]
    frame = spark.createDataFrame(rows, "k long, ts timestamp, v double")
    frame.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in")
    q = streamed_bins(stream, ["k"], 15, F.avg("v").alias("m")).writeStream.outputMode("complete").format("memory").queryName("bins").start()
    q.processAllAvailable()
    q.stop()
    want = sorted(one(timeseries.binned(frame, ["k"], 15, F.avg("v").alias("m")), "k", "bin", "m"))
    assert sorted(one(spark.table("bins"), "k", "bin", "m")) == want == sorted(one(streamed_bins(frame, ["k"], 15, F.avg("v").alias("m")), "k", "bin", "m"))


# ---- times and ids


@pytest.mark.parametrize("given_,want", [("2021-10-09 13:37:30", "2021-10-09 13:45"), ("2021-10-09 13:37:29", "2021-10-09 13:30"), ("2021-10-09 23:55:00", "2021-10-10 00:00")])
def test_rounding(spark, given_, want):
    assert value(spark, times.rounded(F.lit(given_).cast("timestamp"))) == at(want)


def test_clock(spark):
    t = F.lit("2021-10-09 13:37:30").cast("timestamp")
    assert value(spark, times.ceiled(t, 2)) == at("2021-10-09 13:38") and value(spark, times.floored(t, 60)) == at("2021-10-09 13:00")
    assert [value(spark, times.water_year(F.lit(x).cast("date"))) for x in ("2021-09-30", "2021-10-01")] == [2021, 2022]
    assert [value(spark, times.duration_minutes(F.lit(x))) for x in ("5d", "120h", "7200min", "5 days", "")] == [7200, 7200, 7200, None, None]
    assert value(spark, times.from_epoch_minutes(times.epoch_minutes(t, "2000-01-01"), "2000-01-01")) == at("2021-10-09 13:37:30")
    n, a, b = times.centred_window(F.lit("2021-10-09 13:37:30").cast("timestamp"), F.lit(7200), 15)
    assert (value(spark, n), value(spark, a), value(spark, b)) == (480, at("2021-10-07 01:45"), at("2021-10-12 01:30"))
    assert value(spark, F.size(times.grid(F.lit("2021-01-01").cast("timestamp"), F.lit("2021-01-06").cast("timestamp"), 2))) == 3601


def test_ids(spark):
    got = [value(spark, ids.site(F.lit(x))) for x in ("2085000.0", " 123", "208726005", "123456789012345")]
    assert got == ["02085000", "00000123", "208726005", "123456789012345"]
    assert value(spark, ids.without_float_tail(F.lit("1.05.0"), everywhere=True)) == "15"
    assert value(spark, ids.extracted(F.lit("storm_x"), r"storm_(\d+)")) is None
    assert value(spark, ids.number_or_null(F.lit(" 1.5 "))) == 1.5 and value(spark, ids.number_or_null(F.lit("Ice"))) is None
    assert value(spark, ids.time_or_null(F.lit("09/10/2021"), "yyyy-MM-dd", "dd/MM/yyyy")) == at("2021-10-09") and value(spark, ids.time_or_null(F.lit("x"), "yyyy")) is None
    frame = spark.createDataFrame([(1, 2)], "`Site No` int, `A-b ` int")
    assert ids.clean_headers(frame).columns == ["site_no", "a_b"] and ids.resolved(frame, ["staid", "SITE NO"]) == "Site No"
    with pytest.raises(KeyError):
        ids.resolved(frame, ["z"])


# ---- physics


def test_pet(spark):
    def pet(*x):
        return value(spark, physics.hourly_pet(*(F.lit(v).cast("double") for v in x)))

    assert pet(20, 0.008, 350, 500, 100000, 3, 4) == pytest.approx(0.3516381048, abs=1e-9)
    assert pet(20, 8, 350, 500, 100000, 3, 4) == pytest.approx(0.3516381048, abs=1e-9)
    assert pet(20, 0.008, 350, 0, 100000, 3, 4) == pytest.approx(0.0594834170, abs=1e-9)
    assert pet(5, 0.006, 280, 0, 100000, 0, 0) == 0 and pet(None, 0.006, 280, 0, 100000, 0, 0) is None


@pytest.mark.parametrize("lon,lat,x,y", [(-96, 23, 0, 0), (-78.7303, 35.7714, 1539011.2043, 1553363.2877), (-95, 40, 84621.0695, 1887422.7875)])
def test_projection(spark, lon, lat, x, y):
    got = physics.albers(F.lit(float(lon)), F.lit(float(lat)))
    assert (value(spark, got[0]), value(spark, got[1])) == (pytest.approx(x, abs=1e-3), pytest.approx(y, abs=1e-3))


def test_clip_keeps_nulls(spark):
    assert value(spark, physics.at_least(F.lit(None).cast("double"), 0.0)) is None and value(spark, physics.clipped(F.lit(3.0), 0.0, 1.0)) == 1.0
    assert value(spark, physics.lon360(F.lit(-95.5))) == 264.5 and value(spark, physics.present_rate(F.lit(-3.0))) is None


# ---- flows


def flows(spark, values, minutes=15):
    return spark.createDataFrame([("g", at("2021-01-01 00:00") + dt.timedelta(minutes=minutes * k), v) for k, v in enumerate(values)], "STAID string, ts timestamp, q double")


def test_duration_curve(spark):
    f = flows(spark, [10.0, 20.0, 30.0, 40.0, 0.0, None])
    assert sorted(one(hydro.duration_curve(f, ["STAID"], "q"), "q", "exceedance")) == [(10, 80), (20, 60), (30, 40), (40, 20)]
    for percent, want in ((25, 37.5), (50, 25), (5, 40), (95, 10), (40, 30)):
        assert one(hydro.exceeded(f, ["STAID"], "q", float(percent)), "threshold") == [(pytest.approx(want),)]


def test_event_metrics(spark):
    got = hydro.event_metrics(flows(spark, [10.0, 20.0, 40.0, 30.0, 10.0]), ["STAID"], "q", "ts").first()
    assert got.volume_acreft == pytest.approx(2.066116, abs=1e-6) and got.flashiness == pytest.approx(60 / 110)
    assert (got.peak, got.time_to_peak_h, got.duration_hours) == (40, 0.5, 1.0)
    alone = hydro.event_metrics(flows(spark, [5.0]), ["STAID"], "q", "ts").first()
    assert alone.volume_acreft == 0 and alone.flashiness == 0


def test_detector():
    t = np.datetime64("2021-01-01") + np.arange(24 * 30) * np.timedelta64(1, "h")
    q = np.full(len(t), 10.0)
    q[200:224] += 90 * np.exp(-np.arange(24) / 8)
    q[500:524] += 50 * np.exp(-np.arange(24) / 8)
    found = hydro.rising_runs(t, q, hydro.Detection(residual=2.0))
    assert len(found) == 2 and all(a <= p <= b for (a, b), p in zip(found, (200, 500), strict=True))
    assert hydro.rising_runs(t, np.full(len(t), 3.0), hydro.Detection()) == []


def test_detection_fills_gaps(spark):
    q = [10.0] * 100 + [10 + 90 * math.exp(-k / 8) for k in range(30)] + [10.0] * 100
    q[50] = None
    got = hydro.detected(flows(spark, q, 60), "STAID", "q", "ts", hydro.Detection(residual=3.0)).collect()
    assert len(got) == 1 and got[0].peak == pytest.approx(100)


# ---- relational


def test_first_and_last_win(spark):
    rows = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 3, None)], "key string, ord long, v string")
    assert sorted(one(relational.first_by(rows, ["key"], "ord"), "key", "v"), key=repr) == [("j", None), ("k", "a")]
    assert sorted(one(relational.last_by(rows, ["key"], "ord"), "key", "v"), key=repr) == [("j", None), ("k", "b")]


def test_ends_are_dropped(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2)], "k string, t long")
    assert sorted(one(relational.without_ends(rows, ["k"], "t"), "k", "t")) == [("a", 2), ("b", 1), ("b", 2)]


# ---- graphs


def edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "up string, down string")


def test_closure_and_hops(spark):
    e = edges(spark, ("a", "b"), ("b", "c"), ("d", "c"), ("c", "e"))
    seeds = spark.createDataFrame([("c",)], "node string")
    assert sorted(one(graph.reached(e, seeds), "node", "hops")) == [("a", 2), ("b", 1), ("c", 0), ("d", 1)]
    down = graph.reached(e, spark.createDataFrame([("a",)], "node string"), upstream=False)
    assert dict(one(down, "node", "hops"))["e"] == 3
    assert sorted(one(graph.terminals(e), "node", "terminal", "cyclic")) == [(n, "e", False) for n in "abcde"]


def test_cycles_end(spark):
    e = edges(spark, ("x", "y"), ("y", "z"), ("z", "x"), ("w", "x"), ("p", "p"))
    assert sorted(one(graph.terminals(e), "node", "terminal", "cyclic")) == [("p", "p", True), *((n, "x", True) for n in "wxyz")]
    assert {r.node for r in graph.reached(e, spark.createDataFrame([("x",)], "node string")).collect()} == set("wxyz")


def test_deep_chain(spark):
    n = 300
    e = spark.range(1, n).selectExpr("id AS up", "id - 1 AS down")
    assert {r.terminal for r in graph.terminals(e).collect()} == {0}


def test_topology_and_gauges(spark):
    nodes = spark.createDataFrame([("wb-1",), ("wb-2",)], "node string")
    doc = graph.topology(nodes, graph.induced(edges(spark, ("wb-1", "wb-2"), ("wb-2", "wb-3")), nodes), spark.createDataFrame([("01", 2)], "STAID string, divide_id long")).first()[0]
    assert json.loads(doc) == {"nodes": [1, 2], "edges": [[1, 2]], "gage_hf": {"01": 2}}
    divides = spark.createDataFrame([("cat-1", 5.0), ("cat-2", 9.0)], "divide_id string, tot_drainage_areasqkm double")
    locations = spark.createDataFrame([("wb-1", "nex-9", "G1", "gages"), ("wb-2", "cat-1", "G1", "usgs-gage"), ("wb-2", "x", "G2", "other")], "id string, nex_id string, hl_link string, hl_reference string")
    got = one(graph.gauges_in_region(divides, locations, nodes), "STAID", "divide_id", "DRAIN_SQKM")
    assert got == [("G1", 2, 9.0)]


# ---- grids and shapes


def test_grid(spark):
    assert value(spark, grid.RADAR.cell(F.lit(3), F.lit(4))) == 21004
    assert value(spark, grid.RADAR.lon(F.lit(4))) == pytest.approx(-129.955) and value(spark, grid.RADAR.lat(F.lit(3))) == pytest.approx(54.965)
    g = grid.Grid(3, 4, 0.0, 3.0, 1.0)
    assert sorted(one(g.neighbours(spark.createDataFrame([(0, 0)], "row long, col long"), 1), "row", "col")) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    r, c = g.nearest(F.lit(3.5), F.lit(0.5))
    assert (value(spark, r), value(spark, c)) == (2, 3) and value(spark, g.nearest(F.lit(4.5), F.lit(0.5))[0]) is None
    assert g.table(spark).count() == 12


SQUARE = wkb.polygon([(0, 0), (2, 0), (2, 1), (0, 1)])


def test_shapes():
    holed = wkb.polygon([(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (3, 1), (3, 3), (1, 3)])
    assert wkb.area(SQUARE) == 2 and wkb.area(holed) == 12 and wkb.bounds(SQUARE) == (0, 0, 2, 1)
    assert wkb.centroid(SQUARE) == pytest.approx((1, 0.5)) and wkb.centroid(holed) == pytest.approx((2, 2))
    assert wkb.contains(holed, np.array([0.5, 2.0, 5.0]), np.array([0.5, 2.0, 2.0])).tolist() == [True, False, False]
    assert wkb.area_in_box(holed, (0, 0, 2, 2)) == pytest.approx(3) and wkb.distance(SQUARE, 3, 1) == 1 and wkb.distance(SQUARE, 1, 0.5) == 0
    multi = struct.pack("<BII", 1, 6, 2) + SQUARE + wkb.polygon([(5, 5), (6, 5), (6, 6)])
    assert wkb.area(multi) == 2.5
    with pytest.raises(ValueError):
        wkb.parts(wkb.point(1, 2))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(-3, 3), st.floats(-3, 3)), min_size=3, max_size=7))
def test_boxes_share_out_an_area(points):
    """The parts of a star-shaped ring in the four quadrants add up to it."""
    xy = np.array(points)
    centre = xy.mean(axis=0)
    ring = xy[np.argsort(np.arctan2(*(xy - centre).T[::-1]), kind="stable")]
    boxes = [(-9, -9, 0, 0), (0, -9, 9, 0), (-9, 0, 0, 9), (0, 0, 9, 9)]
    assert sum(wkb.clipped_area(ring, b) for b in boxes) == pytest.approx(abs(wkb.ring_area(ring)), abs=1e-9)


def test_areas_in_many_boxes():
    """All boxes at once as one by one: outside, inside, touching, with a hole, in a ring that crosses itself."""
    hole = [(1, 1), (2, 1), (2, 2.5), (1, 2)]
    shapes = [wkb.polygon([(0, 0), (4, 0.3), (3, 4), (0.5, 3)], hole), wkb.polygon([(0, 0), (3, 3), (3, 0), (0, 3)]), wkb.polygon([(0, 0), (3, 0), (0, 3)])]
    low = np.array([(x / 4, y / 4) for x in range(-6, 18) for y in range(-6, 18)])
    for shape in [*shapes, wkb.multipolygon([p for s in shapes for p in wkb.parts(s)])]:
        for size in (0.25, 1, 20):
            boxes = np.hstack([low, low + size])
            want = np.array([wkb.area_in_box(shape, b) for b in boxes])
            got = wkb.areas_in_boxes(shape, *boxes.T)
            assert np.allclose(got, want, rtol=0, atol=1e-12) and ((got > 0) == (want > 0)).all()
    assert wkb.areas_in_boxes(shapes[0], *np.empty((4, 0))).shape == (0,)


def test_overlaps(spark):
    cells = spark.createDataFrame([(k, float(k % 3), float(k // 3), float(k % 3 + 1), float(k // 3 + 1)) for k in range(9)], "cell_id long, c_xmin double, c_ymin double, c_xmax double, c_ymax double")
    shape = wkb.polygon([(0, 0), (1.5, 0), (1.5, 1.5), (0, 1.5)])
    polygons = spatial.with_bounds(spark.createDataFrame([("a", shape), ("none", None)], "divide_id string, geometry binary"))
    got = dict(one(spatial.cell_overlaps(cells, polygons, 0.7), "cell_id", "fraction"))
    assert got == pytest.approx({0: 1, 1: 0.5, 3: 0.5, 4: 0.25})
    points = spark.createDataFrame([(1, 1.0, 1.0, 0.1), (2, 2.0, 0.5, 0.4), (3, 2.0, 0.5, 0.6)], "p long, x double, y double, r double")
    assert one(spatial.points_within(points, polygons, 0.7), "p") == [(1,)]
    assert sorted(one(spatial.points_near(points, polygons, "r", 0.7), "p", "distance")) == [(1, 0.0), (3, 0.5)]


def test_measures_and_boxes(spark):
    shapes = spark.createDataFrame([("a", SQUARE), ("flat", wkb.polygon([(0, 0), (1, 1), (2, 2)])), ("none", None)], "id string, geometry binary")
    got = {r.id: (r.area, r.cx, r.cy) for r in spatial.measured(shapes).collect()}
    assert got["a"] == pytest.approx((2, 1, 0.5)) and got["none"] == (None, None, None)
    assert sorted(one(spatial.invalid(shapes), "id")) == [("flat",), ("none",)]
    own = spatial.with_bounds(shapes)
    assert spatial.in_box(own, 2.5, 0, 3, 1).count() == 0 and spatial.in_box(own, 2.5, 0, 3, 1, margin=0.6).count() == 1
    gauges = spark.createDataFrame([("123.0", 0.5, 1.0), ("123", 0.5, 1.0), ("9", 5.0, 5.0)], "STAID string, LAT_GAGE double, LNG_GAGE double")
    units = spark.createDataFrame([("0302", SQUARE), ("0303", None)], "HUC8 string, geometry binary")
    assert one(pipelines.gauges_within(gauges, units, "0302"), "STAID") == [("00000123",)]


# ---- events and cubes


def test_windows(spark):
    e = spark.createDataFrame([(1, at("2021-10-09 13:37:30"), at("2021-10-09 13:37:30"))], "event_id long, begin timestamp, end timestamp")
    got = events.event_windows(e).first()
    assert (got.warm_start, got.start, got.stop, got.n_steps) == (at("2021-09-07 01:00"), at("2021-10-07 01:00"), at("2021-10-12 02:00"), 480)
    assert events.fixed_windows(e, F.col("begin"), 14_400, 2).select((F.unix_micros("win_end") - F.unix_micros("win_start")) / 120e6).first()[0] == 7200


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9000), st.integers(0, 4000)), min_size=1, max_size=8), st.lists(st.integers(-100, 14000), min_size=1, max_size=20))
def test_range_join(spark, windows, points):
    t0 = at("2021-01-01 00:00")
    w = spark.createDataFrame([(k, t0 + dt.timedelta(minutes=a), t0 + dt.timedelta(minutes=a + n)) for k, (a, n) in enumerate(windows)], "w long, a timestamp, z timestamp")
    p = spark.createDataFrame([(k, t0 + dt.timedelta(minutes=m)) for k, m in enumerate(points)], "p long, ts timestamp")
    for closed in (True, False):
        want = sorted((k, j) for k, (a, n) in enumerate(windows) for j, m in enumerate(points) if a <= m and (m <= a + n if closed else m < a + n))
        assert sorted(one(events.range_join(w, p, "a", "z", "ts", days=2, closed=closed), "w", "p")) == want


def test_merge(spark):
    cube = lambda events_, n, name: spark.createDataFrame([(e, s, HOURS[s], "c", 1.0) for e in events_ for s in range(n)], f"event_id long, step long, ts timestamp, divide_id string, {name} double")
    got = cubes.merged(cube((1, 2, 3), 4, "P"), cube((2, 3, 4), 5, "T"), ["P"], ["T"], "step")
    assert sorted({(r.event_id, r.step) for r in got.collect()}) == [(e, s) for e in (2, 3) for s in range(4)]
    array, names, _ = cubes.dense(cube((1, 2), 3, "P").where("NOT (event_id = 2 AND step = 2)"), "P")
    assert array.shape == (2, 3, 1) and names == [1, 2] and np.isnan(array[1, 2, 0])
    assert one(cubes.shape(cube((1,), 4, "P")), "n_steps") == [(4,)]


# ---- sources and sinks


def test_csv_and_files(spark, tmp_path):
    (tmp_path / "s.csv").write_text("# about\nSite No,Name\n0123,a\n")
    assert one(tables.stations(spark, f"{tmp_path}/s.csv"), "site_no", "name") == [("0123", "a")]
    for k in (7, 8):
        spark.range(2).write.parquet(f"{tmp_path}/storm_{k}_x")
    got = tables.with_file_id(spark.read.parquet(f"{tmp_path}/storm_7_x", f"{tmp_path}/storm_8_x"), r"storm_(\d+)_", wanted=[8])
    assert sorted(one(got, "id", "storm_id")) == [(0, 8), (1, 8)]
    with pytest.raises(ValueError):
        tables.by_suffix(spark, "x.grb")


def test_days_prune(spark, tmp_path):
    tables.write_partitioned(spark.range(6).selectExpr("id", "cast(20210101 + id as int) AS day"), f"{tmp_path}/d", "day")
    got = tables.days(spark, f"{tmp_path}/d", "20210102", "20210103")
    assert sorted(x[0] for x in one(got, "id")) == [1, 2] and "PartitionFilters: [isnotnull(day" in got._jdf.queryExecution().toString()


def test_resumed_write(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert {r.status for r in tables.write_resumed(rows.where("k = 1"), f"{tmp_path}/r", ["k"]).collect()} == {"written"}
    assert sorted(one(tables.write_resumed(rows, f"{tmp_path}/r", ["k"]), "k", "status")) == [(1, "skipped"), (2, "written")]
    assert spark.read.parquet(f"{tmp_path}/r").count() == 2


def test_service_rows(spark):
    doc = {"value": {"timeSeries": [{"sourceInfo": {"siteName": "n", "siteCode": [{"value": "01"}], "geoLocation": {"geogLocation": {"latitude": 1.0, "longitude": 2.0}}}, "variable": {"unit": {"unitCode": "ft3/s"}}, "values": [{"value": [{"value": "3.5", "dateTime": "2021-01-01T00:00:00Z", "qualifiers": ["A", "e"]}, {"value": "", "dateTime": "x"}]}]}]}}
    got = one(tables.service_rows(spark.createDataFrame([(json.dumps(doc),), ("{}",)], "body string")), "STAID", "datetime", "discharge_cfs", "qualifiers", "units")
    assert got == [("01", at("2021-01-01 00:00"), 3.5, "A,e", "ft3/s"), ("01", None, None, "", "ft3/s")]


def test_binary_grids(spark, tmp_path):
    body = struct.pack("<ii", 2, 3) + np.array([[1, -3, 2], [0, 5, -1]], "<f4").tobytes()
    (tmp_path / "rate_1.bin.gz").write_bytes(gzip.compress(body))
    assert sorted(one(tables.grids(spark, f"{tmp_path}/*.gz"), "cell_id", "rate")) == [(0, 1.0), (2, 2.0), (3, 0.0), (4, 5.0)]


def test_geopackage(spark, tmp_path):
    path = f"{tmp_path}/h.gpkg"
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE divides (fid INTEGER PRIMARY KEY, divide_id TEXT, area REAL, geom POLYGON)")
        blob = b"GP\x00\x03" + struct.pack("<i", 5070) + struct.pack("<4d", 0, 2, 0, 1) + SQUARE
        db.executemany("INSERT INTO divides VALUES (?, ?, ?, ?)", [(k, f"cat-{k}", k * 1.5, blob if k % 2 else None) for k in range(1, 12)])
    gpkg.register(spark)
    read = spark.read.format("gpkg").option("layer", "divides")
    got = read.load(path)
    assert got.columns == ["fid", "divide_id", "area", "geom"] and got.count() == 11 and bytes(got.where("fid = 1").first().geom) == SQUARE
    thin = read.option("columns", "divide_id,geom").option("geometry", "false").load(path).where(F.col("divide_id").isin("cat-2", "cat-3"))
    assert thin.columns == ["divide_id"] and sorted(one(thin, "divide_id")) == [("cat-2",), ("cat-3",)]
    assert gpkg.layers(path) == [("divides", [("fid", "INTEGER"), ("divide_id", "TEXT"), ("area", "REAL"), ("geom", "POLYGON")])]


# ---- pipelines


def test_forcing_pipeline(spark):
    t0 = at("2021-10-01 00:00")
    obs = spark.createDataFrame([(t0 + dt.timedelta(hours=h), c, 4.0, 100.0, 290.0 + h % 24, 350.0, 1e5, 0.008, 1.0, 1.0) for h in range(24 * 14) for c in (1, 2)], "ts timestamp, cell_id long, " + ", ".join(f"{v} double" for v in pipelines.FORCING))
    index = spark.createDataFrame([("cat-1", 1, 0.25), ("cat-1", 2, 0.75)], "divide_id string, cell_id long, weight double")
    forcing = pipelines.catchment_forcing(obs, index)
    assert forcing.count() == 24 * 14 and one(forcing.limit(1), "APCP_surface") == [(4.0,)]
    flood = spark.createDataFrame([(7, "01", at("2021-10-09 13:00"), at("2021-10-09 15:00")), (8, "01", at("2021-10-09 13:00"), at("2021-10-09 15:10"))], "event_id long, STAID string, begin timestamp, end timestamp")
    warm, fine = pipelines.event_forcing(forcing, flood)
    assert fine.count() == 480 and {r.event_id for r in fine.collect()} == {7}
    assert warm.agg(F.max("step"), F.count("*")).first()[:] == (145, 146)  # the forcing begins six days before the event
    radar = spark.createDataFrame([(t0 + dt.timedelta(days=8, minutes=2 * k), c, 6.0 if c == 1 else -1.0) for k in range(60) for c in (1, 2)], "ts timestamp, cell_id long, rate double")
    depths = pipelines.radar_depths(radar, index)
    assert {r.P for r in depths.collect()} == {1.5}
    manifest = spark.createDataFrame([(77, "cat-1", at("2021-10-07 01:00"), at("2021-10-12 01:00"))], "event_id long, divide_id string, win_start timestamp, win_end timestamp")
    storm = pipelines.storm_cube(depths, manifest)
    names = spark.createDataFrame([(77, 6, 1), (77, 7, 2)], "storm_id long, event_id long, ord long")
    merged = pipelines.merged_forcing(storm, fine, names)
    assert merged.count() == 8 and {r.event_id for r in merged.collect()} == {7}


def test_flood_pipeline(spark):
    q = [10.0] * 400 + [10 + 90 * math.exp(-k / 40) for k in range(150)] + [10.0] * 400
    raw = flows(spark, q).withColumn("ord", F.monotonically_increasing_id())
    gauges = spark.createDataFrame([("g", 35.0, -78.0)], "STAID string, LAT_GAGE double, LNG_GAGE double")
    got = pipelines.flood_table(raw, gauges, pipelines.Floods(detection=hydro.Detection(residual=3.0))).collect()
    assert len(got) == 1 and got[0].peak_flow_cfs == 100 and got[0].gage_lat == 35 and got[0].event_id == 1


def test_manifest_and_master(spark):
    e = edges(spark, ("wb-1", "nex-1"), ("nex-1", "wb-2"), ("wb-2", "nex-2"), ("nex-2", "wb-3"))
    storms = spark.createDataFrame([(5, at("2021-01-01"), at("2021-01-02"), "wb-1"), (6, at("2021-01-01"), at("2021-01-02"), "zz")], "storm_index long, begin timestamp, end timestamp, node string")
    gauges = spark.createDataFrame([("G2", "wb-2"), ("G3", "wb-3")], "STAID string, node string")
    names = spark.createDataFrame([(f"wb-{k}", f"cat-{k}") for k in (1, 2, 3)], "node string, divide_id string")
    windows, per = pipelines.event_manifest(storms, gauges, e, names)
    assert one(windows, "storm_index", "STAID", "hops") == [(5, "G2", 2)] and sorted(one(per, "divide_id")) == [("cat-1",), ("cat-2",)]
    network = spark.createDataFrame([("cat-1", "v1", 1), ("cat-1", "v2", 2)], "divide_id string, vpuid string, ord long")
    divides = spark.createDataFrame([("cat-1", "tnx-4"), ("cat-2", "nex-5")], "divide_id string, toid string")
    assert sorted(one(pipelines.catchment_master(network, divides), "divide_id", "vpuid", "nexus_type", "is_terminal")) == [("cat-1", "v1", "tnx", True), ("cat-2", None, "nex", False)]


# ---- formats of single files


def test_detection_without_events(spark):
    """A site without events, beside one with some, gives no rows and typed columns."""
    q = [10.0] * 100 + [10 + 90 * math.exp(-k / 8) for k in range(30)] + [10.0] * 100
    flat = flows(spark, [5.0] * 230, 60).withColumn("STAID", F.lit("flat"))
    none = flows(spark, [None] * 230, 60).withColumn("STAID", F.lit("none"))
    got = hydro.detected(flows(spark, q, 60).unionByName(flat).unionByName(none), "STAID", "q", "ts", hydro.Detection(residual=3.0))
    assert {r.STAID for r in got.collect()} == {"g"} and dict(got.dtypes)["begin"] == "timestamp"
    assert hydro.detected(flat, "STAID", "q", "ts", hydro.Detection(residual=3.0)).count() == 0


def test_calendar_of_an_event_over_midnight(spark):
    rows = [("a", at("2021-09-30 23:00"), at("2021-10-01 05:00"), at("2021-10-01 01:00"), 9.0, 1.0, 0.5), ("b", at("2021-01-01"), at("2021-01-02"), at("2021-01-01"), 1.0, 1.0, 0.0), ("a", at("2020-05-01"), at("2020-05-02"), at("2020-05-01"), 2.0, 1.0, 0.0)]
    got = hydro.event_table(spark.createDataFrame(rows, "STAID string, begin timestamp, end timestamp, peak_time timestamp, peak double, volume_acreft double, flashiness double"), "STAID")
    assert sorted(one(got, "event_id", "STAID", "YEAR", "month", "day", "water_year", "duration_hours", "time_to_peak_h")) == [(1, "a", 2020, 5, 1, 2020, 24.0, 0.0), (2, "a", 2021, 9, 30, 2021, 6.0, 2.0), (3, "b", 2021, 1, 1, 2021, 24.0, 0.0)]


def test_netcdf_records_and_packing(tmp_path):
    """A file with a record dimension, packed values and text, laid out by hand."""
    name = lambda s: struct.pack(">i", len(s)) + s.encode() + b"\0" * (-len(s) % 4)
    attr = name("scale_factor") + struct.pack(">iif", 5, 1, 0.5) + name("_FillValue") + struct.pack(">iih2x", 3, 1, -1)
    dims = struct.pack(">ii", 10, 2) + name("time") + struct.pack(">i", 0) + name("x") + struct.pack(">i", 3)
    head = lambda a, b: b"CDF\x01" + struct.pack(">i", 2) + dims + struct.pack(">ii", 0, 0) + struct.pack(">ii", 11, 2) + name("v") + struct.pack(">iii", 2, 0, 1) + struct.pack(">ii", 12, 2) + attr + struct.pack(">iii", 3, 8, a) + name("t") + struct.pack(">ii", 1, 0) + struct.pack(">ii", 0, 0) + struct.pack(">iii", 6, 8, b)
    start = len(head(0, 0))
    body = b"".join(struct.pack(">3h2x", *v) + struct.pack(">d", t) for v, t in (((2, -1, 4), 10.0), ((6, 8, -1), 20.0)))
    (tmp_path / "r.nc").write_bytes(head(start, start + 8) + body)
    file = netcdf.File(f"{tmp_path}/r.nc")
    assert file.variables["v"].shape == [2, 3] and file.values("t").tolist() == [10.0, 20.0]
    assert np.array_equal(file.values("v"), [[1, np.nan, 2], [3, 4, np.nan]], equal_nan=True)
    assert np.array_equal(file.values("v", 1, 2), [[3, 4, np.nan]], equal_nan=True)
    with pytest.raises(ValueError):
        (tmp_path / "h.nc").write_bytes(b"\x89HDF0000")
        netcdf.File(f"{tmp_path}/h.nc")


def test_zarr_edges(spark, tmp_path):
    values = np.arange(35, dtype="f4").reshape(5, 7)
    zarr.write_array(f"{tmp_path}/s.zarr", "v", values, ["a", "b"], [2, 3])
    (tmp_path / "s.zarr/v/0.0").unlink()  # a chunk that isn't stored
    zarr.register(spark)
    got = {(r.a, r.b): r.v for r in spark.read.format("zarr").option("variables", "v").load(f"{tmp_path}/s.zarr").collect()}
    assert len(got) == 35 and got[4, 6] == 34 and got[0, 3] == 3 and all(got[a, b] is None for a in (0, 1) for b in (0, 1, 2))
    meta = json.loads((tmp_path / "s.zarr/v/.zarray").read_text()) | {"compressor": {"id": "blosc"}}
    (tmp_path / "s.zarr/v/.zarray").write_text(json.dumps(meta))
    with pytest.raises(ValueError):
        zarr.Array(f"{tmp_path}/s.zarr", "v").chunk([1, 1])


def test_shapefile_with_holes_and_points(spark, tmp_path):
    ring = wkb.polygon([(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (1, 2), (2, 2), (2, 1)])
    two = wkb.multipolygon([[np.array([(0, 0), (1, 0), (1, 1), (0, 1)], float)], [np.array([(5, 5), (7, 5), (7, 7), (5, 7)], float)]])
    shapefile.write(f"{tmp_path}/p.shp", [("name", "C", 8, 0), ("n", "N", 6, 0)], [("hole", 1, ring), ("two", None, two)])
    shapefile.register(spark)
    got = spatial.measured(spark.read.format("shp").load(f"{tmp_path}/p.shp"))
    assert sorted(one(got, "name", "n", "area")) == [("hole", 1, 15.0), ("two", None, 5.0)]
    shapefile.write(f"{tmp_path}/q.shp", [("size", "N", 8, 2)], [(1.5, (3.0, 4.0))], 1)
    assert one(spatial.coordinates(spark.read.format("shp").load(f"{tmp_path}/q.shp")), "size", "x", "y") == [(1.5, 3.0, 4.0)]


@pytest.mark.parametrize("as_png", [False, True])
def test_radar_messages(as_png):
    field = np.round(np.random.default_rng(1).uniform(-3, 90, (6, 9)), 1)
    assert np.allclose(grib.decode(grib.encode(field, 1, as_png)), field, atol=0.05)
    with pytest.raises(ValueError):
        grib.decode(b"GRIB\0\0\0\x01" + bytes(20))


def test_image_filters():
    """Each filter of the image format against its definition, byte by byte."""
    rng, (w, h) = np.random.default_rng(2), (5, 5)
    want = rng.integers(0, 256, (h, 2 * w))
    lines = []
    for k, row in enumerate(want):
        above = want[k - 1] if k else np.zeros(2 * w, int)
        out = []
        for i, x in enumerate(row.tolist()):
            a, b, c = (int(row[i - 2]) if i > 1 else 0), int(above[i]), (int(above[i - 2]) if i > 1 else 0)
            paeth = min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
            out.append((x - [0, a, b, (a + b) // 2, paeth][k]) % 256)
        lines.append(bytes([k, *out]))
    chunk = lambda kind, d: struct.pack(">I", len(d)) + kind + d + b"\0\0\0\0"
    image = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 16, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines)))
    assert grib.png(image)[0].tolist() == want.tolist()


def test_dissolve_keeps_holes_and_touching_rings(spark):
    cells = [(0, x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)] + [(1, 0, 0), (1, 1, 1)]
    boxes = spatial.as_boxes(spark.createDataFrame([(k, float(x), float(y)) for k, x, y in cells], "k long, x double, y double"), "x", "y", 1.0, 1.0)
    got = {r.k: wkb.parts(bytes(r.geometry)) for r in spatial.dissolved(boxes.select("k", "geometry"), "k").collect()}
    assert [len(rings) for rings in got[0]] == [2] and wkb.area(wkb.multipolygon(got[0])) == 8
    assert [len(rings) for rings in got[1]] == [1, 1] and wkb.area(wkb.multipolygon(got[1])) == 2


def test_layers_written_and_replaced(spark, tmp_path):
    path, rows = f"{tmp_path}/n.gpkg", spark.createDataFrame([(1, "a", bytearray(SQUARE)), (2, None, None)], "id long, name string, geom binary")
    for _ in range(2):
        gpkg.write_layer(rows, path, "units", "geom")
    gpkg.register(spark)
    got = spark.read.format("gpkg").option("layer", "units").load(path)
    assert sorted(one(got, "id", "name")) == [(1, "a"), (2, None)] and bytes(got.where("id = 1").first().geom) == SQUARE
    assert one(gpkg.queried(spark, path, "SELECT count(*), max(id) FROM units", "n long, most long"), "n", "most") == [(2, 2)]
