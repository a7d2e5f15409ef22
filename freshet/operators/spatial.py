"""Spatial joins: coarse buckets make an equi-join, bounding boxes thin it out, an exact test on Arrow batches decides."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions import wkb
from freshet.session import ship


def with_bounds(polygons: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Adds xmin, ymin, xmax, ymax; rows whose geometry has no area are dropped."""
    ship(polygons.sparkSession)
    schema, at = polygons.schema, polygons.columns.index(geometry)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = batch.column(at).to_pylist()
            good = [g is not None and wkb.area(g) > 0 for g in shapes]
            kept = batch.filter(pa.array(good, pa.bool_()))
            found = np.array([wkb.bounds(g) for g, ok in zip(shapes, good, strict=True) if ok]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([*kept.columns, *(pa.array(found[:, k]) for k in range(4))], names=[*kept.schema.names, "xmin", "ymin", "xmax", "ymax"])

    return polygons.mapInArrow(run, f"{fields}, xmin double, ymin double, xmax double, ymax double")


def bucketed(df: DataFrame, size: float, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> DataFrame:
    """One row for each coarse cell that a box touches: _bx, _by."""
    n = lambda c: F.floor(c / size).cast("long")
    return df.withColumn("_bx", F.explode(F.sequence(n(xmin), n(xmax)))).withColumn("_by", F.explode(F.sequence(n(ymin), n(ymax))))


def _tested(pairs: DataFrame, columns: list[str], test: Callable[..., list[float]], name: str) -> DataFrame:
    """Adds a number for each row, computed from some columns on Arrow batches."""
    ship(pairs.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = test(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], names=[*batch.schema.names, name])

    return pairs.mapInArrow(run, f"{fields}, `{name}` double")


def by_geometry(test: Callable[..., np.ndarray]) -> Callable[..., list[float]]:
    """A test of one geometry and arrays of coordinates, for a batch of pairs: each geometry of the batch is parsed once."""

    def run(geometries: list, *coordinates: list) -> list[float]:
        of: dict[bytes, list[int]] = {}
        for k, g in enumerate(geometries):
            of.setdefault(g, []).append(k)
        arrays, out = [np.array(c, float) for c in coordinates], np.empty(len(geometries))
        for g, at in of.items():
            out[at] = test(g, *(a[at] for a in arrays))
        return out.tolist()

    return run


def points_within(points: DataFrame, polygons: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """Points with the polygons (geometry and bounds) that hold them."""
    left = points.withColumn("_bx", F.floor(F.col(x) / size).cast("long")).withColumn("_by", F.floor(F.col(y) / size).cast("long"))
    right = bucketed(polygons, size, F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))
    near = left.join(right, ["_bx", "_by"]).where(F.col(x).between(F.col("xmin"), F.col("xmax")) & F.col(y).between(F.col("ymin"), F.col("ymax")))

    return _tested(near, ["geometry", x, y], by_geometry(lambda g, xs, ys: wkb.contains(g, xs, ys).astype(float)), "_in").where("_in = 1").drop("_in", "_bx", "_by")


def points_near(points: DataFrame, polygons: DataFrame, radius: str, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """Points with the polygons within each point's own radius, by exact distance instead of a buffered outline."""
    r = F.col(radius)
    left = bucketed(points, size, F.col(x) - r, F.col(y) - r, F.col(x) + r, F.col(y) + r)
    right = bucketed(polygons, size, F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))
    box = (F.col(x) + r >= F.col("xmin")) & (F.col(x) - r <= F.col("xmax")) & (F.col(y) + r >= F.col("ymin")) & (F.col(y) - r <= F.col("ymax"))
    # a pair is tested in the first bucket that both touch
    first = (F.col("_bx") == F.floor(F.greatest(F.col(x) - r, F.col("xmin")) / size)) & (F.col("_by") == F.floor(F.greatest(F.col(y) - r, F.col("ymin")) / size))
    near = left.join(right, ["_bx", "_by"]).where(box & first)
    tested = _tested(near, ["geometry", x, y], by_geometry(wkb.distances), "distance")
    return tested.where(F.col("distance") <= r).drop("_bx", "_by")


def cell_overlaps(cells: DataFrame, polygons: DataFrame, size: float, least_area: float = 0.0) -> DataFrame:
    """Cells (c_xmin..) with the polygons that they overlap: overlap (area) and fraction of the cell, in [0, 1]."""
    left = bucketed(cells, size, F.col("c_xmin"), F.col("c_ymin"), F.col("c_xmax"), F.col("c_ymax"))
    right = bucketed(polygons, size, F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))
    box = (F.col("c_xmax") > F.col("xmin")) & (F.col("c_xmin") < F.col("xmax")) & (F.col("c_ymax") > F.col("ymin")) & (F.col("c_ymin") < F.col("ymax"))
    first = (F.col("_bx") == F.floor(F.greatest("c_xmin", "xmin") / size)) & (F.col("_by") == F.floor(F.greatest("c_ymin", "ymin") / size))
    near = left.join(right, ["_bx", "_by"]).where(box & first)
    near = near.sortWithinPartitions("geometry")  # a polygon's cells reach Python together
    got = _tested(near, ["geometry", "c_xmin", "c_ymin", "c_xmax", "c_ymax"], by_geometry(wkb.areas_in_boxes), "overlap")
    area = (F.col("c_xmax") - F.col("c_xmin")) * (F.col("c_ymax") - F.col("c_ymin"))
    kept = got.where((F.col("overlap") > 0) & (F.col("overlap") > least_area))
    return kept.withColumn("fraction", F.least(F.greatest(F.col("overlap") / area, F.lit(0.0)), F.lit(1.0))).drop("_bx", "_by")


def shoelace(xs: str, ys: str) -> Column:
    """Area of a ring given as two arrays of coordinates, in codegen."""
    shifted = lambda c: F.concat(F.slice(c, 2, F.size(c)), F.slice(c, 1, 1))
    cross = F.zip_with(F.zip_with(F.col(xs), shifted(F.col(ys)), lambda a, b: a * b), F.zip_with(shifted(F.col(xs)), F.col(ys), lambda a, b: a * b), lambda a, b: a - b)
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2.0


def center_crosswalk(cells: DataFrame, polygons: DataFrame, size: float, unit: str = "divide_id") -> DataFrame:
    """Each cell with at most one catchment that holds its centre: the least id."""
    return points_within(cells, polygons, size, "lon", "lat").groupBy("cell_id").agg(F.min(unit).alias(unit))


def total_bounds(polygons: DataFrame, *keys: str) -> DataFrame:
    return polygons.groupBy(*keys).agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


def in_box(polygons: DataFrame, west: float, south: float, east: float, north: float, margin: float = 0.0) -> DataFrame:
    """Rows whose bounds touch a box with a margin on each side."""
    return polygons.where((F.col("xmax") >= west - margin) & (F.col("xmin") <= east + margin) & (F.col("ymax") >= south - margin) & (F.col("ymin") <= north + margin))


def measured(polygons: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Adds area, cx and cy: area and centroid of each polygon, in the units of its coordinates."""
    schema, at = polygons.schema, polygons.columns.index(geometry)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    ship(polygons.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = batch.column(at).to_pylist()
            areas = [None if g is None else wkb.area(g) for g in shapes]
            centres = [(None, None) if not a else wkb.centroid(g) for a, g in zip(areas, shapes, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(areas, pa.float64()), *(pa.array([c[k] for c in centres], pa.float64()) for k in (0, 1))], names=[*batch.schema.names, "area", "cx", "cy"])

    return polygons.mapInArrow(run, f"{fields}, area double, cx double, cy double")


def _made(rows: DataFrame, columns: Sequence[str], shape: Callable[..., bytes]) -> DataFrame:
    """Adds a geometry made from some columns; null where one of them is."""
    ship(rows.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    places = [rows.columns.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if None in p else shape(*p) for p in zip(*(batch.column(k).to_pylist() for k in places), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, "geometry"])

    return rows.mapInArrow(run, f"{fields}, geometry binary")


def as_points(rows: DataFrame, x: str, y: str) -> DataFrame:
    return _made(rows, [x, y], wkb.point)


def as_boxes(rows: DataFrame, x: str, y: str, width: float, height: float) -> DataFrame:
    """Rows with the box whose lower left corner they name."""
    return _made(rows, [x, y], lambda a, b: wkb.polygon([(a, b), (a + width, b), (a + width, b + height), (a, b + height)]))


def coordinates(points: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Adds x and y of point geometries."""
    ship(points.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema)
    at = points.columns.index(geometry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xy = [(None, None) if g is None else wkb.place(g) for g in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([p[k] for p in xy], pa.float64()) for k in (0, 1))], names=[*batch.schema.names, "x", "y"])

    return points.mapInArrow(run, f"{fields}, x double, y double")


def with_margin(polygons: DataFrame, margin: float) -> DataFrame:
    """Bounds moved out by a margin on each side."""
    return polygons.withColumns({c: F.col(c) + (margin if c.endswith("max") else -margin) for c in ("xmin", "ymin", "xmax", "ymax")})


def cells_inside(cells: DataFrame, polygons: DataFrame, size: float, slack: float = 1e-9) -> DataFrame:
    """Cells that lie fully inside a polygon: those of which it covers all but rounding errors."""
    return cell_overlaps(cells, polygons, size).where(F.col("fraction") >= 1 - slack)


def invalid(polygons: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Rows without a usable area: missing or degenerate geometries, to be counted and rejected at ingest."""
    return measured(polygons, geometry).where("coalesce(area, 0) <= 0").drop("area", "cx", "cy")


def _mapped(rows: DataFrame, geometry: str, change: Callable[[bytes], bytes | None]) -> DataFrame:
    """The table with each geometry changed."""
    ship(rows.sparkSession)
    at = rows.columns.index(geometry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([None if g is None else change(g) for g in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([made if k == at else c for k, c in enumerate(batch.columns)], names=batch.schema.names)

    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema))


def repaired(polygons: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Geometries made usable by stated rules (``wkb.repaired``); what can't be becomes null, for ``invalid`` to report."""
    return _mapped(polygons, geometry, wkb.repaired)


def buffered(points: DataFrame, radius: str, x: str = "x", y: str = "y", corners: int = 32) -> DataFrame:
    """Points with a polygon around each (geometry), at each row's own radius; the joins use exact distances instead."""
    return _made(points, [x, y, radius], lambda a, b, c: wkb.circle(a, b, c, corners))


def dissolved(polygons: DataFrame, *keys: str, geometry: str = "geometry") -> DataFrame:
    """One multipolygon a key: edges that two polygons of a key share vanish, the others are joined to rings.

    Meant for coverages: polygons that meet in whole edges with equal corners, as grid cells and catchments do, and
    don't overlap. Edges are cancelled by an aggregation, so a key's inner edges never meet in one task; its outline does.
    """
    ship(polygons.sparkSession)
    own = polygons.where(F.col(geometry).isNotNull()).select(*keys, geometry)
    kinds = ", ".join(f"`{k}` {polygons.schema[k].dataType.simpleString()}" for k in keys)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [wkb.edges(g) for g in batch.column(len(keys)).to_pylist()]
            row = np.repeat(np.arange(len(batch)), [len(f) for f in found])
            all_ = np.concatenate(found) if found else np.empty((0, 4))
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(row)) for k in range(len(keys))), *(pa.array(all_[:, k]) for k in range(4))], names=[*keys, "x0", "y0", "x1", "y1"])

    def rings(key: tuple, frame: pa.Table) -> pa.Table:
        line = np.column_stack([frame.column(c).to_numpy() for c in ("x0", "y0", "x1", "y1")])
        return pa.table({**{n: pa.array([v.as_py()], frame.schema.field(n).type) for n, v in zip(keys, key, strict=True)}, geometry: pa.array([wkb.from_edges(line)], pa.binary())})

    way = F.when((F.col("x0") < F.col("x1")) | ((F.col("x0") == F.col("x1")) & (F.col("y0") < F.col("y1"))), 1).otherwise(-1)
    a, b = F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))
    lines = own.mapInArrow(edges, f"{kinds}, x0 double, y0 double, x1 double, y1 double").select(*keys, F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), way.alias("way"))
    # neighbours run along a shared edge in opposite directions
    left = lines.groupBy(*keys, "a", "b").agg(F.sum("way").alias("way")).where("way <> 0")
    ends = [F.when(F.col("way") > 0, F.col(p)).otherwise(F.col(q)) for p, q in (("a", "b"), ("b", "a"))]
    outline = left.select(*keys, *(e[c].alias(f"{c}{k}") for k, e in enumerate(ends) for c in ("x", "y")))
    return outline.groupBy(*keys).applyInArrow(rings, f"{kinds}, `{geometry}` binary")
