"""Sources and sinks as queries: each writes a driver table in a format to the shared folder and reads it back through the
library's reader, beside the SQL over the table itself. Also the remaining geometry, catalog and detection operators."""

from __future__ import annotations

import gzip
import os

import numpy as np
from pyspark.sql import functions as F

from freshet.functions import ids, physics, times, wkb
from freshet.operators import cubes, grid, hydro, relational, spatial, timeseries
from freshet.plans import pipelines
from freshet.plans.queries import _BOX, _COARSE, EV, XW, _boxes, _cells, _triangles, crosswalk, floods, observations, query, r, stamp, table
from freshet.session import shared_folder
from freshet.sources import gpkg, grib, netcdf, shapefile, tables, zarr
from freshet.sources.files import local


def _folder(spark, name: str) -> str:
    """A new local folder of the shared place, for formats that aren't Spark's."""
    at = local(shared_folder(spark, name))
    os.makedirs(at, exist_ok=True)
    return at


# ---- text and columnar files


@query("SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier")
def sc01_csv_inferred(spark, d):
    at = f"{shared_folder(spark, 'csv')}/suppliers.csv"
    tables.write_csv(table(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal"), at)
    got = tables.csv_inferred(spark, at)
    return got.select(F.col("s_suppkey").cast("long").alias("s_suppkey"), F.col("s_nationkey").cast("long").alias("s_nationkey"), "s_acctbal")


@query(f"SELECT event_id, {stamp('ts')} AS ts, value FROM events")
def sc02_csv_typed(spark, d):
    at = f"{shared_folder(spark, 'csv')}/events"
    observations(spark, d).select("event_id", F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("ts"), "user_id", "value").write.option("header", True).csv(at)
    got = tables.csv(spark, at, "event_id long, ts timestamp, user_id long, value double", time_format="dd/MM/yyyy HH:mm:ss")
    return got.select("event_id", times.text(F.col("ts")).alias("ts"), "value")


@query("SELECT lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS site_no, s_name AS station_name FROM supplier")
def sc03_stations(spark, d):
    at = f"{shared_folder(spark, 'stations')}/list"
    own = table(spark, d, "supplier").select(F.concat_ws(",", ids.zero_filled(F.col("s_suppkey").cast("string")), "s_name").alias("value"))
    head = spark.createDataFrame([("# a list of stations",), ("Site-No,Station Name",)], "value string")
    head.coalesce(1).unionByName(own.coalesce(1)).coalesce(1).write.text(at)
    return tables.stations(spark, at)


@query("SELECT p_partkey, p_size FROM part")
def sc21_by_suffix(spark, d):
    base, own, out = shared_folder(spark, "suffix"), table(spark, d, "part").select("p_partkey", "p_size"), None
    for k, suffix in enumerate(("parquet", "csv", "json")):
        at = f"{base}/part.{suffix}"
        own.where(F.pmod(F.xxhash64("p_partkey"), F.lit(3)) == k).write.format(suffix).option("header", True).save(at)
        got = tables.by_suffix(spark, at, "p_partkey long, p_size long")
        out = got if out is None else out.unionByName(got)
    return out


@query(f"SELECT {stamp('ts')} AS ts, event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-15'")
def sc13_day_shards(spark, d):
    at = f"{shared_folder(spark, 'days')}/shards"
    own = observations(spark, d).select("event_id", "ts", "value", F.date_format("ts", "yyyyMMdd").cast("int").alias("day"))
    tables.write_partitioned(own, at, "day")
    return tables.days(spark, at, "20240110", "20240114").select(times.text(F.col("ts")).alias("ts"), "event_id", "value")


@query("SELECT l_suppkey % 10 AS storm_id, l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey % 10 IN (2, 3, 7)")
def sc14_file_ids(spark, d):
    at = shared_folder(spark, "storms")
    own = table(spark, d, "lineitem").select((F.col("l_suppkey") % 10).alias("k"), "l_orderkey", "l_linenumber")
    tables.write_partitioned(own.withColumn("file", F.concat(F.lit("storm_"), F.col("k").cast("string"), F.lit("_x"))).drop("k"), at, "file")
    return tables.with_file_id(spark.read.parquet(at), r"storm_(\d+)_", wanted=[2, 3, 7]).select("storm_id", "l_orderkey", "l_linenumber")


@query("SELECT lpad(CAST(user_id AS VARCHAR), 8, '0') AS STAID, year(ts) + CAST(month(ts) >= 10 AS INTEGER) AS water_year, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def sc18_landed_years(spark, d):
    """One landed answer of the service a site and water year."""
    at = f"{shared_folder(spark, 'service')}/answers"
    own = observations(spark, d).withColumn("STAID", ids.zero_filled(F.col("user_id").cast("string"))).withColumn("wy", times.water_year(F.col("ts")))
    value = F.struct(F.col("value").cast("string").alias("value"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("dateTime"), F.array(F.lit("A")).alias("qualifiers"))
    series = F.struct(
        F.struct(F.lit("n").alias("siteName"), F.array(F.struct(F.col("STAID").alias("value"))).alias("siteCode")).alias("sourceInfo"),
        F.struct(F.struct(F.lit("ft3/s").alias("unitCode")).alias("unit")).alias("variable"),
        F.array(F.struct(F.col("vs").alias("value"))).alias("values"),
    )
    body = own.groupBy("STAID", "wy").agg(F.collect_list(value).alias("vs")).select("wy", F.to_json(F.struct(F.struct(F.array(series).alias("timeSeries")).alias("value"))).alias("value"))
    body.write.partitionBy("wy").text(at)
    rows = tables.service_rows(spark.read.text(at).withColumnRenamed("value", "body"))
    return rows.groupBy("STAID", times.water_year(F.col("datetime")).alias("water_year")).agg(F.count("*").alias("n"), r(F.sum("discharge_cfs"), 4).alias("total"))


@query(f"WITH {XW} SELECT divide_id, cell_id, fraction FROM xw WHERE divide_id IN (SELECT n_nationkey FROM nation)")
def sc19_index(spark, d):
    at = f"{shared_folder(spark, 'index')}/cells"
    crosswalk(spark, d).write.parquet(at)
    wanted = table(spark, d, "nation").select(F.col("n_nationkey").alias("divide_id"))
    return relational.subset(spark.read.parquet(at), wanted, "divide_id")[0]


# ---- one file with many tables


def _written_divides(spark, d) -> str:
    at = f"{_folder(spark, 'gpkg')}/network.gpkg"
    tri = _triangles(spark, d).select(F.concat(F.lit("cat-"), F.col("divide_id").cast("string")).alias("divide_id"), (F.col("divide_id") * 2).alias("size"), "geometry")
    gpkg.write_layer(tri, at, "divides", "geometry")
    gpkg.write_layer(table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"), at, "nations")
    gpkg.register(spark)
    return at


@query("SELECT 'cat-' || s_suppkey AS divide_id, s_suppkey * 2 AS size FROM supplier")
def sc06_layer_pruned(spark, d):
    return spark.read.format("gpkg").option("layer", "divides").option("columns", "divide_id,size,geometry").option("geometry", "false").load(_written_divides(spark, d))


@query("SELECT 'cat-' || s_suppkey AS divide_id, s_suppkey * 2 AS size FROM supplier WHERE s_suppkey IN (2, 3, 9, 12345678)")
def sc07_layer_where_in(spark, d):
    got = spark.read.format("gpkg").option("layer", "divides").load(_written_divides(spark, d))
    return got.where(F.col("divide_id").isin("cat-2", "cat-3", "cat-9", "cat-12345678")).select("divide_id", "size")


@query("SELECT n_regionkey, count(*) AS n, min(n_name) AS first FROM nation WHERE n_nationkey > 3 GROUP BY 1")
def sc08_file_sql(spark, d):
    return gpkg.queried(spark, _written_divides(spark, d), "SELECT n_regionkey, count(*), min(n_name) FROM nations WHERE n_nationkey > 3 GROUP BY 1", "n_regionkey long, n long, first string")


@query("SELECT unnest(['divides', 'divides', 'divides', 'divides', 'nations', 'nations', 'nations', 'nations']) AS layer, unnest(['fid', 'divide_id', 'size', 'geometry', 'fid', 'n_nationkey', 'n_name', 'n_regionkey']) AS name, unnest(['INTEGER', 'TEXT', 'INTEGER', 'POLYGON', 'INTEGER', 'INTEGER', 'TEXT', 'INTEGER']) AS type")
def sc20_layers(spark, d):
    return spark.createDataFrame([(n, *c) for n, cs in gpkg.layers(_written_divides(spark, d)) for c in cs], "layer string, name string, type string")


@query(f"WITH {_BOX} SELECT 'cat-' || id AS divide_id, round(CAST(0.0713 AS DOUBLE) * CAST(0.0511 AS DOUBLE) / 2, 9) AS area, round(xmin + CAST(0.0713 AS DOUBLE) / 3, 6) AS cx, round(ymin + CAST(0.0511 AS DOUBLE) / 3, 6) AS cy FROM b")
def sk03_layer_written(spark, d):
    got = spark.read.format("gpkg").option("layer", "divides").load(_written_divides(spark, d))
    return spatial.measured(got).select("divide_id", r("area", 9).alias("area"), r("cx").alias("cx"), r("cy").alias("cy"))


@query(f"WITH {_BOX} SELECT id AS divide_id, round(CAST(0.0713 AS DOUBLE) * CAST(0.0511 AS DOUBLE) / 2, 9) AS area FROM b")
def sc05_geometry_parquet(spark, d):
    at = f"{shared_folder(spark, 'geometry')}/divides"
    _triangles(spark, d).select("divide_id", "geometry").write.parquet(at)
    return spatial.measured(spark.read.parquet(at)).select("divide_id", r("area", 9).alias("area"))


@query(f"WITH {_BOX} SELECT id AS unit, 'unit ' || id AS name, round(id / CAST(8 AS DOUBLE), 3) AS weight, round(CAST(0.0713 AS DOUBLE) * CAST(0.0511 AS DOUBLE) / 2, 9) AS area FROM b")
def sc09_shapefile(spark, d):
    at = f"{_folder(spark, 'shapes')}/units.shp"
    own = _triangles(spark, d).select("divide_id", "geometry").collect()  # the fixture
    shapefile.write(at, [("unit", "N", 10, 0), ("name", "C", 20, 0), ("weight", "N", 12, 3)], [(i, f"unit {i}", i / 8, bytes(g)) for i, g in own])
    shapefile.register(spark)
    return spatial.measured(spark.read.format("shp").load(at)).select("unit", "name", "weight", r("area", 9).alias("area"))


# ---- gridded files


def _daily(spark, d):
    """Values by day and hour of the day, of all events: the fixture of the gridded formats."""
    own = observations(spark, d).groupBy(times.day(F.col("ts")).alias("day"), F.hour("ts").alias("hour")).agg(F.count("*").alias("n"), F.max("value").alias("top")).collect()
    days = sorted({x.day for x in own})
    top, n = np.full((len(days), 24), np.nan), np.zeros((len(days), 24), "i4")
    for x in own:
        top[days.index(x.day), x.hour], n[days.index(x.day), x.hour] = x.top, x.n
    return np.array(days, "i8"), top, n


_DAILY = "SELECT epoch_us(ts) // 86400000000 AS day, hour(ts) AS hour, count(*) AS n, max(value) AS top FROM events GROUP BY 1, 2"


@query(f"{_DAILY} HAVING epoch_us(min(ts)) // 86400000000 BETWEEN 19723 AND 20088")
def sc10_zarr_years(spark, d):
    """A store a year; days 19723 to 20088 are 2024."""
    base, (days, top, n) = _folder(spark, "zarr"), _daily(spark, d)
    for y in sorted({int(np.datetime64(int(x), "D").astype("datetime64[Y]").astype(int)) + 1970 for x in days}):
        own = np.array([int(np.datetime64(int(x), "D").astype("datetime64[Y]").astype(int)) + 1970 == y for x in days])
        zarr.write_array(f"{base}/{y}.zarr", "day", days[own], ["day"], [7])
        zarr.write_array(f"{base}/{y}.zarr", "top", top[own], ["day", "hour"], [5, 10])
        zarr.write_array(f"{base}/{y}.zarr", "n", n[own], ["day", "hour"], [5, 10], None)
    got = zarr.years(spark, base, 2024, 2024, ["top", "n"]).where("n > 0")
    return got.select("day", "hour", "n", "top")


def _cube(spark, d):
    own = observations(spark, d).groupBy(F.col("event_type").alias("divide_id"), F.col("hr").alias("ts")).agg(F.avg("v").alias("P"), F.max("value").alias("T"))
    return own


_CUBE = f"WITH {EV} SELECT event_type AS divide_id, {stamp('hr')} AS ts, CAST(CAST(avg(v) AS REAL) AS DOUBLE) AS p, CAST(CAST(max(value) AS REAL) AS DOUBLE) AS t FROM ev GROUP BY event_type, hr"


def _written_cube(spark, d) -> str:
    at = f"{_folder(spark, 'cube')}/cube.nc"
    netcdf.write_cube(_cube(spark, d), at, {"P": "mm h-1", "T": "degC"}, attributes={"title": "hourly forcing"})
    netcdf.register(spark)
    return at


def _read_cube(spark, at: str):
    names = spark.read.format("netcdf").option("variables", "catchment_id").load(at).withColumnRenamed("catchment_id", "divide_id")
    got = spark.read.format("netcdf").option("variables", "P,T").load(at).join(F.broadcast(names), "catchment")
    return got.withColumn("ts", times.text(times.from_epoch_minutes(F.col("time"))))


@query(_CUBE)
def sc11_netcdf(spark, d):
    got = _read_cube(spark, _written_cube(spark, d)).where("P IS NOT NULL OR T IS NOT NULL")
    return got.select("divide_id", "ts", F.col("P").alias("p"), F.col("T").alias("t"))


@query("SELECT DISTINCT event_type AS catchment_id FROM events")
def sc12_netcdf_text(spark, d):
    return spark.read.format("netcdf").option("variables", "catchment_id").load(_written_cube(spark, d)).select("catchment_id")


@query(f"WITH {EV}, b AS (SELECT event_type, hr, avg(v) AS p FROM ev GROUP BY 1, 2), k AS (SELECT DISTINCT event_type FROM b), t AS (SELECT DISTINCT hr FROM b) SELECT k.event_type AS divide_id, count(*) AS n_times, count(p) AS n_present, 'mm h-1' AS units, 'CF-1.8' AS conventions FROM k CROSS JOIN t LEFT JOIN b ON b.event_type = k.event_type AND b.hr = t.hr GROUP BY 1")
def sk05_cf_cube(spark, d):
    at = _written_cube(spark, d)
    file = netcdf.File(at)
    got = _read_cube(spark, at).groupBy("divide_id").agg(F.count("*").alias("n_times"), F.count("P").alias("n_present"))
    return got.withColumns({"units": F.lit(file.variables["P"].attributes["units"]), "conventions": F.lit(file.attributes["Conventions"])})


def _written_grids(spark, d) -> str:
    at, (days, top, _) = _folder(spark, "radar"), _daily(spark, d)
    for k, (day, row) in enumerate(zip(days, top, strict=True)):
        field = np.where(np.isnan(row), -3.0, row).reshape(4, 6)
        with open(f"{at}/rate_{day}.grib2.gz", "wb") as f:
            f.write(gzip.compress(grib.encode(field, 2, as_png=bool(k % 2)), 1))
    return at


@query(f"WITH d AS ({_DAILY}) SELECT day, CAST(hour AS BIGINT) AS cell_id, round(top, 2) AS rate FROM d")
def sc15_radar_messages(spark, d):
    got = tables.with_file_id(tables.grids(spark, f"{_written_grids(spark, d)}/*.gz", grib.gzipped).withColumn("day", F.regexp_extract("path", r"rate_(\d+)", 1).cast("long")), "(.*)", "_none", "string")
    return got.select("day", "cell_id", r("rate", 2).alias("rate"))


@query(f"WITH d AS ({_DAILY}) SELECT day, round(top, 2) AS rate FROM d WHERE hour = 15")
def sc16_radar_point(spark, d):
    got = tables.grids(spark, f"{_written_grids(spark, d)}/*.gz", grib.gzipped).where(F.col("cell_id") == 2 * 6 + 3)
    return got.select(F.regexp_extract("path", r"rate_(\d+)", 1).cast("long").alias("day"), r("rate", 2).alias("rate"))


# ---- sinks of Spark's formats


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def sk01_csv_written(spark, d):
    at = f"{shared_folder(spark, 'report')}/orders"
    tables.write_csv(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), at)
    return tables.csv(spark, at, "o_orderkey long, o_totalprice double, o_orderpriority string")


@query("SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1 UNION ALL SELECT 'all', count(*), round(sum(c_acctbal), 2) FROM customer")
def sk02_partitions_and_whole(spark, d):
    base, own = shared_folder(spark, "parts"), table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    tables.write_partitioned(own, f"{base}/parts", "c_mktsegment")
    tables.write_partitioned(own, f"{base}/whole")
    both = spark.read.parquet(f"{base}/parts").unionByName(spark.read.parquet(f"{base}/whole").withColumn("c_mktsegment", F.lit("all")))
    return both.groupBy("c_mktsegment").agg(F.count("*").alias("n"), r(F.sum("c_acctbal"), 2).alias("total"))


@query(f"WITH {EV} SELECT epoch_us(ts) // 86400000000 AS event_id, event_type AS divide_id, {stamp('hr')} AS ts, round(avg(value), 6) AS p FROM ev WHERE epoch_us(ts) // 86400000000 IN (19730, 19735) GROUP BY 1, 2, hr")
def sk06_event_partitions(spark, d):
    """A cube by event, of which two events are read; others are not opened."""
    at = f"{shared_folder(spark, 'cubes')}/hourly"
    own = observations(spark, d).groupBy(times.day(F.col("ts")).alias("event_id"), F.col("event_type").alias("divide_id"), F.col("hr").alias("ts")).agg(F.avg("value").alias("p"))
    tables.write_partitioned(own, at, "event_id")
    got = spark.read.parquet(at).where("event_id IN (19730, 19735)")
    return got.select(F.col("event_id").cast("long").alias("event_id"), "divide_id", times.text(F.col("ts")).alias("ts"), r("p").alias("p"))


@query("SELECT count(*) AS n, count(DISTINCT r_name) AS names FROM region")
def sk07_atomic_write(spark, d):
    """A write that fails leaves the table as it was."""
    at, own = f"{shared_folder(spark, 'atomic')}/t", table(spark, d, "region").select("r_regionkey", "r_name")
    own.write.parquet(at)
    try:
        own.withColumn("r_name", F.raise_error(F.lit("stop")).cast("string")).write.mode("append").parquet(at)
    except Exception as e:  # the failure is the point
        if "stop" not in str(e):
            raise
    return spark.read.parquet(at).agg(F.count("*").alias("n"), F.countDistinct("r_name").alias("names"))


@query(f"WITH {XW} SELECT divide_id, string_agg(CAST(cell_id AS VARCHAR), ',' ORDER BY cell_id) AS cells FROM xw GROUP BY 1")
def sk09_index_written(spark, d):
    """The nested index, a row a catchment with its cells."""
    at = f"{shared_folder(spark, 'index')}/nested"
    crosswalk(spark, d).groupBy("divide_id").agg(F.sort_array(F.collect_list(F.struct("cell_id", "fraction"))).alias("cells")).write.parquet(at)
    return spark.read.parquet(at).select("divide_id", F.array_join("cells.cell_id", ",").alias("cells"))


# ---- columns


@query("SELECT p_partkey AS part_key, p_size AS size_of_part, p_retailprice AS price FROM part")
def pj07_clean_headers(spark, d):
    p = table(spark, d, "part")
    return ids.clean_headers(p.select(F.col("p_partkey").alias(" Part-Key "), F.col("p_size").alias("SIZE of part"), F.col("p_retailprice").alias("Price")))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS site, s_name AS name FROM supplier")
def pj08_synonyms(spark, d):
    own = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("Site_No"), F.col("s_name").alias("station_nm"))
    site, name = ids.resolved(own, ["STAID", "site_no", "gauge"]), ids.resolved(own, ["name", "station_nm"])
    return own.select(F.col(site).alias("site"), F.col(name).alias("name"))


@query("SELECT s_suppkey, s_acctbal FROM supplier")
def pj09_present_columns(spark, d):
    own = table(spark, d, "supplier")
    return own.select(*ids.present(own, ["s_suppkey", "vpuid", "s_acctbal", "cluster_id"]))


@query(f"WITH {EV}, b AS (SELECT event_type, hr, max(value) AS m FROM ev GROUP BY 1, 2), s AS (SELECT min(hr) AS a, max(hr) AS z FROM b), g AS (SELECT unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS hr FROM s), k AS (SELECT DISTINCT event_type FROM b) SELECT k.event_type AS divide_id, count(*) AS n_steps, string_agg(coalesce(CAST(round(m, 2) AS VARCHAR), 'NA'), ';' ORDER BY g.hr) AS x FROM k CROSS JOIN g LEFT JOIN b ON b.event_type = k.event_type AND b.hr = g.hr GROUP BY 1")
def pj13_transposed(spark, d):
    own = observations(spark, d).groupBy(F.lit(1).alias("event_id"), F.col("event_type").alias("divide_id"), F.col("hr").alias("ts")).agg(F.max("value").alias("x"))
    got = cubes.nested(cubes.numbered_steps(own, minutes=60), ["x"])
    return got.select("divide_id", F.size("x").cast("long").alias("n_steps"), F.array_join(F.transform("x", lambda v: F.coalesce(F.round(v, 2).cast("string"), F.lit("NA"))), ";").alias("x"))


@query("SELECT c_custkey FROM customer WHERE c_acctbal / 10 BETWEEN -180 AND 180 AND c_custkey % 200 - 100 BETWEEN -90 AND 90")
def fl05_valid_places(spark, d):
    own = table(spark, d, "customer")
    return own.where(ids.valid_place(F.col("c_acctbal") / 10, (F.col("c_custkey") % 200 - 100).cast("double"))).select("c_custkey")


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'x-' ELSE 'wb-' END || c_custkey AS id FROM customer WHERE c_custkey % 5 <> 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')")
def fl10_like_and_in(spark, d):
    k = F.col("c_custkey")
    own = table(spark, d, "customer").select("c_custkey", "c_mktsegment", F.concat(F.when(k % 5 == 0, "x-").otherwise("wb-"), k.cast("string")).alias("id"))
    return own.where(F.col("id").like("wb-%") & F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "id")


@query("SELECT s_suppkey, 'gage-' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS tag FROM supplier")
def fs10_gauge_tags(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", ids.gauge_tag(ids.zero_filled(F.col("s_suppkey").cast("string"))).alias("tag"))


@query("SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS text FROM supplier")
def fs11_float_ids(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", ids.whole_number_text(F.col("s_suppkey").cast("double")).alias("text"))


@query(f"SELECT event_id, {stamp('ts - INTERVAL 7 HOUR')} AS local, {stamp('ts')} AS again, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-07:00' AS text FROM events")
def fs23_zones(spark, d):
    ts = F.col("ts")
    local_ = times.in_zone(ts, "-07:00")
    return observations(spark, d).select("event_id", times.text(local_).alias("local"), times.text(times.from_zone(local_, "-07:00")).alias("again"), times.text_with_offset(ts, "-07:00").alias("text"))


# ---- geometry


@query("SELECT s_suppkey, round(-100 + s_suppkey / CAST(100 AS DOUBLE), 6) AS x, round(30 + (s_suppkey % 90) / CAST(10 AS DOUBLE), 6) AS y FROM supplier")
def sp01_points(spark, d):
    k = F.col("s_suppkey")
    own = table(spark, d, "supplier").select("s_suppkey", (k / 100.0 - 100).alias("lon"), ((k % 90) / 10.0 + 30).alias("lat"))
    got = spatial.coordinates(spatial.as_points(own, "lon", "lat"))
    return got.select("s_suppkey", r("x").alias("x"), r("y").alias("y"))


@query("SELECT p_partkey, round(-120 + (p_partkey % 100) * CAST(0.5 AS DOUBLE), 7) AS lon, CAST(25 + (p_partkey // 100) % 25 AS DOUBLE) AS lat FROM part")
def sp02_there_and_back(spark, d):
    k = F.col("p_partkey")
    x, y = physics.albers((k % 100) * 0.5 - 120.0, F.floor(k / 100) % 25 + 25.0)
    lon, lat = physics.albers_inverse(F.col("x"), F.col("y"))
    return table(spark, d, "part").select("p_partkey", x.alias("x"), y.alias("y")).select("p_partkey", r(lon, 7).alias("lon"), r(lat, 7).alias("lat"))


@query(f"WITH {XW}, c AS (SELECT divide_id, cell_id, cell_id // 100 AS row, cell_id % 100 AS col FROM xw), b AS (SELECT min(row) AS r0, max(row) AS r1, min(col) AS c0, max(col) AS c1 FROM c) SELECT divide_id, cell_id, (row - r0) * (c1 - c0 + 1) + (col - c0) AS local_id FROM c CROSS JOIN b")
def sp07_local_cells(spark, d):
    whole = grid.Grid(3500, 100, -130.0, 55.0, 0.01)
    own = crosswalk(spark, d).select("divide_id", "cell_id")
    return whole.remapped(own).select("divide_id", "cell_id", "local_id")


@query(f"WITH {_BOX} SELECT id, round(32 * sin(pi() / 16) / 2 * power(CAST(0.01 AS DOUBLE) * (id % 7 + 1), 2), 7) AS area, round(xmin, 6) AS cx, round(ymin, 6) AS cy FROM b")
def sp15_buffers(spark, d):
    own = _boxes(spark, d).select("id", F.col("xmin").alias("x"), F.col("ymin").alias("y"), ((F.col("id") % 7 + 1) * 0.01).alias("radius"))
    return spatial.measured(spatial.buffered(own, "radius")).select("id", r("area", 7).alias("area"), r("cx").alias("cx"), r("cy").alias("cy"))


@query("SELECT s_suppkey AS id, CASE s_suppkey % 4 WHEN 0 THEN CAST(2 AS DOUBLE) WHEN 1 THEN CAST(1 AS DOUBLE) WHEN 2 THEN CAST(4 AS DOUBLE) END AS area FROM supplier")
def sp16_repaired(spark, d):
    """A ring that crosses itself (two loops of one unit), a square with repeated corners, one that runs clockwise, and a line."""
    shapes = [wkb.polygon([(0, 0), (2, 2), (2, 0), (0, 2)]), wkb.polygon([(0, 0), (1, 0), (1, 0), (1, 1), (0, 1), (0, 1)]), wkb.polygon([(0, 0), (0, 2), (2, 2), (2, 0)]), wkb.polygon([(0, 0), (1, 1), (2, 2)])]
    made = F.array(*(F.lit(x) for x in shapes))
    own = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.element_at(made, (F.col("s_suppkey") % 4 + 1).cast("int")).alias("geometry"))
    return spatial.measured(spatial.repaired(own)).select("id", r("area", 9).alias("area"))


@query(f"WITH {_BOX} SELECT id AS divide_id, round(xmin + CAST(0.0713 AS DOUBLE) / 3, 6) AS cx, round(ymin + CAST(0.0511 AS DOUBLE) / 3, 6) AS cy FROM b")
def sp18_centroids(spark, d):
    return spatial.measured(_triangles(spark, d)).select("divide_id", r("cx").alias("cx"), r("cy").alias("cy"))


_PARTS = f"{_BOX}, g AS (SELECT row, col, -130 + col * CAST(0.02 AS DOUBLE) AS x0, 42 - (row + 1) * CAST(0.02 AS DOUBLE) AS y0 FROM (SELECT unnest(range(0, 300)) AS row), (SELECT unnest(range(0, 600)) AS col)), p AS (SELECT id, CAST(row * 600 + col AS BIGINT) AS cell_id, greatest(0, x0 - xmin) / CAST(0.0713 AS DOUBLE) AS a, greatest(0, x0 + CAST(0.02 AS DOUBLE) - xmin) / CAST(0.0713 AS DOUBLE) AS b, greatest(0, y0 - ymin) / CAST(0.0511 AS DOUBLE) AS c, greatest(0, y0 + CAST(0.02 AS DOUBLE) - ymin) / CAST(0.0511 AS DOUBLE) AS d FROM b JOIN g ON x0 < xmin + 0.0713 AND x0 + 0.02 > xmin AND y0 < ymin + 0.0511 AND y0 + 0.02 > ymin)"


def _corner(x: str, y: str) -> str:
    """Area of the unit triangle left of x and below y."""
    half = lambda z: f"power(greatest(0, {z}), 2) / 2"
    return f"(CAST(0.5 AS DOUBLE) - {half(f'1 - {x}')} - {half(f'1 - {y}')} + {half(f'1 - {x} - {y}')})"


_SHARE = f"({_corner('b', 'd')} - {_corner('a', 'd')} - {_corner('b', 'c')} + {_corner('a', 'c')}) * CAST(0.0713 AS DOUBLE) * CAST(0.0511 AS DOUBLE)"


@query(f"WITH {_PARTS}, o AS (SELECT id, cell_id, {_SHARE} AS area FROM p), f AS (SELECT id, cell_id, area / (CAST(0.02 AS DOUBLE) * CAST(0.02 AS DOUBLE)) AS fraction FROM o WHERE area > CAST(1e-9 AS DOUBLE)) SELECT id AS divide_id, cell_id, round(fraction, 6) AS fraction, round(fraction / sum(fraction) OVER (PARTITION BY id), 6) AS weight FROM f")
def dm20_fractional_crosswalk(spark, d):
    from freshet.operators import weights

    got = spatial.cell_overlaps(_cells(spark, d), _triangles(spark, d), 0.1, 1e-9)
    return weights.normalised(got.select("divide_id", "cell_id", "fraction")).select("divide_id", "cell_id", r("fraction").alias("fraction"), r("weight").alias("weight"))


@query(f"WITH {_PARTS} SELECT id AS divide_id, cell_id FROM p WHERE {_SHARE} >= (1 - CAST(1e-9 AS DOUBLE)) * CAST(0.02 AS DOUBLE) * CAST(0.02 AS DOUBLE)")
def sp20_cells_inside(spark, d):
    return spatial.cells_inside(_cells(spark, d), _triangles(spark, d), 0.1).select("divide_id", "cell_id")


def _to_line(x0: str, y0: str, x1: str, y1: str) -> str:
    """Distance of the point (x, y) to a line between two points."""
    t = f"least(1, greatest(0, ((x - ({x0})) * (({x1}) - ({x0})) + (y - ({y0})) * (({y1}) - ({y0}))) / (power(({x1}) - ({x0}), 2) + power(({y1}) - ({y0}), 2))))"
    return f"sqrt(power(({x0}) + {t} * (({x1}) - ({x0})) - x, 2) + power(({y0}) + {t} * (({y1}) - ({y0})) - y, 2))"


_W, _H = "CAST(0.0713 AS DOUBLE)", "CAST(0.0511 AS DOUBLE)"
_SIDES = f"least({_to_line('xmin', 'ymin', f'xmin + {_W}', 'ymin')}, {_to_line('xmin', 'ymin', 'xmin', f'ymin + {_H}')}, {_to_line(f'xmin + {_W}', 'ymin', 'xmin', f'ymin + {_H}')})"


@query(f"WITH {_BOX}, p AS (SELECT id AS storm, xmin + CAST(0.2 AS DOUBLE) AS x, ymin AS y FROM b), n AS (SELECT storm, id AS divide_id, CASE WHEN x > xmin AND y > ymin AND (x - xmin) / {_W} + (y - ymin) / {_H} < 1 THEN 0 ELSE {_SIDES} END AS distance FROM p JOIN b ON abs(x - xmin) < 0.4 AND abs(y - ymin) < 0.4) SELECT storm, divide_id, round(CAST(distance AS DOUBLE), 6) AS distance FROM n WHERE distance <= CAST(0.15 AS DOUBLE)")
def jn18_points_near(spark, d):
    points = _boxes(spark, d).select(F.col("id").alias("storm"), (F.col("xmin") + 0.2).alias("x"), F.col("ymin").alias("y"), F.lit(0.15).alias("radius"))
    return spatial.points_near(points, _triangles(spark, d), "radius", 0.1).select("storm", "divide_id", r("distance").alias("distance"))


@query(f"WITH {_BOX} SELECT id AS divide_id FROM b WHERE xmin + 0.0713 >= -128.9 AND xmin <= -128.7 AND ymin + 0.0511 >= 40.02 AND ymin <= 40.12")
def fl17_in_box(spark, d):
    return spatial.in_box(_triangles(spark, d), -128.9, 40.02, -128.7, 40.12).select("divide_id")


@query(f"WITH {_BOX} SELECT id AS divide_id, round(xmin - CAST(0.05 AS DOUBLE), 6) AS xmin, round(ymin - CAST(0.05 AS DOUBLE), 6) AS ymin, round(xmin + CAST(0.1213 AS DOUBLE), 6) AS xmax, round(ymin + CAST(0.1011 AS DOUBLE), 6) AS ymax FROM b")
def sp22_bounds_with_margin(spark, d):
    got = spatial.with_margin(_triangles(spark, d), 0.05)
    return got.select("divide_id", *(r(c).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")))


@query("WITH s AS (SELECT s_suppkey // 10 AS k, count(*) AS n FROM supplier GROUP BY 1) SELECT k, round(CAST(n AS DOUBLE), 6) AS area FROM s")
def ag23_dissolved(spark, d):
    """Unit squares side by side, one a supplier, ten of a key in a row."""
    k = F.col("s_suppkey")
    own = table(spark, d, "supplier").select(F.floor(k / 10).cast("long").alias("k"), (k % 10).cast("double").alias("x"), (F.floor(k / 10) * 2).cast("double").alias("y"))
    got = spatial.dissolved(spatial.as_boxes(own, "x", "y", 1.0, 1.0).select("k", "geometry"), "k")
    return spatial.measured(got).select("k", r("area").alias("area"))


@query("SELECT k AS row, round(CAST(55 AS DOUBLE) - (k + CAST(0.5 AS DOUBLE)) * CAST(0.01 AS DOUBLE), 6) AS lat FROM (SELECT unnest(range(0, 300)) AS k)")
def sl06_rows_from_north(spark, d):
    """A grid stored from south to north, in rows from north to south."""
    g = grid.Grid(300, 100, -130.0, 55.0, 0.01)
    stored = spark.range(300).select(F.col("id").alias("stored_row"), (F.lit(52.0) + (F.col("id") + 0.5) * 0.01).alias("lat"))
    return stored.select(g.from_south(F.col("stored_row")).alias("row"), r("lat").alias("lat"))


# ---- catalogs


@query(f"WITH {XW}, c AS (SELECT DISTINCT cell_id, divide_id FROM xw), f AS (SELECT cell_id, min(divide_id) AS divide_id FROM c GROUP BY 1), e AS (SELECT DISTINCT o_custkey % 50 AS event_id, l_suppkey AS divide_id FROM orders JOIN lineitem ON l_orderkey = o_orderkey) SELECT e.event_id, count(*) AS n, count(DISTINCT f.cell_id) AS n_cells FROM e JOIN f ON f.divide_id = e.divide_id GROUP BY 1")
def jn04_event_centres(spark, d):
    centre = crosswalk(spark, d).groupBy("cell_id").agg(F.min("divide_id").alias("divide_id"))
    lines = table(spark, d, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("divide_id"))
    own = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("event_id"), F.col("o_orderkey").alias("l_orderkey"))
    pairs = own.join(lines, "l_orderkey").select("event_id", "divide_id").distinct()
    return pairs.join(centre, "divide_id").dropDuplicates(["event_id", "divide_id", "cell_id"]).groupBy("event_id").agg(F.count("*").alias("n"), F.countDistinct("cell_id").alias("n_cells"))


@query("SELECT o_orderkey AS event_id, n_name AS cluster_id FROM orders LEFT JOIN (SELECT n_nationkey, n_name FROM nation) ON n_nationkey = o_custkey")
def jn05_clusters(spark, d):
    names = table(spark, d, "nation").select(F.col("n_nationkey").alias("gauge"), F.col("n_name").alias("cluster_id"))
    return floods(spark, d).select("event_id", "gauge").join(F.broadcast(names), "gauge", "left").select("event_id", "cluster_id")


@query(f"WITH {_PARTS} SELECT cell_id, id AS divide_id, round(CAST(0.0713 AS DOUBLE) * CAST(0.0511 AS DOUBLE) / 2, 9) AS area FROM p WHERE {_SHARE} > CAST(1e-9 AS DOUBLE)")
def jn19_carried_geometry(spark, d):
    """The right side's geometry comes along with each match."""
    got = spatial.cell_overlaps(_cells(spark, d), _triangles(spark, d), 0.1, 1e-9).select("cell_id", "divide_id", "geometry")
    return spatial.measured(got).select("cell_id", "divide_id", r("area", 9).alias("area"))


@query(f"WITH {_BOX}, p AS (SELECT id, xmin + (id % 3) * CAST(0.02 AS DOUBLE) + CAST(0.001 AS DOUBLE) AS x, ymin + CAST(0.001 AS DOUBLE) AS y FROM b), u AS (SELECT xmin, ymin FROM b WHERE id = 5) SELECT lpad(CAST(p.id AS VARCHAR), 8, '0') AS STAID, round(p.y, 6) AS LAT_GAGE, round(p.x, 6) AS LNG_GAGE FROM p, u WHERE p.x > u.xmin AND p.y > u.ymin AND (p.x - u.xmin) / {_W} + (p.y - u.ymin) / {_H} < 1")
def dm16_gauges_within(spark, d):
    own = _boxes(spark, d).select(F.concat(F.col("id").cast("string"), F.lit(".0")).alias("STAID"), (F.col("ymin") + 0.001).alias("LAT_GAGE"), (F.col("xmin") + (F.col("id") % 3) * 0.02 + 0.001).alias("LNG_GAGE"))
    units = _triangles(spark, d).select(F.col("divide_id").cast("string").alias("HUC8"), "geometry")
    return pipelines.gauges_within(own, units, "5", 0.1).select("STAID", r("LAT_GAGE").alias("LAT_GAGE"), r("LNG_GAGE").alias("LNG_GAGE"))


# ---- event detection: the recurrence as a recursive query


def detection_sql(x: str, residual: float, p: hydro.Detection = hydro.Detection()) -> str:
    """CTEs that end in ``found(k, a, b, peak)``, from hourly ``x(k, i, hr, q)`` numbered from 0, missing values as nulls."""
    alpha, back, near = f"CAST({1 - 0.5 ** (1 / p.halflife)!r} AS DOUBLE)", p.window, round(p.radius)
    around = f"ROWS BETWEEN {back - 1 - (back - 1) // 2} PRECEDING AND {(back - 1) // 2} FOLLOWING"
    return f"""{x}, x1 AS (SELECT *, last_value(q IGNORE NULLS) OVER u AS pv, last_value(CASE WHEN q IS NOT NULL THEN i END IGNORE NULLS) OVER u AS pi,
            first_value(q IGNORE NULLS) OVER w AS nv, first_value(CASE WHEN q IS NOT NULL THEN i END IGNORE NULLS) OVER w AS ni FROM x
            WINDOW u AS (PARTITION BY k ORDER BY i ROWS UNBOUNDED PRECEDING), w AS (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        y AS (SELECT k, i, hr, coalesce(q, pv + (nv - pv) * ((i - pi) / CAST(nullif(ni - pi, 0) AS DOUBLE)), pv, nv) AS q, count(*) OVER (PARTITION BY k) AS n FROM x1),
        fw(k, i, l) AS (SELECT k, i, q FROM y WHERE i = 0 AND n >= 3 AND q IS NOT NULL UNION ALL SELECT y.k, y.i, fw.l + {alpha} * (y.q - fw.l) FROM fw JOIN y ON y.k = fw.k AND y.i = fw.i + 1),
        bw(k, i, l) AS (SELECT k, i, q FROM y WHERE i = n - 1 AND n >= 3 AND q IS NOT NULL UNION ALL SELECT y.k, y.i, bw.l + {alpha} * (y.q - bw.l) FROM bw JOIN y ON y.k = bw.k AND y.i = bw.i - 1),
        s AS (SELECT fw.k, fw.i, (fw.l + bw.l) / 2 AS s FROM fw JOIN bw ON bw.k = fw.k AND bw.i = fw.i),
        o AS (SELECT k, i, s - min(s) OVER (PARTITION BY k ORDER BY i {around}) > {residual} AS over FROM s),
        g AS (SELECT k, i, i - row_number() OVER (PARTITION BY k ORDER BY i) AS run FROM o WHERE over),
        e0 AS (SELECT k, min(i) AS i0, max(i) AS b FROM g GROUP BY k, run HAVING max(i) - min(i) >= {p.minimum}),
        e1 AS (SELECT e0.k, b, arg_min(y.i, (y.q, y.i)) AS a FROM e0 JOIN y ON y.k = e0.k AND y.i BETWEEN greatest(0, i0 - {near}) AND i0 GROUP BY e0.k, i0, b),
        found AS (SELECT e1.k, a, b, max(y.q) AS peak FROM e1 JOIN y ON y.k = e1.k AND y.i BETWEEN a AND b GROUP BY e1.k, a, b)"""


_GRID_HOURS = "s0 AS (SELECT k, min(hr) AS lo, max(hr) AS hi FROM b0 GROUP BY 1), g0 AS (SELECT k, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hr FROM s0)"
_HOURS = f"{EV}, b0 AS (SELECT event_type AS k, hr, avg(v) AS m FROM ev GROUP BY 1, 2), {_GRID_HOURS}, x AS (SELECT g0.k, row_number() OVER (PARTITION BY g0.k ORDER BY g0.hr) - 1 AS i, g0.hr, m AS q FROM g0 LEFT JOIN b0 ON b0.k = g0.k AND b0.hr = g0.hr)"
_TIMES = f"{stamp('p.hr')} AS begin, {stamp('z.hr')} AS \"end\""


def _hours(spark, d, value: str = "v"):
    own = timeseries.binned(observations(spark, d), ["event_type"], 60, F.avg(value).alias("m"))
    return timeseries.densified(own, ["event_type"], 60)


@query(f"WITH RECURSIVE {detection_sql(_HOURS, 20.0)} SELECT f.k AS event_type, {_TIMES}, round(peak, 6) AS peak FROM found f JOIN y p ON p.k = f.k AND p.i = f.a JOIN y z ON z.k = f.k AND z.i = f.b")
def wn17_detect(spark, d):
    got = hydro.detected(_hours(spark, d), "event_type", "m", "bin", hydro.Detection(residual=20.0))
    return got.select("event_type", times.text(F.col("begin")).alias("begin"), times.text(F.col("end")).alias("end"), r("peak").alias("peak"))


_HOLES = _HOURS.replace("m AS q", "CASE WHEN hour(g0.hr) % 5 = 0 THEN NULL ELSE m END AS q")


@query(f"WITH RECURSIVE {detection_sql(_HOLES, 15.0)} SELECT f.k AS event_type, {_TIMES}, round(peak, 6) AS peak FROM found f JOIN y p ON p.k = f.k AND p.i = f.a JOIN y z ON z.k = f.k AND z.i = f.b")
def wn18_detect_with_holes(spark, d):
    """Every fifth hour is missing, so that the first try finds nothing and the filled series is used."""
    holes = _hours(spark, d).withColumn("m", F.when(F.hour("bin") % 5 != 0, F.col("m")))
    got = hydro.detected(holes, "event_type", "m", "bin", hydro.Detection(residual=15.0))
    return got.select("event_type", times.text(F.col("begin")).alias("begin"), times.text(F.col("end")).alias("end"), r("peak").alias("peak"))


_FLOWS = f"""{EV}, u0 AS (SELECT event_type AS k, ts, arg_min(CASE WHEN v IS NULL THEN 'NaN'::DOUBLE ELSE v END, event_id) AS v FROM ev GROUP BY 1, 2), u1 AS (SELECT k, ts, date_trunc('hour', ts) AS hr, CASE WHEN NOT isnan(v) THEN v END AS v FROM u0),
    b0 AS (SELECT k, hr, arg_min(v, ts) FILTER (WHERE v IS NOT NULL) AS m FROM u1 GROUP BY 1, 2), {_GRID_HOURS},
    x AS (SELECT g0.k, row_number() OVER w - 1 AS i, g0.hr, last_value(m IGNORE NULLS) OVER w AS q FROM g0 LEFT JOIN b0 ON b0.k = g0.k AND b0.hr = g0.hr WINDOW w AS (PARTITION BY g0.k ORDER BY g0.hr ROWS UNBOUNDED PRECEDING))"""
_LIMIT = """c0 AS (SELECT k, q, row_number() OVER (PARTITION BY k ORDER BY q DESC) AS j, count(*) OVER (PARTITION BY k) AS n FROM x WHERE q > 0), c1 AS (SELECT k, any_value(n) AS n, CAST(25 AS DOUBLE) * (any_value(n) + 1) / 100 AS pos FROM c0 GROUP BY 1),
    lim AS (SELECT c1.k, CASE WHEN pos <= 1 THEN max(q) WHEN pos >= c1.n THEN min(q) ELSE max(CASE WHEN j = floor(pos) THEN q END) + (max(CASE WHEN j = floor(pos) + 1 THEN q END) - max(CASE WHEN j = floor(pos) THEN q END)) * (pos - floor(pos)) END AS thr FROM c1 JOIN c0 ON c0.k = c1.k GROUP BY c1.k, pos, c1.n)"""
_INNER = """inn AS (SELECT f.k, f.a, f.b, x.i, x.hr, x.q, lag(x.q) OVER w AS pq, lag(x.hr) OVER w AS ph FROM found f JOIN x ON x.k = f.k AND x.i BETWEEN f.a AND f.b AND x.q IS NOT NULL WINDOW w AS (PARTITION BY f.k, f.a, f.b ORDER BY x.i)),
    met AS (SELECT k, a, b, max(q) AS peak, arg_min(hr, (-q, i)) AS pt, coalesce(sum((q + pq) / 2 * ((epoch_us(hr) - epoch_us(ph)) / CAST(1000000 AS DOUBLE))), 0) / CAST(43560 AS DOUBLE) AS vol, coalesce(sum(abs(q - pq)), 0) AS ch, sum(q) AS tot FROM inn GROUP BY 1, 2, 3)"""


@query(
    f"""WITH RECURSIVE {detection_sql(_FLOWS, 20.0)}, {_LIMIT}, {_INNER}
    SELECT m.k AS STAID, {stamp('p.hr')} AS BEGIN_DATE_TIME, {stamp('z.hr')} AS END_DATE_TIME, {stamp('pt')} AS peak_time, round(peak, 6) AS peak_flow_cfs, round(vol, 4) AS volume_acreft, round(CASE WHEN tot > 0 THEN ch / tot END, 6) AS flashiness_index,
        year(p.hr) AS "YEAR", month(p.hr) AS month, day(p.hr) AS day, year(p.hr) + CAST(month(p.hr) >= 10 AS INTEGER) AS water_year, CAST(b - a AS DOUBLE) AS duration_hours, (epoch_us(pt) - epoch_us(p.hr)) / CAST(3600000000 AS DOUBLE) AS time_to_peak_h,
        row_number() OVER (ORDER BY m.k, p.hr, z.hr) AS event_id, CAST(35 AS DOUBLE) AS gage_lat, CAST(-78 AS DOUBLE) AS gage_lon
    FROM met m JOIN lim ON lim.k = m.k JOIN x p ON p.k = m.k AND p.i = m.a JOIN x z ON z.k = m.k AND z.i = m.b WHERE peak >= thr"""
)
def dm14_flood_table(spark, d):
    raw = observations(spark, d).select(F.col("event_type").alias("STAID"), "ts", F.col("v").alias("q"), F.col("event_id").alias("ord"))
    gauges = raw.select("STAID").distinct().withColumn("LAT_GAGE", F.lit(35.0)).withColumn("LNG_GAGE", F.lit(-78.0))
    got = pipelines.flood_table(raw, gauges, pipelines.Floods(minutes=60, detection=hydro.Detection(residual=20.0)))
    clock = {c: times.text(F.col(c)) for c in ("BEGIN_DATE_TIME", "END_DATE_TIME", "peak_time")}
    return got.withColumns({**clock, "peak_flow_cfs": r("peak_flow_cfs"), "volume_acreft": r("volume_acreft", 4), "flashiness_index": r("flashiness_index")})
