"""Composite domain operators and the remaining column operators as queries, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.functions import ids, physics, times
from freshet.operators import cubes, events, graph, grid, hydro, relational, spatial, timeseries, weights
from freshet.plans import pipelines
from freshet.plans.queries import _BOX, _COARSE, _INSIDE, _TREE, EV, FL, XW, _boxes, _cells, _tree, _triangles, crosswalk, dense_hours, floods, hourly, observations, query, r, stamp, table

# ---- forcing and radar: event types are cells of two catchments


_INDEX = "ix AS (SELECT 'click' AS cell, 'a' AS unit, CAST(0.5 AS DOUBLE) AS w UNION ALL SELECT 'view', 'a', CAST(0.3 AS DOUBLE) UNION ALL SELECT 'signup', 'a', CAST(0.2 AS DOUBLE) UNION ALL SELECT 'view', 'b', CAST(0.6 AS DOUBLE) UNION ALL SELECT 'purchase', 'b', CAST(0.4 AS DOUBLE))"


def _index(spark):
    rows = [("click", "a", 0.5), ("view", "a", 0.3), ("signup", "a", 0.2), ("view", "b", 0.6), ("purchase", "b", 0.4)]
    return spark.createDataFrame(rows, "cell_id string, divide_id string, weight double")


def _grid_obs(spark, d):
    own = observations(spark, d)
    return own.groupBy(F.col("hr").alias("ts"), F.col("event_type").alias("cell_id")).agg(F.avg("v").alias("x"), F.max("value").alias("y"))


_CELL_HOURS = f"{EV}, {_INDEX}, o AS (SELECT hr, event_type AS cell, avg(v) AS x, max(value) AS y FROM ev GROUP BY 1, 2), j AS (SELECT unit, hr, x, y, w FROM o JOIN ix ON ix.cell = o.cell)"


@query(f"WITH {_CELL_HOURS} SELECT unit AS divide_id, {stamp('hr')} AS ts, round(CASE WHEN count(x) = count(*) THEN sum(x * w) END, 6) AS x, round(CASE WHEN count(y) = count(*) THEN sum(y * w) END, 6) AS y FROM j GROUP BY unit, hr")
def dm02_catchment_forcing(spark, d):
    got = pipelines.catchment_forcing(_grid_obs(spark, d), _index(spark), ["x", "y"])
    return got.select("divide_id", times.text(F.col("ts")).alias("ts"), r("x").alias("x"), r("y").alias("y"))


@query(f"WITH {_CELL_HOURS} SELECT unit AS divide_id, {stamp('hr')} AS ts, round(sum(x * w) / nullif(sum(CASE WHEN x IS NOT NULL THEN w END), 0), 9) AS rate FROM j GROUP BY unit, hr")
def dm07_catchment_rate(spark, d):
    got = weights.catchment_means(_grid_obs(spark, d), _index(spark), ["x"], "renormalize")
    return got.select("divide_id", times.text(F.col("ts")).alias("ts"), r("x", 9).alias("rate"))


_RADAR = f"{EV}, {_INDEX}, o AS (SELECT ts, event_type AS cell, CASE WHEN event_id % 5 = 0 THEN -1 ELSE value END AS v FROM events), c AS (SELECT ts, cell, CASE WHEN v >= 0 THEN v END AS v FROM o), j AS (SELECT unit, ts, sum(v * w) / nullif(sum(CASE WHEN v IS NOT NULL THEN w END), 0) AS rate FROM c JOIN ix ON ix.cell = c.cell GROUP BY 1, 2), q AS (SELECT unit, time_bucket(INTERVAL 15 MINUTE, ts) AS b, avg(rate) * CAST(0.25 AS DOUBLE) AS p FROM j GROUP BY 1, 2)"


def _rates(spark, d):
    return observations(spark, d).select("ts", F.col("event_type").alias("cell_id"), F.when(F.col("event_id") % 5 == 0, -1.0).otherwise(F.col("value")).alias("rate"))


@query(f"WITH {_RADAR} SELECT unit AS divide_id, {stamp('b')} AS bin, round(p, 6) AS p FROM q")
def dm08_radar_depth(spark, d):
    return pipelines.radar_depths(_rates(spark, d), _index(spark)).select("divide_id", times.text(F.col("bin")).alias("bin"), r("P").alias("p"))


@query(f"WITH {_RADAR} SELECT {stamp('b')} AS ts, round(avg(p), 9) AS mean, round(max(p), 9) AS max FROM q GROUP BY b")
def dm34_event_series(spark, d):
    cube = pipelines.radar_depths(_rates(spark, d), _index(spark)).withColumnRenamed("bin", "ts").withColumn("event_id", F.lit(1))
    return pipelines.event_series(cube).select(times.text(F.col("ts")).alias("ts"), r("mean", 9).alias("mean"), r("max", 9).alias("max"))


@query(f"WITH {_INDEX}, j AS (SELECT unit, ts, coalesce(sum(CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END * w), 0) AS z FROM events JOIN ix ON ix.cell = event_type GROUP BY 1, 2) SELECT {stamp('ts')} AS ts, count(*) AS n, round(avg(z) * 2 / CAST(60 AS DOUBLE), 6) AS mean, round(max(z) * 2 / CAST(60 AS DOUBLE), 6) AS max FROM j GROUP BY ts")
def dm33_event_series_2min(spark, d):
    obs = observations(spark, d).select("ts", F.col("event_type").alias("cell_id"), "v")
    got = weights.catchment_means(obs, _index(spark), ["v"], "zero").groupBy("ts").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.max("v").alias("max"))
    return got.select(times.text(F.col("ts")).alias("ts"), "n", *(r(physics.depth(F.col(c), 2)).alias(c) for c in ("mean", "max")))


@query(f"SELECT event_id, {stamp('ts')} AS ts, round(CASE WHEN event_id % 5 <> 0 THEN value END * 2 / CAST(60 AS DOUBLE), 8) AS depth FROM events WHERE event_type = 'view'")
def dm32_point_series(spark, d):
    own = observations(spark, d).select("event_id", "ts", F.col("event_type").alias("cell_id"), F.when(F.col("event_id") % 5 == 0, -1.0).otherwise(F.col("value")).alias("rate"))
    got = own.where("cell_id = 'view'").withColumn("depth", r(physics.depth(physics.present_rate(F.col("rate")), 2), 8))
    return got.select("event_id", times.text(F.col("ts")).alias("ts"), "depth")


@query(f"WITH {EV}, s AS (SELECT epoch_us(ts) // 86400000000 AS event_id, hr, event_type, count(*) AS n FROM ev GROUP BY 1, 2, 3) SELECT event_id, {stamp('min(hr)')} AS ts_start, {stamp('max(hr)')} AS ts_end, (max(epoch_us(hr)) - min(epoch_us(hr))) // 3600000000 + 1 AS n_steps FROM s GROUP BY 1")
def dm09_cube_shape(spark, d):
    rows = observations(spark, d).select(times.day(F.col("ts")).alias("event_id"), F.col("hr").alias("ts"), "event_type").distinct()
    got = cubes.shape(cubes.numbered_steps(rows, minutes=60))
    return got.select("event_id", times.text(F.col("ts_start")).alias("ts_start"), times.text(F.col("ts_end")).alias("ts_end"), "n_steps")


@query(f"WITH {EV}, b AS (SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts) AS hr, arg_min(v, ts) FILTER (WHERE v IS NOT NULL) AS m FROM ev GROUP BY 1, 2), s AS (SELECT user_id, min(hr) AS a, max(hr) AS z FROM b GROUP BY 1), g AS (SELECT user_id, unnest(generate_series(a, z, INTERVAL 6 HOUR)) AS hr FROM s) SELECT g.user_id, {stamp('g.hr')} AS bin, last_value(m IGNORE NULLS) OVER (PARTITION BY g.user_id ORDER BY g.hr ROWS UNBOUNDED PRECEDING) AS q FROM g LEFT JOIN b ON b.user_id = g.user_id AND b.hr = g.hr")
def dm12_clean_flows(spark, d):
    raw = observations(spark, d).select(F.col("user_id").alias("STAID"), "ts", F.col("v").alias("q"), F.col("event_id").alias("ord"))
    return pipelines.clean_flows(raw, 360).select(F.col("STAID").alias("user_id"), times.text(F.col("bin")).alias("bin"), "q")


@query()
def dm06_event_forcing(spark, d):
    own = observations(spark, d).groupBy(F.col("hr").alias("ts")).agg(F.avg("value").alias("x"))
    forcing = own.select(F.lit("cat-1").alias("divide_id"), "ts", F.col("x").alias("APCP_surface"), (F.col("x") + 100).alias("DSWRF_surface"), (F.col("x") / 50 + 280).alias("TMP_2maboveground"), F.lit(340.0).alias("DLWRF_surface"), F.lit(1e5).alias("PRES_surface"), F.lit(0.008).alias("SPFH_2maboveground"), F.lit(2.0).alias("UGRD_10maboveground"), F.lit(1.0).alias("VGRD_10maboveground"))
    begin = F.lit("2024-01-12 10:20:00").cast("timestamp")
    flood = spark.range(1).select(F.col("id").alias("event_id"), F.lit("01").alias("STAID"), begin.alias("begin"), times.plus_minutes(begin, 90).alias("end"))
    return pipelines.event_forcing(forcing, flood)[1]


# ---- catchments, gauges, crosswalks


@query("WITH f AS (SELECT p_brand AS divide_id, arg_min(p_type, p_partkey) AS vpuid FROM part GROUP BY 1), d AS (SELECT DISTINCT p_brand AS divide_id, CASE WHEN right(p_brand, 1) IN ('1', '2') THEN 'tnx-' || p_brand ELSE 'nex-' || p_brand END AS toid FROM part UNION SELECT 'cat-0', 'x') SELECT d.divide_id, toid, vpuid, nullif(regexp_extract(toid, '^([a-z]+)-', 1), '') AS nexus_type, coalesce(regexp_extract(toid, '^([a-z]+)-', 1) IN ('tnx', 'cnx', 'inx'), false) AS is_terminal FROM d LEFT JOIN f ON f.divide_id = d.divide_id")
def dm18_catchment_master(spark, d):
    p = table(spark, d, "part")
    network = p.select(F.col("p_brand").alias("divide_id"), F.col("p_type").alias("vpuid"), F.col("p_partkey").alias("ord"))
    terminal = F.right("p_brand", F.lit(1)).isin("1", "2")
    divides = p.select(F.col("p_brand").alias("divide_id"), F.concat(F.when(terminal, "tnx-").otherwise("nex-"), "p_brand").alias("toid")).distinct().unionByName(spark.createDataFrame([("cat-0", "x")], "divide_id string, toid string"))
    return pipelines.catchment_master(network, divides)


@query("WITH d AS (SELECT 'cat-' || p_partkey AS divide_id, p_retailprice AS a FROM part), h AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN 'x-' ELSE 'wb-' END || c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'cat-' || (c_custkey + 1) ELSE 'nex-1' END AS nex, 'G' || (c_custkey // 3) AS staid, CASE WHEN c_custkey % 7 = 0 THEN 'dam' ELSE 'gages' END AS ref FROM customer), j AS (SELECT staid, id, a FROM d JOIN h ON divide_id = nex WHERE ref = 'gages' UNION SELECT staid, id, a FROM d JOIN h ON 'wb' || substr(divide_id, 4) = id WHERE ref = 'gages'), k AS (SELECT staid, CAST(substr(id, 4) AS BIGINT) AS divide_id, a FROM j WHERE id LIKE 'wb-%' AND CAST(substr(id, 4) AS BIGINT) IN (SELECT p_partkey FROM part)), n AS (SELECT *, row_number() OVER (PARTITION BY staid ORDER BY a DESC, divide_id) AS k FROM k) SELECT staid AS STAID, divide_id, a AS DRAIN_SQKM FROM n WHERE k = 1")
def dm17_gauges_in_region(spark, d):
    k, p = F.col("c_custkey"), table(spark, d, "part")
    divides = p.select(F.concat(F.lit("cat-"), F.col("p_partkey").cast("string")).alias("divide_id"), F.col("p_retailprice").alias("tot_drainage_areasqkm"))
    text = k.cast("string")
    locations = table(spark, d, "customer").select(
        F.concat(F.when(k % 5 == 0, "x-").otherwise("wb-"), text).alias("id"), F.when(k % 2 == 0, F.concat(F.lit("cat-"), (k + 1).cast("string"))).otherwise("nex-1").alias("nex_id"),
        F.concat(F.lit("G"), F.floor(k / 3).cast("string")).alias("hl_link"), F.when(k % 7 == 0, "dam").otherwise("gages").alias("hl_reference"),
    )
    return graph.gauges_in_region(divides, locations, p.select(F.concat(F.lit("wb-"), F.col("p_partkey").cast("string")).alias("node")))


@query(f"WITH {_INSIDE.replace(', i AS', ', unused AS')} SELECT CAST(row * 600 + col AS BIGINT) AS cell_id, min(id) AS divide_id FROM b JOIN g ON lon > xmin AND lat > ymin AND (lon - xmin) / CAST(0.0713 AS DOUBLE) + (lat - ymin) / CAST(0.0511 AS DOUBLE) < 1 GROUP BY 1")
def dm19_center_crosswalk(spark, d):
    return spatial.center_crosswalk(_cells(spark, d), _triangles(spark, d), 0.1)


@query(f"WITH {_BOX} SELECT count(*) AS n, round(min(xmin), 6) AS xmin, round(min(ymin), 6) AS ymin, round(max(xmin + 0.0713), 6) AS xmax, round(max(ymin + 0.0511), 6) AS ymax FROM b")
def ag22_total_bounds(spark, d):
    own = _triangles(spark, d).withColumn("all", F.lit(1))
    n = own.groupBy("all").agg(F.count("*").alias("n"))
    return spatial.total_bounds(own, "all").join(n, "all").select("n", *(r(c).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")))


@query("WITH p AS (SELECT p_partkey, -130 + (p_partkey % 700) * CAST(0.0173 AS DOUBLE) AS lon, 42 - (p_partkey % 400) * CAST(0.0171 AS DOUBLE) AS lat FROM part), c AS (SELECT p_partkey, CAST(floor((42 - lat) / CAST(0.02 AS DOUBLE)) AS BIGINT) AS row, CAST(floor((lon + 130) / CAST(0.02 AS DOUBLE)) AS BIGINT) AS col FROM p) SELECT p_partkey, CASE WHEN row BETWEEN 0 AND 299 AND col BETWEEN 0 AND 599 THEN row * 600 + col END AS cell_id FROM c")
def jn20_nearest_cell(spark, d):
    k = F.col("p_partkey")
    row, col = _COARSE.nearest((k % 700) * 0.0173 - 130.0, F.lit(42.0) - (k % 400) * 0.0171)
    return table(spark, d, "part").select("p_partkey", _COARSE.cell(row, col).alias("cell_id"))


@query("SELECT s_suppkey AS divide_id, l_partkey AS cell_id, n FROM (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2) JOIN supplier ON s_suppkey = l_suppkey WHERE s_suppkey IN (SELECT o_custkey FROM orders)")
def dm27_index_subset(spark, d):
    index = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("divide_id"), F.col("l_partkey").alias("cell_id")).agg(F.count("*").alias("n"))
    wanted = table(spark, d, "orders").select(F.col("o_custkey").alias("divide_id"))
    return relational.subset(index, wanted, "divide_id")[0]


# ---- catalogs and plans


@query(f"WITH {FL}, g AS (SELECT event_id, gauge, b, CASE WHEN event_id % 4 = 0 THEN 'bad' ELSE CAST(event_id * 2 AS VARCHAR) END AS x FROM fl) SELECT event_id, gauge, TRY_CAST(x AS DOUBLE) AS x FROM g WHERE TRY_CAST(x AS DOUBLE) IS NOT NULL")
def dm29_standardised(spark, d):
    own = floods(spark, d).withColumn("x", F.when(F.col("event_id") % 4 == 0, "bad").otherwise((F.col("event_id") * 2).cast("string")))
    return own.select("event_id", "gauge", ids.number_or_null(F.col("x")).alias("x")).na.drop(subset=["event_id", "x"])


@query(f"WITH {FL} SELECT gauge, arg_min(event_id, event_id) AS event_id, arg_min(tag, event_id) AS tag FROM fl GROUP BY 1")
def dm30_point_dimension(spark, d):
    return relational.first_by(floods(spark, d).select("gauge", "event_id", "tag", F.col("event_id").alias("ord")), ["gauge"], "ord").drop("ord")


@query("WITH q AS (SELECT o_custkey AS event_id, count(*) FILTER (WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 0) AS n_good FROM orders GROUP BY 1) SELECT event_id, n_good FROM q ORDER BY n_good DESC, event_id LIMIT 1")
def dm31_best_event(spark, d):
    own = table(spark, d, "orders").select(F.col("o_custkey").alias("event_id"), F.when(F.col("o_orderstatus") == "F", "downloaded").when(F.col("o_orderstatus") == "O", "exists").otherwise("failed").alias("status"), F.col("o_totalprice").alias("size_bytes"))
    return events.best_event(own, "event_id").select("event_id", "n_good").orderBy(F.desc("n_good"), "event_id").limit(1)


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 0")
def fl06_usable(spark, d):
    own = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "downloaded").when(F.col("o_orderstatus") == "O", "exists").otherwise("failed").alias("status"), F.col("o_totalprice").alias("size_bytes"))
    return events.usable(own).select("o_orderkey")


@query(f"WITH {FL}, w AS (SELECT event_id, gauge, b - INTERVAL 60 HOUR AS a, e + INTERVAL 60 HOUR AS z FROM fl), n AS (SELECT c_custkey AS gauge, c_mktsegment AS cluster_id FROM customer) SELECT event_id, 'gage-' || w.gauge AS tag, strftime(a, '%Y-%m-%d') AS first, strftime(z, '%Y-%m-%d') AS last, cluster_id FROM w LEFT JOIN n ON n.gauge = w.gauge")
def dm38_tags(spark, d):
    own = events.buffered(floods(spark, d), "b", "e", 3600, 3600)
    names = table(spark, d, "customer").select(F.col("c_custkey").alias("gauge"), F.col("c_mktsegment").alias("cluster_id"))
    return events.tags(own.drop("tag"), names, "gauge", "gauge").select("event_id", "tag", "first", "last", "cluster_id")


@query("SELECT event_id, 'archive/' || strftime(ts, '%Y/%m/%d') || '/rate_' || strftime(ts, '%Y%m%d-%H%M%S') || '.bin.gz' AS path FROM events")
def sc22_archive_paths(spark, d):
    return events.archive_paths(observations(spark, d), "archive").select("event_id", "path")


@query("WITH f AS (SELECT c_custkey, c_nationkey FROM customer), n AS (SELECT n_nationkey, arg_min(n_name, n_nationkey) AS nexus, arg_min(n_regionkey, n_nationkey) AS toid FROM nation GROUP BY 1) SELECT c_custkey, nexus, r_name AS downstream FROM f LEFT JOIN n ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = toid")
def dm37_attributes(spark, d):
    own = relational.looked_up(table(spark, d, "customer"), "c_nationkey", table(spark, d, "nation").withColumn("o", F.col("n_nationkey")), "n_nationkey", "n_name", "o", "nexus")
    own = relational.looked_up(own, "c_nationkey", table(spark, d, "nation").withColumn("o", F.col("n_nationkey")), "n_nationkey", "n_regionkey", "o", "toid")
    return relational.looked_up(own, "toid", table(spark, d, "region").withColumn("o", F.col("r_regionkey")), "r_regionkey", "r_name", "o", "downstream").select("c_custkey", "nexus", "downstream")


# ---- remaining grouping, window and set operators


@query("SELECT event_type, value, round(value / sum(value) OVER (PARTITION BY event_type), 10) AS share FROM events")
def wn02_group_share(spark, d):
    own = table(spark, d, "events").select("event_type", "value")
    totals = own.groupBy("event_type").agg(F.sum("value").alias("t"))
    return own.join(totals, "event_type").select("event_type", "value", r(F.col("value") / F.col("t"), 10).alias("share"))


@query("SELECT o_custkey, o_orderkey, k AS place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k <= 3")
def wn03_descending_rank(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, d, "orders").withColumn("place", F.row_number().over(w).cast("long")).where("place <= 3").select("o_custkey", "o_orderkey", "place")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k = 1")
def wn07_first_sorted(spark, d):
    own = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return relational.one_by(own, ["o_custkey"], F.asc("o_orderdate"), F.asc("o_orderkey")).drop("o_orderdate")


@query(f"WITH {EV}, b AS (SELECT event_type, hr, count(v) AS m FROM ev GROUP BY 1, 2) SELECT event_type, {stamp('hr')} AS bin, m > 0 AS has_value FROM b")
def wn15_bin_has_value(spark, d):
    return hourly(spark, d, "event_type", F.count("v")).select("event_type", times.text(F.col("bin")).alias("bin"), (F.col("m") > 0).alias("has_value"))


@query(f"WITH {EV}, b AS (SELECT event_type, hr, avg(v) AS m FROM ev GROUP BY 1, 2), s AS (SELECT event_type, min(hr) AS a, max(hr) AS z FROM b GROUP BY 1), g AS (SELECT event_type, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS hr FROM s), n AS (SELECT g.event_type, b.m FROM g LEFT JOIN b ON b.event_type = g.event_type AND b.hr = g.hr) SELECT event_type, count(*) AS bins, count(m) AS filled FROM n GROUP BY 1")
def wn16_densify(spark, d):
    return dense_hours(spark, d, "event_type", F.avg("v")).groupBy("event_type").agg(F.count("*").alias("bins"), F.count("m").alias("filled"))


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(DISTINCT event_type) AS n FROM events GROUP BY 1 HAVING count(DISTINCT event_type) >= 2")
def ag07_collect_set(spark, d):
    got = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("s"))
    return got.where(F.size("s") >= 2).select("user_id", F.array_join("s", ",").alias("types"), F.size("s").cast("long").alias("n"))


@query("SELECT s_nationkey, max(CASE WHEN k = 0 THEN s_acctbal END) AS even, max(CASE WHEN k = 1 THEN s_acctbal END) AS odd FROM (SELECT s_nationkey, s_suppkey % 2 AS k, max(s_acctbal) AS s_acctbal FROM supplier GROUP BY 1, 2) GROUP BY 1")
def ag17_pivot_first(spark, d):
    own = table(spark, d, "supplier").groupBy("s_nationkey", (F.col("s_suppkey") % 2).alias("k")).agg(F.max("s_acctbal").alias("x"))
    return own.groupBy("s_nationkey").pivot("k", [0, 1]).agg(F.first("x")).withColumnsRenamed({"0": "even", "1": "odd"})


@query("SELECT count(*) AS all_rows, count(DISTINCT l_orderkey) AS distinct_rows, round(1 - count(DISTINCT l_orderkey) / CAST(count(*) AS DOUBLE), 8) AS saved FROM lineitem")
def ag32_saving(spark, d):
    got = table(spark, d, "lineitem").agg(F.count("*").alias("all_rows"), F.countDistinct("l_orderkey").alias("distinct_rows"))
    return got.withColumn("saved", r(1 - F.try_divide(F.col("distinct_rows").cast("double"), F.col("all_rows")), 8))


@query("WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT l_suppkey AS k, count(*) AS n FROM lineitem GROUP BY 1) SELECT a.k, least(a.n, b.n) AS steps FROM a JOIN b ON a.k = b.k")
def ag34_least_steps(spark, d):
    a = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("a"))
    b = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("b"))
    return a.join(b, "k").select("k", F.least("a", "b").alias("steps"))


@query("SELECT l_suppkey, arg_min(l_partkey, (l_shipdate, l_partkey)) AS first_part FROM lineitem GROUP BY 1")
def st06_distinct_on_key(spark, d):
    own = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate")
    return relational.one_by(own, ["l_suppkey"], F.asc("l_shipdate"), F.asc("l_partkey")).select("l_suppkey", F.col("l_partkey").alias("first_part"))


@query("SELECT DISTINCT c_nationkey, dense_rank() OVER (ORDER BY c_nationkey DESC) AS place FROM customer")
def sl05_sorted_ids(spark, d):
    got = table(spark, d, "customer").select("c_nationkey").distinct()
    return got.withColumn("place", F.row_number().over(Window.orderBy(F.desc("c_nationkey"))).cast("long"))


@query(f"WITH RECURSIVE {_TREE}, c(node) AS (SELECT CAST(5 AS BIGINT) UNION SELECT e.up FROM c JOIN e ON e.down = c.node) SELECT up, down FROM e WHERE up IN (SELECT node FROM c) AND down IN (SELECT node FROM c)")
def gr09_upstream_network(spark, d):
    seed = spark.range(5, 6).select(F.col("id").alias("node"))
    return graph.upstream_network(_tree(spark, d), seed)[1]


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'nex-' ELSE 'wb-' END || c_custkey AS terminal, c_custkey % 2 <> 0 AS clean, c_custkey AS number FROM customer")
def gr07_clean_terminal(spark, d):
    k = F.col("c_custkey")
    name = F.concat(F.when(k % 2 == 0, "nex-").otherwise("wb-"), k.cast("string"))
    return table(spark, d, "customer").select("c_custkey", name.alias("terminal"), graph.clean_terminal(name).alias("clean"), ids.number_after_dash(name).alias("number"))


@query(f"WITH {EV} SELECT user_id, {stamp('min(ts)')} AS first, year(min(ts)) AS y, hour(min(ts)) AS h, minute(min(ts)) AS m, {stamp('min(ts) + to_microseconds((epoch_us(max(ts)) - epoch_us(min(ts))) // 2)')} AS middle, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types FROM ev GROUP BY 1")
def fs13_parts(spark, d):
    got = observations(spark, d).groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("z"), F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"))
    return got.select("user_id", times.text(F.col("a")).alias("first"), *(f("a").cast("long").alias(n) for n, f in (("y", F.year), ("h", F.hour), ("m", F.minute))), times.text(times.midpoint(F.col("a"), F.col("z"))).alias("middle"), "types")


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M') || ':00' ELSE NULL END AS parsed FROM events")
def fs16_parse_formats(spark, d):
    k, ts = F.col("event_id") % 3, F.col("ts")
    given = F.when(k == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).when(k == 1, F.date_format(ts, "dd/MM/yyyy HH:mm")).otherwise("soon")
    return observations(spark, d).select("event_id", times.text(ids.time_or_null(given, "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm")).alias("parsed"))


@query("WITH w AS (SELECT event_id, ts AS c FROM events), r AS (SELECT event_id, time_bucket(INTERVAL 15 MINUTE, c + INTERVAL 450 SECOND) AS c FROM w) SELECT event_id, CAST(480 AS BIGINT) AS n, strftime(c - INTERVAL 3600 MINUTE, '%Y-%m-%d %H:%M:%S') AS first, strftime(c + INTERVAL 3585 MINUTE, '%Y-%m-%d %H:%M:%S') AS last FROM r")
def fs25_centred_window(spark, d):
    n, a, b = times.centred_window(F.col("ts"), F.lit(7200), 15)
    return observations(spark, d).select("event_id", n.alias("n"), times.text(a).alias("first"), times.text(b).alias("last"))


@query("SELECT p_partkey, k, p_size / CAST(4 AS DOUBLE) AS part FROM (SELECT *, unnest([0, 1, 2, 3]) AS k FROM part)")
def fs33_repeat(spark, d):
    return table(spark, d, "part").select("p_partkey", F.posexplode(F.array_repeat(F.col("p_size") / 4.0, 4)).alias("k", "part"))


@query("SELECT c_custkey, round(abs(c_acctbal), 4) AS a, round(sqrt(abs(c_acctbal)), 6) AS s, round(ln(abs(c_acctbal) + 1), 6) AS l, floor(c_acctbal) AS f, ceil(c_acctbal) AS c, round(sin(c_acctbal), 6) AS sn FROM customer")
def fs26_math(spark, d):
    x = F.col("c_acctbal")
    return table(spark, d, "customer").select("c_custkey", r(F.abs(x), 4).alias("a"), r(F.sqrt(F.abs(x))).alias("s"), r(F.log(F.abs(x) + 1)).alias("l"), F.floor(x).cast("double").alias("f"), F.ceil(x).cast("double").alias("c"), r(F.sin(x)).alias("sn"))


@query("WITH b AS (SELECT event_type, date_trunc('hour', ts) AS hr, avg(value) AS x FROM events GROUP BY 1, 2), d AS (SELECT event_type, hr, x, lag(x) OVER w AS q, lag(hr) OVER w AS t FROM b WINDOW w AS (PARTITION BY event_type ORDER BY hr)) SELECT event_type, round(sum((x + q) / 2 * ((epoch_us(hr) - epoch_us(t)) / CAST(1000000 AS DOUBLE))) / CAST(43560 AS DOUBLE), 4) AS volume_acreft FROM d GROUP BY 1")
def dm15_runoff_volume(spark, d):
    got = hydro.event_metrics(hourly(spark, d, "event_type", F.avg("value")), ["event_type"], "m", "bin")
    return got.select("event_type", r("volume_acreft", 4).alias("volume_acreft"))


@query(f"WITH {XW} SELECT divide_id, round(sum(fraction), 4) AS total FROM xw WHERE fraction > 0.01 GROUP BY 1")
def fl19_tiny_overlap(spark, d):
    return crosswalk(spark, d).where(F.col("fraction") > 0.01).groupBy("divide_id").agg(r(F.sum("fraction"), 4).alias("total"))


@query("SELECT p_partkey, round(-130 + (p_partkey % 100 + CAST(0.5 AS DOUBLE)) * CAST(0.01 AS DOUBLE), 6) AS lon, round(55 - (p_partkey // 100 + CAST(0.5 AS DOUBLE)) * CAST(0.01 AS DOUBLE), 6) AS lat FROM part")
def sp05_cell_centres(spark, d):
    g = grid.Grid(3500, 100, -130.0, 55.0, 0.01)
    return table(spark, d, "part").select("p_partkey", r(g.lon(g.column(F.col("p_partkey")))).alias("lon"), r(g.lat(g.row(F.col("p_partkey")))).alias("lat"))


@query("WITH c AS (SELECT unnest(range(0, 180000)) AS k) SELECT count(*) AS n, round(sum(-130 + (k % 600 + CAST(0.5 AS DOUBLE)) * CAST(0.02 AS DOUBLE)), 2) AS lon, round(sum(42 - (k // 600 + CAST(0.5 AS DOUBLE)) * CAST(0.02 AS DOUBLE)), 2) AS lat FROM c")
def sc23_grid_table(spark, d):
    return _COARSE.table(spark).agg(F.count("*").alias("n"), r(F.sum("lon"), 2).alias("lon"), r(F.sum("lat"), 2).alias("lat"))


@query(f"WITH {EV}, b AS (SELECT user_id, hr, avg(v) AS m FROM ev GROUP BY 1, 2), l AS (SELECT *, lag(m) OVER (PARTITION BY user_id ORDER BY hr) AS q FROM b) SELECT user_id, count(*) AS n, round(sum(abs(m - q)), 4) AS change FROM l GROUP BY 1")
def ag25_change(spark, d):
    got = timeseries.differenced(hourly(spark, d, "user_id", F.avg("v")), ["user_id"], "m", "x")
    return got.groupBy("user_id").agg(F.count("*").alias("n"), r(F.sum(F.abs("x")), 4).alias("change"))
