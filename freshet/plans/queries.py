"""The operators as queries over the star-schema tables, each beside its DuckDB SQL.

Stand-ins: ``events`` are observations of gauges (users) or stations (event types), with every seventh value missing; ``orders`` are flood
events that last one to five days; ``lineitem`` pairs of supplier and part are catchments and cells with an overlap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.functions import ids, physics, times
from freshet.operators import cubes, events, graph, grid, hydro, relational, spatial, timeseries, weights

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

EV = "ev AS (SELECT *, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS v, date_trunc('hour', ts) AS hr FROM events)"
FL = "fl AS (SELECT o_orderkey AS event_id, o_custkey AS gauge, o_orderdate AS b, o_orderdate + to_days(CAST(o_orderkey % 5 + 1 AS INTEGER)) AS e, o_orderpriority AS tag FROM orders)"
XW = "xw AS (SELECT l_suppkey AS divide_id, l_partkey AS cell_id, max(l_discount) * 10 AS fraction FROM lineitem GROUP BY 1, 2)"
DENSE = "s AS (SELECT {k}, min(hr) AS a, max(hr) AS z FROM b GROUP BY 1), g AS (SELECT {k}, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS hr FROM s), d AS (SELECT g.{k}, g.hr, b.m FROM g LEFT JOIN b ON b.{k} = g.{k} AND b.hr = g.hr)"


def stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return own.withColumn("v", F.when(F.col("event_id") % 7 != 0, F.col("value"))).withColumn("hr", F.date_trunc("hour", "ts"))


def floods(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "orders").withColumn("b", F.col("o_orderdate").cast("timestamp"))
    return own.select(F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("gauge"), "b", times.plus_minutes(F.col("b"), (F.col("o_orderkey") % 5 + 1) * 1440).alias("e"), F.col("o_orderpriority").alias("tag"))


def crosswalk(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("divide_id"), F.col("l_partkey").alias("cell_id")).agg((F.max("l_discount") * 10).alias("fraction"))


def hourly(spark: SparkSession, d: str, key: str, aggregate: Column) -> DataFrame:
    return timeseries.binned(observations(spark, d), [key], 60, aggregate.alias("m"))


def dense_hours(spark: SparkSession, d: str, key: str, aggregate: Column) -> DataFrame:
    return timeseries.densified(hourly(spark, d, key, aggregate), [key], 60)


def r(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# ---- time series


@query(f"WITH {EV} SELECT event_type, {stamp('bin')} AS bin, round(avg(v) * CAST(0.25 AS DOUBLE), 6) AS depth, count(v) AS n FROM (SELECT *, time_bucket(INTERVAL '15 minutes', ts) AS bin FROM ev) GROUP BY event_type, bin")
def wn14_bin_mean_15min(spark, d):
    got = timeseries.binned(observations(spark, d), ["event_type"], 15, r(physics.depth(F.avg("v"), 15)).alias("depth"), F.count("v").alias("n"))
    return got.withColumn("bin", times.text(F.col("bin")))


@query(f"WITH {EV}, b AS (SELECT event_type, hr, max(v) AS m FROM ev GROUP BY 1, 2), {DENSE.format(k='event_type')} SELECT event_type, {stamp('hr')} AS bin, m AS max_value FROM d")
def wn13_bin_max_dense(spark, d):
    return dense_hours(spark, d, "event_type", F.max("v")).select("event_type", times.text(F.col("bin")).alias("bin"), F.col("m").alias("max_value"))


@query(f"WITH {EV}, b AS (SELECT user_id, hr, arg_min(v, ts) FILTER (WHERE v IS NOT NULL) AS m FROM ev GROUP BY 1, 2), {DENSE.format(k='user_id')} SELECT user_id, {stamp('hr')} AS bin, last_value(m IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY hr ROWS UNBOUNDED PRECEDING) AS filled FROM d")
def wn12_bin_first_ffill(spark, d):
    got = timeseries.forward_filled(dense_hours(spark, d, "user_id", timeseries.first_in_bin("v")), ["user_id"], "m")
    return got.select("user_id", times.text(F.col("bin")).alias("bin"), F.col("m").alias("filled"))


@query(
    f"""WITH {EV}, b AS (SELECT user_id, hr, avg(v) AS m FROM ev GROUP BY 1, 2), {DENSE.format(k='user_id')},
    f AS (SELECT *, last_value(m IGNORE NULLS) OVER p AS pv, last_value(CASE WHEN m IS NOT NULL THEN epoch_us(hr) END IGNORE NULLS) OVER p AS pt,
        first_value(m IGNORE NULLS) OVER n AS nv, first_value(CASE WHEN m IS NOT NULL THEN epoch_us(hr) END IGNORE NULLS) OVER n AS nt FROM d
        WINDOW p AS (PARTITION BY user_id ORDER BY hr ROWS UNBOUNDED PRECEDING), n AS (PARTITION BY user_id ORDER BY hr ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT user_id, {stamp('hr')} AS bin, round(coalesce(m, pv + (nv - pv) * ((epoch_us(hr) - pt) / CAST(nullif(nt - pt, 0) AS DOUBLE)), pv, nv), 9) AS filled FROM f"""
)
def wn09_bidirectional_fill(spark, d):
    got = timeseries.filled_both_ways(dense_hours(spark, d, "user_id", F.avg("v")), ["user_id"], "m")
    return got.select("user_id", times.text(F.col("bin")).alias("bin"), r("m", 9).alias("filled"))


_FOUR = f"""WITH {EV}, b AS (SELECT event_type, hr, sum(value) AS p, avg(value) AS m FROM ev GROUP BY 1, 2), l AS (SELECT *, lead(m) OVER (PARTITION BY event_type ORDER BY hr) AS nxt FROM b),
    k AS (SELECT *, unnest([0, 1, 2, 3]) AS k FROM l) SELECT event_type, {stamp('hr + to_minutes(15 * k)')} AS ts, """


def _quarters(spark, d):
    own = observations(spark, d).groupBy("event_type", F.col("hr").alias("ts")).agg(F.sum("value").alias("p"), F.avg("value").alias("m"))
    return timeseries.quarter_hours(own, ["event_type"], ["p"], ["m"])


@query(_FOUR + "round(m * (1 - k / CAST(4 AS DOUBLE)) + coalesce(nxt, m) * (k / CAST(4 AS DOUBLE)), 6) AS level FROM k")
def wn10_interpolate_15min(spark, d):
    return _quarters(spark, d).select("event_type", times.text(F.col("ts")).alias("ts"), r("m").alias("level"))


@query(_FOUR + "round(p / 4, 6) AS part FROM k")
def wn11_split_15min(spark, d):
    return _quarters(spark, d).select("event_type", times.text(F.col("ts")).alias("ts"), r("p").alias("part"))


@query(f"WITH {EV}, b AS (SELECT event_type, hr, avg(value) AS m FROM ev GROUP BY 1, 2) SELECT event_type, {stamp('hr')} AS bin, round(m - lag(m) OVER (PARTITION BY event_type ORDER BY hr), 6) AS change FROM b")
def wn01_difference(spark, d):
    got = timeseries.differenced(hourly(spark, d, "event_type", F.avg("value")), ["event_type"], "m", "change")
    return got.select("event_type", times.text(F.col("bin")).alias("bin"), r("change").alias("change"))


@query(
    f"""WITH {EV}, b AS (SELECT user_id, hr, max(v) AS m FROM ev GROUP BY 1, 2), {DENSE.format(k='user_id')},
    c AS (SELECT *, m IS NULL AS miss, CASE WHEN (m IS NULL) IS DISTINCT FROM lag(m IS NULL) OVER w THEN 1 ELSE 0 END AS new FROM d WINDOW w AS (PARTITION BY user_id ORDER BY hr)),
    i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY hr ROWS UNBOUNDED PRECEDING) AS run FROM c),
    n AS (SELECT user_id, run, any_value(miss) AS miss, count(*) AS n FROM i GROUP BY 1, 2) SELECT user_id, coalesce(max(CASE WHEN miss THEN n END), 0) AS longest_gap FROM n GROUP BY 1"""
)
def wn05_longest_gap(spark, d):
    return timeseries.longest_gap(dense_hours(spark, d, "user_id", F.max("v")), ["user_id"], "m")


@query(f"WITH {EV} SELECT user_id, count(DISTINCT hr) AS bins, 721 AS expected, round(count(DISTINCT hr) / CAST(721 AS DOUBLE), 6) AS coverage FROM ev WHERE v IS NOT NULL AND ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31' GROUP BY 1")
def ag29_coverage(spark, d):
    a, b = (F.lit(x).cast("timestamp") for x in ("2024-01-01", "2024-01-31"))
    got = timeseries.coverage(observations(spark, d), ["user_id"], 60, a, b, "v")
    return got.select("user_id", "bins", F.col("expected").cast("int").alias("expected"), r("coverage").alias("coverage"))


# ---- flow statistics


@query(
    """WITH f AS (SELECT *, lag(value) OVER w AS q, lag(ts) OVER w AS t FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    a AS (SELECT user_id, min(ts) AS s, max(ts) AS e, max(value) AS peak, arg_max(ts, value) AS pt, count(*) AS n, sum(abs(value - q)) AS ch, sum(value) AS tot,
        coalesce(sum((value + q) / 2 * ((epoch_us(ts) - epoch_us(t)) / CAST(1000000 AS DOUBLE))), 0) / CAST(43560 AS DOUBLE) AS vol FROM f GROUP BY 1)
    SELECT user_id, peak, strftime(pt, '%Y-%m-%d %H:%M:%S') AS peak_time, round(vol, 4) AS volume_acreft, round(CASE WHEN tot > 0 THEN coalesce(ch, 0) / tot END, 6) AS flashiness,
        round((epoch_us(e) - epoch_us(s)) / CAST(3600000000 AS DOUBLE), 6) AS duration_hours, round((epoch_us(pt) - epoch_us(s)) / CAST(3600000000 AS DOUBLE), 6) AS time_to_peak_h FROM a"""
)
def ag24_event_metrics(spark, d):
    got = hydro.event_metrics(observations(spark, d), ["user_id"], "value", "ts")
    return got.select("user_id", "peak", times.text(F.col("peak_time")).alias("peak_time"), r("volume_acreft", 4).alias("volume_acreft"), *(r(c).alias(c) for c in ("flashiness", "duration_hours", "time_to_peak_h")))


_FDC = "f AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC) AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value > 0)"


@query(f"WITH {_FDC} SELECT event_type, value, round(k * CAST(100 AS DOUBLE) / (n + 1), 8) AS exceedance FROM f")
def ag27_fdc(spark, d):
    return hydro.duration_curve(observations(spark, d), ["event_type"], "value").select("event_type", "value", r("exceedance", 8).alias("exceedance"))


_Q25 = f"""{_FDC}, p AS (SELECT event_type, any_value(n) AS n, CAST(25 AS DOUBLE) * (any_value(n) + 1) / 100 AS pos FROM f GROUP BY 1),
    q AS (SELECT p.event_type, CASE WHEN pos <= 1 THEN max(value) WHEN pos >= p.n THEN min(value) ELSE
        max(CASE WHEN k = floor(pos) THEN value END) + (max(CASE WHEN k = floor(pos) + 1 THEN value END) - max(CASE WHEN k = floor(pos) THEN value END)) * (pos - floor(pos)) END AS thr
        FROM p JOIN f ON f.event_type = p.event_type GROUP BY p.event_type, pos, p.n)"""


@query(f"WITH {_Q25} SELECT event_type, round(thr, 6) AS threshold FROM q")
def ag28_q_exceedance(spark, d):
    return hydro.exceeded(observations(spark, d), ["event_type"], "value", 25.0).select("event_type", r("threshold").alias("threshold"))


@query(f"WITH {_Q25} SELECT e.event_type, count(*) AS n, round(sum(value), 4) AS total FROM events e JOIN q ON q.event_type = e.event_type WHERE value >= round(thr, 6) GROUP BY 1")
def fl02_above_threshold(spark, d):
    limits = hydro.exceeded(observations(spark, d), ["event_type"], "value", 25.0).withColumn("threshold", r("threshold"))
    return observations(spark, d).join(limits, "event_type").where("value >= threshold").groupBy("event_type").agg(F.count("*").alias("n"), r(F.sum("value"), 4).alias("total"))


@query("SELECT user_id, count(*) AS n, count(v) AS n_good, string_agg(DISTINCT CAST(m AS VARCHAR), ',' ORDER BY CAST(m AS VARCHAR)) AS minutes FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS v, minute(ts) // 15 AS m FROM events) GROUP BY 1")
def dm26_quality(spark, d):
    own = observations(spark, d).withColumn("q", times.floored(F.col("ts"), 15))
    got = hydro.quality(own.withColumn("q", times.plus_minutes(F.date_trunc("hour", "q"), F.floor(F.minute("q") / 15).cast("long"))), "user_id", "v", "q")
    return got


# ---- weighted aggregation


def _means(policy: str) -> Callable:
    def run(spark, d):
        cells = table(spark, d, "part").select(F.col("p_partkey").alias("cell_id"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice")).alias("v"))
        got = weights.catchment_means(cells, crosswalk(spark, d).withColumnRenamed("fraction", "weight"), ["v"], policy, keys=())
        return got.select("divide_id", r("v", 4).alias("mean"))

    return run


_CELLS = f"WITH {XW}, j AS (SELECT x.divide_id, x.fraction AS w, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END AS v FROM xw x JOIN part p ON p.p_partkey = x.cell_id) SELECT divide_id, round("
for _id, _policy, _sql in (
    ("ag09_propagate", "propagate", "CASE WHEN count(v) = count(*) THEN sum(v * w) END"),
    ("ag10_skip", "skip", "avg(v)"),
    ("ag11_renormalize", "renormalize", "sum(v * w) / nullif(sum(CASE WHEN v IS NOT NULL THEN w END), 0)"),
    ("ag12_zero", "zero", "coalesce(sum(v * w), 0)"),
):
    QUERIES[_id] = _means(_policy)
    ORACLE_SQL[_id] = f"{_CELLS}{_sql}, 4) AS mean FROM j GROUP BY 1"


@query(f"WITH {XW}, o AS (SELECT * FROM xw WHERE fraction > 0) SELECT divide_id, cell_id, round(fraction / sum(fraction) OVER (PARTITION BY divide_id), 8) AS weight FROM o")
def ag13_normalised_weight(spark, d):
    return weights.normalised(crosswalk(spark, d)).select("divide_id", "cell_id", r("weight", 8).alias("weight"))


@query(f"WITH {XW}, o AS (SELECT * FROM xw WHERE fraction > 0) SELECT divide_id, round(CAST(1 AS DOUBLE), 6) AS weight_sum, count(*) AS n_cells FROM o GROUP BY 1")
def ag14_weight_sum(spark, d):
    return weights.weight_sums(weights.normalised(crosswalk(spark, d))).select("divide_id", r("weight_sum").alias("weight_sum"), "n_cells")


_GRID = grid.Grid(3500, 100, -130.0, 55.0, 0.01)
_AT = "(-130 + ((cell_id % 100) + CAST(0.5 AS DOUBLE)) * CAST(0.01 AS DOUBLE))", "(55 - ((cell_id // 100) + CAST(0.5 AS DOUBLE)) * CAST(0.01 AS DOUBLE))"


def _placed(index: DataFrame) -> DataFrame:
    return index.withColumns({"lon": _GRID.lon(_GRID.column(F.col("cell_id"))), "lat": _GRID.lat(_GRID.row(F.col("cell_id")))})


@query(f"WITH {XW}, o AS (SELECT *, {_AT[0]} AS lon, {_AT[1]} AS lat FROM xw WHERE fraction > 0) SELECT divide_id, round(sum(fraction * lon) / sum(fraction), 6) AS lon, round(sum(fraction * lat) / sum(fraction), 6) AS lat FROM o GROUP BY 1")
def ag19_weighted_centroid(spark, d):
    got = weights.centroids(weights.normalised(_placed(crosswalk(spark, d))))
    return got.select("divide_id", r("lon").alias("lon"), r("lat").alias("lat"))


@query(f"WITH {XW} SELECT divide_id, round(avg({_AT[0]}), 6) AS lon, round(avg({_AT[1]}), 6) AS lat FROM xw GROUP BY 1")
def ag20_plain_centroid(spark, d):
    return weights.centroids(_placed(crosswalk(spark, d)), weight=None).select("divide_id", r("lon").alias("lon"), r("lat").alias("lat"))


@query(f"WITH {XW} SELECT divide_id, min(cell_id // 100) AS row_min, max(cell_id // 100) AS row_max, min(cell_id % 100) AS col_min, max(cell_id % 100) AS col_max FROM xw GROUP BY 1")
def ag21_cell_bounds(spark, d):
    own = crosswalk(spark, d).select("divide_id", _GRID.row(F.col("cell_id")).alias("row"), _GRID.column(F.col("cell_id")).alias("col"))
    return grid.bounds(own, "divide_id")


@query(f"WITH {XW} SELECT divide_id, count(*) AS n_cells, count(*) FILTER (WHERE fraction >= 0.999) AS n_whole, count(*) FILTER (WHERE fraction < 0.999) AS n_fractional, round(sum(fraction), 4) AS fraction_sum FROM xw GROUP BY 1")
def dm36_overlap_profile(spark, d):
    return weights.overlap_profile(crosswalk(spark, d)).withColumn("fraction_sum", r("fraction_sum", 4))


@query(f"WITH {XW} SELECT count(*) AS n_rows, count(DISTINCT cell_id) AS n_cells, count(DISTINCT divide_id) AS n_units, count(*) FILTER (WHERE divide_id IS NULL) AS n_null, (SELECT count(*) FROM supplier WHERE s_suppkey NOT IN (SELECT divide_id FROM xw)) AS n_uncovered, round(count(*) / CAST(count(DISTINCT divide_id) AS DOUBLE), 6) AS cells_a_unit FROM xw")
def dm35_sanity(spark, d):
    units = table(spark, d, "supplier").select(F.col("s_suppkey").alias("divide_id"))
    return weights.crosswalk_summary(crosswalk(spark, d), units).withColumn("cells_a_unit", r("cells_a_unit"))


@query(f"WITH {XW}, b AS (SELECT DISTINCT o_custkey % 50 AS event_id, l_suppkey AS divide_id FROM orders JOIN lineitem ON l_orderkey = o_orderkey) SELECT b.event_id, count(*) AS n_rows, count(DISTINCT cell_id) AS n_cells, round(sum(fraction), 4) AS total FROM b JOIN xw USING (divide_id) GROUP BY 1")
def dm28_event_weights(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("divide_id"))
    own = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("event_id"), F.col("o_orderkey").alias("l_orderkey"))
    pairs = own.join(lines, "l_orderkey").select("event_id", "divide_id").distinct()
    return pairs.join(crosswalk(spark, d), "divide_id").groupBy("event_id").agg(F.count("*").alias("n_rows"), F.countDistinct("cell_id").alias("n_cells"), r(F.sum("fraction"), 4).alias("total"))


# ---- grouping


@query("SELECT n_name, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def ag01_group_summary(spark, d):
    own = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return own.groupBy("n_name").agg(F.count("*").alias("n"), r(F.sum("c_acctbal"), 2).alias("total"))


@query("SELECT c_mktsegment, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) AS place FROM customer GROUP BY 1")
def ag02_sizes_sorted(spark, d):
    counted = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return counted.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "c_mktsegment")).cast("long"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def ag03_value_counts(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT date_trunc('day', ts)) AS days FROM events GROUP BY 1")
def ag04_distinct_counts(spark, d):
    return observations(spark, d).groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.countDistinct(times.day(F.col("ts"))).alias("days"))


@query("SELECT user_id, count(*) AS n, min(value) AS least, max(value) AS most FROM events GROUP BY 1")
def ag05_minmax(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))


@query(f"SELECT user_id, {stamp('min(ts)')} AS first, {stamp('max(ts)')} AS last, arg_min(event_type, ts) AS tag FROM events GROUP BY 1")
def ag06_span(spark, d):
    return observations(spark, d).groupBy("user_id").agg(times.text(F.min("ts")).alias("first"), times.text(F.max("ts")).alias("last"), F.min_by("event_type", "ts").alias("tag"))


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types FROM events GROUP BY 1")
def ag08_sorted_distinct(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"))


@query(f"WITH {EV}, b AS (SELECT event_type, user_id % 10 AS unit, hr, avg(v) AS x FROM ev GROUP BY 1, 2, 3) SELECT event_type, {stamp('hr')} AS ts, round(avg(x), 6) AS mean, round(max(x), 6) AS max FROM b GROUP BY event_type, hr")
def ag15_mean_max(spark, d):
    own = timeseries.binned(observations(spark, d).withColumn("unit", F.col("user_id") % 10), ["event_type", "unit"], 60, F.avg("v").alias("x"), name="ts")
    got = cubes.over_units(own, "x", "event_type")
    return got.select("event_type", times.text(F.col("ts")).alias("ts"), r("mean").alias("mean"), r("max").alias("max"))


_TYPES = ("click", "purchase", "view")


@query(f"WITH {EV} SELECT {stamp('hr')} AS ts, " + ", ".join(f"round(avg(v) FILTER (WHERE event_type = '{t}'), 6) AS {t}" for t in _TYPES) + " FROM ev GROUP BY hr")
def ag16_pivot_mean(spark, d):
    got = observations(spark, d).groupBy("hr").pivot("event_type", list(_TYPES)).agg(F.avg("v"))
    return got.select(times.text(F.col("hr")).alias("ts"), *(r(t).alias(t) for t in _TYPES))


@query("SELECT s_suppkey, 'acctbal' AS name, s_acctbal AS x FROM supplier UNION ALL SELECT s_suppkey, 'nation', CAST(s_nationkey AS DOUBLE) FROM supplier")
def ag18_unpivot(spark, d):
    own = table(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").cast("double").alias("nation"))
    return own.unpivot("s_suppkey", ["acctbal", "nation"], "name", "x")


@query("SELECT count(value) AS n, min(value) AS least, round(avg(value), 6) AS mean, max(value) AS most, round(stddev_samp(value), 6) AS sd FROM events")
def ag31_summary(spark, d):
    return table(spark, d, "events").agg(F.count("value").alias("n"), F.min("value").alias("least"), r(F.avg("value")).alias("mean"), F.max("value").alias("most"), r(F.stddev_samp("value")).alias("sd"))


@query("SELECT o_custkey AS event_id, count(*) FILTER (WHERE o_orderstatus IN ('F', 'O') AND o_totalprice > 0) AS n_good, count(*) FILTER (WHERE NOT (o_orderstatus IN ('F', 'O') AND o_totalprice > 0)) AS n_missing FROM orders GROUP BY 1")
def ag33_file_quality(spark, d):
    own = table(spark, d, "orders").select(F.col("o_custkey").alias("event_id"), F.when(F.col("o_orderstatus") == "F", "downloaded").when(F.col("o_orderstatus") == "O", "exists").otherwise("failed").alias("status"), F.col("o_totalprice").alias("size_bytes"))
    return events.best_event(own, "event_id")


# ---- joins and sets


@query("WITH f AS (SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS k, arg_min(o_orderpriority, o_orderkey) AS p FROM orders GROUP BY 1) SELECT c_custkey, k AS first_order, p AS first_priority FROM customer LEFT JOIN f ON c_custkey = o_custkey")
def jn01_left_first(spark, d):
    first = relational.first_by(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", F.col("o_orderkey").alias("ord")), ["o_custkey"], "ord")
    got = table(spark, d, "customer").join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
    return got.select("c_custkey", F.col("o_orderkey").alias("first_order"), F.col("o_orderpriority").alias("first_priority"))


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey")
def jn06_left_fanout(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey")


@query("WITH c AS (SELECT p_partkey, p_partkey // 2 AS nx FROM part), n AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey // 2 + 1 END AS pth FROM part), f AS (SELECT p_partkey AS id, p_partkey * 3 AS dv FROM part) SELECT c.p_partkey AS up, f.dv AS down FROM c JOIN n ON n.id = c.nx JOIN f ON f.id = n.pth")
def jn07_chain(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k")).withColumn("ord", F.col("k"))
    half = F.floor(F.col("k") / 2).cast("long")
    divides = p.select(F.col("k").alias("divide_id"), half.alias("toid"))
    nexus = p.select(F.col("k").alias("id"), F.when(F.col("k") % 3 != 0, half + 1).alias("toid"), "ord")
    return relational.chained(divides, nexus, p.select(F.col("k").alias("id"), (F.col("k") * 3).alias("divide_id"), "ord"))


@query("WITH l AS (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS p FROM orders GROUP BY 1) SELECT c_custkey, p AS last_priority FROM customer LEFT JOIN l ON c_custkey = o_custkey")
def jn08_map_last_wins(spark, d):
    return relational.looked_up(table(spark, d, "customer"), "c_custkey", table(spark, d, "orders"), "o_custkey", "o_orderpriority", "o_orderkey", "last_priority").select("c_custkey", "last_priority")


@query("SELECT 'both' AS side, count(*) AS n FROM orders JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = o_orderkey UNION ALL SELECT 'left', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'right', count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def jn09_inner_report(spark, d):
    a, b = table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")).distinct()
    parts = [x.agg(F.count("*").alias("n")).select(F.lit(name).alias("side"), "n") for name, x in zip(("both", "left", "right"), relational.matched(a, b, "k"), strict=True)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT DISTINCT c_custkey, s_suppkey FROM customer JOIN supplier ON c_custkey = s_suppkey OR c_nationkey * 7 = s_suppkey")
def jn12_or_to_union(spark, d):
    return relational.either_join(table(spark, d, "customer"), table(spark, d, "supplier"), F.col("c_custkey") == F.col("s_suppkey"), F.col("c_nationkey") * 7 == F.col("s_suppkey"), [F.col("c_custkey"), F.col("s_suppkey")])


@query("SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT o_custkey * 2 FROM orders)")
def jn22_index_subset(spark, d):
    wanted = table(spark, d, "orders").select((F.col("o_custkey") * 2).alias("p_partkey"))
    return relational.subset(table(spark, d, "part").select("p_partkey", "p_brand"), wanted, "p_partkey")[0]


@query("SELECT DISTINCT o_custkey * 2 AS p_partkey FROM orders WHERE o_custkey * 2 NOT IN (SELECT p_partkey FROM part)")
def fl07_missing_keys(spark, d):
    wanted = table(spark, d, "orders").select((F.col("o_custkey") * 2).alias("p_partkey"))
    return relational.subset(table(spark, d, "part"), wanted, "p_partkey")[1]


@query("SELECT c_custkey AS k FROM customer UNION ALL SELECT s_suppkey FROM supplier")
def st01_union_all(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k")).unionByName(table(spark, d, "supplier").select(F.col("s_suppkey").alias("k")))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def st02_union(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, d, "supplier").select("s_nationkey")).distinct()


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT p_partkey FROM part")
def st03_intersect(spark, d):
    return relational.shared_keys(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "part").select(F.col("p_partkey").alias("k")), "k")


@query("SELECT p_partkey AS k FROM part EXCEPT SELECT c_custkey FROM customer")
def st04_except(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("k")).subtract(table(spark, d, "customer").select(F.col("c_custkey").alias("k")))


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def st05_distinct(spark, d):
    return table(spark, d, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query(f"WITH {EV}, b AS (SELECT DISTINCT hr, user_id FROM ev) SELECT {stamp('hr')} AS ts, bool_or(user_id % 2 = 0) OR bool_or(user_id % 3 = 0) AS available FROM b GROUP BY hr")
def st08_available(spark, d):
    hours = observations(spark, d).select("hr", "user_id")
    flags = hours.groupBy("hr").agg((F.bool_or(F.col("user_id") % 2 == 0) | F.bool_or(F.col("user_id") % 3 == 0)).alias("available"))
    return flags.select(times.text(F.col("hr")).alias("ts"), "available")


@query("WITH l AS (SELECT l_orderkey, max(l_shipdate) AS done FROM lineitem GROUP BY 1) SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM l)")
def sk08_resume(spark, d):
    done = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return relational.pending(table(spark, d, "orders").select("o_orderkey"), done, ["o_orderkey"])


# ---- event windows


_WIN = f"""{FL}, c AS (SELECT *, b + to_microseconds((epoch_us(e) - epoch_us(b)) // 2) AS c FROM fl), w AS (SELECT *, date_trunc('hour', c - INTERVAL 3600 MINUTE) AS start, date_trunc('hour', c + INTERVAL 3600 MINUTE) + INTERVAL 1 HOUR AS stop FROM c)"""


@query(f"WITH {_WIN} SELECT event_id, {stamp('start')} AS start, {stamp('stop')} AS stop, {stamp('start - INTERVAL 30 DAY')} AS warm_start, least((epoch_us(c + INTERVAL 3600 MINUTE) - epoch_us(start)) // 900000000, 480) AS n_steps FROM w")
def dm04_event_windows(spark, d):
    got = events.event_windows(floods(spark, d), "b", "e")
    return got.select("event_id", *(times.text(F.col(c)).alias(c) for c in ("start", "stop", "warm_start")), "n_steps")


@query(f"WITH {_WIN} SELECT min(event_id) AS event_id, gauge FROM w GROUP BY gauge, date_trunc('hour', c)")
def dm05_event_dedup(spark, d):
    return events.deduplicated(events.event_windows(floods(spark, d), "b", "e"), "gauge").select("event_id", "gauge")


@query(f"WITH {_WIN} SELECT event_id, {stamp('c')} AS midpoint, {stamp('c - INTERVAL 3600 MINUTE')} AS win_start, {stamp('c + INTERVAL 3600 MINUTE')} AS win_end FROM c")
def dm21_manifest_windows(spark, d):
    got = events.manifest(floods(spark, d), "event_id", "b", "e")
    return got.select("event_id", *(times.text(F.col(c)).alias(c) for c in ("midpoint", "win_start", "win_end")))


@query(f"WITH w AS (SELECT ts - INTERVAL 3 HOUR AS a, ts + INTERVAL 3 HOUR AS z FROM events), g AS (SELECT unnest(generate_series(time_bucket(INTERVAL 60 MINUTE, a), CASE WHEN time_bucket(INTERVAL 60 MINUTE, z) = z THEN z ELSE time_bucket(INTERVAL 60 MINUTE, z) + INTERVAL 60 MINUTE END, INTERVAL 60 MINUTE)) AS ts FROM w) SELECT DISTINCT {stamp('ts')} AS ts FROM g")
def dm22_union_stamps(spark, d):
    own = observations(spark, d).select(times.plus_minutes(F.col("ts"), -180).alias("a"), times.plus_minutes(F.col("ts"), 180).alias("z"))
    return events.stamps(own, "a", "z", 60).select(times.text(F.col("ts")).alias("ts"))


@query(f"WITH {FL}, w AS (SELECT event_id, time_bucket(INTERVAL 2 MINUTE, b - INTERVAL 168 HOUR) AS a, e + INTERVAL 24 HOUR AS z FROM fl) SELECT event_id, {stamp('a')} AS win_start, {stamp('CASE WHEN time_bucket(INTERVAL 2 MINUTE, z) = z THEN z ELSE time_bucket(INTERVAL 2 MINUTE, z) + INTERVAL 2 MINUTE END')} AS win_end FROM w")
def dm23_buffer_windows(spark, d):
    got = events.buffered(floods(spark, d), "b", "e", 168 * 60, 24 * 60)
    return got.select("event_id", *(times.text(F.col(c)).alias(c) for c in ("win_start", "win_end")))


@query(f"WITH {FL} SELECT gauge, strftime(CAST(min(b) AS DATE) - INTERVAL 1 MONTH, '%Y-%m-%d') AS first_day, strftime(CAST(max(e) AS DATE) + INTERVAL 1 MONTH, '%Y-%m-%d') AS last_day, arg_min(tag, (b, tag)) AS tag FROM fl GROUP BY 1")
def dm24_span(spark, d):
    got = events.spans(floods(spark, d), "gauge", "b", "e", "tag")
    return got.select("gauge", *(F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("first_day", "last_day")), "tag")


_SHORT = "w AS (SELECT event_id, user_id, ts AS c, ts - INTERVAL 60 HOUR AS a, ts + INTERVAL 60 HOUR AS z FROM events WHERE event_type = 'purchase')"


def _windows(spark, d):
    own = observations(spark, d).where("event_type = 'purchase'")
    return own.select("event_id", "user_id", times.plus_minutes(F.col("ts"), -3600).alias("a"), times.plus_minutes(F.col("ts"), 3600).alias("z"))


@query(f"WITH {_SHORT} SELECT w.event_id, count(*) AS n, round(sum(o.value), 4) AS total FROM w JOIN events o ON o.user_id = w.user_id AND o.ts BETWEEN a AND z GROUP BY 1")
def jn14_event_window(spark, d):
    obs = observations(spark, d).select("user_id", "ts", "value")
    return events.range_join(_windows(spark, d), obs, "a", "z", "ts", on=("user_id",)).groupBy("event_id").agg(F.count("*").alias("n"), r(F.sum("value"), 4).alias("total"))


@query(f"WITH {_SHORT}, m AS (SELECT w.event_id, o.value, o.ts, row_number() OVER (PARTITION BY w.event_id ORDER BY o.value DESC, o.ts) AS k FROM w JOIN events o ON o.user_id = w.user_id AND o.ts BETWEEN a AND z) SELECT event_id, value AS peak, {stamp('ts')} AS peak_time FROM m WHERE k = 1")
def jn15_window_peak(spark, d):
    obs = observations(spark, d).select("user_id", "ts", "value")
    got = events.peaks(events.range_join(_windows(spark, d), obs, "a", "z", "ts", on=("user_id",)), "event_id", "value", "ts")
    return got.select("event_id", "peak", times.text(F.col("peak_time")).alias("peak_time"))


_DAYS = f"{EV}, wd AS (SELECT DISTINCT date_trunc('day', ts) AS day FROM events), f AS (SELECT event_type AS gauge_id, hr AS ts, avg(value) AS q FROM ev GROUP BY 1, 2), g AS (SELECT epoch_us(day) // 86400000000 AS event_id, unnest(range(0, 24)) AS step, day FROM wd)"


@query(f"WITH {_DAYS} SELECT g.event_id, CAST(g.step AS BIGINT) AS step, k.gauge_id, round(f.q, 6) AS streamflow FROM g CROSS JOIN (SELECT DISTINCT gauge_id FROM f) k LEFT JOIN f ON f.gauge_id = k.gauge_id AND f.ts = g.day + to_hours(CAST(g.step AS INTEGER))")
def dm11_flow_grid(spark, d):
    own = observations(spark, d)
    win = own.select(times.day(F.col("ts")).alias("event_id"), F.date_trunc("day", "ts").alias("ts_start")).distinct().withColumn("ts_end", times.plus_minutes(F.col("ts_start"), 23 * 60))
    flows = own.select(F.col("hr").alias("ts"), F.col("event_type").alias("gauge_id"), F.col("value").alias("discharge"))
    return cubes.flow_grid(win, flows).select("event_id", "step", "gauge_id", r("streamflow").alias("streamflow"))


def _two_cubes(spark, d):
    own = observations(spark, d).select(times.day(F.col("ts")).alias("event_id"), F.col("hr").alias("ts"), F.col("event_type").alias("divide_id"), "v", "value")
    a = cubes.numbered_steps(own.groupBy("event_id", "ts", "divide_id").agg(F.avg("value").alias("p")), minutes=60)
    b = cubes.numbered_steps(own.where("v IS NOT NULL").groupBy("event_id", "ts", "divide_id").agg(F.max("value").alias("t")), minutes=60)
    return a, b


_CUBES = f"""{EV}, a0 AS (SELECT epoch_us(hr) // 86400000000 AS event_id, hr AS ts, event_type AS divide_id, avg(value) AS p FROM ev GROUP BY 1, 2, 3),
    b0 AS (SELECT epoch_us(hr) // 86400000000 AS event_id, hr AS ts, event_type AS divide_id, max(value) AS t FROM ev WHERE v IS NOT NULL GROUP BY 1, 2, 3),
    a AS (SELECT *, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY event_id)) // 3600000000 AS step FROM a0), b AS (SELECT *, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY event_id)) // 3600000000 AS step FROM b0)"""


@query(f"WITH {_CUBES} SELECT a.event_id, a.step, a.divide_id, round(p, 6) AS p, t FROM a JOIN b ON a.event_id = b.event_id AND a.ts = b.ts AND a.divide_id = b.divide_id")
def dm10_merge_by_time(spark, d):
    return cubes.merged(*_two_cubes(spark, d), ["p"], ["t"]).select("event_id", "step", "divide_id", r("p").alias("p"), "t")


@query(f"WITH {_CUBES}, n AS (SELECT event_id, least((SELECT max(step) FROM a x WHERE x.event_id = a.event_id), (SELECT max(step) FROM b y WHERE y.event_id = a.event_id)) AS e FROM a GROUP BY 1) SELECT a.event_id, a.step, a.divide_id, round(p, 6) AS p, t FROM a JOIN b ON a.event_id = b.event_id AND a.step = b.step AND a.divide_id = b.divide_id JOIN n ON n.event_id = a.event_id WHERE a.step <= e")
def dm10_merge_by_step(spark, d):
    return cubes.merged(*_two_cubes(spark, d), ["p"], ["t"], align="step").select("event_id", "step", "divide_id", r("p").alias("p"), "t")


# ---- graphs


_TREE = "e AS (SELECT p_partkey AS up, p_partkey // 2 AS down FROM part WHERE p_partkey > 0)"


def _tree(spark, d):
    own = table(spark, d, "part").where("p_partkey > 0")
    return own.select(F.col("p_partkey").alias("up"), F.floor(F.col("p_partkey") / 2).cast("long").alias("down"))


def _seeds(spark, d):
    return table(spark, d, "nation").select((F.col("n_nationkey").cast("long") + 1).alias("node"))


@query(f"WITH RECURSIVE {_TREE}, c(node) AS (SELECT CAST(n_nationkey AS BIGINT) + 1 FROM nation UNION SELECT e.up FROM c JOIN e ON e.down = c.node) SELECT node FROM c")
def gr02_upstream(spark, d):
    return graph.reached(_tree(spark, d), _seeds(spark, d)).select("node")


@query(f"WITH RECURSIVE {_TREE}, c(seed, node, hops) AS (SELECT CAST(s_suppkey AS BIGINT) * 3, CAST(s_suppkey AS BIGINT) * 3, CAST(0 AS BIGINT) FROM supplier UNION SELECT c.seed, e.down, c.hops + 1 FROM c JOIN e ON e.up = c.node) SELECT seed, node, min(hops) AS hops FROM c GROUP BY 1, 2")
def gr03_descendants_hops(spark, d):
    seeds = table(spark, d, "supplier").select((F.col("s_suppkey") * 3).alias("seed")).withColumn("node", F.col("seed"))
    return graph.reached(_tree(spark, d), seeds, ["seed"], upstream=False).select("seed", "node", "hops")


@query("WITH n AS (SELECT c_custkey AS k FROM customer), m AS (SELECT max(k) AS m, min(k) AS a FROM n) SELECT k AS node, CASE WHEN k % 7 = a % 7 THEN a ELSE k % 7 + CASE WHEN k % 7 < a THEN 7 ELSE 0 END END AS terminal, false AS cyclic FROM n, m")
def gr06_terminal_chain(spark, d):
    own = table(spark, d, "customer").select(F.col("c_custkey").alias("up"))
    least = own.agg(F.min("up")).first()[0]
    return graph.terminals(own.where(F.col("up") - 7 >= least).withColumn("down", F.col("up") - 7)).select("node", "terminal", "cyclic")


@query("SELECT p_partkey AS node, p_partkey // 10 * 10 AS terminal, true AS cyclic FROM part")
def gr06_terminal_cycles(spark, d):
    top = table(spark, d, "part").agg(F.max("p_partkey")).first()[0]
    block = F.floor(F.col("up") / 10) * 10
    size = F.least(F.lit(10), F.lit(top + 1) - block)
    own = table(spark, d, "part").select(F.col("p_partkey").alias("up"))
    return graph.terminals(own.withColumn("down", (block + (F.col("up") - block + 1) % size).cast("long"))).select("node", "terminal", "cyclic")


@query(f"WITH {_TREE} SELECT up, down FROM e WHERE up IN (SELECT c_custkey FROM customer) AND down IN (SELECT c_custkey FROM customer)")
def gr08_subgraph(spark, d):
    return graph.induced(_tree(spark, d), table(spark, d, "customer").select(F.col("c_custkey").alias("node")))


@query(
    f"""WITH {_TREE}, n AS (SELECT CAST(n_nationkey AS BIGINT) AS k FROM nation WHERE n_nationkey > 0), g AS (SELECT lpad(CAST(CAST(r_regionkey AS BIGINT) AS VARCHAR), 8, '0') AS s, CAST(r_regionkey AS BIGINT) + 1 AS k FROM region)
    SELECT '{{"nodes":[' || (SELECT string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FROM n) || '],"edges":[' || (SELECT string_agg('[' || up || ',' || down || ']', ',' ORDER BY up, down) FROM e WHERE up IN (SELECT k FROM n) AND down IN (SELECT k FROM n)) || '],"gage_hf":{{' || (SELECT string_agg('"' || s || '":' || k, ',' ORDER BY s) FROM g) || '}}}}' AS document"""
)
def gr10_topology(spark, d):
    nodes = table(spark, d, "nation").where("n_nationkey > 0").select(F.concat(F.lit("wb-"), F.col("n_nationkey").cast("string")).alias("node"))
    edges = _tree(spark, d).select(*(F.concat(F.lit("wb-"), F.col(c).cast("string")).alias(c) for c in ("up", "down")))
    gauges = table(spark, d, "region").select(ids.zero_filled(F.col("r_regionkey").cast("string")).alias("STAID"), (F.col("r_regionkey").cast("long") + 1).alias("divide_id"))
    return graph.topology(nodes, graph.induced(edges, nodes), gauges)


@query(f"WITH RECURSIVE {_TREE}, c(seed, node, hops) AS (SELECT c_custkey, c_custkey, CAST(0 AS BIGINT) FROM customer UNION SELECT c.seed, e.down, c.hops + 1 FROM c JOIN e ON e.up = c.node), g AS (SELECT CAST(n_nationkey AS BIGINT) * 4 AS node FROM nation WHERE n_nationkey > 0), r AS (SELECT seed, g.node, hops, row_number() OVER (PARTITION BY seed ORDER BY hops, g.node) AS k FROM c JOIN g ON g.node = c.node) SELECT seed, node AS gauge_node, hops FROM r WHERE k = 1")
def jn21_nearest_gauge(spark, d):
    starts = table(spark, d, "customer").select(F.col("c_custkey").alias("seed"), F.col("c_custkey").alias("node"))
    gauges = table(spark, d, "nation").where("n_nationkey > 0").select((F.col("n_nationkey").cast("long") * 4).alias("node")).withColumn("STAID", F.lpad(F.col("node").cast("string"), 8, "0"))
    return graph.nearest_below(_tree(spark, d), starts, gauges, "seed").select("seed", "gauge_node", "hops")


@query(f"WITH RECURSIVE {_TREE}, c(gauge, node) AS (SELECT CAST(r_regionkey AS BIGINT) + 2, CAST(r_regionkey AS BIGINT) + 2 FROM region UNION SELECT c.gauge, e.up FROM c JOIN e ON e.down = c.node) SELECT gauge, count(DISTINCT 'cat-' || node) AS n_catchments FROM c GROUP BY 1")
def gr04_catchments_above(spark, d):
    gauges = table(spark, d, "region").select((F.col("r_regionkey").cast("long") + 2).alias("STAID")).withColumn("node", F.col("STAID"))
    tree = _tree(spark, d)
    names = tree.select(F.col("up").alias("node")).distinct().withColumn("divide_id", F.concat(F.lit("cat-"), F.col("node").cast("string")))
    return graph.upstream_catchments(tree, gauges, names).groupBy(F.col("STAID").alias("gauge")).agg(F.count("*").alias("n_catchments"))


@query("SELECT DISTINCT trim(c_name) AS up, trim(c_mktsegment) AS down FROM customer WHERE trim(c_name) <> '' AND trim(c_mktsegment) <> ''")
def gr11_edges(spark, d):
    return graph.edges_from(table(spark, d, "customer"), "c_name", "c_mktsegment")


# ---- grids and projection


_BOX = "b AS (SELECT s_suppkey AS id, -129 + (s_suppkey % 10) * CAST(0.05 AS DOUBLE) + CAST(0.0025 AS DOUBLE) AS xmin, -129 + (s_suppkey % 10) * CAST(0.05 AS DOUBLE) + CAST(0.0525 AS DOUBLE) AS xmax, 40 + (s_suppkey // 10) * CAST(0.03 AS DOUBLE) + CAST(0.0025 AS DOUBLE) AS ymin, 40 + (s_suppkey // 10) * CAST(0.03 AS DOUBLE) + CAST(0.0325 AS DOUBLE) AS ymax FROM supplier)"
_COARSE = grid.Grid(300, 600, -130.0, 42.0, 0.02)


def _boxes(spark, d):
    k, own = F.col("s_suppkey"), table(spark, d, "supplier")
    x, y = (k % 10) * 0.05 - 129.0, F.floor(k / 10) * 0.03 + 40.0
    return own.select(k.alias("id"), (x + 0.0025).alias("xmin"), (x + 0.0525).alias("xmax"), (y + 0.0025).alias("ymin"), (y + 0.0325).alias("ymax"))


_INSIDE = f"{_BOX}, r AS (SELECT unnest(range(0, 300)) AS row), c AS (SELECT unnest(range(0, 600)) AS col), g AS (SELECT row, col, -130 + (col + CAST(0.5 AS DOUBLE)) * CAST(0.02 AS DOUBLE) AS lon, 42 - (row + CAST(0.5 AS DOUBLE)) * CAST(0.02 AS DOUBLE) AS lat FROM r, c), i AS (SELECT id, CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col FROM b JOIN g ON lon BETWEEN xmin AND xmax AND lat BETWEEN ymin AND ymax)"


@query(f"WITH {_INSIDE} SELECT id, row, col, row * 600 + col AS cell_id FROM i")
def sp04_cells_bbox(spark, d):
    got = _COARSE.cells_in(_boxes(spark, d))
    return got.select("id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), _COARSE.cell(F.col("row"), F.col("col")).alias("cell_id"))


@query(f"WITH {_INSIDE}, o AS (SELECT unnest(range(-2, 3)) AS o) SELECT DISTINCT id, row + x.o AS row, col + y.o AS col FROM i, o x, o y WHERE row + x.o BETWEEN 0 AND 299 AND col + y.o BETWEEN 0 AND 599")
def sp14_neighbours(spark, d):
    return _COARSE.neighbours(_COARSE.cells_in(_boxes(spark, d)).select("id", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col")), 2)


@query("SELECT p_partkey * 8401 + 5 AS cell_id, p_partkey AS row, 5 AS col FROM part")
def sp06_decode(spark, d):
    g = grid.Grid(grid.FORCING_ROWS, grid.FORCING_COLUMNS, 0.0, 0.0, 1.0)
    own = table(spark, d, "part").select(g.cell(F.col("p_partkey"), F.lit(5)).alias("cell_id"))
    return own.select("cell_id", g.row(F.col("cell_id")).alias("row"), g.column(F.col("cell_id")).cast("int").alias("col"))


@query("SELECT c_custkey, round(fmod(fmod(CAST(c_acctbal AS DOUBLE), 360) + 360, 360), 6) AS lon FROM customer")
def sp21_lon360(spark, d):
    return table(spark, d, "customer").select("c_custkey", r(physics.lon360(F.col("c_acctbal"))).alias("lon"))


@query(f"WITH {_BOX} SELECT a.id AS a, b.id AS b, round(least(greatest(greatest(0, least(a.xmax, b.xmax + 0.01) - greatest(a.xmin, b.xmin + 0.01)) * greatest(0, least(a.ymax, b.ymax + 0.01) - greatest(a.ymin, b.ymin + 0.01)) / ((a.xmax - a.xmin) * (a.ymax - a.ymin)), 0), 1), 6) AS fraction FROM b a JOIN b ON a.id = b.id OR a.id = b.id + 1")
def sp11_box_overlap(spark, d):
    a = _boxes(spark, d)
    b = a.select(F.col("id").alias("b"), *((F.col(c) + 0.01).alias(f"b_{c}") for c in ("xmin", "xmax", "ymin", "ymax")))
    pairs = a.join(b, F.col("id") == F.col("b")).unionByName(a.join(b, F.col("id") == F.col("b") + 1))
    return pairs.select(F.col("id").alias("a"), "b", r(grid.box_fraction()).alias("fraction"))


_K = physics.albers_terms()


@query(
    f"""WITH p AS (SELECT p_partkey, -120 + (p_partkey % 100) * CAST(0.5 AS DOUBLE) AS lon, 25 + (p_partkey // 100) % 25 AS lat FROM part), s AS (SELECT *, sin(radians(lat)) AS s, radians(lon + 96) * {_K['n']!r}::DOUBLE AS th FROM p),
    q AS (SELECT *, (1 - {_K['e']!r}::DOUBLE * {_K['e']!r}::DOUBLE) * (s / (1 - {_K['e']!r}::DOUBLE * {_K['e']!r}::DOUBLE * s * s) - ln((1 - {_K['e']!r}::DOUBLE * s) / (1 + {_K['e']!r}::DOUBLE * s)) / (2 * {_K['e']!r}::DOUBLE)) AS q FROM s),
    r AS (SELECT *, CAST(6378137 AS DOUBLE) * sqrt({_K['C']!r}::DOUBLE - {_K['n']!r}::DOUBLE * q) / {_K['n']!r}::DOUBLE AS rho FROM q) SELECT p_partkey, round(rho * sin(th), 3) AS x, round({_K['rho0']!r}::DOUBLE - rho * cos(th), 3) AS y FROM r"""
)
def sp03_albers(spark, d):
    k = F.col("p_partkey")
    x, y = physics.albers((k % 100) * 0.5 - 120.0, F.floor(k / 100) % 25 + 25.0)
    return table(spark, d, "part").select("p_partkey", r(x, 3).alias("x"), r(y, 3).alias("y"))


def _triangles(spark, d):
    from freshet.functions import wkb

    make = F.pandas_udf(lambda x, y: x.combine(y, lambda a, b: wkb.polygon([(a, b), (a + 0.0713, b), (a, b + 0.0511)])), "binary")
    own = _boxes(spark, d)
    spatial.ship(spark)
    return spatial.with_bounds(own.select(F.col("id").alias("divide_id"), make("xmin", "ymin").alias("geometry")))


@query(f"WITH {_BOX} SELECT id AS divide_id, round(CAST(0.0713 AS DOUBLE) * CAST(0.0511 AS DOUBLE) / 2, 10) AS area FROM b")
def sp09_area(spark, d):
    own = _boxes(spark, d).select("id", F.array(F.col("xmin"), F.col("xmin") + 0.0713, F.col("xmin")).alias("xs"), F.array(F.col("ymin"), F.col("ymin"), F.col("ymin") + 0.0511).alias("ys"))
    return own.select(F.col("id").alias("divide_id"), r(spatial.shoelace("xs", "ys"), 10).alias("area"))


def _cells(spark, d):
    return _COARSE.boxes(_COARSE.table(spark)).select("cell_id", "lon", "lat", *(F.col(c).alias(f"c_{c}") for c in ("xmin", "ymin", "xmax", "ymax")))


@query(f"WITH {_INSIDE.replace(', i AS', ', unused AS')} SELECT id AS divide_id, CAST(row * 600 + col AS BIGINT) AS cell_id FROM b JOIN g ON lon > xmin AND lat > ymin AND (lon - xmin) / CAST(0.0713 AS DOUBLE) + (lat - ymin) / CAST(0.0511 AS DOUBLE) < 1")
def jn16_points_within(spark, d):
    return spatial.points_within(_cells(spark, d), _triangles(spark, d), 0.1, "lon", "lat").select("divide_id", "cell_id")


@query(f"WITH {_BOX} SELECT id AS divide_id, round(CAST(0.0713 AS DOUBLE) * CAST(0.0511 AS DOUBLE) / 2, 6) AS covered FROM b")
def sp10_polygon_overlap(spark, d):
    own = _triangles(spark, d).withColumn("_row", F.monotonically_increasing_id())  # rows that share an id stay apart
    cells = _COARSE.boxes(_COARSE.touched(own)).select(*(F.col(c).alias(f"c_{c}") for c in ("xmin", "ymin", "xmax", "ymax")))
    got = spatial.cell_overlaps(cells, own, 0.1)
    return got.groupBy("divide_id", "_row").agg(r(F.sum("overlap"), 6).alias("covered")).drop("_row")


@query(f"WITH {XW} SELECT CASE WHEN fraction >= 0.999 THEN 'whole' ELSE 'fractional' END AS kind, count(*) AS n FROM xw GROUP BY 1")
def sp19_overlap_kind(spark, d):
    return crosswalk(spark, d).groupBy(grid.overlap_kind(F.col("fraction")).alias("kind")).agg(F.count("*").alias("n"))


# ---- scalar functions


@query(
    """WITH p AS (SELECT p_partkey, p_size + CAST(0 AS DOUBLE) - 10 AS t, (p_partkey % 30) / CAST(1000 AS DOUBLE) AS h, 300 + p_size AS dl, (p_partkey % 10) * 80 AS ds, CAST(95000 + p_partkey % 7000 AS DOUBLE) AS pr, CAST(p_partkey % 9 AS DOUBLE) AS u, CAST(p_partkey % 5 AS DOUBLE) AS v FROM part),
    a AS (SELECT *, CASE WHEN h > 0.02 THEN h / 1000 ELSE h END AS q, pr / 1000 AS kpa, sqrt(u * u + v * v) * (CAST(4.87 AS DOUBLE) / ln(CAST(67.8 AS DOUBLE) * 10 - CAST(5.42 AS DOUBLE))) AS w, CAST(0.6108 AS DOUBLE) * exp(CAST(17.27 AS DOUBLE) * t / (t + CAST(237.3 AS DOUBLE))) AS es FROM p),
    b AS (SELECT *, CAST(0.000665 AS DOUBLE) * kpa AS g, q * kpa / (CAST(0.622 AS DOUBLE) + CAST(0.378 AS DOUBLE) * q) AS ea, 4098 * es / power(t + CAST(237.3 AS DOUBLE), 2) AS sl,
        CAST(0.77 AS DOUBLE) * (ds * CAST(0.0036 AS DOUBLE)) + dl * CAST(0.0036 AS DOUBLE) - CAST(0.98 AS DOUBLE) * (CAST(4.903e-9 AS DOUBLE) / 24) * power(t + CAST(273.15 AS DOUBLE), 4) AS rn FROM a),
    c AS (SELECT *, CASE WHEN rn > 0 THEN CAST(0.1 AS DOUBLE) * rn ELSE CAST(0.5 AS DOUBLE) * rn END AS gs, CASE WHEN rn > 0 THEN CAST(0.24 AS DOUBLE) ELSE CAST(0.96 AS DOUBLE) END AS cd FROM b)
    SELECT p_partkey, round(greatest(0, (CAST(0.408 AS DOUBLE) * sl * (rn - gs) + g * (37 / (t + CAST(273.15 AS DOUBLE))) * w * (es - ea)) / (sl + g * (1 + cd * w))), 8) AS pet FROM c"""
)
def dm01_pet(spark, d):
    k, s = F.col("p_partkey"), F.col("p_size").cast("double")
    pet = physics.hourly_pet(s - 10.0, (k % 30) / 1000.0, s + 300.0, (k % 10) * 80.0, (k % 7000 + 95000).cast("double"), (k % 9).cast("double"), (k % 5).cast("double"))
    return table(spark, d, "part").select("p_partkey", r(pet, 8).alias("pet"))


@query("SELECT c_custkey, CASE WHEN length(s) < 8 THEN lpad(s, 8, '0') ELSE s END AS site, replace(s || '.0.0', '.0', '') AS bare, CASE WHEN c_custkey % 2 = 0 THEN 'cat-' || s ELSE 'cat-' || s END AS cat, CASE WHEN c_custkey % 3 = 0 THEN '123456789012345' ELSE CASE WHEN length(s) < 8 THEN lpad(s, 8, '0') ELSE s END END AS long_id FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS s FROM customer)")
def fs01_ids(spark, d):
    s = F.col("c_custkey").cast("string")
    given = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("cat-"), s)).otherwise(s)
    return table(spark, d, "customer").select("c_custkey", ids.site(F.concat(F.lit(" "), s, F.lit(".0 "))).alias("site"), ids.without_float_tail(F.concat(s, F.lit(".0.0")), everywhere=True).alias("bare"), ids.prefixed(given, "cat-").alias("cat"), ids.zero_filled(F.when(F.col("c_custkey") % 3 == 0, "123456789012345").otherwise(s)).alias("long_id"))


@query("SELECT c_custkey, CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS BIGINT) AS number, right(c_name, 4) AS tail, upper(substr(c_mktsegment, 1, 2)) || '-' || c_custkey AS code, nullif(regexp_extract(c_name, 'x([0-9]+)y', 1), '') AS none FROM customer")
def fs07_text(spark, d):
    return table(spark, d, "customer").select("c_custkey", ids.extracted(F.col("c_name"), r"(\d+)$").cast("long").alias("number"), F.right("c_name", F.lit(4)).alias("tail"), F.concat(F.upper(F.substring("c_mktsegment", 1, 2)), F.lit("-"), F.col("c_custkey").cast("string")).alias("code"), ids.extracted(F.col("c_name"), r"x(\d+)y").alias("none"))


@query(f"SELECT o_orderkey, year(o_orderdate) + CASE WHEN month(o_orderdate) >= 10 THEN 1 ELSE 0 END AS water_year, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS dd, {stamp('time_bucket(INTERVAL 15 MINUTE, o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) + INTERVAL 450 SECOND)')} AS rounded, round((o_orderkey % 5 + 1) * CAST(24 AS DOUBLE), 6) AS hours FROM orders")
def fs12_dates(spark, d):
    own = floods(spark, d).join(table(spark, d, "orders").select(F.col("o_orderkey").alias("event_id")), "event_id")
    at = times.plus_minutes(F.col("b"), F.col("event_id") % 1440)
    return own.select(F.col("event_id").alias("o_orderkey"), times.water_year(F.col("b")).cast("long").alias("water_year"), *(f("b").cast("long").alias(n) for n, f in (("y", F.year), ("m", F.month), ("dd", F.dayofmonth))), times.text(times.rounded(at)).alias("rounded"), r(times.hours_between(F.col("b"), F.col("e"))).alias("hours"))


@query("SELECT event_id, round(epoch_us(ts) / CAST(60000000 AS DOUBLE), 4) AS minutes, strftime(ts, '%Y%m%d-%H%M%S') AS compact, strftime(time_bucket(INTERVAL 2 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS floor2 FROM events")
def fs22_epoch(spark, d):
    ts = F.col("ts")
    return observations(spark, d).select("event_id", r(times.epoch_minutes(ts), 4).alias("minutes"), F.date_format(ts, "yyyyMMdd-HHmmss").alias("compact"), times.text(times.floored(times.from_epoch_minutes(times.epoch_minutes(ts)), 2)).alias("floor2"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS BIGINT) * 1440 WHEN 1 THEN p_size * 60 WHEN 2 THEN p_size ELSE NULL END AS minutes FROM part")
def fs21_durations(spark, d):
    k, n = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    given = F.concat(n, F.when(k == 0, "d").when(k == 1, "h").when(k == 2, "min").otherwise(" weeks"))
    return table(spark, d, "part").select("p_partkey", times.duration_minutes(given).alias("minutes"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def fs36_json(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS x, coalesce(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END, 'NA') AS label, greatest(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 0 END) AS clipped FROM customer")
def fs38_null(spark, d):
    x = F.nullif(F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_acctbal").cast("string")), F.lit("")).try_cast("double")
    label = F.coalesce(F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")), F.lit("NA"))
    return table(spark, d, "customer").select("c_custkey", x.alias("x"), label.alias("label"), physics.at_least(x, 0.0).alias("clipped"))


@query("SELECT event_type, len(list(DISTINCT user_id)) AS n, list_aggregate(list_sort(list(DISTINCT user_id)), 'min') AS least, CAST(list_aggregate(list(DISTINCT user_id), 'sum') AS BIGINT) AS total FROM events GROUP BY 1")
def fs32_arrays(spark, d):
    own = table(spark, d, "events").groupBy("event_type").agg(F.array_sort(F.collect_set("user_id")).alias("u"))
    return own.select("event_type", F.size("u").cast("long").alias("n"), F.element_at("u", 1).alias("least"), F.aggregate("u", F.lit(0).cast("long"), lambda s, v: s + v).alias("total"))


# ---- filters, projections, order


@query("SELECT p_partkey, p_brand FROM part WHERE p_size BETWEEN 10 AND 30 AND p_retailprice > 0 AND p_type LIKE '%M%' AND p_brand IN (SELECT DISTINCT p_brand FROM part WHERE p_partkey < 20) AND trim(p_name) <> ''")
def fl08_compound(spark, d):
    p = table(spark, d, "part")
    brands = p.where("p_partkey < 20").select("p_brand").distinct()
    return p.where(F.col("p_size").between(10, 30) & (F.col("p_retailprice") > 0) & F.col("p_type").contains("M") & (F.trim("p_name") != "")).join(brands, "p_brand", "left_semi").select("p_partkey", "p_brand")


@query("WITH n AS (SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id) AS n, min(event_id) OVER (PARTITION BY user_id) AS a, max(event_id) OVER (PARTITION BY user_id) AS z FROM events) SELECT user_id, event_id FROM n WHERE NOT (n > 2 AND (event_id = a OR event_id = z))")
def fl18_without_ends(spark, d):
    return relational.without_ends(table(spark, d, "events").select("user_id", "event_id"), ["user_id"], "event_id")


@query("SELECT row_number() OVER (ORDER BY c_nationkey, c_custkey) AS ord, c_custkey, c_nationkey FROM customer")
def pj05_numbered(spark, d):
    return relational.with_ordinal(table(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", "c_custkey")


@query("SELECT c_custkey AS custkey, upper(c_name) AS name, 'source' AS origin, c_acctbal / 2 AS half FROM customer")
def pj04_projection(spark, d):
    own = table(spark, d, "customer").select("c_custkey", F.upper("c_name").alias("c_name"), F.lit("source").alias("origin"), (F.col("c_acctbal") / 2).alias("half"))
    return own.withColumnsRenamed({"c_custkey": "custkey", "c_name": "name"})


@query("SELECT p_brand, p_partkey, p_retailprice FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS k FROM part) WHERE k = 1")
def sl04_top_each(spark, d):
    own = table(spark, d, "part").select("p_brand", "p_partkey", "p_retailprice")
    return relational.one_by(own, ["p_brand"], F.desc("p_retailprice"), F.asc("p_partkey"))


@query("SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 5")
def sl03_head(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey").limit(5)


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) BETWEEN 9 AND 390 ORDER BY n DESC, user_id LIMIT 1")
def sl07_range_pick(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n")).where(F.col("n").between(9, 390)).orderBy(F.desc("n"), "user_id").limit(1)
