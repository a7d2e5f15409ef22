"""River networks as edge tables (up, down). Iterations write each step, so depth costs rounds and no lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.ids import number_after_dash
from freshet.session import cut


def edges_from(network: DataFrame, up: str = "id", down: str = "toid") -> DataFrame:
    """Edges with blank endpoints left out."""
    named = network.select(F.trim(up).alias("up"), F.trim(down).alias("down"))
    return named.where("up != '' AND down != ''").distinct()


def reached(edges: DataFrame, seeds: DataFrame, keys: list[str] | None = None, upstream: bool = True, most: int | None = None) -> DataFrame:
    """Breadth-first closure from (keys.., node): keys.., node, hops. Seeds have no hops. Safe on cycles.

    One frontier serves all seeds at once; each round joins it with the edges and drops what was seen.
    """
    keys = keys or []
    here, there = ("down", "up") if upstream else ("up", "down")
    steps = edges.select(F.col(here).alias("_at"), F.col(there).alias("_next")).distinct()
    frontier = cut(seeds.select(*keys, "node").distinct().withColumn("hops", F.lit(0).cast("long")), "frontier")
    seen, hops = [frontier], 0
    while (most is None or hops < most) and frontier.limit(1).count():
        hops += 1
        ahead = frontier.join(steps, F.col("node") == F.col("_at")).select(*keys, F.col("_next").alias("node")).distinct()
        known = seen[0]
        for part in seen[1:]:
            known = known.unionByName(part)
        frontier = cut(ahead.join(known.select(*keys, "node"), [*keys, "node"], "left_anti").withColumn("hops", F.lit(hops).cast("long")), "frontier")
        seen.append(frontier)
        if len(seen) == 8:  # many small tables become one
            merged = seen[0]
            for part in seen[1:]:
                merged = merged.unionByName(part)
            seen = [cut(merged, "reached")]
    out = seen[0]
    for part in seen[1:]:
        out = out.unionByName(part)
    return out


def terminals(edges: DataFrame) -> DataFrame:
    """node, terminal, cyclic: where each node's way downstream ends, by pointer doubling in log2(depth) rounds.

    Each node has one way down (the least, if there are more). Nodes on or above a cycle get the cycle's least node.
    """
    nxt = edges.groupBy("up").agg(F.min("down").alias("to")).select(F.col("up").alias("node"), "to").withColumn("end", F.lit(False))
    ends = edges.select(F.col("down").alias("node")).distinct().join(nxt.select("node"), "node", "left_anti").select("node", F.col("node").alias("to"), F.lit(True).alias("end"))
    # least: the least node passed after the start's own, so that a full turn of a cycle shows the cycle's least
    first = cut(nxt.unionByName(ends).withColumn("least", F.col("to")), "pointers")
    at, n, length = first.drop("end"), first.count(), 1
    while length < 2 * n:
        hop = at.select(F.col("node").alias("_n"), F.col("to").alias("_to"), F.col("least").alias("_least"))
        new = cut(at.join(hop, F.col("to") == F.col("_n")).select("node", F.col("_to").alias("to"), F.least("least", "_least").alias("least"), (F.col("_to") != F.col("to")).alias("moved")), "pointers")
        at, length = new.drop("moved"), length * 2
        if not new.where("moved").limit(1).count():
            break
    # after more steps than nodes a pointer stands on an end or on a cycle; there, the least passed from it on is the cycle's
    own = first.select(F.col("node").alias("_n"), (~F.col("end")).alias("cyclic"))
    stands = at.select("node", F.col("to").alias("on")).join(own, F.col("on") == F.col("_n")).drop("_n")
    turn = at.select(F.col("node").alias("_m"), F.col("least").alias("_least"))
    return stands.join(turn, F.col("on") == F.col("_m")).select("node", F.when(F.col("cyclic"), F.col("_least")).otherwise(F.col("on")).alias("terminal"), "cyclic")


def clean_terminal(terminal: Column) -> Column:
    """Whether a way ends outside the nexus layer."""
    return ~terminal.startswith("nex-")


def induced(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges with both ends among the nodes."""
    own = nodes.select("node").distinct()
    return edges.join(own.withColumnRenamed("node", "up"), "up", "left_semi").join(own.withColumnRenamed("node", "down"), "down", "left_semi").select("up", "down")


def upstream_network(edges: DataFrame, seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    nodes = reached(edges, seeds).select("node").distinct()
    return nodes, induced(edges, nodes)


def topology(nodes: DataFrame, edges: DataFrame, gauges: DataFrame) -> DataFrame:
    """One JSON document: {nodes, edges, gage_hf}. Meant for one basin: the document is one row."""
    a = nodes.agg(F.sort_array(F.collect_set(number_after_dash(F.col("node")))).alias("nodes"))
    b = edges.agg(F.sort_array(F.collect_set(F.array(number_after_dash(F.col("up")), number_after_dash(F.col("down"))))).alias("edges"))
    c = gauges.agg(F.map_from_entries(F.sort_array(F.collect_set(F.struct("STAID", "divide_id")))).alias("gage_hf"))
    return a.crossJoin(b).crossJoin(c).select(F.to_json(F.struct("nodes", "edges", "gage_hf")).alias("document"))  # one row each


def nearest_below(edges: DataFrame, starts: DataFrame, gauges: DataFrame, key: str) -> DataFrame:
    """For each start (key, node) the gauge (STAID, node) with the fewest hops downstream, the least id among equals."""
    ways = reached(edges, starts, [key], upstream=False)
    found = ways.join(gauges.select("STAID", "node"), "node")
    return found.groupBy(key).agg(F.min(F.struct("hops", "STAID", "node")).alias("best")).select(key, "best.STAID", F.col("best.node").alias("gauge_node"), "best.hops")


def upstream_catchments(edges: DataFrame, gauges: DataFrame, catchment_of: DataFrame) -> DataFrame:
    """STAID, divide_id: all catchments above each gauge, in one closure for all gauges."""
    return reached(edges, gauges.select("STAID", "node"), ["STAID"]).join(catchment_of.select("node", "divide_id"), "node").select("STAID", "divide_id").distinct()


def gauges_in_region(divides: DataFrame, locations: DataFrame, nodes: DataFrame) -> DataFrame:
    """Gauges of a region: STAID, divide_id, DRAIN_SQKM; of several rows for a gauge that with the largest drainage, then the least divide."""
    own = locations.where(F.col("hl_reference").isin("gages", "usgs-gage"))
    columns = [F.col("hl_link").alias("STAID"), F.col("id").alias("wb"), F.col("tot_drainage_areasqkm").alias("DRAIN_SQKM")]
    d = divides.select("divide_id", "tot_drainage_areasqkm")
    by_nexus = d.join(own, F.col("divide_id") == F.col("nex_id")).select(*columns)
    by_path = d.join(own, F.concat(F.lit("wb"), F.substring("divide_id", 4, 100)) == F.col("id")).select(*columns)
    found = by_nexus.union(by_path).distinct().where(F.col("wb").like("wb-%")).withColumn("divide_id", number_after_dash(F.col("wb")))
    kept = found.join(nodes.select(number_after_dash(F.col("node")).alias("divide_id")).distinct(), "divide_id", "left_semi")
    w = Window.partitionBy("STAID").orderBy(F.desc("DRAIN_SQKM"), "divide_id")
    return kept.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("STAID", "divide_id", "DRAIN_SQKM")
