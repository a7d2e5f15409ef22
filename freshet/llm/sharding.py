"""Sharding by balanced label propagation: documents with equal texts move to one shard while all shards keep equal row counts.

Documents with equal texts are linked each with each. As all members of such a group have the same neighbours, the labels of a
group are held as one row with the members in each shard, at most one entry a shard. Groups that are as large as a shard
or larger (fewer than twice as many as there are shards) first get whole shards; what is left of them goes on as a group of its own, dealt out with all
others over the remaining shards. In each round

1. every group takes the shard where most of its members are as its target, equal numbers in an order that changes by the round; in
   every other round only shards with room count;
2. the members elsewhere ask to move there. Requests are summed in a histogram of (shard, target, size class, hash class), so that
   the groups that are largest at the target go first;
3. what two shards ask of each other is swapped; the rest is granted up to the target's room. This gives for each two shards the class up
   to which all move, and the part of the next one. These grants, one row a target, are joined with the groups' labels.

Each move makes the sum of the squares of a group's members by shard larger, so the rounds end: when no group is dealt out any more or two
rounds in a row move nothing. Unlinked documents have no edges to cut; they fill what is left, by rank, so that row counts
are at most one apart. Linked documents beyond a shard's quota (possible when nearly all documents are linked) are ranked with them.

Ranks come from row numbers within (shard, bin) and running sums over bins, so no shard or group is sorted in one task. A round reads the
groups' table twice and writes it once, without a shuffle of groups. Groups with more than one in ``HOT`` of all rows are joined with their rows by
broadcast, so that no task gathers them. Only sums by shard or by two shards (24 or 576 numbers), and the groups as large as a shard, reach the driver.

Defined results: null text counts as empty for crc and grouping and has no bytes; rows with equal or null doc_ids are rows of their
own; fewer rows than shards leave the last shards empty; an empty table gives no rows; texts of any length count by their hash only; extra columns are
ignored. Groups go by 64-bit hashes: two texts with the same hash would be kept together, which breaks no law.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.llm.common import discarded, few_files, stored, table

SHARDS = 24
#: Rows that are numbered together, about, and bins at least.
BIN_ROWS, LEAST_BINS = 20_000, 256
SIZE_CLASSES, HASH_CLASSES = 64, 64
#: There are fewer groups than this with more than one in so many of all rows.
HOT = 1024

PLACES = "array<struct<shard:int,members:bigint>>"
#: Of a class that is granted in part, so much of the grant is tried for, as roundings are random.
PART = 0.9


def _of(values: list[int], at: Column) -> Column:
    """The value with the number ``at``."""
    return F.element_at(F.array(*(F.lit(v).cast("long") for v in values)), at + 1)


def _place(shard: Column, members: Column) -> Column:
    return F.struct(shard.cast("int").alias("shard"), members.cast("long").alias("members"))


def first_labels(groups: DataFrame, shards: list[int]) -> DataFrame:
    """Deals ``rest`` members of each group (link, n, rest) out evenly over the shards, beginning at one by its hash: link, n, places."""
    m = len(shards)
    first = F.pmod(F.xxhash64("link"), F.lit(m)).cast("int")
    dealt = F.transform(
        F.sequence(F.lit(0), F.least(F.col("rest"), F.lit(m)).cast("int") - 1),
        lambda k: _place(_of(shards, (F.col("first") + k) % m), F.expr(f"rest div {m}") + (k < F.col("rest") % m).cast("long")),
    )
    places = F.when(F.col("rest") > 0, dealt).otherwise(F.array()).cast(PLACES)
    return groups.withColumn("first", first).select("link", "n", places.alias("places"), F.lit(0).cast("long").alias("come"))


def grants(asked: list[list[int]], room: list[int]) -> list[int]:
    """Moves allowed from each shard to each other one: what both ask of each other is swapped, the rest takes the target's room, shard by shard."""
    n = range(len(room))
    allowed, left = [[min(asked[a][b], asked[b][a]) for b in n] for a in n], list(room)
    for a in n:
        for b in n:
            more = min(left[b], asked[a][b] - allowed[a][b])
            allowed[a][b], left[b] = allowed[a][b] + more, left[b] - more
    return [g for row in allowed for g in row]


def _loads(labels: DataFrame, shards: int) -> tuple[list[int], int]:
    """Members by shard, and how many of them have come in the last round."""
    each = labels.select(F.posexplode("places").alias("nth", "p"), "come")
    got = {r[0]: r[1:] for r in each.groupBy("p.shard").agg(F.sum("p.members"), F.sum(F.when(F.col("nth") == 0, F.col("come")).otherwise(F.lit(0)))).collect()}  # one small row a shard
    return [int(got[s][0]) if s in got else 0 for s in range(shards)], sum(int(x[1]) for x in got.values())


def _aimed(labels: DataFrame, room: list[int], k: int) -> DataFrame:
    """Adds each group's target, its strength there (best), its class among the requests, and the places that are weaker."""
    shards = F.col("places")
    if k % 2 == 0:
        shards = F.filter(shards, lambda p: _of(room, p["shard"]) > 0)
    tie = lambda p: F.xxhash64("link", p["shard"], F.lit(k))
    best = F.array_max(F.transform(shards, lambda p: F.struct(p["members"].alias("members"), tie(p).alias("tie"), p["shard"].alias("shard"))))
    size_class = F.lit(SIZE_CLASSES - 1) - F.floor(F.log2(F.col("best.members").cast("double"))).cast("int")
    number = size_class * HASH_CLASSES + F.pmod(F.xxhash64("link", F.lit(k)), F.lit(HASH_CLASSES)).cast("int")
    weaker = lambda p: (p["members"] < F.col("best.members")) | ((p["members"] == F.col("best.members")) & (tie(p) < F.col("best.tie")))
    asks = F.when(F.col("best").isNull(), F.array().cast(PLACES)).otherwise(F.filter("places", weaker))
    return labels.withColumn("best", best).withColumn("target", F.col("best.shard")).withColumn("class", number).withColumn("asks", asks)


def _moved(aimed: DataFrame, by_target: DataFrame, k: int) -> DataFrame:
    """The labels after the granted moves."""
    joined = aimed.join(F.broadcast(by_target), F.col("target") == F.col("to"), "left")

    def granted(p: Column) -> Column:
        """Members that may move: all below the class where the grant ends, a part of that class, rounded at random."""
        stop = F.try_element_at("stops", p["shard"])
        chance = F.pmod(F.xxhash64("link", p["shard"], F.lit(~k)), F.lit(1000)) / F.lit(1000.0)
        part = F.least(p["members"], F.floor(p["members"] * PART * (stop["left"] / stop["asked"]) + chance).cast("long"))
        part = F.when(stop["left"] > 0, part).otherwise(F.lit(0).cast("long"))
        return F.when(stop.isNull() | (F.col("class") < stop["class"]), p["members"]).when(F.col("class") == stop["class"], part).otherwise(F.lit(0).cast("long"))

    gone = joined.withColumn("gone", F.transform("asks", lambda p: _place(p["shard"], granted(p)))).withColumn("come", F.aggregate("gone", F.lit(0).cast("long"), lambda total, p: total + p["members"]))

    def left(p: Column) -> Column:
        own = F.filter("gone", lambda g: g["shard"] == p["shard"])
        return p["members"] - F.when(F.size(own) > 0, own[0]["members"]).otherwise(F.lit(0)) + F.when(p["shard"] == F.col("target"), F.col("come")).otherwise(F.lit(0))

    places = F.when(F.col("come") > 0, F.filter(F.transform("places", lambda p: _place(p["shard"], left(p))), lambda p: p["members"] > 0)).otherwise(F.col("places"))
    return gone.select("link", "n", places.cast(PLACES).alias("places"), "come")


def propagate(spark: SparkSession, labels: DataFrame, quotas: list[int]) -> DataFrame:
    """Rounds of moves over the stored table (link, n, places, come), which is deleted."""
    shards, idle, k = len(quotas), 0, -1
    load, _ = _loads(labels, shards)
    while idle < 2 and any(load):
        k += 1
        room = [max(0, q - x) for q, x in zip(quotas, load, strict=True)]
        aimed = _aimed(labels, room, k)
        asks = aimed.select("target", "class", F.explode("asks").alias("p")).groupBy(F.col("p.shard").alias("shard"), "target", "class").agg(F.sum("p.members").alias("asked"))
        # at most shards x shards x classes rows, whatever the input: one task sums them up
        sums = stored(spark, asks.coalesce(4), "asked")
        few, asked = sums.coalesce(1), [[0] * shards for _ in range(shards)]
        for a, b, n in few.groupBy("shard", "target").agg(F.sum("asked")).collect():  # a number for each two shards
            asked[a][b] = n
        allowed = grants(asked, room)
        if any(allowed):
            grant = _of(allowed, F.col("shard") * shards + F.col("target"))
            upto = F.sum("asked").over(Window.partitionBy("shard", "target").orderBy("class").rowsBetween(Window.unboundedPreceding, 0))
            stops = few.withColumn("upto", upto).where(F.col("upto") > grant).groupBy("shard", "target").agg(F.min(F.struct("class", (grant - F.col("upto") + F.col("asked")).alias("left"), "asked")).alias("stop"))
            # one row a target, an entry a shard; what may move whole has no stop
            by_target = stops.groupBy(F.col("target").alias("to")).agg(F.map_from_entries(F.collect_list(F.struct("shard", "stop"))).alias("stops"))
            after = stored(spark, _moved(aimed, by_target, k), "labels")
            discarded(spark, sums, labels)
            labels = after
            load, moved = _loads(labels, shards)
            idle = 0 if moved else idle + 1
        else:
            discarded(spark, sums)
            if k % 2 and not any(map(any, asked)):  # all shards counted: every group is in one
                break
            idle += 1
    return labels


def ranked(spark: SparkSession, rows: DataFrame, key: str, bins: int) -> DataFrame:
    """Adds ``rank``, gapless from 0 within the key, without sorting a key in one task."""
    binned = rows.withColumn("bin", F.pmod(F.xxhash64("row"), F.lit(bins)).cast("int"))
    counts = stored(spark, binned.groupBy(key, "bin").agg(F.count("*").alias("n_bin")), "bins")
    before = Window.partitionBy(key).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(key).alias("of"), F.col("bin").alias("of_bin"), F.coalesce(F.sum("n_bin").over(before), F.lit(0)).alias("offset"))
    numbered = binned.withColumn("nth", F.row_number().over(Window.partitionBy(key, "bin").orderBy("row")))
    got = numbered.join(offsets, (F.col(key) == F.col("of")) & (F.col("bin") == F.col("of_bin")))
    return got.withColumn("rank", F.col("offset") + F.col("nth") - 1).drop("bin", "nth", "of", "of_bin", "offset")


def group_places(spark: SparkSession, groups: DataFrame, quotas: list[int]) -> DataFrame:
    """link, n, places: where the members of each group (link, n) go."""
    # groups of a shard's size or more: fewer than twice as many as there are shards
    large = [(r[0], r[1]) for r in groups.where(F.col("n") >= max(2, min(quotas))).select("link", "n").orderBy(F.desc("n"), "link").collect()]
    free, whole, rest = list(range(len(quotas))), {}, {}
    for link, n in large:
        whole[link] = []
        while free and n >= quotas[free[0]] > 0:
            whole[link].append(free[0])
            n -= quotas[free.pop(0)]
        rest[link] = n
    of_link = lambda values, other: F.coalesce(*(F.when(F.col("link") == link, v) for link, v in values.items()), other)
    own = groups.withColumn("rest", of_link({k: F.lit(v).cast("long") for k, v in rest.items()}, F.col("n")))
    labels = stored(spark, first_labels(own, free or [len(quotas) - 1]), "labels")
    labels = propagate(spark, labels, [q if s in free else 0 for s, q in enumerate(quotas)])
    full = {k: F.array(*(_place(F.lit(s), F.lit(quotas[s])) for s in v)).cast(PLACES) for k, v in whole.items() if v}
    places = stored(spark, labels.select("link", "n", F.concat(of_link(full, F.array().cast(PLACES)), "places").alias("places"), "come"), "places")
    discarded(spark, labels)
    return places


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: row counts at most one apart, equal texts together as far as that allows."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = stored(spark, docs.select(docs["doc_id"].cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("link"), F.monotonically_increasing_id().alias("row")), "rows")
    n = rows.count()
    groups = stored(spark, few_files(rows.groupBy("link").agg(F.count("*").alias("n")).where("n > 1"), n), "groups")
    quotas = [n // shards + (s < n % shards) for s in range(shards)]
    places = group_places(spark, groups, quotas)
    load, _ = _loads(places, shards)
    places = places.select("link", "n", "places")

    hot = F.broadcast(places.where(F.col("n") * HOT > n).drop("n"))  # fewer than HOT rows, each with an entry a shard at most
    own = rows.join(hot, "link").unionByName(rows.join(hot.select("link"), "link", "left_anti").join(places.where(F.col("n") * HOT <= n).drop("n"), "link", "left"))
    own = stored(spark, own, "placed")
    split = ranked(spark, own.where(F.size("places") > 1), "link", max(LEAST_BINS, -(-n // BIN_ROWS)))
    nth_place = F.aggregate(
        "places",
        F.struct(F.lit(0).cast("long").alias("passed"), F.lit(-1).alias("shard")),
        lambda acc, x: F.when((acc["shard"] < 0) & (F.col("rank") < acc["passed"] + x["members"]), F.struct(acc["passed"].alias("passed"), x["shard"].alias("shard"))).otherwise(
            F.struct((acc["passed"] + x["members"]).alias("passed"), acc["shard"].alias("shard"))
        ),
    )["shard"]
    columns = ["doc_id", "size", "text_crc32", "row"]
    labelled = own.where("places IS NULL OR size(places) = 1").select(*columns, F.coalesce(F.col("places")[0]["shard"], F.lit(shards)).alias("label")).unionByName(split.select(*columns, nth_place.alias("label")))

    # linked rows first; those beyond a quota and the unlinked rows (label ``shards``) share what is left
    full = [min(x, q) for x, q in zip(load, quotas, strict=True)]
    beyond = [0, *accumulate(x - f for x, f in zip(load, full, strict=True))]
    gaps = [0, *accumulate(q - f for q, f in zip(quotas, full, strict=True))]
    all_ = ranked(spark, stored(spark, labelled, "labelled"), "label", max(LEAST_BINS, -(-n // BIN_ROWS)))
    label, rank = F.col("label"), F.col("rank")
    stays = (label < shards) & (rank < _of([*quotas, 0], label))
    free = rank - _of([*full, 0], label) + _of([*beyond[:-1], beyond[-1]], label)
    gap_shard = F.size(F.filter(F.array(*(F.lit(g).cast("long") for g in gaps[1:])), lambda g: g <= F.col("free")))
    got = all_.withColumn("free", free).withColumn("stays", stays).withColumn("shard", F.when(F.col("stays"), label).otherwise(F.least(gap_shard, F.lit(shards - 1))).cast("int"))
    slot = F.when(F.col("stays"), rank).otherwise(_of(full, F.col("shard")) + F.col("free") - _of(gaps[:-1], F.col("shard")))
    return got.select("doc_id", "size", "text_crc32", "shard", slot.cast("long").alias("slot"))


def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = shard_documents(spark, table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
