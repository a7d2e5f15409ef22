"""Near-duplicate groups: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidates.

1. Every text becomes its set of word shingles; documents with the same set are one node.
2. A node's signature is cut into bands; nodes that share a band share a bucket. In each bucket the least node is the
   hub and each other node is a candidate for it alone, so that a bucket of n nodes gives n - 1 candidates.
3. Candidates are confirmed on the full sets. Confirmed links give components.
4. A bucket whose nodes are still in more than one component may hide a link between two nodes that are not the hub. Its
   nodes are banded once more by a far more selective signature, which deals them to small buckets; there the stars are
   drawn again, around the least and around the greatest node, between nodes of different components only.
5. Where buckets of step 2 still hold several components, all their pairs of different components are compared exactly. Nodes that
   are joined by such buckets form a clan, which is dealt into blocks of about ``BLOCK_SHINGLES``; each two blocks are compared by
   matrix products. This takes time by the square of a clan, in the worst case, but as many tasks as there are pairs of blocks.

With 36 bands of 8 rows two sets with the resemblance 0.85 miss each other with a probability of 1e-5 where bins are independent, less if they
are closer; at 0.80, 40 bands of 7 rows miss with 8e-5. Bins of sets with fewer shingles than bins are filled from others and not quite
independent: 2 of 9,000 such pairs with about 47 shingles and a resemblance near 0.85 were missed.
Words and shingles are told apart by 64-bit hashes throughout, also where full sets are compared.

Skew: exact copies meet in a partial aggregation; joins on buckets, hubs and sets read written tables, so that
adaptive execution can split large keys (a hub's candidates, too). No bucket, hub or component is collected anywhere. Tables are
broadcast only where their bytes, counted first, are within a bound.

Defined results: null text, empty text and text of blanks have no shingles, are linked with nothing and are kept; rows
with equal doc_id are rows of their own; a null doc_id never names a component unless all its members have none; a row is kept
if its doc_id equals (or is null like) its component's; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import LOWER, UPPER, small_or_not, stored, table, tidy
from freshet.llm.shingles import OnePermutation, set_id, shingle_set

#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 85
BANDS, ROWS = 36, 8
#: Percentage, bands and rows of the general rule for near duplicates.
LOOSE = (80, 40, 7)
FINE_BANDS, FINE_ROWS = 128, 16
#: Shingles of a block of nodes, about, and nodes and shingles that are multiplied at once.
BLOCK_SHINGLES, NODES, COLUMNS = 400_000, 1024, 2048
#: Bytes that a row of a table takes once it is broadcast, about: its keys, the key of the hash table and what surrounds them.
KEY_BYTES, HUB_BYTES, NODE_BYTES = 40, 256, 100


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of the text, which tells texts apart that share a doc_id or have none."""
    text = docs["text"].cast("string")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, mark, n_shingles, set_id, keys: a 64-bit key a band; set_id and keys are null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = OnePermutation(bands, rows)
        for batch in batches:
            for a in range(0, len(batch), 500):
                sets = [shingle_set(t) for t in batch.column(1).slice(a, 500).to_pylist()]
                cols = [
                    batch.column(0).slice(a, len(sets)),
                    batch.column(2).slice(a, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_id(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([hashing.band_keys(s).view(np.int64) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "mark", "n_shingles", "set_id", "keys"])

    return _texts(docs).mapInArrow(tidy(run), "doc_id long, mark long, n_shingles long, set_id binary, keys array<long>")


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """set_id, shingles of the nodes (set_id, least, least_mark), from documents with that doc_id and that text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 500):
                made = [(w, s) for t, w in zip(*(c.slice(a, 500).to_pylist() for c in batch.columns), strict=True) if set_id(s := shingle_set(t)) == w]
                cols = [pa.array([w for w, _ in made], pa.binary()), pa.array([s.view(np.int64) for _, s in made], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["set_id", "shingles"])

    wanted = nodes.withColumnRenamed("set_id", "wanted")
    # of rows without a doc_id, or with the same one, only those with the node's own text meet it
    own = _texts(docs).join(wanted, F.col("doc_id").eqNullSafe(F.col("least")) & (F.col("mark") == F.col("least_mark")))
    return own.select("text", "wanted").mapInArrow(tidy(run), "set_id binary, shingles array<long>").dropDuplicates(["set_id"])


def buckets(spark: SparkSession, keyed: DataFrame, name: str) -> DataFrame:
    """Rows of buckets with two or more nodes: key, node, low and high (the least and the greatest node)."""
    shared = keyed.select(F.explode("keys").alias("key")).groupBy("key").count().where("count > 1").select("key")
    shared = small_or_not(stored(spark, shared, f"{name}-keys"), KEY_BYTES)
    rows = stored(spark, keyed.select(F.explode("keys").alias("key"), F.struct("set_id", "n").alias("node")).join(shared, "key"), f"{name}-rows")
    hubs = stored(spark, rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")), f"{name}-hubs")
    return stored(spark, rows.join(small_or_not(hubs, HUB_BYTES), "key"), name)


def near_in_size(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def star(rows: DataFrame, hub: str, percent: int) -> DataFrame:
    """Candidates (a, b) between hubs and the other nodes of their buckets, by set_id, each pair once."""
    pairs = rows.where(F.col("node.set_id") != F.col(f"{hub}.set_id")).where(near_in_size(F.col("node.n"), F.col(f"{hub}.n"), percent))
    return pairs.select(F.least("node.set_id", f"{hub}.set_id").alias("a"), F.greatest("node.set_id", f"{hub}.set_id").alias("b")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("of_b")), "b").join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("of_a")), "a")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return both.withColumn("shared", shared).where(F.col("shared") * 100 >= (F.size("of_a") + F.size("of_b") - F.col("shared")) * percent).select("a", "b")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node, root: one node of each component.

    Each node takes the least of its neighbours and itself as its label; nodes with one label become one node, and only links between
    different labels go on. Nodes are named by hashes, so about a third of them are least among their neighbours and the rounds are few.
    """
    maps = []
    while True:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        maps.append(stored(spark, both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("root")), "labels"))
        of = [maps[-1].select(F.col("node").alias(c), F.col("root").alias(f"of_{c}")) for c in ("a", "b")]
        left = links.join(of[0], "a").join(of[1], "b").where("of_a != of_b").select(F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b")).distinct()
        links = stored(spark, left, "links-left")
        if not links.limit(1).count():
            break
    out = maps.pop()
    while maps:  # from the last labels back to the nodes
        top = out.select(F.col("node").alias("root"), F.col("root").alias("top"))
        out = stored(spark, maps.pop().join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")
    return out


def _merged(spark: SparkSession, roots: DataFrame, links: DataFrame) -> DataFrame:
    """The roots after more links: only components that a new link joins are gone through again, one node each."""
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    known = stored(spark, roots.unionByName(ends.join(roots, "node", "left_anti").select("node", F.col("node").alias("root"))), "known-roots")
    of = [known.select(F.col("node").alias(c), F.col("root").alias(f"of_{c}")) for c in ("a", "b")]
    pairs = links.join(of[0], "a").join(of[1], "b").where("of_a != of_b").select(F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b")).distinct()
    pairs = stored(spark, pairs, "root-links")
    if not pairs.limit(1).count():
        return known
    top = components(spark, pairs).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return stored(spark, known.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")


def _apart(spark: SparkSession, rows: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """Rows of the buckets that hold more than one component, with the nodes' roots."""
    own = rows.join(roots.select(F.col("node").alias("of"), "root"), F.col("node.set_id") == F.col("of"), "left").select("key", "node", "low", "high", F.coalesce("root", "node.set_id").alias("root"))
    own = stored(spark, own, name)
    mixed = own.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y").select("key")
    return own.join(stored(spark, mixed, f"{name}-keys"), "key")


def _across(rows: DataFrame, hub: str, percent: int) -> DataFrame:
    """Star candidates between different components."""
    hubs = rows.where(F.col("node.set_id") == F.col(f"{hub}.set_id")).select("key", F.col("root").alias("hub_root"))
    return star(rows.join(hubs, "key").where("root != hub_root"), hub, percent)


def near_duplicates(spark: SparkSession, docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, band_rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept. The bands must suit the percentage: see ``BANDS`` and ``LOOSE``."""
    sketched = stored(spark, sketches(docs, bands, band_rows), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    nodes = sketched.where("n_shingles > 0").groupBy("set_id").agg(first, F.count("*").alias("copies"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"))
    nodes = stored(spark, nodes.select("set_id", F.col("first.doc_id").alias("least"), F.col("first.mark").alias("least_mark"), "copies", "n", "keys"), "nodes")
    rows = buckets(spark, nodes, "buckets")
    met = stored(spark, rows.select("node.set_id").distinct().join(nodes.select("set_id", "least", "least_mark"), "set_id"), "met")
    sets = stored(spark, full_sets(docs, small_or_not(met, NODE_BYTES)), "sets")
    links = stored(spark, confirmed(star(rows, "low", percent), sets, percent), "links")
    roots = components(spark, links)
    apart = stored(spark, _apart(spark, rows, roots, "apart").select("node.set_id").distinct(), "apart-nodes")
    if apart.limit(1).count():
        roots = _merged(spark, roots, stored(spark, _second_stars(spark, sets.join(apart, "set_id"), sets, roots, percent), "more-links"))
        roots = _merged(spark, roots, stored(spark, _remaining(spark, rows, sets, roots, percent), "exact-links"))
    named = roots.join(nodes.select(F.col("set_id").alias("node"), "least"), "node")
    named = stored(spark, named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(F.col("node").alias("set_id"), "component_id"), "named")
    copies = nodes.where("copies > 1").join(named, "set_id", "left_anti").select("set_id", F.col("least").alias("component_id"))
    special = stored(spark, named.unionByName(copies), "special")
    got = sketched.select("doc_id", "n_shingles", "set_id").join(special, "set_id", "left").select("doc_id", "n_shingles", F.when(F.col("component_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return got.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _second_stars(spark: SparkSession, some: DataFrame, sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links that finer buckets show between different components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = OnePermutation(FINE_BANDS, FINE_ROWS, seed=23)
        for batch in batches:
            ids, arrays = batch.column(0).to_pylist(), batch.column(1)
            for a in range(0, len(ids), 500):
                found = [np.sort(arrays[i].values.to_numpy().view(np.uint64)) for i in range(a, min(a + 500, len(ids)))]
                cols = [pa.array(ids[a : a + 500], pa.binary()), pa.array([len(s) for s in found], pa.int64()), pa.array([hashing.band_keys(s).view(np.int64) for s in found], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["set_id", "n", "keys"])

    fine = buckets(spark, some.select("set_id", "shingles").mapInArrow(tidy(run), "set_id binary, n long, keys array<long>"), "fine")
    rows = stored(spark, _apart(spark, fine, roots, "fine-apart"), "fine-rows")
    pairs = _across(rows, "low", percent).unionByName(_across(rows, "high", percent)).distinct()
    return confirmed(pairs, sets, percent)


def _remaining(spark: SparkSession, rows: DataFrame, sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """All links between different components that share a bucket."""
    apart = stored(spark, _apart(spark, rows, roots, "left-apart"), "left-rows")
    joined = apart.where("node.set_id != low.set_id").select(F.col("low.set_id").alias("a"), F.col("node.set_id").alias("b")).distinct()
    clans = components(spark, joined).withColumnRenamed("root", "clan")
    own = apart.groupBy(F.col("node.set_id").alias("node")).agg(F.first("root").alias("root"), F.first("node.n").alias("n"), F.collect_set("key").alias("keys"))  # a key a band
    own = stored(spark, own.join(clans, "node"), "clans")
    sizes = own.groupBy("clan").agg(F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).cast("int").alias("blocks"))
    sizes = stored(spark, sizes, "clan-sizes")
    dealt = own.join(sizes, "clan").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # each block goes to all pairs that it is part of
    twice = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least("block", x).alias("i"), F.greatest("block", x).alias("j")))
    sent = dealt.join(sets.withColumnRenamed("set_id", "node"), "node").select("clan", F.explode(twice).alias("pair"), "block", "node", "root", "keys", "shingles")
    sent = sent.select("clan", "pair.i", "pair.j", "block", "node", "root", "keys", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def done() -> pa.RecordBatch:
            found = between([x[1:] for x in held if x[0] == at[1]], [x[1:] for x in held if x[0] == at[2]], percent)
            return pa.RecordBatch.from_arrays([pa.array([min(x) for x in found], pa.binary()), pa.array([max(x) for x in found], pa.binary())], names=["a", "b"])

        for batch in batches:
            clan, i, j, block, node, root, keys = (batch.column(k).to_pylist() for k in range(7))
            for k in range(len(batch)):
                if at != (clan[k], i[k], j[k]):
                    if at is not None:
                        yield done()
                    at, held = (clan[k], i[k], j[k]), []
                held.append((block[k], node[k], root[k], keys[k], batch.column(7)[k].values.to_numpy().copy()))
        if at is not None:
            yield done()

    return sent.repartition("clan", "i", "j").sortWithinPartitions("clan", "i", "j").mapInArrow(tidy(run), "a binary, b binary").distinct()


def between(left: list[tuple], right: list[tuple], percent: int) -> list[tuple[bytes, bytes]]:
    """The similar enough pairs of different roots that share a key, from two lists of (node, root, keys, shingles)."""
    of_key: dict[int, set[bytes]] = {}
    for _, root, keys, _ in [*left, *right]:
        for k in keys:
            of_key.setdefault(k, set()).add(root)
    left, right = ([x for x in side if any(len(of_key[k]) > 1 for k in x[2])] for side in (left, right))
    if not left or not right:
        return []
    return [pair for a in range(0, len(left), NODES) for b in range(0, len(right), NODES) for pair in _close(left[a : a + NODES], right[b : b + NODES], percent)]


def _close(left: list[tuple], right: list[tuple], percent: int) -> list[tuple[bytes, bytes]]:
    """The similar enough pairs of different roots, from at most ``NODES`` nodes a side."""
    shared = np.intersect1d(np.concatenate([x[3] for x in left]), np.concatenate([x[3] for x in right]))
    number = {r: k for k, r in enumerate({x[1] for x in [*left, *right]})}
    total, entries = np.zeros((len(left), len(right)), np.float32), []
    for side in (left, right):
        row, value = np.repeat(np.arange(len(side)), [len(x[3]) for x in side]), np.concatenate([x[3] for x in side])
        place = np.minimum(np.searchsorted(shared, value), max(0, len(shared) - 1))
        known = shared[place] == value if len(shared) else np.zeros(len(value), bool)
        order = np.argsort(place[known], kind="stable")
        entries.append((row[known][order], place[known][order]))
    for a in range(0, len(shared), COLUMNS):
        dense = []
        for side, (row, place) in zip((left, right), entries, strict=True):
            low, high = np.searchsorted(place, [a, a + COLUMNS])
            m = np.zeros((len(side), min(COLUMNS, len(shared) - a)), np.float32)
            m[row[low:high], place[low:high] - a] = 1
            dense.append(m)
        total += dense[0] @ dense[1].T
    n, m = (np.array([len(x[3]) for x in side], np.float32) for side in (left, right))
    apart = np.array([number[x[1]] for x in left])[:, None] != np.array([number[x[1]] for x in right])
    close = (total * 100 >= (n[:, None] + m - total) * percent) & apart & (total > 0)
    return [(left[i][0], right[j][0]) for i, j in zip(*(x.tolist() for x in np.nonzero(close)), strict=True)]


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))


ORACLE_SQL = {
    "op5_near_duplicates": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= {PERCENT} * (na.n + nb.n - count(*))),
        reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
        FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""
}
