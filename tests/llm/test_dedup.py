"""Exact and near duplicates against SQL and brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from freshet.llm import content_sort, minhash
from freshet.llm.shingles import OnePermutation, shingle_set

from .conftest import edited, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name,module", [("op8_content_sort", content_sort), ("op5_near_duplicates", minhash)])
def test_against_sql(agree, name, module):
    agree(vars(module)[name], module.ORACLE_SQL[name], "/root/testdata/sf0.001")


def test_exact_groups(spark, docs, nothing):
    got = content_sort.exact_groups(spark, docs).collect()
    texts = [((t or "").translate(LOWER), i) for i, t in docs.select("doc_id", "text").collect()]
    size = Counter(t for t, _ in texts)
    largest = {t: max((i for x, i in texts if x == t and i is not None), default=None) for t in size}
    want = Counter((i, largest[t], size[t]) for t, i in texts)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == want
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter({r.text_sha256: 1 for r in got})
    kept = content_sort.exact_kept(spark, docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.kept)
    assert content_sort.exact_groups(spark, nothing).count() == content_sort.exact_kept(spark, nothing).count() == 0


def test_a_group_over_many_partitions(spark):
    rows = [(k, "hot" if k % 3 else f"t{k}") for k in range(3000)]
    got = content_sort.exact_groups(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {(r.keep_id, r.group_size) for r in got if rows[r.doc_id][1] == "hot"} == {(2999, 2000)}
    assert sum(r.kept for r in got) == 1001


def brute(texts: dict[int, str | None], percent: int = 85) -> dict[int, int]:
    sets = {}
    for i, t in texts.items():
        w = [x.encode() for x in (t or "").translate(LOWER).encode().decode().split(" ")]
        w = (t or "").translate(LOWER).encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_near_groups(spark, docs, nothing):
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    got = minhash.near_duplicates(spark, docs).collect()
    want = brute(dict(rows))
    assert {(r.doc_id, r.component_id, r.kept) for r in got if r.doc_id is not None} == {(i, c, i == c) for i, c in want.items()}
    assert len(got) == docs.count() and minhash.near_duplicates(spark, nothing).count() == 0


def test_near_groups_of_families(spark):
    texts = {}
    for f in range(6):
        base = prose(500 + f, 150 + 20 * f)
        for k in range(25):
            texts[len(texts)] = edited(base, 0.002 * k, 1000 * f + k)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute(texts)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(spark, frame).collect()} == want
    assert 6 < len(set(want.values())) < len(want)


def test_pairs_in_a_large_loose_family(spark, monkeypatch):
    """All of the family are below the threshold but for pairs, which are rarely hubs of a bucket; few finer bands show them."""
    rng, base, rows = np.random.default_rng(4), prose(900, 404).split(" "), {}
    for twin in range(200):
        both = rng.integers(5, 399, 2)
        for _ in range(2):
            words = list(base)
            for k in [*both, *rng.integers(5, 399, 3)]:
                words[k] = f"s{twin}" if k in both else f"x{rng.integers(10**9)}"
            rows[len(rows)] = " ".join(words)
    monkeypatch.setattr(minhash, "FINE_BANDS", 4)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 100_000, raising=False)
    want = brute(rows)
    assert 100 < len(set(want.values())) < len(want)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(spark, spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()} == want


def test_signatures_estimate_resemblance():
    op = OnePermutation(64, 8)
    a, b = shingle_set(prose(5, 400)), shingle_set(edited(prose(5, 400), 0.03, 1))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((op.signature(a) == op.signature(b)).mean() - true) < 0.08
    small = shingle_set("one two three four five six")
    assert set(op.signature(small)) <= set(small) and len(op.band_keys(small)) == 64


def test_kept_rows_keep_clashing_columns(spark):
    rows = [(1, "A b", "x", 10, 0.5), (2, "a B", "y", 20, 0.25), (2, "a b", "z", 30, 0.1), (None, "own", None, 40, None), (None, "OWN", "v", 50, 1.0), (3, None, "u", 60, 2.0)]
    frame = spark.createDataFrame(rows, "doc_id long, Text string, digest string, id int, _of double").withColumnRenamed("_of", "of").repartition(3)
    for name in ("__digest", "_id"):
        frame = frame.withColumn(name, frame["id"] * 2)
    got = content_sort.exact_kept(spark, frame)
    assert got.columns == frame.columns
    kept = got.collect()
    assert all(r._id == 2 * r.id and r["__digest"] == 2 * r.id for r in kept)
    assert Counter((r.doc_id, (r.Text or "").lower()) for r in kept) == {(2, "a b"): 1, (None, "own"): 1, (3, ""): 1}
    assert {tuple(r) for r in kept} == {tuple(r) for r in content_sort.exact_kept(spark, frame.coalesce(1)).collect()}


def rows_for_sets(spark, n):
    """Rows that meet a node in the pass over full sets, of n documents without an id."""
    frame = spark.createDataFrame([(None, f"{prose(k // 2, 60)} {k % 2}") for k in range(n)], "doc_id long, text string")
    sketched = minhash.sketches(frame)
    nodes = sketched.selectExpr("set_id", "doc_id AS least", "mark AS least_mark").distinct()
    joined = minhash._texts(frame).join(nodes, minhash.F.expr("doc_id <=> least AND mark = least_mark"))
    assert minhash.full_sets(frame, nodes).count() == n
    return joined.count(), {r.component_id for r in minhash.near_duplicates(spark, frame).collect()}


def test_documents_without_ids_meet_only_their_own_text(spark):
    assert [rows_for_sets(spark, n) for n in (100, 200)] == [(100, {None}), (200, {None})]


def test_looser_threshold(spark):
    texts = {k: edited(prose(40 + k // 4, 300), 0.02, k) for k in range(60)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want, strict = brute(texts, 80), brute(texts, 85)
    assert len(set(want.values())) < len(set(strict.values()))
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(spark, frame, *minhash.LOOSE).collect()} == want


def test_recall_of_links_of_every_hundredth_document(spark):
    """Links of the documents whose id is divisible by 100, against all documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = {r.doc_id: shingle_set(r.text) for r in docs.collect()}
    component = {r.doc_id: r.component_id for r in minhash.op5_near_duplicates(spark, "/root/testdata/sf0.01").collect()}
    found = total = 0
    for q, s in rows.items():
        if q % 100 == 0 and len(s):
            for i, t in rows.items():
                if i != q and len(t) and 100 * min(len(s), len(t)) >= 85 * max(len(s), len(t)):
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    if 100 * both >= 85 * (len(s) + len(t) - both):
                        total, found = total + 1, found + (component[q] == component[i])
    assert found >= 0.99 * total
