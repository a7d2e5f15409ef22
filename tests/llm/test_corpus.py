"""Sharding, language-model scores and the pipeline."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from freshet.llm import bpe, licenses, log_bilinear, lm_score, sharding
from freshet.llm.registry import oracle_sql, queries

from .test_dedup import brute
from .test_scans import true_distance

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def check_shards(spark, rows, shards):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sharding.shard_documents(spark, frame, shards).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    by = {s: sorted(r.slot for r in got if r.shard == s) for s in range(shards)}
    assert all(v == list(range(len(v))) for v in by.values()) and sum(map(len, by.values())) == len(rows)
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    return got


def test_shards_keep_groups(spark):
    rows = [(k, f"text {k // 4}" if k < 200 else f"own {k}") for k in range(1200)]
    got = check_shards(spark, rows, 24)
    assert all(len({r.shard for r in got if r.doc_id // 4 == g}) == 1 for g in range(50))
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(i, len(t) + 8, zlib.crc32(t.encode())) for i, t in rows}


def test_shards_with_hot_groups(spark):
    rows = [(k, "hot") for k in range(500)] + [(500 + k, f"own {k}") for k in range(1000)]
    got = check_shards(spark, rows, 24)
    by = Counter(r.shard for r in got if r.doc_id < 500)
    assert sorted(by.values())[-7] >= 62 and len(by) <= 9  # 500 rows of 62 or 63 a shard


def least_cut(groups, shards):
    """Fewest links between shards that any placement of the groups' members cuts, by trying them all; counts at most one apart."""
    n = sum(groups)
    quotas = [n // shards + (s < n % shards) for s in range(shards)]

    def ways(k, room):
        if k == 0:
            yield (), room
        else:
            for x in range(min(k, room[0]) + 1) if len(room) > 1 else [k] if room[0] >= k else []:
                for rest, left in ways(k - x, room[1:]) if len(room) > 1 else [((), ())]:
                    yield (x, *rest), (room[0] - x, *left)

    best = {tuple(quotas): 0}
    for g in groups:
        new = {}
        for room, cut in best.items():
            for parts, _ in ways(g, room):
                left = tuple(r - x for r, x in zip(room, [*parts, *[0] * len(room)], strict=False))
                key, cost = left, cut + (g * g - sum(x * x for x in parts)) // 2
                if cost < new.get(key, 10**9):
                    new[key] = cost
        best = new
    return min(best.values())


@pytest.mark.parametrize("seed", range(4))
def test_cut_links_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    groups = sorted(rng.integers(2, 9, 5).tolist(), reverse=True) + [1] * int(rng.integers(4, 12))
    rows = [(len(groups) * 100 + 31 * g + k, f"group {seed} {g}") for g, size in enumerate(groups) for k in range(size)]
    got = check_shards(spark, rows, 3)
    text, by = dict(rows), Counter()
    for r in got:
        by[text[r.doc_id], r.shard] += 1
    cut = sum(n * n for n in groups) - sum(n * n for n in by.values())
    links = sum(n * (n - 1) // 2 for n in groups)
    assert cut // 2 <= least_cut(groups, 3) + 0.25 * links


def test_shards_of_clashing_columns_and_long_texts(spark, docs):
    got = sharding.shard_documents(spark, docs, 5).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 8) for r in docs.select("doc_id", "text").collect())
    assert Counter((r.doc_id, r.size) for r in got) == want


def test_shards_of_pairs_without_room(spark):
    """Every document has one copy: swaps alone can bring nearly all of them together."""
    got = check_shards(spark, [(k, f"pair {k // 2}") for k in range(2000)], 8)
    by = {r.doc_id: r.shard for r in got}
    assert sum(by[2 * k] == by[2 * k + 1] for k in range(1000)) > 950


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, None)] * 30, [(k, f"{k // 3}") for k in range(301)], [(7, "x")] * 50])
def test_shards_of_odd_tables(spark, rows):
    check_shards(spark, rows, 7)


def test_op1(spark, folder, docs):
    got = sharding.op1_shards(spark, folder).collect()
    assert len(got) == docs.count() and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    plan = sharding.op1_shards(spark, folder)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def base_of(rows):
    tokens = {k: [*re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)), None] for k, (i, t) in enumerate(rows)}
    held = {k: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for k, (i, t) in enumerate(rows)}
    c = Counter(w for k, ws in tokens.items() if not held[k] for w in ws)
    n, v = sum(c.values()), len(c)
    return n, [(i, held[k], len(tokens[k]), sum(c[w] > 0 for w in tokens[k]), sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens[k])) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("frequent", [lm_score.FREQUENT, 16])
def test_lm_base(spark, docs, nothing, monkeypatch, frequent):
    monkeypatch.setattr(lm_score, "FREQUENT", frequent)
    n, want = base_of([(r.doc_id, r.text) for r in docs.collect()])
    got = lm_score.score(spark, docs).collect()
    assert {r.train_tokens for r in got} == {n}
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got), key=repr) == sorted(((*x[:4], round(x[4], 6)) for x in want), key=repr)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_score.score(spark, nothing).count() == 0


def test_lm_beats_its_base_on_held_out_text(spark):
    got = [r for r in lm_score.op10_lm_score(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_log_bilinear_learns_context():
    counts = np.zeros((6, 6, 6))
    for a in range(3, 6):
        for b in range(3, 6):
            counts[a, b, 3 + (a + b) % 3] = 100
    p = np.exp(log_bilinear.train(counts, begin=2, steps=600))
    assert np.allclose(p.sum(axis=2), 1) and (p[:, :, 2] == 0).all()
    flat = np.exp(log_bilinear.train(np.zeros((6, 6, 6)), begin=2))
    assert np.allclose(flat.sum(axis=2), 1)
    one = np.zeros((6, 6, 6))
    one[3, :, 4], one[4, :, 3] = 50, 50
    q = np.exp(log_bilinear.train(one, begin=2, steps=600))
    assert q[3, 3, 4] > 0.8 and q[4, 3, 3] > 0.8


def test_pipeline_against_brute_force(spark, folder, docs):
    got = {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if any(map(str.isalpha, r.text or ""))]
    last: dict[str, int | None] = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        last[t.translate(LOWER)] = i
    texts = {i: t for i, t in rows if last[t.translate(LOWER)] == i and i is not None}
    kept = {i: texts[i] for i, c in brute(texts, 80).items() if i == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").where("text IS NOT NULL").collect()]
    split = [licenses.words(t) for _, t in items]
    want = {i for i, t in kept.items() if not any(w and true_distance(w, licenses.words(t)) <= len(w) // 5 for w in split)}
    assert got - {None} == want


def test_stages_return_the_columns_of_documents(spark, folder):
    assert len(corpus_pipeline.STAGES) == 5
    given = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, given, folder).schema == given.schema
        assert stage(spark, given.limit(0), folder).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, given, folder).columns == bpe.encode_documents(given).columns


def test_stages_keep_columns_of_any_name(spark, folder):
    given = spark.read.parquet(f"{folder}/documents.parquet").withColumnRenamed("text", "Text")
    for name in ("__digest", "_id", "_of", "digest", "label", "set_id", "least", "component_id", "mark"):
        given = given.withColumn(name, given["n_chars"] + 1)
    want = {r.doc_id: r for r in given.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, given, folder)
        assert got.columns == given.columns
        assert all(r.doc_id is None or tuple(r)[2:] == tuple(want[r.doc_id])[2:] for r in got.collect())


def test_registry():
    names = set(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and set(oracle_sql()) <= names


def test_lm_vocabulary_grows_with_training(spark):
    """Each of several hundred words follows a word of its own; a model that knows few of them can't tell."""
    n = 600
    rows = [(k, " ".join(f"a{(7 * k + i) % n} b{(7 * k + i) % n}" for i in range(200))) for k in range(200)]
    wrong = [(10_000 + k, " ".join(f"a{(7 * k + i) % n} b{(7 * k + i * 3 + 300) % n}" for i in range(200))) for k in range(0, 200, 10)]
    wrong = [(i, t) for i, t in wrong if zlib.crc32(str(i).encode()) % 7 == 2]
    frame = spark.createDataFrame(rows + wrong, "doc_id long, text string").coalesce(1)
    own = frame.withColumn("residue", lm_score.id_residue(frame["doc_id"], lm_score.MODULUS))
    counts = lm_score._counts(own, 3)
    assert len(lm_score.corpus_of(own, counts, 3).symbols) == 2 * n
    got = lm_score.score(spark, frame).collect()
    right, other = [r.score for r in got if r.held_out and r.doc_id < 10_000], [r.score for r in got if r.doc_id >= 10_000]
    assert other and min(right) > max(other)


def test_classes_are_normalised():
    words = log_bilinear.Vocabulary(np.sort(np.random.default_rng(1).integers(1, 1000, 300))[::-1])
    trainer = log_bilinear.Trainer(words)
    x, y = np.random.default_rng(2).integers(0, 300, (2, 5000))
    trainer.feed(x, y, (x + y) % 300)
    p = np.exp(trainer.weights.log_probabilities(words, np.full(300, 5), np.full(300, 300), np.arange(300)))
    assert math.isclose(p.sum(), 1, rel_tol=1e-4) and (p > 0).all()


def test_lm_trains_on_every_training_token(spark, docs, monkeypatch):
    seen, summed = [], lm_score._summed

    def watched(parts, *keys):
        got = summed(parts, *keys)
        seen.append(sum(np.frombuffer(r.weights, "<f4").sum() for r in got.where("block = -1").collect()))
        return got

    monkeypatch.setattr(lm_score, "_summed", watched)
    (n,) = {r.train_tokens for r in lm_score.score(spark, docs).collect()}
    assert seen == [n, n]


def test_sums_of_runs():
    rng = np.random.default_rng(4)
    for most in (1, 3, 40):
        lengths = rng.integers(1, most + 1, 500)
        rows, starts = rng.normal(size=(lengths.sum(), 3)).astype(np.float32), np.cumsum(lengths) - lengths
        assert np.allclose(log_bilinear._sums(rows, starts), np.add.reduceat(rows, starts, axis=0), atol=1e-4)
