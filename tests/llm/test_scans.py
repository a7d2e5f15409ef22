"""License scan, language ID and decontamination."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np

from freshet.llm import decontaminate, language_id, licenses

from .conftest import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_hundreds_of_rules():
    assert len(licenses.RULES) > 300 and len({r[3] for r in licenses.RULES}) > 300


def base_places(text: str | None) -> list[tuple[int, str]]:
    w = WORD.findall((text or "").translate(LOWER))
    return [(k, label) for phrase, label in licenses.BASE for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]


def test_base_and_summaries(spark, docs, nothing):
    extra = ["CC-BY cc by; (cc/by) General\nPublic  License all rights reserved. All Rights Reserved", "accby cc byx general public licenses", "cc cc by by"]
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10_000 + k, t) for k, t in enumerate(extra)]
    got = licenses.summaries(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = []
    for i, t in rows:
        p = base_places(t)
        want.append((i, len(WORD.findall((t or "").translate(LOWER))), len(p), min((k for k, _ in p), default=None), max((k for k, _ in p), default=None), ",".join(sorted({x for _, x in p}))))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=repr) == sorted(want, key=repr)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert licenses.summaries(nothing).count() == 0


def labels(text: str) -> set[str]:
    return {d.label for d in licenses.scan(text)[2]}


def test_priorities_and_containment():
    assert labels("Licensed under the Apache License, Version 2.0.") == {"apache-2.0"}
    assert labels("SPDX-License-Identifier: MIT") == {"mit"}
    assert labels("GNU General Public License version 3 or later") == {"gpl-3.0-or-later"}
    assert labels("GNU General Public License, and the Apache License") == {"gpl", "apache"}
    assert labels("This work is under CC BY-SA 4.0") == {"cc-by-sa-4.0"}
    assert labels("mit freundlichen Gruessen") == set()


def test_outermost_is_the_definition():
    rng = random.Random(4)
    for _ in range(300):
        found = [licenses.Detection(a := rng.randrange(12), a + rng.randrange(1, 6), f"l{k}", rng.randrange(1, 4), k) for k in range(rng.randrange(9))]

        def covered(d, found=found):
            def stronger(e):
                return e.priority > d.priority or e.priority == d.priority and (e.end - e.start > d.end - d.start or (e.start, e.end) == (d.start, d.end) and e.rule < d.rule)

            return any(e is not d and stronger(e) and e.start <= d.start and d.end <= e.end for e in found)

        want = sorted(d for d in found if not covered(d))
        assert licenses.outermost(found) == want


def test_spans(spark, docs):
    frame = spark.createDataFrame([(1, "before the MIT License and CC BY after")], "doc_id long, text string")
    got = {(r.label, r.first_word, r.last_word, r.rule >= 0) for r in licenses.detections(frame).collect()}
    assert ("mit", 1, 3, True) in got and ("cc-by", 5, 6, False) in got


def test_language_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in language_id.op7_language(spark, sf).collect()}
    true = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()
    held = [(got[i].lang_pred, lang) for i, lang in true if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in true)
    assert len(got) == len(true) and np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_edges(spark, docs, nothing):
    decoder = language_id.train(docs)
    got = language_id.predict(spark, docs, decoder).collect()
    assert len(got) == docs.count()
    no_letter = {t: not any(map(str.isalpha, t or "")) for t in (r.text for r in docs.collect())}
    und = sum(no_letter[r.text] for r in docs.collect())
    assert sum(r.lang_pred == "und" for r in got) == und
    assert {r.lang_pred for r in got} <= {"en", "de", "und"}
    assert language_id.accepted(spark, docs, decoder).count() == docs.count() - und
    assert language_id.train(nothing) is None
    assert {r.lang_pred for r in language_id.predict(spark, docs, None).collect()} == {"und"}


def test_codewords():
    assert language_id.codewords(4).shape == (4, 7)
    code = language_id.codewords(20)
    assert min((code[i] != code[j]).sum() for i in range(20) for j in range(i)) >= 12
    rng = np.random.default_rng(1)
    x = np.abs(rng.normal(size=(300, 12))).astype(np.float32) + np.repeat(np.eye(12, dtype=np.float32) * 3, 25, axis=0)
    y = [f"l{k:02}" for k in range(12) for _ in range(25)]
    model = language_id.fit(x, y)
    assert np.mean([model.languages[k] == v for k, v in zip(model(x)[0], y, strict=True)]) > 0.95


def true_distance(item: np.ndarray, part: np.ndarray) -> int:
    cost = [0] * (len(part) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(part, 1):
            new.append(min(cost[j - 1] + (w != v), cost[j] + 1, new[-1] + 1))
        cost = new
    return min(cost)


def test_edit_distance():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 9)), rng.integers(0, 5, rng.integers(0, 14))
        d, start, end = decontaminate.edit_distance(a, b)
        assert d == true_distance(a, b) and 0 <= start <= end <= len(b)
        whole = [0, *range(1, end - start + 1)]
        cost = list(range(end - start + 1))
        for i, w in enumerate(a, 1):
            new = [i]
            for j, v in enumerate(b[start:end], 1):
                new.append(min(cost[j - 1] + (w != v), cost[j] + 1, new[-1] + 1))
            cost = new
        assert cost[-1] == d and whole is not None


def test_leaks_against_brute_force(spark, nothing):
    rng = random.Random(8)
    items = [(k, prose(k, rng.choice([1, 2, 4, 5, 6, 9, 18, 40]))) for k in range(25)] + [(50, None), (51, ""), (52, prose(3, 40))]
    docs = [(0, None), (1, ""), (2, "one")]
    for k in range(150):
        w = (dict(items)[rng.randrange(25)] or "x").split()
        for _ in range(rng.randrange(len(w) // 5 + 2)):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(2)] = [rng.choice(["new", "word", w[0]])][: rng.randrange(2)]
            w = w or ["x"]
        before, after = prose(900 + k, 30).split(), prose(700 + k, 30).split()
        docs.append((10 + k, " ".join(before[: rng.randrange(30)] + w + after[: rng.randrange(30)])))
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    index = decontaminate.Index([(i, t) for i, t in items if t is not None])
    want = {(d, i): x for d, t in docs for i, h in zip(index.ids, index.items, strict=True) if len(h) and (x := true_distance(h, index.numbered(licenses.words(t)))) <= len(h) // 5}
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.find_leaks(spark, a, b).collect()}
    assert set(got) <= set(want) and len(set(want) - set(got)) <= 0.01 * len(want)
    assert all(want[k] == d for k, d in got.items())
    kept = {r.doc_id for r in decontaminate.decontaminated(spark, a, b).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}
    assert decontaminate.find_leaks(spark, nothing, b).count() == decontaminate.find_leaks(spark, a, b.limit(0)).count() == 0
    halves = [set(x.ids) for x in decontaminate.blocks(spark, b, 20_000)]
    assert len(halves) > 2 and set().union(*halves) >= {i for i, t in items if t}
    assert {(r.doc_id, r.item_id): r.distance for r in decontaminate.find_leaks(spark, a, b, 20_000).collect()} == got
    assert {r.doc_id for r in decontaminate.decontaminated(spark, a, b, 20_000).collect()} == kept


def test_long_items_are_found():
    """A fifth of the words edited, in items of hundreds and thousands of words."""
    rng = np.random.default_rng(3)
    for m, tries in ((300, 30), (1000, 20), (4000, 4)):
        item = [f"w{k}" for k in rng.integers(0, 3000, m)]
        index, found = decontaminate.Index([(1, " ".join(item))]), 0
        for _ in range(tries):
            doc = list(item)
            for k in sorted(rng.choice(m, m // 5, replace=False).tolist(), reverse=True):
                doc[k : k + 1] = [[], [f"new{rng.integers(10**6)}"], [doc[k], f"new{rng.integers(10**6)}"]][rng.integers(3)]
            found += bool(index.leaks(f"some words before {' '.join(doc)} and after"))
        assert found == tries
        assert not index.leaks(" ".join(item[: m * 3 // 4])) and not index.leaks(" ".join(item[::2]))


def test_a_large_index_is_small_in_memory():
    index = decontaminate.Index([(k, " ".join(f"w{k}x{j}" for j in range(20))) for k in range(2000)])
    arrays = [x for t in (*index.found_at.values(), *index.tables.values()) for x in t if isinstance(x, np.ndarray)]
    assert sum(x.nbytes for x in arrays if x.dtype != bool) < 2000 * (decontaminate.PART_BYTES + 20 * decontaminate.WORD_BYTES)
    assert [x.item for x in index.leaks(" ".join(f"w77x{j}" for j in range(20)))] == [77]


def test_leaks_of_odd_rows(spark):
    item = prose(5, 30)
    docs = spark.createDataFrame([(None, item, "a", 1), (None, "clean", "b", 2), (7, f"x {item} y", "c", 3), (7, item, "d", 4), (8, prose(6, 20_000) + " " + item, "e", 5), (9, None, "f", 6)], "doc_id long, Text string, digest string, _digest int")
    bench = spark.createDataFrame([(1, item)] * 50 + [(None, item), (2, "")], "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in decontaminate.find_leaks(spark, docs, bench, 60_000).collect()]
    assert len(got) == 4 * 51 and {i for _, i in got} == {1, None} and {i for i, _ in got} == {None, 7, 8}
    left = decontaminate.decontaminated(spark, docs, bench, 60_000)
    assert left.columns == docs.columns and sorted(tuple(r) for r in left.collect() if r.doc_id) == [(9, None, "f", 6)]
    assert [tuple(r) for r in left.collect() if r.doc_id is None] == [(None, "clean", "b", 2)]


def test_decoding_is_the_nearest_codeword():
    """The decoder against plain loops over codewords and bits."""
    rng = np.random.default_rng(5)
    x = np.abs(rng.normal(size=(200, 9))).astype(np.float32) + np.repeat(np.eye(9, dtype=np.float32), 25, axis=0)[rng.integers(0, 225, 200)]
    model = language_id.fit(x, [f"l{k % 9}" for k in range(200)])
    index, score, ambiguous = model(x)
    for row, i, s, flag in zip(x, index, score, ambiguous, strict=True):
        margins = [float(row @ model.weights[:-1, b] + model.weights[-1, b]) for b in range(model.code.shape[1])]
        losses = [sum(float(t) * max(0.0, 1 - m * c) ** 2 for m, c, t in zip(margins, word, model.trust, strict=True)) for word in model.code]
        near = sorted(losses)
        assert abs(losses[i] - near[0]) < 1e-6 and abs(s - 1 / (1 + np.exp(-language_id.SHARPNESS * (near[1] - near[0])))) < 1e-4
        assert flag == (near[1] - near[0] < language_id.AMBIGUOUS) or abs(near[1] - near[0] - language_id.AMBIGUOUS) < 1e-6


def test_language_model_does_not_depend_on_partitions(spark, monkeypatch):
    rows = [(k // 40, prose(k, 20), ["en", "de", "fr"][k % 3]) for k in range(240)] + [(1, "same text", "en")] * 60 + [(2, "a b", f"rare{k}") for k in range(5)]
    monkeypatch.setattr(language_id, "PER_LANGUAGE", 30)
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 4)
    frame = spark.createDataFrame(rows, "doc_id long, Text string, LANG string")
    a, b = language_id.train(frame.repartition(5)), language_id.train(frame.coalesce(1))
    assert a.languages == b.languages == ["de", "en", "fr", "rare0"] and np.allclose(a.weights, b.weights)
