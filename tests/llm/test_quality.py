"""Quality classifier: contexts against brute force, gradients, calibration, held-out rows, edge cases."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lapidar.llm import quality
from lapidar.llm.quality import REACH, SLOTS, WIDTH, WORD


def test_contexts_match_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["ab", "cd", "e!", "FG", "é", "_x_", "9"]) for _ in range(rng.randrange(0, 30))) for _ in range(40)]
    texts += [None, "", " \n", "one", "long " * 3000]
    index, words = quality.index_vectors(SLOTS), quality.Words()
    sums = defaultdict(lambda: np.zeros(WIDTH, np.int64))
    for text in texts:
        slots = words(text or "") % SLOTS
        for i, s in enumerate(slots):
            for j in range(max(0, i - REACH), min(len(slots), i + REACH + 1)):
                if j != i:
                    sums[s] += index[slots[j]]
    total = np.zeros((SLOTS, WIDTH + 1), np.int64)
    quality.add_contexts(total, [words(t or "") for t in texts], index)
    assert set(np.flatnonzero(total[:, -1])) >= {s for s in sums if sums[s].any()}
    for s in sums:
        assert (total[s, :-1] == sums[s]).all()
    assert total[:, -1].sum() == sum(len(WORD.findall(t or "")) for t in texts)
    frame = spark.createDataFrame([(t, 1) for t in texts], "text string, slot int").repartition(5)
    vectors = quality.context_vectors(frame)
    out = np.zeros((SLOTS, WIDTH), np.float32)
    for s in sums:
        out[s] = sums[s]
    out -= out.sum(axis=0) / max(np.abs(out).sum(), 1) * np.abs(out).sum(axis=1, keepdims=True)
    np.testing.assert_allclose(vectors, out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9), atol=1e-5)


def test_pooling_takes_whole_texts_in_any_parts(monkeypatch):
    random_ = np.random.default_rng(1)
    pooling, own = quality.Pooling(random_.standard_normal((SLOTS, WIDTH)).astype(np.float32)), quality.index_vectors(quality.OWN_SEEDS)
    hashes = random_.integers(0, 60, 500)
    whole = pooling(hashes, own)
    x = np.concatenate([own[hashes], pooling.contexts[hashes]], axis=1)
    np.testing.assert_allclose(whole[: 4 * WIDTH], np.r_[x.mean(axis=0), x.std(axis=0)], atol=1e-4)
    monkeypatch.setattr(quality, "TOKENS", 7)
    np.testing.assert_allclose(pooling(hashes, own), whole, atol=1e-4)


def test_gradients_are_those_of_the_loss():
    random_ = np.random.default_rng(5)
    x, label = random_.standard_normal((9, 4)), (random_.random(9) > 0.5).astype(float)
    weights = {k: random_.standard_normal(s) for k, s in (("first", (4, 3)), ("first_bias", 3), ("second", 3), ("second_bias", 1))}

    def loss(w):
        return quality.cross_entropy(np.tanh(x @ w["first"] + w["first_bias"]) @ w["second"] + w["second_bias"], label)

    for name, grad in quality.gradients(weights, x, label).items():
        for at in np.ndindex(grad.shape):
            near = [{k: v.copy() for k, v in weights.items()} for _ in range(2)]
            near[0][name][at] += 1e-6
            near[1][name][at] -= 1e-6
            assert grad[at] == pytest.approx((loss(near[0]) - loss(near[1])) / 2e-6, abs=1e-6)


def test_temperature_calibrates():
    random_ = np.random.default_rng(6)
    odds = random_.standard_normal(20_000) * 2
    label = (random_.random(20_000) < quality.sigmoid(odds)).astype(int)
    for factor in (0.25, 1, 4):
        assert quality.temperature(odds * factor, label) == pytest.approx(factor, rel=0.1)


def corpus():
    rng = random.Random(9)
    stems = ["".join(rng.choice("aeiourstlnm") for _ in range(rng.randrange(2, 7))) for _ in range(300)]
    sentence = lambda: " ".join(rng.choice(stems) for _ in range(rng.randrange(4, 12))).capitalize() + "."
    rows, labels = [], []
    for i in range(700):
        text = " ".join(sentence() for _ in range(rng.randrange(1, 9)))
        good = rng.random() < 0.7
        if not good:
            text = rng.choice([lambda t: t.replace(" ", " | "), lambda t: t.upper().replace(" ", "!! "), lambda t: f"{rng.choice(stems)} " * 30])(text)
        rows.append((i, text))
        labels.append((i, int(good)))
    return rows, labels


def test_held_out_rows_are_told_apart_and_edge_cases_have_scores(spark):
    rows, labels = corpus()
    extra = [(7001, None), (7002, ""), (7003, " \t"), (None, "word"), (rows[5][0], "another text"), (7004, "x y " * 20_000)]
    frame = spark.createDataFrame([(i, t, "en", 0.5) for i, t in rows + extra], "doc_id long, text string, lang string, score double")
    marks = labels + [(7001, None), (3, 0), (3, None), (None, 1)]
    marks = spark.createDataFrame([(i, q, 0, "t") for i, q in marks], "doc_id long, quality int, toxic int, text string")
    found = quality.scored(spark, frame.repartition(3), marks)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    found = found.collect()
    assert len(found) == len(rows) + len(extra)
    is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1
    assert all(r["held_out"] == is_held(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    truth = dict(labels)
    tested = [(r["predicted"], truth[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([p == q for p, q in tested]) > 0.95
    again = quality.scored(spark, frame.repartition(5), marks).collect()
    key = lambda r: (str(r["doc_id"]), r["score"])
    np.testing.assert_allclose([r["score"] for r in sorted(again, key=key)], [r["score"] for r in sorted(found, key=key)], atol=1e-3)


def test_labels_of_one_kind_or_none(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(9)], "doc_id long, text string")
    for value, marks in ((1.0, [(i, 1) for i in range(9)]), (0.0, [(i, 0) for i in range(9)]), (0.0, []), (0.0, [(1, None)])):
        labels = spark.createDataFrame(marks, "doc_id long, quality int")
        assert {r["score"] for r in quality.scored(spark, docs, labels).collect()} == {value}
    assert quality.scored(spark, docs.limit(0), labels).count() == 0
