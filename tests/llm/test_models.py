"""Language model and toxicity network against brute force, gradients and held-out rows."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lapidar.llm import language_model, toxicity


def lm_rows():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdef") for _ in range(3)) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for i in range(150)]
    return rows + [(200, None), (201, ""), (202, " \t"), (203, "NEW Neu\x0bneW é É"), (3, rows[3][1]), (None, "abc abd"), (204, "x " * 9000)]


def test_scores_match_brute_force(spark):
    rows = lm_rows()
    frame = spark.createDataFrame([(i, t, 1.0, 2) for i, t in rows], "doc_id long, text string, score double, block int")
    found = language_model.scored(spark, frame.repartition(3), block_tokens=700, shard_tokens=900).collect()
    docs = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    one, two = Counter(), Counter()
    for i, words in docs:
        if not is_held(i):
            one.update(words)
            two.update(zip([b"", *words[:-1]], words, strict=True))
    total, kinds = sum(one.values()), len(one)
    discount = min(sum(n == 1 for n in one.values()) / kinds, language_model.MOST_DISCOUNT)
    p1 = lambda w: (one[w] - discount) / total if one[w] else discount * kinds / total
    prior, expected = language_model.PRIOR, []
    for i, words in docs:
        score = sum(math.log10((two[u, w] + prior * p1(w)) / (one[u] + prior)) for u, w in zip([b"", *words[:-1]], words, strict=True))
        base = sum(math.log10((one[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
        expected.append((str(i), is_held(i), len(words), sum(one[w] > 0 for w in words), total, round(base, 6), round(score, 6)))
    got = [
        (str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6))
        for r in found
    ]
    assert sorted(got) == sorted(expected)
    assert sum(p1(w) for w in one) + p1(b"unseen") == pytest.approx(1)


def test_language_model_without_training_rows(spark):
    schema = "doc_id long, text string"
    assert language_model.scored(spark, spark.createDataFrame([], schema)).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    rows = language_model.scored(spark, spark.createDataFrame([(held, "a b")], schema)).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in rows] == [(3, 0, 0, 0.0)]


def test_unknown_words_have_a_score_where_no_word_is_seen_once(spark):
    held, *seen = sorted(range(6), key=lambda i: zlib.crc32(str(i).encode()) % 5 != 1)
    seen = [i for i in seen if zlib.crc32(str(i).encode()) % 5 != 1][:2]
    frame = spark.createDataFrame([(held, "a new"), *((i, "a b") for i in seen)], "doc_id long, text string")
    rows = {r["doc_id"]: (r["held_out"], r["score"]) for r in language_model.scored(spark, frame).collect()}
    # two each of a, b and the end; half a count for unknown words
    p1 = lambda n: (n - 0.5 / 3) / 6 if n else 0.5 / 6
    prior = language_model.PRIOR
    expected = math.log10((2 + prior * p1(2)) / (2 + prior)) + math.log10(prior * p1(0) / (2 + prior)) + math.log10(p1(2))
    assert len(seen) == 2 and rows[held] == (True, pytest.approx(expected)) and all(math.isfinite(s) for _, s in rows.values())


@pytest.mark.parametrize("dtype", ["<u1", "<u2", "<u4", "<u8"])
def test_packed_arrays_round_trip(dtype):
    arrays = [np.arange(9, dtype=dtype), np.zeros(0, dtype=dtype), np.array([np.iinfo(dtype).max], dtype=dtype)]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, language_model.unpack(language_model.pack(*arrays)), strict=True))


def test_gradients():
    rng = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in toxicity.new_network().items()}
    grams = toxicity.grams_of([b"the", b"idiot", b"a", "é".encode(), b"xx"])
    rows, kept, label = rng.integers(0, 5, (6, 3)), np.ones((6, 3), bool), np.array([1.0, 0, 1])
    kept[4:, 1] = False

    def loss():
        odds = toxicity.log_odds(net, toxicity.inputs(net, grams), rows, kept)
        return -np.mean(label * np.log(1 / (1 + np.exp(-odds))) + (1 - label) * np.log(1 / (1 + np.exp(odds))))

    found = toxicity.gradients(net, grams, rows, kept, label)
    for name in net:
        at = np.unravel_index(np.abs(found[name]).argmax(), found[name].shape)
        net[name][at] += 1e-3
        up = loss()
        net[name][at] -= 2e-3
        slope = (up - loss()) / 2e-3
        net[name][at] += 1e-3
        assert found[name][at] == pytest.approx(slope, rel=2e-3, abs=1e-6)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 55, 56, 57, 300])
def test_windows_cover_and_overlap(n):
    starts = list(toxicity.window_starts(n))
    assert starts[0] == 0 and starts[-1] + toxicity.WINDOW >= n
    assert all(b - a == toxicity.STRIDE < toxicity.WINDOW for a, b in zip(starts, starts[1:], strict=False))
    assert len(starts) == 1 or starts[-2] + toxicity.WINDOW < n


def toxic_corpus():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(["ba", "do", "ki", "ru", "se"]) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(400):
        words, toxic = [word() for _ in range(rng.randrange(3, 120))], i % 4 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["zorgly", "zorgling,", "Zorg."]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows_and_odd_texts(spark):
    rows, labels = toxic_corpus()
    odd = [(900, None), (901, ""), (902, "ba " * 20_000), (902, "ba " * 20_000), (None, "ba zorg"), (903, "ba " * 9000 + "zorgly")]
    docs = spark.createDataFrame([(i, t, 9, 0.5) for i, t in rows + odd], "doc_id long, text string, toxic int, score double")
    marks = spark.createDataFrame(labels + [(5, None), (None, 1), (8, 0)], "doc_id long, toxic int")
    found = toxicity.scored(spark, docs, marks).collect()
    truth = dict(labels)
    held = [r for r in found if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert len(held) > 50 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found) and len(found) == len(rows) + len(odd)
    by = {r["doc_id"]: r["score"] for r in found}
    assert by[902] < 0.5 < by[903] and by[900] == by[901]


def test_toxicity_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    for marks, expected in (([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0)):
        rows = toxicity.scored(spark, docs, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()
        assert [r["score"] for r in rows] == [expected] * 2
    none = toxicity.scored(spark, docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int"))
    assert none.count() == 0
