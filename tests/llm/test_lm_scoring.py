import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import gru, lm_scoring
from tideline.llm.common import id_crc
from tideline.llm.lm_scoring import Settings

SMALL = Settings(words=30, dictionary=60, tails=4, classes=3, size=5, rounds=2, task_tokens=4000, chunk_tokens=3000, piece=50)
SCHEMA = "doc_id long, text string"


def rows(seed=1, n=120):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10**6)}" for _ in range(150)] + ["Straße", "ÀB", "ab\x0bc"]
    texts = [" ".join(words[min(int(rng.expovariate(0.04)), 152)] for _ in range(rng.randrange(60))) for _ in range(n)]
    return [*enumerate(texts), (500, None), (501, ""), (502, " \t\n"), (None, "w1 UNSEEN Unseen"), (503, texts[3]), (503, texts[3]), (504, " ".join(words * 9))]


def learns(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2


def tokens(text):
    return [t for t in (text or "").encode().lower().split() if t]


def brute_base(data):
    counts, ends = Counter(), 0
    for doc, text in data:
        if learns(doc):
            counts.update(tokens(text))
            ends += 1
    total, types = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = []
    for doc, text in data:
        own = [counts[t] for t in tokens(text)] + [ends]
        out.append((doc, learns(doc), len(own), sum(c > 0 for c in own), total, sum(math.log10((c + 1) / (total + types + 1)) for c in own)))
    return counts, ends, out


def slow_score(shape, w, ids):
    """ln p of one text's inputs, a token at a time, from the definition of the network."""
    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    s, h, before, total = shape.size, np.zeros(shape.size), 0, 0.0
    w = {k: v.astype(float) for k, v in w.items()}
    for token in ids:
        a, g = w["input"][before] @ w["gates"] + w["gates_bias"], h @ w["state"]
        z, r = sigmoid(a[:s] + g[:s]), sigmoid(a[s : 2 * s] + g[s : 2 * s])
        new = np.tanh(a[2 * s :] + r * g[2 * s :])
        h = (1 - z) * new + z * h
        logits = h @ w["class"] + w["class_bias"]
        k = next(k for k in range(shape.classes) if shape.starts[k + 1] > token) if token < shape.words else shape.classes + token - shape.words
        total += logits[k] - np.log(np.exp(logits).sum())
        if token < shape.words:
            lo, hi = shape.starts[k], shape.starts[k + 1]
            inside = w["word"][lo:hi] @ h + w["word_bias"][lo:hi]
            total += inside[token - lo] - np.log(np.exp(inside).sum())
        before = token
    return total


def test_against_slow_scorer_and_plain_counts(spark):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    rule = id_crc("doc_id") % 7 != 2
    lexicon = lm_scoring.count_tokens(docs.filter(rule), settings=SMALL)
    encoded = lm_scoring.encode(docs, rule, lexicon)
    weights = lm_scoring.train(encoded, lexicon)
    found = lm_scoring.score(encoded, lexicon, weights).collect()
    counts, ends, expected = brute_base(data)
    key = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    for got, want in zip(sorted((tuple(r) for r in found), key=key), sorted(expected, key=key), strict=True):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5], abs=1e-9)

    order = sorted(counts, key=lambda t: (-counts[t], t))[: SMALL.words - 1]
    place = {t: i + 1 for i, t in enumerate(order)}
    tail = [Counter() for _ in range(SMALL.tails)]
    for t, n in counts.items():
        if t not in place:
            tail[zlib.crc32(t[-2:]) % SMALL.tails][t] = n
    scores = {}
    for doc, text in data:
        ids, fixed = [], 0.0
        for t in tokens(text):
            if t in place:
                ids.append(place[t])
            else:
                k = zlib.crc32(t[-2:]) % SMALL.tails
                ids.append(SMALL.words + k)
                fixed += math.log10((tail[k][t] + 1) / (sum(tail[k].values()) + len(tail[k]) + 1))
        scores.setdefault(doc, []).append(slow_score(lexicon.shape, weights, [*ids, 0]) / math.log(10) + fixed)
    for r in found:
        assert any(r["score"] == pytest.approx(s, rel=1e-4, abs=1e-4) for s in scores[r["doc_id"]])


def test_chances_sum_to_one():
    shape = gru.Shape(7, 3, (0, 1, 4, 7), 4)
    w = gru.initial(shape, np.arange(7, 0, -1.0), np.array([2.0, 0, 5]))
    rng = np.random.default_rng(0)
    w["class"], w["word"] = (rng.standard_normal(w[k].shape).astype(np.float32) for k in ("class", "word"))
    state = np.repeat(rng.standard_normal((1, 4)).astype(np.float32), 10, axis=0)
    found, _ = gru.Network(shape, w).chances(state, np.arange(10))
    assert np.exp(found).sum() == pytest.approx(1, abs=1e-5)


def test_gradients_are_those_of_the_likelihood():
    shape = gru.Shape(6, 2, (0, 2, 6), 3)
    rng = np.random.default_rng(3)
    w = {k: rng.standard_normal(v.shape) * 0.5 for k, v in gru.initial(shape, np.ones(6), np.ones(2)).items()}
    docs = [rng.integers(0, 8, n) for n in (5, 3, 2)]
    before, token, keep, valid, _ = next(gru.Lanes(docs, 2).windows(6))
    h = rng.standard_normal((before.shape[1], 3)) * 0.3

    def loss():
        return -gru.Network(shape, w).gradients(before, token, keep, valid, h)[2]

    back = gru.Network(shape, w).gradients(before, token, keep, valid, h)[0]
    whole = np.zeros_like(w["input"])
    whole[back.pop("input_rows")] = back["input"]
    for name, g in {**back, "input": whole}.items():
        for at in [tuple(rng.integers(0, n) for n in w[name].shape) for _ in range(6)]:
            kept = w[name][at]
            w[name][at] = kept + 1e-2
            up = loss()
            w[name][at] = kept - 1e-2
            down = loss()
            w[name][at] = kept
            assert g[at] == pytest.approx((up - down) / 2e-2, rel=0.03, abs=3e-3)


def test_each_gate_of_a_step_is_a_run_of_lanes():
    shape = gru.Shape(20, 2, (0, 3, 20), 6)
    net = gru.Network(shape, gru.initial(shape, np.ones(20), np.ones(2)))
    before = np.arange(12).reshape(4, 3)
    sums = net.gate_sums(before)
    assert sums.shape == (18, 4, 3) and sums.strides[-1] == sums.itemsize
    expected = net.w["input"][before] @ net.w["gates"] + net.w["gates_bias"]
    assert np.allclose(sums.transpose(1, 2, 0), expected, atol=1e-6)


def test_windows_and_lanes_do_not_change_a_score():
    shape = gru.Shape(20, 2, (0, 3, 20), 6)
    rng = np.random.default_rng(5)
    w = {k: (rng.standard_normal(v.shape) * 0.4).astype(np.float32) for k, v in gru.initial(shape, np.ones(20), np.ones(2)).items()}
    docs = [rng.integers(0, 22, n) for n in (1, 700, 3, 40, 40, 1, 90)]
    expected = [slow_score(shape, w, d.tolist()) for d in docs]
    for lanes, steps in ((1, 1), (2, 7), (512, 32), (3, 1000)):
        assert gru.Network(shape, w).score(docs, lanes, steps) == pytest.approx(expected, rel=1e-4)


def test_held_out_texts_gain(spark):
    """On the small table, held-out documents are likelier under the network than under the unigram law."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = lm_scoring.score_documents(docs, id_crc("doc_id") % 7 != 2, settings=Settings(rounds=2))
    total = found.filter(~F.col("learns")).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert total[0] - total[1] > 0.2 * total[2]


def test_empty_unlearned_and_clashing(spark):
    assert lm_scoring.score_documents(spark.createDataFrame([], SCHEMA), F.lit(True), settings=SMALL).collect() == []
    docs = spark.createDataFrame([(1, "a b", 5, "x"), (2, None, 6, "y")], SCHEMA + ", n long, row string")
    found = lm_scoring.score_documents(docs, F.lit(None).cast("boolean"), settings=SMALL).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found) == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]
    with pytest.raises(ValueError):
        lm_scoring.score_documents(docs.withColumnRenamed("doc_id", "score"), F.lit(True), "score")
