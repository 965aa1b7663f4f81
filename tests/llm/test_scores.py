"""Scores of the trained classifiers, recomputed with plain Python loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandspark.llm import langid, quality_classifier, toxicity
from demandspark.llm.common import BASE, MIXER, byte_values

MASK = (1 << 64) - 1
TEXTS = ["You absolute idiot, leave.", "a quiet day\tby the sea", "", "IDIOT idiot", "ünï çödé scum", "tiny", "the day and the sea and the day again " * 9, None]


def mixed(x: int) -> int:
    for _ in range(2):
        x = (x ^ (x >> 32)) * int(MIXER) & MASK
    return x ^ (x >> 32)


def hashed(run: bytes) -> int:
    h = 0
    for b in run:
        h = (h * int(BASE) + int(byte_values()[b])) & MASK
    return h


def sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def grams(text) -> set[int]:
    """Features of a text: n-grams of its lower-cased bytes with a blank at both ends."""
    raw = bytes(32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    raw = b" " + raw + b" "
    return {mixed((hashed(raw[i : i + n]) + n) & MASK) >> (64 - toxicity.BITS) for n in toxicity.ORDERS for i in range(len(raw) - n + 1)}


def test_toxicity_by_hand(spark):
    """Choice of features, log-count ratios, the regression's steps and the scores of a table."""
    rng = np.random.default_rng(1)
    words = "river stone market winter letter garden cloud engine".split()
    learn = [" ".join(rng.choice(words, 12)) + (" you scum" if k % 3 == 0 else "") for k in range(60)]
    labels = np.array([int(k % 3 == 0) for k in range(60)])
    model = toxicity.fit(learn, labels, steps=25)
    sets = [grams(t) for t in learn]
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    least = max(toxicity.LEAST_ROWS, toxicity.LEAST_SHARE * min(n1, n0))
    ratio = {}
    for f in set().union(*sets):
        one, none = (sum(f in s for s, y in zip(sets, labels) if y == k) for k in (1, 0))
        r = math.log((one + 1) / (n1 + 2) / ((none + 1) / (n0 + 2)))
        if abs(r) >= 2 and one + none >= least:
            ratio[f] = r
    assert set(np.flatnonzero(model.weights).tolist()) == set(ratio) and len(ratio) > 5
    names = sorted(ratio)
    x = np.array([[ratio[f] * (f in s) for f in names] for s in sets])
    w, b, m, v = np.zeros(len(names)), 0.0, np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    share = np.where(labels == 1, 0.5 / n1, 0.5 / n0)
    for step in range(1, 26):
        e = (np.array([sigmoid(z) for z in x @ w + b]) - labels) * share
        g = np.append(x.T @ e + 1e-4 * w, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    weight = {f: w[i] * ratio[f] for i, f in enumerate(names)}
    assert np.allclose(model.weights[names], [weight[f] for f in names], rtol=1e-4, atol=1e-6) and model.intercept == pytest.approx(b, rel=1e-6)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("toxicity", F.lit("x")).repartition(3)
    got = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    for i, text in enumerate(TEXTS):
        assert got[i] == pytest.approx(sigmoid(sum(weight.get(f, 0.0) for f in grams(text)) + b), rel=1e-4)


def test_quality_by_hand(spark):
    """Score of a text from its n-grams, the ordered thresholds, the expected grade; the loss falls with each unit of fitting."""
    Q = quality_classifier
    learn = ["### $$$ %%% junk ###"] * 20 + ["fair but rude text here"] * 20 + ["a long and well made text about the sea"] * 20
    grades = np.repeat([0, 1, 2], 20)

    def score_of(model, text):
        raw = (text or "").encode()
        runs = [mixed(hashed(raw[i : i + Q.ORDER])) >> (64 - Q.BITS) for i in range(len(raw) - Q.ORDER + 1)]
        return Q.SCALE * sum(model.weights[f] for f in runs) / max(1, len(runs)) + model.length_weight * (math.log1p(len(raw)) / 10 - 0.7)

    def loss(model):
        total = 0.0
        for text, g in zip(learn, grades):
            reach = [1.0, *[1 - sigmoid(t - score_of(model, text)) for t in model.thresholds], 0.0]
            total -= math.log(max(reach[g] - reach[g + 1], 1e-9))
        return total / len(learn)

    few, many = Q.fit(learn, grades, steps=5), Q.fit(learn, grades, steps=120)
    assert loss(many) < 0.3 * loss(few) and list(many.thresholds) == sorted(many.thresholds) and list(many.grades) == [0, 1, 2]
    docs = spark.createDataFrame(list(enumerate([*TEXTS, *learn[::20]])), "doc_id long, text string").withColumn("reach", F.lit(1)).repartition(3)
    for r in Q.grade(docs, many).collect():
        z = score_of(many, r.text)
        want = [1 / (1 + math.exp(max(-30, min(30, t - z)))) for t in many.thresholds]
        assert r.reach == pytest.approx(want, rel=1e-6) and r.expected_grade == pytest.approx(sum(want), rel=1e-6)


def test_language_by_hand(spark):
    """The network of a table's scores, byte by byte, in both directions, over segments."""
    net = langid.new_network(["aa", "bb", "cc"], np.random.default_rng(4))
    n = langid.HIDDEN

    def states(d, raw):
        h, out = np.zeros(n), []
        for x in raw:
            a, u = d.byte[x].astype(float), h @ d.state
            r, z = ((1 / (1 + np.exp(-(a[k : k + n] + u[k : k + n])))) for k in (0, n))
            new = np.tanh(a[2 * n :] + r * (u[2 * n :] + d.bias))
            h = new + z * (h - new)
            out.append(h)
        return out

    def pooled(raw):
        total = np.zeros(3)
        for lo in range(0, len(raw), langid.SEGMENT):
            part = raw[lo : lo + langid.SEGMENT]
            for a, b in zip(states(net.ahead, part), states(net.back, part[::-1])[::-1]):
                e = np.exp(np.concatenate([a, b]) @ net.out + net.out_bias)
                total += e / e.sum()
        return total / max(1, len(raw))

    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("score", F.lit("x")).repartition(3)
    for r in langid.predict(docs, net).collect():
        p = pooled((r.text or "").encode())
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == (langid.UNKNOWN, 0.0)
        else:
            assert r.lang_pred == net.languages[int(p.argmax())] and r.score == pytest.approx(p.max(), rel=1e-4)
