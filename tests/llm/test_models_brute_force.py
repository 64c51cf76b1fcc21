"""The two classifiers against plain Python: dictionaries of n-grams, loops, no arrays."""

import math
import random

import pytest

from railtrace.llm import ordinal, toxicity
from railtrace.llm.textfeatures import BITS, LENGTHS


def place(gram: bytes) -> int:
    """The hashed place of an n-gram."""
    rolled = 0
    for n, byte in enumerate(gram, 1):
        rolled = (rolled * 0x100000001B3 + byte + n) % (1 << 64)
    return ((rolled ^ (rolled >> 31)) * 0x9E3779B97F4A7C15) % (1 << 64) >> (64 - BITS)


def features(words):
    """Counts of the n-gram places of a text's distinct words, and the scale of the text."""
    out = {}
    for w in words:
        data = f" {w} ".encode()
        for n in LENGTHS:
            for i in range(len(data) - n + 1):
                p = place(data[i:i + n])
                out[p] = out.get(p, 0) + 1
    return out, 1 / math.sqrt(len(words)) if words else 0.0


class PlainAdam:
    def __init__(self, rate=0.05):
        self.m, self.v, self.t, self.rate = {}, {}, 0, rate

    def step(self, gradient):
        self.t += 1
        out = {}
        for k, g in gradient.items():
            self.m[k] = 0.9 * self.m.get(k, 0.0) + 0.1 * g
            self.v[k] = 0.99 * self.v.get(k, 0.0) + 0.01 * g * g
            out[k] = self.rate * (self.m[k] / (1 - 0.9 ** self.t)) / (math.sqrt(self.v[k] / (1 - 0.99 ** self.t)) + 1e-8)
        return out


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def plain_toxicity(texts, labels):
    rows = [features(toxicity.words_of(t)) for t in texts]
    places = sorted({p for f, _ in rows for p in f})
    size = 1 << BITS
    sums = [{p: 1 + sum(f.get(p, 0) for (f, _), y in zip(rows, labels) if y == label) for p in places} for label in (0, 1)]
    totals = [sum(s.values()) + size - len(places) for s in sums]
    ratio = {p: math.log((sums[1][p] / totals[1]) / (sums[0][p] / totals[0])) for p in places}
    n = len(labels)
    rate = (sum(labels) + 0.5) / (n + 1)
    bias = math.log(rate / (1 - rate))
    share = [toxicity.TOXIC_WEIGHT if y else 1.0 for y in labels]
    share = [s / sum(share) for s in share]
    weights, of_weights, of_bias = dict.fromkeys(places, 0.0), PlainAdam(), PlainAdam()
    score = lambda f, scale: sum(c * weights[p] * ratio[p] for p, c in f.items()) * scale
    for _ in range(toxicity.ROUNDS):
        errors = [(sigmoid(score(f, scale) + bias) - y) * s for (f, scale), y, s in zip(rows, labels, share)]
        gradient = {p: toxicity.PENALTY * weights[p] / n for p in places}
        for (f, scale), e in zip(rows, errors):
            for p, c in f.items():
                gradient[p] += c * scale * e * ratio[p]
        for p, change in of_weights.step(gradient).items():
            weights[p] -= change
        bias -= of_bias.step({0: sum(errors)})[0]
    return {p: weights[p] * ratio[p] for p in places}, bias


def test_toxicity_equals_a_plain_model(spark):
    rng = random.Random(8)
    bad, good = ["scum", "idiot", "filth", "trash"], ["day", "river", "garden", "letter", "music", "idle"]
    texts = [" ".join(rng.choices(bad if i % 3 == 0 else good, k=2) + rng.choices(good, k=rng.randrange(4))) for i in range(24)] + ["", "É x"]
    labels = [int(i % 3 == 0) for i in range(24)] + [0, 1]
    weights, bias = plain_toxicity(texts, labels)
    model = toxicity.fit(texts, labels)
    assert model.bias == pytest.approx(bias, abs=1e-9)
    assert all(model.weights[p] == pytest.approx(w, abs=1e-6) for p, w in weights.items())
    new = ["you scum of the river", "a garden", "", "unseen words entirely"]
    docs = spark.createDataFrame(list(enumerate(new)), "doc_id int, text string")
    got = {r.doc_id: r.score_ for r in toxicity.score(docs, model).collect()}
    for i, text in enumerate(new):
        f, scale = features(toxicity.words_of(text))
        assert got[i] == pytest.approx(sigmoid(sum(c * weights.get(p, 0.0) for p, c in f.items()) * scale + bias), abs=1e-6)


def plain_ordinal(texts, grades):
    rows = [features(ordinal.words_of(t)) for t in texts]
    places = sorted({p for f, _ in rows for p in f})
    k, n = ordinal.GRADES, len(grades)
    thresholds = [math.log(i / (k - i)) for i in range(1, k)]
    first, steps = thresholds[0], [math.log(b - a) for a, b in zip(thresholds, thresholds[1:])]
    weights = dict.fromkeys(places, 0.0)
    of_weights, of_first, of_steps = PlainAdam(), PlainAdam(), PlainAdam()
    for _ in range(ordinal.ROUNDS):
        thresholds = [first + sum(math.exp(s) for s in steps[:i]) for i in range(k - 1)]
        slopes, by_threshold = [], [0.0] * (k + 1)
        for (f, scale), y in zip(rows, grades):
            s = sum(c * weights[p] for p, c in f.items()) * scale
            below = [0.0, *[sigmoid(t - s) for t in thresholds], 1.0]
            high, low = below[y + 1], below[y]
            p = max(high - low, 1e-9)
            d_high, d_low = high * (1 - high) / p / n, low * (1 - low) / p / n
            slopes.append(d_high - d_low)
            by_threshold[y + 1] -= d_high
            by_threshold[y] += d_low
        inner = by_threshold[1:-1]
        gradient = {p: ordinal.PENALTY * weights[p] / n for p in places}
        for (f, scale), e in zip(rows, slopes):
            for p, c in f.items():
                gradient[p] += c * scale * e
        for p, change in of_weights.step(gradient).items():
            weights[p] -= change
        later = [sum(inner[i:]) for i in range(len(inner))]
        first -= of_first.step({0: later[0]})[0]
        change = of_steps.step({i: later[i + 1] * math.exp(s) for i, s in enumerate(steps)})
        steps = [s - change[i] for i, s in enumerate(steps)]
    return weights, [first + sum(math.exp(s) for s in steps[:i]) for i in range(k - 1)]


def test_ordinal_equals_a_plain_model(spark):
    rng = random.Random(9)
    pools = [["junk", "spam"], ["fair", "plain", "plan"], ["clear", "bright", "exact"]]
    grades = [i % 3 for i in range(21)] + [0, 2]
    texts = [" ".join(rng.choices(pools[g], k=2) + rng.choices(["and", "so", "the"], k=2)) for g in grades[:21]] + ["junk junk!", "Clear."]
    weights, thresholds = plain_ordinal(texts, grades)
    model = ordinal.fit(texts, grades)
    assert [float(t) for t in model.thresholds] == pytest.approx(thresholds, abs=1e-9)
    assert all(model.weights[p] == pytest.approx(w, abs=1e-6) for p, w in weights.items())
    new = ["clear and so exact", "junk the spam", "fair", "other words"]
    docs = spark.createDataFrame(list(enumerate(new)), "doc_id int, text string")
    got = {r.doc_id: r for r in ordinal.grade_documents(docs, model).collect()}
    for i, text in enumerate(new):
        f, scale = features(ordinal.words_of(text))
        s = sum(c * weights.get(p, 0.0) for p, c in f.items()) * scale
        below = [0.0, *[sigmoid(t - s) for t in thresholds], 1.0]
        assert got[i].expected_grade_ == pytest.approx(sum(g * (below[g + 1] - below[g]) for g in range(ordinal.GRADES)), abs=1e-6)
        assert got[i].tail_probability_ == pytest.approx(1 - below[ordinal.TAIL], abs=1e-6)
