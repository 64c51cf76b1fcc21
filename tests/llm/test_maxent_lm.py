import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from railtrace.llm import maxent_lm as M
from railtrace.llm.common import table
from railtrace.llm.queries import op13_maxent_scoring

SF = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))] + [b""]


def held_out(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


@pytest.fixture(scope="module")
def trained(spark):
    docs = table(spark, SF, "documents")
    return M.train(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)


def test_counts_and_base_scores_by_brute_force(spark):
    texts = {r.doc_id: tokens(r.text) for r in table(spark, SF, "documents").collect()}
    seen = Counter(w for k, ws in texts.items() if not held_out(k) for w in ws)
    n, types = sum(seen.values()), len(seen)
    for r in op13_maxent_scoring(spark, SF).collect():
        words = texts[r.doc_id]
        base = math.fsum(math.log10((seen[w] + 1) / (n + types + 1)) for w in words)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out(r.doc_id), len(words), sum(seen[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(base, rel=1e-12) and r.score <= 0


def plain_log10(trained, seen, words):
    """The model's score of a text, token by token in plain Python."""
    v, c = trained.vocabulary, M.Classes(trained.vocabulary)
    number = {w: i for i, w in enumerate(v.words.split(b"\n"))}
    n, (class_weights, member_weights) = len(v.counts), trained.weights
    row = lambda salt, *parts: int(M._place(salt, *[np.array([p], dtype=np.int32) for p in parts])[0])
    softmax = lambda logits, k: logits[k] - math.log(sum(math.exp(x) for x in logits))
    one = two = n + 1
    out = 0.0
    for w in words:
        i = number.get(w, -1)
        of = int(c.of[i])
        logits = [float(c.bias[k]) + sum(float(class_weights[r, k]) for r in (row(1, one), row(2, one, two))) for k in range(c.n)]
        out += softmax(logits, of)
        if of < c.n_head:
            logits = [float(c.shares[of, k]) + sum(float(member_weights[r, k]) for r in (row(4, one, of), row(5, two, of))) for k in range(M.MEMBERS)]
            out += softmax(logits, int(c.member[i]))
        elif i >= 0:
            out += math.log(v.counts[i] / sum(v.counts[j] for j in range(n) if c.of[j] == of))
        else:
            out += math.log((seen[w] - v.discount) / v.tail_tokens if seen[w] else v.unknown)
        one, two = (i if i >= 0 else n), one
    return out / math.log(10)


def test_scores_equal_a_plain_model(spark, trained):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: tokens(r.text) for r in docs.collect()}
    seen = Counter(w for k, ws in texts.items() if not held_out(k) for w in ws)
    got = {r.doc_id: r.score_ for r in M.score(docs, trained, ["doc_id"]).collect()}
    short = sorted(texts, key=lambda k: len(texts[k]))
    for k in short[:40] + [k for k in short if held_out(k)][:6]:
        assert got[k] == pytest.approx(plain_log10(trained, seen, texts[k]), rel=1e-4, abs=1e-4)


def test_probabilities_of_all_words_add_up(trained):
    v = trained.vocabulary
    model = M.Model(v, trained.weights)
    counts = {bytes(r.word): r.n for r in trained.counts.collect()}
    tail = sum((n - v.discount) / v.tail_tokens for w, n in counts.items() if w not in model.words) + v.unknown
    assert tail == pytest.approx(1)
    for before in ([], [0], [3, 1], [1, -1], [len(v.counts) - 1, 2]):
        ends = np.arange(-1, len(v.counts), dtype=np.int32)
        ids = np.concatenate([[*before, e] for e in ends]).astype(np.int32)
        starts = np.arange(len(ends)) * (len(before) + 1)
        odds = model.log_odds(ids, starts)[starts + len(before)]
        assert np.exp(odds).sum() == pytest.approx(1, abs=1e-4)


def test_a_step_follows_the_gradient():
    """The change of a row is the AdaGrad step of the numeric slope of the log likelihood."""
    rng = np.random.default_rng(3)
    weights = rng.normal(size=(8, 5)).astype(np.float32) / 3
    shares = rng.normal(size=5).astype(np.float32)
    places, target = [np.array([1, 2, 1, 7]), np.array([0, 0, 3, 3])], np.array([4, 0, 2, 2])

    def loss(w):
        logits = shares.astype(float) + sum(w[p] for p in places)
        return -(logits[np.arange(4), target] - np.log(np.exp(logits).sum(1))).sum()

    slope = np.zeros((8, 5))
    for i, j in np.ndindex(8, 5):
        up, down = weights.astype(float), weights.astype(float)
        up[i, j] += 1e-5
        down[i, j] -= 1e-5
        slope[i, j] = (loss(up) - loss(down)) / 2e-5
    model = M.Softmax(weights.copy())
    model.learn()
    model.step(shares, places, target)
    expected = M.RATE * slope / np.sqrt(1e-3 + (slope ** 2).mean(1, keepdims=True))
    assert np.allclose(weights - model.weights, expected, atol=2e-3)
    assert model.used.tolist() == [2, 2, 1, 2, 0, 0, 0, 1] and not model.sums.any()


def test_training_helps_and_repeats(spark):
    sf = "/root/testdata/sf0.01"
    rows = op13_maxent_scoring(spark, sf).collect()
    held = [r for r in rows if r.held_out]
    docs = table(spark, sf, "documents")
    v = M.vocabulary(M.word_counts(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2")))
    untrained = M.Trained(v, M.new_weights(v), M.word_counts(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2")))
    plain = {r.doc_id: r.score_ for r in M.score(docs, untrained, ["doc_id"]).collect()}
    per_token = lambda score: sum(score(r) for r in held) / sum(r.n_tokens for r in held)
    assert per_token(lambda r: r.score) > per_token(lambda r: plain[r.doc_id]) + 0.05 > per_token(lambda r: r.base_score)
    again = {r.doc_id: r.score for r in op13_maxent_scoring(spark, sf).collect()}
    assert all(r.score == pytest.approx(again[r.doc_id], rel=1e-12) for r in rows)


def test_changes_are_averaged_by_use_in_order(spark):
    """Two tasks' changes of a row, weighted by their uses; rows of no task stay."""
    texts = spark.range(0, 2, 1, 2).selectExpr("CASE id WHEN 0 THEN repeat('a b a c ', 30) ELSE repeat('a c b ', 50) END AS text")  # two tasks
    v = M.vocabulary(M.word_counts(texts))
    start = M.new_weights(v)
    merged = M.new_weights(v)
    M._add(merged, M._changes(texts, v, start))
    total, used = [np.zeros(w.shape) for w in start], [np.zeros(len(w)) for w in start]
    for (text,) in texts.collect():
        model = M.Model(v, tuple(w.copy() for w in start))
        for p in (model.of_class, model.of_member):
            p.learn()
        model.learn(model.numbers([w for part in M.pieces(text.encode()) for w in part]), np.array([0]))
        for k, p in enumerate((model.of_class, model.of_member)):
            total[k] += (p.weights - p.start) * p.used[:, None]
            used[k] += p.used
    for k in range(2):
        assert np.allclose(merged[k], total[k] / np.maximum(1, used[k])[:, None], atol=2e-3)
        assert merged[k].any() and not merged[k][used[k] == 0].any()


def test_odd_documents(spark, odd_docs, no_docs, tmp_path, monkeypatch):
    for docs, name in ((odd_docs, "odd"), (no_docs, "none")):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    assert op13_maxent_scoring(spark, f"{tmp_path}/none").count() == 0
    rows = op13_maxent_scoring(spark, f"{tmp_path}/odd").collect()
    assert len(rows) == odd_docs.count() and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    texts = odd_docs.collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(tokens(r.text)) for r in texts)
    assert len({(r.n_tokens, r.score) for r in rows if r.doc_id == 11}) == 1
    nothing = M.train(odd_docs, F.lit(False))
    got = M.score(odd_docs, nothing, ["doc_id", "a.b", "key"]).collect()
    assert {(r.n_known_, r.base_score_) for r in got} == {(0, 0.0)} and {round(r.score_, 6) for r in got} == {0.0}
    assert got[0].asDict().keys() >= {"a.b", "key"}
    monkeypatch.setattr(M, "PIECE", 3)
    for text in ("", "a", "Ab  cD\tefghij k", " x ", "éa b"):
        assert [w for part in M.pieces(text.encode()) for w in part] == tokens(text)


def test_words_beyond_the_dictionary(spark, trained, monkeypatch):
    """A smaller dictionary leaves more words to the join; counts and base scores stay."""
    docs = table(spark, SF, "documents")
    want = {r.doc_id: (r.n_known_, r.base_score_) for r in M.score(docs, trained, ["doc_id"]).collect()}
    monkeypatch.setattr(M, "WORDS", 300)
    small = M.train(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)
    assert 0 < len(small.vocabulary.counts) <= 300 < len(trained.vocabulary.counts)
    for r in M.score(docs, small, ["doc_id"]).collect():
        assert r.n_known_ == want[r.doc_id][0] and r.base_score_ == pytest.approx(want[r.doc_id][1], rel=1e-12)
        assert math.isfinite(r.score_)
