import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from railtrace.llm import labelled, ordinal, toxicity
from railtrace.llm.queries import QUERIES, quality_grade
from railtrace.llm.textfeatures import Design, WordScores, hashed_ngrams

SF = "/root/testdata/sf0.1"


def test_held_out_fold_is_crc32_of_the_id(spark):
    import zlib

    rows = spark.range(50).select("id", labelled.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)
    assert spark.sql("SELECT CAST(NULL AS int) AS id").select(labelled.held_out("id")).first()[0] is False


def test_scores_equal_the_design():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=1 << 18)
    sets = [{"abc", "é", "x"}, set(), {"abc"}, {"w" * 3000, "中"}]
    found = WordScores(weights).sums([" ".join(sorted(s)) for s in sets], lambda t: set(t.split()))
    assert np.allclose(found, Design(sets).scores(weights))
    starts, places = hashed_ngrams(["ab", "abc"])
    assert np.diff(starts).tolist() == [3, 6]  # of " ab ": two of 3, one of 4; of " abc ": three, two, one


def test_toxicity_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op2_toxicity"](spark, SF).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    toxic, clean = [r.score for r in held if r.toxic == 1], [r.score for r in held if r.toxic == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert auc > 0.97


def test_ordinal_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").withColumn("y", quality_grade())
    rows = QUERIES["op5_ordinal_quality"](spark, SF).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in rows)
    poor, good = [r.expected_grade for r in held if r.y == 0], [r.expected_grade for r in held if r.y == 2]
    assert np.mean([a < b for a in poor for b in good]) > 0.9
    assert np.mean([r.kept for r in held if r.y == 2]) > 0.99


def test_toxicity_odd(odd_docs, no_docs):
    model = toxicity.fit(["you scum", "fine day", "scum of it", "a good day"], [1, 0, 1, 0])
    scored = toxicity.score(odd_docs, model)
    rows = scored.collect()
    base = 1 / (1 + math.exp(-model.bias))
    assert len(rows) == odd_docs.count()
    assert {r.score_ for r in rows if not (r.text or "").split()} == {base}
    assert toxicity.score(no_docs, model).count() == 0
    same = toxicity.score(odd_docs.repartition(7), model)
    assert sorted((str(r.doc_id), r.score_) for r in same.collect()) == sorted((str(r.doc_id), r.score_) for r in rows)


def test_toxicity_without_one_class(spark, odd_docs):
    labels = spark.createDataFrame([(1, 0), (5, 0), (77, 1), (None, 1), (6, None)], "doc_id int, toxic int")
    model = toxicity.train(odd_docs, labels)
    assert not model.weights.any()
    empty = toxicity.train(odd_docs, labels.limit(0))
    assert {r.score_ for r in toxicity.score(odd_docs, empty).collect()} == {0.5}


def test_the_sample_is_bounded_and_excludes_the_fold(spark):
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    sample = labelled.sample_labels(labels.union(labels), "doc_id", F.col("toxic"), {1: 100, 0: 50})
    assert {(r.y, r.n) for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()} == {(1, 100), (0, 50)}
    assert sample.where(labelled.held_out("label_id")).count() == 0


def test_thresholds_are_ordered_and_tails_add_up(odd_docs, no_docs):
    texts = ["bad bad", "bad", "so so", "so", "good good", "good"] * 5
    model = ordinal.fit(texts, [0, 0, 1, 1, 2, 2] * 5)
    assert (np.diff(model.thresholds) > 0).all()
    design = Design([ordinal.words_of(t) for t in ("bad", "so", "good")])
    scores = design.scores(model.weights.astype(float))
    assert scores[0] < scores[1] < scores[2]
    rows = ordinal.grade_documents(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.tail_probability_ <= 1 for r in rows)
    assert all(r.kept_ == (r.tail_probability_ >= ordinal.KEEP) for r in rows)
    assert ordinal.grade_documents(no_docs, model).count() == 0
    none = ordinal.fit([], [])
    assert {round(r.expected_grade_, 9) for r in ordinal.grade_documents(odd_docs, none).collect()} == {1.0}


@pytest.mark.parametrize("grades", [[0, 0, 0], [2, 2], [0, 2]])
def test_missing_grades(grades):
    model = ordinal.fit(["a b", "c d", "e f"][:len(grades)], grades)
    assert np.isfinite(model.weights).all() and (np.diff(model.thresholds) > 0).all()


def test_the_gradient_is_the_slope_of_the_likelihood():
    """One small step of the fit's own rule lowers the loss; checked against brute-force likelihoods."""
    texts, y = ["aa bb", "bb cc", "cc dd", "dd aa"], np.array([0, 1, 2, 1])

    def loss(model):
        below = ordinal._below(model.thresholds, Design([ordinal.words_of(t) for t in texts]).scores(model.weights.astype(float)))
        return -np.log(np.diff(below, axis=1)[np.arange(4), y]).mean()

    start = loss(ordinal.Model(np.zeros(1 << 18), ordinal.fit([], []).thresholds))
    assert loss(ordinal.fit(texts, y.tolist())) < 0.5 * start
