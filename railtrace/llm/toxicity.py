"""Toxicity by a character n-gram linear classifier with naive Bayes scaling (operator 2).

Features are hashed character n-grams of a text's distinct words.  Each is
scaled by its naive Bayes log-count ratio between toxic and other texts, and a
logistic regression with an L2 penalty is fitted on the scaled features.

The fit takes a bounded sample: at most ``TOXIC`` and ``OTHER`` labelled rows
outside the held-out fold, chosen by the hash of the id, with whole texts, in
one task.  Scoring is one pass over all texts, without a shuffle; ids, labels,
languages and sources are never inputs.

Defined cases: a null or empty text scores as one without features (the base
rate); labels that are null or have no document are left out; a label table
with one class or none gives a constant score; repeated rows score alike; an
empty table gives an empty result; other columns pass through, but for those
named like an added one, which is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtrace.llm.common import map_batches, q
from railtrace.llm.labelled import fit_on, sample_labels
from railtrace.llm.textfeatures import BITS, Adam, Design, WordScores
from railtrace.llm.workers import claim

TOXIC = 1500  # labelled rows to learn from, at most
OTHER = 6500
ROUNDS = 80
PENALTY = 1.0  # of the squared weights, over the number of texts
TOXIC_WEIGHT = 3.0  # of a toxic row in the fit, against 1 of another
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # already scaled by the log-count ratios
    bias: float


def words_of(text: str) -> set[str]:
    return set(text.lower().split())


def fit(texts: Iterable[str], labels: list[int]) -> Model:
    """The model of labelled texts; the labels may be filled while the texts are read, which is once."""
    design = Design(words_of(t) for t in texts)
    y = np.array(labels, dtype=np.float64)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    bias = math.log(rate / (1 - rate))
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(1 << BITS, dtype=np.float32), bias)
    toxic, other = 1 + design.gradient(y, scaled=False), 1 + design.gradient(1 - y, scaled=False)
    ratio = np.log((toxic / toxic.sum()) / (other / other.sum()))
    share = np.where(y == 1, TOXIC_WEIGHT, 1.0)
    share /= share.sum()
    weights, of_weights, of_bias = np.zeros(1 << BITS), Adam(1 << BITS), Adam(())
    for _ in range(ROUNDS):
        error = (_sigmoid(design.scores(weights * ratio) + bias) - y) * share
        weights = weights - of_weights.step(design.gradient(error) * ratio + PENALTY * weights / len(y))
        bias = float(bias - of_bias.step(error.sum()))
    return Model((weights * ratio).astype(np.float32), bias)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    sample = sample_labels(labels, id_col, F.col(q(label_col)), {1: TOXIC, 0: OTHER})
    return fit_on(docs, sample, fit, id_col, text_col)


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents' columns plus ``score_`` (0 to 1) and ``predicted_`` (1 from the threshold on)."""
    passed = docs.select(*[F.col(q(c)) for c in docs.columns if c not in ("score_", "predicted_")])
    at = passed.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity")
        words, bias = WordScores(sent.value.weights), sent.value.bias
        for batch in batches:
            scores = _sigmoid(np.array(words.sums(batch.column(at).to_pylist(), words_of), dtype=np.float64) + bias)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=[*batch.schema.names, "score_", "predicted_"],
            )

    return map_batches(passed, run, "score_ double, predicted_ int")


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
