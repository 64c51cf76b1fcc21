"""Quality by ordinal cumulative-link regression on graded ratings (operator 5).

A text has one score: shared weights over hashed features (character n-grams of
its distinct words, case kept, and binned shape features of the whole text).
Ordered thresholds cut the score into grades: P(grade <= k) is the logistic
function of threshold k minus the score.  The model gives the expected grade
and the tail probability P(grade >= ``TAIL``), on which selection rests.

The fit takes at most ``PER_GRADE`` rated rows of each grade outside the
held-out fold, chosen by the hash of the id, with whole texts, in one task.
Scoring is one pass over all texts, without a shuffle.

Defined cases: a null or empty text has shape features alone; ratings that are
null or have no document are left out; grades without a row keep their place
between their neighbours' thresholds; no ratings at all give every grade the
same odds; repeated rows score alike; an empty table gives an empty result;
other columns pass through, but for those named like an added one, which is
replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtrace.llm.common import map_batches, q
from railtrace.llm.labelled import fit_on, sample_labels
from railtrace.llm.textfeatures import BITS, Adam, Design, WordScores
from railtrace.llm.workers import claim

GRADES = 3
PER_GRADE = 2500  # rated rows of a grade to learn from, at most
TAIL = 1  # texts are kept for the probability of this grade or a higher one
KEEP = 0.5
ROUNDS = 80
PENALTY = 0.1

_SYMBOLS = re.compile(r"[^\w\s.,;:?'\"()-]")


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades


def words_of(text: str) -> set[str]:
    """The distinct words, and shape features in the form of words that no text can hold."""
    words = text.split()
    distinct = set(words)
    n = len(words)
    upper = sum(w.isupper() for w in distinct) / max(1, len(distinct))
    symbols = len(_SYMBOLS.findall(text)) / max(1, len(text))
    shape = {
        "length": min(12, n.bit_length()),
        "distinct": int(10 * len(distinct) / max(1, n)),
        "upper": int(10 * upper),
        "symbols": min(10, int(200 * symbols)),
    }
    return distinct | {f"\n{k}={v}" for k, v in shape.items()}


def fit(texts: Iterable[str], grades: list[int]) -> Model:
    """The model of graded texts; the grades may be filled while the texts are read, which is once."""
    design = Design(words_of(t) for t in texts)
    y = np.array(grades, dtype=np.int64)
    thresholds = np.log(np.arange(1, GRADES) / np.arange(GRADES - 1, 0, -1))
    weights = np.zeros(1 << BITS)
    if not len(y):
        return Model(weights.astype(np.float32), thresholds)
    # free parameters: the first threshold, and the logarithms of the steps between thresholds
    first, steps = thresholds[0], np.log(np.diff(thresholds))
    of_weights, of_first, of_steps = Adam(1 << BITS), Adam(()), Adam(len(steps))
    for _ in range(ROUNDS):
        thresholds = first + np.concatenate([[0], np.cumsum(np.exp(steps))])
        below = _below(thresholds, design.scores(weights))  # P(grade <= k), with 0 and 1 at the ends
        high, low = below[np.arange(len(y)), y + 1], below[np.arange(len(y)), y]
        p = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / p / len(y), low * (1 - low) / p / len(y)
        by_score = d_high - d_low  # of the negative log-likelihood
        by_threshold = np.zeros(GRADES + 1)
        np.add.at(by_threshold, y + 1, -d_high)
        np.add.at(by_threshold, y, d_low)
        by_threshold = by_threshold[1:-1]
        weights = weights - of_weights.step(design.gradient(by_score) + PENALTY * weights / len(y))
        later = np.cumsum(by_threshold[::-1])[::-1]
        first = first - of_first.step(later[0])
        steps = steps - of_steps.step(later[1:] * np.exp(steps))
    thresholds = first + np.concatenate([[0], np.cumsum(np.exp(steps))])
    return Model(weights.astype(np.float32), thresholds)


def train(docs: DataFrame, ratings: DataFrame, grade: Column, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """``grade`` is the rating, 0 to GRADES - 1, in terms of the columns of ``ratings``."""
    sample = sample_labels(ratings, id_col, grade, {g: PER_GRADE for g in range(GRADES)})
    return fit_on(docs, sample, fit, id_col, text_col)


def grade_documents(docs: DataFrame, model: Model, text_col: str = "text", tail: int = TAIL, keep: float = KEEP) -> DataFrame:
    """The documents' columns plus ``expected_grade_``, ``tail_probability_``, ``grade_`` and ``kept_``."""
    added = "expected_grade_ double, tail_probability_ double, grade_ int, kept_ boolean"
    names = [f.split()[0] for f in added.split(", ")]
    passed = docs.select(*[F.col(q(c)) for c in docs.columns if c not in names])
    at = passed.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("ordinal")
        words, thresholds = WordScores(sent.value.weights), sent.value.thresholds
        for batch in batches:
            texts = [t or "\n" for t in batch.column(at).to_pylist()]
            below = _below(thresholds, np.array(words.sums(texts, words_of), dtype=np.float64))
            p = np.diff(below, axis=1)
            upper = 1 - below[:, tail]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p @ np.arange(p.shape[1])), pa.array(upper),
                 pa.array(p.argmax(axis=1).astype(np.int32)), pa.array(upper >= keep)],
                names=[*batch.schema.names, *names],
            )

    return map_batches(passed, run, added)


def _below(thresholds: np.ndarray, scores: np.ndarray) -> np.ndarray:
    z = np.clip(thresholds[None, :] - scores[:, None], -500, 500)
    inner = 1 / (1 + np.exp(-z))
    return np.concatenate([np.zeros((len(scores), 1)), inner, np.ones((len(scores), 1))], axis=1)
