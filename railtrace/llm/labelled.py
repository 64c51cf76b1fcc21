"""Bounded samples of labelled texts, and models that one task fits on them."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railtrace.llm.common import batch_bytes, q
from railtrace.llm.workers import claim, release

BATCH = 4 << 20  # bytes of texts that the fit takes at a time, about
FOLDS = 4
HELD_OUT = 2


def held_out(id_col: str) -> Column:
    """Whether a row's fold (crc32 of the id as text, mod FOLDS) is kept from learning."""
    return F.coalesce(F.crc32(F.col(q(id_col)).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def sample_labels(labels: DataFrame, id_col: str, label: Column, per_label: dict[int, int]) -> DataFrame:
    """At most ``per_label[v]`` learning rows (id, y) of each label v, by the hash of their ids."""
    rows = labels.where(~held_out(id_col)).select(F.col(q(id_col)).alias("label_id"), label.cast("int").alias("y"))
    rows = rows.where("label_id IS NOT NULL AND y IS NOT NULL").groupBy("label_id").agg(F.max("y").alias("y"))
    out = None
    for value, bound in per_label.items():
        part = rows.where(F.col("y") == value).orderBy(F.xxhash64("label_id"), "label_id").limit(bound)
        out = part if out is None else out.unionByName(part)
    return out


def fit_on(
    docs: DataFrame, sample: DataFrame, fit: Callable[[Iterable[str], list[int]], object],
    id_col: str = "doc_id", text_col: str = "text",
):
    """``fit(texts, labels)`` in one task over the sampled rows' whole texts, ordered by id.

    The texts pass as a stream; ``labels`` holds those of the texts read so far.

    ``sample`` is bounded by its limits, so it may be broadcast and its texts may meet in one task.
    """
    rows = docs.select(F.col(q(id_col)).alias("id"), F.coalesce(F.col(q(text_col)), F.lit("")).alias("text")).join(
        F.broadcast(sample), F.col("id") == F.col("label_id")
    ).select("id", "text", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("fit")
        labels: list[int] = []

        def texts() -> Iterator[str]:
            for batch in batches:
                for text, label in zip(batch.column(1), batch.column(2).to_pylist()):
                    labels.append(label)
                    yield text.as_py()

        model = fit(texts(), labels)
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})
        del model
        release()

    with batch_bytes(docs.sparkSession, BATCH):
        models = rows.repartition(1).sortWithinPartitions("id", "text").mapInArrow(run, "model binary").collect()
    return pickle.loads(models[0][0]) if models else fit([], [])  # no task runs over no rows
