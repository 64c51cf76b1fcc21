"""Quality rules with cross-document line frequency (operator 4).

Rules on one text (counts of words, symbols, repeated lines and windows) run
first.  Then lines are normalised (A-Z lowered, white space collapsed) and
hashed; for each host the documents that contain a line are counted; lines in
``least`` documents of the host or more, and in over ``per_mille`` of a thousand of its
documents, are removed, whatever the host's size; a document that
loses more than ``max_removed`` of its words is depleted and rejected.

One pass over the texts writes the counts and each document's distinct line
hashes to the shared folder; all later steps read those.  Counts per
(host, line) are summed within tasks before the shuffle; lines above the limit
are joined back on (host, line), and only their words are summed per document.
Rows bound ids from above, so a line's ids are counted only if its rows are above the limit.

Defined cases: a null or empty text has no words and fails the base rules;
lines without a word are not counted; a null host is a host; a document is a row (repeated rows count
each and get the same verdict) or, with ``ids_once``, an id (its rows count once for a
line; rows without an id count each); an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtrace.llm.common import q, written

PER_MILLE = 5  # of a host's documents that may share a line, whatever their number
LEAST_DOCS = 4  # documents that share a line before it is removed
MAX_REMOVED = 0.5  # share of a document's words that removed lines may have
MIN_WORDS = 50  # fewer fail
MAX_REPEATED = 50  # percent of words in repeated windows; more fail

SYMBOLS = b"#*$%&|<>"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "text_key long, line_keys array<long>, line_words array<int>"
)


class TextCounter:
    """Counts of one text; word numbers are kept between texts."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}

    def count(self, text: bytes) -> tuple:
        words = text.split()
        lines, seen, dup = text.split(b"\n"), set(), 0
        keys: dict[int, int] = {}
        for line in lines:
            own = line.split()
            if own:
                dup += line in seen
                seen.add(line)
                key = xxhash.xxh64_intdigest(b" ".join(own).translate(_LOWER))
                key -= (key >> 63) << 64
                keys[key] = keys.get(key, 0) + len(own)
        n_symbols = len(text) - len(text.translate(None, SYMBOLS))
        text_key = xxhash.xxh64_intdigest(text)
        return (
            len(words), len(b"".join(words).decode()), n_symbols, dup, self.repeated(words),
            text_key - ((text_key >> 63) << 64), list(keys), list(keys.values()),
        )

    def repeated(self, words: list[bytes], size: int = 3) -> int:
        """Words inside windows of so many words that occur twice or more."""
        if len(words) <= size:
            return 0
        numbers = self.numbers
        if len(numbers) > 1 << 20:
            numbers.clear()
        for w in set(words):
            numbers.setdefault(w, len(numbers))
        at = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
        n, base = len(at) - size + 1, len(numbers)
        if base ** size >= 1 << 63:  # renumber within the text
            _, at = np.unique(at, return_inverse=True)
            base = int(at.max()) + 1
        key = at[:n].copy()
        for i in range(1, size):
            key = key * base + at[i:i + n]
        ordered = np.sort(key)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            return 0
        found = np.isin(key, twice)
        covered = np.zeros(len(at), dtype=bool)
        for i in range(size):
            covered[i:i + n] |= found
        return int(covered.sum())


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host, counts, line hashes) of each row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TextCounter()
        for batch in batches:
            texts = batch.column(2)
            rows = [counter.count(texts[i].as_py() or b"") for i in range(len(texts))]
            columns = list(zip(*rows)) if rows else [()] * 8
            types = [pa.int64()] * 6 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["id", "host", *[f.split()[0] for f in _FIELDS.split(", ")]],
            )

    rows = docs.select(
        F.col(q(id_col)).alias("id"), F.col(q(host_col)).alias("host"), F.col(q(text_col)).cast("binary").alias("text")
    )
    types = dict(rows.dtypes)
    return rows.mapInArrow(count, f"id {types['id']}, host {types['host']}, {_FIELDS}")


def apply_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    per_mille: int = PER_MILLE, least: int = LEAST_DOCS, max_removed: float = MAX_REMOVED, ids_once: bool = False,
) -> DataFrame:
    """Counts and verdicts: the id, counts, ``n_removed_words``, ``base_failed`` and ``kept``."""
    counted = written(text_counts(docs, id_col, text_col, host_col), "line-counts")
    n_ids = (F.countDistinct("id") + F.count_if(F.col("id").isNull())) if ids_once else F.count("*")
    totals = counted.groupBy(F.col("host").alias("of_host")).agg(n_ids.alias("n_host"))

    def limited(counts: DataFrame) -> DataFrame:
        common = counts.where(F.col("n") >= least).join(totals, F.col("host").eqNullSafe(F.col("of_host")))
        return common.where(1000 * F.col("n") > per_mille * F.col("n_host")).select("host", "key")

    hot = limited(counted.select("host", F.explode("line_keys").alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")))
    lines = counted.select(
        "id", "host", "text_key", F.explode(F.arrays_zip("line_keys", "line_words")).alias("line")
    ).select("id", "host", "text_key", F.col("line.line_keys").alias("key"), F.col("line.line_words").alias("words"))
    if ids_once:
        hot = limited(_of_lines(lines, hot).groupBy("host", "key").agg(n_ids.alias("n")))
    removed = (
        _of_lines(lines, hot)
        .select("id", "host", "text_key", "key", "words").distinct()  # repeated rows remove the same
        .groupBy("id", "host", "text_key").agg(F.sum("words").alias("n_removed"))
        .select(F.col("id").alias("r_id"), F.col("host").alias("r_host"), F.col("text_key").alias("r_key"), "n_removed")
    )
    judged = counted.join(
        removed,
        F.col("id").eqNullSafe(F.col("r_id")) & F.col("host").eqNullSafe(F.col("r_host"))
        & (F.col("text_key") == F.col("r_key")),
        "left",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    n_removed = F.coalesce("n_removed", F.lit(0)).cast("long")
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        n_removed.alias("n_removed_words"), failed.alias("base_failed"),
        (~failed & (n_removed <= max_removed * F.col("n_words"))).alias("kept"),
    )


def _of_lines(lines: DataFrame, hot: DataFrame) -> DataFrame:
    """The rows whose (host, key) is in ``hot``."""
    named = hot.select(F.col("host").alias("hot_host"), F.col("key").alias("hot_key"))
    return lines.join(named, (F.col("key") == F.col("hot_key")) & F.col("host").eqNullSafe(F.col("hot_host")))
