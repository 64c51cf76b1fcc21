"""Vector bin packing of examples into sequences (operator 1).

A sequence has three limits at once: tokens, segments (pieces of examples) and
loss-bearing tokens.  The dot-product heuristic fills one sequence at a time:
of the examples that fit whole, it takes the one whose demand vector has the
largest weighted dot product with the sequence's residual capacity; a
dimension's weight is the mean demand for it.  When none fits whole and cutting
is allowed, the example with the largest product is cut to fill the rest; its
remainder goes back to the pool.  An example over a limit is cut up first.

An example's loss-bearing tokens are its last ``n_loss`` tokens (prompt, then
response), so a cut knows the loss of either piece.

Each task packs the rows it reads, in pools of ``POOL`` examples; sequences
that are not full go back to the pool, so a task ends with one remainder.  Where
the limit of segments or loss binds, most of a pool gets no fuller and leaves it at once.
With cutting, both become sequences at powers of two (which need no padding).  There is no shuffle, and memory is bounded by the pool.  Sequence
ids hold the task's partition number, so no two tasks share one.  The input
should be a written table: a retried task then packs the same rows.

Defined cases: a null or empty text is the end id alone; examples of 0 tokens
give no piece; a null id is carried through; repeated rows are packed each; an
empty table gives an empty result; other columns are not read.  Without
cutting, an example over a limit raises ``ValueError``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtrace.llm.common import q

POOL = 4096  # examples that are packed together
SEQUENCE_BITS = 40  # of a sequence id; those above hold the partition number


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 128
    loss: int = 4096


def loss_within(start: int, end: int, n: int, n_loss: int) -> int:
    """Loss-bearing tokens among tokens start..end of an example of n tokens."""
    return max(0, end - max(start, n - n_loss))


def _longest(start: int, n: int, n_loss: int, tokens: int, loss: int) -> int:
    """The longest piece from ``start`` within so many tokens and loss-bearing tokens."""
    end = min(n, start + tokens)
    return min(end, max(start, n - n_loss) + loss) - start


class Packer:
    """Packs examples pool by pool; ``add`` and ``finish`` give finished sequences.

    A sequence is a list of (example, start, length); an example is an index of
    the caller, with its tokens and loss-bearing tokens.
    """

    def __init__(self, limits: Limits = Limits(), cut: bool = True, pool: int = POOL):
        self.limits, self.cut, self.pool = limits, cut, pool
        self.waiting: list[tuple[int, int, int, int, int]] = []  # example, start, end, n, n_loss

    def add(self, example: int, n: int, n_loss: int) -> list[list[tuple[int, int, int]]]:
        out, start, lim = [], 0, self.limits
        while n - start > lim.tokens or loss_within(start, n, n, n_loss) > lim.loss:
            if not self.cut:
                raise ValueError(f"an example of {n} tokens, {n_loss} loss-bearing, is over the limits {lim}")
            length = _longest(start, n, n_loss, lim.tokens, lim.loss)
            if length == lim.tokens:
                out.append([(example, start, length)])
            else:
                self.waiting.append((example, start, start + length, n, n_loss))
            start += length
        if n - start == lim.tokens:
            out.append([(example, start, n - start)])
        elif n > start:
            self.waiting.append((example, start, n, n, n_loss))
        if len(self.waiting) >= self.pool:
            full, rest = self._pack()
            out += full
            self.waiting = [p for bin_ in rest for p in bin_]
            if len(self.waiting) > self.pool // 2:  # limits other than tokens bind: those are as full as they get
                out += self._ended(rest)
                self.waiting = []
        return out

    def finish(self) -> list[list[tuple[int, int, int]]]:
        full, rest = self._pack()
        self.waiting = []
        return full + self._ended(rest)

    def _ended(self, rest) -> list[list[tuple[int, int, int]]]:
        """Sequences of what gets no fuller; with cutting, at powers of two."""
        return [s for b in rest for s in (_at_powers_of_two(_pieces(b)) if self.cut else [_pieces(b)])]

    def _pack(self):
        """Full sequences as pieces, and the others as examples."""
        lim = self.limits
        rows = list(self.waiting)
        size = np.array([e - s for _, s, e, _, _ in rows], dtype=np.int64)
        loss = np.array([loss_within(s, e, n, k) for _, s, e, n, k in rows], dtype=np.int64)
        left = np.ones(len(rows), dtype=bool)
        cap = np.array([lim.tokens, lim.segments, max(1, lim.loss)], dtype=float)
        demand = np.stack([size, np.ones_like(size), loss], axis=1) / cap if rows else np.zeros((0, 3))
        weight = demand.mean(axis=0) if rows else np.zeros(3)
        full, rest, n_left = [], [], len(rows)
        while n_left:
            free = np.array([lim.tokens, lim.segments, lim.loss], dtype=np.int64)
            bin_: list[tuple[int, int, int, int, int]] = []
            while n_left and free[0] and free[1]:
                product = demand @ (weight * free / cap)
                fits = left & (size <= free[0]) & (loss <= free[2])
                if fits.any():
                    i = int(np.argmax(np.where(fits, product, -1.0)))
                    bin_.append(rows[i])
                    free -= (size[i], 1, loss[i])
                    left[i] = False
                    n_left -= 1
                    continue
                if not self.cut:
                    break
                i = int(np.argmax(np.where(left, product, -1.0)))
                example, s, e, n, k = rows[i]
                length = min(_longest(s, n, k, int(free[0]), int(free[2])), e - s)
                if length <= 0:
                    break
                bin_.append((example, s, s + length, n, k))
                free -= (length, 1, loss_within(s, s + length, n, k))
                rows[i] = (example, s + length, e, n, k)
                size[i], loss[i] = e - s - length, loss_within(s + length, e, n, k)
                demand[i] = np.array([size[i], 1, loss[i]]) / cap
            if free[0] == 0:
                full.append(_pieces(bin_))
            else:
                rest.append(bin_)
            if n_left < len(rows) // 2:  # drop what is placed
                rows = [r for r, keep in zip(rows, left) if keep]
                size, loss, demand, left = size[left], loss[left], demand[left], left[left]
        return full, rest


def _pieces(bin_) -> list[tuple[int, int, int]]:
    return [(example, s, e - s) for example, s, e, _, _ in bin_]


def _at_powers_of_two(pieces) -> list[list[tuple[int, int, int]]]:
    """Cuts a sequence into sequences whose lengths are powers of two."""
    total, out, pieces = sum(p[2] for p in pieces), [], list(pieces)
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        sequence = []
        while room:
            example, start, length = pieces.pop(0)
            take = min(length, room)
            sequence.append((example, start, take))
            if take < length:
                pieces.insert(0, (example, start + take, length - take))
            room -= take
        out.append(sequence)
    return out


_PIECE_FIELDS = "start long, length long, {crc}doc_tokens long, sequence_id long, offset long, loss_tokens long"


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, limits: Limits = Limits(),
    id_col: str = "doc_id", text_col: str = "text", pool: int = POOL,
) -> DataFrame:
    """Pieces of every document: its ids and then ``end_id``, every token bearing loss.

    Returns the id, start, length, ids_crc32, doc_tokens, sequence_id, offset and loss_tokens.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from railtrace.llm.tokens import encoder

        enc = encoder(tokenizer)
        end = np.array([end_id], dtype=enc.dtype).tobytes()

        def examples():
            for batch in batches:
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = np.frombuffer(enc.ids(text.as_py()) + end, dtype=enc.dtype)
                    yield key, len(ids), len(ids), ids

        yield from _packed(examples(), limits, True, pool, schema)

    rows = docs.select(F.col(q(id_col)).alias("id"), F.col(q(text_col)).cast("binary").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = _schema(id_type, crc=True)
    out = rows.mapInArrow(pack, f"id {id_type}, " + _PIECE_FIELDS.format(crc="ids_crc32 long, "))
    return out.withColumnRenamed("id", id_col)


def pack_examples(
    examples: DataFrame, id_col: str, tokens_col: str, loss_col: str,
    limits: Limits = Limits(), cut: bool = False, pool: int = POOL,
) -> DataFrame:
    """Pieces of examples that are given by their counts of tokens and loss-bearing tokens.

    Null counts are 0; loss-bearing tokens above the tokens count as all.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for key, n, k in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    yield key, n, k, None

        yield from _packed(rows(), limits, cut, pool, schema)

    n = F.greatest(F.coalesce(F.col(q(tokens_col)), F.lit(0)), F.lit(0)).cast("long")
    loss = F.greatest(F.coalesce(F.col(q(loss_col)), F.lit(0)), F.lit(0)).cast("long")
    rows = examples.select(F.col(q(id_col)).alias("id"), n.alias("n"), F.least(n, loss).alias("k"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = _schema(id_type, crc=False)
    out = rows.mapInArrow(pack, f"id {id_type}, " + _PIECE_FIELDS.format(crc=""))
    return out.withColumnRenamed("id", id_col)


def _schema(id_type: str, crc: bool) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    key = to_arrow_type(StructType.fromDDL(f"id {id_type}")["id"].dataType)
    names = ["start", "length", *["ids_crc32"] * crc, "doc_tokens", "sequence_id", "offset", "loss_tokens"]
    return pa.schema([("id", key), *[(c, pa.int64()) for c in names]])


def _packed(examples, limits: Limits, cut: bool, pool: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Packs (key, tokens, loss tokens, ids or None); keeps only the ids that wait in the pool."""
    packer, held = Packer(limits, cut, pool), {}
    sequence = TaskContext.get().partitionId() << SEQUENCE_BITS
    out: list[tuple] = []

    def emit(sequences) -> None:
        nonlocal sequence
        for pieces in sequences:
            offset = 0
            for example, start, length in pieces:
                key, n, k, ids = held[example][:4]
                crc = () if ids is None else (zlib.crc32(ids[start:start + length].astype("<u4").tobytes()),)
                out.append((key, start, length, *crc, n, sequence, offset, loss_within(start, start + length, n, k)))
                offset += length
                held[example][4] -= length
                if not held[example][4]:
                    del held[example]
            sequence += 1

    for i, (key, n, k, ids) in enumerate(examples):
        if n:
            held[i] = [key, n, k, ids, n]
            emit(packer.add(i, n, k))
        if len(out) >= 20_000:
            yield _batch(out, schema)
            out.clear()
    emit(packer.finish())
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
