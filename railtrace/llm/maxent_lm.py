"""Hashed maximum-entropy language model with class-factored softmax (operator 13).

P(word | history) = P(class | history) * P(word | class, history).  The most frequent
``CLASSES * MEMBERS`` words are dealt into classes by rank and have a softmax over the members of
their class; other words of the dictionary are in classes by the octave of their count, and all
words beyond it in one class, with fixed shares there (absolute discounting; one event
stands for every unknown word).  Both softmaxes are maximum-entropy models whose features are
hashed: of a class the word before and the two words before, of a member the word before and
the one before that alone (a skip).

Counting covers all learning texts: tasks pre-count, Spark sums.  Training sees every learning text
once: in each of ``ROUNDS`` rounds tasks take a share of the texts, make gradient steps from
the broadcast weights (AdaGrad over numpy batches), and give their changes row by row;
changes are averaged by how often a row was used, block by block, in the order of the tasks;
their number follows the tokens, so what they send grows with the texts.  Targets are
left-one-out: a word is learned as if it had been seen once less, so that rare words teach
what unknown words do.  Scoring is one pass in numpy batches; only words beyond the dictionary are
joined to their counts, so nothing of the corpus' vocabulary is broadcast but the
dictionary (at most ``WORDS`` words of at most ``WORD_BYTES`` bytes).

The base score is that of a unigram model with add-one smoothing over all words counted.

Defined cases: a null or empty text is its end token alone; rows with a null id learn
like any other unless the caller's condition says no; without learning texts every token is unknown, and
scores are 0; repeated rows score alike; an empty table gives an empty result; other columns
are left alone and may have any names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from railtrace.llm.common import batch_bytes, q, written

WORDS, WORD_BYTES = 1 << 18, 64  # the dictionary, at most
LEAST_COUNT = 2  # of a word of the dictionary
CLASSES, MEMBERS = 16, 64
BITS = 16  # of the hashed rows of either softmax
ROUNDS = 2
RATE = 0.12
STEP = 32_768  # tokens of a gradient step or scoring batch
BLOCK = 1024  # rows of weights that travel together
HELD_WORDS = 400_000  # distinct words that a counting task holds
TASK_TOKENS = 4_000_000  # that one task of a round learns, about; each sends its changed rows once
PIECE = 4 << 20  # bytes of a text that are split at once
BATCH = 8 << 20  # bytes of an Arrow batch, about
END = b""  # the end token's place among the words

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SPACE = b" \t\n\r\x0b\x0c"


def pieces(text: bytes | None) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, some megabytes at a time, and the end token."""
    text, at = text or b"", 0
    while at < len(text):
        to = at + PIECE
        while to < len(text) and text[to] not in SPACE:
            to += 1
        yield text[at:to].translate(LOWER).split()
        at = to
    yield [END]


def _texts(batch: pa.RecordBatch, at: int) -> list[bytes | None]:
    return batch.column(at).cast(pa.large_binary() if pa.types.is_large_string(batch.column(at).type) else pa.binary()).to_pylist()


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word`` and ``n``: how often each token is in the texts; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for text in _texts(batch, 0):
                for words in pieces(text):
                    held.update(words)
                    if len(held) >= HELD_WORDS:
                        yield flush()
        if held:
            yield flush()

    counted = docs.select(F.col(q(text_col)).cast("string").alias("text")).mapInArrow(run, "word binary, n long")
    with batch_bytes(docs.sparkSession, BATCH):
        return written(counted.groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")


@dataclass(frozen=True)
class Vocabulary:
    """The dictionary by falling count, and what is known of the words beyond it."""

    words: bytes  # joined by line ends
    counts: np.ndarray
    tokens: int  # in the learning texts
    types: int
    tail_tokens: int
    tail_types: int
    discount: float

    @property
    def least(self) -> int:
        return int(self.counts[-1]) if len(self.counts) else 0

    @property
    def unknown(self) -> float:
        """The share of unknown words among those beyond the dictionary."""
        return self.discount * self.tail_types / self.tail_tokens if self.tail_tokens else 1.0

    def base(self, counts):
        return np.log10((counts + 1) / (self.tokens + self.types + 1))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The dictionary: the most frequent words, to the finest band of counts that fits ``WORDS``."""
    band = "CAST(floor(log2(n) * 16) AS INT)"
    fits = f"length(word) <= {WORD_BYTES} AND n >= {LEAST_COUNT}"
    sizes = counts.groupBy(F.expr(band).alias("band")).agg(
        F.sum("n").alias("tokens"), F.count("*").alias("types"), F.count_if(F.expr(fits)).alias("fit"),
        F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos"),
    ).orderBy(F.desc("band")).collect()  # a row per band
    room, lowest = WORDS, None
    for r in sizes:
        room -= r.fit
        if room < 0:
            break
        lowest = r.band
    held = counts.where(f"{fits} AND {band} >= {lowest}" if lowest is not None else "false").toArrow()
    rows = sorted(zip(held.column("n").to_pylist(), held.column("word").to_pylist()), key=lambda r: (-r[0], r[1]))
    tokens, types = (sum(r[c] for r in sizes) for c in ("tokens", "types"))
    ones, twos = (sum(r[c] for r in sizes) for c in ("ones", "twos"))
    number = np.array([r[0] for r in rows], dtype=np.int64)
    discount = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones else 0.1
    return Vocabulary(
        b"\n".join(r[1] for r in rows), number, tokens, types, tokens - int(number.sum()), types - len(rows), discount
    )


class Words(dict):
    """Numbers of the dictionary's words; -1 for others."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(zip(vocabulary.words.split(b"\n"), range(len(vocabulary.counts))))

    def __missing__(self, word: bytes) -> int:
        return -1


class Classes:
    """Classes of the dictionary's words: by rank (with members), by octave of the count, and the rest."""

    def __init__(self, v: Vocabulary):
        n = len(v.counts)
        head = min(n, CLASSES * MEMBERS)
        self.n_head = -(-head // MEMBERS)
        octave = np.log2(np.maximum(1, v.counts)).astype(np.int64)
        low = int(octave[-1]) if n else 0
        self.tail = self.n_head + (int(octave[head]) - low + 1 if n > head else 0)
        self.n = self.tail + 1
        rank = np.arange(n)
        self.of = np.where(rank < head, rank // MEMBERS, self.n_head + octave - low).astype(np.int32)
        self.member = (rank % MEMBERS).astype(np.int32)
        # as if each word had been seen once less
        less = np.log2(np.maximum(1, v.counts - 1)).astype(np.int64)
        target = np.where(v.counts - 1 >= max(v.least, LEAST_COUNT), self.n_head + np.maximum(less, low) - low, self.tail)
        self.target = np.where(rank < head, self.of, np.minimum(target, self.tail)).astype(np.int32)
        # of the last place: words that the dictionary lacks (number -1)
        self.of, self.target = np.append(self.of, self.tail).astype(np.int32), np.append(self.target, self.tail).astype(np.int32)
        self.member = np.append(self.member, 0).astype(np.int32)
        mass = np.bincount(self.of[:-1], weights=v.counts, minlength=self.n)
        self.within = np.append(np.where(rank < head, 0.0, np.log(v.counts / np.maximum(1, mass[self.of[:-1]]))), 0.0)
        learned = np.bincount(self.target[:-1], weights=v.counts, minlength=self.n)
        learned[self.tail] += v.tail_tokens
        self.bias = np.log((learned + 0.5) / (learned + 0.5).sum()).astype(np.float32)
        share = np.full(self.n_head * MEMBERS, -30.0, dtype=np.float32)  # places without a word
        share[:head] = np.log(v.counts[:head] / np.maximum(1, mass[self.of[:head]]))
        self.shares = share.reshape(self.n_head, MEMBERS)


def _place(salt: int, *parts: np.ndarray) -> np.ndarray:
    """Hashed row numbers of features."""
    h = np.full(parts[0].shape, salt * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
    for p in parts:
        h = (h ^ p.astype(np.uint32)) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return ((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)).astype(np.int64)


class Softmax:
    """A maximum-entropy model over ``width`` outcomes: hashed rows of weights beside fixed shares.

    Batches use the same buffers again; sums avoid BLAS, whose threads would fight over a task's core.
    """

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.rows, self.width = weights.shape
        self.logits, self.taken = (np.empty((STEP, self.width), dtype=np.float32) for _ in range(2))

    def learn(self) -> None:
        self.start = self.weights.copy()
        self.used = np.zeros(self.rows)
        self.squares = np.full(self.rows, 1e-3, dtype=np.float32)
        self.sums = np.zeros((self.rows, self.width), dtype=np.float32)
        self.flat = np.empty((STEP, self.width), dtype=np.int64)
        self.columns = np.arange(self.width)

    def odds(self, shares: np.ndarray, places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Exponentials of the logits, and their sums."""
        n = len(places[0])
        logits, taken = self.logits[:n], self.taken[:n]
        logits[:] = shares
        for p in places:
            self.weights.take(p, 0, out=taken, mode="clip")
            logits += taken
        np.clip(logits, -60, 60, out=logits)
        np.exp(logits, out=logits)
        return logits, np.einsum("ij->i", logits)

    def step(self, shares: np.ndarray, places: list[np.ndarray], target: np.ndarray) -> None:
        slopes, total = self.odds(shares, places)
        n = len(target)
        slopes *= (1 / total)[:, None]
        slopes[np.arange(n), target] -= 1
        times = np.zeros(self.rows, dtype=np.int64)
        for p in places:
            flat = np.add((p * self.width)[:, None], self.columns, out=self.flat[:n])
            np.add.at(self.sums.reshape(-1), flat.reshape(-1), slopes.reshape(-1))
            times += np.bincount(p, minlength=self.rows)
        touched = np.flatnonzero(times)
        change = self.sums.take(touched, 0)
        self.sums[touched] = 0
        self.used += times
        squares = self.squares[touched] + np.einsum("ij,ij->i", change, change) / self.width
        self.squares[touched] = squares
        change *= (RATE / np.sqrt(squares))[:, None]
        self.weights[touched] -= change


class Model:
    """The two softmaxes over a vocabulary, in one worker."""

    def __init__(self, vocabulary: Vocabulary, weights: tuple[np.ndarray, np.ndarray]):
        self.v, self.words, self.classes = vocabulary, Words(vocabulary), Classes(vocabulary)
        self.of_class, self.of_member = Softmax(weights[0]), Softmax(weights[1])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.words.__getitem__, words), dtype=np.int32, count=len(words))

    def history(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the word before and the one before that, of texts that begin at ``starts``."""
        n = len(self.v.counts)
        known = np.where(ids < 0, n, ids)
        one, two = np.empty_like(known), np.empty_like(known)
        one[1:], two[2:] = known[:-1], known[:-2]
        one[starts] = two[starts] = n + 1
        after = starts + 1
        two[after[after < len(ids)]] = n + 1
        return one, two

    def _class_places(self, one, two):
        return [_place(1, one), _place(2, one, two)]

    def _member_places(self, one, two, of):
        return [_place(4, one, of), _place(5, two, of)]

    def learn(self, ids: np.ndarray, starts: np.ndarray) -> None:
        one, two = self.history(ids, starts)
        for i in range(0, len(ids), STEP):
            part = slice(i, i + STEP)
            x, a, b = ids[part], one[part], two[part]
            self.of_class.step(self.classes.bias, self._class_places(a, b), self.classes.target[x])
            head = self.classes.of[x] < self.classes.n_head
            if head.any():
                x, of = x[head], self.classes.of[x[head]]
                self.of_member.step(self.classes.shares[of], self._member_places(a[head], b[head], of), self.classes.member[x])

    def log_odds(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural log probabilities of tokens; of words beyond the dictionary, of their class alone."""
        one, two = self.history(ids, starts)
        out = np.empty(len(ids))
        for i in range(0, len(ids), STEP):
            part = slice(i, i + STEP)
            x, a, b = ids[part], one[part], two[part]
            of = self.classes.of[x]
            odds, total = self.of_class.odds(self.classes.bias, self._class_places(a, b))
            found = np.log(odds[np.arange(len(x)), of] / total) + self.classes.within[x]
            head = np.flatnonzero(of < self.classes.n_head)
            if len(head):
                of = of[head]
                odds, total = self.of_member.odds(self.classes.shares[of], self._member_places(a[head], b[head], of))
                found[head] += np.log(odds[np.arange(len(head)), self.classes.member[x[head]]] / total)
            out[part] = found
        return out


def new_weights(v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Weights before training: the shares alone speak."""
    return np.zeros((1 << BITS, Classes(v).n), dtype=np.float32), np.zeros((1 << BITS, MEMBERS), dtype=np.float32)


@dataclass(frozen=True)
class Trained:
    vocabulary: Vocabulary
    weights: tuple[np.ndarray, np.ndarray]
    counts: DataFrame  # of all words


def train(docs: DataFrame, learns: Column, id_col: str = "doc_id", text_col: str = "text") -> Trained:
    """Count, then train on, the rows that ``learns`` marks."""
    rows = docs.select(F.col(q(text_col)).cast("string").alias("text"), F.xxhash64(F.col(q(id_col))).alias("share"), learns.alias("learns"))
    rows = rows.where("learns")
    counts = word_counts(rows)
    v = vocabulary(counts)
    weights = new_weights(v)
    if v.tokens:
        tasks = -(-v.tokens // (ROUNDS * TASK_TOKENS))
        for k in range(ROUNDS):
            texts = rows.where(f"pmod(share, {ROUNDS}) = {k}").select("text")
            _add(weights, _changes(texts.coalesce(tasks), v, weights))
    return Trained(v, weights, counts)


def _changes(texts: DataFrame, v: Vocabulary, weights: tuple[np.ndarray, np.ndarray]):
    """Averaged changes of the weights' blocks after one pass over texts; as many as the weights have."""
    sent = texts.sparkSession.sparkContext.broadcast((v, weights))  # bounded by WORDS and BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        voc, start = sent.value
        model = Model(voc, tuple(w.copy() for w in start))
        parts = (model.of_class, model.of_member)
        for p in parts:
            p.learn()
        held, size = [], 0
        for batch in batches:
            for text in _texts(batch, 0):
                ids = np.concatenate([model.numbers(w) for w in pieces(text)])
                held.append(ids)
                size += len(ids)
                if size >= STEP:
                    model.learn(*_joined(held))
                    held, size = [], 0
        if held:
            model.learn(*_joined(held))
        task = TaskContext.get().partitionId()
        for kind, p in enumerate(parts):
            change = p.weights - p.start
            for block in range(0, p.rows, BLOCK):
                at = np.flatnonzero(p.used[block:block + BLOCK])
                if len(at):
                    yield pa.RecordBatch.from_pydict({
                        "kind": pa.array([kind], pa.int32()), "block": pa.array([block], pa.int32()), "task": pa.array([task], pa.int32()),
                        "rows": pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                        "used": pa.array([p.used[block + at].astype(np.float32).tobytes()], pa.binary()),
                        "change": pa.array([change[block + at].astype(np.float16).tobytes()], pa.binary()),
                    })

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = total = used = None

        def done():
            mean = (total / np.maximum(1, used)[:, None]).astype(np.float32)
            return pa.RecordBatch.from_pydict({
                "kind": pa.array([now[0]], pa.int32()), "block": pa.array([now[1]], pa.int32()), "change": pa.array([mean.tobytes()], pa.binary()),
            })

        for batch in batches:
            for r in batch.to_pylist():
                if now != (r["kind"], r["block"]):
                    if now is not None:
                        yield done()
                    now = r["kind"], r["block"]
                    total, used = np.zeros((BLOCK, widths[now[0]])), np.zeros(BLOCK)
                at = np.frombuffer(r["rows"], dtype=np.uint16)
                n = np.frombuffer(r["used"], dtype=np.float32).astype(np.float64)
                total[at] += np.frombuffer(r["change"], dtype=np.float16).reshape(len(at), -1).astype(np.float64) * n[:, None]
                used[at] += n
        if now is not None:
            yield done()

    widths = [w.shape[1] for w in weights]
    steps = texts.mapInArrow(run, "kind int, block int, task int, rows binary, used binary, change binary")
    dealt = steps.repartition("kind", "block").sortWithinPartitions("kind", "block", "task")
    with batch_bytes(texts.sparkSession, BATCH):
        merged = dealt.mapInArrow(merge, "kind int, block int, change binary").collect()
    sent.destroy()
    return merged


def _add(weights: tuple[np.ndarray, np.ndarray], changes) -> None:
    for r in changes:
        w = weights[r["kind"]]
        w[r["block"]:r["block"] + BLOCK] += np.frombuffer(r["change"], dtype=np.float32).reshape(-1, w.shape[1])


def _joined(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts' numbers one after the other, and where each begins."""
    return np.concatenate(held), np.cumsum([0] + [len(h) for h in held[:-1]])


FOUND = "tokens_ long, known_ long, base_ double, model_ double, tail_ array<struct<word:binary,n:int>>"


def score(docs: DataFrame, trained: Trained, carry: list[str], text_col: str = "text") -> DataFrame:
    """The ``carry`` columns plus ``n_tokens_``, ``n_known_``, ``base_score_`` and ``score_`` (log10)."""
    v = trained.vocabulary
    sent = docs.sparkSession.sparkContext.broadcast((v, trained.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, weights = sent.value
        model = Model(voc, weights)
        base = np.append(voc.base(voc.counts), 0.0)
        for batch in batches:
            texts = _texts(batch, batch.num_columns - 1)
            tokens, known, bases, scores = [], [], [], []
            beyond, times, ends = [], [], [0]  # words beyond the dictionary, text by text

            def flush(held):
                ids, starts = _joined(held)
                size = np.diff(np.append(starts, len(ids)))
                tokens.extend(size.tolist())
                known.extend(np.add.reduceat(ids >= 0, starts, dtype=np.int64).tolist())
                bases.extend(np.add.reduceat(base[ids], starts).tolist())
                scores.extend((np.add.reduceat(model.log_odds(ids, starts), starts) / math.log(10)).tolist())

            held, size = [], 0
            for text in texts:
                parts, tail = [], Counter()
                for words in pieces(text):
                    ids = model.numbers(words)
                    tail.update([words[i] for i in np.flatnonzero(ids < 0).tolist()])
                    parts.append(ids)
                beyond.extend(tail.keys())
                times.extend(tail.values())
                ends.append(len(beyond))
                held.append(np.concatenate(parts))
                size += len(held[-1])
                if size >= STEP:
                    flush(held)
                    held, size = [], 0
            if held:
                flush(held)
            tails = pa.StructArray.from_arrays([pa.array(beyond, pa.binary()), pa.array(times, pa.int32())], names=["word", "n"])
            tails = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tails)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(bases, pa.float64()),
                 pa.array(scores, pa.float64()), tails],
                names=[*batch.schema.names[:-1], "tokens_", "known_", "base_", "model_", "tail_"],
            )

    kept = [F.col(q(c)).alias(f"c{i}_") for i, c in enumerate(carry)]
    sources = docs.select(*kept, F.monotonically_increasing_id().alias("row_"), F.col(q(text_col)).cast("string").alias("text_"))
    schema = StructType(sources.schema.fields[:-1] + StructType.fromDDL(FOUND).fields)
    with batch_bytes(docs.sparkSession, BATCH):
        found = written(sources.mapInArrow(run, schema), "lm-scores")
    sent.destroy()
    beyond = trained.counts.where(f"length(word) > {WORD_BYTES} OR n <= {max(v.least, LEAST_COUNT)}")
    tails = found.select("row_", F.explode("tail_").alias("t")).select("row_", "t.word", F.col("t.n").alias("times"))
    joined = tails.join(beyond, "word", "left")
    share = f"log10((n - {v.discount!r}D) / {float(max(1, v.tail_tokens))!r}D)"
    sums = joined.groupBy("row_").agg(
        F.sum(F.expr("CASE WHEN n IS NOT NULL THEN times ELSE 0 END")).alias("more_known_"),
        F.sum(F.expr(f"times * log10((coalesce(n, 0) + 1D) / {float(v.tokens + v.types + 1)!r}D)")).alias("more_base_"),
        F.sum(F.expr(f"times * coalesce({share}, {math.log10(v.unknown)!r}D)")).alias("more_model_"),
    )
    rows = found.drop("tail_").join(sums, "row_", "left")
    return rows.select(
        *[F.col(f"c{i}_").alias(c) for i, c in enumerate(carry)], F.col("tokens_").alias("n_tokens_"),
        F.expr("known_ + coalesce(more_known_, 0)").alias("n_known_"),
        F.expr("base_ + coalesce(more_base_, 0D)").alias("base_score_"),
        F.expr("model_ + coalesce(more_model_, 0D)").alias("score_"),
    )
