"""Benchmark decontamination with an FM-index per shard (operator 8).

A shard is a run of documents in one task.  Its words, mapped to the
benchmark's vocabulary, form one sequence; words that no benchmark item has,
and ends of documents, are symbol 0.  Over it the task builds an FM-index: the
Burrows-Wheeler transform held in a wavelet tree, the counts of smaller
symbols, and sampled suffix positions.  Every test window is searched backwards
by rank queries, all windows at a time; its occurrences are located by walking
to a sampled position; the spans they cover are merged.

Each symbol 0 counts as an end marker of its own, in order of position, so a
suffix is ordered by its words up to the next 0.  Suffixes that start with a 0
need no order: no window holds it, so no interval lies among them, and
positions after a 0 are always sampled, so a walk never enters them.

The benchmark is a stated query set.  Tasks deal its items to blocks of about
``BLOCK_WORDS`` words and write each block's vocabulary and windows to the shared folder; the
tasks that scan read them there, each shard against every block, in one pass over the
documents, which are not shuffled.  The driver holds the names of the blocks alone.

Defined cases: a null text has no words; an item without words has no window;
an item shorter than a window is one window; equal items each count; repeated
documents each get their row; tables may be empty; other columns pass through,
but for those named like an added one, which is replaced.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railtrace.llm.common import map_batches, q, shared_path
from railtrace.llm.token_files import _filesystem
from railtrace.llm.workers import cache, claim

WINDOW = 10
SHARD_WORDS = 1 << 20  # words of a shard, but for a longer document
SAMPLE = 16  # every so many positions one is sampled
BLOCK_WORDS = 1 << 21  # words of a block of the benchmark, about
HELD_BLOCKS = 2  # that a worker holds at once

# words are runs of 0-9, a-z and all above ASCII; A-Z are lower-cased
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class WaveletTree:
    """Ranks over a sequence of symbols: one bit plane per bit, the highest first."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.planes, self.zeros = bits, [], []
        for b in range(bits - 1, -1, -1):
            plane = ((symbols >> b) & 1).astype(bool)
            ones = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(plane, out=ones[1:])
            self.planes.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[~plane], symbols[plane]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before position ``at``; both are arrays."""
        low, high = np.zeros_like(at), at
        for b, ones, zeros in zip(range(self.bits - 1, -1, -1), self.planes, self.zeros):
            one = ((symbol >> b) & 1).astype(bool)
            ones_low, ones_high = ones[low], ones[high]
            low = np.where(one, zeros + ones_low, low - ones_low)
            high = np.where(one, zeros + ones_high, high - ones_high)
        return high - low

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and how often it stands before it."""
        symbol, low, high = np.zeros_like(at), np.zeros_like(at), at
        for ones, zeros in zip(self.planes, self.zeros):
            before = ones[high]
            one = ones[high + 1] > before
            ones_low = ones[low]
            low = np.where(one, zeros + ones_low, low - ones_low)
            high = np.where(one, zeros + before, high - before)
            symbol = 2 * symbol + one
        return symbol, high - low


class FMIndex:
    """Backward search over a sequence of symbols below ``1 << bits``; 0 is never searched."""

    def __init__(self, text: np.ndarray, bits: int, sample: int = SAMPLE):
        n = len(text)
        text = np.append(text, 0).astype(np.int64)  # ends with a separator
        suffixes = np.concatenate([np.flatnonzero(text == 0), _sorted_suffixes(text, bits)])
        previous = text[suffixes - 1]  # position 0 is preceded by the last symbol, a 0
        counts = np.bincount(text, minlength=1 << bits)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.tree = WaveletTree(previous, bits)
        kept = (suffixes % sample == 0) | (previous == 0)
        self.sampled = np.zeros(n + 2, dtype=np.int32)
        np.cumsum(kept, out=self.sampled[1:])
        self.positions = suffixes[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of suffixes that start with each pattern; patterns end at the matrix's right edge."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), len(self.sampled) - 1, dtype=np.int64)
        width = patterns.shape[1]
        live = np.arange(len(patterns))
        for step in range(width):
            live = live[(lengths[live] > step) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = patterns[live, width - 1 - step]
            base = self.first[symbol]
            low[live] = base + self.tree.rank(symbol, low[live])
            high[live] = base + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The position of each row's suffix."""
        out = np.zeros(len(rows), dtype=np.int64)
        steps, todo = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
        rows = rows.copy()
        while len(todo):
            here = rows[todo]
            kept = self.sampled[here + 1] > self.sampled[here]
            done = todo[kept]
            out[done] = self.positions[self.sampled[rows[done]]] + steps[done]
            todo = todo[~kept]
            symbol, before = self.tree.access(rows[todo])
            rows[todo] = self.first[symbol] + before
            steps[todo] += 1
        return out


def _sorted_suffixes(text: np.ndarray, bits: int) -> np.ndarray:
    """The positions of symbols other than 0, by their words up to the next 0, then by position.

    Several symbols make one integer key; suffixes that go on beyond it are
    ordered by doubling.  Only those whose run is at least as long as what is compared
    so far take part in a round, so that one that ends there comes before those that go on;
    equal suffixes end at the same distance, so a stable sort leaves them by position.
    """
    at = np.flatnonzero(text)
    if not len(at):
        return at
    zeros = np.flatnonzero(text == 0)
    run = zeros[np.searchsorted(zeros, at)] - at
    done = max(1, 62 // bits)  # symbols that one integer holds
    padded = np.concatenate([text, np.zeros(done, dtype=text.dtype)])
    key, alive = text[at], np.ones(len(at), dtype=bool)
    for i in range(1, done):
        symbol = padded[at + i]
        alive &= symbol != 0
        key = (key << bits) | np.where(alive, symbol, 0)
    order = np.argsort(key, kind="stable")
    rank = np.empty(len(at), dtype=np.int64)  # where the suffix's group of equals starts
    rank[order] = _group_starts(key[order])
    rank_at = np.zeros(len(text) + 1, dtype=np.int64)
    while True:
        open_ = np.flatnonzero(run >= done)
        if not len(open_):
            return at[np.argsort(rank, kind="stable")]
        rank_at[at] = rank + 1  # 0 for an end
        first, second = rank[open_], rank_at[at[open_] + done]
        by = np.lexsort((second, first))
        first, second = first[by], second[by]
        group, subgroup = _group_starts(first), _group_starts(first * (len(at) + 1) + second)
        rank[open_[by]] = first + subgroup - group
        done *= 2


def _group_starts(values: np.ndarray) -> np.ndarray:
    """For each of sorted values, where its group of equals starts."""
    new = np.concatenate([[True], values[1:] != values[:-1]])
    return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))


class Symbols(dict):
    """Numbers of the benchmark's words; 0 for any other."""

    def __missing__(self, word: bytes) -> int:
        return 0


class Windows:
    """A block of the benchmark: its vocabulary, distinct windows and the items that have each."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int = WINDOW):
        self.window = window
        self.symbols = Symbols()
        owners: dict[tuple[int, ...], set[str | None]] = {}
        for item, text in items:
            codes = [self.symbols.setdefault(w, len(self.symbols) + 1) for w in words_of(text)]
            for i in range(max(1, len(codes) - window + 1) if codes else 0):
                owners.setdefault(tuple(codes[i:i + window]), set()).add(item)
        self.bits = max(1, len(self.symbols).bit_length())
        self.lengths = np.array([len(w) for w in owners], dtype=np.int64)
        self.patterns = np.zeros((len(owners), window), dtype=np.int64)
        for i, w in enumerate(owners):
            self.patterns[i, window - len(w):] = w
        self.items = [_by_name(s) for s in owners.values()]

    def hits(self, shard: list[list[bytes]]):
        """For each document: merged spans of word numbers, and the items that occur."""
        sizes = np.array([len(d) for d in shard], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        known = self.symbols.__getitem__
        text = np.zeros(int((sizes + 1).sum()), dtype=np.int64)
        for s, d in zip(starts, shard):
            text[s:s + len(d)] = np.fromiter(map(known, d), dtype=np.int64, count=len(d))
        index = FMIndex(text, self.bits)
        low, high = index.search(self.patterns, self.lengths)
        found = high - low
        which = np.repeat(np.arange(len(found)), found)
        rows = np.repeat(low - np.concatenate([[0], np.cumsum(found)])[:-1], found) + np.arange(int(found.sum()))
        at = index.locate(rows)
        owner = np.searchsorted(starts, at, side="right") - 1
        out: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in shard]
        by = np.lexsort((at, owner))
        for d, w, p in zip(owner[by].tolist(), which[by].tolist(), (at - starts[owner])[by].tolist()):
            spans, items = out[d]
            end = p + int(self.lengths[w])
            if spans and p <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
            else:
                spans.append((p, end))
            items.update(self.items[w])
        return out


def write_blocks(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
    unnamed: bool = False,
) -> list[str]:
    """Files of the benchmark's blocks in the shared folder, made and written by tasks.

    Items are dealt to blocks by hash, as many as their bytes ask for; the driver sees the number of
    bytes and the files' names."""
    spark = benchmark.sparkSession
    folder = shared_path(spark, "benchmark")
    rows = benchmark.select(F.col(q(id_col)).cast("string").alias("i"), F.col(q(text_col)).cast("binary").alias("t"))
    rows = rows.where("t IS NOT NULL" if unnamed else "i IS NOT NULL AND t IS NOT NULL")
    n = max(1, -(-(rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // (8 * block_words)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for block, items in groupby(members, key=lambda r: r[0]):
            files, base = _filesystem(folder)
            files.create_dir(base, recursive=True)
            part = f"{base}/.block-{block:06d}-{TaskContext.get().taskAttemptId()}"
            with files.open_output_stream(part) as out:
                out.write(pickle.dumps(Windows([(i, t) for _, i, t in items], window)))
            files.move(part, f"{base}/block-{block:06d}")  # a task that runs again replaces it
            yield pa.RecordBatch.from_pydict({"path": pa.array([f"{folder}/block-{block:06d}"])})

    dealt = rows.select(F.pmod(F.xxhash64("i", "t"), F.lit(n)).alias("b"), "i", "t").repartition(n, "b").sortWithinPartitions("b", "i")
    return sorted(r.path for r in dealt.mapInArrow(build, "path string").collect())


_BLOCKS: dict[str, Windows] = {}
cache(_BLOCKS.clear)


def _block(path: str) -> Windows:
    """A block, read from the shared folder; a worker holds the last ones."""
    if path not in _BLOCKS:
        if len(_BLOCKS) >= HELD_BLOCKS:
            _BLOCKS.clear()
        files, base = _filesystem(path)
        with files.open_input_file(base) as file:
            _BLOCKS[path] = pickle.loads(file.read())
    return _BLOCKS[path]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
    clean: bool = False, block_words: int = BLOCK_WORDS, unnamed: bool = False,
) -> DataFrame:
    """The documents' columns plus ``n_words_``, ``spans_`` (merged, in word numbers) and ``items_``.

    With ``clean`` the text has the spans cut out, from the first word of a span to its last.
    The documents are read once; each shard is searched for every block.  Items without an id are left
    out; with ``unnamed`` their windows count too, all as one item that is null in ``items_``.
    """
    passed = docs.select(*[F.col(q(c)) for c in docs.columns if c not in ("n_words_", "spans_", "items_")])
    paths = write_blocks(benchmark, item_col, item_text_col, window, block_words, unnamed)
    text_at = passed.columns.index(text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("fm_index")
        for batch in batches:
            start, size, shard = 0, 0, []
            texts = batch.column(text_at).cast(pa.binary())
            for i in range(batch.num_rows):
                words = words_of(texts[i].as_py())
                shard.append(words)
                size += len(words)
                if size >= SHARD_WORDS or i == batch.num_rows - 1:
                    yield _result(batch.slice(start, i + 1 - start), shard, _hits(paths, shard), clean, text_at)
                    start, size, shard = i + 1, 0, []

    return map_batches(passed, scan, "n_words_ long, spans_ array<struct<start:int,end:int>>, items_ array<string>")


def _hits(paths: list[str], shard: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """The shard's hits of all blocks, joined per document."""
    out: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in shard]
    for path in paths:
        for d, (spans, items) in enumerate(_block(path).hits(shard)):
            if spans:
                out[d] = _merged(out[d][0] + spans), out[d][1] | items
    return out


def _result(batch: pa.RecordBatch, shard, hits, clean: bool, text_at: int) -> pa.RecordBatch:
    columns = batch.columns
    if clean:
        texts = [cut_spans(t, spans) if spans else t for t, (spans, _) in zip(columns[text_at].to_pylist(), hits)]
        columns[text_at] = pa.array(texts, type=columns[text_at].type)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    extra = [
        pa.array([len(d) for d in shard], pa.int64()),
        pa.array([[{"start": a, "end": b} for a, b in spans] for spans, _ in hits], span),
        pa.array([_by_name(items) for _, items in hits], pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays([*columns, *extra], names=[*batch.schema.names, "n_words_", "spans_", "items_"])


def _by_name(items: set[str | None]) -> list[str | None]:
    return sorted(items, key=lambda i: (i is not None, i or ""))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans of word numbers."""
    data = text.encode()
    plain = np.frombuffer(data.translate(_TABLE), dtype=np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[0], plain.view(np.int8), [0]])))
    begins, ends = edges[0::2], edges[1::2]
    out, at = [], 0
    for a, b in spans:
        out.append(data[at:begins[a]])
        at = int(ends[b - 1])
    return b"".join([*out, data[at:]]).decode()


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
