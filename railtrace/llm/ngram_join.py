"""N-gram Jaccard join with prefix trees (operator 3).

A document is the set of its distinct word n-grams (as 64-bit hashes); two
documents link when their Jaccard similarity reaches a percentage.

1. One pass counts shingles within shards and sums the frequent ones over the
   corpus.  The most frequent ``FREQUENT`` (a fixed bound) are broadcast; they
   give the global order: rare shingles first, then by hash.  The order decides
   cost alone; links are complete under any.
2. A second pass writes each document's set size, set fingerprint and first
   shingles, these in slices by hash.  Of its first ``n - ceil(t n) + l`` two similar sets share at least
   ``l`` (a set that had fewer in common with the other would differ in more
   shingles than the similarity allows), for ``l`` from ``1`` up; ``l`` grows with
   the size.  Equal sets are one set from here on, known by the smallest id; a
   task sends its equal sets once.
3. Rows (shingle, size, set) are partitioned by shingle, one slice after the other; those of one set alone
   end here.  A set that shares fewer than ``l`` of its rows (for the smallest size it
   can link to) with any other has no links; what passages alone share falls
   away.  Of a shingle in few sets all pairs are counted, and a pair that cannot have ``l``
   of them even with its frequent shingles falls away: chance would else tie ever more
   sets as the corpus grows.  The number of pairs is bounded.  Of frequent shingles the sets that could
   share ``l`` of those are sorted by size; each set is tied to the
   first of its shingle, or to the one before it, if the sizes allow a link.
   The ties' components hold every possible link.
4. Each component is dealt into units of two chunks of about ``CHUNK`` sets and
   ``CHUNK_SHINGLES`` shingles at most, by hash, so that every pair of its sets meets in one unit.  Units
   are done in rounds, whose texts are about as many as the corpus has.  A unit stores one
   chunk's globally ordered sets in a prefix tree and takes the other chunk's sets
   through it: sets that share a path share the overlap counted so far, and a
   subtree is left when the overlap and the longest remainder cannot reach
   the required overlap.  (In a unit the order is by frequency there, highest
   first, so that near copies share long paths.)  It returns per set the unit's class
   and the number of linked documents, no pairs.
5. Components over the units' classes give the result.

Disk: a job's shuffle files go as it ends, and tables of steps as they are done with.

Defined cases: words are runs without white space, A-Z lowered; a text with
fewer words than a shingle is one shingle of all its words; a text without
words, or null, is empty and links with nothing; a null id has a null
component, and its row takes no part; rows of one id are documents of their own with
one component; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railtrace.llm.common import batch_bytes, discard, q, written
from railtrace.llm.components import components
from railtrace.llm.workers import cache, claim

WORDS = 5
PERCENT = 80
FREQUENT = 1 << 17  # shingles whose frequency is known to the order
SHARD = 1 << 20  # shingles that a task counts at once
LOCAL_COUNT = 4  # times a shingle is in a shard to be reported for the order
EXTRA = 35  # percent of a prefix that is sent beyond it
CHUNK = 1024  # sets of a chunk, about
CHUNK_SHINGLES = 1 << 21  # and shingles
MAX_WORD_HASHES = 150_000
BATCH_BYTES = 8 << 20  # of texts that a task takes at once
TABLE_BYTES = 8 << 20  # of a unit's table of shingles by sets
SLICE_BITS = 2  # the last of a shingle name its slice; the slices are shuffled one after the other
RARE = 32  # sets of a shingle whose pairs are counted
PAIR_SLICES = 8  # in which the most pairs are shuffled; few pairs need one
MARKS = 1 << 26  # bits of the filter of candidates, broadcast

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = [np.uint64(xxhash.xxh64_intdigest(f"shingle {i}") | 1) for i in range(64)]
_SHIFT = np.uint64(32)


class WordHashes(dict):
    """64-bit hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MAX_WORD_HASHES:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


_HASHES = WordHashes()
cache(_HASHES.clear)


def shingles(text: bytes | None, size: int = WORDS) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=1)], dtype=np.uint64)
    at = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    n = len(at) - size + 1
    mixed = at[:n] * _MIX[0]
    for i in range(1, size):
        mixed ^= mixed >> _SHIFT
        mixed *= _MIX[i]
        mixed += at[i:i + n]
    mixed ^= mixed >> _SHIFT
    mixed *= _MIX[size % len(_MIX)]
    mixed.sort()
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def fingerprint(shingle_set: np.ndarray) -> int:
    out = xxhash.xxh3_64_intdigest(shingle_set.tobytes())
    return out - ((out >> 63) << 64)


def frequent_shingles(docs: DataFrame, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, ascending, with their counts; ``docs`` has one column ``text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("ngram_join")
        parts, total = [], 0

        def counted():
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            keep = n >= LOCAL_COUNT
            return pa.RecordBatch.from_pydict({"shingle": found[keep].view(np.int64), "n": n[keep].astype(np.int64)})

        for batch in batches:
            for text in batch.column(0):
                parts.append(shingles(text.as_py(), size))
                total += len(parts[-1])
                if total >= SHARD:
                    yield counted()
                    parts, total = [], 0
        if total:
            yield counted()

    top = (
        docs.select(F.col("text").cast("binary")).mapInArrow(count, "shingle long, n long")
        .groupBy("shingle").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "shingle").limit(FREQUENT).toArrow()
    )
    known = top.column("shingle").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(known)
    return known[order], top.column("n").to_numpy()[order]


def prefix_length(n, percent: int):
    """How many first shingles must hold one that is shared; for integers and arrays."""
    return n - -(-percent * n // 100) + 1


def must_share(n, percent: int):
    """How many shingles two similar sets, the smaller of size n, share among those sent."""
    more = np.maximum(2, EXTRA * prefix_length(n, percent) // 100)
    return 1 + np.minimum(n - prefix_length(n, percent), more)


def first_shingles(found: np.ndarray, known: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles in global order that a set sends."""
    n = len(found)
    often = np.zeros(n, dtype=np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, found), len(known) - 1)
        often = np.where(known[at] == found, counts[at], 0)
    order = np.argsort(often, kind="stable")  # ascending hashes break ties
    return found[order[:prefix_length(n, percent) - 1 + int(must_share(n, percent))]]


def _sets(docs: DataFrame, frequent, size: int, percent: int) -> DataFrame:
    """(id, n, s, sent_0, ...) of each document; a task gives equal sets' shingles once, by slice."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("ngram_join")
        known, counts = sent.value
        none = np.zeros(0, dtype=np.uint64)
        seen: set[int] = set()
        for batch in batches:
            n, s, sent_ = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = shingles(text.as_py(), size)
                mark = fingerprint(found)
                n.append(len(found))
                s.append(mark)
                if key is None or not len(found) or mark in seen:
                    sent_.append(none)
                    continue
                if len(seen) > 1 << 20:
                    seen.clear()
                seen.add(mark)
                sent_.append(first_shingles(found, known, counts, percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(s, pa.int64()), *_sliced(sent_)],
                names=["id", "n", "s", *_SLICES],
            )

    return docs.mapInArrow(measure, "id long, n int, s long, " + ", ".join(f"{c} array<long>" for c in _SLICES))


_SLICES = [f"sent_{i}" for i in range(1 << SLICE_BITS)]


def _sliced(sent: list[np.ndarray]) -> list[pa.Array]:
    """The shingles of each slice, as lists."""
    every = np.concatenate([np.zeros(0, dtype=np.uint64), *sent])
    ends = np.concatenate([[0], np.cumsum([len(x) for x in sent], dtype=np.int64)])
    of = every & np.uint64(len(_SLICES) - 1)  # the first bits are uneven, as low hashes are sent
    out = []
    for i in range(len(_SLICES)):
        own = of == np.uint64(i)
        cuts = np.concatenate([[0], np.cumsum(own)])[ends]
        out.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(every[own].view(np.int64))))
    return out


def _shared(rows: DataFrame) -> DataFrame:
    """The rows (shingle, n, s) whose shingle another set sends too."""
    # a set that several tasks send stands together: its outer row has the other set beside it
    order = Window.partitionBy("shingle").orderBy("n", "s")
    beside = rows.withColumns({"before": F.lag(F.struct("n", "s")).over(order), "after": F.lead(F.struct("n", "s")).over(order)})
    own = F.struct("n", "s")
    return beside.where((F.col("before") != own) | (F.col("after") != own)).select("shingle", "n", "s").distinct()


def must_share_sql(n: str, percent: int) -> str:
    """``must_share`` of an SQL expression."""
    spare = f"(({n} * {percent} + 99) div 100 - 1)"  # beyond the prefix
    return f"1 + least({spare}, greatest(2, {EXTRA} * ({n} - {spare}) div 100))"


def _needed(percent: int):
    """How many of its first shingles a set with links shares: those of the smallest set that it can link to."""
    return F.expr(must_share_sql(f"((CAST(n AS BIGINT) * {percent} + 99) div 100)", percent))


def _able(rows: DataFrame, percent: int) -> DataFrame:
    """The shared rows of sets that share enough of them to have a link."""
    shares = F.count("*").over(Window.partitionBy("n", "s"))
    return rows.withColumn("shares", shares).where(F.col("shares") >= _needed(percent)).drop("shares")


def _shared_rows(sets: DataFrame, percent: int) -> DataFrame:
    """(shingle, n, s): the shared rows of sets that can have a link.  Each step is a job, so no two keep shuffle files."""
    parts = [_shared(sets.select(F.explode(c).alias("shingle"), "n", "s")) for c in _SLICES]
    rows = written(parts[0], "shared-shingles", *parts[1:])
    # the second time for what is left after sets fell away
    for step in (lambda x: _able(x, percent), _shared, lambda x: _able(x, percent)):
        old, rows = rows, written(step(rows), "shared-shingles")
        discard(old)
    return rows


def _ties(rows: DataFrame, percent: int, most_pairs: int) -> DataFrame:
    """Distinct ties (an, a, bn, b) that connect all sets that can link.

    Pairs of sets that share rare shingles are counted: those that cannot share enough, with the
    frequent shingles of both, have no link.  Sets that could share enough frequent ones are tied in stars.
    A shingle is rare if it is in few sets, ``RARE`` at most; in fewer, if there were more than ``most_pairs`` pairs.
    """
    grouped = written(
        rows.withColumn("in_sets", F.count("*").over(Window.partitionBy("shingle"))).where("in_sets > 1"), "shingle-groups"
    )
    pairs, rare = 0, 1
    for in_sets, n in sorted(grouped.where(F.col("in_sets") <= RARE).groupBy("in_sets").count().collect()):
        if pairs + n * (in_sets - 1) // 2 > most_pairs:
            break
        pairs, rare = pairs + n * (in_sets - 1) // 2, in_sets
    sets = grouped.where(F.col("in_sets") <= rare).groupBy("shingle").agg(F.sort_array(F.collect_list(F.struct("n", "s"))).alias("sets"))
    sets = written(sets.select("sets"), "shingle-sets")
    slices = max(1, -(-pairs // max(1, most_pairs // PAIR_SLICES)))

    def pairs_of(i: int) -> DataFrame:
        first = sets.select("sets", F.posexplode("sets").alias("at", "first")).where(F.pmod(F.xxhash64("first"), F.lit(slices)) == i)
        return (
            first.select("first", F.explode(F.slice("sets", F.col("at") + 2, RARE)).alias("other"))
            .select(F.col("first.n").alias("an"), F.col("first.s").alias("a"), F.col("other.n").alias("bn"), F.col("other.s").alias("b"))
            .where(f"100 * CAST(an AS BIGINT) >= {percent} * CAST(bn AS BIGINT)")
            .groupBy("an", "a", "bn", "b").agg(F.count("*").alias("shared"))
        )

    counted = written(pairs_of(0), "counted-pairs", *[pairs_of(i) for i in range(1, slices)])
    discard(sets)
    frequent = written(grouped.where(F.col("in_sets") > rare).groupBy("n", "s").agg(F.count("*").alias("frequent")), "frequent-shares")
    of = lambda n, s, c: frequent.select(F.col("n").alias(n), F.col("s").alias(s), F.col("frequent").alias(c))
    enough = f"shared + least(coalesce(of_a, 0), coalesce(of_b, 0)) >= {must_share_sql('CAST(an AS BIGINT)', percent)}"
    likely = counted.join(of("an", "a", "of_a"), ["an", "a"], "left").join(of("bn", "b", "of_b"), ["bn", "b"], "left").where(enough)
    able = frequent.where(F.col("frequent") >= _needed(percent)).select(F.col("n").alias("able_n"), F.col("s").alias("able_s"))
    left = grouped.where(F.col("in_sets") > rare).join(able, (F.col("n") == F.col("able_n")) & (F.col("s") == F.col("able_s")), "left_semi")
    ties = written(likely.select("an", "a", "bn", "b"), "ties", _stars(left, percent))
    for done in (grouped, counted, frequent):
        discard(done)
    return ties


def _stars(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct ties (an, a, bn, b) between sets that share a shingle and could link by size."""
    same = Window.partitionBy("shingle").orderBy("n", "s")
    seen = rows.select(
        "n", "s",
        F.first(F.struct("n", "s")).over(same.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("head"),
        F.lag(F.struct("n", "s")).over(same).alias("last"),
    )
    fits = lambda c: 100 * F.col(f"{c}.n").cast("long") >= percent * F.col("n").cast("long")
    tied = seen.select(
        "n", "s", F.when(fits("head"), F.col("head")).when(fits("last"), F.col("last")).alias("other")
    ).where((F.col("other.s") != F.col("s")) | (F.col("other.n") != F.col("n")))
    return tied.select(
        F.col("other.n").alias("an"), F.col("other.s").alias("a"), F.col("n").alias("bn"), F.col("s").alias("b")
    ).distinct()


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
) -> DataFrame:
    """(id, n_shingles, component_id, n_links) of each row; the id column must be an integer."""
    texts = docs.select(F.col(q(id_col)).cast("long").alias("id"), F.col(q(text_col)).cast("binary").alias("text"))
    spark = docs.sparkSession
    with batch_bytes(spark, BATCH_BYTES):
        sending = written(_sets(texts, frequent_shingles(texts.select("text"), words), words, percent), "sets")
    sets = written(sending.select("id", "n", "s"), "set-marks")
    reps = written(
        sets.where("n > 0 AND id IS NOT NULL").groupBy("n", "s").agg(F.min("id").alias("rep"), F.count("*").alias("copies")),
        "representatives",
    )
    shared = _shared_rows(sending, percent)
    discard(sending)
    shingles_of_all = sets.agg(F.sum("n")).first()[0] or 0
    tied = _ties(shared, percent, shingles_of_all)
    discard(shared)
    ties = (
        tied.join(reps.select(F.col("n").alias("an"), F.col("s").alias("a"), F.col("rep").alias("u")), ["an", "a"])
        .join(reps.select(F.col("n").alias("bn"), F.col("s").alias("b"), F.col("rep").alias("v")), ["bn", "b"])
        .select("u", "v")
    )
    candidates = components(ties)
    discard(tied)
    joined = _join_units(texts, reps, candidates, shingles_of_all, words, percent)
    classes = components(joined.select(F.col("node").alias("u"), F.col("class").alias("v")))
    degrees = joined.groupBy("node").agg(F.sum("links").alias("links"))
    result = (
        reps.join(classes.withColumnRenamed("node", "rep"), "rep", "left")
        .join(degrees.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            F.col("n").alias("r_n"), F.col("s").alias("r_s"), F.coalesce("component", "rep").alias("component_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    out = sets.select("id", "n", "s").join(result, (F.col("n") == F.col("r_n")) & (F.col("s") == F.col("r_s")), "left")
    has = F.col("id").isNotNull()
    return out.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(has, F.coalesce("component_id", "id")).alias("component_id"),
        F.when(has, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
    )


def _marked(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts of ``nodes``, and a few others, before they are shuffled: a filter of ``MARKS`` bits, whatever their number."""
    mark = lambda c: F.pmod(F.xxhash64(c), F.lit(MARKS)) + 1
    marks = (
        nodes.select(mark("node").alias("mark")).groupBy(F.expr("bitmap_bucket_number(mark)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(mark))").alias("marks"))
    )
    marked = texts.withColumn("mark", mark("id")).join(F.broadcast(marks), F.expr("bitmap_bucket_number(mark)") == F.col("bucket"))
    byte = "CAST(conv(hex(substring(marks, CAST(bitmap_bit_position(mark) div 8 + 1 AS INT), 1)), 16, 10) AS INT)"
    return marked.where(f"shiftright({byte}, CAST(bitmap_bit_position(mark) % 8 AS INT)) % 2 = 1").select(*texts.columns)


def _join_units(texts: DataFrame, reps: DataFrame, candidates: DataFrame, most: int, words: int, percent: int) -> DataFrame:
    """(node, class, links) from every unit: a class is the smallest node of a unit's links.

    Texts that go to several units are dealt in rounds of about ``most`` shingles, those of all documents.
    """
    spark = texts.sparkSession
    candidates = candidates.join(reps.withColumnRenamed("rep", "node"), "node")
    sizes = candidates.groupBy("component").agg(
        F.greatest(F.ceil(F.count("*") / CHUNK), F.ceil(F.sum("n") / CHUNK_SHINGLES)).cast("int").alias("k")
    )
    chunks = written(
        candidates.join(sizes, "component").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
        .select("component", "k", "chunk", "node", "n", "s", "copies"),
        "chunks",
    )
    dealt = chunks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select(
        "component", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
        "chunk", "node", "n", "s", "copies",
    )
    unit = ["component", "low", "high"]
    rounds = max(1, -(-(chunks.agg(F.sum(F.col("k").cast("long") * F.col("n"))).first()[0] or 0) // max(1, most)))
    near = _marked(texts, chunks)

    def units(i: int) -> DataFrame:
        own = dealt.where(F.pmod(F.xxhash64(*unit, F.lit(1)), F.lit(rounds)) == i)
        return (
            near.join(own, near["id"] == own["node"]).drop("id")
            .select(*unit, "chunk", "node", "n", "s", "copies", "text")
            .repartition(*unit)
            .sortWithinPartitions(*unit, "chunk", "node")
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("ngram_join")
        of, rows = None, []
        for batch in batches:
            columns = [batch.column(i) for i in range(9)]
            keys = list(zip(*(c.to_pylist() for c in columns[:8])))
            for i, (component, low, high, chunk, node, n, s, copies) in enumerate(keys):
                if (component, low, high) != of:
                    if rows:
                        yield _unit(rows, of, percent)
                    of, rows = (component, low, high), []
                if rows and rows[-1][1] == node:
                    continue  # a repeated row
                found = shingles(columns[8][i].as_py(), words)
                if len(found) == n and fingerprint(found) == s:  # else another text of the same id
                    rows.append((chunk, node, copies, found))
        if rows:
            yield _unit(rows, of, percent)

    classes = [units(i).mapInArrow(run, "node long, class long, links long") for i in range(rounds)]
    with batch_bytes(spark, BATCH_BYTES):  # near copies may be long texts
        joined = written(classes[0], "unit-classes", *classes[1:])
    discard(chunks)
    return joined


def _unit(rows, unit, percent: int) -> pa.RecordBatch:
    nodes = np.array([r[1] for r in rows], dtype=np.int64)
    copies = np.array([r[2] for r in rows], dtype=np.int64)
    chunk = np.array([r[0] for r in rows])
    _, low, high = unit
    index, probes = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
    classes, links = nodes.copy(), np.zeros(len(nodes), dtype=np.int64)
    for i, found in trie_join([r[3] for r in rows], index, probes, percent):
        if low == high:
            found = found[found != i]
            links[i] += copies[found].sum()
        else:
            links[i] += copies[found].sum()
            links[found] += copies[i]
        if len(found):
            own = np.unique(np.append(classes[found], classes[i]))
            if len(own) > 1:
                classes[np.isin(classes, own)] = own[0]
    return pa.RecordBatch.from_pydict({"node": nodes, "class": classes, "links": links})


def trie_join(sets: list[np.ndarray], index: np.ndarray, probes: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each set of ``index``, the sets of ``probes`` that are similar to it (it may be among them)."""
    if not len(index) or not len(probes):
        return
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    every = np.concatenate(sets)
    by = np.argsort(every, kind="stable").astype(np.int32)
    every = every[by]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    del every
    number = np.cumsum(new, dtype=np.int32) - 1  # of a shingle, by hash
    often = np.bincount(number).astype(np.int32)
    order = np.argsort(-often, kind="stable")  # by frequency here, then by hash
    shared = int((often > 1).sum())  # a shingle of one set alone adds to no overlap
    place = np.empty(len(often), dtype=np.int32)
    place[order] = np.arange(len(often), dtype=np.int32)
    at = np.empty(len(by), dtype=np.int32)
    at[by] = place[number]
    del by, new, number, place, order
    paths = []
    for i in range(len(sets)):
        path = np.sort(at[cuts[i]:cuts[i + 1]])
        paths.append(path[:np.searchsorted(path, shared)])
    del at

    leaves = sorted(index.tolist(), key=lambda i: paths[i].astype(">u4").tobytes())
    common = np.zeros(len(leaves) + 1, dtype=np.int64)  # of a leaf's path with that of the leaf before
    for j in range(1, len(leaves)):
        a, b = paths[leaves[j - 1]], paths[leaves[j]]
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        common[j] = differ[0] if len(differ) else m
    length = np.array([len(paths[i]) for i in leaves], dtype=np.int64)
    leaf_size = sizes[leaves]

    width = max(1, TABLE_BYTES // max(1, shared))
    for first in range(0, len(probes), width):
        group = probes[first:first + width]
        table = np.zeros((shared, len(group)), dtype=np.uint8)
        for j, p in enumerate(group):
            table[paths[p], j] = 1
        size = sizes[group]
        stack = [(0, len(leaves), 0, np.arange(len(group)), np.zeros(len(group), dtype=np.int64))]
        while stack:
            lo, hi, depth, live, overlap = stack.pop()
            path = paths[leaves[lo]]
            end = int(length[lo]) if hi - lo == 1 else int(common[lo + 1:hi].min())
            if end > depth:
                part = table[path[depth:end]]
                if len(live) < len(group):
                    part = part[:, live]
                overlap = overlap + part.sum(axis=0, dtype=np.int64)
            # the overlap needed with the smallest set below, against what the longest path can add
            best = overlap + (int(length[lo:hi].max()) - end)
            can = (100 + percent) * best >= percent * (int(leaf_size[lo:hi].min()) + size[live])
            live, overlap = live[can], overlap[can]
            if not len(live):
                continue
            j = lo
            while j < hi and length[j] == end:  # sets that end here
                union = leaf_size[j] + size[live] - overlap
                hit = 100 * overlap >= percent * union
                if hit.any():
                    yield leaves[j], group[live[hit]]
                j += 1
            if j < hi:
                splits = [j, *(k for k in range(j + 1, hi) if common[k] == end), hi]
                for a, b in zip(splits, splits[1:]):
                    stack.append((a, b, end, live, overlap))
