import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from railtrace.llm import fm_index
from railtrace.llm.fm_index import FMIndex, WaveletTree, Windows, cut_spans, find_contamination, words_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(text, items, window=10):
    words = WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for key, item in items:
        own = WORD.findall((item or "").translate(LOWER))
        for i in range(max(1, len(own) - window + 1) if own else 0):
            w = own[i:i + window]
            for p in range(len(words) - len(w) + 1):
                if words[p:p + len(w)] == w:
                    hit.update(range(p, p + len(w)))
                    found.add(str(key))
    return len(words), hit, sorted(found)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=120), st.lists(st.integers(1, 6), min_size=1, max_size=6), st.integers(1, 20))
def test_index_counts_and_locates(symbols, pattern, sample):
    text = np.array(symbols, dtype=np.int64)
    index = FMIndex(text, bits=3, sample=sample)
    row = np.zeros((1, 8), dtype=np.int64)
    row[0, 8 - len(pattern):] = pattern
    low, high = index.search(row, np.array([len(pattern)]))
    at = sorted(index.locate(np.arange(low[0], high[0])).tolist())
    assert at == [i for i in range(len(symbols) - len(pattern) + 1) if symbols[i:i + len(pattern)] == pattern]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 15), min_size=1, max_size=80))
def test_wavelet_ranks(symbols):
    s = np.array(symbols, dtype=np.int64)
    tree = WaveletTree(s, 4)
    for c in range(16):
        at = np.arange(len(s) + 1)
        assert tree.rank(np.full(len(at), c), at).tolist() == [int((s[:i] == c).sum()) for i in at]
    symbol, before = tree.access(np.arange(len(s)))
    assert symbol.tolist() == symbols
    assert before.tolist() == [int((s[:i] == s[i]).sum()) for i in range(len(s))]


def test_long_runs_of_known_words():
    rng = random.Random(5)
    block = ["ab"[rng.random() < 0.5] for _ in range(400)]
    items = [("1", " ".join(block[40:75]).encode()), ("2", b"a b"), ("3", b"a a a a a a a a a a a a")]
    texts = [" ".join(block), " ".join(block[30:60]), "c " + " ".join(block[40:50]) + " c", ""]
    for text, (spans, found) in zip(texts, Windows(items).hits([words_of(t.encode()) for t in texts])):
        n, hit, expected = brute_force(text, [(k, t.decode()) for k, t in items])
        assert {p for a, b in spans for p in range(a, b)} == hit and sorted(found) == expected


@pytest.mark.parametrize("block_words", [1 << 21, 2])
def test_odd_documents_and_blocks(spark, odd_docs, no_docs, block_words):
    items = [(1, "Alpha, BETA"), (2, None), (3, "..."), (4, "café — ǆ"), (10, "beta gamma"), (11, "beta gamma"),
             (12, " ".join(f"w{i % 977}q{i}" for i in range(1000, 1030))), (None, "delta")]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    rows = odd_docs.collect()
    expected = sorted(
        (repr(r.doc_id), *(lambda n, hit, found: (n, len(hit), ",".join(found)))(*brute_force(r.text, [i for i in items if i[0] is not None])))
        for r in rows
    )
    found = find_contamination(odd_docs, benchmark, block_words=block_words)
    got = sorted(
        (repr(r.doc_id), r.n_words_, sum(s.end - s.start for s in r.spans_), ",".join(r.items_)) for r in found.collect()
    )
    assert got == expected
    cleaned = {r.doc_id: r.text for r in find_contamination(odd_docs, benchmark, clean=True, block_words=block_words).collect()}
    assert cleaned[1] == " delta epsilon zeta eta theta iota kappa lambda mu" and cleaned[3] == "" and cleaned[6] == "one two"
    assert find_contamination(no_docs, benchmark).count() == 0
    none = find_contamination(odd_docs, benchmark.limit(0))
    assert none.where("size(spans_) > 0").count() == 0 and none.count() == len(rows)


def test_cut_spans():
    assert cut_spans("One, two; THREE. four", [(0, 1), (2, 3)]) == ", two; . four"
    assert cut_spans("é x-y é", [(1, 3)]) == "é  é"
    assert cut_spans("a b", [(0, 2)]) == ""


def test_shards_do_not_change_hits(monkeypatch, spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    key = lambda df: sorted((r.doc_id, r.n_words_, str(r.spans_), str(r.items_)) for r in df.collect())
    whole = key(find_contamination(docs, benchmark))
    assert any(r[2] != "[]" for r in whole)
    assert Windows([("1", b"x")]).hits([]) == []
    assert fm_index.SHARD_WORDS > 0
    assert whole == key(find_contamination(docs.repartition(5), benchmark))


def test_blocks_are_made_by_tasks(spark):
    """Many blocks give the hits of one; the driver gets their names alone."""
    from railtrace.llm import fm_index

    folder = "/root/testdata/sf0.001"
    docs, benchmark = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    paths = fm_index.write_blocks(benchmark, block_words=100)
    assert len(paths) > 5 and all(isinstance(p, str) for p in paths)
    items = [i for p in paths for w in fm_index._block(p).items for i in w]
    assert set(items) == {str(r.item_id) for r in benchmark.collect()}
    assert len(fm_index._BLOCKS) <= fm_index.HELD_BLOCKS
    rows = lambda n: sorted((r.doc_id, tuple(map(tuple, r.spans_)), tuple(r.items_)) for r in find_contamination(docs, benchmark, block_words=n).collect())
    assert rows(100) == rows(1 << 21) and any(r[1] for r in rows(100))


def test_runs_as_long_as_one_key():
    """A suffix that ends where the first key ends comes before those that go on; spans stay in their document."""
    rng = random.Random(1)
    for bits in (2, 5, 8, 12, 16, 20, 31):
        for _ in range(60):
            text = np.array([rng.randint(1, 2) if rng.random() < 0.9 else 0 for _ in range(rng.randint(1, 60))] + [0])
            run = lambda i: text[i:i + int(np.argmin(text[i:]))].tolist()
            expected = sorted(np.flatnonzero(text).tolist(), key=lambda i: (run(i), i))
            assert fm_index._sorted_suffixes(text, bits).tolist() == expected
    block = [f"w{i}" for i in range(300)]  # 9 bits: a key holds 6 words
    items = [("1", " ".join(block).encode()), ("2", " ".join(block[20:26]).encode())]
    texts = [" ".join(block[20:26]) + " x " + " ".join(block[15:40]), " ".join(block[20:26]), "y " + " ".join(block[20:32])] * 3
    for text, (spans, found) in zip(texts, Windows(items).hits([words_of(t.encode()) for t in texts])):
        _, hit, names = brute_force(text, [(k, t.decode()) for k, t in items])
        assert {p for a, b in spans for p in range(a, b)} == hit and sorted(found) == names


def test_query_counts_items_without_id(spark, tmp_path):
    """op8's contract: words inside any window are hit, also one of an item whose id is null."""
    from railtrace.llm.queries import QUERIES

    spark.createDataFrame([(1, "one two three"), (2, "two x"), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, "two"), ("7", "three"), (None, "x"), ("8", None)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = sorted(tuple(r) for r in QUERIES["op8_fm_decontamination"](spark, str(tmp_path)).collect())
    assert got == [(1, 3, 2, 2, sha("7"), True), (2, 2, 2, 1, sha(""), True), (3, 0, 0, 0, sha(""), False)]
