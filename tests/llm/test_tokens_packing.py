import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from railtrace.llm import packing, token_files
from railtrace.llm.queries import END_ID, QUERIES, word_tokenizer
from railtrace.llm.tokens import WordEncoder

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(word_tokenizer())
    return lambda text: np.array([*t.encode(text or "", add_special_tokens=False).ids, END_ID], dtype="<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(list("aAbB'sStT <|>0́\n\t\x1c\x85ÀßẞİΣς")))))
def test_word_by_word_ids_are_the_librarys(text):
    global _encoder, _whole
    if "_encoder" not in globals():
        _encoder, _whole = WordEncoder(word_tokenizer(), max_words=50), Tokenizer.from_file(word_tokenizer())
    ids = np.frombuffer(_encoder.ids(text.encode()), dtype=_encoder.dtype)
    assert ids.tolist() == _whole.encode(text, add_special_tokens=False).ids


def expected_files(rows, library):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out, start = [], 0
    for key, text in rows:
        ids = library(text)
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def by_start(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_token_files_round_trip(spark, odd_docs, no_docs, library):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    manifest = token_files.write_token_files(
        odd_docs, token_files.new_folder(spark), word_tokenizer(), END_ID, docs_per_file=4
    )
    assert manifest.count() > 1
    assert by_start(token_files.read_documents(manifest)) == expected_files(rows, library)
    empty = token_files.write_token_files(no_docs, token_files.new_folder(spark), word_tokenizer(), END_ID)
    assert empty.count() == 0 and token_files.read_documents(empty).count() == 0


def test_op6_reads_back_every_id(spark, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op6_token_files"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert by_start(found) == expected_files(rows, library)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=300), st.integers(0, 300), st.integers(0, 300))
def test_bits_round_trip_and_random_access(width, ids, a, b):
    ids = np.array(ids, dtype=np.uint64) & np.uint64((1 << width) - 1)
    ids = ids.astype("<u4")
    data = token_files.pack_bits(ids, width)
    assert len(data) == -(-len(ids) * width // 8)
    assert token_files.unpack_bits(data, width, len(ids)).tolist() == ids.tolist()
    import io

    old, token_files.BLOCK = token_files.BLOCK, 16
    try:
        stream = io.BytesIO()
        writer = token_files.Writer(stream, width)
        writer.document(None, ids[:a])
        writer.document(-5, ids[a:])
        assert writer.close() == len(stream.getvalue())
        reader = token_files.Reader(stream)
        low, high = sorted((min(a, len(ids)), min(b, len(ids))))
        assert reader.ids(low, high).tolist() == ids[low:high].tolist()
        assert reader.document(1).tolist() == ids[a:].tolist()
        assert [r[0] for r in reader.document_crcs()] == [None, -5]
        stream.seek(len(token_files.MAGIC) + 1 if len(data) > 2 else 0)
    finally:
        token_files.BLOCK = old


def test_a_broken_file_is_refused():
    import io

    with pytest.raises(ValueError):
        token_files.Reader(io.BytesIO(b"x" * 200))


def check_pieces(pieces, docs, tokens=4096, segments=128):
    """Every id in one piece, offsets without gaps, limits kept; gives the sequences' lengths."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], p["length"], p["ids_crc32"]))
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for (key, n), parts in by_doc.items():
        ids = next(i for k, i in docs if k == key and len(i) == n)
        times = sum(k == key and len(i) == n for k, i in docs)
        assert sum(p[1] for p in parts) == n * times
        covered = np.zeros(n, dtype=int)
        for start, length, crc in parts:
            covered[start:start + length] += 1
            assert crc == zlib.crc32(ids[start:start + length].tobytes())
        assert (covered == times).all()
    lengths = []
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= tokens and len(parts) <= segments
        lengths.append(at)
    assert {k for k, _ in docs} == {k for k, _ in by_doc}
    return lengths


def test_op1_packs_every_id_once(spark, library):
    docs = [(r.doc_id, library(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    lengths = check_pieces([r.asDict() for r in QUERIES["op1_vector_packing"](spark, SF).collect()], docs)
    assert all(n & (n - 1) == 0 for n in lengths)  # full, or at a power of two: no padding


def test_packing_odd_documents(odd_docs, no_docs, library):
    docs = [(r.doc_id, library(r.text)) for r in odd_docs.collect()]
    packed = packing.pack_documents(odd_docs, word_tokenizer(), END_ID)
    check_pieces([r.asDict() for r in packed.collect()], docs)
    assert packing.pack_documents(no_docs, word_tokenizer(), END_ID).count() == 0


def test_examples_under_three_limits(spark):
    rng = np.random.default_rng(7)
    rows = [(i, int(n), int(rng.integers(0, n + 1))) for i, n in enumerate(rng.integers(1, 900, 600))]
    rows += [(600, None, 5), (601, 0, 0), (602, 40, None), (603, 30, 99)]
    df = spark.createDataFrame(rows, "ex int, n int, k int").repartition(2)
    limits = packing.Limits(tokens=1000, segments=6, loss=600)
    for cut in (False, True):
        some = df if cut else df.where("k IS NULL OR k <= 600")
        sequences = {}
        for r in packing.pack_examples(some, "ex", "n", "k", limits, cut=cut, pool=128).collect():
            sequences.setdefault(r.sequence_id, []).append(r)
        total = 0
        for parts in sequences.values():
            assert sum(p.length for p in parts) <= 1000
            assert len(parts) <= 6 and sum(p.loss_tokens for p in parts) <= 600
            total += sum(p.length for p in parts)
            if not cut:
                assert all(p.start == 0 and p.length == p.doc_tokens for p in parts)
        assert total == sum(n or 0 for e, n, k in rows if cut or k is None or k <= 600)
    with pytest.raises(ValueError):
        packing.Packer(limits, cut=False).add(0, 2000, 0)


def test_the_largest_dot_product_goes_first():
    p = packing.Packer(packing.Limits(tokens=100, segments=10, loss=100), cut=False)
    for i, n in enumerate((10, 60, 30, 35)):
        assert p.add(i, n, n) == []
    assert [[e for e, _, _ in s] for s in p.finish()] == [[1, 3], [2, 0]]


def test_pools_of_tiny_documents_need_no_padding():
    p = packing.Packer()
    out = [s for i in range(10_000) for s in p.add(i, 5, 5)] + p.finish()
    totals = [sum(length for _, _, length in s) for s in out]
    assert all(t & (t - 1) == 0 for t in totals) and max(len(s) for s in out) <= 128
    tokens = [(example, at) for s in out for example, start, length in s for at in range(start, start + length)]
    assert sorted(tokens) == [(i, at) for i in range(10_000) for at in range(5)]
