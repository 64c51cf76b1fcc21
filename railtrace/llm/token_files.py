"""Token-id files with fixed-width bit packing (operator 6).

Every id takes the minimum bits that the vocabulary needs.  Ids are packed in
blocks of ``BLOCK`` ids; a block starts on a byte, its offset is in the file's
index, and bits run from the lowest up, so that numpy unpacks a block at once
and any range of ids is read by touching its blocks only.

File layout (little-endian): magic, blocks, index (document ids, first id
position of each document plus the end, byte offset of each block plus the
end), footer of fixed size with the counts, a CRC-32 of the index and the magic
again.  A reader starts from the footer.

Documents are range-partitioned and sorted by id; each task encodes its range
and writes one file below the shared folder, under a temporary name that is
then moved, so a retried or doubled task leaves one whole file.  A written
manifest has one row per file; positions over the whole corpus are running sums
over the manifest.

Defined cases: a null or empty text is the end id alone; null ids come first
and are kept; rows of one id follow each other, ordered by their text; an empty
table writes no file and reads back as no rows; other columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railtrace.llm.common import q, shared_path, written

MAGIC = b"TOKBITS1"
BLOCK = 1 << 16  # ids of a block; a multiple of 8, so that only the last block can end inside a byte
FOOTER = struct.Struct("<IIQQQQQI8s")  # width, block ids, documents, null ids, ids, blocks, index offset, index crc, magic
DOCS_PER_FILE = 8192
READ_IDS = 1 << 20  # ids that a reader unpacks at once

MANIFEST = "file_no int, path string, n_docs long, n_ids long, n_bytes long"


def bits_for(vocabulary: int) -> int:
    """The bits that hold any id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Packs ids of ``width`` bits each, lowest bit first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, width: int, n: int) -> np.ndarray:
    """The first n ids of ``width`` bits, as unsigned 32-bit integers."""
    if width in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{width // 8}", count=n).astype("<u4")
    bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8), bitorder="little", count=n * width).reshape(n, width)
    wide = np.zeros((n, 32), dtype=np.uint8)
    wide[:, :width] = bits
    return np.packbits(wide, axis=1, bitorder="little").reshape(-1).view("<u4")


class Writer:
    """Writes one file to an open binary stream; ids may come in parts."""

    def __init__(self, stream, width: int):
        self.stream, self.width, self.at = stream, width, len(MAGIC)
        self.parts: list[np.ndarray] = []
        self.waiting = self.n_ids = 0
        self.docs: list[int] = []
        self.nulls = 0
        self.firsts: list[int] = [0]
        self.blocks: list[int] = [self.at]
        stream.write(MAGIC)

    def document(self, doc_id: int | None, ids: np.ndarray) -> None:
        if doc_id is None:
            self.nulls += 1  # they sort first
        self.docs.append(0 if doc_id is None else doc_id)
        self.n_ids += len(ids)
        self.firsts.append(self.n_ids)
        self.parts.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 16 * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, dtype=np.uint32)
        end = len(ids) if last else len(ids) // BLOCK * BLOCK
        for i in range(0, end, BLOCK):
            data = pack_bits(ids[i:min(i + BLOCK, end)], self.width)
            self.stream.write(data)
            self.at += len(data)
            self.blocks.append(self.at)
        self.parts, self.waiting = [ids[end:]], len(ids) - end

    def close(self) -> int:
        self._flush(True)
        index = b"".join(
            np.array(x, dtype=t).tobytes() for x, t in ((self.docs, "<i8"), (self.firsts, "<u8"), (self.blocks, "<u8"))
        )
        footer = FOOTER.pack(
            self.width, BLOCK, len(self.docs), self.nulls, self.n_ids, len(self.blocks) - 1, self.at, zlib.crc32(index), MAGIC
        )
        self.stream.write(index + footer)
        return self.at + len(index) + len(footer)


class Reader:
    """Random access to one file through an open binary stream that can seek."""

    def __init__(self, stream):
        self.stream = stream
        end = stream.seek(0, 2) if not hasattr(stream, "size") else stream.size()
        stream.seek(end - FOOTER.size)
        self.width, self.block, self.n_docs, self.nulls, self.n_ids, n_blocks, at, crc, magic = FOOTER.unpack(
            stream.read(FOOTER.size)
        )
        stream.seek(at)
        index = stream.read(end - FOOTER.size - at)
        if magic != MAGIC or zlib.crc32(index) != crc:
            raise ValueError("not a whole token file")
        cuts = [8 * self.n_docs, 8 * (2 * self.n_docs + 1)]
        self.docs = np.frombuffer(index[:cuts[0]], dtype="<i8")
        self.firsts = np.frombuffer(index[cuts[0]:cuts[1]], dtype="<u8").astype(np.int64)
        self.blocks = np.frombuffer(index[cuts[1]:], dtype="<u8").astype(np.int64)
        if len(self.blocks) != n_blocks + 1:
            raise ValueError("not a whole token file")

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids at positions start..end, from their blocks alone."""
        if end <= start:
            return np.zeros(0, dtype="<u4")
        a, b = start // self.block, (end - 1) // self.block
        self.stream.seek(int(self.blocks[a]))
        data = self.stream.read(int(self.blocks[b + 1] - self.blocks[a]))
        base = a * self.block
        return unpack_bits(data, self.width, end - base)[start - base:]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.firsts[k]), int(self.firsts[k + 1]))

    def document_crcs(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(id, first position, ids, crc) of each document, reading on through the file."""
        k = 0
        while k < self.n_docs:
            j = max(k + 1, int(np.searchsorted(self.firsts, self.firsts[k] + READ_IDS, side="right")) - 1)
            base, end = int(self.firsts[k]), int(self.firsts[j])
            if j == k + 1:  # may be very long
                crc = 0
                for at in range(base, end, READ_IDS):
                    crc = zlib.crc32(self.ids(at, min(end, at + READ_IDS)).tobytes(), crc)
                yield self._row(k, crc)
            else:
                data = memoryview(self.ids(base, end).tobytes())
                for i in range(k, j):
                    yield self._row(i, zlib.crc32(data[4 * (int(self.firsts[i]) - base):4 * (int(self.firsts[i + 1]) - base)]))
            k = j

    def _row(self, k: int, crc: int) -> tuple[int | None, int, int, int]:
        first = int(self.firsts[k])
        return None if k < self.nulls else int(self.docs[k]), first, int(self.firsts[k + 1]) - first, crc


def _filesystem(uri: str):
    """A file system that executors share, and the path in it, for a folder's URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int,
    id_col: str = "doc_id", text_col: str = "text", docs_per_file: int = DOCS_PER_FILE,
) -> DataFrame:
    """Writes the files below ``folder`` and gives the written manifest, one row per file."""
    rows = docs.select(F.col(q(id_col)).cast("long").alias("id"), F.col(q(text_col)).cast("binary").alias("text"))
    n_files = max(1, -(-docs.count() // docs_per_file))
    ordered = rows.repartitionByRange(n_files, "id").sortWithinPartitions("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from railtrace.llm.tokens import encoder

        task = TaskContext.get()
        file_no = task.partitionId()
        writer = stream = None
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if writer is None:
                    enc = encoder(tokenizer)
                    end = np.array([end_id], dtype=enc.dtype).tobytes()
                    files, base = _filesystem(folder)
                    files.create_dir(base, recursive=True)
                    part = f"{base}/.part-{file_no:06d}-{task.taskAttemptId()}"
                    stream = files.open_output_stream(part)
                    writer = Writer(stream, bits_for(max(enc.vocabulary, end_id + 1)))
                writer.document(key, np.frombuffer(enc.ids(text.as_py()) + end, dtype=enc.dtype))
        if writer is not None:
            size = writer.close()
            stream.close()
            name = f"tokens-{file_no:06d}.bin"
            files.move(part, f"{base}/{name}")
            yield pa.RecordBatch.from_pydict({
                "file_no": pa.array([file_no], pa.int32()), "path": [f"{folder.rstrip('/')}/{name}"],
                "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids], "n_bytes": [size],
            })

    return written(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, read back from the files.

    ``start`` counts the ids of all documents before it, over all files.
    """
    # one row per file, so the running sum is a small job
    before = F.sum("n_ids").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("file_no", "path", F.coalesce(before, F.lit(0)).alias("base"))
    n = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                files, name = _filesystem(path)
                with files.open_input_file(name) as stream:
                    rows = list(Reader(stream).document_crcs())
                ids, first, count, crc = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([base + f for f in first], pa.int64()),
                     pa.array(count, pa.int64()), pa.array(crc, pa.int64())],
                    names=["id", "start", "n_tokens", "ids_crc32"],
                )

    # one task per file: repartitionById sends file k to partition k
    spread = files.repartitionById(n, F.pmod(F.col("file_no"), F.lit(n)))
    return spread.mapInArrow(read, "id long, start long, n_tokens long, ids_crc32 long")


def new_folder(spark: SparkSession) -> str:
    return shared_path(spark, "tokens")
