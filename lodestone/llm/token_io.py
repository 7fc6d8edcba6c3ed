"""Token ids in bit-packed binary files.

File layout (little-endian): a 40-byte header (magic, version, bits per id, ids per block,
ids, blocks, documents), the byte offset of every block and of the end, the documents' ids and
first positions, then the blocks.  An id takes the minimum bits of the vocabulary; a block of
``BLOCK_IDS`` ids begins on a byte, so any id's block is found by a division and unpacked
without its neighbours.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage, ship_package
from .text import bounded_batches
from .tokens import default_path, encoder

MAGIC, VERSION = b"LSTK", 1
HEADER = struct.Struct("<4sHHQQQQ")
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 23
_NULL_ID = -(1 << 63)  # stands for a missing doc_id in a file


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` low bits of each id, least significant first, padded to a whole byte."""
    if bits in (8, 16, 32):  # the same layout, without the detour over single bits
        return ids.astype(f"<u{bits // 8}").tobytes()
    lanes = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(lanes[:, :bits].ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=n).astype("<u4")
    lanes = np.zeros((n, 32), dtype=np.uint8)
    flat = np.unpackbits(np.frombuffer(data, dtype=np.uint8), bitorder="little", count=n * bits)
    lanes[:, :bits] = flat.reshape(n, bits)
    return np.packbits(lanes, axis=1, bitorder="little").view("<u4").ravel()


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


class TokenFileWriter:
    """Collects ids of one file (bounded by the caller) and writes it in one go."""

    def __init__(self, bits: int):
        self.bits, self.blocks, self.docs, self.starts = bits, [], [], []
        self.n, self.rest, self.waiting = 0, [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(_NULL_ID if doc_id is None else doc_id)
        self.starts.append(self.n)
        self.n += len(ids) // 4
        self.rest.append(ids)
        self.waiting += len(ids) // 4
        if self.waiting >= BLOCK_IDS:
            self._close(all_of_it=False)

    def _close(self, all_of_it: bool) -> None:
        """Pack whole blocks of what waits, and the rest of it as the last block."""
        data = np.frombuffer(b"".join(self.rest), dtype="<u4")
        stop = len(data) if all_of_it else len(data) // BLOCK_IDS * BLOCK_IDS
        for i in range(0, stop, BLOCK_IDS):
            self.blocks.append(pack_bits(data[i:min(i + BLOCK_IDS, stop)], self.bits))
        self.rest, self.waiting = [data[stop:].tobytes()], len(data) - stop

    def write(self, uri: str) -> None:
        """Write under a name of this attempt, then rename: a lost or doubled task leaves one
        whole file with the same content."""
        self._close(all_of_it=True)
        head = HEADER.size + 8 * (len(self.blocks) + 1) + 16 * len(self.docs)
        offsets = head + np.cumsum([0] + [len(b) for b in self.blocks], dtype="<i8")
        files, path = _filesystem(uri)
        folder, name = os.path.split(path)
        files.create_dir(folder, recursive=True)
        own = f"{folder}/.{name}.{uuid.uuid4().hex}"
        with files.open_output_stream(own) as out:
            out.write(HEADER.pack(MAGIC, VERSION, self.bits, BLOCK_IDS, self.n, len(self.blocks),
                                  len(self.docs)))
            out.write(offsets.tobytes())
            out.write(np.array(self.docs, dtype="<i8").tobytes())
            out.write(np.array(self.starts, dtype="<i8").tobytes())
            for b in self.blocks:
                out.write(b)
        files.move(own, path)


class TokenFile:
    """Random access to a written file: only the blocks asked for are read."""

    def __init__(self, uri: str):
        files, path = _filesystem(uri)
        self.f = files.open_input_file(path)
        magic, version, self.bits, self.block_ids, self.n, blocks, docs = HEADER.unpack(
            self.f.read_at(HEADER.size, 0))
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"{uri} is not a token file")
        at = HEADER.size
        self.offsets = np.frombuffer(self.f.read_at(8 * (blocks + 1), at), dtype="<i8")
        at += 8 * (blocks + 1)
        self.docs = np.frombuffer(self.f.read_at(8 * docs, at), dtype="<i8")
        self.starts = np.frombuffer(self.f.read_at(8 * docs, at + 8 * docs), dtype="<i8")
        self._last: tuple[int, np.ndarray] | None = None

    def block(self, k: int) -> np.ndarray:
        if self._last is None or self._last[0] != k:
            a, b = int(self.offsets[k]), int(self.offsets[k + 1])
            n = min(self.block_ids, self.n - k * self.block_ids)
            self._last = k, unpack_bits(self.f.read_at(b - a, a), n, self.bits)
        return self._last[1]

    def ids(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """The ids ``start:stop`` as runs of at most a block."""
        while start < stop:
            k, i = divmod(start, self.block_ids)
            run = self.block(k)[i:i + stop - start]
            yield run
            start += len(run)

    def close(self) -> None:
        self.f.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 0,
                      file_ids: int = FILE_IDS) -> DataFrame:
    """Write all ids in ascending doc_id order (rows without a doc_id first, repeated doc_ids by
    text) below ``folder``, a URI on shared storage that pyarrow can open.  Returns the
    manifest (part, k, file, n_ids, n_docs); part and k give the files' order.

    Documents are range-partitioned as texts, before they are encoded, so no id is shuffled;
    a task keeps at most ``file_ids`` ids and one document in memory."""
    path = tokenizer or default_path()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, k = encoder(path), TaskContext.get().partitionId(), 0
        bits = bits_for(max(enc.vocabulary, end_id + 1))
        writer = TokenFileWriter(bits)

        def done() -> pa.RecordBatch:
            uri = f"{folder}/part-{part:06d}-{k:04d}.tok"
            writer.write(uri)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "k": k, "file": uri, "n_ids": writer.n, "n_docs": len(writer.docs)}],
                pa.schema([("part", pa.int32()), ("k", pa.int32()), ("file", pa.string()),
                           ("n_ids", pa.int64()), ("n_docs", pa.int64())]))

        doc_ids: deque[int | None] = deque()  # of texts that the encoder holds

        def texts() -> Iterator[str | None]:
            for batch in batches:
                doc_ids.extend(batch.column("doc_id").to_pylist())
                yield from batch.column("text").to_pylist()

        for ids in enc.encode(texts()):  # cut up across batches: their words are looked up once
            writer.add(doc_ids.popleft(), ids + end)
            if writer.n >= file_ids:
                yield done()
                writer, k = TokenFileWriter(bits), k + 1
        if writer.docs:
            yield done()

    ship_package(docs.sparkSession)
    ordered = (bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    return ordered.mapInArrow(run, "part int, k int, file string, n_ids long, n_docs long")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the files of a manifest; ``start``
    counts the ids of all documents before."""
    before = Window.orderBy("part", "k").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    placed = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                f = TokenFile(uri)
                stops = np.append(f.starts[1:], f.n)
                crcs = []
                for a, b in zip(f.starts.tolist(), stops.tolist()):
                    crc = 0
                    for ids in f.ids(a, b):
                        crc = zlib.crc32(ids.tobytes(), crc)
                    crcs.append(crc)
                f.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.docs, mask=f.docs == _NULL_ID), pa.array(f.starts + base),
                     pa.array(stops - f.starts), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = placed.repartition(manifest.sparkSession.sparkContext.defaultParallelism * 2, "file")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_round_trip(docs: DataFrame, tokenizer: str | None = None, folder: str | None = None) -> DataFrame:
    """Write every document's ids and read them back: doc_id, start, n_tokens (with the end
    id), ids_crc32.  Null and empty texts hold their end id alone; a null doc_id stays null and
    comes first; repeated rows are written each; an empty table gives no rows."""
    spark: SparkSession = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/tokens/{uuid.uuid4().hex}"
    return read_token_files(cut_lineage(write_token_files(docs, folder, tokenizer)))
