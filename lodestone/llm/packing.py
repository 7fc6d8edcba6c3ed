"""Packing documents into fixed-length training sequences by vector best fit.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared
piece lengths).  Pieces are taken by falling size; each goes to the open sequence that has room
in every capacity and the best score, a weighted residual norm (small: little room left after
placing) or a weighted dot product of room and demand (large: room of the right shape).

Pieces are dealt by row number into groups of about ``group_pieces``, each packed on its own:
groups are equally large whatever the keys look like, and each costs at most about one
sequence more than packing everything at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .text import bounded_batches
from .tokens import default_path, encoder

CAPACITY = 2048
GROUP_PIECES = 8000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
                 end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids with ``end_id`` after
    them, cut into pieces of ``capacity`` where longer; the first piece takes the remainder.
    A null or empty text is the end id alone."""
    path = tokenizer or default_path()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text").to_pylist())):
                ids += end
                n = len(ids) // 4
                stop = n % capacity or min(n, capacity)
                start = piece = 0
                while start < n:
                    out.append((doc_id, piece, start, stop - start,
                                zlib.crc32(memoryview(ids)[4 * start:4 * stop])))
                    start, stop, piece = stop, stop + capacity, piece + 1
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in cols[2:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    ship_package(docs.sparkSession)
    return (bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, PIECE_SCHEMA))


def vector_best_fit(lengths: np.ndarray, capacity: int, max_docs: int, max_cost: int,
                    rule: str = "norm", weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
                    ) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; a piece alone always fits (its cost may be its own bin's
    whole capacity).  Ties go to the older bin, equal lengths keep their order."""
    n = len(lengths)
    order = np.argsort(-lengths, kind="stable")
    smallest = int(lengths.min()) if n else 0
    cap = np.array([capacity, max_docs, max_cost], dtype=np.float64)
    w = np.asarray(weights, dtype=np.float64)
    room = np.empty((max(16, n), 3))   # of the open bins, in the order of their numbers
    name = np.empty(max(16, n), dtype=np.int64)
    used = bins = 0
    where, offset = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for p in order:
        length = int(lengths[p])
        need = np.array([length, 1, length * length], dtype=np.float64)
        best = -1
        if used:
            r = room[:used]
            fits = np.flatnonzero((r[:, 0] >= need[0]) & (r[:, 1] >= 1) & (r[:, 2] >= need[2]))
            if len(fits):
                if rule == "norm":
                    left = (r[fits] - need) / cap
                    best = fits[np.argmin((left * left) @ w)]
                else:
                    best = fits[np.argmax((r[fits] / cap) @ (w * need / cap))]
        if best < 0:
            best = used
            room[best], name[best] = cap, bins
            room[best, 2] = max(max_cost, length * length)
            used, bins = used + 1, bins + 1
        where[p], offset[p] = name[best], capacity - int(room[best, 0])
        room[best] -= need
        if room[best, 0] < smallest or room[best, 1] < 1:  # closed: nothing fits any more
            room[best:used - 1], name[best:used - 1] = room[best + 1:used].copy(), name[best + 1:used].copy()
            used -= 1
    return where, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, max_docs: int = CAPACITY,
         max_cost: int = CAPACITY * CAPACITY, rule: str = "norm",
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (a written table) with ``sequence_id`` and ``offset``.  With the defaults the
    document and cost capacities never forbid what the tokens allow, so that sequences are as
    few as possible; lower them to bound documents or attention work per sequence."""
    groups = max(1, -(-pieces.count() // group_pieces))

    def run(pdf):
        import pandas as pd  # noqa: F401
        where, offset = vector_best_fit(pdf["length"].to_numpy(), capacity, max_docs, max_cost, rule)
        pdf["sequence_id"] = pdf["g"].to_numpy() * (1 << 24) + where
        pdf["offset"] = offset
        return pdf.drop(columns=["g"])

    dealt = pieces.withColumn(
        "g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("long"))
    return dealt.groupBy("g").applyInPandas(run, PIECE_SCHEMA + ", sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer: str | None = None, **options) -> DataFrame:
    """One row per piece of every row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Pieces of a sequence lie gapless from offset 0.  Null and empty texts are packed as their
    end id; rows without a doc_id keep the null; repeated rows are packed each; an empty table
    gives no rows."""
    return pack(cut_lineage(token_pieces(docs, tokenizer)), **options)
