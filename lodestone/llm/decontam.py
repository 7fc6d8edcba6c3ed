"""Benchmark decontamination by winnowing.

A text's fingerprints are the smallest k-gram hashes of every ``PICK`` consecutive k-grams.  A
document and a benchmark item that share ``WINDOW = K + PICK - 1`` words share a whole run of
``PICK`` k-grams and so its smallest hash: every shared window of 13 words is found.  Items
shorter than a window are fingerprinted whole, and documents by all runs of such a length.

Documents' fingerprints first pass a bitmap of the benchmark's (a fixed 512 KB, whatever the
benchmark's size), so only likely hits leave the scan; these join the benchmark's fingerprints
exactly.  Around each that is left the document's windows are cut from its words and join the
benchmark's distinct windows, each known by a digest of its words and with the set of items that
hold it: a passage that many items share is one run of windows with one set, however many.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .joins import slot_filter
from .text import U64, WordHash, bounded_batches, mix64, odd_multipliers, rolling, texts_of

WINDOW, K = 13, 8
PICK = WINDOW - K + 1
BITS = 1 << 22
_MULT = odd_multipliers(WINDOW, 11)
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def item_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased: runs of digits,
    letters and non-ASCII characters."""
    return text.translate(_TABLE).split() if text else []


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    return mix64(rolling(h, k, _MULT) + U64(k))  # grams of different lengths never meet


def fingerprints(h: np.ndarray, short: tuple[int, ...] = ()) -> np.ndarray:
    """Distinct fingerprints of a sequence of word hashes: winnowed k-grams, and every gram of
    the lengths in ``short``."""
    out = [_grams(h, m) for m in short]
    if len(h) >= WINDOW:
        g = _grams(h, K)
        low = g[:len(g) - PICK + 1].copy()
        for j in range(1, PICK):
            np.minimum(low, g[j:len(g) - PICK + 1 + j], out=low)
        out.append(low)
    return np.unique(np.concatenate(out)) if out else np.empty(0, dtype=U64)


def window_digest(words: list[bytes]) -> bytes:
    """16 bytes that stand for a sequence of words (words hold no spaces)."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def extend_hits(words: list[bytes], h: np.ndarray, fps: np.ndarray, short: tuple[int, ...]) -> list[tuple[int, int, bytes]]:
    """(start, length, digest) of the windows of a text that the fingerprints ``fps`` may stand
    for: the windows around each of its k-grams among them, and its runs of a short item's length."""
    out = []
    for m in short:
        if len(h) >= m:
            out += [(int(i), m, window_digest(words[i:i + m])) for i in np.flatnonzero(np.isin(_grams(h, m), fps))]
    if len(h) >= WINDOW:
        at = np.flatnonzero(np.isin(_grams(h, K), fps))
        starts = np.unique(at[:, None] - np.arange(PICK)[None, :])
        starts = starts[(starts >= 0) & (starts <= len(h) - WINDOW)]
        out += [(int(i), WINDOW, window_digest(words[i:i + WINDOW])) for i in starts]
    return out


def joined_spans(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, stop) of the runs of words that the (start, length) windows cover, ascending."""
    out: list[tuple[int, int]] = []
    for start, length in sorted(hits):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], start + length))
        else:
            out.append((start, start + length))
    return out


def benchmark_marks(benchmark: DataFrame) -> DataFrame:
    """(item_id, m, fps, windows) of each item: m its length where shorter than a window, else
    13; its fingerprints and the digests of its distinct windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHash()
        with np.errstate(over="ignore"):
            for batch in batches:
                fps, ms, windows = [], [], []
                for text in texts_of(batch):
                    words = item_words(text)
                    h, m = cache.of(words), min(len(words), WINDOW)
                    fps.append((fingerprints(h) if m == WINDOW else
                                _grams(h, m) if m else h).view(np.int64))
                    ms.append(m)
                    windows.append(sorted({window_digest(words[i:i + m]) for i in range(len(words) - m + 1)} if m else ()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").cast(pa.string()), pa.array(ms, pa.int32()), pa.array(fps, pa.list_(pa.int64())),
                     pa.array(windows, pa.list_(pa.binary()))], ["item_id", "m", "fps", "windows"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    return items.mapInArrow(run, "item_id string, m int, fps array<long>, windows array<binary>")


def fingerprint_bitmap(fps: DataFrame) -> bytes:
    """A bitmap of ``BITS`` slots (512 KB) of the column ``fp``, built on Spark in runs of 4 KB."""
    slot = F.pmod("fp", F.lit(BITS)) + 1
    runs = fps.groupBy(F.bitmap_bucket_number(slot).alias("run")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    out = bytearray(BITS // 8)
    for r in runs.collect():  # at most 128 rows
        at = (r["run"] - 1) * len(r["bits"])
        out[at:at + len(r["bits"])] = r["bits"]
    return bytes(out)


def scan_documents(docs: DataFrame, bitmap: bytes, short: tuple[int, ...]) -> DataFrame:
    """(doc_id, key, n_words, fps): fingerprints that pass the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, bits = WordHash(), np.frombuffer(bitmap, dtype=np.uint8)
        with np.errstate(over="ignore"):
            for batch in batches:
                n, fps = [], []
                for text in texts_of(batch):
                    words = item_words(text)
                    f = fingerprints(cache.of(words), short)
                    at = (f % U64(BITS)).astype(np.int64)
                    n.append(len(words))
                    fps.append(f[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("key"), pa.array(n, pa.int64()),
                     pa.array(fps, pa.list_(pa.int64()))], ["doc_id", "key", "n_words", "fps"])

    return docs.select("doc_id", "key", "text").mapInArrow(
        run, "doc_id long, key long, n_words long, fps array<long>")


def _windows_around(short: tuple[int, ...]):
    """Arrow stage: the windows of each text that its fingerprints ``fps`` may stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHash()
        with np.errstate(over="ignore"):
            for batch in batches:
                for i, (text, fps) in enumerate(zip(texts_of(batch), batch.column("fps"))):
                    words = item_words(text)
                    here = extend_hits(words, cache.of(words), fps.values.to_numpy(zero_copy_only=False).view(U64), short)
                    n = len(here)
                    if n:
                        at = pa.array([i] * n)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("doc_id").take(at), batch.column("key").take(at),
                             pa.array([w[0] for w in here], pa.int64()), pa.array([w[1] for w in here], pa.int32()),
                             pa.array([w[2] for w in here], pa.binary())], ["doc_id", "key", "start", "m", "window"])
    return run


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    for batch in batches:
        spans = [joined_spans([(h["start"], h["m"]) for h in hits]) for hits in batch.column("hits").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
             pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], pa.list_(span)), batch.column("sets")],
            ["doc_id", "key", "n_hit", "spans", "sets"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_words,
    n_hit, items (ids of benchmark items with an occurring window, sorted), spans (runs of hit
    words), contaminated (a twentieth of the words or more are hit), key (xxhash64 of the text).

    A word is hit when it lies inside an occurrence of a window of 13 consecutive words of an
    item (a shorter item is one window; one without words none).  Null and empty texts have no
    words and are clean; null ids stay null, an item without an id counts under the id '';
    repeated rows get equal rows; empty tables give no hits or no rows."""
    docs = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                        F.xxhash64("text").alias("key"))
    ship_package(docs.sparkSession)
    marks = cut_lineage(benchmark_marks(benchmark))
    fps = marks.select(F.explode("fps").alias("fp")).distinct()
    short = tuple(r["m"] for r in marks.where(f"m between 1 and {WINDOW - 1}").select("m").distinct().collect())  # at most 12
    scanned = cut_lineage(scan_documents(docs, fingerprint_bitmap(fps), short))
    likely = cut_lineage(scanned.select("doc_id", "key", F.explode("fps").alias("fp")).distinct().join(fps, "fp")
                         .groupBy("doc_id", "key").agg(F.collect_list("fp").alias("fps")))
    same = F.col("l.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("l.key") == F.col("d.key"))
    texts = slot_filter(docs, F.col("key"), likely, F.col("key")).dropDuplicates(["doc_id", "key"])
    around = (texts.alias("d").join(likely.alias("l"), same).select("d.doc_id", "d.key", "d.text", "l.fps")
              .mapInArrow(_windows_around(short), "doc_id long, key long, start long, m int, window binary"))
    # windows with the same items share one set of them, and texts with the same sets one list
    known = cut_lineage(marks.select("item_id", F.explode("windows").alias("window")).groupBy("window")
                        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
                        .withColumn("set", F.unhex(F.sha2(F.to_json("items"), 256))))
    hits = cut_lineage(around.join(known.select("window", "set"), "window").groupBy("doc_id", "key")
                       .agg(F.collect_list(F.struct("start", "m")).alias("hits"), F.array_sort(F.collect_set("set")).alias("sets"))
                       .mapInArrow(_cover, "doc_id long, key long, n_hit long, "
                                           "spans array<struct<start: long, stop: long>>, sets array<binary>"))
    lists = (hits.select("sets").distinct().withColumn("set", F.explode("sets"))
             .join(known.select("set", "items").dropDuplicates(["set"]), "set").groupBy("sets")
             .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    confirmed = hits.join(lists, "sets").select("doc_id", "key", "n_hit", "items", "spans")
    both = F.col("c.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("c.key") == F.col("s.key"))
    n_hit = F.coalesce("c.n_hit", F.lit(0))
    return (scanned.alias("s").join(confirmed.alias("c"), both, "left")
            .select("s.doc_id", "s.n_words", n_hit.alias("n_hit"),
                    F.coalesce("c.items", F.array().cast("array<string>")).alias("items"),
                    F.coalesce("c.spans", F.array().cast("array<struct<start:long,stop:long>>")).alias("spans"),
                    ((n_hit > 0) & (20 * n_hit >= F.col("s.n_words"))).alias("contaminated"), "s.key"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all their columns; rows are told apart by
    doc_id and text, so equal ones share their fate."""
    hit = contamination(docs, benchmark).where("contaminated").select(
        "doc_id", "key").distinct()
    same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("h.doc_id")) & (F.xxhash64("d.text") == F.col("h.key"))
    return docs.alias("d").join(hit.alias("h"), same, "left_anti")


def item_digest(items):
    """Lower-case hex sha256 of the sorted item ids, comma-joined."""
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)


