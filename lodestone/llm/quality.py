"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

A document is described by statistics of its whole text.  Random Fourier features of the
standardised statistics approximate a Gaussian kernel; ridge scores over them come from normal
equations that every partition sums for its rows, fold by fold, so one pass over any number of
labelled rows gives the model and its out-of-fold versions.  The out-of-fold scores of the
training rows, counted in fixed bins, are calibrated to probabilities by isotonic regression.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package
from .text import bounded_batches, texts_of

HELD_OUT_FOLDS = 5
DIM, SIGMA, RIDGE, BINS = 256, 3.0, 1.0, 2000
THRESHOLD = 0.3

_CLASS = np.zeros(256, dtype=np.int64)  # of a byte: 0 other, 1 lower, 2 upper, 3 digit, 4 space, ...
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[32, 9, 11, 12, 13]], _CLASS[10] = 4, 5
_CLASS[[ord(c) for c in ".,;:"]], _CLASS[[ord(c) for c in "!?"]] = 6, 7
_CLASS[[ord(c) for c in "#$%&*+=<>@^_|~\\/{}[]"]], _CLASS[128:] = 8, 9

STATISTICS = ["log_bytes", "log_words", "log_lines", "lower", "upper", "digit", "space", "newline", "stop",
              "bang", "symbol", "high", "other", "word_len", "word_len_sd", "longest", "distinct",
              "top_word", "repeats", "distinct_pairs", "distinct_lines", "line_words", "short", "entropy",
              "capital_words", "all_caps"]


def statistics(text: bytes | None) -> list[float]:
    """Shape, repetition and character statistics of a whole text; zeros for an empty one."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    n = len(text)
    kind = np.bincount(_CLASS, weights=raw, minlength=10) / n
    words, lines = text.split(), text.split(b"\n")
    m = len(words)
    if not m:
        return [np.log1p(n), 0.0, np.log1p(len(lines)), kind[1], kind[2], kind[3], kind[4], kind[5], kind[6],
                kind[7], kind[8], kind[9], kind[0]] + [0.0] * (len(STATISTICS) - 13)
    lens = np.fromiter(map(len, words), dtype=np.int64, count=m)
    ids: dict[bytes, int] = {}
    idx = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=m)
    counts = np.bincount(idx)
    pairs = np.unique(idx[:-1] * len(ids) + idx[1:]).size if m > 1 else 1
    p = counts / m
    return [np.log1p(n), np.log1p(m), np.log1p(len(lines)), kind[1], kind[2], kind[3], kind[4], kind[5],
            kind[6], kind[7], kind[8], kind[9], kind[0], lens.mean(), lens.std(), np.log1p(lens.max()),
            len(ids) / m, counts.max() / m, float((idx[1:] == idx[:-1]).mean()) if m > 1 else 0.0,
            pairs / max(1, m - 1), len(set(lines)) / len(lines), np.log1p(m / len(lines)),
            float((lens <= 2).mean()), float(-(p * np.log(p)).sum() / np.log(m + 1)),
            sum(w[:1].isupper() for w in words) / m, sum(w.isupper() for w in words) / m]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fold = [None if d is None else zlib.crc32(str(d).encode()) % HELD_OUT_FOLDS
                for d in batch.column("doc_id").to_pylist()]
        rows = [statistics(t) for t in texts_of(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(fold, pa.int32()), pa.array(rows, pa.list_(pa.float64()))],
            ["doc_id", "fold", "stats"])


class FourierMap:
    """Standardise, clip, and map to ``dim`` cosines and a constant."""

    def __init__(self, mean: np.ndarray, sd: np.ndarray, dim: int = DIM, sigma: float = SIGMA, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.sd = mean, np.where(sd > 1e-9, sd, 1.0)
        self.w = rng.normal(0, 1 / sigma, (len(mean), dim))
        self.b = rng.uniform(0, 2 * np.pi, dim)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.sd, -5, 5)
        z = np.cos(x @ self.w + self.b) * np.sqrt(2 / len(self.b))
        return np.hstack([z, np.ones((len(x), 1))])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def normal_equations(train: DataFrame, fmap: FourierMap) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """fold -> (Z'Z, Z'y).  A partition sums its rows and gives one row per matrix row; these
    are summed by Spark, so the driver gets matrices of a fixed size."""
    d = len(fmap.b) + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            z, y = fmap(_matrix(batch.column("stats"), len(STATISTICS))), batch.column("y").to_numpy()
            fold = batch.column("fold").to_numpy()
            for f in np.unique(fold):
                own = z[fold == f]
                sums[int(f)] = sums.get(int(f), 0) + own.T @ np.hstack([own, y[fold == f][:, None]])
        for f, a in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([f] * d, pa.int32()), pa.array(range(d), pa.int32()),
                 pa.array(list(a), pa.list_(pa.float64()))], ["fold", "i", "row"])

    def add(pdf):
        import pandas as pd
        return pd.DataFrame({"fold": pdf["fold"].iloc[:1], "i": pdf["i"].iloc[:1],
                             "row": [np.sum(np.stack(pdf["row"].to_numpy()), axis=0)]})

    schema = "fold int, i int, row array<double>"
    rows = (train.select("fold", "y", "stats").mapInArrow(partial, schema)
            .groupBy("fold", "i").applyInPandas(add, schema).collect())
    out = {}
    for f in {r["fold"] for r in rows}:
        a = np.zeros((d, d + 1))
        for r in rows:
            if r["fold"] == f:
                a[r["i"]] = r["row"]
        out[f] = a[:, :-1], a[:, -1]
    return out


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    ridge = np.full(len(b), RIDGE)
    ridge[-1] = 1e-6
    return np.linalg.solve(a + np.diag(ridge), b)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (knots, non-decreasing values)."""
    blocks: list[list[float]] = []  # weight, weighted y, weighted x
    for xi, yi, wi in zip(x, y, w):
        blocks.append([wi, wi * yi, wi * xi])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return (np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks]))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, held_out
    (crc32 of the doc_id as text is a multiple of 5; never trained on), score (calibrated
    probability of quality 1), predicted (1 where the score reaches the threshold).

    All labelled rows outside the held-out fold train the model.  Null and empty texts have
    zero statistics and are scored like any other; rows without a doc_id are scored, not held
    out and not trained on; repeated rows are scored each, and repeated labels count each.
    Without training rows every score is 0.5; an empty table gives no rows."""
    ship_package(docs.sparkSession)
    described = cut_lineage(
        bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(_described, "doc_id long, fold int, stats array<double>"))
    marked = labels.select("doc_id", F.col("quality").cast("double").alias("y")).where("quality is not null")
    train = cut_lineage(described.where("fold != 0").join(marked, "doc_id").select("fold", "y", "stats"))
    cols = [F.transform("stats", lambda v: v)[i] for i in range(len(STATISTICS))]
    moments = train.agg(F.count("*").alias("n"), *(F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)),
                        *(F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols))).first()
    if not moments["n"]:
        def scored(z):
            return np.full(len(z), 0.5)
        fmap = FourierMap(np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)))
    else:
        fmap = FourierMap(np.array([moments[f"m{i}"] for i in range(len(STATISTICS))]),
                          np.array([moments[f"s{i}"] for i in range(len(STATISTICS))]))
        sums = normal_equations(train, fmap)
        a, b = sum(s[0] for s in sums.values()), sum(s[1] for s in sums.values())
        full = _solve(a, b)
        unseen = {f: _solve(a - s[0], b - s[1]) if len(sums) > 1 else full for f, s in sums.items()}

        def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                z, fold = fmap(_matrix(batch.column("stats"), len(STATISTICS))), batch.column("fold").to_numpy()
                s = np.array([z[i] @ unseen[int(f)] for i, f in enumerate(fold)])
                at = np.clip(np.floor((np.clip(s, -0.5, 1.5) + 0.5) / 2 * BINS), 0, BINS - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int32)), batch.column("y"), pa.array(s)], ["bin", "y", "s"])

        bins = (train.mapInArrow(raw, "bin int, y double, s double").groupBy("bin")  # BINS rows at most
                .agg(F.avg("s").alias("x"), F.avg("y").alias("y"), F.count("*").alias("w"))
                .orderBy("x").collect())
        knots, values = isotonic(*(np.array([float(r[c]) for r in bins]) for c in ("x", "y", "w")))

        def scored(z):
            return np.clip(np.interp(z @ full, knots, values), 0.0, 1.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("fold"),
                     pa.array(scored(fmap(_matrix(batch.column("stats"), len(STATISTICS)))))],
                    ["doc_id", "fold", "score"])

    return (described.mapInArrow(score, "doc_id long, fold int, score double")
            .select("doc_id", F.coalesce(F.col("fold") == 0, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
