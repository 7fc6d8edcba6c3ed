"""Word helpers shared by the operators: byte-level words, cached 64-bit word hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift), vectorised."""
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


class WordHash(dict):
    """word bytes -> 64-bit hash, remembered; forgets everything beyond ``limit`` words, so
    a task's memory stays bounded whatever the vocabulary."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def shingle_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased (``bytes.split`` and
    ``bytes.lower`` know exactly these ASCII characters)."""
    return text.lower().split() if text else []


def rolling(hashes: np.ndarray, width: int, multipliers: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each run of ``width`` consecutive word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    out = hashes[:n] * multipliers[0]
    for j in range(1, width):
        out = out + hashes[j:j + n] * multipliers[j]
    return mix64(out)


def bounded_batches(df, records: int = 1000):
    """``df``; sees to it that Arrow batches hold at most ``records`` rows (texts may be
    long, and a task holds one batch at a time)."""
    conf = df.sparkSession.conf
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(key)) > records or int(conf.get(key)) <= 0:
        conf.set(key, records)
    return df
