"""Fast similarity sketching of sets of 64-bit hashes.

A sketch has ``t`` coordinates and is filled in rounds.  In round ``i < t`` every element
falls into one hashed bin and offers the value ``(i, hash)``; a coordinate keeps its smallest
offer, so an earlier round always wins.  When a round ends with every coordinate filled the
sketch is done; a set with many elements needs one round.  Rounds ``t .. 2t - 1`` send all
elements to bin ``i - t``, which fills whatever the random rounds left empty: after them every
coordinate holds a value, for a set of any size but zero.  Two sets agree in a coordinate with
probability equal to their Jaccard similarity, and the share of agreeing coordinates is
concentrated as for independent samples.
"""

from __future__ import annotations

import numpy as np

from .text import U64, mix64, odd_multipliers

_STEP = U64(0x9E3779B97F4A7C15)


class Sketcher:
    def __init__(self, bands: int = 80, rows: int = 6, seed: int = 1):
        self.bands, self.rows, self.t = bands, rows, bands * rows
        self.seed = U64(seed)
        self._salt = mix64(np.arange(2 * self.t, dtype=U64) * _STEP + self.seed)
        self._mult = odd_multipliers(rows, seed + 17)
        self._band = mix64(np.arange(bands, dtype=U64) + U64(seed * 1000 + 7))

    def sketch(self, elements: np.ndarray) -> np.ndarray:
        """The ``t`` coordinates of a non-empty array of distinct 64-bit hashes."""
        t, n = self.t, len(elements)
        out = np.full(t, np.iinfo(np.uint64).max, dtype=U64)
        block = max(1, 3000 // n)  # rounds taken at once
        i = 0
        while i < t:
            j = min(i + block, t)
            h = mix64(elements[None, :] ^ self._salt[i:j, None])
            value = (np.arange(i, j, dtype=U64)[:, None] << U64(48)) | (h >> U64(16))
            np.minimum.at(out, ((h & U64(0xFFFFFFFF)) % U64(t)).astype(np.int64).ravel(),
                          value.ravel())
            i = j
            if out.max() != np.iinfo(np.uint64).max:
                return out
        for b in np.flatnonzero(out == np.iinfo(np.uint64).max):
            h = mix64(elements ^ self._salt[t + b]).min()
            out[b] = (U64(t + b) << U64(48)) | (h >> U64(16))
        return out

    def band_hashes(self, sketch: np.ndarray) -> np.ndarray:
        """One 64-bit hash per band of ``rows`` coordinates, the band's number mixed in."""
        return mix64((sketch.reshape(self.bands, self.rows) * self._mult).sum(axis=1, dtype=U64)
                     ^ self._band)
