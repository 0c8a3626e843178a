"""Minwise signatures of 64-bit fingerprints and their band keys."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class Minwise:
    """Band keys of the minwise signature of a fingerprint, taken as the set of its 64 (position, bit) elements.

    A minwise value is the rank of the first element of the set in a random order of all 128. Two
    fingerprints that differ in h bits share 64 - h of 64 + h elements, so they agree in a value with
    probability (64 - h) / (64 + h): 0.78 at 8 bits, a third for unrelated ones. A key is a band of
    eight values, one byte each, with the number of the band in the bytes' highest bits; it is exact,
    not a hash. All keys are negative, so that they can stand beside keys of other kinds.
    """

    ROWS = 8

    def __init__(self, bands: int = 16, seed: int = 42):
        if not 1 <= bands <= 127:
            raise ValueError("1 to 127 bands are possible")
        self.bands, self.seed = bands, seed
        n = bands * self.ROWS
        orders = np.argsort(np.random.default_rng(seed).random((n, 128)), axis=1)
        ranks = np.argsort(orders, axis=1).astype(np.uint8).reshape(n, 64, 2)
        bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
        #: The least rank among the eight elements of each byte of a fingerprint, by byte, its value and the order.
        self.least = np.stack([ranks[:, np.arange(8 * b, 8 * b + 8), bits].min(axis=2).T for b in range(8)])
        number = (np.arange(1, bands + 1)[:, None] >> np.arange(self.ROWS - 1)) & 1
        self.marks = (np.concatenate([number, np.ones((bands, 1), int)], axis=1) << 7).astype(np.uint8)

    def signatures(self, hashes: np.ndarray) -> np.ndarray:
        """One row of minwise values per fingerprint."""
        parts = np.ascontiguousarray(hashes, "<i8").view(np.uint8).reshape(-1, 8)
        out = self.least[0][parts[:, 0]]
        for b in range(1, 8):
            np.minimum(out, self.least[b][parts[:, b]], out=out)
        return out

    def band_keys(self, hashes: np.ndarray) -> np.ndarray:
        """One row of ``bands`` keys per fingerprint."""
        signed = self.signatures(hashes).reshape(len(hashes), self.bands, self.ROWS) | self.marks
        return np.ascontiguousarray(signed).view("<i8").reshape(len(hashes), self.bands)

    def keys(self, value: Column) -> Column:
        """The keys of a column of fingerprints without nulls, an array of longs."""
        bands, seed = self.bands, self.seed

        @F.pandas_udf("array<bigint>")
        def of(hashes: pd.Series) -> pd.Series:
            return pd.Series(list(_cached(bands, seed).band_keys(hashes.to_numpy(np.int64))))

        return of(value)


_KNOWN: dict[tuple[int, int], Minwise] = {}


def _cached(bands: int, seed: int) -> Minwise:
    if (bands, seed) not in _KNOWN:
        _KNOWN[bands, seed] = Minwise(bands, seed)
    return _KNOWN[bands, seed]
