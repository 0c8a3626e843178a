"""64-bit fingerprints: packing, distance and the band keys that make thresholded searches equi-joins."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hamming(a: Column, b: Column) -> Column:
    """Number of different bits of two longs; null if either is null."""
    return F.bit_count(a.bitwiseXOR(b))


def fingerprint64(values: Column) -> Column:
    """64 numbers to 64 bits, first number highest: 1 where the number exceeds the median of all but the first.

    Null or a length other than 64 gives null.
    """
    rest = F.array_sort(F.slice(values, 2, 63))
    median = F.element_at(rest, 32)
    packed = F.aggregate(
        values, F.lit(0).cast("long"), lambda acc, x: F.shiftleft(acc, 1).bitwiseOR(F.when(x > median, 1).otherwise(0).cast("long"))
    )
    return F.when(F.size(values) == 64, packed)


class Bands:
    """A cut of 64 bits into bands with a radius each, such that hashes within ``threshold`` meet.

    If every band of two hashes differed in more than its radius, they would differ in at least
    sum(radius + 1) bits. So with sum(radius + 1) > threshold at least one band is within its
    radius, and looking up all variants of a band within its radius misses no pair. A band with
    radius -1 is not looked up at all.
    """

    def __init__(self, threshold: int = 8, bands: int = 5):
        if not 0 <= threshold < 64 or not 2 <= bands <= 16:
            raise ValueError("threshold from 0 to 63 and 2 to 16 bands are possible")
        self.threshold, self.count = threshold, bands
        self.widths = [64 // bands + (i < 64 % bands) for i in range(bands)]
        self.shifts = [sum(self.widths[i + 1 :]) for i in range(bands)]
        self.radii = [(threshold + 1) // bands - 1 + (i < (threshold + 1) % bands) for i in range(bands)]

    def part(self, value: Column, i: int) -> Column:
        return F.shiftrightunsigned(value, self.shifts[i]).bitwiseAND(F.lit((1 << self.widths[i]) - 1).cast("long"))

    def flips(self, i: int, radius: int) -> list[int]:
        """All masks of at most ``radius`` bits of band i."""
        bits = [1 << b for b in range(self.widths[i])]
        return [sum(c) for n in range(radius + 1) for c in combinations(bits, n)]

    def key(self, part: Column, i: int) -> Column:
        """Band number and band value in one long."""
        return part.bitwiseOR(F.lit(i << 40).cast("long"))

    def variants(self, value: Column, i: int, masks: Column) -> Column:
        """The keys of band i with each of the masks applied."""
        part = self.part(value, i)
        return F.transform(masks, lambda m: self.key(part.bitwiseXOR(m), i))

    def stored_keys(self, value: Column) -> Column:
        """The keys under which a hash is stored: each band as it is. An array of longs."""
        return F.array(*[self.key(self.part(value, i), i) for i in range(self.count)])

    def probe_keys(self, value: Column, radii: list[int] | None = None) -> Column:
        """The keys under which a hash looks for others: each band's variants within its radius."""
        arrays = []
        for i, radius in enumerate(radii or self.radii):
            if radius < 0:
                continue
            arrays.append(self.variants(value, i, F.lit(self.flips(i, radius)).cast("array<bigint>")))
        return F.flatten(F.array(*arrays))

    def first_meeting(self, a: Column, b: Column, radii: list[int] | None = None) -> Column:
        """The key under which two hashes meet first, in order of the bands; null if they never meet.

        A join that keeps a pair only at this key gives every pair once, without a distinct.
        """
        out = F.lit(None).cast("long")
        for i, radius in reversed(list(enumerate(radii or self.radii))):
            if radius < 0:
                continue
            mask = ((1 << self.widths[i]) - 1) << self.shifts[i]
            mask = mask - (1 << 64) if mask >= 1 << 63 else mask
            near = F.bit_count(a.bitwiseXOR(b).bitwiseAND(F.lit(mask).cast("long"))) <= radius
            out = F.when(near, self.key(self.part(b, i), i)).otherwise(out)
        return out
