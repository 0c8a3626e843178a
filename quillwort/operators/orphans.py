"""References to records that do not exist (or did not at the time)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwort.session import discard, durable, parallelism, pinned

_NEVER = np.iinfo(np.int64).max
#: Rows of parents and references for each range, and characters that the keys of one array of fixed width may have.
RANGE_ROWS, _WIDE = 2_000_000, 1 << 26


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per range: its number, first and last key, and the stays still open at its end, for its last key."""
    first = last = None
    part, net, single = -1, 0, True
    for b in batches:
        if not len(b):
            continue
        part = int(b["part"].iat[0])
        keys = b["key"].to_numpy()
        first = keys.min() if first is None else min(first, keys.min())
        top = keys.max()
        if last is None or top > last:
            single, net, last = last is None and keys.min() == top, 0, top
        elif keys.min() != last:
            single = False
        net += int(b["step"][keys == last].sum())
    if last is not None:
        yield pd.DataFrame({"part": [part], "first": [first], "last": [last], "net": [net], "single": [first == last]})


def _sortable(keys: np.ndarray) -> np.ndarray:
    """Keys as an array of fixed width where that is small and exact; else as objects, which compare more slowly."""
    width = max(map(len, keys), default=0)
    if width * len(keys) > _WIDE or any("\0" in k for k in keys):
        return keys
    return keys.astype(f"U{max(1, width)}")


class _Range:
    """The parents of one range as sorted arrays of keys and of the times their stays begin and end, searched by bisection."""

    def __init__(self, parents: pd.DataFrame, first: str | None, carried: int):
        self.keys, codes = np.unique(_sortable(parents["key"].to_numpy(dtype=object)), return_inverse=True)
        times = parents["at"].to_numpy(dtype=np.int64)
        self.times = np.unique(times)
        self.base = len(self.times) + 1
        ranks = np.searchsorted(self.times, times, side="right")
        begins = parents["step"].to_numpy() > 0
        self.begun = np.sort(codes[begins] * self.base + ranks[begins])
        self.ended = np.sort(codes[~begins] * self.base + ranks[~begins])
        self.first, self.carried = first, carried

    def open_at(self, keys: np.ndarray, times: np.ndarray) -> np.ndarray:
        """How many stays of each key are open at each time."""
        carried = np.where(keys == self.first, self.carried, 0)
        if not len(self.keys):
            return carried
        asked = _sortable(keys)
        held = self.keys if asked.dtype != object else self.keys.astype(object)
        codes = np.searchsorted(held, asked if held.dtype != object else keys)
        known = codes < len(held)
        known[known] = held[codes[known]] == asked[known]
        low = codes * self.base
        at = low + np.searchsorted(self.times, times, side="right")
        n = sum(
            sign * (np.searchsorted(side, at, side="right") - np.searchsorted(side, low, side="left"))
            for sign, side in ((1, self.begun), (-1, self.ended))
        )
        return np.where(known, n, 0) + carried


def _probe(carry: dict[int, tuple[str, int]]):
    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, searched = [], None
        for b in batches:
            if not len(b):
                continue
            parents = b[b["step"] != 0]
            if len(parents):
                held.append(parents)
            refs = b[b["step"] == 0]
            if not len(refs):
                continue
            if searched is None:
                first, carried = carry.get(int(b["part"].iat[0]), (None, 0))
                searched = _Range(pd.concat(held) if held else b.iloc[:0], first, carried)
            n = searched.open_at(refs["key"].to_numpy(dtype=object), refs["at"].to_numpy(dtype=np.int64))
            missed = refs[n <= 0]
            yield missed[["row", "field"]]

    return probe


def orphan_references(references: DataFrame, parents: DataFrame, ranges: int | None = None) -> DataFrame:
    """References without a parent at their time: (row, field).

    ``references`` has (row long, field string, key string, at timestamp), ``parents`` has (field,
    key, since timestamp, until timestamp). A parent exists from ``since`` (inclusive) to ``until``
    (exclusive; null: still). Keys are compared as they are, within a field.

    Keys are range-partitioned together with time, so a key that holds a third of all rows spreads
    over many ranges; what stays open of a key from one range into the next is carried by one small
    row per range. There is a range for each ``RANGE_ROWS`` rows. Within a range the parents are sorted
    arrays, and references are probed in batches by binary search.

    Defined results: null keys are no references. A reference with a null time is an orphan, as
    nothing exists at no time. A parent with a null key or ``since``, or one that ends before it
    begins, holds nothing. Parents that overlap or are listed twice count as one. Repeated
    references come out as often as they went in. Without parents all references are orphans.
    """
    spark = references.sparkSession
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    tagged = lambda: F.concat_ws("\x1f", "field", "key")
    stays = parents.where("key is not null and since is not null and (until is null or until > since)")
    begin = stays.select(tagged().alias("key"), micros("since").alias("at"), F.lit(1).alias("step"))
    end = stays.where("until is not null").select(tagged().alias("key"), micros("until").alias("at"), F.lit(-1).alias("step"))
    none = F.lit(None)
    events = begin.unionByName(end).select(
        "key", "at", F.lit(-1).cast("long").alias("salt"), "step", none.cast("long").alias("row"), none.cast("string").alias("field")
    )
    known = references.where("key is not null and at is not null").select(
        tagged().alias("key"), micros("at").alias("at"), F.xxhash64("row").bitwiseAND(F.lit(_NEVER)).alias("salt"),
        F.lit(0).alias("step"), "row", "field",
    )
    rows = durable(events.unionByName(known))  # the ranges are found in one pass over the keys as written, not by deriving them twice
    n = ranges or max(2, parallelism(spark), -(-rows.count() // RANGE_ROWS))
    ranged = (
        rows.repartitionByRange(n, "key", "at", "salt")
        .withColumn("part", F.spark_partition_id())
        .sortWithinPartitions(F.abs("step").desc())
    )
    ranged = pinned(ranged)
    discard(rows)
    edges = sorted(
        ranged.select("part", "key", "step").mapInPandas(_edges, "part int, first string, last string, net long, single boolean").collect()
    )
    carry, key, open_ = {}, None, 0
    for e in edges:
        if e["first"] == key:
            carry[e["part"]] = (key, open_)
        open_ = (open_ if e["single"] and e["last"] == key else 0) + e["net"]
        key = e["last"]
    found = ranged.mapInPandas(_probe(carry), "row long, field string")
    timeless = references.where("key is not null and at is null").select("row", "field")
    return found.unionByName(timeless)


def orphan_report(references: DataFrame, orphans: DataFrame, period: Column) -> DataFrame:
    """Per referenced table (field) and period: references and orphans. (row, field) must identify a reference."""
    missed = orphans.select("row", "field").distinct().withColumn("missed", F.lit(1))
    return (
        references.where("key is not null")
        .select("row", "field", period.alias("period"))
        .join(missed, ["row", "field"], "left")
        .groupBy("field", "period")
        .agg(F.count("*").alias("n_references"), F.count("missed").alias("n_orphans"))
    )
