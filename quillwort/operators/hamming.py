"""Joins of 64-bit fingerprints by Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwort.functions.bits import Bands, hamming
from quillwort.session import durable

#: Bank rows that one step holds against a block of queries, and an id beyond all ids.
_AT_ONCE, _TOP = 1024, np.iinfo(np.int64).max


def band_index(values: DataFrame, column: str, bands: Bands) -> DataFrame:
    """The stored side: (key, stored), one row per band of each distinct non-null hash."""
    distinct = values.select(F.col(column).alias("stored")).where("stored is not null").distinct()
    return distinct.select(F.explode(bands.stored_keys(F.col("stored"))).alias("key"), "stored")


def probe_index(probes: DataFrame, index: DataFrame, column: str, bands: Bands) -> DataFrame:
    """(probe, stored, distance) and further columns of the index: every pair of distinct hashes within the threshold, once.

    Both sides are distinct hashes, so groups of copies never multiply. The join is an equi-join
    on the band key, which adaptive execution splits where a key is hot. It is a merge join by hint:
    a side that looks small before its keys are spread out would be broadcast otherwise, and the
    other would stay in the few tasks that its hashes fit into.
    """
    distinct = probes.select(F.col(column).alias("probe")).where("probe is not null").distinct()
    keyed = distinct.select(F.explode(bands.probe_keys(F.col("probe"))).alias("key"), "probe")
    distance = hamming(F.col("probe"), F.col("stored"))
    return (
        keyed.hint("merge").join(index, "key")
        .where((distance <= bands.threshold) & (F.col("key") == bands.first_meeting(F.col("probe"), F.col("stored"))))
        .select("probe", *[c for c in index.columns if c != "key"], distance.alias("distance"))
    )


def near_values(left: DataFrame, right: DataFrame, column: str, threshold: int = 8, bands: int = 5) -> DataFrame:
    """(probe, stored, distance) of all distinct hashes of the two sides within ``threshold`` bits.

    Null hashes meet nothing; equal hashes meet at distance 0. Exact for every threshold below 64.
    """
    cut = Bands(threshold, bands)
    return probe_index(left, band_index(right, column, cut), column, cut)


def nearest(queries: DataFrame, bank: DataFrame, query_id: str, bank_id: str, column: str, block: int = 4096, others: bool = False) -> DataFrame:
    """Each query row's nearest bank row: (query_id, nearest_id, distance); ties to the smallest bank id.

    The distance is unbounded, so no key can prune: a stated query set is held against all rows of
    the bank, in blocks of about ``block`` distinct query hashes, one block at a time, and each task
    passes on the two best matches per query hash. With ``others`` a query is not its own neighbour:
    the bank row with its id is passed over. Queries with a null hash, and all queries if the bank
    is empty, have a null match.
    """
    rows = bank.where(F.col(column).isNotNull()).select(F.col(bank_id).cast("long").alias("id"), F.col(column).alias("b"))
    hashes = queries.select(F.col(column).alias("q")).where("q is not null").distinct()
    n = max(1, -(-hashes.count() // block))
    found = None
    for part in range(n):
        own = hashes.where(F.pmod(F.xxhash64("q"), F.lit(n)) == part).toPandas()["q"].to_numpy(np.int64)
        asked = queries.sparkSession.sparkContext.broadcast(own)

        def run(batches: Iterator[pd.DataFrame], asked=asked) -> Iterator[pd.DataFrame]:
            q = asked.value
            best, who = np.full((len(q), 2), 65, np.int64), np.full((len(q), 2), _TOP, np.int64)
            for batch in batches:
                for low in range(0, len(batch), _AT_ONCE):
                    ids = batch["id"].to_numpy(np.int64)[low : low + _AT_ONCE]
                    apart = np.bitwise_count((q[:, None] ^ batch["b"].to_numpy(np.int64)[low : low + _AT_ONCE]).view(np.uint64)).astype(np.int8)
                    near, them = [best], [who]
                    for _ in range(2):
                        least = apart.min(axis=1)
                        first = np.where(apart == least[:, None], ids, _TOP).min(axis=1)
                        near.append(least[:, None].astype(np.int64))
                        them.append(np.where(least < 65, first, _TOP)[:, None])
                        apart[ids == first[:, None]] = 65
                    near, them = np.concatenate(near, axis=1), np.concatenate(them, axis=1)
                    order = np.lexsort((them, near), axis=1)[:, :2]
                    best, who = np.take_along_axis(near, order, 1), np.take_along_axis(them, order, 1)
            hit = best < 65
            yield pd.DataFrame({"q": np.repeat(q, 2)[hit.ravel()], "distance": best[hit].astype(np.int32), "id": who[hit]})

        matches = rows.mapInPandas(run, "q long, distance int, id long")
        if n > 1:  # written, so that the next block need not wait beside this one
            matches = durable(matches)
            asked.unpersist()
        found = matches if found is None else found.unionByName(matches)
    best = found.groupBy("q").agg(F.slice(F.array_sort(F.collect_set(F.struct("distance", "id"))), 1, 2).alias("two"))  # two for each task
    joined = queries.select(query_id, column).join(best, F.col(column) == F.col("q"), "left")
    fits = F.filter("two", lambda x: x["id"] != F.col(query_id)) if others else F.col("two")
    return joined.withColumn("m", F.try_element_at(fits, F.lit(1))).select(query_id, F.col("m.id").alias("nearest_id"), F.col("m.distance").alias("distance"))
