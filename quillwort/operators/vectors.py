"""Cosine neighbours of embedding vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Vectors of the query set that one pass over the bank holds.
BLOCK = 8192


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers, null if either is null or has no length."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return F.try_divide(dot, norm(a) * norm(b))


def _unit(vectors: pd.Series) -> np.ndarray:
    m = np.stack([np.asarray(v, np.float64) for v in vectors])
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def cosine_search(queries: DataFrame, bank: DataFrame, key: str, vector: str, threshold: float | None = None) -> DataFrame:
    """(key, neighbour, cosine) of a stated query set against all rows of a bank.

    Without a threshold the nearest neighbour of each query, ties to the smallest key; with one, all
    neighbours at or above it. A row is not its own neighbour. Cosines are rounded to 4 digits.
    Queries are sent to the bank in blocks of ``BLOCK`` vectors; within a task a block and a batch of
    the bank are one matrix product, and without a threshold each task passes on one row per query.
    Null vectors and vectors of length 0 have no neighbours.
    """
    asked = queries.where(F.col(vector).isNotNull()).select(key, vector)
    rows = bank.where(F.col(vector).isNotNull()).select(key, vector)
    n = max(1, -(-asked.count() // BLOCK))
    out = None
    for part in range(n):
        own = asked.where(F.pmod(F.xxhash64(key), F.lit(n)) == part).toPandas()
        if not len(own):
            continue
        ids = own[key].to_numpy()
        block = queries.sparkSession.sparkContext.broadcast((ids, _unit(own[vector])))

        def run(batches: Iterator[pd.DataFrame], block=block) -> Iterator[pd.DataFrame]:
            asked_ids, asked_units = block.value
            live = (asked_units != 0).any(axis=1)
            best, who = np.full(len(asked_ids), -np.inf), np.zeros(len(asked_ids), np.int64)
            for b in batches:
                if not len(b):
                    continue
                keys, units = b[key].to_numpy(), _unit(b[vector])
                scores = np.round(asked_units @ units.T, 4)
                scores[:, ~(units != 0).any(axis=1)] = -np.inf
                scores[~live] = -np.inf
                scores[asked_ids[:, None] == keys[None, :]] = -np.inf
                if threshold is not None:
                    i, j = np.nonzero(scores >= threshold)
                    if len(i):
                        yield pd.DataFrame({key: asked_ids[i], "neighbour": keys[j], "cosine": scores[i, j]})
                    continue
                top = scores.max(axis=1)
                low = np.where(scores == top[:, None], keys[None, :], np.iinfo(np.int64).max).min(axis=1)
                better = (top > best) | ((top == best) & (low < who))
                best, who = np.where(better, top, best), np.where(better, low, who)
            if threshold is None:
                found = np.isfinite(best)
                yield pd.DataFrame({key: asked_ids[found], "neighbour": who[found], "cosine": best[found]})

        found = rows.mapInPandas(run, f"{key} long, neighbour long, cosine double")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return queries.sparkSession.createDataFrame([], f"{key} long, neighbour long, cosine double")
    if threshold is not None:
        return out
    best = out.groupBy(key).agg(F.min(F.struct((-F.col("cosine")).alias("c"), "neighbour")).alias("m"))
    return best.select(key, F.col("m.neighbour").alias("neighbour"), (-F.col("m.c")).alias("cosine"))
