"""Group-level split assignment: folds over groups in a fixed order, one unit after another."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLITS = ("train", "val", "test")
SHARES = (0.8, 0.1, 0.1)


def _fold(groups: DataFrame, unit: str, group: str, size: str, start: Callable, step: Callable, value: str) -> DataFrame:
    """A running decision over each unit's groups, largest first, ties by group.

    The groups of a unit pass in sorted order through one task, which keeps only the running sums:
    the decision depends on all earlier ones, so it cannot be split, but a unit's groups are
    never held at once, and rows were aggregated to groups before.
    """
    fields = f"{unit} string, {group} string, {size} long, {value} string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for b in batches:
            out = []
            for u, n, total in zip(b[unit], b[size], b["_total"], strict=True):
                if state is None or u != current:
                    current, state = u, start(total)
                out.append(step(state, n))
            yield pd.DataFrame({unit: b[unit], group: b[group], size: b[size], value: out})

    totals = groups.groupBy(unit).agg(F.sum(size).alias("_total"))
    return (
        groups.join(totals, unit)
        .select(F.col(unit).cast("string"), F.col(group).cast("string"), F.col(size).cast("long"), "_total")
        .repartition(unit).sortWithinPartitions(F.col(unit), F.col(size).desc(), F.col(group))
        .mapInPandas(run, fields)
    )


def assign_greedy(groups: DataFrame, unit: str, group: str, size: str, shares: tuple[float, float, float] = SHARES) -> DataFrame:
    """(unit, group, size, split): each group to train, else val, if it overshoots its share by at most half of itself; else test."""

    def start(total: int) -> list[float]:
        return [0.0, 0.0, total * shares[0], total * shares[1]]

    def step(s: list[float], n: int) -> str:
        for i in (0, 1):
            if s[i] + n <= s[i + 2] + 0.5 * n:
                s[i] += n
                return SPLITS[i]
        return SPLITS[2]

    return _fold(groups, unit, group, size, start, step, "split")


def assign_lightest(groups: DataFrame, unit: str, group: str, size: str, shares: tuple[float, float, float] = SHARES) -> DataFrame:
    """(unit, group, size, split): each group into the lightest of three bins, then the bins to the splits they fit best.

    Of the six ways to name the bins the one with the smallest sum of differences from the shares
    wins, ties to the first in order.
    """

    def step(s: list[int], n: int) -> str:
        i = min(range(3), key=lambda k: (s[k], k))
        s[i] += n
        return str(i)

    binned = _fold(groups, unit, group, size, lambda _: [0, 0, 0], step, "bin")
    sums = binned.groupBy(unit).agg(F.sum(size).alias("t"), *[F.coalesce(F.sum(F.when(F.col("bin") == str(i), F.col(size))), F.lit(0)).alias(f"s{i}") for i in range(3)])
    ways = []
    for order, way in enumerate(permutations(range(3))):
        error = sum(F.abs(F.col(f"s{b}") / F.col("t") - share) for b, share in zip(way, shares, strict=True))
        names = F.create_map(*[x for b, s in zip(way, SPLITS, strict=True) for x in (F.lit(str(b)), F.lit(s))])
        ways.append(F.struct(F.round(error, 12).alias("error"), F.lit(order).alias("order"), names.alias("names")))
    best = F.array_sort(F.array(*[F.struct(w["error"].alias("error"), w["order"].alias("order")) for w in ways]))[0]["order"]
    named = sums.select(F.col(unit).alias("_u"), F.element_at(F.array(*[w["names"] for w in ways]), best + 1).alias("names"))
    return binned.join(named, F.col(unit).eqNullSafe(F.col("_u"))).select(unit, group, size, F.element_at("names", F.col("bin")).alias("split"))


def split_ratios(assigned: DataFrame, unit: str, size: str, shares: tuple[float, float, float] = SHARES) -> DataFrame:
    """Per unit the share of each split, rounded to 3 digits, and the sum of differences from the targets."""
    total = F.sum(size)
    parts = [F.round(F.coalesce(F.sum(F.when(F.col("split") == s, F.col(size))), F.lit(0)) / total, 3).alias(s) for s in SPLITS]
    ratios = assigned.groupBy(unit).agg(F.count("*").alias("n_groups"), *parts)
    return ratios.withColumn("err", F.round(sum(F.abs(F.col(s) - share) for s, share in zip(SPLITS, shares, strict=True)), 6))


def choose_method(greedy: DataFrame, lightest: DataFrame, unit: str, size: str) -> DataFrame:
    """Per unit both errors and the method with the smaller one, greedy on ties."""
    a = split_ratios(greedy, unit, size).select(unit, "n_groups", F.col("err").alias("greedy_err"))
    b = split_ratios(lightest, unit, size).select(unit, F.col("err").alias("lightest_err"))
    return a.join(b, unit).withColumn("chosen", F.when(F.col("greedy_err") <= F.col("lightest_err"), "greedy").otherwise("lightest"))


def propose_balanced(groups: DataFrame, unit: str, group: str, size: str, weighted: bool = False, shares: tuple[float, float, float] = SHARES) -> DataFrame:
    """(unit, group, size, split): largest group first to the split with the fewest rows so far, ties alphabetical.

    Weighted, each split's rows count relative to its share.
    """
    names = sorted(SPLITS)
    weight = dict(zip(SPLITS, shares, strict=True)) if weighted else dict.fromkeys(SPLITS, 1.0)

    def step(s: dict[str, int], n: int) -> str:
        split = min(names, key=lambda k: (s[k] / weight[k], k))
        s[split] += n
        return split

    return _fold(groups, unit, group, size, lambda _: dict.fromkeys(SPLITS, 0), step, "split")
