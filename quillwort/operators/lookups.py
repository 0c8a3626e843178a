"""Joins of images with labels, families, expectations and earlier runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_label(images: DataFrame, labels: DataFrame, on: list[str], count: str) -> DataFrame:
    """Images with their label's count, 0 without a label. Labels listed twice count once, with the highest count."""
    one = labels.groupBy(*on).agg(F.max(count).alias(count))
    return images.join(one, on, "left").withColumn(count, F.coalesce(count, F.lit(0)))


def with_fallback(left: DataFrame, right: DataFrame, on: str, fallback: str, value: str) -> DataFrame:
    """``value`` of the match on ``on``; without one, the smallest value that shares ``fallback``. Adds ``matched_by``."""
    exact = right.where(F.col(on).isNotNull()).groupBy(on).agg(F.min(value).alias("_exact"))
    loose = right.where(F.col(fallback).isNotNull()).groupBy(fallback).agg(F.min(value).alias("_loose"))
    joined = left.join(exact, on, "left").join(loose, fallback, "left")
    by = F.when(F.col("_exact").isNotNull(), on).when(F.col("_loose").isNotNull(), fallback)
    return joined.withColumn(value, F.coalesce("_exact", "_loose")).withColumn("matched_by", by).drop("_exact", "_loose")


def resolve_label(images: DataFrame, labels: DataFrame, key: str, tiers: list[str], value: str) -> DataFrame:
    """(key, value, status): the label of the first tier (a column of both sides) with any match.

    One match in that tier is `found`, several are `ambiguous`, none in any tier `missing`.
    """
    out = images.select(key, *tiers)
    for i, tier in enumerate(tiers):
        counts = labels.where(F.col(tier).isNotNull()).groupBy(tier).agg(F.countDistinct(value).alias(f"_n{i}"), F.min(value).alias(f"_v{i}"))
        out = out.join(counts, tier, "left")
    n = F.coalesce(*[F.col(f"_n{i}") for i in range(len(tiers))])
    first = F.coalesce(*[F.col(f"_v{i}") for i in range(len(tiers))])
    status = F.when(n.isNull(), "missing").when(n == 1, "found").otherwise("ambiguous")
    return out.select(key, F.when(n == 1, first).alias(value), status.alias("status"))


def lookup_complete(df: DataFrame, dimension: DataFrame, on: list[str], value: str, strict: bool = True) -> DataFrame:
    """``df`` with the dimension's value; strict, a key the dimension lacks fails the job."""
    joined = df.join(dimension.select(*on, value), on, "left")
    if not strict:
        return joined
    lacking = F.raise_error(F.concat_ws(" ", F.lit("no entry for"), *[F.col(c).cast("string") for c in on])).cast(dimension.schema[value].dataType)
    return joined.withColumn(value, F.when(F.col(value).isNotNull(), F.col(value)).otherwise(lacking))


def both_ways_missing(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """(side, on): keys that only one side has. Null keys are on no side."""
    a = left.where(F.col(on).isNotNull()).select(on).distinct()
    b = right.where(F.col(on).isNotNull()).select(on).distinct()
    only = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), on, "full_outer").where("_a is null or _b is null")
    return only.select(F.when(F.col("_b").isNull(), "left").otherwise("right").alias("side"), on)


def shared_families(df: DataFrame, family: str, side: Column, a: str, b: str, dropped: Column) -> DataFrame:
    """(family, n_a, n_b, n_dropped): families with rows on both sides."""
    cells = df.where(F.col(family).isNotNull()).groupBy(family).agg(
        F.count_if(side == a).alias("n_a"), F.count_if(side == b).alias("n_b"), F.count_if(dropped).alias("n_dropped")
    )
    return cells.where("n_a > 0 and n_b > 0")


def reconcile(expected: DataFrame, actual: DataFrame, on: str, value: str) -> DataFrame:
    """(on, expected, actual, status): PASS where both have the same value; a side that lacks the key has null."""
    e = expected.select(F.col(on).alias("k"), F.col(value).alias("expected"))
    a = actual.select(F.col(on).alias("k"), F.col(value).alias("actual"))
    status = F.when(F.col("expected").eqNullSafe(F.col("actual")), "PASS").otherwise("FAIL")
    return e.join(a, "k", "full_outer").select(F.col("k").alias(on), "expected", "actual", status.alias("status"))


def head_to_head(control: DataFrame, treatment: DataFrame, on: list[str], metric: str) -> DataFrame:
    """(on, control, treatment, delta): a metric of two runs; a run without it counts as 0.0."""
    c = control.select(*on, F.col(metric).alias("control"))
    t = treatment.select(*on, F.col(metric).alias("treatment"))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0.0)).alias(name)
    joined = c.join(t, on, "full_outer").select(*on, zero("control"), zero("treatment"))
    return joined.withColumn("delta", F.col("treatment") - F.col("control"))


def stitch(earlier: DataFrame, later: DataFrame, epoch: str) -> DataFrame:
    """Two runs as one trajectory: the later run's epochs follow the last one of the earlier."""
    last = earlier.agg(F.coalesce(F.max(epoch), F.lit(0)).alias("_last"))
    moved = later.join(F.broadcast(last)).withColumn(epoch, F.col(epoch) + F.col("_last")).drop("_last")  # one row
    return earlier.unionByName(moved)
