"""Fail-closed checks: one row per check, gates from blockers, tolerances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_none(name: str, bad: DataFrame, detail: Column | None = None) -> DataFrame:
    """(check, status, n_bad, detail): PASS if ``bad`` has no row; detail is the smallest of its details, cut to 400 characters."""
    said = F.lit("") if detail is None else F.coalesce(F.min(detail.cast("string")), F.lit(""))
    return bad.agg(F.count("*").alias("n_bad"), F.substring(said, 1, 400).alias("detail")).select(
        F.lit(name).alias("check"), F.when(F.col("n_bad") == 0, "PASS").otherwise("FAIL").alias("status"), "n_bad", "detail"
    )


def check_value(name: str, actual: DataFrame, column: str, expected: float, tolerance: float = 0.0) -> DataFrame:
    """(check, status, n_bad, detail) of a one-row table's value against the expected one."""
    good = F.coalesce(F.abs(F.col(column) - expected) <= tolerance, F.lit(False))
    return actual.select(
        F.lit(name).alias("check"), F.when(good, "PASS").otherwise("FAIL").alias("status"), F.when(good, 0).otherwise(1).cast("long").alias("n_bad"),
        F.substring(F.concat(F.lit("got "), F.coalesce(F.col(column).cast("string"), F.lit("nothing"))), 1, 400).alias("detail"),
    )


def check_at_most(name: str, actual: DataFrame, column: str, limit: float, slack: float = 1e-12) -> DataFrame:
    """(check, status, n_bad, detail) of a one-row table's value that must not exceed the limit; a null value fails."""
    good = F.coalesce(F.col(column) <= limit + slack, F.lit(False))
    return actual.select(
        F.lit(name).alias("check"), F.when(good, "PASS").otherwise("FAIL").alias("status"), F.when(good, 0).otherwise(1).cast("long").alias("n_bad"),
        F.substring(F.concat(F.lit("got "), F.coalesce(F.round(column, 6).cast("string"), F.lit("nothing"))), 1, 400).alias("detail"),
    )


def stop_at_first(checks: DataFrame, order: list[str]) -> DataFrame:
    """The checks with ``place`` in the given order; those after the first that fails are SKIPPED, with nothing counted."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("check")).cast("int")
    placed = checks.withColumn("place", place)
    first = placed.where("status = 'FAIL'").agg(F.min("place").alias("_first"))
    skipped = F.coalesce(F.col("place") > F.col("_first"), F.lit(False))
    return placed.join(F.broadcast(first)).select(  # one row
        "place", "check", F.when(skipped, "SKIPPED").otherwise(F.col("status")).alias("status"), F.when(skipped, 0).otherwise(F.col("n_bad")).cast("long").alias("n_bad"),
        F.when(skipped, "").otherwise(F.col("detail")).alias("detail"),
    )


def all_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def gates(blockers: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """One row: a boolean per gate, true if no blocker's reason begins with the gate's prefix, and the status of all."""
    cells = [(~F.coalesce(F.bool_or(F.col("reason").startswith(p)), F.lit(False))).alias(g) for g, p in prefixes.items()]
    status = F.when(F.count("*") == 0, "READY_FOR_MERGE").otherwise("QUARANTINED").alias("status")
    return blockers.agg(*cells, status)


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """The table, with the job failing at the first row for which the condition does not hold; null does not hold."""
    return df.where(F.when(F.coalesce(condition, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df


def drift(before: DataFrame, now: DataFrame, on: list[str], metric: str, tolerance: float = 5e-4) -> DataFrame:
    """(on, before, now, drift, status): PASS where a metric moved by no more than the tolerance; FAIL also where a side lacks it."""
    b, n = before.select(*on, F.col(metric).alias("before")), now.select(*on, F.col(metric).alias("now"))
    moved = F.abs(F.col("now") - F.col("before"))
    return b.join(n, on, "full_outer").withColumn("drift", moved).withColumn(
        "status", F.when(F.coalesce(moved <= tolerance, F.lit(False)), "PASS").otherwise("FAIL")
    )


def in_unit_range(values: Column) -> Column:
    """Whether all numbers of an array lie in [0, 1]; null if one is null."""
    return F.forall(values, lambda x: (x >= 0) & (x <= 1))
