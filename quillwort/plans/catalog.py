"""All queries of the core library, by name, with the SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillwort.plans import assignment, data_quality, files, lookups, scalars, similarity, statistics, streams, validation

MODULES = (statistics, assignment, lookups, scalars, similarity, validation, streams, data_quality, files)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in module.SQL.items()}


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return validation.flagship(spark, d)
