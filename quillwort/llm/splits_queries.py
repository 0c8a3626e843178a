"""Queries of problem 1: splits that keep related records together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions.names import group_key, source_key, split_key
from quillwort.llm.components import assign_splits, linked_groups, torn_keys
from quillwort.session import durable, table


def manifest_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "manifest").select(
        "row_id", group_key("group_id").alias("group_key"), "final_stem", split_key("split").alias("now")
    )


def linked_rows(spark: SparkSession, d: str) -> DataFrame:
    """(row_id, component, group_key, now) of the manifest, linked by group and by stem, so a row written twice stays together."""
    keys = manifest_keys(spark, d)
    return keys.join(linked_groups(keys, "row_id", ["group_key", "final_stem"]).hint("merge"), "row_id").select("row_id", "component", "group_key", "now")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Groups of the manifest that the present split tears apart: the torn ones inside of torn components of linked rows."""
    return torn_keys(durable(linked_rows(spark, d).select("component", "group_key", "now").distinct()), "group_key", "now").select("group_key")


def split_rows(spark: SparkSession, d: str) -> DataFrame:
    """(row_id, component, split) of the manifest: whole components of linked rows in one split each."""
    linked = durable(linked_rows(spark, d).select("row_id", "component"))
    sizes = durable(linked.groupBy("component").agg(F.count("*").alias("n")))
    return linked.join(assign_splits(sizes, table(spark, d, "split_targets")).hint("merge"), "component").select("row_id", "component", "split")


def p1_splits(spark: SparkSession, d: str) -> DataFrame:
    """A split for every row of the manifest."""
    return split_rows(spark, d).select("row_id", "split")


def p1_shares(spark: SparkSession, d: str) -> DataFrame:
    """Rows, components and share reached per split, beside the target."""
    rows = split_rows(spark, d).groupBy("split", "component").agg(F.count("*").alias("n"))
    reached = rows.groupBy("split").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_components"))
    total = rows.agg(F.sum("n").alias("total"))
    targets = table(spark, d, "split_targets").select("split", "target_share")
    return (
        targets.join(reached, "split", "left").join(F.broadcast(total))  # one row
        .select("split", "target_share", F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                F.coalesce("n_components", F.lit(0)).alias("n_components"),
                F.round(F.coalesce("n_rows", F.lit(0)) / F.col("total"), 6).alias("share"))
    )


QUERIES = {"p1_found": p1_found, "p1_splits": p1_splits, "p1_shares": p1_shares}
