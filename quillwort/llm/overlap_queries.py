"""Queries of problem 6: same or nearly the same records across splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions.names import computed_hash, digest_key, source_key, split_key
from quillwort.llm.overlap import cross_split_links, cross_split_pairs, members, overlap_report
from quillwort.session import table


def audited(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "candidate_records").select(
        F.col("record_id").alias("id"), split_key("official_split").alias("split"), source_key("source").alias("source"),
        digest_key("sha256").alias("digest"), computed_hash("phash").alias("hash"),
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of a training and a held-out record that are the same or nearly so, smaller record_id first."""
    pairs = cross_split_pairs(audited(spark, d))
    return pairs.select(F.least("train_id", "held_id").alias("record_id_a"), F.greatest("train_id", "held_id").alias("record_id_b"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Held-out records with a twin in train, per split and source."""
    return overlap_report(audited(spark, d))


def p6_links(spark: SparkSession, d: str) -> DataFrame:
    """Links between representatives of the classes of equal digests, and of equal hashes, on the two sides."""
    return cross_split_links(members(audited(spark, d)))


def p6_members(spark: SparkSession, d: str) -> DataFrame:
    """The classes of each record of a split, by their representatives."""
    return members(audited(spark, d)).select("id", "kind", "rep")


QUERIES = {"p6_found": p6_found, "p6_report": p6_report, "p6_links": p6_links, "p6_members": p6_members}
