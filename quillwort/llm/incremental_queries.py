"""Queries of problem 5: new batches against all history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions.names import computed_hash, digest_key, source_key
from quillwort.llm.incremental import AcceptedIndex, dedupe_batches
from quillwort.session import fresh_path, table

#: The sources that were there first.
INCUMBENTS = ("kanal_fx",)


def _keys(df: DataFrame, *more: str) -> DataFrame:
    return df.select("image_id", *more, digest_key("sha256").alias("digest"), computed_hash("phash").alias("hash"))


def _cases(spark: SparkSession, d: str) -> DataFrame:
    """The cases of all batches: the history is indexed once, and all batches probe the index."""
    index = AcceptedIndex.create(spark, fresh_path(spark, "accepted"))
    try:
        index.append(_keys(table(spark, d, "accepted_images")).where("image_id is not null"))
        return dedupe_batches(index, _keys(table(spark, d, "incoming_images"), "batch_no"))
    finally:
        index.drop()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Incoming images that repeat an accepted one, each with its match."""
    return _cases(spark, d).select("matched_id", "image_id")


def match_category(donor: Column, matched_donor: Column) -> Column:
    """vs_existing for a match of an incumbent source, within_donor for the same donor, else cross_donor:<donor>."""
    mine, other = source_key(donor), source_key(matched_donor)
    return (
        F.when(other.isin(*INCUMBENTS), F.lit("vs_existing"))
        .when(mine.eqNullSafe(other), F.lit("within_donor"))
        .otherwise(F.concat(F.lit("cross_donor:"), F.coalesce(other, F.lit(""))))
    )


def p5_dropped(spark: SparkSession, d: str) -> DataFrame:
    """The drops in the form of dedupe_result."""
    about = ("donor", "split", "stem", "path")
    incoming = table(spark, d, "incoming_images").select("image_id", *about)
    all_ = table(spark, d, "accepted_images").select("image_id", *about).unionByName(incoming)
    matched = all_.select(F.col("image_id").alias("matched_id"), *[F.col(c).alias(f"matched_{c}") for c in ("donor", "stem", "path")])
    return (
        _cases(spark, d).join(incoming, "image_id").join(matched, "matched_id")
        .select(*about, "matched_donor", "matched_stem", "matched_path", "hamming", match_category(F.col("donor"), F.col("matched_donor")).alias("category"))
    )


QUERIES = {"p5_found": p5_found, "p5_dropped": p5_dropped}
