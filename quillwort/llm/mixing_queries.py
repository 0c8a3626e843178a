"""Queries of problem 2: mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions.names import source_key
from quillwort.llm.mixing import MixPlan, mix, mix_shares, plan_mixture
from quillwort.session import durable, table


def _boxes() -> Column:
    return F.greatest(F.coalesce(F.col("n_boxes").cast("long"), F.lit(0)), F.lit(0))


def _images(df: DataFrame, name: str, row: str, origin: str) -> DataFrame:
    """One row per image: rows with the same name count once, as the one written first. Rows without a name are images of their own."""
    rows = df.select(source_key("source").alias("key"), F.concat(F.lit(f"{origin}:"), F.coalesce(F.concat(F.lit("n:"), F.col(name)), F.concat(F.lit("r:"), F.col(row)))).alias("image"), F.col(row).alias("row"), _boxes().alias("size"))
    return rows.groupBy("image").agg(F.min_by(F.struct("key", "size"), "row").alias("r")).select("r.key", "image", "r.size")


def mix_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    images = _images(table(spark, d, "manifest"), "final_stem", "row_id", "manifest").unionByName(
        _images(table(spark, d, "candidate_records"), "relative_path", "record_id", "candidate")
    )
    targets = table(spark, d, "mix_targets").select("source", source_key("source").alias("key"), "target_share", "max_repeat")
    return images, targets


def _mixture(spark: SparkSession, d: str) -> MixPlan:
    images, targets = mix_inputs(spark, d)
    return plan_mixture(durable(images), targets, "image")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Target sources of which the mixture misses boxes, though each image is used max_repeat times."""
    return _mixture(spark, d).table().where("missing > 0").select("source")


def p2_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mixture: images in shards, shuffled within each."""
    return mix(_mixture(spark, d), "image")


def p2_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of boxes per source."""
    plan = _mixture(spark, d)
    return mix_shares(mix(plan, "image"), plan, "image")


QUERIES = {"p2_found": p2_found, "p2_mix": p2_mix, "p2_shares": p2_shares}
