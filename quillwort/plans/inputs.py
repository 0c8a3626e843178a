"""The driver's tables in normal form, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions.names import computed_hash, digest_key, group_key, source_key, split_key
from quillwort.session import table


def strip_sql(c: str) -> str:
    return rf"lower(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"


def split_sql(c: str) -> str:
    return f"case when {strip_sql(c)} in ('valid', 'validation') then 'val' when {strip_sql(c)} in ('train', 'val', 'test') then {strip_sql(c)} end"


def source_sql(c: str) -> str:
    return f"nullif(replace({strip_sql(c)}, '-', '_'), '')"


def group_sql(c: str) -> str:
    return f"nullif({strip_sql(c)}, '')"


def manifest(spark: SparkSession, d: str) -> DataFrame:
    boxes = F.greatest(F.coalesce("n_boxes", F.lit(0)), F.lit(0)).cast("long")
    return table(spark, d, "manifest").select(
        "row_id", source_key("source").alias("source"), split_key("split").alias("split"), group_key("group_id").alias("group_key"),
        "original_path", "original_class", "mapped_class", "final_stem", boxes.alias("n_boxes"), "width", "height", "built_at",
    )


MANIFEST = f"""m as (
  select row_id, {source_sql('source')} as source, {split_sql('split')} as split, {group_sql('group_id')} as group_key,
    original_path, original_class, mapped_class, final_stem, greatest(coalesce(n_boxes, 0), 0)::bigint as n_boxes, width, height, built_at
  from manifest)"""


def candidates(spark: SparkSession, d: str) -> DataFrame:
    boxes = F.greatest(F.coalesce("n_boxes", F.lit(0)), F.lit(0)).cast("long")
    return table(spark, d, "candidate_records").select(
        "record_id", "batch_id", source_key("source").alias("source"), split_key("official_split").alias("split"), group_key("group_id").alias("group_key"),
        "relative_path", "label_path", digest_key("sha256").alias("digest"), computed_hash("phash").alias("hash"), "width", "height",
        boxes.alias("n_boxes"), "mapped_classes", "empty_label", "issues", "audited_at",
    )


CANDIDATES = f"""c as (
  select record_id, batch_id, {source_sql('source')} as source, {split_sql('official_split')} as split, {group_sql('group_id')} as group_key,
    relative_path, label_path, nullif({strip_sql('sha256')}, '') as digest, nullif(phash, 0) as hash, width, height,
    greatest(coalesce(n_boxes, 0), 0)::bigint as n_boxes, mapped_classes, empty_label, issues, audited_at
  from candidate_records)"""
