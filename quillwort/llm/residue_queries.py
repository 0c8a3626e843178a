"""Queries of problem 9: template residue and error pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.llm.residue import residue
from quillwort.session import table


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose own content is, wholly or in part, template residue, filler, an error page or a script notice."""
    return residue(table(spark, d, "documents")).select("doc_id").distinct()


def p9_kept(spark: SparkSession, d: str) -> DataFrame:
    """Per source the documents that stay once the found ones are excluded, and the found ones by kind."""
    documents = table(spark, d, "documents").select("doc_id", "source")
    found = residue(table(spark, d, "documents"))
    per_doc = found.groupBy("doc_id").agg(*[F.max((F.col("kind") == k).cast("int")).alias(k) for k in ("field", "filler", "error", "script")])
    return (
        documents.join(per_doc, "doc_id", "left")
        .groupBy("source")
        .agg(F.count_if(F.col("field").isNull()).alias("n_kept"), *[F.coalesce(F.sum(k), F.lit(0)).alias(f"n_{k}") for k in ("field", "filler", "error", "script")])
    )


QUERIES = {"p9_found": p9_found, "p9_kept": p9_kept}
