"""Queries of problem 7: encoding the corpus with a public tokenizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.llm.bpe import encode
from quillwort.session import table


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """The ids of every document."""
    return encode(table(spark, d, "documents"), "doc_id", "text")


def p7_counts(spark: SparkSession, d: str) -> DataFrame:
    """Documents, characters and tokens per source."""
    documents = table(spark, d, "documents")
    counted = encode(documents, "doc_id", "text").select("doc_id", F.size("ids").alias("n_tokens"))
    per_id = counted.groupBy("doc_id").agg(F.max("n_tokens").alias("n_tokens"))
    return (
        documents.select("doc_id", "source", "n_chars").join(per_id, "doc_id")
        .groupBy("source")
        .agg(F.count("*").alias("n_docs"), F.coalesce(F.sum("n_chars"), F.lit(0)).alias("n_chars"), F.sum("n_tokens").alias("n_tokens"))
    )


QUERIES = {"p7_ids": p7_ids, "p7_counts": p7_counts}
