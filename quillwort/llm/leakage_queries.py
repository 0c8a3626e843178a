"""Queries of problem 8: evaluation texts in the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.llm.leakage import leaked_items
from quillwort.session import table


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold 12 consecutive words of an evaluation item: the pairs of the search that need no edit."""
    return leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items")).where("edits = 0").select("doc_id", "item_id").distinct()


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """Per evaluation item the number of documents that hold a passage of it, exactly and within two edits."""
    items = table(spark, d, "eval_items")
    found = leaked_items(table(spark, d, "documents"), items).groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"))
    counts = found.groupBy("item_id").agg(F.count_if(F.col("edits") == 0).alias("n_docs"), F.count("*").alias("n_docs_near"))
    zero = F.lit(0)
    return (
        items.select("item_id", "task", "split").distinct().join(counts, "item_id", "left")
        .select("item_id", "task", "split", F.coalesce("n_docs", zero).alias("n_docs"), F.coalesce("n_docs_near", zero).alias("n_docs_near"))
    )


QUERIES = {"p8_found": p8_found, "p8_items": p8_items}
