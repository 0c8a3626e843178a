"""Queries that run a stream over the events that are there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.functions.bits import fingerprint64
from quillwort.session import fresh_path, table
from quillwort.streaming.sessions import cache_writer, run_available, session_counts, thin_frames, tumbling_counts


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    source = spark.readStream.schema(table(spark, d, name).schema)
    return source.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).parquet(f"{d}/{name}.parquet*")


def st_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of each user that the watermark has closed."""
    return run_available(session_counts(_stream(spark, d, "events"), "ts", ["user_id"]), fresh_path(spark, "stream"))


def st_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Events per type and hour that the watermark has closed."""
    return run_available(tumbling_counts(_stream(spark, d, "events"), "ts", ["event_type"]), fresh_path(spark, "stream"))


def st_thinned(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings of each label that are not near a kept one of their label."""
    frames = _stream(spark, d, "embeddings").select(F.col("label").cast("string").alias("clip"), "vec_id", fingerprint64(F.col("embedding")).alias("hash"))
    return run_available(thin_frames(frames, "clip", "vec_id", "hash", 24), fresh_path(spark, "stream"))


def st_cache(spark: SparkSession, d: str) -> DataFrame:
    """Digests of the documents, added to a cache batch by batch; a batch written again adds nothing."""
    path = fresh_path(spark, "cache")
    digests = lambda b: b.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))
    write = cache_writer(path, "doc_id", digests)

    def twice(batch: DataFrame, no: int) -> None:
        write(batch, no)
        write(batch, no)

    stream = _stream(spark, d, "documents").where("text is not null").select("doc_id", "text")
    started = stream.writeStream.foreachBatch(twice).option("checkpointLocation", fresh_path(spark, "state")).trigger(availableNow=True).start()
    try:
        if not started.awaitTermination(600):
            raise TimeoutError("the stream did not end")
    finally:
        started.stop()
    return spark.read.parquet(path)


QUERIES = {f.__name__: f for f in (st_sessions, st_hourly, st_thinned, st_cache)}

SQL = {
    "st_cache": "select doc_id, md5(text) as digest from documents where text is not null",
    "st_sessions": """with k as (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 600 second then 0 else 1 end as new from events),
        s as (select *, sum(new) over (partition by user_id order by ts, event_id rows unbounded preceding) as no from k)
        select user_id, min(ts) as started, max(ts) as ended, count(*) as n_events from s group by user_id, no
        having max(ts) + interval 600 second <= (select max(ts) from events) - interval 10 minute""",
    "st_hourly": """select event_type, date_trunc('hour', ts) as started, count(*) as n_events from events group by 1, 2
        having date_trunc('hour', ts) + interval 1 hour <= (select max(ts) from events) - interval 10 minute""",
}
