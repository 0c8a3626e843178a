"""Streams: sessions with a watermark, hash caches, and thinning of frames."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwort.sources.sinks import append_cache


def session_counts(events: DataFrame, at: str, by: list[str], gap_seconds: int = 600, late: str = "10 minutes") -> DataFrame:
    """(by, started, ended, n_events) of sessions by gap, final once the watermark has passed; later events are dropped.

    A gap of exactly ``gap_seconds`` keeps a session together, as in the batch operator: the window is a microsecond longer.
    """
    timed = events.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late)
    window = F.session_window("_at", f"{gap_seconds} seconds 1 microsecond")
    counted = timed.groupBy(*by, window.alias("_w")).agg(F.count("*").alias("n_events"), F.min("_at").alias("started"), F.max("_at").alias("ended"))
    return counted.select(*by, "started", "ended", "n_events")


def tumbling_counts(events: DataFrame, at: str, by: list[str], width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(by, started, n_events) of windows of fixed width."""
    timed = events.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late)
    return timed.groupBy(*by, F.window("_at", width).alias("_w")).agg(F.count("*").alias("n_events")).select(*by, F.col("_w.start").alias("started"), "n_events")


def cache_writer(path: str, key: str, compute: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that adds the values of new keys to a cache table. A batch written again adds nothing."""

    def write(batch: DataFrame, _: int) -> None:
        append_cache(compute(batch.dropDuplicates([key])), path, key)

    return write


def thin_frames(frames: DataFrame, clip: str, seq: str, fingerprint: str, threshold: int = 8) -> DataFrame:
    """(clip, seq) of the frames of a stream that are kept: those not within ``threshold`` bits of a kept frame of their clip.

    The state of a clip is the fingerprints kept so far, in order of arrival, 8 bytes each; it grows with what is kept
    of the clip, not with its frames, so clips should be cut where they get long. Within a batch frames are taken by seq.
    Frames without a fingerprint are kept.
    """

    def run(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        kept = np.array(state.get[0] if state.exists else [], np.int64)
        rows = pd.concat(list(batches)).sort_values(seq)
        out = []
        for n, h in zip(rows[seq], rows[fingerprint], strict=True):
            if pd.isna(h):
                out.append(n)
                continue
            if (np.bitwise_count((kept ^ np.int64(int(h))).view(np.uint64)) > threshold).all():
                kept = np.append(kept, np.int64(int(h)))
                out.append(n)
        state.update((kept.tolist(),))
        yield pd.DataFrame({clip: [key[0]] * len(out), seq: out})

    chosen = frames.select(F.col(clip).cast("string").alias(clip), F.col(seq).cast("long").alias(seq), F.col(fingerprint).cast("long").cast("string").alias(fingerprint))
    return chosen.groupBy(clip).applyInPandasWithState(run, f"{clip} string, {seq} long", "kept array<long>", "append", "NoTimeout")


def run_available(query: DataFrame, path: str, timeout: int = 600) -> DataFrame:
    """Run a stream over what is there into parquet files below ``path``, and return them as a table.

    Files are committed exactly once; results that the watermark has not passed stay in the state.
    Stops after ``timeout`` seconds at the latest.
    """
    started = (
        query.writeStream.outputMode("append").format("parquet").option("path", f"{path}/table")
        .option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    )
    try:
        if not started.awaitTermination(timeout):
            raise TimeoutError(f"the stream did not end within {timeout} s")
    finally:
        started.stop()
    return query.sparkSession.read.schema(query.schema).parquet(f"{path}/table")
