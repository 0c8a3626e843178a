"""Sessions by time gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sessionize(events: DataFrame, by: list[str], at: str, order: str, gap_seconds: int = 600, prefix: str = "s") -> DataFrame:
    """The events with day, session_no and session_id.

    Within each day of each ``by`` group, a new session begins where more than ``gap_seconds`` lie
    between an event and the one before; numbers begin anew each day. Ties in time follow ``order``.
    Events without a time have a null session. One shuffle by (by, day); the sort may spill.
    """
    dated = events.withColumn("day", F.to_date(at))
    w = Window.partitionBy(*by, "day").orderBy(at, order)
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    new = F.coalesce((micros - F.lag(micros).over(w) > gap_seconds * 1_000_000).cast("int"), F.lit(1))
    numbered = dated.withColumn("_new", new).withColumn(
        "session_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    )
    ident = F.concat_ws("_", F.lit(prefix), *[F.col(c).cast("string") for c in by], F.date_format("day", "yyyyMMdd"), F.format_string("s%02d", "session_no"))
    known = F.col(at).isNotNull()
    return (
        numbered.withColumn("session_no", F.when(known, F.col("session_no")))
        .withColumn("session_id", F.when(known, ident)).drop("_new")
    )
