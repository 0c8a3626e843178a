"""Exact and near duplicates, in order of arrival."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillwort.operators.hamming import near_values
from quillwort.session import discard, durable


def settle(rows: DataFrame, pairs: DataFrame, kept: Column | None = None) -> DataFrame:
    """The rows that stay when they are taken in order and one that repeats an earlier kept one is dropped.

    ``rows`` has (seq, digest, hash), seq being unique; ``pairs`` has (probe, stored) of all hashes
    that count as the same, equal ones included. Rows for which ``kept`` holds stay in any case. A row is
    kept once no earlier row that is still possible repeats it, and dropped once a kept earlier one
    does; so rows settle in rounds, in as many as the longest chain of repeats. Equal digests and
    hashes meet as one value each: a hot value is one row of a join, not a clique.
    """
    alive = F.when(F.col("state") != "dropped", F.col("seq"))
    taken = F.when(F.col("state") == "kept", F.col("seq"))
    state = F.lit("open") if kept is None else F.when(F.coalesce(kept, F.lit(False)), "kept").otherwise("open")
    rows = rows.withColumn("state", state).select("seq", "digest", "hash", "state")
    for round_ in count(1):
        by_digest = rows.where("digest is not null").groupBy("digest").agg(F.min(alive).alias("da"), F.min(taken).alias("dt"))
        by_hash = rows.where("hash is not null").groupBy(F.col("hash").alias("stored")).agg(F.min(alive).alias("a"), F.min(taken).alias("t"))
        near = pairs.join(by_hash, "stored").groupBy(F.col("probe").alias("hash")).agg(F.min("a").alias("ha"), F.min("t").alias("ht"))
        earlier = F.coalesce(F.least("da", "ha") < F.col("seq"), F.lit(False))
        beaten = F.least("dt", "ht") < F.col("seq")
        before, rows = rows, durable(
            rows.join(by_digest, "digest", "left").join(near, "hash", "left")
            .withColumn("state", F.when(F.col("state") != "open", F.col("state")).when(beaten, "dropped").when(earlier, "open").otherwise("kept"))
            .select("seq", "digest", "hash", "state")
        )
        if round_ > 1:
            discard(before)
        if rows.where("state = 'open'").isEmpty():
            return rows.where("state = 'kept'").select("seq", "digest", "hash")


def first_seen(rows: DataFrame, threshold: int = 8) -> tuple[DataFrame, DataFrame]:
    """(kept, drops) of (seq, digest, hash, incumbent): near-duplicate removal in order of seq.

    A row is dropped if its hash is within the threshold of an earlier kept row's; incumbents stay
    in any case. drops has (seq, matched_seq, distance): the closest earlier kept row, ties to the
    first. Rows without a hash are kept. Digests are not looked at.
    """
    plain = rows.select("seq", F.lit(None).cast("string").alias("digest"), "hash", F.coalesce("incumbent", F.lit(False)).alias("incumbent"))
    pairs = durable(near_values(plain, plain, "hash", threshold))
    kept = settle(plain, pairs, F.col("incumbent"))
    bank = kept.where("hash is not null").select(F.col("hash").alias("stored"), F.col("seq").alias("matched_seq"))
    gone = plain.join(kept.select("seq"), "seq", "left_anti").select("seq", F.col("hash").alias("probe"))
    best = (
        gone.join(pairs, "probe").join(bank, "stored").where("matched_seq < seq")
        .groupBy("seq").agg(F.min(F.struct("distance", "matched_seq")).alias("m"))
    )
    return kept.select("seq", "hash"), best.select("seq", F.col("m.matched_seq").alias("matched_seq"), F.col("m.distance").alias("distance"))


def exact_groups(df: DataFrame, digest: Column, key: str) -> DataFrame:
    """(digest, n, first): groups of rows with the same digest, of more than one row. Null digests are in no group."""
    return df.where(digest.isNotNull()).groupBy(digest.alias("digest")).agg(F.count("*").alias("n"), F.min(key).alias("first")).where("n > 1")


def redundancy(groups: DataFrame) -> DataFrame:
    """One row: number of groups and of redundant rows, that is all but one of each group."""
    return groups.agg(F.count("*").alias("n_groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("redundant"))


def exact_matches(candidates: DataFrame, incumbents: DataFrame, digest: str, key: str) -> DataFrame:
    """(key, matched, kind): each candidate whose digest an incumbent, else an earlier candidate, has; the first such row."""
    known = incumbents.where(F.col(digest).isNotNull()).groupBy(digest).agg(F.min(key).alias("_incumbent"))
    first = candidates.where(F.col(digest).isNotNull()).groupBy(digest).agg(F.min(key).alias("_first"))
    joined = candidates.join(known, digest, "left").join(first, digest, "left")
    earlier = F.when(F.col("_first") < F.col(key), F.col("_first"))
    return (
        joined.select(key, F.coalesce("_incumbent", earlier).alias("matched"), F.when(F.col("_incumbent").isNotNull(), "incumbent").otherwise("candidate").alias("kind"))
        .where("matched is not null")
    )


def cross_split_bytes(df: DataFrame, size: str, split: str, content: str) -> DataFrame:
    """(digest, n, splits): contents that lie in more than one split. Only sizes that more than one split has are digested."""
    shared = df.where(F.col(split).isNotNull()).select(size, split).distinct().groupBy(size).agg(F.count("*").alias("_n")).where("_n > 1").select(size)
    hashed = df.join(shared, size, "left_semi").select(F.sha2(content, 256).alias("digest"), split)
    cells = hashed.where(F.col(split).isNotNull()).groupBy("digest", split).agg(F.count("*").alias("_c"))
    return (
        cells.groupBy("digest").agg(F.sum("_c").alias("n"), F.array_join(F.array_sort(F.collect_set(split)), "+").alias("splits"))
        .where(F.col("splits").contains("+"))
    )


def keep_latest(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
