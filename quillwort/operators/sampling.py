"""Samples, caps, budgets and allocations, all by rank of a seeded digest, so that they do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42
#: Rows that a top-k may hold.
FEW = 100_000


def rank_key(key: str | Column, seed: int = SEED) -> Column:
    """The digest by which rows are ranked: md5 of seed and key."""
    c = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def number_key(c: Column) -> Column:
    """A long as 16 hex digits that sort as the numbers do."""
    return F.lpad(F.hex(c.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")


def lowest(df: DataFrame, at: Column, k: int) -> DataFrame:
    """The k rows (all if there are fewer) with the lowest keys ``at``, hex text of one length; nulls are lowest.

    Few rows are a top-k. For many the cut is found by counting: the rows of each of 4096 beginnings,
    then of the beginnings within the one in which the cut lies, until few rows are left; so no
    task holds k rows. Rows with the key at the cut are equal; any of them are taken.
    """
    if k <= FEW:
        return df.orderBy(at).limit(max(0, k))
    keyed = df.withColumn("_at", F.coalesce(at, F.lit("")))
    inside, before, width = keyed.select("_at"), 0, 0
    while True:
        width += 3
        counts = inside.groupBy(F.substring("_at", 1, width).alias("b")).agg(F.count("*").alias("n"), F.max(F.length("_at")).alias("l")).collect()
        for b, n, longest in sorted(counts):
            if before + n >= k:
                break
            before += n
        else:
            return df
        if before + n == k:
            return keyed.where(F.substring("_at", 1, width) <= b).drop("_at")
        if n <= FEW or width >= longest:
            break
        inside = inside.where(F.substring("_at", 1, width) == b)
    cell = keyed.where(F.substring("_at", 1, width) == b)
    first = cell.orderBy("_at").limit(k - before) if n <= FEW else cell.limit(k - before)
    return keyed.where(F.substring("_at", 1, width) < b).unionByName(first).drop("_at")


def ranked(df: DataFrame, by: list[str], cell: Column, order: list[Column]) -> DataFrame:
    """Adds _rank, the place of a row in its group from 1, without a group in one task.

    ``cell`` must not decrease in ``order`` and cuts groups into parts that are sorted for
    themselves; a part begins where the counts of the parts before it end. Null groups are groups.
    """
    celled = df.withColumn("_cell", cell)
    sums = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    begins = celled.groupBy(*by, "_cell").agg(F.count("*").alias("_n")).select(
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_cell").alias("_own"), F.coalesce(F.sum("_n").over(sums), F.lit(0)).alias("_before")
    )
    same = F.col("_cell").eqNullSafe(F.col("_own"))
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"_by{i}"))
    place = F.row_number().over(Window.partitionBy(*by, "_cell").orderBy(*order))
    out = celled.withColumn("_place", place).join(begins, same).withColumn("_rank", F.col("_place") + F.col("_before"))
    return out.select(*df.columns, "_rank")


def number_cell(df: DataFrame, order: str) -> Column:
    """Which of 4096 equal parts of its range a number lies in; a single part for other types."""
    if df.schema[order].dataType.typeName() not in ("integer", "long", "short", "byte"):
        return F.lit(0)
    low, high = df.agg(F.min(order), F.max(order)).first()
    if low is None:
        return F.lit(0)
    return F.floor((F.coalesce(F.col(order), F.lit(low)) - F.lit(low)) / F.lit((high - low) / 4096 + 1e-9)).cast("int")


def sample_rows(df: DataFrame, k: int, key: str, seed: int = SEED) -> DataFrame:
    """k rows without replacement (all if there are fewer), by rank."""
    return lowest(df, rank_key(key, seed), k)


def sample_per_group(df: DataFrame, by: list[str], k: int | Column, key: str, seed: int = SEED) -> DataFrame:
    """Up to k rows of each group. With a number k, each task passes on at most k rows per group; with a column the ranks are taken in parts."""
    at = rank_key(key, seed)
    if isinstance(k, int):
        w = Window.partitionBy(*by).orderBy(at, key)
        return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")
    return ranked(df, by, F.substring(at, 1, 3), [at, F.col(key)]).where(F.col("_rank") <= k).drop("_rank")


def first_rows(df: DataFrame, by: list[str], order: str, k: int) -> DataFrame:
    """The first k rows of each group in order; each task passes on at most k rows per group."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(order))).where(F.col("_rank") <= k).drop("_rank")


def strided_sample(df: DataFrame, by: list[str], order: str, n: int) -> DataFrame:
    """Every s-th row of each group in order, s being its size / n rounded down, at least 1."""
    sizes = df.groupBy(*by).agg(F.count("*").alias("_n"))
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / n))
    placed = ranked(df, by, number_cell(df, order), [F.col(order)])
    return placed.join(sizes, by).where((F.col("_rank") - 1) % step == 0).drop("_rank", "_n")


def even_picks(df: DataFrame, by: list[str], order: str, n: int = 5) -> DataFrame:
    """The first n rows of each group's strided sample, which has less than 2 n + 1 rows."""
    return first_rows(strided_sample(df, by, order, n), by, order, n)


def cap_share(df: DataFrame, pool: Column, droppable: Column, key: str, cap: float = 0.35, seed: int = SEED) -> tuple[DataFrame, dict]:
    """Rows left after a pool's share was cut down to the cap by dropping pool rows that are droppable.

    If the pool is more than ``cap`` of all rows, int(cap * others / (1 - cap)) of it may stay.
    The counts come back too.
    """
    in_pool, loose = F.coalesce(pool, F.lit(False)), F.coalesce(droppable, F.lit(False))
    n, p, d = df.agg(F.count("*"), F.count_if(in_pool), F.count_if(in_pool & loose)).first()
    target = int(cap * (n - p) / (1 - cap))
    drop = min(d, max(0, p - target)) if n and p / n > cap else 0
    counts = {"n": n, "pool": p, "target": target, "dropped": drop}
    if not drop:
        return df, counts
    gone = sample_rows(df.where(in_pool & loose).select(key), drop, key, seed)
    return df.join(gone, key, "left_anti"), counts


def cap_replay(df: DataFrame, by: str, size: str, item: str, pool: Column, droppable: Column, key: str, cap: float = 0.35) -> DataFrame:
    """Per group how its total comes about: (by, raw, doubled, capped, final, status).

    raw is the sum over all rows, doubled what rows with the name of an earlier one add, capped what
    ``cap_share`` drops of the rest, final what is left, counted from the rows themselves. PASS if raw - doubled - capped = final.
    """
    first = df.groupBy(item).agg(F.min(key).alias(key))
    once = df.join(first, [item, key], "left_semi")
    kept, _ = cap_share(once, pool, droppable, key, cap)
    total = lambda rows, name: rows.groupBy(by).agg(F.sum(size).cast("long").alias(name))
    gone = once.join(kept.select(key), key, "left_anti")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    joined = total(df, "raw").join(total(once, "_once"), by, "left").join(total(gone, "capped"), by, "left").join(total(kept, "final"), by, "left")
    out = joined.select(by, "raw", (F.col("raw") - F.coalesce("_once", F.lit(0))).alias("doubled"), zero("capped"), zero("final"))
    return out.withColumn("status", F.when(F.expr("raw - doubled - capped = final"), "PASS").otherwise("FAIL"))


def background_budget(df: DataFrame, empty: Column, first: Column, order: str, share: float = 0.10) -> DataFrame:
    """Empty rows to be used as background: int(share * non-empty rows), the first half from ``first``, the rest from others, by ``order``, a number."""
    blank, preferred = F.coalesce(empty, F.lit(False)), F.coalesce(first, F.lit(False))
    n, a = df.agg(F.count_if(~blank), F.count_if(blank & preferred)).first()
    budget = int(share * n)
    take = min(a, budget // 2)
    at = number_key(F.col(order))
    return lowest(df.where(blank & preferred), at, take).unionByName(lowest(df.where(blank & ~preferred), at, budget - take))


def repeat_factor(frequency: Column, t: Column, top: float = 6.0) -> Column:
    """min(top, max(1, sqrt(t / f))); 1 for a class that never occurs."""
    return F.when(frequency > 0, F.least(F.lit(top), F.greatest(F.lit(1.0), F.sqrt(t / frequency)))).otherwise(1.0)


def repeat_grid(frequencies: DataFrame, ts: list[float]) -> DataFrame:
    """(value, t, share, r) of each class and each t."""
    grid = F.explode(F.array(*[F.lit(float(t)) for t in ts])).alias("t")
    return frequencies.select("value", "share", grid).withColumn("r", repeat_factor(F.col("share"), F.col("t")))


def choose_t(grid: DataFrame, guide: str, low: float = 3.0, high: float = 6.0) -> DataFrame:
    """One row: the first t with r of the guiding class in [low, high], else the last t, and whether that was needed."""
    fits = F.when((F.col("value") == guide) & F.col("r").between(low, high), F.col("t"))
    return grid.agg(F.coalesce(F.min(fits), F.max("t")).alias("t"), F.min(fits).isNull().alias("fallback"))


def row_repeats(df: DataFrame, joined: str, factors: DataFrame, key: str, separator: str = "+") -> DataFrame:
    """(key, repeats): the largest factor of a row's classes, rounded down, at least 1. ``factors`` has (value, r), a row per class."""
    pairs = F.map_from_entries(F.collect_list(F.struct("value", "r")))
    lookup = factors.agg(pairs.alias("_factors"))  # one row, an entry per class
    classes = F.split(F.coalesce(F.col(joined), F.lit("")), f"\\{separator}")
    best = F.array_max(F.transform(classes, lambda c: F.coalesce(F.try_element_at(F.col("_factors"), c), F.lit(1.0))))
    return df.join(F.broadcast(lookup)).select(key, F.greatest(F.lit(1), F.floor(best).cast("int")).alias("repeats"))


def repeat_rows(df: DataFrame, repeats: str) -> DataFrame:
    """Each row as often as it says, with copy_no from 1; null, 0 and negative counts give none."""
    return df.where(F.col(repeats) > 0).withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col(repeats))))


def largest_remainder(capacities: DataFrame, key: str, capacity: str, total: int) -> DataFrame:
    """(key, capacity, quota): ``total`` (at most the sum of capacities) in proportion, the rest by largest remainder, ties by key.

    One round is enough: a quota is at most its capacity. ``capacities`` is an aggregate with a row
    per key; only its remainders are ranked.
    """
    summed = capacities.agg(F.sum(capacity).alias("_sum"))
    quoted = capacities.join(F.broadcast(summed)).withColumn("_q", F.coalesce(F.try_divide(F.least(F.lit(total), F.col("_sum")) * F.col(capacity), F.col("_sum")), F.lit(0.0)))
    floors = quoted.withColumn("_f", F.floor(F.round("_q", 9))).withColumn("_rest", F.round(F.col("_q") - F.col("_f"), 9))
    placed = floors.agg(F.sum("_f").alias("_placed"))
    rank = F.row_number().over(Window.orderBy(F.col("_rest").desc(), key))
    return (
        floors.join(F.broadcast(placed)).withColumn("_rank", rank)
        .select(key, capacity, (F.col("_f") + (F.col("_rank") <= F.least(F.lit(total), F.col("_sum")) - F.col("_placed")).cast("long")).cast("long").alias("quota"))
    )


def stratified_sample(df: DataFrame, special: Column, by: str, key: str, n: int, share: float = 0.25, seed: int = SEED) -> DataFrame:
    """n rows: min(special rows, max(int(share * n), 1)) special ones, the rest from the others, allocated to ``by`` by largest remainder.

    Fewer than n come out only if the table is too small.
    """
    is_special = F.coalesce(special, F.lit(False))
    have = df.agg(F.count_if(is_special)).first()[0]
    n_special = min(have, max(int(share * n), 1))
    picked = sample_rows(df.where(is_special), n_special, key, seed)
    rest = df.where(~is_special)
    quotas = largest_remainder(rest.groupBy(by).agg(F.count("*").alias("_c")), by, "_c", n - n_special).select(by, "quota")
    others = sample_per_group(rest.join(F.broadcast(quotas), by), [by], F.col("quota"), key, seed).drop("quota")
    return picked.unionByName(others.select(picked.columns))


def floors_then_rest(df: DataFrame, by: str, key: str, floor: int, total: int, seed: int = SEED) -> DataFrame:
    """At least ``floor`` rows of each group (as far as it has them), then others by rank, ``total`` rows in all, with ``place``: their shuffled order from 1.

    Neither groups nor the table are sorted whole: each task passes on its first rows by rank.
    """
    at = rank_key(key, seed)
    must = sample_per_group(df, [by], floor, key, seed).withColumn("_late", F.lit(0))
    others = df.join(must.select(key), key, "left_anti").orderBy(at, key).limit(total).withColumn("_late", F.lit(1))
    chosen = must.unionByName(others).orderBy("_late", at, key).limit(total).drop("_late")
    return chosen.withColumn("place", F.row_number().over(Window.orderBy(rank_key(key, seed + 1), key)))  # total rows


def halves(sample: DataFrame, n: int) -> DataFrame:
    """The first n rows of a shuffled sample as train, the others as val."""
    return sample.withColumn("split", F.when(F.col("place") <= n, "train").otherwise("val"))
