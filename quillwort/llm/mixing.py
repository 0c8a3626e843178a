"""Mixing of sources to target weights, with exact block quotas per output shard."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Blocks at least that a source's records are cut into, by hash, and records for each block beyond that.
LEAST_BLOCKS, BLOCK_ROWS = 64, 100_000
#: Output shards at least, and records for each shard beyond that.
LEAST_SHARDS, SHARD_ROWS = 64, 1_000_000
#: Places of blocks that are sent to every worker.
SENT = 200_000


def source_sizes(records: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target: (source, key, target_share, max_repeat, size, n_records, total, wanted).

    ``records`` has (key, size), one row per record; ``targets`` has (source, key, target_share,
    max_repeat). size is the source's sum, total that of all targets, wanted the target share of the
    total. Sources without records have size 0; records without a target count for nothing. Null
    shares and repeats count as 0.
    """
    targets = targets.select("source", "key", "target_share", "max_repeat")
    summed = records.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n_records"))
    joined = targets.join(summed, "key", "left").select(
        "source", "key",
        F.coalesce("target_share", F.lit(0.0)).alias("target_share"),
        F.coalesce("max_repeat", F.lit(0)).cast("long").alias("max_repeat"),
        F.coalesce("size", F.lit(0)).cast("long").alias("size"),
        F.coalesce("n_records", F.lit(0)).cast("long").alias("n_records"),
    )
    total = joined.agg(F.sum("size").alias("total"))
    return joined.join(F.broadcast(total)).withColumn("wanted", F.col("target_share") * F.col("total"))  # one row


def split_tree(counts: np.ndarray, sizes: list[int], rng: np.random.Generator) -> list[np.ndarray]:
    """Exact quotas: counts[i] blocks of source i are dealt to shards of the given sizes (sum(sizes) == sum(counts)).

    The shards are halved again and again; what each half gets of each source is one draw from the
    multivariate hypergeometric distribution, so every division of the blocks is equally likely.
    """
    if len(sizes) == 1:
        return [counts.copy()]
    half = len(sizes) // 2
    left = rng.multivariate_hypergeometric(counts, sum(sizes[:half]), method="marginals")
    return split_tree(left, sizes[:half], rng) + split_tree(counts - left, sizes[half:], rng)


@dataclass
class MixPlan:
    """What a mixture draws: the sources (as in ``source_sizes``, with n_blocks, drawn and missing), whole blocks and cut ones."""

    sources: list[dict]
    whole: list[tuple[str, int, int, int]]
    cut: list[tuple[str, int, int, int, int]]
    images: DataFrame

    def table(self) -> DataFrame:
        """(source, key, target_share, max_repeat, size, n_records, total, wanted, drawn, missing), a row per target."""
        columns = "source string, key string, target_share double, max_repeat long, size long, n_records long, total long, wanted double, drawn long, missing long"
        names = [c.split()[0] for c in columns.split(", ")]
        return self.images.sparkSession.createDataFrame([tuple(s[n] for n in names) for s in self.sources], columns)


def plan_mixture(records: DataFrame, targets: DataFrame, record_id: str, shards: int | None = None, seed: int = 42) -> MixPlan:
    """Deal the blocks of the sources to shards: what ``mix`` draws, and what is missing where a source is too small.

    The driver holds one size per block, that is a hundred thousand records of a source (a 64th of a
    smaller one), and max_repeat places for each.
    """
    sized = records.select("key", record_id, F.greatest(F.coalesce(F.col("size").cast("long"), F.lit(0)), F.lit(0)).alias("size"))
    sources = [r.asDict() for r in source_sizes(sized, targets).orderBy("source").collect()]
    for s in sources:
        s["n_blocks"] = max(LEAST_BLOCKS, -(-s["n_records"] // BLOCK_ROWS))
    shards = shards or max(LEAST_SHARDS, -(-sum(s["n_records"] for s in sources) // SHARD_ROWS))
    known = [x for s in sources if s["key"] is not None for x in (F.lit(s["key"]), F.lit(s["n_blocks"]))]
    blocks = F.element_at(F.create_map(*known), F.col("key")) if known else F.lit(None).cast("int")
    images = sized.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), record_id), blocks).cast("int")).where("block is not null")
    measured = images.groupBy("key", "block").agg(F.sum("size").alias("size")).collect()
    by_key = {s["key"]: s for s in sources}
    whole, cut, left = _plan(measured, {k: math.ceil(s["wanted"]) for k, s in by_key.items()}, {k: s["max_repeat"] for k, s in by_key.items()}, shards, seed)
    for s in sources:
        s["missing"] = left.get(s["key"], math.ceil(s["wanted"]))
        s["drawn"] = math.ceil(s["wanted"]) - s["missing"]
    return MixPlan(sources, whole, cut, images)


def _plan(blocks: list, quotas: dict[str, int], repeats: dict[str, int], shards: int, seed: int) -> tuple[list, list, dict[str, int]]:
    """(key, pass, block, shard) of whole blocks, (key, pass, block, shard, take) of cut ones, and what is left of each quota."""
    rng = np.random.default_rng(seed)
    sizes: dict[str, dict[int, int]] = {}
    for key, block, size in sorted((r["key"], r["block"], r["size"]) for r in blocks):
        sizes.setdefault(key, {})[block] = size
    dealt: dict[str, list[tuple[int, int, int | None]]] = {}
    unfilled: dict[str, int] = {}
    for key, own in sizes.items():
        left, dealt[key] = quotas[key], []
        for turn in range(repeats[key]):
            if left <= 0:
                break
            for block in rng.permutation(sorted(own)).tolist():
                if left <= 0 and own[block]:
                    break
                cut = own[block] > left
                dealt[key].append((turn, block, left if cut else None))
                left -= min(left, own[block])
        unfilled[key] = left
    keys = sorted(dealt)
    counts = np.array([len(dealt[k]) for k in keys], dtype=np.int64)
    n = int(counts.sum())
    if not n:
        return [], [], unfilled
    shards = max(1, min(shards, n))
    per_shard = [n // shards + (i < n % shards) for i in range(shards)]
    whole, cut, next_ = [], [], dict.fromkeys(keys, 0)
    orders = {k: rng.permutation(len(dealt[k])) for k in keys}
    for shard, quota in enumerate(split_tree(counts, per_shard, rng)):
        for k, q in zip(keys, quota.tolist(), strict=True):
            for at in orders[k][next_[k] : next_[k] + q]:
                turn, block, take = dealt[k][at]
                (whole.append((k, turn, block, shard)) if take is None else cut.append((k, turn, block, shard, take)))
            next_[k] += q
    return whole, cut, unfilled


def mix(plan: MixPlan, record_id: str, seed: int = 42) -> DataFrame:
    """(shard, position, source, record_id, pass, size): the mixture of a plan, shuffled within its shards.

    Each source is drawn in passes over its blocks, permuted anew in each pass, until its quota (its
    share of the total of all targets) is reached; a record is drawn at most max_repeat times. The last
    block is cut: its records follow in hash order until the rest of the quota is filled, the last one
    being taken if at least half of it fits. Records of size 0 (or null) come with their blocks
    and cost no quota, so a source used whole gives all of them; a source of quota 0 gives none.
    """
    spark, of_targets = plan.images.sparkSession, plan.images
    names = spark.createDataFrame([(s["key"], s["source"]) for s in plan.sources], "key string, source string")
    few = len(plan.whole) <= SENT
    places = spark.createDataFrame(plan.whole, "key string, pass int, block int, shard int")
    cuts = F.broadcast(spark.createDataFrame(plan.cut, "key string, pass int, block int, shard int, take long"))  # one per target
    taken = of_targets.join(F.broadcast(places) if few else places.hint("merge"), ["key", "block"]).select("key", record_id, "size", "pass", "shard")
    filled = F.sum("size").over(
        Window.partitionBy("key", "pass").orderBy(F.xxhash64(F.lit(seed), record_id, "pass"), record_id).rowsBetween(Window.unboundedPreceding, 0)
    )
    partly = (
        of_targets.join(cuts, ["key", "block"])
        .withColumn("filled", filled)
        .where(F.col("filled") - F.col("size") / 2 <= F.col("take"))
        .select("key", record_id, "size", "pass", "shard")
    )
    shuffled = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 1), "shard", record_id, "pass"), record_id, "pass")
    return (
        taken.unionByName(partly)
        .join(F.broadcast(names), "key")
        .withColumn("position", F.row_number().over(shuffled))
        .select("shard", "position", "source", record_id, "pass", "size")
    )


def mix_shares(mixture: DataFrame, plan: MixPlan, record_id: str) -> DataFrame:
    """Per target source what was drawn, what is missing of its quota, and its share of what was drawn and of what was wanted.

    What a source is missing is not made up from others: they keep to their share of the wanted
    total, and so have a larger share of the smaller mixture.
    """
    drawn = (
        mixture.groupBy("source", record_id).agg(F.count("*").alias("times"), F.sum("size").alias("size"))
        .groupBy("source")
        .agg(F.sum("size").alias("drawn_size"), F.sum("times").alias("n_drawn"), F.max("times").alias("most_repeats"))
    )
    total = drawn.agg(F.sum("drawn_size").alias("drawn_total"))
    zero = F.lit(0)
    share = lambda of: F.round(F.coalesce(F.try_divide(F.coalesce("drawn_size", zero), F.col(of)), F.lit(0.0)), 6)
    return (
        plan.table().select("source", "target_share", "max_repeat", "size", "total", "missing").join(drawn, "source", "left")
        .join(F.broadcast(total))  # one row
        .select(
            "source", "target_share", "max_repeat", "size", "missing",
            F.coalesce("drawn_size", zero).alias("drawn_size"), F.coalesce("n_drawn", zero).alias("n_drawn"),
            F.coalesce("most_repeats", zero).alias("most_repeats"),
            share("drawn_total").alias("actual_share"), share("total").alias("share_of_wanted"),
        )
    )
