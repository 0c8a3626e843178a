"""Same or nearly the same records on both sides of a split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwort.functions.bits import Bands, hamming
from quillwort.session import durable


class RarePrefix:
    """Which bands of a hash are looked up, and within which radius: rare ones wide, frequent ones narrow or not at all.

    A shingle is a band of the hash at its position. Two hashes within the threshold agree on a
    band up to its radius as soon as the radii, each plus one, sum to more than the threshold; so a
    hash may leave out its most frequent shingles if it looks for the rare ones more widely.
    """

    def __init__(self, threshold: int = 8, bands: int = 5):
        self.cut = Bands(threshold, bands)
        self.plans = [p for p in (self._plan(skip) for skip in range(bands)) if p]

    def _plan(self, skipped: int) -> list[int] | None:
        """Radii from the rarest band to the most frequent one, of which ``skipped`` are left out."""
        used, need = self.cut.count - skipped, self.cut.threshold + 1
        radii = [need // used - 1 + (i < need % used) for i in range(used)] + [-1] * skipped
        return radii if radii[0] <= 2 else None

    def size(self, band: int, radius: int) -> int:
        w = self.cut.widths[band]
        return 0 if radius < 0 else 1 + (w if radius else 0) + (w * (w - 1) // 2 if radius > 1 else 0)

    def radii(self, counts: list[Column], mean: Column) -> Column:
        """The array of radii, by band, with the fewest candidates to be expected."""
        n = self.cut.count
        ranks = [
            sum(((counts[j] < counts[i]) | ((counts[j] == counts[i]) & F.lit(j < i))).cast("int") for j in range(n) if j != i) for i in range(n)
        ]
        options = []
        for plan in self.plans:
            chosen = [F.element_at(F.array(*map(F.lit, plan)), ranks[i] + 1) for i in range(n)]
            sizes = [F.element_at(F.array(*[F.lit(self.size(i, r)) for r in (-1, 0, 1, 2)]), chosen[i] + 2) for i in range(n)]
            cost = sum(F.when(sizes[i] > 0, counts[i] + (sizes[i] - 1) * mean + sizes[i]).otherwise(0.0) for i in range(n))
            options.append(F.struct(cost.alias("cost"), F.array(*chosen).alias("radii")))
        return (F.least(*options) if len(options) > 1 else options[0])["radii"]

    def keys(self, value: Column, radii: Column) -> Column:
        """The variants of each band within its radius."""
        arrays = []
        for i in range(self.cut.count):
            masks = F.lit(self.cut.flips(i, 2)).cast("array<bigint>")
            n = F.element_at(F.array(*[F.lit(self.size(i, r)) for r in (-1, 0, 1, 2)]), F.element_at(radii, i + 1) + 2)
            arrays.append(self.cut.variants(value, i, F.slice(masks, F.lit(1), n)))
        return F.flatten(F.array(*arrays))

    def meets_first(self, indexed: Column, radii: Column, probe: Column, key: Column) -> Column:
        """Whether ``key`` is the first key at which the two meet: each pair passes once."""
        out = F.lit(None).cast("long")
        for i in reversed(range(self.cut.count)):
            apart = F.bit_count(self.cut.part(indexed, i).bitwiseXOR(self.cut.part(probe, i)))
            out = F.when(apart <= F.element_at(radii, i + 1), self.cut.key(self.cut.part(probe, i), i)).otherwise(out)
        return key == out


def rare_prefix_pairs(held: DataFrame, train: DataFrame, column: str, threshold: int = 8, bands: int = 5) -> DataFrame:
    """(held, train, distance): all pairs of distinct hashes within the threshold, once each.

    The held-out hashes are indexed under their rare shingles (``RarePrefix``, from the frequencies
    of the training side), the training hashes probe with each shingle at its position. Before a
    pair is verified, its numbers of ones must differ by no more than the threshold. Null hashes
    meet nothing.
    """
    prefix = RarePrefix(threshold, bands)
    cut = prefix.cut
    probes = durable(train.select(F.col(column).alias("train")).where("train is not null").distinct())
    shingled = probes.select(F.explode(cut.stored_keys(F.col("train"))).alias("key"), "train")
    counts = shingled.groupBy("key").agg(F.count("*").cast("double").alias("n"))
    mean = max(1.0, probes.count()) / 2.0 ** min(cut.widths)
    values = held.select(F.col(column).alias("held")).where("held is not null").distinct()
    per_band = (
        values.select("held", F.posexplode(cut.stored_keys(F.col("held"))).alias("band", "key"))
        .join(counts, "key", "left")
        .groupBy("held")
        .agg(*[F.max(F.when(F.col("band") == i, F.coalesce("n", F.lit(0.0)))).alias(f"n{i}") for i in range(cut.count)])
    )
    indexed = per_band.withColumn("radii", prefix.radii([F.col(f"n{i}") for i in range(cut.count)], F.lit(mean)))
    indexed = indexed.select("held", "radii", F.explode(prefix.keys(F.col("held"), F.col("radii"))).alias("key"))
    distance = hamming(F.col("held"), F.col("train"))
    return (
        indexed.hint("merge").join(shingled, "key")  # by hint, as a side looks small before its keys are spread out
        .where(F.abs(F.bit_count("held") - F.bit_count("train")) <= threshold)
        .where(distance <= threshold)
        .where(prefix.meets_first(F.col("held"), F.col("radii"), F.col("train"), F.col("key")))
        .select("held", "train", distance.alias("distance"))
    )


def _sides(records: DataFrame) -> DataFrame:
    """(id, split, held, digest, hash) of the rows in a split, listed once each."""
    rows = records.where("split is not null").select("id", "split", "digest", "hash").distinct()
    return rows.withColumn("held", F.col("split") != "train")


def members(records: DataFrame) -> DataFrame:
    """(id, split, held, kind, value, digest, hash, rep): the classes a record of a split is in, those of its digest (exact) and of its hash (near).

    A class holds the records of one side, held out or train, with the same value; rep is its
    smallest id. Rows with neither digest nor hash are in no class.
    """
    kinds = F.array(
        F.when(F.col("digest").isNotNull(), F.struct(F.lit("exact").alias("kind"), F.col("digest").alias("value"))),
        F.when(F.col("hash").isNotNull(), F.struct(F.lit("near").alias("kind"), F.col("hash").cast("string").alias("value"))),
    )
    rows = durable(_sides(records).select("*", F.explode(F.array_compact(kinds)).alias("c")).select("id", "split", "held", "c.kind", "c.value", "digest", "hash"))
    reps = rows.groupBy("held", "kind", "value").agg(F.min("id").alias("rep"))
    return rows.join(reps.hint("merge"), ["held", "kind", "value"])


def cross_split_links(classes: DataFrame, threshold: int = 8) -> DataFrame:
    """(kind, train_rep, held_rep, distance): links between classes (``members``) of the two sides.

    kind is `exact` for the classes of one digest, at most one link for a digest, and `near` for those
    of hashes within the threshold, one link for each pair of distinct hashes; distance is null for
    exact links. All members of linked classes are twins, so no pair of records need be written.
    """
    reps = durable(classes.where("id = rep").select("held", "kind", "value", "hash", "rep").distinct())
    train = reps.where("not held").select("kind", "value", F.col("hash").alias("train"), F.col("rep").alias("train_rep"))
    held = reps.where("held").select("kind", "value", F.col("hash").alias("held"), F.col("rep").alias("held_rep"))
    exact = train.where("kind = 'exact'").hint("merge").join(held.drop("kind"), "value").select(F.lit("exact").alias("kind"), "train_rep", "held_rep", F.lit(None).cast("int").alias("distance"))
    train, held = (x.where("kind = 'near'").drop("kind", "value") for x in (train, held))
    pairs = rare_prefix_pairs(held.select(F.col("held").alias("hash")), train.select(F.col("train").alias("hash")), "hash", threshold)
    near = pairs.join(train.hint("merge"), "train").join(held.hint("merge"), "held").select(F.lit("near").alias("kind"), "train_rep", "held_rep", "distance")
    return exact.unionByName(near)


def cross_split_pairs(records: DataFrame, threshold: int = 8) -> DataFrame:
    """(train_id, held_id, kind, distance): pairs over the border between train and the held-out splits.

    ``records`` has (id, split, digest, hash). kind is `exact` for the same digest, else `near` for
    hashes within the threshold; distance is null where hashes cannot be compared. Rows in neither
    train, val nor test, and rows with neither digest nor hash, are in no pair; rows listed twice
    count once. Every pair is written, so copies multiply; ``cross_split_links`` and ``members`` say the same without.
    """
    classes = durable(members(records))
    links = cross_split_links(classes, threshold).drop("distance")
    train = classes.where("not held").select("kind", F.col("rep").alias("train_rep"), F.col("id").alias("train_id"), F.col("digest").alias("td"), F.col("hash").alias("th"))
    held = classes.where("held").select("kind", F.col("rep").alias("held_rep"), F.col("id").alias("held_id"), F.col("digest").alias("hd"), F.col("hash").alias("hh"))
    return (
        links.join(train.hint("merge"), ["kind", "train_rep"]).join(held.hint("merge"), ["kind", "held_rep"])
        .where((F.col("kind") == "exact") | ~F.coalesce(F.col("td") == F.col("hd"), F.lit(False)))
        .select("train_id", "held_id", "kind", hamming(F.col("th"), F.col("hh")).alias("distance"))
    )


def overlap_report(records: DataFrame, threshold: int = 8) -> DataFrame:
    """Per held-out split and source: records, and those with an exact, and with only a near, twin in train.

    A held-out record has such a twin if its class is linked, so the report is made of classes, not of pairs.
    """
    classes = durable(members(records))
    linked = cross_split_links(classes, threshold).select("kind", F.col("held_rep").alias("rep")).distinct()
    best = classes.where("held").join(linked.hint("merge"), ["kind", "rep"]).groupBy("id").agg(F.min("kind").alias("kind"))
    held = records.where("split in ('val', 'test')").select("id", "split", "source").distinct()
    return (
        held.join(best.hint("merge"), "id", "left")
        .groupBy("split", "source")
        .agg(F.count("*").alias("n_records"), F.count_if(F.col("kind") == "exact").alias("n_exact"), F.count_if(F.col("kind") == "near").alias("n_near"))
    )
