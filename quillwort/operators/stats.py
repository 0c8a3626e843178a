"""Aggregations: composition, dependencies, exact percentiles, digests, rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillwort.session import durable

#: Cells into which a range is cut at each step of the exact percentiles, and values that end the steps.
CELLS, FEW = 1024, 100_000


def composition(df: DataFrame, by: list[str], part: Column, values: list[str], rest: str = "unsplit") -> DataFrame:
    """Per group one count column n_<value> for each value of ``part``, and n_<rest> for all others and null."""
    known = part.isin(*values)
    cells = [F.count_if(part == v).alias(f"n_{v}") for v in values]
    return df.groupBy(*by).agg(*cells, F.count_if(~F.coalesce(known, F.lit(False))).alias(f"n_{rest}"))


def composition_json(df: DataFrame, by: list[str], part: Column, rest: str = "unsplit") -> DataFrame:
    """Per group its counts by part as JSON text with sorted keys; null and blank parts count as ``rest``."""
    named = F.coalesce(F.nullif(part, F.lit("")), F.lit(rest))
    cells = df.groupBy(*by, named.alias("_part")).agg(F.count("*").alias("_n"))
    entries = F.array_sort(F.collect_list(F.struct("_part", "_n")))
    return cells.groupBy(*by).agg(F.to_json(F.map_from_entries(entries)).alias("mix"))


def dependency_violations(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n_values, values): keys with more than one distinct value. Nulls are no key and no value."""
    pairs = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).select(key, value).distinct()
    grouped = pairs.groupBy(key).agg(F.count("*").alias("n_values"), F.array_join(F.array_sort(F.collect_set(value)), "+").alias("found"))
    return grouped.where("n_values > 1")


def exact_percentiles(df: DataFrame, by: str, value: str, ps: dict[str, float]) -> DataFrame:
    """Per group the percentiles with linear interpolation, exact, without a group in one task.

    Each step counts the values of each group in ``CELLS`` equal cells of the range that holds the
    wanted ranks and keeps only those that fall into the cell, until few values are left; so what
    a task holds is bounded whatever a group's size. Nulls and NaN are not counted; a group without
    values, and a null group, is left out.
    """
    parts = []
    good = df.select(F.col(by).alias("g"), F.col(value).cast("double").alias("v")).where("v is not null and not isnan(v)")
    span = durable(good.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))
    for name, p in ps.items():
        for side in ("low", "high"):
            position = (F.col("n") - 1) * F.lit(float(p))
            rank = F.floor(position) if side == "low" else F.ceil(position)
            parts.append(span.select("g", F.lit(name).alias("name"), F.lit(side).alias("side"), position.alias("position"), rank.cast("long").alias("rank"), "lo", "hi", F.col("n").alias("held")))
    wanted = parts[0]
    for more in parts[1:]:
        wanted = wanted.unionByName(more)
    wanted = durable(wanted)
    while not wanted.where((F.col("held") > FEW) & (F.col("lo") < F.col("hi"))).isEmpty():
        cell = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * CELLS), F.lit(CELLS - 1))
        ranges = wanted.select("g", "lo", "hi").distinct()
        cells = (
            good.join(F.broadcast(ranges), "g").where("v >= lo and v <= hi")  # a few rows per group
            .withColumn("cell", F.when(F.col("lo") < F.col("hi"), cell).otherwise(0))
            .groupBy("g", "lo", "hi", "cell").agg(F.count("*").alias("k"), F.min("v").alias("clo"), F.max("v").alias("chi"))
        )
        w = Window.partitionBy("g", "lo", "hi").orderBy("cell")  # at most CELLS rows
        cells = cells.withColumn("before", F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("k"))
        wanted = durable(
            wanted.drop("held").join(cells, ["g", "lo", "hi"]).where("rank >= before and rank < before + k")
            .select("g", "name", "side", "position", (F.col("rank") - F.col("before")).alias("rank"), F.col("clo").alias("lo"), F.col("chi").alias("hi"), F.col("k").alias("held"))
        )
    ranges = wanted.select("g", "lo", "hi").distinct()
    sorted_ = good.join(F.broadcast(ranges), "g").where("v >= lo and v <= hi").groupBy("g", "lo", "hi", "v").agg(F.count("*").alias("k"))
    w = Window.partitionBy("g", "lo", "hi").orderBy("v")
    ranked = sorted_.withColumn("upto", F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    at = wanted.join(ranked, ["g", "lo", "hi"]).where("rank < upto and rank >= upto - k").select("g", "name", "side", "position", "v")
    both = at.groupBy("g", "name").agg(
        F.max(F.when(F.col("side") == "low", F.col("v"))).alias("a"), F.max(F.when(F.col("side") == "high", F.col("v"))).alias("b"), F.max("position").alias("position")
    )
    out = both.groupBy("g").agg(
        *[F.max(F.when(F.col("name") == n, F.col("a") + (F.col("b") - F.col("a")) * (F.col("position") - F.floor("position")))).alias(n) for n in ps]
    )
    return out.withColumnRenamed("g", by)


def share_below(df: DataFrame, by: list[str], value: str, limit: float) -> DataFrame:
    """Per group the share of values below the limit; nulls are not counted."""
    return df.groupBy(*by).agg(F.avg((F.col(value) < limit).cast("double")).alias("share"))


def mode_with_tie(df: DataFrame, by: list[str], value: Column, first: str) -> DataFrame:
    """Per group the most frequent value, ties to the one whose smallest ``first`` is lowest, and how often it occurs."""
    counted = df.groupBy(*by, value.alias("_v")).agg(F.count("*").alias("_n"), F.min(first).alias("_first"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col("_first"), F.col("_v")))
    return counted.groupBy(*by).agg(best.alias("_b"), F.count("*").alias("n_distinct")).select(
        *by, F.col("_b._v").alias("mode"), (-F.col("_b.n")).alias("mode_count"), "n_distinct"
    )


def histogram_of_counts(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """How many keys occur once, twice, ...: (n, n_keys)."""
    return df.groupBy(key).agg(F.count("*").alias(name)).groupBy(name).agg(F.count("*").alias("n_keys"))


def set_frequency(df: DataFrame, joined: str, separator: str = "+") -> DataFrame:
    """(value, n_rows, share) of each value of a joined set column: rows that contain it, over all rows."""
    total = df.agg(F.count("*").alias("total"))
    values = F.array_distinct(F.split(F.coalesce(F.col(joined), F.lit("")), f"\\{separator}"))
    counted = df.select(F.explode(values).alias("value")).where("value <> ''").groupBy("value").agg(F.count("*").alias("n_rows"))
    return counted.join(F.broadcast(total)).select("value", "n_rows", (F.col("n_rows") / F.col("total")).alias("share"))  # one row


def macro_average(df: DataFrame, by: list[str], metric: str, digits: int = 6) -> DataFrame:
    """The mean of a metric over its measured rows, rounded; 0.0 where none is measured."""
    return df.groupBy(*by).agg(F.coalesce(F.round(F.avg(metric), digits), F.lit(0.0)).alias("macro"))


def confusion_counts(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per class tp, fn and fp; a null on either side is background."""
    cells = df.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    as_truth = cells.where("t is not null").select(F.col("t").alias("class"), F.when(F.col("t").eqNullSafe(F.col("p")), F.col("n")).otherwise(0).alias("tp"), F.when(~F.col("t").eqNullSafe(F.col("p")), F.col("n")).otherwise(0).alias("fn"), F.lit(0).cast("long").alias("fp"))
    as_guess = cells.where("p is not null and not (t <=> p)").select(F.col("p").alias("class"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fn"), F.col("n").alias("fp"))
    return as_truth.unionByName(as_guess).groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "fn", "fp")])


def class_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 of each class; all null where the class has no ground truth."""
    present = F.col("tp") + F.col("fn") > 0
    precision = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))
    recall = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn"))
    measured = counts.select("class", present.alias("present"), F.when(present, precision).alias("precision"), F.when(present, recall).alias("recall"))
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-16)
    return measured.withColumn("f1", F.round(f1, 6)).withColumn("precision", F.round("precision", 6)).withColumn("recall", F.round("recall", 6))


def list_digests(df: DataFrame, by: str, order: str, line: Column, chunk: int = 1000) -> DataFrame:
    """(by, n_lines, digest) of each ordered list, computed over chunks of the order key, so that no list is in one task.

    The digest of a chunk is the SHA-256 of its lines, each ended by a line feed, in order; the
    digest of the list is that of its chunks' digests in order. Null lines count as empty.
    """
    place = F.floor(F.col(order) / chunk).alias("_chunk")
    lines = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(line, F.lit("")).alias("l"))))
    chunks = df.groupBy(by, place).agg(
        F.count("*").alias("_n"), F.sha2(F.concat(F.array_join(F.transform(lines, lambda x: x["l"]), "\n"), F.lit("\n")), 256).alias("_d")
    )
    parts = F.array_sort(F.collect_list(F.struct("_chunk", "_d")))
    return chunks.groupBy(by).agg(F.sum("_n").alias("n_lines"), F.sha2(F.array_join(F.transform(parts, lambda x: x["_d"]), "\n"), 256).alias("digest"))


def human_bytes(n: Column) -> Column:
    """Bytes with a unit, one decimal."""
    out = F.format_string("%.1f TB", n / 1e12)
    for unit, size in (("GB", 1e9), ("MB", 1e6), ("KB", 1e3)):
        out = F.when(n < size * 1e3, F.format_string(f"%.1f {unit}", n / size)).otherwise(out)
    return F.when(n < 1e3, F.format_string("%d B", n.cast("long"))).otherwise(out)
