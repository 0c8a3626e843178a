"""Connected components by frontier search from many seeds, and splits that keep components together.

Joins of tables that grow with the data are merge joins by hint: written tables are compressed, and
one that looks small enough to broadcast may be many times as large in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwort.session import discard, durable

#: Bits of the hash order that the driver sees the sizes of at once.
STEP = 12


def _order(c: str) -> F.Column:
    """The hash order of nodes, ties by the node itself."""
    return F.struct(F.xxhash64(F.lit(42), F.col(c)).alias("h"), F.col(c).alias("n"))


def _grow(edges: DataFrame) -> DataFrame:
    """(node, seed): every node of a symmetric, non-empty edge table with the seed that reached it first.

    Seeds are the nodes that precede all their neighbours in hash order, so each component has one.
    All seeds expand at once; a frontier is joined with the adjacency, which is hash-partitioned by
    node once, and a node that several seeds reach in one round takes the smallest.
    """
    lowest = edges.groupBy("src").agg(F.min(_order("dst")).alias("low"))
    seeded = lowest.select(F.col("src").alias("node"), F.when(_order("src") < F.col("low"), F.col("src")).alias("seed"))
    labels = durable(seeded)
    frontier = labels.where("seed is not null")
    open_ = labels.where("seed is null").select("node")
    while not open_.isEmpty():
        reached = (
            frontier.withColumnRenamed("node", "src")
            .join(edges.hint("merge"), "src")
            .groupBy(F.col("dst").alias("node"))
            .agg(F.min("seed").alias("reached"))
        )
        before, labels = labels, durable(
            labels.select("node", "seed")
            .join(reached.hint("merge"), "node", "left")
            .select("node", F.coalesce("seed", "reached").alias("seed"), (F.col("seed").isNull() & F.col("reached").isNotNull()).alias("new"))
        )
        discard(before)
        frontier = labels.where("new").select("node", "seed")
        open_ = labels.where("seed is null").select("node")
    return labels.select("node", "seed")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of an undirected edge table (a, b); component is one of its nodes.

    Where the regions of two seeds touch, their labels collide; collisions form a smaller graph of
    seeds, which is solved the same way until no regions touch. Each level keeps at most half of
    the nodes, as every seed that touches another region holds at least one more node.

    Null ends and loops are left out; repeated edges and both directions count as one.
    """
    pairs = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    both = pairs.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(
        pairs.select(F.col("b").alias("src"), F.col("a").alias("dst"))
    )
    level = durable(both.distinct())
    if level.isEmpty():
        return level.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    labels = _grow(level)
    touching = (
        level.join(labels.select(F.col("node").alias("src"), F.col("seed").alias("a")).hint("merge"), "src")
        .join(labels.select(F.col("node").alias("dst"), F.col("seed").alias("b")).hint("merge"), "dst")
        .where("a <> b")
        .select("a", "b")
        .distinct()
    )
    touching = durable(touching)
    if touching.isEmpty():
        return labels.select("node", F.col("seed").alias("component"))
    merged = components(touching).select(F.col("node").alias("seed"), F.col("component").alias("merged"))
    return labels.join(merged.hint("merge"), "seed", "left").select("node", F.coalesce("merged", "seed").alias("component"))


def linked_groups(records: DataFrame, row_id: str, keys: list[str]) -> DataFrame:
    """(row_id, component) of all rows; rows that share a value of any key column, however indirectly, share it.

    A key value is a node, and a row links the values it carries. Values in only one row link
    nothing, so they leave before the graph is built. A hot value is one node whatever its rows.
    Rows without any key (null) have a component of their own.
    """
    named = [F.when(F.col(k).isNotNull(), F.concat(F.lit(f"{i}:"), F.col(k))) for i, k in enumerate(keys)]
    first = F.coalesce(*named, F.concat(F.lit("row:"), F.col(row_id).cast("string")))
    long = records.select(row_id, F.explode(F.array_compact(F.array(*named))).alias("key"))
    shared = long.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    nodes = long.join(shared.hint("merge"), "key")
    hub = nodes.groupBy(row_id).agg(F.min("key").alias("a"), F.collect_set("key").alias("ks"))
    edges = hub.where(F.size("ks") > 1).select("a", F.explode("ks").alias("b")).where("a <> b").distinct()
    labels = components(edges)
    anchor = hub.select(row_id, "a").join(labels.withColumnRenamed("node", "a").hint("merge"), "a", "left")
    anchor = anchor.select(row_id, F.coalesce("component", "a").alias("component"))
    return records.select(row_id, first.alias("alone")).join(anchor.hint("merge"), row_id, "left").select(row_id, F.coalesce("component", "alone").alias("component"))


def _cut(cells: dict[int, tuple[int, int]], limit: float, closer=None, level: int = 0, before: float = 0.0) -> int:
    """Where the hash order is cut so that about ``limit`` rows lie before: a bound on ``spot``.

    ``cells`` has the rows and components of each cell of the order. The cell in which the limit falls
    goes to the side of its middle, or, with ``closer``, is looked at more closely until it is one component.
    """
    for cell in sorted(cells):
        n, count = cells[cell]
        if before + n > limit:
            if closer and count > 1 and level < 4:
                return _cut(closer(cell, level + 1), limit, closer, level + 1, before)
            return (cell if before + n / 2 >= limit else cell + 1) << STEP * (4 - level)
        before += n
    return 1 << 5 * STEP


def assign_splits(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(component, split): whole components, with the shares of rows in ``targets`` approached.

    ``sizes`` has (component string, n long), ``targets`` (split, target_share). Components follow each
    other in hash order, size class (powers of two) by size class from the largest, and each class is
    cut into the splits in proportion to what they still miss; a component goes where its middle
    lies. What a cut misses is left to the smaller classes. The smallest one is cut between two
    components, the others between two of 4096 parts of the hash order, so the driver holds at most
    60 x 4096 sums, and the shares reached miss the targets by about the smallest components unless
    one component is larger than a split. Shares that are null or not positive take nothing; they
    need not sum to 1. Repeated components are not allowed.
    """
    wanted = [(r["split"], r["target_share"]) for r in targets.collect() if r["target_share"] and r["target_share"] > 0]
    wanted.sort(key=lambda x: (-x[1], x[0]))
    if not wanted:
        raise ValueError("split targets with a positive share are needed")
    spot = F.shiftrightunsigned(F.xxhash64(F.lit(7), "component"), 64 - 5 * STEP)
    placed = sizes.select("component", "n", F.floor(F.log2("n")).cast("int").alias("class"), spot.alias("spot"))
    by_cell = lambda df, level: df.groupBy("class", F.shiftright("spot", STEP * (4 - level)).alias("cell")).agg(F.sum("n").alias("n"), F.count("*").alias("c"))
    sums: dict[int, dict[int, tuple[int, int]]] = {}
    for r in by_cell(placed, 0).collect():
        sums.setdefault(r["class"], {})[r["cell"]] = (r["n"], r["c"])
    total = sum(n for cells in sums.values() for n, _ in cells.values())
    missing = [share / sum(w for _, w in wanted) * total for _, share in wanted]
    bounds: dict[int, list[int]] = {}
    for k in sorted(sums, reverse=True):

        def closer(cell: int, level: int, k=k) -> dict[int, tuple[int, int]]:
            inside = placed.where((F.col("class") == k) & (F.shiftright("spot", STEP * (5 - level)) == cell))
            return {r["cell"]: (r["n"], r["c"]) for r in by_cell(inside, level).collect()}

        cells, needs = sums[k], [max(0.0, m) for m in missing]
        scale = sum(n for n, _ in cells.values()) / sum(needs) if sum(needs) else 0.0
        limits = [sum(needs[: i + 1]) * scale for i in range(len(needs) - 1)]
        bounds[k] = [_cut(cells, limit, closer if k == min(sums) else None) for limit in limits]
        edges = [0, *[b >> STEP * 4 for b in bounds[k]], 1 << STEP]
        for i in range(len(needs)):
            missing[i] -= sum(n for c, (n, _) in cells.items() if edges[i] <= c < edges[i + 1])
    if len(wanted) == 1 or not bounds:
        return sizes.select("component", F.lit(wanted[0][0]).alias("split"))
    limits_of = F.create_map(*[x for k, b in bounds.items() for x in (F.lit(k), F.array(*[F.lit(v).cast("long") for v in b]))])
    own_limits = F.element_at(limits_of, F.col("class"))
    split = F.lit(wanted[-1][0])
    for i in reversed(range(len(wanted) - 1)):
        split = F.when(F.col("spot") < own_limits[i], wanted[i][0]).otherwise(split)
    return placed.select("component", split.alias("split"))


def torn_components(linked: DataFrame, split: str) -> DataFrame:
    """Components whose rows lie in more than one split now: (component, n_splits).

    ``linked`` has (component, the split column); rows with a null split lie in none.
    """
    lain = linked.where(F.col(split).isNotNull()).select("component", split).distinct()
    return lain.groupBy("component").agg(F.count("*").alias("n_splits")).where("n_splits > 1")


def torn_keys(linked: DataFrame, key: str, split: str) -> DataFrame:
    """(key, n_splits): key values that lie in more than one split themselves, looked for inside of torn components.

    ``linked`` has (component, the key and the split column). A value's rows share their component, so
    the component of a torn value is torn; that of an untorn value may be, too, by the other values in it.
    """
    lain = linked.where(F.col(split).isNotNull()).select("component", key, split).distinct()
    inside = lain.where(F.col(key).isNotNull()).join(torn_components(lain, split).select("component").hint("merge"), "component", "left_semi")
    return inside.groupBy(key).agg(F.count("*").alias("n_splits")).where("n_splits > 1")
