from collections import Counter
from random import Random

import pytest
from pyspark.sql import functions as F

from quillwort.llm.components import assign_splits, components, linked_groups, torn_components, torn_keys
from quillwort.llm.splits_queries import manifest_keys, p1_shares, p1_splits


def parts(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    out = {}
    for x in list(root):
        out.setdefault(find(x), set()).add(x)
    return sorted(map(sorted, out.values()))


def as_parts(rows):
    out = {}
    for n, c in rows:
        out.setdefault(c, set()).add(n)
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("kind", ["random", "path", "star", "copies"])
def test_components_equal_union_find(spark, kind):
    rng = Random(1)
    if kind == "random":
        pairs = [(f"n{rng.randrange(120)}", f"n{rng.randrange(120)}") for _ in range(90)]
    elif kind == "path":
        names = [f"p{i}" for i in range(60)]
        rng.shuffle(names)
        pairs = list(zip(names, names[1:]))
    elif kind == "star":
        pairs = [("hub", f"s{i}") for i in range(200)] + [("x", "y")]
    else:
        pairs = [("a", "b")] * 50 + [("b", "a"), ("c", "d")]
    got = components(spark.createDataFrame([(*p, 0) for p in pairs], "a string, b string, seed int"))
    assert as_parts(map(tuple, got.collect())) == parts([p for p in pairs if p[0] != p[1]])


def test_no_edges_nulls_and_loops(spark):
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0
    assert components(spark.createDataFrame([("a", None), (None, "b"), ("c", "c")], "a string, b string")).count() == 0


def test_linked_groups(spark):
    rows = [(1, "g", "s1"), (2, "g", "s2"), (3, "h", "s2"), (4, "i", "s4"), (5, None, "s4"), (6, None, None), (7, "j", None), (8, "", "s8")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "id long, g string, s string, component string")
    got = linked_groups(df.select("id", "g", "s"), "id", ["g", "s"])
    assert as_parts(map(tuple, got.select("id", "component").collect())) == [[1, 2, 3], [4, 5], [6], [7], [8]]
    assert linked_groups(df.select("id", "g", "s").limit(0), "id", ["g", "s"]).count() == 0
    single = linked_groups(df.select("id", "g"), "id", ["g"])
    assert as_parts(map(tuple, single.select("id", "component").collect()))[:1] == [[1, 2]]


def test_torn(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "val"), ("b", "train"), ("b", None), ("c", None)], "component string, now string")
    assert [r["component"] for r in torn_components(df, "now").collect()] == ["a"]


def test_torn_keys_of_one_component(spark):
    rows = [  # a null source and one whose name and group spell the same; a stem links two groups, of which one is torn
        (1, "a:g", "s1", "train"), (2, "a:g", "s2", "test"), (3, "g", "s3", "train"), (4, "g", "s4", "val"),
        (5, "u", "s5", "train"), (6, "v", "s5", "test"), (7, "v", "s6", "train"), (8, "w", "s7", None), (9, "w", "s8", "val"), (10, None, "s9", "train"), (11, None, "s9", "val"),
    ]
    df = spark.createDataFrame(rows, "row_id long, g string, stem string, now string")
    linked = df.join(linked_groups(df, "row_id", ["g", "stem"]), "row_id")
    assert sorted(map(tuple, torn_keys(linked, "g", "now").collect())) == [("a:g", 2), ("g", 2), ("v", 2)]
    assert torn_keys(linked.limit(0), "g", "now").count() == 0


@pytest.mark.parametrize("sizes", [[1] * 5000, [7] * 40, [3300] + [1] * 6700, [500, 300, 200], [1]])
def test_cuts_lie_between_components(spark, sizes):
    targets = spark.createDataFrame([("train", 0.8), ("val", 0.1), ("test", 0.1)], "split string, target_share double")
    df = spark.createDataFrame([(f"c{i}", n) for i, n in enumerate(sizes)], "component string, n long")
    share = Counter()
    for r in assign_splits(df, targets).collect():
        share[r["split"]] += sizes[int(r["component"][1:])]
    total, worst = sum(sizes), max(sizes) if max(sizes) > 0.1 * sum(sizes) and len(sizes) < 10 else min(sizes)
    assert sum(share.values()) == total
    assert all(abs(share[s] - t * total) <= worst for s, t in (("train", 0.8), ("val", 0.1), ("test", 0.1)))


def test_no_group_of_the_manifest_is_in_two_splits(spark):
    d = "/root/testdata/sf0.01"
    rows = manifest_keys(spark, d).join(p1_splits(spark, d), "row_id")
    assert rows.count() == spark.read.parquet(f"{d}/manifest.parquet").count()
    for key in ("group_key", "final_stem"):
        assert rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct("split").alias("n")).where("n <> 1").count() == 0
    assert all(abs(r["share"] - r["target_share"]) < 0.001 for r in p1_shares(spark, d).collect())


def test_splits_approach_the_shares_and_keep_components_whole(spark):
    rng = Random(3)
    sizes = [("huge", 3000)] + [(f"c{i}", rng.randrange(1, 30)) for i in range(2000)]
    targets = spark.createDataFrame([("train", 0.8), ("val", 0.1), ("test", 0.1), ("none", 0.0), ("null", None)], "split string, target_share double")
    df = spark.createDataFrame(sizes, "component string, n long")
    got = assign_splits(df, targets).collect()
    assert len(got) == len(sizes) == len({r["component"] for r in got})
    n, total = dict(sizes), sum(s for _, s in sizes)
    share = Counter()
    for r in got:
        share[r["split"]] += n[r["component"]] / total
    assert set(share) == {"train", "val", "test"}
    assert all(abs(share[s] - t) < 0.01 for s, t in (("train", 0.8), ("val", 0.1), ("test", 0.1)))
    assert assign_splits(df.limit(0), targets).count() == 0
    with pytest.raises(ValueError):
        assign_splits(df, targets.where(F.col("target_share") == 0))
