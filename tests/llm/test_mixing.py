from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwort.llm.mixing import mix, mix_shares, plan_mixture, source_sizes, split_tree


@pytest.mark.parametrize("seed", range(5))
def test_tree_deals_exact_quotas(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 50, 6)
    shards = int(rng.integers(1, 9))
    sizes = [int(counts.sum()) // shards + (i < int(counts.sum()) % shards) for i in range(shards)]
    dealt = split_tree(counts, sizes, rng)
    assert [int(d.sum()) for d in dealt] == sizes and (sum(dealt) == counts).all() and all((d >= 0).all() for d in dealt)


def test_tree_is_unbiased():
    rng = np.random.default_rng(0)
    mean = np.mean([split_tree(np.array([30, 10]), [10, 10, 20], rng)[0] for _ in range(3000)], axis=0)
    assert np.allclose(mean, [7.5, 2.5], atol=0.1)


@pytest.fixture
def tables(spark):
    records = [("big", f"b{i}", 1 + i % 5) for i in range(3000)] + [("small", f"s{i}", 2) for i in range(50)] + [("zero", "z0", 0), (None, "n", 9), ("other", "o", 9)]
    targets = [("Big", "big", 0.5, 2), ("small", "small", 0.3, 3), ("zero", "zero", 0.1, 2), ("gone", "gone", 0.1, 2), ("none", "none", None, None)]
    return (
        spark.createDataFrame([(*r, 1, 2) for r in records], "key string, image string, size int, shard int, pass int"),
        spark.createDataFrame(targets, "source string, key string, target_share double, max_repeat int"),
    )


def test_sizes(tables):
    got = {r["source"]: r for r in source_sizes(*tables).collect()}
    assert (got["Big"]["size"], got["small"]["size"], got["gone"]["size"]) == (9000, 100, 0)
    assert got["small"]["total"] == 9100 and got["small"]["wanted"] == 0.3 * 9100 and got["none"]["wanted"] == 0
    plan = {s["source"]: s["missing"] for s in plan_mixture(*tables, "image").sources}
    assert plan == {"Big": 0, "small": 2730 - 300, "zero": 910, "gone": 910, "none": 0}


def test_mixture(spark, tables):
    plan = plan_mixture(*tables, "image", shards=8)
    out = mix(plan, "image")
    rows = out.collect()
    per, times = Counter(), Counter()
    for r in rows:
        per[r["source"]] += r["size"]
        times[r["image"]] += 1
    assert per["small"] == 300 and abs(per["Big"] - 4550) <= 5 and set(per) == {"Big", "small", "zero"} and per["zero"] == 0
    assert max(v for k, v in times.items() if k[0] == "s") == 3 and max(v for k, v in times.items() if k[0] == "b") == 1
    assert len({(r["image"], r["pass"]) for r in rows}) == len(rows)
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["position"] for r in rows if r["shard"] == shard) == list(range(1, 1 + sum(r["shard"] == shard for r in rows)))
    shares = {r["source"]: r for r in mix_shares(out, plan, "image").collect()}
    assert shares["small"]["most_repeats"] == 3 and shares["gone"]["drawn_size"] == 0
    assert abs(sum(r["actual_share"] for r in shares.values()) - 1) < 1e-5
    assert shares["small"]["missing"] == 2430 and abs(shares["Big"]["share_of_wanted"] - 0.5) < 0.001
    assert sorted(map(tuple, mix(plan_mixture(*tables, "image", shards=8), "image").collect())) == sorted(map(tuple, rows))


def test_blocks_follow_the_records_and_many_places_are_joined(spark, tables, monkeypatch):
    want = sorted(map(tuple, mix(plan_mixture(*tables, "image", shards=8), "image").collect()))
    monkeypatch.setattr("quillwort.llm.mixing.SENT", 0)
    assert sorted(map(tuple, mix(plan_mixture(*tables, "image", shards=8), "image").collect())) == want
    monkeypatch.setattr("quillwort.llm.mixing.BLOCK_ROWS", 10)
    plan = plan_mixture(*tables, "image", shards=8)
    assert {s["source"]: s["n_blocks"] for s in plan.sources}["Big"] == 300
    assert abs(sum(r["size"] for r in mix(plan, "image").collect() if r["source"] == "Big") - 4550) <= 5


def test_records_of_size_0_are_drawn_with_their_blocks(spark):
    records = [("all", f"a{i}", i % 2) for i in range(60)] + [("all", "null", None)] + [("half", f"h{i}", i % 2) for i in range(4000)] + [("zero", "z", 0)]
    targets = [("all", "all", 0.9, 3), ("half", "half", 0.1, 2), ("zero", "zero", 0.1, 2)]
    rows = mix(plan_mixture(
        spark.createDataFrame(records, "key string, image string, size int"),
        spark.createDataFrame(targets, "source string, key string, target_share double, max_repeat int"), "image", shards=4,
    ), "image").collect()
    times = Counter(r["image"] for r in rows)
    assert {i: n for i, n in times.items() if i[0] != "h"} == {i: 3 for k, i, _ in records if k == "all"} | {"z": 2}
    drawn = [r for r in rows if r["source"] == "half"]
    none = sum(r["size"] == 0 for r in drawn)
    assert sum(r["size"] for r in drawn) in (203, 204) and 100 < none < 400 and max(times[r["image"]] for r in drawn) == 1


def test_empty(spark, tables):
    records, targets = tables
    assert mix(plan_mixture(records.limit(0), targets, "image"), "image").count() == 0
    assert mix(plan_mixture(records, targets.limit(0), "image"), "image").count() == 0
    assert source_sizes(records.limit(0), targets).where(F.col("size") > 0).count() == 0
