"""Incremental deduplication and cross-split overlap against plain models."""

from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwort.llm.incremental import AcceptedIndex, dedupe_batches
from quillwort.llm.incremental_queries import match_category
from quillwort.llm.minwise import Minwise
from quillwort.llm.overlap import RarePrefix, cross_split_links, cross_split_pairs, members, overlap_report, rare_prefix_pairs


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def far(a, b):
    return ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count()


def images(rng, n, hot=0.3):
    """Clusters, chains, a hot digest, a hot hash and nulls."""
    chain = [rng.getrandbits(64)]
    for _ in range(30):
        h = chain[-1]
        for b in rng.sample(range(64), 5):
            h ^= 1 << b
        chain.append(h)
    out = []
    for _ in range(n):
        x = rng.random()
        h = chain[0] if x < hot / 2 else rng.choice(chain) if x < 0.7 else rng.getrandbits(64)
        if rng.random() < 0.4:
            h ^= 1 << rng.randrange(64)
        digest = "hot" if rng.random() < hot / 3 else f"d{rng.randrange(n)}"
        out.append((None if rng.random() < 0.05 else digest, None if rng.random() < 0.1 else signed(h)))
    return out


def model(history, incoming):
    bank = [(i, d, h) for i, d, h in history]
    cases = {}
    for i, _, d, h in sorted(incoming, key=lambda r: (r[1], r[0])):
        same = [j for j, e, _ in bank if d is not None and e == d]
        near = [(far(h, g), j) for j, _, g in bank if h is not None and g is not None and far(h, g) <= 8]
        if same:
            cases[i] = min(same)
        elif near:
            cases[i] = min(near)[1]
        else:
            bank.append((i, d, h))
    return cases


HISTORY, INCOMING = "image_id long, digest string, hash long", "image_id long, batch_no int, digest string, hash long"


@pytest.fixture
def index(spark, tmp_path):
    made = AcceptedIndex.create(spark, str(tmp_path / "index"))
    yield made
    made.drop()


def matches(cases):
    return {r["image_id"]: r["matched_id"] for r in cases.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_batches_equal_the_sequence(spark, index, seed):
    rng = Random(seed)
    first = model([], [(i, 0, d, h) for i, (d, h) in enumerate(images(rng, 60))])
    known = [(i, *x) for i, x in enumerate(images(Random(seed), 60)) if i not in first]
    new = [(1000 + i, 1 + i * 3 // 90, *x) for i, x in enumerate(images(rng, 90))]
    n = spark.createDataFrame([*((*r, "x") for r in new), (*new[5], "y"), (None, 1, "q", 5, "z")], INCOMING + ", key string")
    index.append(spark.createDataFrame(known, HISTORY))
    assert matches(dedupe_batches(index, n.drop("key"))) == model(known, new)


def test_empty_batches(spark, index):
    n = spark.createDataFrame([(9, 1, "A", 5)], INCOMING)
    assert dedupe_batches(index, n.limit(0)).count() == 0
    index.append(spark.createDataFrame([], HISTORY))
    assert dedupe_batches(index, n).count() == 0
    again = dedupe_batches(index, spark.createDataFrame([(10, None, "B", 4), (11, 2, "A", None), (12, 2, None, None)], INCOMING))
    assert sorted(map(tuple, again.collect())) == [(10, 9, 1, False), (11, 9, 0, True)]


def test_an_index_is_opened_again_and_no_history_is_read(spark, tmp_path):
    rng = Random(5)
    known = [(i, *x) for i, x in enumerate(images(rng, 40))]
    known = [r for r in known if r[0] not in model([], [(i, 0, d, h) for i, d, h in known])]
    new = [(1000 + i, 1 + i // 30, *x) for i, x in enumerate(images(rng, 90))]
    spark.createDataFrame(known, HISTORY).write.parquet(str(tmp_path / "history"))
    path = str(tmp_path / "index")
    with AcceptedIndex.create(spark, path, buckets=3) as built:
        built.append(spark.read.parquet(str(tmp_path / "history")))
    for file in (tmp_path / "history").iterdir():
        file.unlink()
    got = {}
    for no in (1, 2, 3):
        with AcceptedIndex.open(spark, path) as index:
            before = {f: f.stat().st_mtime_ns for f in (tmp_path / "index").rglob("*.parquet")}
            got |= matches(dedupe_batches(index, spark.createDataFrame([r for r in new if r[1] == no], INCOMING)))
            assert {f: f.stat().st_mtime_ns for f in before} == before
            probe = index.same(spark.createDataFrame([(1, "a", 7)], HISTORY))._jdf.queryExecution().executedPlan().toString()
            assert probe.count("Exchange hashpartitioning(digest") == 1, "only the batch is shuffled"
    assert got == model(known, new)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("quillwort_")]


def test_minwise_keys_agree_as_often_as_the_sets_are_alike():
    rng = np.random.default_rng(1)
    a = rng.integers(-(1 << 63), 1 << 63, 20_000, dtype=np.int64)
    minwise = Minwise()
    assert (minwise.band_keys(a) < 0).all() and len(set(minwise.band_keys(a[:1])[0])) == minwise.bands
    for bits, least in ((0, 1.0), (4, 0.99), (8, 0.88)):
        b = a.copy()
        for k in range(bits):
            b ^= np.int64(1) << np.int64(7 * k)
        alike = (minwise.signatures(a) == minwise.signatures(b)).mean()
        assert abs(alike - (64 - bits) / (64 + bits)) < 0.03
        assert (minwise.band_keys(a) == minwise.band_keys(b)).any(axis=1).mean() >= least - 0.02


def test_categories(spark):
    df = spark.createDataFrame([("a", "KANAL-fx"), ("b ", "B"), ("a", "b"), (None, "b"), (None, None)], "d string, m string")
    assert [r[0] for r in df.select(match_category(F.col("d"), F.col("m"))).collect()] == ["vs_existing", "within_donor", "cross_donor:b", "cross_donor:b", "within_donor"]


@pytest.mark.parametrize("seed", range(3))
def test_overlap_pairs(spark, seed):
    rng = Random(seed)
    rows = [(i, rng.choice(["train", "train", "val", "test", None]), *x) for i, x in enumerate(images(rng, 160))]
    want = set()
    for i, s, d, h in rows:
        for j, t, e, g in rows:
            if s == "train" and t in ("val", "test"):
                if d is not None and d == e:
                    want.add((i, j, "exact"))
                elif h is not None and g is not None and far(h, g) <= 8:
                    want.add((i, j, "near"))
    df = spark.createDataFrame([(*r, "k", "src") for r in [*rows, rows[3]]], "id long, split string, digest string, hash long, key string, source string")
    pairs = cross_split_pairs(df)
    assert sorted((r["train_id"], r["held_id"], r["kind"]) for r in pairs.collect()) == sorted(want)
    report = overlap_report(df).collect()
    assert sum(r["n_exact"] for r in report) == len({j for _, j, k in want if k == "exact"})
    assert sum(r["n_near"] for r in report) == len({j for _, j, k in want if k == "near"} - {j for _, j, k in want if k == "exact"})
    assert cross_split_pairs(df.limit(0)).count() == overlap_report(df.limit(0)).count() == 0


def test_copies_do_not_multiply(spark):
    rows = [(i, "train" if i % 2 else "val", "same" if i < 300 else f"d{i}", 77 if i < 400 else 78 if i == 400 else None, "s") for i in range(450)]
    df = spark.createDataFrame(rows, "id long, split string, digest string, hash long, source string")
    classes = members(df).cache()
    links = sorted((r["kind"], r["train_rep"], r["held_rep"], r["distance"]) for r in cross_split_links(classes).collect())
    assert links == [("exact", 1, 0, None), ("near", 1, 0, 0), ("near", 1, 400, 2)]
    assert classes.count() == 450 + 401
    assert [tuple(r) for r in overlap_report(df).collect()] == [("val", "s", 225, 150, 51)]


def test_hot_bands_are_left_out(spark):
    rng = Random(8)
    low = 0b1011 << 3
    train = [signed(rng.getrandbits(38) << 26 | low) for _ in range(3000)]
    held = [signed(rng.getrandbits(38) << 26 | low) for _ in range(50)] + [signed(t & 0xFFFFFFFFFFFFFFFF ^ 0b111) for t in train[:5]]
    a, b = spark.createDataFrame([(h,) for h in held], "hash long"), spark.createDataFrame([(t,) for t in train], "hash long")
    got = sorted(map(tuple, rare_prefix_pairs(a, b, "hash").collect()))
    assert got == sorted((h, t, far(h, t)) for h in set(held) for t in set(train) if far(h, t) <= 8)
    prefix = RarePrefix()
    assert all(sum(r + 1 for r in plan) == 9 for plan in prefix.plans) and len(prefix.plans) == 3
