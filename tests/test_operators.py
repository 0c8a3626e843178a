"""Core operators against plain models, on small fixtures."""

from __future__ import annotations

import math
from itertools import permutations
from random import Random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quillwort.functions import grouping, names
from quillwort.functions.bits import Bands
from quillwort.operators import checks, dedupe, lookups, mapping, sampling, splits, stats, tiling
from quillwort.operators.hamming import near_values, nearest
from quillwort.operators.sessions import sessionize
from quillwort.operators.vectors import cosine_search
from quillwort.sources import readers, sinks
from quillwort.sources.labels import VARIANTS, line_issues, parse_boxes


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def some_hashes(rng, n, clusters=12):
    centres = [rng.getrandbits(64) for _ in range(clusters)]
    out = []
    for _ in range(n):
        h = rng.choice(centres) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.randrange(7)):
            h ^= 1 << rng.randrange(64)
        out.append(signed(h))
    return out


def far(a, b):
    return ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count()


@pytest.mark.parametrize(("threshold", "bands"), [(8, 5), (8, 9), (3, 4), (0, 2), (8, 4)])
def test_near_values_is_exact(spark, threshold, bands):
    rng = Random(threshold * 10 + bands)
    a, b = some_hashes(rng, 120), some_hashes(rng, 100)
    b += a[:20]
    left = spark.createDataFrame([(h, 1) for h in [*a, None, a[0]]], "hash long, key int")
    right = spark.createDataFrame([(h, 1) for h in [*b, None]], "hash long, key int")
    got = sorted(map(tuple, near_values(left, right, "hash", threshold, bands).collect()))
    assert got == sorted((x, y, far(x, y)) for x in set(a) for y in set(b) if far(x, y) <= threshold)


def test_band_radii_reach_the_threshold():
    for t in range(12):
        for n in range(2, 10):
            b = Bands(t, n)
            assert sum(r + 1 for r in b.radii) == t + 1 and sum(b.widths) == 64


def test_nearest_ties_nulls_and_empty_bank(spark):
    bank = spark.createDataFrame([(5, 0b11), (3, 0b11), (9, None)], "id long, hash long")
    ask = spark.createDataFrame([(1, 0b01), (2, None)], "id long, hash long")
    assert sorted(map(tuple, nearest(ask, bank, "id", "id", "hash").collect())) == [(1, 3, 1), (2, None, None)]
    assert sorted(map(tuple, nearest(bank, bank, "id", "id", "hash", block=1).collect())) == [(3, 3, 0), (5, 3, 0), (9, None, None)]
    rng = Random(3)
    a, b = some_hashes(rng, 60), some_hashes(rng, 3000)
    rows = lambda hs: spark.createDataFrame(list(enumerate(hs)), "id long, hash long")
    want = [(i, *min((far(h, g), j) for j, g in enumerate(b))[::-1]) for i, h in enumerate(a)]
    assert sorted(map(tuple, nearest(rows(a), rows(b), "id", "id", "hash", block=20).collect())) == want
    assert sorted(map(tuple, nearest(ask, bank.limit(0), "id", "id", "hash").collect())) == [(1, None, None), (2, None, None)]


@pytest.mark.parametrize("seed", range(3))
def test_first_seen_equals_the_sequence(spark, seed):
    rng = Random(seed)
    hashes = some_hashes(rng, 150, 6) + [None, None]
    rows = [(i, h, i < 10) for i, h in enumerate(hashes)]
    kept, drops = [], []
    for i, h, inc in rows:
        near = [(far(h, k), j) for j, k in kept if h is not None and k is not None and far(h, k) <= 8]
        if near and not inc:
            drops.append((i, min(near)[1], min(near)[0]))
        else:
            kept.append((i, h))
    k, d = dedupe.first_seen(spark.createDataFrame(rows, "seq long, hash long, incumbent boolean"))
    assert sorted(r[0] for r in k.collect()) == [i for i, _ in kept]
    assert sorted(map(tuple, d.collect())) == drops


def test_sessions(spark):
    rows = [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:10:00"), (3, "2024-01-01 00:20:01"), (4, "2024-01-02 00:00:00"), (5, None)]
    df = spark.createDataFrame(rows, "id long, at string").select("id", F.col("at").cast("timestamp").alias("at"), F.lit("u").alias("u"))
    got = sorted((r["id"], r["session_no"], r["session_id"]) for r in sessionize(df, ["u"], "at", "id").collect())
    assert got == [(1, 1, "s_u_20240101_s01"), (2, 1, "s_u_20240101_s01"), (3, 2, "s_u_20240101_s02"), (4, 1, "s_u_20240102_s01"), (5, None, None)]


def greedy(sizes):
    total, sums, out = sum(sizes.values()), [0, 0], {}
    for g, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        out[g] = "test"
        for i, (s, f) in enumerate((("train", 0.8), ("val", 0.1))):
            if sums[i] + n <= total * f + n / 2:
                out[g], sums[i] = s, sums[i] + n
                break
    return out


def lightest(sizes):
    bins, where = [0, 0, 0], {}
    for g, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        i = bins.index(min(bins))
        bins[i] += n
        where[g] = i
    best = min(permutations(range(3)), key=lambda p: round(sum(abs(bins[b] / sum(bins) - f) for b, f in zip(p, (0.8, 0.1, 0.1))), 12))
    return {g: ("train", "val", "test")[best.index(i)] for g, i in where.items()}


@pytest.mark.parametrize(("operator", "model"), [(splits.assign_greedy, greedy), (splits.assign_lightest, lightest)])
def test_folds(spark, operator, model):
    rng = Random(4)
    units = {u: {f"g{i:03}": rng.randrange(1, 60) for i in range(n)} for u, n in (("a", 40), ("b", 7), ("c", 1))}
    df = spark.createDataFrame([(u, g, n) for u, s in units.items() for g, n in s.items()], "unit string, g string, n long")
    got = {(r["unit"], r["g"]): r["split"] for r in operator(df, "unit", "g", "n").collect()}
    assert got == {(u, g): s for u, sizes in units.items() for g, s in model(sizes).items()}
    assert operator(df.limit(0), "unit", "g", "n").count() == 0


def test_exact_percentiles_refine(spark, monkeypatch):
    monkeypatch.setattr(stats, "FEW", 20)
    monkeypatch.setattr(stats, "CELLS", 8)
    rng = Random(2)
    values = {"a": [rng.expovariate(1) for _ in range(500)], "b": [1.0] * 300, "c": [3.5], "d": [float(rng.randrange(5)) for _ in range(400)]}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs] + [("a", None), ("e", None), ("b", math.nan)], "g string, v double")
    got = {r["g"]: (r["p10"], r["p50"], r["p99"]) for r in stats.exact_percentiles(df, "g", "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99}).collect()}
    assert set(got) == set(values)
    for g, vs in values.items():
        assert np.allclose(got[g], np.percentile(vs, [10, 50, 99]))


def allocate(total, caps):
    out = dict.fromkeys(caps, 0)
    left = min(total, sum(caps.values()))
    full = sum(caps.values())
    quotas = {k: left * c / full for k, c in caps.items()} if full else {}
    for k, q in quotas.items():
        out[k] = int(q + 1e-9)
    for k in sorted(caps, key=lambda k: (-round(quotas.get(k, 0) - out[k], 9), k))[: left - sum(out.values())]:
        out[k] += 1
    return out


@pytest.mark.parametrize("total", [0, 1, 7, 50, 10_000])
def test_largest_remainder(spark, total):
    caps = {"a": 10, "b": 3, "c": 7, "d": 100}
    df = spark.createDataFrame(list(caps.items()), "k string, c long")
    got = {r["k"]: r["quota"] for r in sampling.largest_remainder(df, "k", "c", total).collect()}
    assert got == allocate(total, caps) and all(got[k] <= caps[k] for k in caps)


def test_caps_and_repeats_follow_the_worked_examples(spark):
    df = spark.range(9067).select(F.col("id"), (F.col("id") < 4505).alias("pool"))
    kept, counts = sampling.cap_share(df, F.col("pool"), F.col("pool"), "id")
    assert (counts["target"], counts["dropped"], kept.count()) == (2456, 2049, 9067 - 2049)
    r = spark.range(1).select(F.round(sampling.repeat_factor(F.lit(0.1834), F.lit(2.0)), 2), sampling.repeat_factor(F.lit(0.0), F.lit(2.0))).first()
    assert tuple(r) == (3.30, 1.0)
    histogram = spark.createDataFrame([(0, 70), (1, 768), (2, 496), (3, 6), (4, 75)], "n_tiles int, n_boxes long")
    assert tuple(tiling.reconcile_appearances(histogram).first()) == (1415, 70, 733, 2078)
    macro = spark.createDataFrame([("a", 0.9576), ("a", 0.9134), ("a", 0.6796), ("a", 0.6225), ("b", None)], "k string, m double")
    assert {r["k"]: round(r["macro"], 4) for r in stats.macro_average(macro, ["k"], "m").collect()} == {"a": 0.7933, "b": 0.0}


def test_tile_hits_equal_the_theta_join(spark):
    rng = Random(9)
    rows = []
    for i in range(200):
        w, h = rng.choice([(640, 640), (500, 400), (2000, 1500), (1300, 700)])
        x, y = rng.uniform(0, w), rng.uniform(0, h)
        rows.append((i, w, h, x, y, min(float(w), x + rng.uniform(0, 700)), min(float(h), y + rng.uniform(0, 500))))
    rows.append((999, 640, 640, None, 1.0, 2.0, 3.0))
    df = spark.createDataFrame(rows, "id int, width int, height int, x_min double, y_min double, x_max double, y_max double")
    want = set()
    for i, w, h, x0, y0, x1, y1 in rows[:-1]:
        for c in range(max(1, (w - 640) // 512 + 1)):
            for r in range(max(1, (h - 640) // 512 + 1)):
                tx, ty = min(c * 512, w - 640), min(r * 512, h - 640)
                area = max(0, min(x1, tx + 640) - max(x0, tx)) * max(0, min(y1, ty + 640) - max(y0, ty))
                if x1 > x0 and y1 > y0 and area / max((x1 - x0) * (y1 - y0), 1e-9) >= 0.40:
                    want.add((i, c, r))
    assert {(r["id"], r["col"], r["row"]) for r in tiling.tile_hits(df).collect()} == want


def test_cosine_ties_zero_and_blocks(spark, monkeypatch):
    monkeypatch.setattr("quillwort.operators.vectors.BLOCK", 2)
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [3.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    assert sorted(map(tuple, cosine_search(df, df, "id", "v").collect()))[:3] == [(1, 2, 1.0), (2, 1, 1.0), (3, 1, 1.0)]
    assert sorted(map(tuple, cosine_search(df, df, "id", "v", 0.9).collect())) == [(1, 2, 1.0), (1, 3, 1.0), (2, 1, 1.0), (2, 3, 1.0), (3, 1, 1.0), (3, 2, 1.0)]
    assert cosine_search(df.limit(0), df, "id", "v").count() == 0


def test_aliases_and_explicit_mapping(spark):
    df = spark.createDataFrame([("water hyacinth",), ("aquatic vegetation",), ("ent_litter",), (" River  Vegetation ",), (None,)], "n string")
    explicit = mapping.parse_mapping(["River Vegetation=hyacinth"])
    assert list(explicit) == ["river vegetation"]
    assert [r[0] for r in df.select(mapping.alias_class("n", explicit)).collect()] == ["hyacinth", None, "entangled_plastic", "hyacinth", None]
    with pytest.raises(ValueError):
        mapping.parse_mapping(["x"])
    with pytest.raises(Exception, match="without a mapping"):
        mapping.vocabulary_class(df, "n", spark.createDataFrame([("a", 1)], "name string, t int"), "name", "t").collect()


def test_groups_of_stems(spark):
    hexes = "0" * 32
    df = spark.createDataFrame([(f"14_JPG.rf.{hexes}",), (f"14_jpg.rf.{hexes}",)], "s string")
    assert {r[0] for r in df.select(grouping.export_group(F.col("s"), "x_")).collect()} == {"x_14"}
    plain = spark.createDataFrame([("plain",)], "s string")
    with pytest.raises(Exception, match="without an export suffix"):
        plain.select(grouping.export_group(F.col("s"), "x_")).collect()
    families = spark.createDataFrame([("IMG_6301_frame_00007",), ("FOTO_0011",)], "s string")
    assert [r[0] for r in families.select(grouping.family_group(F.col("s"), "men_")).collect()] == ["men_vIMG_6301", "men_FOTO_0011"]
    frames = spark.createDataFrame([(f"train/a_frame_1_jpg.rf.{hexes}", f"A_frame_1_jpg.rf.{hexes}"), (f"test/a_frame_2_jpg.rf.{hexes}", f"a_frame_2_jpg.rf.{hexes}")], "p string, s string")
    assert {r[0] for r in frames.select(grouping.candidate_group(F.col("p"), F.col("s"))).collect()} == {"frame_a"}


LINES = ["0 0.5 0.5 0.2 0.2", "0 0.5 0.5 0.2", "x 0.5 0.5 0.2 0.2", "1 1.5 0.5 0.2 0.2", "7 0.5 0.5 0 0.2", "0 0.5 0.5 0.2 0.2 9", "", None]


@pytest.mark.parametrize(
    ("variant", "kept"), [("lenient", [0, 3, 4, 5]), ("explore", [0, 2, 4, 5]), ("donor", [0, 3, 4, 5]), ("candidate", [0, 3, 4]), ("verify", [0, 3, 4])]
)
def test_label_variants(spark, variant, kept):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(LINES)], "i int, line string")
    assert sorted(r["i"] for r in parse_boxes(df, "line", n_classes=3, **VARIANTS[variant]).collect()) == kept


def test_label_variant_fails(spark):
    df = spark.createDataFrame([(LINES[3],)], "line string")
    with pytest.raises(Exception, match="bad label line"):
        parse_boxes(df, "line", n_classes=3, **VARIANTS["preflight"]).collect()


def test_names(spark):
    df = spark.createDataFrame([(" Kanal-FX\t",), ("",), (None,), ("VALIDATION ",), ("unspecified",)], "x string")
    assert [tuple(r) for r in df.select(names.source_key("x"), names.split_key("x")).collect()] == [
        ("kanal_fx", None), (None, None), (None, None), ("validation", "val"), ("unspecified", None)
    ]


def test_metrics_of_absent_class_are_null(spark):
    counts = spark.createDataFrame([("a", 3, 1, 1), ("b", 0, 0, 2)], "class string, tp long, fn long, fp long")
    got = {r["class"]: r for r in stats.class_metrics(counts).collect()}
    assert got["b"]["recall"] is None and got["b"]["f1"] is None and (got["a"]["precision"], got["a"]["recall"]) == (0.75, 0.75)


def test_checks_and_gates(spark):
    bad = spark.createDataFrame([("x" * 500,)], "d string")
    row = checks.check_none("n", bad, F.col("d")).first()
    assert (row["status"], row["n_bad"], len(row["detail"])) == ("FAIL", 1, 400)
    assert checks.check_none("n", bad.limit(0)).first()["status"] == "PASS"
    clean = checks.gates(spark.createDataFrame([], "reason string"), {"g": "x"}).first()
    assert clean["g"] and clean["status"] == "READY_FOR_MERGE"
    with pytest.raises(Exception, match="no way"):
        checks.require(spark.range(2), F.col("id") < 1, "no way").collect()
    with pytest.raises(ValueError):
        checks.require_columns(bad, "nope")


def test_lookups(spark):
    images = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, stem string")
    labels = spark.createDataFrame([("a", 7), ("b", 8), ("b", 9)], "stem string, f int")
    got = sorted(map(tuple, lookups.resolve_label(images, labels, "k", ["stem"], "f").collect()))
    assert got == [(1, 7, "found"), (2, None, "ambiguous"), (3, None, "missing")]
    with pytest.raises(Exception, match="no entry for"):
        lookups.lookup_complete(images, labels, ["stem"], "f").collect()
    runs = lookups.stitch(spark.createDataFrame([(1, 0.5), (2, 0.6)], "epoch int, v double"), spark.createDataFrame([(1, 0.7)], "epoch int, v double"), "epoch")
    assert sorted(r["epoch"] for r in runs.collect()) == [1, 2, 3]


def test_size_prefilter_digests_only_shared_sizes(spark):
    rows = [(3, "train", b"abc"), (3, "test", b"xyz"), (4, "train", b"abcd"), (5, "train", b"hello"), (5, "val", b"hello"), (5, None, b"hello")]
    df = spark.createDataFrame(rows, "size int, split string, content binary")
    got = dedupe.cross_split_bytes(df, "size", "split", "content").collect()
    assert [(r["n"], r["splits"]) for r in got] == [(2, "train+val")]


def test_nearest_other(spark):
    rng = Random(4)
    rows = [(i, rng.choice([7, rng.getrandbits(64) - (1 << 63)])) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, hash long")
    want = [(i, *min((far, j) for j, g in rows if j != i for far in [((h ^ g) & 0xFFFFFFFFFFFFFFFF).bit_count()])[::-1]) for i, h in rows]
    for block in (7, 4096):
        assert sorted(map(tuple, nearest(df, df, "id", "id", "hash", block=block, others=True).collect())) == want
    one = df.where("id = 0")
    assert nearest(one, one, "id", "id", "hash", others=True).first()["nearest_id"] is None


@pytest.mark.parametrize("few", [0, 5, 100_000])
def test_lowest_finds_its_cut_by_counting(spark, monkeypatch, few):
    monkeypatch.setattr(sampling, "FEW", few)
    rows = [(i,) for i in range(-300, 700)]
    df = spark.createDataFrame(rows, "n long")
    at = sampling.number_key(F.col("n"))
    for k in (0, 1, 6, 500, 999, 1000, 2000):
        assert sorted(r[0] for r in sampling.lowest(df, at, k).collect()) == [i for i, in rows[:k]]
    same = spark.createDataFrame([(1,)] * 50 + [(2,)], "n long")
    assert sorted(r[0] for r in sampling.lowest(same, at, 20).collect()) == [1] * 20
    assert sampling.lowest(df.limit(0), at, 7).count() == 0
    keys = [r["n"] for r in df.orderBy(sampling.rank_key("n")).collect()]
    assert sorted(r["n"] for r in sampling.sample_rows(df, 321, "n").collect()) == sorted(keys[:321])


def test_ranks_in_parts_equal_a_window(spark):
    df = spark.createDataFrame([(None if i % 7 == 0 else "hot" if i % 3 else f"g{i % 5}", i * i % 977) for i in range(900)], "g string, n long").dropDuplicates()
    w = F.row_number().over(Window.partitionBy("g").orderBy("n"))
    want = sorted(map(tuple, df.withColumn("_rank", w).collect()), key=repr)
    parts = sampling.ranked(df, ["g"], sampling.number_cell(df, "n"), [F.col("n")])
    assert sorted(map(tuple, parts.collect()), key=repr) == want
    assert sampling.ranked(df.limit(0), ["g"], sampling.number_cell(df.limit(0), "n"), [F.col("n")]).count() == 0
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number() windowspecdefinition(g" in plan and "_cell" in plan.split("Window [row_number()")[1].split("Sort")[0]


def test_checks_stop_at_the_first_failure(spark):
    made = spark.createDataFrame([("c", "FAIL", 2, "x"), ("a", "PASS", 0, ""), ("b", "FAIL", 1, "y")], "check string, status string, n_bad long, detail string")
    got = [tuple(r) for r in checks.stop_at_first(made, ["a", "b", "c"]).orderBy("place").collect()]
    assert got == [(1, "a", "PASS", 0, ""), (2, "b", "FAIL", 1, "y"), (3, "c", "SKIPPED", 0, "")]
    one = spark.createDataFrame([(0.35,)], "s double")
    assert checks.check_at_most("m", one, "s", 0.35).first()["status"] == "PASS" and checks.check_at_most("m", one, "s", 0.349).first()["status"] == "FAIL"
    assert checks.check_at_most("m", one.agg(F.max(F.lit(None).cast("double")).alias("s")), "s", 1).first()["status"] == "FAIL"


@pytest.mark.parametrize(("line", "level", "issues"), [
    ("a 0.5 0.5 0.1 0.1", "explore", []), ("a 0.5 0.5 0.1 0.1", "verify", ["not_numeric"]), ("1 0.5 0.5 0.1 0.1 9", "lenient", []), ("1 0.5 0.5 0.1 0.1 9", "verify", ["expected_5_fields"]),
    ("7 0.5 0.5 0 0.1", "candidate", ["non_positive_box", "class_out_of_range"]), ("0 0.99 0.5 0.1 0.1", "preflight", ["box_beyond_image"]), ("0 1.5 0.5 0.1 0.1", "explore", ["coordinate_out_of_range"]),
])
def test_levels_of_label_lines(spark, line, level, issues):
    v = VARIANTS[level]
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(line_issues("line", v["arity"], v["checks"], 3, v.get("cls", "int"))).first()[0] == issues


def test_banker_and_csv_blanks(spark, tmp_path):
    df = spark.createDataFrame([(" a ", 1), (None, 2)], "s string, n int")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, readers.read_csv(spark, str(tmp_path / "c"), df.schema).collect()), key=repr) == sorted([(" a ", 1), (None, 2)], key=repr)
