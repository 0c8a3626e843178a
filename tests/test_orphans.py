from datetime import datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from quillwort.functions.paths import file_key, label_path_of, rebase, split_of_path, stem
from quillwort.operators.orphans import orphan_references, orphan_report

REFS = "row long, field string, key string, at timestamp, part int, step string"
STAYS = "field string, key string, since timestamp, until timestamp, salt int"
T0 = datetime(2024, 1, 1)


def found(spark, refs, stays, ranges=5):
    refs = spark.createDataFrame([(*r, 9, "x") for r in refs], REFS)  # columns with names the operator uses itself
    stays = spark.createDataFrame([(*s, 7) for s in stays], STAYS)
    return sorted(map(tuple, orphan_references(refs, stays, ranges).collect()))


def at(h):
    return T0 + timedelta(hours=h)


def test_bounds_nulls_and_repeats(spark):
    stays = [("f", "a", at(1), at(5)), ("f", "a", at(1), at(5)), ("f", "b", at(3), None), ("f", None, at(0), None), ("f", "c", None, None), ("f", "d", at(5), at(2))]
    refs = [
        (1, "f", "a", at(1)), (2, "f", "a", at(5)), (3, "f", "a", at(0)), (4, "f", "b", at(99)), (5, "g", "a", at(2)), (6, "f", None, at(2)),
        (7, "f", "a", None), (8, "f", "c", at(1)), (9, "f", "d", at(3)), (10, "f", "zz", at(1)), (10, "f", "zz", at(1)), (11, "f", "", at(1)),
    ]
    assert found(spark, refs, stays) == [(2, "f"), (3, "f"), (5, "g"), (7, "f"), (8, "f"), (9, "f"), (10, "f"), (10, "f"), (11, "f")]


def test_empty_tables(spark):
    assert found(spark, [], []) == []
    assert found(spark, [(1, "f", "a", at(0))], []) == [(1, "f")]
    assert found(spark, [], [("f", "a", at(0), None)]) == []


@pytest.mark.parametrize("seed", range(3))
def test_hot_key_over_many_ranges(spark, seed):
    rng = Random(seed)
    key = lambda: "hot" if rng.random() < 0.5 else f"k{rng.randrange(30)}"
    stays = []
    for _ in range(400):
        a = rng.randrange(1000)
        stays.append(("f", key(), at(a), None if rng.random() < 0.05 else at(a + rng.randrange(1, 30))))
    refs = [(i, "f", key(), at(rng.randrange(1100))) for i in range(800)]
    want = [(i, f) for i, f, k, t in refs if not any(s[1] == k and s[2] <= t and (s[3] is None or s[3] > t) for s in stays)]
    assert found(spark, refs, stays, 16) == sorted(want)


def test_report(spark):
    refs = spark.createDataFrame([(1, "f", "a", at(0)), (2, "f", "b", at(0)), (3, "g", None, at(0))], "row long, field string, key string, at timestamp")
    missed = spark.createDataFrame([(2, "f")], "row long, field string")
    assert [tuple(r) for r in orphan_report(refs, missed, F.date_format("at", "yyyy-MM")).collect()] == [("f", "2024-01", 2, 1)]


@pytest.mark.parametrize(
    ("path", "key"),
    [("a/b.jpg", "a/b.jpg"), (" a\\b.jpg\t", "a/b.jpg"), ("./a//b/./c", "a/b/c"), ("/a/b", "a/b"), ("a/x/../b", "a/b"), ("../../a", "a"), ("a/..", None), ("", None), ("  ", None), (None, None), ("A/b", "A/b"), ("a..b/c.", "a..b/c."), (".", None)],
)
def test_file_key(spark, path, key):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(file_key("p")).first()[0] == key


def test_path_parts(spark):
    df = spark.createDataFrame([("x/images/y/images/a.b.jpg",)], "p string")
    r = df.select(stem("p"), label_path_of("p"), split_of_path("p"), rebase("p", "images/", "/r/")).first()
    assert tuple(r) == ("a.b", "x/images/y/labels/a.b.txt", "unspecified", "/r/a.b.jpg")
    df = spark.createDataFrame([("t/Valid/images/a.jpg",)], "p string")
    assert df.select(split_of_path("p")).first()[0] == "val"
    with pytest.raises(Exception, match="no marker"):
        spark.createDataFrame([("C:\\x",)], "p string").select(rebase("p", "data/", "/r")).collect()
