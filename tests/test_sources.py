import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quillwort.sources import readers, sinks
from quillwort.streaming.sessions import cache_writer


@pytest.fixture
def tree(tmp_path):
    for split in ("train", "valid"):
        (tmp_path / split / "images").mkdir(parents=True)
        (tmp_path / split / "labels").mkdir()
    (tmp_path / "train/images/one.JPG").write_bytes(b"x")
    (tmp_path / "valid/images/two.png").write_bytes(b"yy")
    (tmp_path / "train/labels/one.txt").write_text("0 .5 .5 .1 .1\r\n1 .5 .5 .1 .1\n")
    (tmp_path / "data.yaml").write_text("nc: 2\nnames:\n  1: 'b'\n  0: a\n")
    return tmp_path


def test_scans(spark, tree):
    got = {(r["stem"], r["split"], r["length"]) for r in readers.scan_images(spark, str(tree)).collect()}
    assert got == {("one", "train", 1), ("two", "val", 2)}
    lines = readers.read_labels(spark, str(tree)).where("line <> ''")
    assert sorted((r["stem"], r["line_no"]) for r in lines.collect()) == [("one", 1), ("one", 2)]
    assert readers.discover_class_names(spark, str(tree)) == ["a", "b"]
    assert readers.scan_incumbents(spark, str(tree), f"{tree}/valid").count() == 1


@pytest.mark.parametrize(("text", "names"), [("names: ['a', \"b\"]", ["a", "b"]), ("names:\n- x\n- y\n", ["x", "y"]), ("p\nq\n", ["p", "q"]), ("", [])])
def test_class_names(text, names):
    assert readers.class_names(text) == names


def test_csv_bom_and_required(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿x,y\n1,b\n", encoding="utf-8")
    assert tuple(readers.read_csv(spark, str(tmp_path / "a.csv"), "x int, y string").first()) == (1, "b")
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path / "a.csv"), "x int, y string", ("z",))


def test_coco(spark, tmp_path):
    doc = {"images": [{"id": 1, "file_name": "f.jpg"}], "annotations": [{"image_id": 1, "category_id": 3, "bbox": [1, 2, 3, 4]}], "categories": [{"id": 3, "name": "c"}]}
    (tmp_path / "c.json").write_text(json.dumps(doc))
    assert tuple(readers.read_coco(spark, str(tmp_path / "c.json")).first()) == ("f.jpg", "c", 1.0, 2.0, 4.0, 6.0)
    (tmp_path / "d.json").write_text(json.dumps({"images": []}))
    with pytest.raises(ValueError):
        readers.read_coco(spark, str(tmp_path / "d.json"))


def test_docx(spark, tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", "<w:p><w:t>Hello</w:t></w:p><w:p>World</w:p>")
    (tmp_path / "a.docx").write_bytes(data.getvalue())
    (tmp_path / "b.docx").write_bytes(b"no zip")
    got = {r["path"][-6:]: r["text"] for r in readers.read_docx(spark, str(tmp_path)).collect()}
    assert got["a.docx"].split("\n") == ["Hello", "World"] and got["b.docx"].startswith("unreadable")


def test_sinks_refuse_to_overwrite(spark, tmp_path):
    df = spark.range(3).select("id", F.array(F.lit("a")).alias("tags"))
    for write in (sinks.write_csv, sinks.write_table, sinks.write_report):
        path = str(tmp_path / write.__name__)
        write(df, path)
        with pytest.raises(Exception, match="(?i)exists"):
            write(df, path)
        write(df, path, force=True)
    sinks.write_csv(df.limit(0), str(tmp_path / "empty"))
    assert spark.read.csv(str(tmp_path / "empty"), header=True).columns == ["id", "tags"]


def test_lists_and_listed_files(spark, tmp_path):
    df = spark.createDataFrame([("a", 2), ("b", 1), ("c", None)], "p string, n int").withColumn("split", F.lit("train"))
    sinks.write_lists(df, F.col("p"), ["split"], str(tmp_path / "lists"), "n")
    listed = readers.read_list(spark, str(tmp_path / "lists/split=train"))
    assert sorted(r[0] for r in listed.collect()) == ["a", "a", "b", "c"]
    with pytest.raises(Exception, match="does not exist"):
        readers.read_list(spark, str(tmp_path / "lists/split=train"), df.where("p <> 'b'").select(F.col("p").alias("path"))).collect()


def test_cache_takes_each_key_once(spark, tmp_path):
    path = str(tmp_path / "cache")
    write = cache_writer(path, "id", lambda b: b.withColumn("v", F.col("id") * 2))
    for batch in (spark.range(3), spark.range(5), spark.range(5).union(spark.range(6))):
        write(batch, 0)
    assert sorted(r[0] for r in spark.read.parquet(path).select("id").collect()) == [0, 1, 2, 3, 4, 5]
    assert readers.cached(spark, str(tmp_path / "none")) is None


def test_repair(spark):
    lines = spark.createDataFrame([("f", 1, 0, 0.1, 0.2, 0.3, 0.4), ("f", 2, 0, 0.1, 0.2, 0.3, 0.4)], "stem string, n int, cls int, cx double, cy double, w double, h double")
    fix = "stem string, n int, old_cls int, old_cx double, old_cy double, old_w double, old_h double, new_cls int"
    good = spark.createDataFrame([("f", 1, 0, 0.1, 0.2, 0.3, 0.4, 2)], fix)
    assert sorted((r["n"], r["cls"]) for r in sinks.repair_lines(lines, good, ["stem", "n"]).collect()) == [(1, 2), (2, 0)]
    with pytest.raises(Exception, match="does not match"):
        sinks.repair_lines(lines, spark.createDataFrame([("f", 1, 1, 0.1, 0.2, 0.3, 0.4, 2)], fix), ["stem", "n"]).collect()
