"""Queries of sources and sinks: files written from the driver's tables and read again."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.session import fresh_path, table
from quillwort.sources import readers, sinks

#: Splits of the few files that stand for a dataset folder.
_SPLITS = ("train", "valid", "test")


def _put(spark: SparkSession, path: str, content: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(content.encode()))
    out.close()


def _tree(spark: SparkSession, d: str) -> str:
    """A dataset folder with an image and a label file for each nation, and one image that is no part of it."""
    root = fresh_path(spark, "tree")
    for r in table(spark, d, "nation").select("n_nationkey", "n_name").collect():  # 25 rows
        folder = f"{root}/set/{_SPLITS[r[0] % 3]}"
        _put(spark, f"{folder}/images/n_{r[0]}.JPG", r[1])
        _put(spark, f"{folder}/labels/n_{r[0]}.txt", f"{r[0]} 0.5 0.5 0.1 0.1\r\n\n")
    _put(spark, f"{root}/candidate/train/images/c.png", "x")
    _put(spark, f"{root}/set/candidate_audits/a.png", "x")
    return root


def s1_scan_files(spark: SparkSession, d: str) -> DataFrame:
    """All files of a dataset folder, by stem and length."""
    return readers.scan_files(spark, _tree(spark, d) + "/set").select("stem", "length")


def s2_scan_images(spark: SparkSession, d: str) -> DataFrame:
    """Its images, with the split their folder names."""
    return readers.scan_images(spark, _tree(spark, d) + "/set").select("stem", "split", "length")


def s3_scan_labels(spark: SparkSession, d: str) -> DataFrame:
    """The lines of its label files that are not blank."""
    return readers.read_labels(spark, _tree(spark, d) + "/set").where("line <> ''").select("stem", "line_no", "line")


def s17_incumbents(spark: SparkSession, d: str) -> DataFrame:
    """Images of a corpus outside of the candidate's and of audit folders."""
    root = _tree(spark, d)
    return readers.scan_incumbents(spark, root, f"{root}/candidate").select("stem", "split")


def s5_coco(spark: SparkSession, d: str) -> DataFrame:
    """Nations as images, one annotation each, regions as categories."""
    nations, path = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey").collect(), fresh_path(spark, "coco") + ".json"  # 25 rows
    _put(spark, path, json.dumps({
        "images": [{"id": k, "file_name": n} for k, n, _ in nations],
        "annotations": [{"image_id": k, "category_id": r, "bbox": [k, r, 2, 3]} for k, _, r in nations],
        "categories": [{"id": k, "name": n} for k, n in table(spark, d, "region").select("r_regionkey", "r_name").collect()],  # 5 rows
    }))
    return readers.read_coco(spark, path)


def s7_manifest_csv(spark: SparkSession, d: str) -> DataFrame:
    """The manifest written as CSV and read under its schema: rows, boxes and groups per source."""
    columns, path = readers.MANIFEST.names, fresh_path(spark, "csv")
    sinks.write_csv(table(spark, d, "manifest").select(*columns), path)
    read = readers.read_csv(spark, path, readers.MANIFEST, tuple(columns))
    return read.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("n_boxes").alias("n_boxes"), F.count_distinct("final_stem").alias("n_stems"))


def _named(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "class_id int, name string")


def _regions(spark: SparkSession, d: str) -> list[str]:
    return [r[0] for r in table(spark, d, "region").orderBy("r_regionkey").select("r_name").collect()]  # 5 rows


def s8_yaml_names(spark: SparkSession, d: str) -> DataFrame:
    """Class names of a one-line list in a configuration."""
    return _named(spark, readers.class_names(f"nc: 5\nnames: [{', '.join(_regions(spark, d))}]\n"))


def s9_discover_names(spark: SparkSession, d: str) -> DataFrame:
    """Class names from the first file that has any: an empty classes.txt is passed over, numbers order the block."""
    root = fresh_path(spark, "names")
    _put(spark, f"{root}/classes.txt", "\n")
    _put(spark, f"{root}/data.yaml", "names:\n" + "".join(f"  {k}: {n}\n" for k, n in reversed(list(enumerate(_regions(spark, d))))))
    return _named(spark, readers.discover_class_names(spark, root))


def s10_classes_txt(spark: SparkSession, d: str) -> DataFrame:
    """A classes.txt in the folder itself goes before one further down."""
    root = fresh_path(spark, "names")
    _put(spark, f"{root}/a/classes.txt", "other\n")
    _put(spark, f"{root}/classes.txt", "\n".join(_regions(spark, d)))
    return _named(spark, readers.discover_class_names(spark, root, ("classes.txt",)))


def s13_embedding_cache(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings kept by the digest of their content: filled for some rows, then for all, each content once."""
    e = table(spark, d, "embeddings").select(F.md5(F.to_json("embedding").cast("binary")).alias("content"), F.size("embedding").alias("n"), "vec_id")
    path = fresh_path(spark, "cache")
    rows = lambda df: df.dropDuplicates(["content"]).select("content", "n")
    sinks.append_cache(rows(e.where("vec_id % 2 = 0")), path, "content")
    return sinks.append_cache(rows(e), path, "content").agg(F.count("*").alias("n_contents"), F.sum("n").alias("n_numbers"))


def s14_list_file(spark: SparkSession, d: str) -> DataFrame:
    """Paths of accepted images written as a list, and read with each checked against the table."""
    images, path = table(spark, d, "accepted_images").select("path"), fresh_path(spark, "list")
    images.select(F.col("path").alias("value")).write.text(path)
    return readers.read_list(spark, path, images.select(F.trim("path").alias("path")))


def s15_exclusions(spark: SparkSession, d: str) -> DataFrame:
    """Nations without those that a report excludes."""
    path = fresh_path(spark, "report") + ".json"
    _put(spark, path, json.dumps({"drops": [{"n_nationkey": k} for k in range(0, 25, 4)]}))
    return table(spark, d, "nation").join(readers.read_exclusions(spark, path), "n_nationkey", "left_anti").select("n_nationkey", "n_name")


def k2_empty_csv(spark: SparkSession, d: str) -> DataFrame:
    """The header of a table without rows."""
    path = fresh_path(spark, "csv")
    sinks.write_csv(table(spark, d, "region").select("r_regionkey", "r_name").limit(0), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def k3_report(spark: SparkSession, d: str) -> DataFrame:
    """Counts of the manifest as a JSON report, read again."""
    path = fresh_path(spark, "report")
    sinks.write_report(table(spark, d, "manifest").agg(F.count("*").alias("n_rows"), F.sum("n_boxes").alias("n_boxes")), path)
    report = readers.read_json_report(spark, path)
    return spark.createDataFrame([(report["n_rows"], report["n_boxes"])], "n_rows long, n_boxes long")


def k13_repair(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of parts with the classes of some corrected; every fix must match its line."""
    line = table(spark, d, "part").select(
        "p_partkey", (F.col("p_size") % 3).cast("int").alias("cls"), *[F.lit(v).alias(c) for c, v in (("cx", 0.5), ("cy", 0.25), ("w", 0.1), ("h", 0.2))]
    )
    fixes = line.where("p_partkey % 50 = 0").select("p_partkey", *[F.col(c).alias(f"old_{c}") for c in ("cls", "cx", "cy", "w", "h")], F.lit(9).alias("new_cls"))
    return sinks.repair_lines(line, fixes, ["p_partkey"]).groupBy("cls").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (
    s1_scan_files, s2_scan_images, s3_scan_labels, s5_coco, s7_manifest_csv, s8_yaml_names, s9_discover_names, s10_classes_txt, s13_embedding_cache,
    s14_list_file, s15_exclusions, s17_incumbents, k2_empty_csv, k3_report, k13_repair,
)}

_NATION = "(select n_nationkey as k, n_name, ['train', 'val', 'test'][n_nationkey % 3 + 1] as split from nation)"
_NAMES = "select r_regionkey::int as class_id, r_name as name from region"

SQL = {
    "s1_scan_files": f"""select 'n_' || k as stem, strlen(n_name)::bigint as length from {_NATION} union all select 'n_' || k, strlen(k::varchar) + 19 from {_NATION} union all select 'a', 1""",
    "s2_scan_images": f"select 'n_' || k as stem, split, strlen(n_name)::bigint as length from {_NATION} union all select 'a', 'unspecified', 1",
    "s3_scan_labels": f"select 'n_' || k as stem, 1 as line_no, k || ' 0.5 0.5 0.1 0.1' as line from {_NATION}",
    "s17_incumbents": f"select 'n_' || k as stem, split from {_NATION}",
    "s5_coco": """select n_name as file_name, r_name as category, n_nationkey::double as x_min, n_regionkey::double as y_min, n_nationkey + 2.0::double as x_max, n_regionkey + 3.0::double as y_max
        from nation join region on n_regionkey = r_regionkey""",
    "s7_manifest_csv": "select nullif(source, '') as source, count(*) as n_rows, sum(n_boxes)::bigint as n_boxes, count(distinct final_stem) as n_stems from manifest group by 1",
    "s8_yaml_names": _NAMES, "s9_discover_names": _NAMES, "s10_classes_txt": _NAMES,
    "s13_embedding_cache": "select count(*) as n_contents, sum(n)::bigint as n_numbers from (select distinct embedding, len(embedding) as n from embeddings)",
    "s14_list_file": "select trim(path, ' ') as path from accepted_images where trim(path, ' ') <> ''",
    "s15_exclusions": "select n_nationkey, n_name from nation where n_nationkey % 4 <> 0",
    "k2_empty_csv": "select 'r_regionkey,r_name' as line",
    "k3_report": "select count(*) as n_rows, sum(n_boxes)::bigint as n_boxes from manifest",
    "k13_repair": "select case when p_partkey % 50 = 0 then 9 else p_size % 3 end::int as cls, count(*) as n from part group by 1",
}
