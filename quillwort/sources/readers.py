"""Files as tables: images, labels, CSV, COCO, class names, documents."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwort.functions.paths import split_of_path, stem
from quillwort.operators.checks import require_columns

#: Fixed value: the extensions of images.
IMAGES = r"(?i)\.(jpg|jpeg|png|webp)$"
MANIFEST = T.StructType([T.StructField(n, T.StringType()) for n in ("source", "original_path", "original_class", "mapped_class", "split", "group_id", "tile_info", "final_stem")]
                        + [T.StructField(n, T.IntegerType()) for n in ("n_boxes", "width", "height", "rfs_repeat")])


def scan_files(spark: SparkSession, root: str, pattern: str | None = None, content: bool = False) -> DataFrame:
    """(path, length, modified, stem[, content]) of all files below a folder; content is read only if asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    if pattern:
        files = files.where(F.col("path").rlike(pattern))
    columns = [F.col("path"), F.col("length"), F.col("modificationTime").alias("modified"), stem("path").alias("stem")]
    return files.select(*columns, *([F.col("content")] if content else []))


def scan_images(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """Images below a folder, with the split that a folder of their path names."""
    return scan_files(spark, root, IMAGES, content).withColumn("split", split_of_path("path"))


def scan_incumbents(spark: SparkSession, root: str, candidate_root: str, skipped: str = "candidate_audits") -> DataFrame:
    """Images of a corpus outside of a candidate's folder and of audit folders."""
    prefix = candidate_root.rstrip("/") + "/"
    return scan_images(spark, root).where(~F.contains("path", F.lit(prefix)) & ~F.contains("path", F.lit(f"/{skipped}/"))).dropDuplicates(["path"])


def read_labels(spark: SparkSession, root: str) -> DataFrame:
    """(path, stem, line_no, line) of all label files below a folder, one row per line."""
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(root, wholetext=True)
    lines = texts.select(F.input_file_name().alias("path"), F.posexplode(F.split("value", r"\r?\n")).alias("pos", "line"))
    return lines.select("path", stem("path").alias("stem"), (F.col("pos") + 1).alias("line_no"), "line")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, required: tuple[str, ...] = ()) -> DataFrame:
    """A CSV with header under an explicit schema; a leading byte order mark is ignored, a bad row fails the job."""
    df = spark.read.csv(path, header=True, schema=schema, mode="FAILFAST", enforceSchema=False)
    return require_columns(df, *required)


def read_coco(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, category, x_min, y_min, x_max, y_max) of a COCO document; `images` and `annotations` are required."""
    raw = require_columns(spark.read.json(path, multiLine=True), "images", "annotations")
    images = raw.select(F.explode("images").alias("i")).select(F.col("i.id").alias("image_id"), F.col("i.file_name").alias("file_name"))
    boxes = raw.select(F.explode("annotations").alias("a")).select("a.image_id", "a.category_id", "a.bbox")
    names = raw.select(F.explode("categories").alias("c")).select(F.col("c.id").alias("category_id"), F.col("c.name").alias("category"))
    x, y, w, h = (F.col("bbox")[i].cast("double") for i in range(4))
    return boxes.join(images, "image_id").join(names, "category_id", "left").select(
        "file_name", "category", x.alias("x_min"), y.alias("y_min"), (x + w).alias("x_max"), (y + h).alias("y_max")
    )


def class_names(text: str) -> list[str]:
    """Class names of a configuration: `names: [a, b]`, a `names:` block by number or dash, or one name per line."""
    listed = re.search(r"(?ms)^names:\s*\[(.*?)\]", text)
    if listed:
        return [n.strip().strip("'\"") for n in listed.group(1).split(",") if n.strip()]
    block = re.search(r"(?m)^names:\s*\n((?:[ \t]+.*\n?|-.*\n?)+)", text)
    if block:
        entries = [line.strip() for line in block.group(1).splitlines() if line.strip()]
        numbered = [re.match(r"(\d+)\s*:\s*(.+)", e) for e in entries]
        if all(numbered):
            return [m.group(2).strip().strip("'\"") for m in sorted(numbered, key=lambda m: int(m.group(1)))]
        return [e.lstrip("- ").strip("'\"") for e in entries]
    return [line.strip() for line in text.splitlines() if line.strip() and not line.strip().startswith("#")]


def discover_class_names(spark: SparkSession, root: str, names: tuple[str, ...] = ("classes.txt", "data.yaml", "data.yml")) -> list[str]:
    """Class names from the first of the files, in order, that has any; configuration, so the driver reads it."""
    for name in names:
        found = scan_files(spark, root, rf"(^|/){re.escape(name)}$", content=True).orderBy(F.length("path"), "path").limit(1).collect()
        if found and (out := class_names(bytes(found[0]["content"]).decode("utf-8-sig"))):
            return out
    return []


def docx_text(content: bytes) -> str:
    """The text of a DOCX file, a line break for each run of tags; what fails to open gives its error as text."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            xml = z.read("word/document.xml").decode()
    except Exception as error:  # noqa: BLE001
        return f"unreadable: {type(error).__name__}"
    return re.sub(r"(?:\s*<[^>]+>\s*)+", "\n", xml).strip()


def read_docx(spark: SparkSession, root: str) -> DataFrame:
    """(path, text) of the DOCX files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.docx").load(root)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["path"], "text": [docx_text(c) for c in b["content"]]})

    return files.select("path", "content").mapInPandas(run, "path string, text string")


def read_exclusions(spark: SparkSession, path: str, field: str = "drops") -> DataFrame:
    """Entries of a list in a JSON report, one row each."""
    return spark.read.json(path, multiLine=True).select(F.explode(field).alias("e")).select("e.*")


def read_list(spark: SparkSession, path: str, known: DataFrame | None = None, on: str = "path") -> DataFrame:
    """Lines of a list file, repeats kept. With ``known``, a line that no known file has fails the job."""
    lines = spark.read.text(path).select(F.trim("value").alias(on)).where(F.col(on) != "")
    if known is None:
        return lines
    held = known.select(on).distinct().withColumn("_known", F.lit(True))
    lacking = F.raise_error(F.concat(F.lit("listed file does not exist: "), F.col(on))).cast("string")
    return lines.join(held, on, "left").select(F.when(F.col("_known").isNotNull(), F.col(on)).otherwise(lacking).alias(on))


def cached(spark: SparkSession, path: str) -> DataFrame | None:
    """A cache table written earlier, if there is one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return spark.read.parquet(path) if exists else None


def read_json_report(spark: SparkSession, path: str) -> dict:
    """A report as a dictionary; a report is small."""
    rows = spark.read.text(path, wholetext=True).collect()
    return json.loads(rows[0]["value"]) if rows else {}
