"""Tables as files. Every sink refuses to overwrite unless told to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwort.sources.labels import format_box
from quillwort.sources.readers import cached


def _mode(force: bool) -> str:
    return "overwrite" if force else "errorifexists"


def write_csv(df: DataFrame, path: str, force: bool = False) -> None:
    """A CSV with header, values as they are; an empty table still has one."""
    flat = [F.to_json(c).alias(c) if t.startswith(("map", "struct", "array")) else F.col(c) for c, t in df.dtypes]
    out = df.select(*flat)
    (out.coalesce(1) if out.isEmpty() else out).write.mode(_mode(force)).csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_table(df: DataFrame, path: str, by: list[str] | None = None, force: bool = False) -> None:
    """Parquet, partitioned by columns of few values, with one writer per value range rather than per task."""
    if by:
        df = df.repartition(*by, F.pmod(F.monotonically_increasing_id(), F.lit(8)))
        df.write.mode(_mode(force)).partitionBy(*by).parquet(path)
    else:
        df.write.mode(_mode(force)).parquet(path)


def write_report(df: DataFrame, path: str, force: bool = False) -> None:
    """A one-row report as JSON."""
    df.coalesce(1).write.mode(_mode(force)).json(path)


def write_lists(df: DataFrame, line: Column, by: list[str], path: str, repeats: str | None = None, force: bool = False) -> None:
    """Text lists, one folder per value of ``by``, each row as often as ``repeats`` says."""
    rows = df.select(*by, line.alias("value"), *([F.col(repeats).alias("_n")] if repeats else []))
    if repeats:
        rows = rows.withColumn("_i", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), "_n")))).drop("_i", "_n")
    rows.write.mode(_mode(force)).partitionBy(*by).text(path)


def label_texts(boxes: DataFrame, by: list[str], order: str, ids: dict[str, str]) -> DataFrame:
    """(by, one text per id column): the label file of each image, for each of several class vocabularies.

    An image's boxes are one row's worth of text, bounded by the image.
    """
    text = lambda c: F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), format_box(F.col(c), F.col("cx"), F.col("cy"), F.col("w"), F.col("h")).alias("t")))), lambda x: x["t"]), "\n"
    )
    return boxes.groupBy(*by).agg(*[text(c).alias(name) for c, name in ids.items()])


def append_cache(todo: DataFrame, path: str, key: str) -> DataFrame:
    """The rows that a cache table lacks by key, appended to it; the whole cache comes back."""
    held = cached(todo.sparkSession, path)
    new = todo if held is None else todo.join(held.select(key).distinct(), key, "left_anti")
    new.write.mode("append").parquet(path)
    return todo.sparkSession.read.parquet(path)


def repair_lines(lines: DataFrame, fixes: DataFrame, on: list[str], tolerance: float = 5e-7) -> DataFrame:
    """Lines with the class of a fix where one exists; a fix whose old class or geometry does not match fails the job.

    ``lines`` has cls, cx, cy, w, h; ``fixes`` has the same as old_cls, old_cx, ... and new_cls.
    """
    joined = lines.join(fixes, on, "left")
    same = F.col("cls") == F.col("old_cls")
    for c in ("cx", "cy", "w", "h"):
        same &= F.abs(F.col(c) - F.col(f"old_{c}")) <= tolerance
    wrong = F.raise_error(F.lit("a fix does not match its line")).cast("int")
    new = F.when(F.col("new_cls").isNull(), F.col("cls")).when(same, F.col("new_cls")).otherwise(wrong)
    return joined.withColumn("cls", new).select(*lines.columns)
