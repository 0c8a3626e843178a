"""Paths as keys, and what a path says about a file. All are native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillwort.functions.names import strip


def _walk(acc: Column, part: Column) -> Column:
    return (
        F.when(part.isin("", "."), acc)
        .when(part == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.array_append(acc, part))
    )


def file_key(path: Column | str) -> Column:
    """One spelling for each file below the root.

    White space around the path, the kind of separator, doubled separators, `.` steps, `..` steps
    and a leading separator do not matter; letter case does. `..` stops at the root. Null, empty
    and blank paths, and paths that denote the root itself, are null.
    """
    slashed = F.translate(strip(path), "\\", "/")
    walked = F.array_join(
        F.aggregate(F.split(slashed, "/"), F.array().cast("array<string>"), _walk), "/"
    )
    plain = ~slashed.rlike(r"(^|/)\.{0,2}(/|$)")
    key = F.when(plain, slashed).otherwise(walked)
    return F.when(key != "", key)


def stem(path: Column | str) -> Column:
    """The file name without folders and last extension."""
    name = F.regexp_extract(path if isinstance(path, Column) else F.col(path), r"([^/\\]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def label_path_of(path: Column | str) -> Column:
    """The label path that belongs to an image path: the last `images` folder becomes `labels`, the extension `.txt`."""
    c = path if isinstance(path, Column) else F.col(path)
    moved = F.regexp_replace(c, r"^(.*)/images/", "$1/labels/")
    return F.regexp_replace(moved, r"\.[^./]*$", ".txt")


def split_of_path(path: Column | str) -> Column:
    """train, val or test from a folder of the path, tried in that order; otherwise `unspecified`."""
    c = path if isinstance(path, Column) else F.col(path)
    parts = F.split(F.lower(c), r"[/\\]")
    return (
        F.when(F.array_contains(parts, "train"), "train")
        .when(F.arrays_overlap(parts, F.array(*map(F.lit, ("val", "valid", "validation")))), "val")
        .when(F.array_contains(parts, "test"), "test")
        .otherwise("unspecified")
    )


def rebase(path: Column | str, marker: str, root: str) -> Column:
    """The part after ``marker`` below a new root; a path without the marker stays, unless it names a Windows drive, which fails."""
    c = path if isinstance(path, Column) else F.col(path)
    slashed = F.translate(c, "\\", "/")
    return (
        F.when(F.contains(slashed, F.lit(marker)), F.concat(F.lit(root.rstrip("/") + "/"), F.substring_index(slashed, marker, -1)))
        .when(slashed.rlike("^[A-Za-z]:"), F.raise_error(F.concat(F.lit("no marker in Windows path "), slashed)).cast("string"))
        .otherwise(slashed)
    )
