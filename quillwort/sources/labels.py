"""Label lines `class cx cy w h` with any strictness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The known readings of a label line: arity, what a bad line does, and which checks apply.
VARIANTS = {
    "lenient": {"arity": "ge5", "on_error": "drop", "checks": ()},
    "replay": {"arity": "ge5", "on_error": "fail", "checks": ()},
    "explore": {"arity": "ge5", "on_error": "drop", "checks": ("range",), "cls": "string"},
    "profile": {"arity": "ge5", "on_error": "drop", "checks": ("integer_class",)},
    "donor": {"arity": "ge5", "on_error": "record", "checks": ("range", "size")},
    "candidate": {"arity": "eq5", "on_error": "record", "checks": ("range", "size", "class")},
    "verify": {"arity": "eq5", "on_error": "record", "checks": ("range",)},
    "preflight": {"arity": "eq5", "on_error": "fail", "checks": ("range", "size", "class", "extent")},
}


def _cut(text: str, cls: str) -> tuple[Column, list[Column]]:
    fields = F.split(F.trim(F.col(text)), r"\s+")
    number = lambda i: F.try_element_at(fields, F.lit(i + 1)).try_cast("double")
    return fields, [F.try_element_at(fields, F.lit(1)).try_cast(cls), *(number(i) for i in range(1, 5))]


def line_issues(text: str, arity: str = "eq5", checks: tuple[str, ...] = ("range", "size"), n_classes: int | None = None, cls: str = "int", slack: float = 1e-4) -> Column:
    """What is wrong with a label line, an array of codes: the wrong number of fields alone, else that they are no numbers, else the checks that fail."""
    fields, (c, cx, cy, w, h) = _cut(text, cls)
    right = F.size(fields) == 5 if arity == "eq5" else F.size(fields) >= 5
    numeric = c.isNotNull() & cx.isNotNull() & cy.isNotNull() & w.isNotNull() & h.isNotNull()
    unit = lambda x: (x >= 0) & (x <= 1)
    rules = {
        "range": (lambda: unit(cx) & unit(cy) & unit(w) & unit(h), "coordinate_out_of_range"),
        "size": (lambda: (w > 0) & (h > 0), "non_positive_box"),
        "class": (lambda: ((c >= 0) & (c < n_classes)) if n_classes else (c >= 0), "class_out_of_range"),
        "extent": (lambda: (cx - w / 2 >= -slack) & (cx + w / 2 <= 1 + slack) & (cy - h / 2 >= -slack) & (cy + h / 2 <= 1 + slack), "box_beyond_image"),
        "integer_class": (lambda: c.try_cast("int").isNotNull(), "class_not_integer"),
    }
    failed = F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(~rules[k][0](), F.lit(rules[k][1])) for k in checks]))
    return F.when(~right, F.array(F.lit("expected_5_fields"))).when(~numeric, F.array(F.lit("not_numeric"))).otherwise(failed)


def parse_boxes(lines: DataFrame, text: str, arity: str = "eq5", on_error: str = "record", checks: tuple[str, ...] = ("range", "size"),
                n_classes: int | None = None, slack: float = 1e-4, cls: str = "int") -> DataFrame:
    """Adds cls, cx, cy, w, h and issues (an array, empty for a good line) to one label line per row.

    arity `eq5` wants five fields, `ge5` at least five. on_error: `record` keeps lines that were
    split into numbers with their issues and drops others; `drop` drops any line with an issue; `fail` fails the job at
    the first. Blank and null lines are no lines. Checks: range (all in [0, 1]), size (w, h > 0), class (0 <= cls <
    n_classes), extent (the box within the image, up to ``slack``), integer_class. The class is an int, or kept as it is with cls `string`.
    """
    found = line_issues(text, arity, checks, n_classes, cls, slack)
    _, parts = _cut(text, cls)
    named = [c.alias(n) for n, c in zip(("cls", "cx", "cy", "w", "h"), parts, strict=True)]
    parsed = lines.where(F.trim(F.col(text)) != "").select("*", *named, found.alias("issues"))
    if on_error == "fail":
        message = F.concat(F.lit("bad label line: "), F.col(text), F.lit(" "), F.array_join("issues", ","))
        return parsed.withColumn("issues", F.when(F.size("issues") == 0, F.col("issues")).otherwise(F.raise_error(message).cast("array<string>")))
    if on_error == "drop":
        return parsed.where(F.size("issues") == 0)
    return parsed.where(~F.arrays_overlap("issues", F.array(F.lit("expected_5_fields"), F.lit("not_numeric"))))


def bad_lines(lines: DataFrame, text: str, arity: str = "eq5", checks: tuple[str, ...] = ("range", "size"), n_classes: int | None = None) -> DataFrame:
    """Each line with its issues, lines that cannot be split into numbers included; good lines left out."""
    found = line_issues(text, arity, checks, n_classes)
    return lines.where(F.trim(F.col(text)) != "").select("*", found.alias("issues")).where(F.size("issues") > 0)


def count_lines(lines: DataFrame, by: str, text: str, five_only: bool = False) -> DataFrame:
    """Lines per file: all that are not blank, or only those with five fields."""
    counted = F.trim(F.col(text)) != ""
    if five_only:
        counted &= F.size(F.split(F.trim(F.col(text)), r"\s+")) == 5
    return lines.groupBy(by).agg(F.count_if(F.coalesce(counted, F.lit(False))).alias("n_boxes"))


def format_box(cls: Column, cx: Column, cy: Column, w: Column, h: Column) -> Column:
    """A label line with six decimals."""
    return F.format_string("%d %.6f %.6f %.6f %.6f", cls, cx, cy, w, h)
