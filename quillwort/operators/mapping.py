"""Class names to a vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwort.functions.names import label_text

#: The classes, and the names that mean them.
ALIASES = {
    "hyacinth": ("hyacinth", "water_hyacinth", "water hyacinth", "eichhornia crassipes"),
    "litter": ("litter", "floating_waste", "floating waste", "garbage"),
    "entangled_plastic": ("ent_litter", "entangled_plastic", "entangled plastic"),
}
#: Both class ids of a name, of three classes and of two.
CLASS_IDS = {"litter": (0, 0), "hyacinth": (1, 1), "entangled_plastic": (2, 0)}


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    cells = [F.lit(x) for pair in sorted(pairs.items()) for x in pair]
    return F.try_element_at(F.create_map(*cells), key) if cells else F.lit(None).cast("string")


def alias_class(name: Column | str, explicit: dict[str, str] | None = None) -> Column:
    """The class a name means: an explicit mapping first, then the aliases; unknown names are null."""
    key = label_text(name)
    wanted = {normal_name(k): v for k, v in (explicit or {}).items()}
    return F.coalesce(_lookup(wanted, key), _lookup({a: c for c, names in ALIASES.items() for a in names}, key))


def normal_name(name: str) -> str:
    """What ``label_text`` makes of a name."""
    return " ".join(name.strip().lower().replace("-", "_").split())


def parse_mapping(pairs: list[str]) -> dict[str, str]:
    """`Source name=target` options as a mapping with normal keys."""
    out = {}
    for pair in pairs:
        source, found, target = pair.partition("=")
        if not found or not source.strip() or not target.strip():
            raise ValueError(f"not SOURCE=TARGET: {pair!r}")
        if normal_name(target) not in ALIASES:
            raise ValueError(f"not a class: {target.strip()!r}")
        out[normal_name(source)] = normal_name(target)
    return out


def vocabulary_class(df: DataFrame, raw: str, vocabulary: DataFrame, on: str, target: str, strict: bool = True) -> DataFrame:
    """``df`` with the target of each raw name. Strict, a name the vocabulary lacks fails the job; otherwise it is null.

    ``vocabulary`` has a row per known name (``on`` unique), a configuration of bounded size.
    """
    joined = df.join(F.broadcast(vocabulary.select(F.col(on).alias("_name"), target)), F.col(raw) == F.col("_name"), "left").drop("_name")
    if not strict:
        return joined
    unknown = F.raise_error(F.concat(F.lit("class without a mapping: "), F.col(raw))).cast("string")
    return joined.withColumn(target, F.when(F.col(raw).isNull() | F.col(target).isNotNull(), F.col(target)).otherwise(unknown))


def class_ids(name: Column) -> list[Column]:
    """id3 and id2: the class in the vocabulary of three and in that of two classes; null for other names."""
    three = F.lit(None).cast("int")
    two = F.lit(None).cast("int")
    for known, (a, b) in CLASS_IDS.items():
        three, two = F.when(name == known, a).otherwise(three), F.when(name == known, b).otherwise(two)
    return [three.alias("id3"), two.alias("id2")]


def expand_set(joined: Column, separator: str = "+") -> Column:
    """A joined set as an array; null and empty give an empty array."""
    return F.filter(F.split(F.coalesce(joined, F.lit("")), f"\\{separator}"), lambda x: x != "")


def join_set(values: Column, separator: str = "+") -> Column:
    """An array as a sorted joined set."""
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(values))), separator)
