"""Normal forms of the names that sources spell differently. All are native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The splits there are, and the spellings that mean val.
SPLITS = ("train", "val", "test")
VAL_SPELLINGS = ("valid", "validation")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without surrounding white space of any kind."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def source_key(c: Column | str) -> Column:
    """Letter case, surrounding white space and `-` against `_` do not tell sources apart. Blank is null."""
    key = F.translate(F.lower(strip(c)), "-", "_")
    return F.when(key != "", key)


def split_key(c: Column | str) -> Column:
    """train, val or test; anything else (null, blank, unspecified, ...) is no split, that is null."""
    key = F.lower(strip(c))
    key = F.when(key.isin(*VAL_SPELLINGS), F.lit("val")).otherwise(key)
    return F.when(key.isin(*SPLITS), key)


def group_key(c: Column | str) -> Column:
    """Lower case without surrounding white space; null and blank are no group."""
    key = F.lower(strip(c))
    return F.when(key != "", key)


def digest_key(c: Column | str) -> Column:
    """A digest in lower case; blank is no digest."""
    key = F.lower(strip(c))
    return F.when(key != "", key)


def computed_hash(c: Column | str) -> Column:
    """A perceptual hash as long; 0 means, like null, that it could not be computed."""
    value = _col(c).cast("long")
    return F.when(value != 0, value)


def label_text(c: Column | str) -> Column:
    """Class names for comparison: trimmed lower case, `-` as `_`, runs of white space as one blank."""
    return F.regexp_replace(F.translate(F.lower(F.trim(_col(c))), "-", "_"), r"\s+", " ")


def safe_slug(c: Column | str) -> Column:
    """Everything but letters, digits, `.`, `_` and `-` becomes `_`, none at the ends; nothing left is null."""
    slug = F.btrim(F.regexp_replace(_col(c), r"[^A-Za-z0-9._-]+", "_"), F.lit("._-"))
    return F.when(slug != "", slug)
