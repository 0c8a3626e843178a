"""Group keys from file stems and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The suffix that an export adds to a stem, and that of a video frame.
EXPORT = r"(?i)^(.+)_[A-Za-z0-9]+\.rf\.[0-9a-f]{32}$"
EXPORT_OF_IMAGE = r"(?i)^(.+)_(?:jpg|png)\.rf\.[0-9a-f]{32}$"
FRAME = r"(?i)^(.+)_frame_\d+(?:_(?:jpg|jpeg|png|webp))?$"


def _base(stem: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(stem, pattern, 1), F.lit(""))


def prefix_group(stem: Column, prefix: str) -> Column:
    """The part of the stem before the first `_`."""
    return F.concat(F.lit(prefix), F.split_part(stem, F.lit("_"), F.lit(1)))


def family_group(stem: Column, prefix: str, video: str = "IMG_") -> Column:
    """Frames of one video together, by the stem's first two parts; any other stem by itself."""
    return F.when(stem.startswith(video), F.concat(F.lit(f"{prefix}v"), F.substring_index(stem, "_", 2))).otherwise(F.concat(F.lit(prefix), stem))


def export_group(stem: Column, prefix: str, strict: bool = True) -> Column:
    """The stem before an export's suffix, in lower case. Without the suffix the job fails, or, if not strict, the stem stays."""
    base = _base(stem, EXPORT if strict else EXPORT_OF_IMAGE)
    if strict:
        failed = F.raise_error(F.concat(F.lit("stem without an export suffix: "), stem)).cast("string")
        return F.concat(F.lit(prefix), F.when(stem.isNull() | base.isNotNull(), F.lower(base)).otherwise(failed))
    return F.concat(F.lit(prefix), F.coalesce(base, stem))


def candidate_group(path: Column, stem: Column, mode: str = "auto") -> Column:
    """The group of a candidate image, the export suffix taken off first.

    `per-image`: the path. `auto`: the video of a frame, else the path. `stem`: the video of a frame, else the stem.
    """
    if mode not in ("per-image", "auto", "stem"):
        raise ValueError(f"no such mode: {mode}")
    image = F.concat(F.lit("img_"), path)
    if mode == "per-image":
        return image
    bare = F.coalesce(_base(stem, EXPORT), stem)
    frame = _base(bare, FRAME)
    other = image if mode == "auto" else F.concat(F.lit("stem_"), F.lower(bare))
    return F.when(frame.isNotNull(), F.concat(F.lit("frame_"), F.lower(frame))).otherwise(other)


def seconds_of_day(digits: Column) -> Column:
    """HHMMSS digits as seconds; null unless six digits."""
    part = lambda at: F.substring(digits, at, 2).cast("int")
    return F.when(digits.rlike(r"^\d{6}$"), part(1) * 3600 + part(3) * 60 + part(5))
