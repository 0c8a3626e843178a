"""Boxes, tiles and their spatial join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE, STRIDE, AREA = 640, 512, 0.40


def to_corners(cx: Column, cy: Column, w: Column, h: Column) -> list[Column]:
    """x_min, y_min, x_max, y_max of a box given by centre and size."""
    return [(cx - w / 2).alias("x_min"), (cy - h / 2).alias("y_min"), (cx + w / 2).alias("x_max"), (cy + h / 2).alias("y_max")]


def to_centre(x_min: Column, y_min: Column, x_max: Column, y_max: Column) -> list[Column]:
    """cx, cy, w, h of a box given by its corners."""
    return [((x_min + x_max) / 2).alias("cx"), ((y_min + y_max) / 2).alias("cy"), (x_max - x_min).alias("w"), (y_max - y_min).alias("h")]


def letterbox_side(w: Column, h: Column, width: Column, height: Column, size: int) -> Column:
    """The shorter side in pixels of a box with normalised sizes, once its image is fitted into a square of ``size``."""
    scale = F.lit(float(size)) / F.greatest(width, height)
    return F.least(w * width * scale, h * height * scale)


def tile_count(side: Column, tile: int = TILE, stride: int = STRIDE) -> Column:
    """Tiles along a side; what lies beyond the last one is in no tile."""
    return F.greatest(F.lit(1), F.floor((side - tile) / stride).cast("int") + 1)


def tile_origin(i: Column, side: Column, tile: int = TILE, stride: int = STRIDE) -> Column:
    return F.least(i * stride, side - tile)


def tile_grid(images: DataFrame, width: str, height: str, tile: int = TILE, stride: int = STRIDE) -> DataFrame:
    """One row per image and tile: col, row, x0, y0 and a tag."""
    cols, rows = tile_count(F.col(width), tile, stride), tile_count(F.col(height), tile, stride)
    grid = images.withColumn("col", F.explode(F.sequence(F.lit(0), cols - 1))).withColumn("row", F.explode(F.sequence(F.lit(0), rows - 1)))
    placed = grid.withColumn("x0", tile_origin(F.col("col"), F.col(width), tile, stride)).withColumn("y0", tile_origin(F.col("row"), F.col(height), tile, stride))
    return placed.withColumn("tag", F.format_string(f"x%d_y%d_s{stride}", F.col("x0").cast("int"), F.col("y0").cast("int")))


def _candidates(low: Column, high: Column, side: Column, tile: int, stride: int) -> Column:
    """Indices of the tiles that an extent may meet, from its ends alone."""
    n = tile_count(side, tile, stride)
    first = F.floor((low - tile) / stride).cast("int") + 1
    last = F.floor(high / stride).cast("int")
    begin, end = F.least(F.greatest(F.lit(0), first), n - 1), F.least(n - 1, F.greatest(F.lit(0), last))
    return F.sequence(begin, F.greatest(begin, end))


def tile_hits(
    boxes: DataFrame, width: str = "width", height: str = "height", tile: int = TILE, stride: int = STRIDE, area: float = AREA
) -> DataFrame:
    """The boxes (x_min, y_min, x_max, y_max in pixels) once for each tile that holds at least ``area`` of them.

    Each box makes its own few candidate tiles, so there is no join and no shuffle. Adds col, row,
    x0, y0 and fraction. Boxes with a null corner or without area hit nothing.
    """
    spread = boxes.where("x_max > x_min and y_max > y_min").withColumn(
        "col", F.explode(_candidates(F.col("x_min"), F.col("x_max"), F.col(width), tile, stride))
    ).withColumn("row", F.explode(_candidates(F.col("y_min"), F.col("y_max"), F.col(height), tile, stride)))
    placed = spread.withColumn("x0", tile_origin(F.col("col"), F.col(width), tile, stride)).withColumn("y0", tile_origin(F.col("row"), F.col(height), tile, stride))
    across = F.greatest(F.lit(0.0), F.least("x_max", F.col("x0") + tile) - F.greatest("x_min", F.col("x0")))
    down = F.greatest(F.lit(0.0), F.least("y_max", F.col("y0") + tile) - F.greatest("y_min", F.col("y0")))
    full = F.greatest((F.col("x_max") - F.col("x_min")) * (F.col("y_max") - F.col("y_min")), F.lit(1e-9))
    return placed.withColumn("fraction", across * down / full).where(F.col("fraction") >= area)


def appearance_histogram(boxes: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """(n_tiles, n_boxes): in how many tiles boxes appear, 0 included."""
    counted = hits.groupBy(key).agg(F.count("*").alias("_n"))
    return boxes.select(key).join(counted, key, "left").groupBy(F.coalesce("_n", F.lit(0)).alias("n_tiles")).agg(F.count("*").alias("n_boxes"))


def reconcile_appearances(histogram: DataFrame) -> DataFrame:
    """One row: raw boxes, those in no tile, what overlap adds, and the boxes there are after tiling."""
    n, k = F.col("n_boxes"), F.col("n_tiles")
    return histogram.agg(
        F.sum(n).alias("raw"), F.coalesce(F.sum(F.when(k == 0, n)), F.lit(0)).alias("boundary_dropped"),
        F.coalesce(F.sum(F.when(k > 1, (k - 1) * n)), F.lit(0)).alias("overlap_gain"), F.sum(k * n).alias("tiled"),
    )


def empty_quota(n_positive: Column, n_empty: Column, share: float = 0.15) -> Column:
    """How many empty tiles an image keeps."""
    return F.least(n_empty, F.floor(n_positive * share))
