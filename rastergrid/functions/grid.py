"""Plate carrée tile pyramid as column expressions.

Level ``z`` has ``2**z`` columns and ``max(1, 2**z / 2)`` rows of square tiles; row 0
is the northernmost. Everything here is built-in arithmetic, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnLike, as_column, idiv

MAX_ZOOM = 21
TILE_SIZE = 256
WORLD = {"left": -180.0, "right": 180.0, "top": 90.0, "bottom": -90.0}
LEVEL0_RESOLUTION = 360.0 / TILE_SIZE


def tile_columns(z: ColumnLike) -> Column:
    """Number of tile columns of a level."""
    return F.pow(F.lit(2.0), as_column(z)).cast("int")


def tile_rows(z: ColumnLike) -> Column:
    """Number of tile rows of a level."""
    return F.greatest(F.lit(1), idiv(tile_columns(z), 2).cast("int"))


def resolution(z: ColumnLike, size: ColumnLike = TILE_SIZE) -> Column:
    """Degrees per pixel of a level."""
    return F.lit(360.0) / (F.pow(F.lit(2.0), as_column(z)) * as_column(size))


def tile_bounds(z: ColumnLike, y: ColumnLike, x: ColumnLike, size: ColumnLike = TILE_SIZE) -> Column:
    """Struct ``left, right, top, bottom`` of a tile in degrees."""
    span = resolution(z, size) * as_column(size)
    left = as_column(x) * span - 180.0
    top = F.lit(90.0) - as_column(y) * span
    return F.struct(
        left.alias("left"),
        (left + span).alias("right"),
        top.alias("top"),
        (top - span).alias("bottom"),
    )


def strict_tile(
    lon: ColumnLike, lat: ColumnLike, z: ColumnLike, size: ColumnLike = TILE_SIZE
) -> Column:
    """Struct ``x, y`` of the tile holding a position; NULL outside the domain.

    The position is truncated to a whole pixel first; the eastern and southern
    edges of the world belong to the last column and row.
    """
    lon, lat, z, size = map(as_column, (lon, lat, z, size))
    inside = (
        lon.between(-180.0, 180.0)
        & lat.between(-90.0, 90.0)
        & z.between(0, MAX_ZOOM)
        & (size > 0)
    )
    res = resolution(z, size)
    px = ((lon + 180.0) / res).cast("int")
    py = ((F.lit(90.0) - lat) / res).cast("int")
    tile = F.struct(
        F.least(idiv(px, size).cast("int"), tile_columns(z) - 1).alias("x"),
        F.least(idiv(py, size).cast("int"), tile_rows(z) - 1).alias("y"),
    )
    return F.when(inside, tile)


def clamped_tile(
    lon: ColumnLike, lat: ColumnLike, z: ColumnLike, size: ColumnLike = TILE_SIZE
) -> Column:
    """Struct ``x, y`` that clamps any position to the nearest edge tile."""
    lon, lat, z, size = map(as_column, (lon, lat, z, size))
    res = F.lit(360.0) / F.pow(F.lit(2.0), z) / size
    xf = (lon + 180.0) / res / size
    yf = (F.lit(90.0) - lat) / res / size

    def clamp(value: Column, count: Column) -> Column:
        # Clamped before the cast: an out-of-range cast is an error in ANSI mode.
        return F.greatest(F.lit(0.0), F.least(value, (count - 1).cast("double"))).cast("int")

    return F.struct(
        clamp(xf, tile_columns(z)).alias("x"), clamp(yf, tile_rows(z)).alias("y")
    )


def pixel_position(
    lon: ColumnLike,
    lat: ColumnLike,
    z: ColumnLike,
    width: ColumnLike = TILE_SIZE,
    height: ColumnLike = TILE_SIZE,
) -> Column:
    """Struct ``x, y, col, row``: the pixel nearest to a position.

    Rounds to the nearest pixel corner without clamping, so a position at the
    eastern edge may give a tile column equal to the number of columns.
    """
    lon, lat, z, width, height = map(as_column, (lon, lat, z, width, height))
    n = F.pow(F.lit(2.0), z)
    full_x = ((lon + 180.0) / (F.lit(360.0) / n / width) + 0.5).cast("int")
    full_y = ((F.lit(90.0) - lat) / (F.lit(180.0) / (n / 2.0) / height) + 0.5).cast("int")
    return F.struct(
        idiv(full_x, width).cast("int").alias("x"),
        idiv(full_y, height).cast("int").alias("y"),
        (full_x % width).cast("int").alias("col"),
        (full_y % height).cast("int").alias("row"),
    )


def tile_range(
    left: ColumnLike,
    right: ColumnLike,
    top: ColumnLike,
    bottom: ColumnLike,
    z: ColumnLike,
    size: ColumnLike = TILE_SIZE,
) -> Column:
    """Struct of the inclusive tile range of an extent with its outer bounds.

    NULL when a corner lies outside the domain.
    """
    first = strict_tile(left, top, z, size)
    last = strict_tile(right, bottom, z, size)
    outer_first = tile_bounds(z, first["y"], first["x"], size)
    outer_last = tile_bounds(z, last["y"], last["x"], size)
    return F.when(
        first.isNotNull() & last.isNotNull(),
        F.struct(
            first["x"].alias("xmin"),
            last["x"].alias("xmax"),
            first["y"].alias("ymin"),
            last["y"].alias("ymax"),
            outer_first["left"].alias("left"),
            outer_last["right"].alias("right"),
            outer_first["top"].alias("top"),
            outer_last["bottom"].alias("bottom"),
        ),
    )


def expand_half_pixel(
    left: ColumnLike, right: ColumnLike, top: ColumnLike, bottom: ColumnLike
) -> Column:
    """Extent struct grown by half a level-0 pixel on each side, inside the world."""
    half = LEVEL0_RESOLUTION / 2
    return F.struct(
        F.greatest(F.lit(WORLD["left"]), as_column(left) - half).alias("left"),
        F.least(F.lit(WORLD["right"]), as_column(right) + half).alias("right"),
        F.least(F.lit(WORLD["top"]), as_column(top) + half).alias("top"),
        F.greatest(F.lit(WORLD["bottom"]), as_column(bottom) - half).alias("bottom"),
    )
