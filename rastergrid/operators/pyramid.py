"""Tile keys of extents, point aggregation on tiles and roll-up of a pyramid."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import grid
from ..functions.pixel_types import pixel_value
from ..joins import keep_wanted, never_broadcast, save
from . import pixels as px


def enumerate_tiles(
    extents: DataFrame,
    keys: list[str],
    size: int = grid.TILE_SIZE,
    partitions: int | None = None,
) -> DataFrame:
    """All tiles ``(keys…, z, y, x)`` of extents from ``zmin`` to ``zmax``.

    ``extents`` has ``zmin, zmax, left, right, top, bottom``. Extents with a corner
    outside the world, or inverted ones, give no tile.

    A deep level holds millions of tiles, so one extent must not expand inside one
    task: levels and tile rows are expanded first, then spread over the cluster, and
    only then the columns. The partition number is explicit because the spread rows
    are tiny and would otherwise be merged again at run time.
    """
    partitions = partitions or int(extents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    levels = extents.filter(F.col("zmin") <= F.col("zmax")).select(
        *keys, "left", "right", "top", "bottom",
        F.explode(F.sequence("zmin", "zmax")).alias("z"),
    )
    ranges = levels.withColumn(
        "range", grid.tile_range("left", "right", "top", "bottom", "z", size)
    ).filter((F.col("range.xmin") <= F.col("range.xmax")) & (F.col("range.ymin") <= F.col("range.ymax")))
    rows = ranges.select(
        *keys, "z", "range.xmin", "range.xmax",
        F.explode(F.sequence("range.ymin", "range.ymax")).alias("y"),
    )
    return rows.repartition(partitions, *keys, "z", "y").select(
        *keys, "z", "y", F.explode(F.sequence("xmin", "xmax")).alias("x")
    )


def bounded_extents(requests: DataFrame, keys: list[str]) -> DataFrame:
    """Extents of requests: their box where ``usebound`` is 1, the world otherwise."""
    bounded = F.col("usebound") == 1
    return requests.select(
        *keys, "zmin", "zmax",
        *(
            F.when(bounded, F.col(side)).otherwise(F.lit(edge)).alias(side)
            for side, edge in grid.WORLD.items()
        ),
    )


def ancestor(position: Column, steps: Column) -> Column:
    """Tile row or column ``steps`` levels up."""
    return F.call_function("shiftright", position, steps)


def roll_up(tiles: DataFrame, sums: list[str], levels: int, others: list[str] = ()) -> DataFrame:
    """Totals of the same tiles at their own level and ``levels`` levels above.

    The input is already one row per tile, so every ancestor is derived from the
    aggregated rows and added up in one shuffle with map-side partial sums.
    """
    up = F.col("up")
    return (
        tiles.withColumn(
            "up", F.explode(F.sequence(F.lit(0), F.least(F.lit(levels), F.col("z"))))
        )
        .select(
            *others,
            (F.col("z") - up).alias("z"),
            ancestor(F.col("y"), up).alias("y"),
            ancestor(F.col("x"), up).alias("x"),
            *sums,
        )
        .groupBy(*others, "z", "y", "x")
        .agg(*(F.sum(name).alias(name) for name in sums))
    )


def tile_counts(
    points: DataFrame, values: list[str], zmax: int, size: int = grid.TILE_SIZE
) -> DataFrame:
    """Count and value sums of points per tile, for every level ``0..zmax``.

    Points are placed once, at the deepest level; a tile index one level up is the
    index halved, edges included, so coarser levels come from the totals.
    """
    placed = points.select(
        grid.strict_tile("lon", "lat", F.lit(zmax), size).alias("tile"), *values
    ).filter(F.col("tile").isNotNull())
    deepest = (
        placed.groupBy(F.lit(zmax).alias("z"), F.col("tile.y").alias("y"), F.col("tile.x").alias("x"))
        .agg(F.count(F.lit(1)).alias("n"), *(F.sum(v).alias(v) for v in values))
    )
    return roll_up(deepest, ["n", *values], zmax)


def pixels_at(
    requests: DataFrame,
    cells: DataFrame,
    z: int,
    bands: int,
    type_code: int,
    width: int = grid.TILE_SIZE,
    height: int = grid.TILE_SIZE,
) -> DataFrame:
    """Values of all bands at the positions of a request table.

    ``requests`` has ``htable, hpid, dt, lon, lat``; missing tiles give NULL values.
    """
    placed = requests.withColumn(
        "at", grid.pixel_position("lon", "lat", F.lit(z), width, height)
    ).select("*", F.lit(z).alias("z"), "at.y", "at.x", "at.row", "at.col").drop("at")
    keys = ["htable", "hpid", "z", "y", "x", "dt"]
    # Only the dates and tiles that positions fall into are read, and only those are shuffled.
    payload = keep_wanted(cells.filter(F.col("z") == z).select(*keys, "data"), placed, keys, F.col("dt") >= 0)
    found = placed.join(never_broadcast(payload), keys, "left")
    values = F.array(
        *(
            pixel_value("data", type_code, width, height, bands, band, "row", "col")
            for band in range(bands)
        )
    )
    return found.withColumn("values", F.when(F.col("data").isNotNull(), values)).drop("data")


def overviews(
    cells: DataFrame, keys: list[str], levels: int, bands: int, size: int, type_code: int, method: str, fill: float
) -> DataFrame:
    """Blocks of the given level and of ``levels`` levels above it, ``(keys…, z, y, x, data)``.

    ``cells`` has ``keys…, z, y, x, data`` of one level. A pixel of a parent stands for four of its children: ``nearest``
    takes the first of them (top left), ``max`` and ``mean`` the largest and the average of those that are not
    ``fill`` (integers rounded half up); it is ``fill`` where none is, and so is a child that is not stored. At level 1 the two
    tiles of the world fill the upper half of the only tile of level 0. Each level is saved, the given one too, and made of the one
    below in one shuffle of blocks that were halved in their tasks, a quarter of its size. Tiles go through numpy many at a time.
    """
    dtype = px.numpy_type(type_code)
    half = size // 2
    schema = T.StructType([*px.fields_of(cells, [*keys, "z", "y", "x"]), T.StructField("data", T.BinaryType())])
    piece = T.StructType([*schema.fields[:-1], T.StructField("corner", T.IntegerType()), schema.fields[-1]])

    def halved(blocks: np.ndarray) -> np.ndarray:
        if method == "nearest":
            return blocks[:, :, ::2, ::2]
        four = np.stack([blocks[:, :, r::2, c::2] for r in (0, 1) for c in (0, 1)], axis=-1)
        seen = four != fill
        if method == "max":
            low = np.finfo(dtype).min if dtype.kind == "f" else np.iinfo(dtype).min
            result = np.where(seen, four, low).max(axis=-1)
        else:
            result = np.where(seen, four, 0).sum(axis=-1, dtype="<f8") / np.maximum(seen.sum(axis=-1), 1)
            result = np.floor(result + 0.5) if dtype.kind in "iu" else result
        return np.where(seen.any(axis=-1), result, fill).astype(dtype)

    # Tiles that a task takes together; a tile of averages needs some tens of bytes a pixel.
    at_once = max(1, px.WORKING_BYTES // (bands * size * size * max(16, dtype.itemsize)))

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, at_once):
                batch = whole.slice(first, at_once)
                z, y, x = (batch.column(c).to_numpy() for c in ("z", "y", "x"))
                blocks = px.block_matrix(batch.column("data"), dtype).reshape(-1, bands, size, size)
                place = [pa.array(v.astype(np.int32)) for v in (z - 1, y >> 1, x >> 1)]
                corner = pa.array(((y & 1) * 2 + (x & 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k) for k in keys], *place, corner, px.block_array(halved(blocks))], names=piece.names
                )

    def joined(batch: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        bounds = np.append(starts, batch.num_rows)
        for first in range(0, len(starts), at_once):
            some = bounds[first : first + at_once + 1]
            part = batch.slice(some[0], some[-1] - some[0])
            owner = np.repeat(np.arange(len(some) - 1), np.diff(some))
            corner = part.column("corner").to_numpy()
            quarters = px.block_matrix(part.column("data"), dtype).reshape(-1, bands, half, half)
            blocks = np.full((len(some) - 1, bands, size, size), fill, dtype)
            for k in range(4):
                r, c = k // 2 * half, k % 2 * half
                blocks[owner[corner == k], :, r : r + half, c : c + half] = quarters[corner == k]
            found = batch.select(place).take(pa.array(some[:-1]))
            yield pa.RecordBatch.from_arrays([*found.columns, px.block_array(blocks)], names=schema.names)

    def join_four(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            # The quarters of the last tile may go on in the next batch.
            starts = px.run_starts(batch, place)
            held = batch.slice(starts[-1])
            yield from joined(batch.slice(0, starts[-1]), starts[:-1])
        if held is not None:
            yield from joined(held, np.zeros(1, np.int64))

    place = [*keys, "z", "y", "x"]
    level = everything = save(cells.select(*place, "data").filter(F.col("data").isNotNull()), "overview")
    for _ in range(levels):
        quarters = level.filter("z > 0").mapInArrow(halve, piece)
        level = save(quarters.repartition(*place).sortWithinPartitions(*place).mapInArrow(join_four, schema), "overview")
        everything = everything.unionByName(level)
    return everything
