"""Export of a box at one level as blocks of a mosaic."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import grid
from ..joins import never_broadcast
from ..operators import pixels as px
from ..operators.pyramid import enumerate_tiles
from ..sources import cells as store

BLOCK = 512
BOX = ["row0", "col0", "rows", "cols"]


def box_pixels(level: Column, size: int) -> dict[str, Column]:
    """First pixel and number of pixels of a box at a level: all pixels that it has a part of, within the world."""
    res = grid.resolution(level, size)
    width = F.pow(F.lit(2.0), level) * size
    height = F.greatest(F.lit(1.0), F.pow(F.lit(2.0), level) / 2) * size

    def edges(low: Column, high: Column, whole: Column):
        first = F.greatest(F.floor(low / res), F.lit(0))
        return first.cast("int"), (F.least(F.ceil(high / res), whole) - first).cast("int")

    col0, cols = edges(F.col("left") + 180, F.col("right") + 180, width)
    row0, rows = edges(F.lit(90) - F.col("top"), F.lit(90) - F.col("bottom"), height)
    return {"row0": row0, "col0": col0, "rows": rows, "cols": cols}


def export_blocks(
    orders: DataFrame,
    cells: DataFrame,
    keys: list[str],
    bands: int,
    size: int,
    type_code: int,
    fill: float,
    function: Callable[[np.ndarray], np.ndarray] | None = None,
    out_bands: int | None = None,
    out_type: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Blocks ``(keys…, row0, col0, rows, cols, data)`` that tile each order's box, cut to it.

    ``orders`` has ``keys…, htable, hpid, dt, level, left, right, top, bottom``. A block has at most ``block``
    pixels a side and holds its bands one after another; ``row0`` and ``col0`` are its first pixel on the whole level.
    Every tile is cut into the slices of the blocks it meets, and the slices of a block, a bounded number, are put
    together. Tiles that are not stored come out full of ``fill``. With a ``function`` its result on each
    tile is exported instead of the stored values. A box without pixels gives no block.
    """
    attributes = ["htable", "hpid", "dt"]
    boxed = orders.withColumns(box_pixels(F.col("level"), size)).filter("rows > 0 AND cols > 0")
    # The corners of a box that reaches beyond the world lie on no tile.
    inside = {
        "left": F.greatest("left", F.lit(-180.0)), "right": F.least("right", F.lit(180.0)),
        "top": F.least("top", F.lit(90.0)), "bottom": F.greatest("bottom", F.lit(-90.0)),
    }
    extents = boxed.withColumns({**inside, "zmin": F.col("level"), "zmax": F.col("level")})
    wanted = enumerate_tiles(extents, [*keys, *attributes, *BOX], size)
    found = store.at(cells, never_broadcast(wanted))
    if function is not None:
        place = [*keys, "z", "y", "x", *BOX]
        found = px.map_tiles(found, place, function, bands, size, size, type_code, out_type)
        bands, type_code = out_bands or bands, out_type or type_code
    dtype = px.numpy_type(type_code)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of every tile the slices inside the box, one for each block; a tile that is missing has no data."""
        for batch in batches:
            own, rows = [], []
            tiles = [batch.column(c).to_pylist() for c in ("y", "x", *BOX)]
            for k, (y, x, row0, col0, height, width) in enumerate(zip(*tiles)):
                data = batch.column("data")[k]
                tile = np.frombuffer(data.as_buffer(), dtype).reshape(-1, size, size) if data.is_valid else None
                top, left = max(y * size, row0), max(x * size, col0)
                bottom, right = min((y + 1) * size, row0 + height), min((x + 1) * size, col0 + width)
                for by in range((top - row0) // block, -(-(bottom - row0) // block)):
                    for bx in range((left - col0) // block, -(-(right - col0) // block)):
                        r0, r1 = max(top, row0 + by * block), min(bottom, row0 + (by + 1) * block)
                        c0, c1 = max(left, col0 + bx * block), min(right, col0 + (bx + 1) * block)
                        if r0 < r1 and c0 < c1:
                            part = None if tile is None else tile[:, r0 - y * size : r1 - y * size, c0 - x * size : c1 - x * size].tobytes()
                            own.append(k)
                            rows.append((by, bx, r0, c0, row0 + by * block, col0 + bx * block, r1 - r0, c1 - c0, part, height, width, row0, col0))
            if rows:
                by, bx, r0, c0, b0, d0, h, w, part, height, width, row0, col0 = zip(*rows)
                # The size of the whole block, and place and shape of the slice in it.
                whole_h = [min(block, a + n - b) for a, n, b in zip(row0, height, b0)]
                whole_w = [min(block, a + n - b) for a, n, b in zip(col0, width, d0)]
                where = [(r - b) << 32 | (c - d) for r, b, c, d in zip(r0, b0, c0, d0)]
                shape = [a << 32 | b for a, b in zip(h, w)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(pa.array(own)) for c in keys], *[pa.array(v, pa.int32()) for v in (by, bx)],
                     pa.array(where, pa.int64()), pa.array(shape, pa.int64()), *[pa.array(v, pa.int32()) for v in (b0, d0, whole_h, whole_w)],
                     pa.array(part, pa.binary())],
                    names=[*keys, "by", "bx", "place", "shape", *BOX, "data"],
                )

    piece = T.StructType([
        *px.fields_of(found, keys), T.StructField("by", T.IntegerType()), T.StructField("bx", T.IntegerType()),
        T.StructField("place", T.LongType()), T.StructField("shape", T.LongType()),
        *(T.StructField(n, T.IntegerType()) for n in BOX), T.StructField("data", T.BinaryType()),
    ])
    result = T.StructType([*px.fields_of(found, keys), *(T.StructField(n, T.IntegerType()) for n in BOX), T.StructField("data", T.BinaryType())])

    def stitch(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        box = [table.column(n)[0].as_py() for n in BOX]
        whole = np.full((bands, box[2], box[3]), fill, dtype)
        low = (1 << 32) - 1
        for place, shape, data in zip(table.column("place").to_pylist(), table.column("shape").to_pylist(), table.column("data")):
            if data.is_valid:
                r, c, h, w = place >> 32, place & low, shape >> 32, shape & low
                whole[:, r : r + h, c : c + w] = np.frombuffer(data.as_buffer(), dtype).reshape(bands, h, w)
        columns = [pa.array([k.as_py()], type=k.type) for k in key[: len(keys)]] + [pa.array([v], pa.int32()) for v in box]
        return pa.Table.from_arrays([*columns, pa.array([whole.tobytes()], pa.binary())], names=result.names)

    return found.mapInArrow(cut, piece).groupBy(*keys, "by", "bx").applyInArrow(stitch, result)


def block_rows(blocks: DataFrame, keys: list[str], bands: int, type_code: int) -> DataFrame:
    """Sums along the pixel rows of blocks: ``keys…, grow, n, total``, one row per block row."""
    dtype = px.numpy_type(type_code)
    schema = T.StructType([*px.fields_of(blocks, keys), T.StructField("grow", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("total", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row0, _, rows, cols = (batch.column(n)[k].as_py() for n in BOX)
                data = np.frombuffer(batch.column("data")[k].as_buffer(), dtype).reshape(bands, rows, cols)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(pa.array([k] * rows)) for c in keys], pa.array(np.arange(row0, row0 + rows), pa.int32()),
                     pa.array(np.full(rows, bands * cols), pa.int64()), pa.array(data.sum(axis=(0, 2), dtype=np.float64))],
                    names=schema.names,
                )

    return blocks.mapInArrow(run, schema)
