"""Regions as row segments: building, levels, clipping and packed zonal statistics.

A region is a set of inclusive column ranges ``(roi_id, level, grow, x0, x1)`` in pixel
positions of a whole level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import grid, texts
from ..functions.columns import ColumnLike, as_column, idiv
from ..joins import broadcast_if_small, never_broadcast, save
from .pixels import WORKING_BYTES, fields_of, numbers_batch, block_numbers, numpy_type


# Crossings of polygons with pixel rows that one task gets.
CROSSINGS = 1 << 18


def merge_segments(segments: DataFrame) -> DataFrame:
    """Join overlapping and touching segments of one region row, so pixels count once."""
    row = ["roi_id", "level", "grow"]
    order = Window.partitionBy(*row).orderBy("x0", "x1")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # One segment per start keeps a row's window within the width of the level.
    longest = segments.groupBy(*row, "x0").agg(F.max("x1").alias("x1"))
    started = longest.withColumn("reach", F.max("x1").over(before)).withColumn(
        "new", F.when(F.col("reach").isNull() | (F.col("x0") > F.col("reach") + 1), 1).otherwise(0)
    )
    return (
        started.withColumn("run", F.sum("new").over(order))
        .groupBy(*row, "run").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("run")
    )


def at_levels(segments: DataFrame, zmin: ColumnLike, zmax: ColumnLike) -> DataFrame:
    """The same regions at other levels: a coarser pixel is in if any part of it is.

    The level range may differ per row; the result is merged.
    """
    levels = segments.withColumn("to", F.explode(F.sequence(as_column(zmin), as_column(zmax))))
    up = F.greatest(F.col("level") - F.col("to"), F.lit(0))
    down = F.greatest(F.col("to") - F.col("level"), F.lit(0))

    def coarser(name):
        return F.call_function("shiftright", F.col(name), up)

    def finer(column):
        return F.call_function("shiftleft", column, down)

    first = finer(coarser("grow"))
    last = finer(coarser("grow") + 1) - 1
    scaled = levels.select(
        "roi_id", F.col("to").alias("level"),
        F.explode(F.sequence(first, last)).alias("grow"),
        finer(coarser("x0")).alias("x0"),
        (finer(coarser("x1") + 1) - 1).alias("x1"),
    )
    return merge_segments(scaled)


def cut_at_tiles(segments: DataFrame, size: int, merged: bool = False) -> DataFrame:
    """Segments cut at tile columns: ``(roi_id, z, grow, x, x0, x1)``.

    ``merged`` says that they do not overlap already.
    """
    merged = segments if merged else merge_segments(segments)
    tiles = F.sequence(idiv("x0", size).cast("int"), idiv("x1", size).cast("int"))
    return merged.select(
        "roi_id", F.col("level").alias("z"), "grow", "x0", "x1", F.explode(tiles).alias("x")
    ).select(
        "roi_id", "z", "grow", "x",
        F.greatest("x0", F.col("x") * size).alias("x0"),
        F.least("x1", F.col("x") * size + size - 1).alias("x1"),
    )


def by_tile(segments: DataFrame, size: int, merged: bool = False) -> DataFrame:
    """One row per region and tile, ``covered`` or with its in-tile segments ``(row, c0, c1)``.

    A tile that lies wholly inside its region is covered and carries no segments. Merged segments bound
    the list of the others: at most half a tile width per tile row.
    """
    part = F.struct(
        (F.col("grow") % size).alias("row"), (F.col("x0") % size).alias("c0"), (F.col("x1") % size).alias("c1")
    )
    gathered = (
        cut_at_tiles(segments, size, merged)
        .withColumn("y", idiv("grow", size).cast("int"))
        .groupBy("roi_id", "z", "y", "x")
        .agg(F.collect_list(part).alias("parts"), (F.sum(F.col("x1") - F.col("x0") + 1) == size * size).alias("covered"))
    )
    return gathered.select("roi_id", "z", "y", "x", "covered", F.when(~F.col("covered"), F.col("parts")).alias("segments"))


def cover_tiles(segments: DataFrame, zmin: ColumnLike, zmax: ColumnLike, size: int) -> DataFrame:
    """The tiles of regions at the levels from ``zmin`` to ``zmax``, as ``by_tile`` has them.

    Levels finer than a region's own come from its tiles, as in a quadtree: all descendants of a covered tile are
    covered and never become pixel rows, so only the segments of border tiles are carried down. A region has all
    levels between the least ``zmin`` and the greatest ``zmax`` of its rows.
    """
    limits = segments.groupBy("roi_id").agg(F.min(as_column(zmin)).alias("lo_"), F.max(as_column(zmax)).alias("hi_"))
    columns = ["roi_id", "level", "grow", "x0", "x1"]
    rows = segments.select(*columns).distinct().join(limits, "roi_id")
    upto = rows.filter("lo_ <= level")
    own_and_coarser = by_tile(at_levels(upto, F.col("lo_"), F.least("hi_", "level")), size, merged=True)
    own = by_tile(rows.filter("hi_ > level").select(*columns), size).join(limits, "roi_id")
    deeper = own.filter("covered").select(
        "roi_id", "z", "y", "x", F.explode(F.sequence(F.greatest("lo_", F.col("z") + 1), "hi_")).alias("to")
    )

    def under(name: str) -> Column:
        first = F.call_function("shiftleft", F.col(name), F.col("to") - F.col("z"))
        last = F.call_function("shiftleft", F.col(name) + 1, F.col("to") - F.col("z")) - 1
        return F.explode(F.sequence(first, last))

    covered = (
        deeper.withColumn("ny", under("y")).withColumn("nx", under("x"))
        .select("roi_id", F.col("to").alias("z"), F.col("ny").alias("y"), F.col("nx").alias("x"), F.lit(True).alias("covered"),
                F.lit(None).cast(own.schema["segments"].dataType).alias("segments"))
    )
    border = own.filter("NOT covered").select("roi_id", "z", "y", "x", "lo_", "hi_", F.explode("segments").alias("s")).select(
        "roi_id", F.col("z").alias("level"), (F.col("y") * size + F.col("s.row")).alias("grow"),
        (F.col("x") * size + F.col("s.c0")).alias("x0"), (F.col("x") * size + F.col("s.c1")).alias("x1"), "lo_", "hi_",
    )
    finer = by_tile(at_levels(border, F.greatest("lo_", F.col("level") + 1), F.col("hi_")), size, merged=True)
    return own_and_coarser.unionByName(covered).unionByName(finer)


def clip(pixels: DataFrame, segments: DataFrame, roi: str, size: int, fill: float) -> DataFrame:
    """Pixel rows with ``fill`` outside the region named in column ``roi``.

    Merged segments do not overlap, so each pixel meets at most one of them.
    """
    cut = broadcast_if_small(cut_at_tiles(segments, size)).withColumnRenamed("roi_id", roi)
    hit = pixels.alias("p").join(
        cut.alias("s"),
        (F.col(f"p.{roi}") == F.col(f"s.{roi}")) & (F.col("p.z") == F.col("s.z"))
        & (F.col("p.grow") == F.col("s.grow")) & (F.col("p.x") == F.col("s.x"))
        & (F.col("p.gcol") >= F.col("s.x0")) & (F.col("p.gcol") <= F.col("s.x1")),
        "left",
    )
    others = [F.col(f"p.{c}") for c in pixels.columns if c != "dn"]
    return hit.select(*others, F.when(F.col("s.x0").isNotNull(), F.col("p.dn")).otherwise(F.lit(fill)).alias("dn"))


def tile_mask(segments, width: int, height: int) -> np.ndarray:
    """Boolean tile mask of a list of in-tile segments."""
    edges = np.zeros((height, width + 1), np.int32)
    if segments is not None and len(segments):
        row, c0, c1 = (np.asarray(segments.field(name)) for name in ("row", "c0", "c1"))
        np.add.at(edges, (row, c0), 1)
        np.add.at(edges, (row, c1 + 1), -1)
    return np.cumsum(edges, axis=1)[:, :width] > 0


class MaskCache:
    """Tile masks by place, since all dates of a tile share them; bounded in bytes."""

    def __init__(self, width: int, height: int):
        self.width, self.height = width, height
        self.limit = max(1, WORKING_BYTES // (width * height))
        self.masks: dict[tuple, np.ndarray] = {}
        self.whole = np.ones((height, width), bool)

    def get(self, place: tuple, segments: pa.Scalar, covered: pa.Scalar) -> np.ndarray:
        if covered.as_py():
            return self.whole
        mask = self.masks.get(place)
        if mask is None:
            if len(self.masks) >= self.limit:
                self.masks.clear()
            mask = self.masks[place] = tile_mask(segments.values, self.width, self.height)
        return mask


def clip_tiles(
    tiles: DataFrame,
    region_tiles: DataFrame,
    width: int,
    height: int,
    type_code: int,
) -> DataFrame:
    """Packed tiles with column ``fill`` outside the region in column ``roi_id``.

    A NULL or empty region leaves the tile as it is.
    """
    dtype = numpy_type(type_code)
    names = tiles.columns
    schema = T.StructType(fields_of(tiles, names))
    regions = broadcast_if_small(region_tiles)
    joined = tiles.join(regions, ["roi_id", "z", "y", "x"], "left").select(*names, "segments", "covered")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = MaskCache(width, height)
        for batch in batches:
            data = []
            columns = {name: batch.column(name) for name in names}
            for i in range(batch.num_rows):
                cell, roi = columns["data"][i], columns["roi_id"][i].as_py()
                # A covered tile skips the clip.
                if not cell.is_valid or not roi or batch.column("covered")[i].as_py():
                    data.append(cell.as_py())
                    continue
                block = np.frombuffer(cell.as_buffer(), dtype).reshape(-1, height, width)
                place = (roi, *(columns[c][i].as_py() for c in ("z", "y", "x")))
                mask = masks.get(place, batch.column("segments")[i], batch.column("covered")[i])
                data.append(np.where(mask, block, np.array(columns["fill"][i].as_py(), dtype)).astype(dtype).tobytes())
            columns["data"] = pa.array(data, pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return joined.mapInArrow(run, schema)


def zonal_tiles(
    cells: DataFrame,
    region_tiles: DataFrame,
    by: list[str],
    band: int,
    vmin: float,
    vmax: float,
    width: int,
    height: int,
    type_code: int,
) -> DataFrame:
    """Zonal statistics straight from packed tiles.

    Each (tile, region) pair becomes one small row of sums in the map task; only
    those rows are shuffled.
    """
    dtype = numpy_type(type_code)
    joined = cells.join(broadcast_if_small(region_tiles), ["z", "y", "x"]).select(
        "roi_id", "z", "y", "x", *(c for c in by if c not in ("z", "y", "x")), "data", "segments", "covered"
    )
    schema = T.StructType(
        [
            *fields_of(joined, ["roi_id", *by]),
            T.StructField("n", T.LongType()),
            T.StructField("total", T.DoubleType()),
            T.StructField("low", T.DoubleType()),
            T.StructField("high", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = MaskCache(width, height)
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                place = tuple(batch.column(c)[i].as_py() for c in ("roi_id", "z", "y", "x"))
                mask = masks.get(place, batch.column("segments")[i], batch.column("covered")[i])
                block = np.frombuffer(batch.column("data")[i].as_buffer(), dtype)
                plane = block.reshape(-1, height, width)[band][mask]
                rows.append(block_numbers(plane[(plane >= vmin) & (plane <= vmax)]))
            yield numbers_batch([batch.column(k) for k in ("roi_id", *by)], rows, schema.names)

    totals = joined.mapInArrow(run, schema).groupBy("roi_id", *by).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    return totals.filter("n > 0").withColumn("ave", F.col("total") / F.col("n"))


def polygon_segments(
    vertices: DataFrame, level: int, size: int = grid.TILE_SIZE
) -> DataFrame:
    """Row segments of polygons, a pixel being in when its centre is (even-odd rule).

    ``vertices`` has ``roi_id, ring, seq, lon, lat`` with ``seq`` counting up by one;
    rings close by themselves. Every edge is expanded to the pixel rows whose centre
    line it crosses. Crossings that fall between the same two centres cancel in pairs,
    so what is ordered per row is bounded by the width of the level. Edges are saved and their crossings counted, so that
    tasks get so many of them each, however few files or partitions the vertices came from.
    """
    degrees = 360.0 / (2**level * size)
    columns = 2**level * size
    rows = max(1, 2**level // 2) * size
    ring = ["roi_id", "ring"]
    corners = vertices.select(
        *ring, "seq",
        ((F.col("lon") + 180.0) / degrees).alias("px"),
        ((F.lit(90.0) - F.col("lat")) / degrees).alias("py"),
    )
    ends = corners.select(
        *ring, (F.col("seq") - 1).alias("seq"), F.col("px").alias("qx"), F.col("py").alias("qy")
    )
    # Neighbours meet by an equality join and only the closing edge by ring, so a ring
    # with very many corners is not gathered in one place.
    point = F.struct("px", "py")
    closing = corners.groupBy(*ring).agg(
        F.max_by(point, "seq").alias("last"), F.min_by(point, "seq").alias("first")
    ).select(
        *ring, "last.px", "last.py", F.col("first.px").alias("qx"), F.col("first.py").alias("qy")
    )
    edges = never_broadcast(corners).join(ends, [*ring, "seq"]).drop("seq").unionByName(closing).filter("py <> qy")
    # An edge covers the row centres in [min, max), so shared corners count once.
    first = F.greatest(F.ceil(F.least("py", "qy") - 0.5), F.lit(0)).cast("int")
    last = F.least(F.ceil(F.greatest("py", "qy") - 0.5) - 1, F.lit(rows - 1)).cast("int")
    share = (F.col("grow") + 0.5 - F.col("py")) * (F.col("qx") - F.col("px")) / (F.col("qy") - F.col("py"))
    column = F.greatest(F.lit(0), F.least(F.lit(columns), F.ceil(F.col("px") + share - 0.5)))
    crossing = save(edges.withColumns({"r0": first, "r1": last}).filter("r0 <= r1").drop("ring"), "edges")
    count = crossing.agg(F.coalesce(F.sum(F.col("r1").cast("bigint") - F.col("r0") + 1), F.lit(0))).first()[0]
    tasks = max(vertices.sparkSession.sparkContext.defaultParallelism, -(-count // CROSSINGS))
    # One shuffle by pixel row serves the cancelling and the pairing.
    toggles = (
        crossing.withColumn("grow", F.explode(F.sequence("r0", "r1")))
        .select("roi_id", "grow", column.cast("int").alias("x0")).repartition(tasks, "roi_id", "grow")
        .groupBy("roi_id", "grow", "x0")
        .agg((F.count(F.lit(1)) % 2).alias("odd")).filter("odd = 1")
    )
    order = Window.partitionBy("roi_id", "grow").orderBy("x0")
    paired = toggles.withColumn("number", F.row_number().over(order)).withColumn(
        "next", F.lead("x0").over(order)
    ).filter("number % 2 = 1")
    return paired.select(
        "roi_id", F.lit(level).alias("level"), "grow", "x0", (F.col("next") - 1).alias("x1")
    )


def resolve(wanted: DataFrame, stores: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Mask bytes of region texts: ``user:n`` and ``sys:n`` by store, others by path.

    ``wanted`` has a column ``roi``; ``stores`` is ``(prefix, rid, data)`` and ``files``
    ``(path, data)``. ``ok`` is false for a text that names nothing.
    """
    parsed = texts.region_id("roi")
    keyed = wanted.withColumns(
        {"prefix": texts.region_route("roi"), "rid": parsed["id"]}
    )
    found = keyed.join(stores, ["prefix", "rid"], "left")
    if files is not None:
        by_path = files.select(
            F.lit("file").alias("prefix"), F.col("path").alias("roi"), F.col("data").alias("file_data")
        )
        found = found.join(by_path, ["prefix", "roi"], "left").withColumn(
            "data", F.coalesce("data", "file_data")
        ).drop("file_data")
    return found.select(*wanted.columns, "prefix", "rid", "data").withColumn(
        "ok", F.col("data").isNotNull()
    )
