"""Composite and zonal-statistics requests, many at once, on packed tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..joins import broadcast_if_small, never_broadcast, save
from ..operators import pixels as px
from ..operators import pyramid, regions
from ..sources import cells as store


def composite_requests(
    requests: DataFrame,
    cells: DataFrame,
    method: str,
    vmin: float,
    vmax: float,
    fill: float,
    size: int,
    type_code: int,
    out_type: int | None = None,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Composite blocks ``(request_id, z, y, x, data)`` of each request's pyramid.

    ``requests``: request_id, htable, hpid, startdt, stopdt, usebound, zmin, zmax and a
    box, all with the same method, valid range and fill. ``dates``: the store's list of
    dates, where it keeps one.
    """
    ranges = ["htable", "hpid", "startdt", "stopdt"]
    extents = pyramid.bounded_extents(requests, ["request_id", *ranges])
    tiles = save(pyramid.enumerate_tiles(extents, ["request_id", *ranges], size), "composite-tiles")
    if dates is None:
        cells = store.made_once(cells)
        dates = store.listed_dates(cells)
    # Requests that ask for the same dates of a tile share its composite, so a block is met once a range, not once a request.
    asked = [*store.TILE, "startdt", "stopdt"]
    stored = store.of_planes(cells, store.request_dates(requests, dates)).select(*store.CELL, "data")
    found = never_broadcast(tiles.select(*asked).distinct()).join(stored, store.TILE)
    inside = found.filter(F.col("dt").between(F.col("startdt"), F.col("stopdt")))
    return px.composite_tiles(
        inside, asked, method, vmin, vmax, fill, type_code, out_type, askers=tiles, by=["request_id", "z", "y", "x"]
    )


def _listed_numbers(known: DataFrame) -> DataFrame:
    """Numbers of covered tiles, ``request_id, method, dt, n, total, low, high``, from their listed values."""
    least, most = F.greatest("vmin", "valid_min"), F.least("vmax", "valid_max")
    pairs = F.arrays_zip("values", "counts")
    kept = F.filter(pairs, lambda p: (p["values"] >= least) & (p["values"] <= most) & (p["values"] != F.col("nodata")))
    rows = known.select("request_id", "method", "dt", kept.alias("kept"))
    return rows.select(
        "request_id", "method", "dt",
        F.aggregate("kept", F.lit(0).cast("bigint"), lambda n, p: n + p["counts"]).alias("n"),
        F.aggregate("kept", F.lit(0.0), lambda total, p: total + p["values"] * p["counts"]).alias("total"),
        F.array_min("kept.values").alias("low"), F.array_max("kept.values").alias("high"),
    )


def zonal_requests(
    requests: DataFrame, cells: DataFrame, segments: DataFrame, size: int, type_code: int, dates: DataFrame | None = None,
    zones: DataFrame | None = None,
) -> DataFrame:
    """Statistics per request and date: ``request_id, dt, n, low, high, ave, value``.

    ``requests``: request_id, roi_id, htable, hpid, bsq, zlevel, startdt, stopdt, vmin,
    vmax, valid_min, valid_max, nodata, method. A pixel counts when it lies in both
    ranges and is not nodata; ``value`` is the statistic the method names. With ``zones``, the store's zone
    table (``pixels.zone_table``), tiles that lie wholly inside a region are answered from it, and only blocks of border tiles
    are read.
    """
    dtype = px.numpy_type(type_code)
    levels = requests.select("roi_id", "zlevel").distinct()
    wanted = segments.join(levels, "roi_id")
    region_tiles = regions.cover_tiles(wanted, "zlevel", "zlevel", size)
    limits = ["bsq", "vmin", "vmax", "valid_min", "valid_max", "nodata"]
    # Requests may be many more than tiles of regions, which are measured; a join of guessed sizes would broadcast the requests.
    tiles = requests.withColumnRenamed("zlevel", "z").join(broadcast_if_small(region_tiles), ["roi_id", "z"])
    from_zones = None
    if zones is not None:
        tiles = save(tiles, "zonal-tiles")
        known = tiles.filter("covered").join(zones, [*store.TILE, "bsq"]).filter(F.col("dt").between(F.col("startdt"), F.col("stopdt")))
        from_zones = _listed_numbers(known.filter("values IS NOT NULL"))
        # Covered tiles whose bands have too many values to list are read like border tiles.
        unlisted = known.filter("values IS NULL").select("request_id", *store.CELL).distinct()
    if dates is None:
        cells = store.made_once(cells)
        dates = store.listed_dates(cells)
    wanted = store.request_dates(requests, dates)
    if zones is None:
        stored = store.of_planes(cells, wanted).select(*store.CELL, "data")
        found = never_broadcast(tiles).join(stored, store.TILE)
    else:
        dated = tiles.join(wanted, ["htable", "hpid"]).filter(F.col("dt").between(F.col("startdt"), F.col("stopdt")))
        border = dated.filter("NOT covered").unionByName(dated.filter("covered").join(unlisted, ["request_id", *store.CELL], "left_semi"))
        border = save(border, "zonal-border")
        found = store.at(cells, border).filter(F.col("data").isNotNull())
    inside = found.filter(F.col("dt").between(F.col("startdt"), F.col("stopdt"))).select(
        "request_id", "method", "roi_id", "z", "y", "x", "dt", *limits, "segments", "covered", "data"
    )
    schema = T.StructType(
        [
            *px.fields_of(inside, ["request_id", "method", "dt"]),
            T.StructField("n", T.LongType()),
            T.StructField("total", T.DoubleType()),
            T.StructField("low", T.DoubleType()),
            T.StructField("high", T.DoubleType()),
        ]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = regions.MaskCache(size, size)
        for batch in batches:
            rows = []
            places = zip(*(batch.column(c).to_pylist() for c in ("roi_id", "z", "y", "x")))
            ranges = zip(*(batch.column(c).to_pylist() for c in limits))
            tiles = zip(*(batch.column(c) for c in ("segments", "covered", "data")))
            for place, (bsq, vmin, vmax, low, high, nodata), (segments, covered, data) in zip(places, ranges, tiles):
                mask = masks.get(place, segments, covered)
                block = np.frombuffer(data.as_buffer(), dtype)
                values = block.reshape(-1, size, size)[bsq][mask]
                keep = (values >= max(vmin, low)) & (values <= min(vmax, high)) & (values != nodata)
                rows.append(px.block_numbers(values[keep]))
            columns = [batch.column(c) for c in ("request_id", "method", "dt")]
            yield px.numbers_batch(columns, rows, schema.names)

    numbers = inside.mapInArrow(measure, schema)
    if from_zones is not None:
        numbers = numbers.unionByName(from_zones)
    totals = numbers.groupBy("request_id", "method", "dt").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    ave = F.when(F.col("n") > 0, F.col("total") / F.col("n"))
    value = F.when(F.col("method") == "min", F.col("low")).when(F.col("method") == "max", F.col("high")).when(F.col("method") == "ave", ave)
    return totals.select("request_id", "dt", "n", "low", "high", ave.alias("ave"), value.alias("value"))
