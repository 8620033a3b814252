"""Extents of regions and the common frame of a job's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import grid

# States a job reports.
STATE_OK = 0
STATE_STARTED = 1
STATE_BAD_DRY_RUN = 20
STATE_NO_DATASET = 21
STATE_PROJECTION = 22
STATE_BAD_REGION = 23


def segment_extents(segments: DataFrame, size: int = grid.TILE_SIZE) -> DataFrame:
    """Degrees covered by each region's row segments, at the level they are given in."""
    degrees = grid.resolution("level", size)
    corners = segments.groupBy("roi_id", "level").agg(
        F.min("x0").alias("x0"), F.max("x1").alias("x1"),
        F.min("grow").alias("r0"), F.max("grow").alias("r1"),
    )
    return corners.select(
        "roi_id",
        (F.col("x0") * degrees - 180.0).alias("left"),
        ((F.col("x1") + 1) * degrees - 180.0).alias("right"),
        (F.lit(90.0) - F.col("r0") * degrees).alias("top"),
        (F.lit(90.0) - (F.col("r1") + 1) * degrees).alias("bottom"),
    )


def intersect(wanted: DataFrame, extents: DataFrame, keys: list[str]) -> DataFrame:
    """Common extent of each key's regions, inside the world.

    ``wanted`` has ``keys…, roi_id``; empty region texts are skipped, so a key with
    only those keeps the world. ``named`` counts the others and ``missing`` those of
    them without an extent.
    """
    named = F.col("roi_id") != ""
    joined = wanted.join(extents, "roi_id", "left")
    world = {side: F.lit(edge) for side, edge in grid.WORLD.items()}
    return joined.groupBy(*keys).agg(
        F.greatest(world["left"], F.max("left")).alias("left"),
        F.least(world["right"], F.min("right")).alias("right"),
        F.least(world["top"], F.min("top")).alias("top"),
        F.greatest(world["bottom"], F.max("bottom")).alias("bottom"),
        F.count_if(named).alias("named"),
        F.count_if(named & F.col("left").isNull()).alias("missing"),
    )


def input_compatibility(inputs: DataFrame, products: DataFrame, keys: list[str]) -> DataFrame:
    """Per job: number of projections, deepest common level and resulting state.

    ``inputs`` has ``keys…, dsname``. Projections are compared by value.
    """
    known = inputs.join(
        products.select(F.col("name").alias("dsname"), "pid", "proj", "maxZoom"), "dsname", "left"
    )
    return known.groupBy(*keys).agg(
        F.count_distinct("proj").alias("projections"),
        F.min("maxZoom").alias("max_zoom"),
        F.when(F.count("pid") < F.count(F.lit(1)), STATE_NO_DATASET)
        .when(F.count_distinct("proj") > 1, STATE_PROJECTION)
        .otherwise(STATE_OK)
        .alias("state"),
    )
