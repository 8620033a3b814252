"""The tile job: orders to a computed, clipped and stored pyramid, with registration.

Everything an order needs (its planes, region, fill, output place) is resolved once per
order and travels with the tile keys, so the tile-level plan has two joins only: keys
with region tiles, before any payload is read, and keys with the stored cells. Pixels
are computed and clipped in one pass over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid, rowkey
from ..functions.pixel_types import bytes_per_pixel
from ..joins import never_broadcast
from ..operators import changes, extents, reading, regions
from ..operators.pixels import band_block, numpy_type
from ..operators.pyramid import enumerate_tiles
from ..sources import cells as store

TILE_KEY = ["order_id", "z", "y", "x"]
OUTPUT = ["out_htable", "mpid_hpid", "out_hcol", "out_hpidlen", "out_xylen"]
RESULT_SCHEMA = (
    "order_id bigint, z int, y int, x int, out_htable string, mpid_hpid int, out_hcol bigint, "
    "out_hpidlen int, out_xylen int, status int, log string, data binary"
)
# What is reported with each state.
MESSAGES = {
    extents.STATE_BAD_DRY_RUN: "the first tile could not be computed",
    extents.STATE_NO_DATASET: "at least one known dataset is needed",
    extents.STATE_PROJECTION: "datasets differ in projection",
    extents.STATE_BAD_REGION: "region has no data",
}


@dataclass
class JobInputs:
    """Tables a job reads.

    ``orders``: order_id, dt, roi, filldata, mpid_hpid, out_htable, out_hcol,
    out_hpidlen, out_xylen. ``inputs``: order_id, position, dsname, dt, bands; a NULL
    dt stands for the date of the order. ``script_regions`` (optional): order_id, roi_id.
    """

    orders: DataFrame
    inputs: DataFrame
    products: DataFrame
    bands: DataFrame
    items: DataFrame
    cells: DataFrame
    segments: DataFrame
    script_regions: DataFrame | None = None


def order_states(job: JobInputs, size: int = grid.TILE_SIZE) -> DataFrame:
    """State, deepest level, projection and extent of every order, before any tile."""
    orders = job.orders
    compat = extents.input_compatibility(job.inputs, job.products, ["order_id"])
    projection = job.inputs.join(
        job.products.select(F.col("name").alias("dsname"), "proj"), "dsname"
    ).groupBy("order_id").agg(F.min("proj").alias("proj"))
    wanted = orders.select("order_id", F.coalesce("roi", F.lit("")).alias("roi_id"))
    if job.script_regions is not None:
        wanted = wanted.unionByName(job.script_regions.select("order_id", "roi_id"))
    cut = extents.intersect(wanted, extents.segment_extents(job.segments, size), ["order_id"])
    grown = grid.expand_half_pixel("left", "right", "top", "bottom")
    # Orders without any region keep the world as it is.
    sides = {
        s: F.when(F.col("named") > 0, grown[s]).otherwise(F.col(s)) for s in grid.WORLD
    }
    cut = cut.select("order_id", "missing", *(c.alias(s) for s, c in sides.items()))
    state = (
        F.when(F.col("state").isNull(), extents.STATE_NO_DATASET)
        .when(F.col("state") != extents.STATE_OK, F.col("state"))
        .when(F.col("missing") > 0, extents.STATE_BAD_REGION)
        .otherwise(extents.STATE_OK)
    )
    return (
        orders.select("order_id").join(compat, "order_id", "left").join(projection, "order_id", "left")
        .join(cut, "order_id", "left")
        .select("order_id", state.alias("state"), "max_zoom", "proj", *grid.WORLD)
    )


def order_planes(job: JobInputs) -> DataFrame:
    """Stored planes each order reads, with the bands to take and where they go.

    The array holds what the order itself lists. Orders with an input that cannot be
    resolved have ``planes`` NULL.
    """
    dates = job.orders.select("order_id", F.col("dt").alias("order_dt"))
    inputs = job.inputs.join(dates, "order_id", "left").withColumn("dt", F.coalesce("dt", "order_dt")).drop("order_dt")
    planned = reading.plan_requests(inputs, job.products, job.bands, job.items)
    slots = planned.select(
        "order_id", "position", "pid", "hTableName", "dt", "user_file",
        (F.col("tileWid") * F.col("tileHei") * bytes_per_pixel("dataType")).alias("band_bytes"),
        F.posexplode("slots").alias("slot", "position_"),
    )
    places = reading.band_positions(job.bands).select("pid", F.col("position").alias("position_"), "hPid", "bsqIndex")
    located = slots.join(places, ["pid", "position_"], "left")
    located = located.filter(~F.col("user_file") | (F.col("slot") == 0))
    part = F.struct("position", "slot", F.col("bsqIndex").alias("bsq"))
    plane_key = ["hTableName", "hPid", "dt", "band_bytes", "user_file"]
    planes = located.groupBy("order_id", *plane_key).agg(F.array_sort(F.collect_list(part)).alias("parts"))
    lists = planes.groupBy("order_id").agg(
        F.collect_list(
            F.struct(
                F.col("hTableName").alias("htable"), F.col("hPid").alias("hpid"), "dt", "band_bytes", "user_file", "parts"
            )
        ).alias("planes")
    )
    broken = planned.groupBy("order_id").agg(F.bool_or(F.col("log").isNotNull()).alias("broken"))
    return broken.join(lists, "order_id", "left").select(
        "order_id", F.when(~F.col("broken"), F.col("planes")).alias("planes")
    )


def _stacked(joined: DataFrame, attributes: list[str]) -> DataFrame:
    """Wanted bands of each tile as one block; NULL when any plane is missing."""

    def sliced(part: Column) -> Column:
        block = F.when(F.col("user_file"), F.col("data"))
        start = part["bsq"] * F.col("band_bytes")
        enough = F.octet_length("data") >= start + F.col("band_bytes")
        return block.when(enough, F.substring(F.col("data"), (start + 1).cast("int"), F.col("band_bytes").cast("int")))

    def concatenated(blocks: Column) -> Column:
        # concat gives NULL for any NULL part, so one missing band leaves no block.
        return F.aggregate(blocks, F.lit(b""), lambda acc, block: F.concat(acc, block))

    # Most orders read one plane: their bands are joined inside the row, without a shuffle.
    single = joined.filter(F.col("planes_") == 1).select(
        *TILE_KEY, *attributes, concatenated(F.transform("parts", sliced)).alias("data")
    )
    several = joined.filter(F.col("planes_") > 1).select(
        *TILE_KEY, *attributes, "data", "user_file", "band_bytes", F.explode("parts").alias("part")
    )
    block = F.when(F.col("user_file"), F.col("data")).otherwise(
        band_block("data", "bsq", F.col("band_bytes"))
    )
    pieces = several.withColumn("bsq", F.col("part.bsq")).select(
        *TILE_KEY, *attributes, F.struct("part.position", "part.slot", block.alias("block")).alias("piece")
    )
    gathered = pieces.groupBy(*TILE_KEY).agg(
        *(F.first(a).alias(a) for a in attributes), F.array_sort(F.collect_list("piece")).alias("pieces")
    )
    merged = gathered.select(
        *TILE_KEY, *attributes, concatenated(F.transform("pieces", lambda p: p["block"])).alias("data")
    )
    return single.unionByName(merged)


def compute_tiles(
    job: JobInputs,
    ready: DataFrame,
    function: Callable[[np.ndarray], np.ndarray],
    size: int,
    type_code: int,
    out_type: int,
    level: int | None = None,
) -> DataFrame:
    """Result rows of all tiles of ready orders: status, log, block and output place.

    ``ready`` has the order columns, ``planes`` and an extent with ``zmin, zmax``. ``level`` is the only
    level that the extents reach, where there is only one.
    """
    tiles = enumerate_tiles(ready, ["order_id", "roi", "filldata", *OUTPUT, "planes"], size)
    # The deepest level each region is needed at, so that no others are built.
    depth = ready.filter(F.col("roi") != "").groupBy(F.col("roi").alias("roi_id")).agg(F.max("zmax").alias("depth"))
    region_tiles = regions.cover_tiles(job.segments.join(depth, "roi_id"), F.lit(0), "depth", size).withColumnRenamed("roi_id", "roi")
    placed = never_broadcast(tiles).join(region_tiles, ["roi", "z", "y", "x"], "left")
    attributes = ["roi", "filldata", *OUTPUT, "segments", "covered"]
    requests = placed.select(
        *TILE_KEY, *attributes, F.size("planes").alias("planes_"), F.explode("planes").alias("plane")
    ).select(*TILE_KEY, *attributes, "planes_", "plane.*")
    # Cells that no tile of any order needs are dropped where they are read; the first tiles need those of level 0 only.
    joined = store.at(job.cells if level is None else job.cells.filter(F.col("z") == level), never_broadcast(requests))
    source, target = numpy_type(type_code), numpy_type(out_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = regions.MaskCache(size, size)
        for batch in batches:
            status, log, data = [], [], []
            for i in range(batch.num_rows):
                cell, roi = batch.column("data")[i], batch.column("roi")[i].as_py()
                block, problem = None, None
                if not cell.is_valid:
                    problem = reading.NO_CELL
                else:
                    try:
                        tile = np.frombuffer(cell.as_buffer(), source).reshape(-1, size, size)
                        result = np.asarray(function(tile)).astype(target)
                        if roi:
                            place = (roi, *(batch.column(c)[i].as_py() for c in ("z", "y", "x")))
                            mask = masks.get(place, batch.column("segments")[i], batch.column("covered")[i])
                            fill = np.array(batch.column("filldata")[i].as_py()).astype(target)
                            result = np.where(mask, result, fill)
                        block = np.ascontiguousarray(result, dtype=target).tobytes()
                    except Exception as error:  # a bad tile is counted, the job goes on
                        problem = f"{type(error).__name__}: {error}"
                status.append(0 if problem is None else 1)
                log.append(problem or "")
                data.append(block)
            columns = [batch.column(c) for c in [*TILE_KEY, *OUTPUT]]
            columns += [pa.array(status, pa.int32()), pa.array(log, pa.string()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*TILE_KEY, *OUTPUT, "status", "log", "data"])

    return _stacked(joined, attributes).mapInArrow(run, RESULT_SCHEMA)


def with_row_keys(results: DataFrame) -> DataFrame:
    """Result rows with the binary row key of their output place."""
    key = rowkey.encode("mpid_hpid", "z", "y", "x", F.col("out_hpidlen"), F.col("out_xylen"))
    return results.withColumn("rowkey", key)


def run_jobs(
    spark: SparkSession,
    job: JobInputs,
    function: Callable[[np.ndarray], np.ndarray],
    store_path: str,
    scratch: str,
    size: int = grid.TILE_SIZE,
    type_code: int = 1,
    out_type: int | None = None,
    period: str = store.DATE,
    groups: int | None = None,
) -> DataFrame:
    """Run all orders and store their tiles; one row per order with state and counts.

    ``period`` is what a folder of the store holds, of a plane or of one of ``groups`` of planes.

    The first tile of each order is computed alone; orders whose first tile fails stop
    there. Results are written to ``scratch``, the shared folder, before they are merged
    into the store, so neither step is repeated when executors are lost.
    """
    out_type = out_type or type_code
    # Resolved orders are written once: both runs over tiles and the final report start
    # from this small table instead of repeating the catalog joins.
    (
        order_states(job, size).join(order_planes(job), "order_id", "left")
        .write.mode("overwrite").parquet(f"{scratch}/orders")
    )
    states = spark.read.parquet(f"{scratch}/orders")
    resolved = (
        states.filter((F.col("state") == extents.STATE_OK) & F.col("planes").isNotNull())
        .join(job.orders.withColumn("roi", F.coalesce("roi", F.lit(""))), "order_id")
        .withColumns({"zmin": F.lit(0), "zmax": F.col("max_zoom")})
    )
    first = resolved.withColumn("zmax", F.lit(0))
    compute_tiles(job, first, function, size, type_code, out_type, level=0).select(
        "order_id", "status"
    ).write.mode("overwrite").parquet(f"{scratch}/first")
    passed = spark.read.parquet(f"{scratch}/first").filter("status = 0").select("order_id").distinct()
    ready = resolved.join(passed, "order_id", "left_semi")
    compute_tiles(job, ready, function, size, type_code, out_type).write.mode("overwrite").parquet(f"{scratch}/tiles")
    results = spark.read.schema(RESULT_SCHEMA).parquet(f"{scratch}/tiles")
    good = results.filter("status = 0").select(
        F.col("out_htable").alias("htable"), F.col("mpid_hpid").alias("hpid"), "z", "y", "x",
        F.col("out_hcol").alias("dt"), "data", "order_id",
    )
    store.upsert(spark, store_path, good, "order_id", period, groups)
    counts = results.groupBy("order_id").agg(
        F.count_if(F.col("status") == 0).alias("good"), F.count_if(F.col("status") != 0).alias("bad")
    )
    started = passed.withColumn("started", F.lit(True))
    final = states.join(started, "order_id", "left").join(counts, "order_id", "left")
    state = F.when(
        (F.col("state") == extents.STATE_OK) & F.col("started").isNull(), extents.STATE_BAD_DRY_RUN
    ).otherwise(F.col("state"))
    good_count, bad_count = F.coalesce("good", F.lit(0)), F.coalesce("bad", F.lit(0))
    message = F.concat(
        F.lit("success done, good:"), good_count.cast("string"), F.lit(", bad:"), bad_count.cast("string")
    )
    final = final.withColumn("state", state)
    for code, text in MESSAGES.items():
        message = F.when(F.col("state") == code, F.lit(text)).otherwise(message)
    return final.select(
        "order_id", "state", message.alias("message"), good_count.alias("good"), bad_count.alias("bad"),
        "max_zoom", "proj", *grid.WORLD,
    )


def registrations(outcome: DataFrame, job: JobInputs, out_bands: int, out_type: int, stamp: Column) -> dict[str, DataFrame]:
    """Band, data item and product rows of the orders that succeeded."""
    done = outcome.filter(F.col("state") == extents.STATE_OK).join(job.orders, "order_id").select(
        F.col("mpid_hpid").alias("pid"), F.col("mpid_hpid").alias("hpid"), F.lit(out_bands).alias("bands"),
        F.col("filldata").alias("fill"), F.col("out_hcol").alias("hcol"), *grid.WORLD,
        "proj", F.col("max_zoom").alias("maxZoom"), F.lit(out_type).alias("dataType"),
        F.col("out_htable").alias("htable"),
    )
    return {
        "bands": changes.band_records(done),
        "items": changes.data_items(done, stamp),
        "products": changes.product_updates(done),
    }
