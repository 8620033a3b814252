"""Dataset reads: product names, bands and dates to band-sequential tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import texts
from ..functions.pixel_types import bytes_per_pixel
from ..joins import never_broadcast, save
from ..sources import cells as store
from .catalog import by_name
from .pixels import band_block, stack_bands

NO_PRODUCT = "no such product"
NO_BAND = "band index out of range"
NO_LIST = "no band list"
NO_CELL = "no cell data"
NO_ITEM = "no data item"
NO_SOURCE = "source is not supported"
# Where a product's tiles are kept.
TABLE_SOURCE, FILE_SOURCE = "hbase", "file"


def band_positions(bands: DataFrame) -> DataFrame:
    """Bands with their position in the product: 0, 1, … in the order of ``bindex``, whatever its values."""
    order = Window.partitionBy("pid").orderBy("bindex")
    return bands.withColumn("position", F.row_number().over(order) - 1)


def plan_requests(
    requests: DataFrame, products: DataFrame, bands: DataFrame, items: DataFrame | None, series: bool = False
) -> DataFrame:
    """Requests with product, effective date and one array entry per wanted band, by position.

    Names that begin with a slash are user files: their only item's date is used and
    all bands are read. A series treats all names alike and needs a band list. The request's list
    bounds the arrays; nothing is exploded here.
    """
    requests = requests.withColumn("bands", F.coalesce("bands", F.array().cast("array<int>")))
    known = by_name(
        requests, products.select("pid", "name", "hTableName", "tileWid", "tileHei", "dataType", "source")
    )
    counts = bands.groupBy("pid").agg(F.count(F.lit(1)).cast("int").alias("nbands"))
    user_file = F.lit(False) if series else texts.is_user_file("dsname")
    planned = known.join(counts, "pid", "left").withColumn("user_file", user_file)
    if items is not None:
        first = items.groupBy("pid").agg(F.min("hcol").alias("first_hcol"))
        planned = planned.join(first, "pid", "left")
        planned = planned.withColumn("dt", F.when(F.col("user_file"), F.col("first_hcol")).otherwise(F.col("dt")))
    everything = F.sequence(F.lit(0), F.col("nbands") - 1)
    asked = F.when((F.size("bands") == 0) | F.col("user_file"), everything).otherwise(F.col("bands"))
    in_range = F.forall("bands", lambda b: (b >= 0) & (b < F.col("nbands")))
    problem = F.when(F.col("pid").isNull(), NO_PRODUCT)
    if series:
        problem = problem.when(F.size("bands") == 0, NO_LIST)
    problem = problem.when(F.col("nbands").isNull() | ~F.coalesce(in_range, F.lit(False)), NO_BAND)
    if not series:
        problem = problem.when(F.col("dt").isNull(), NO_ITEM)
    problem = problem.when(~F.col("source").isin(TABLE_SOURCE, FILE_SOURCE), NO_SOURCE)
    return planned.withColumn("log", problem).withColumn("slots", F.when(F.col("log").isNull(), asked))


def _plane_reads(planned: DataFrame, bands: DataFrame, keys: list[str]) -> DataFrame:
    """One row per request and stored plane with the bands to take from it."""
    wanted = planned.select(
        *keys, "pid", "hTableName", "tileWid", "tileHei", "dataType", "user_file", "source",
        F.posexplode("slots").alias("slot", "position"),
    )
    # A left join can only broadcast the band table, never the expanded requests.
    places = band_positions(bands).select("pid", "position", "hPid", "bsqIndex")
    located = wanted.join(places, ["pid", "position"], "left")
    # A user file is one block: everything comes from the first band's plane.
    located = located.filter(~F.col("user_file") | (F.col("slot") == 0))
    return located.groupBy(
        *keys, F.col("hTableName").alias("htable"), F.col("hPid").alias("hpid"), "tileWid", "tileHei", "dataType", "user_file", "source"
    ).agg(F.collect_list(F.struct("slot", F.col("bsqIndex").alias("bsq"))).alias("parts"))


def _by_source(reads: DataFrame, cells: DataFrame, files: DataFrame | None, read) -> DataFrame:
    """Read each request from the store of its product; one store serves both if alone."""
    if files is None:
        return read(cells, reads)
    # User files are always in the table store.
    in_files = (F.col("source") == FILE_SOURCE) & ~F.col("user_file")
    return read(cells, reads.filter(~in_files)).unionByName(read(files, reads.filter(in_files)))


def _sliced(read: DataFrame, keys: list[str]) -> DataFrame:
    """Single-band blocks ``(keys…, slot, data)`` out of plane reads."""
    size = F.col("tileWid") * F.col("tileHei") * bytes_per_pixel("dataType")
    parts = read.select(
        *keys, "data", "user_file", size.alias("band_bytes"), F.explode("parts").alias("part")
    ).select(*keys, "data", "user_file", "band_bytes", "part.slot", "part.bsq")
    block = F.when(F.col("user_file"), F.col("data")).otherwise(band_block("data", "bsq", F.col("band_bytes")))
    return parts.select(*keys, "slot", block.alias("data"))


def dataset_tiles(
    requests: DataFrame,
    products: DataFrame,
    bands: DataFrame,
    items: DataFrame,
    cells: DataFrame,
    key: str = "request_id",
    files: DataFrame | None = None,
) -> DataFrame:
    """One tile per request ``(key, dsname, dt, bands, z, y, x)``.

    An empty band list takes all bands; an index out of range fails the whole read.
    Result: ``key, status, log, nbands, data`` with status 0 for a good read.
    """
    planned = plan_requests(requests, products, bands, items)
    keys = [key, "z", "y", "x", "dt"]
    reads = _plane_reads(planned, bands, keys)
    stacked = stack_bands(_sliced(_by_source(reads, cells, files, store.at), keys), [key])
    result = planned.select(key, "log", F.size("slots").alias("nbands")).join(stacked, key, "left")
    log = F.coalesce("log", F.when(~F.coalesce("complete", F.lit(False)), NO_CELL), F.lit(""))
    status = F.when(log == "", 0).otherwise(1)
    return result.select(key, status.alias("status"), log.alias("log"), "nbands", "data")


def dataset_series(
    requests: DataFrame,
    products: DataFrame,
    bands: DataFrame,
    cells: DataFrame,
    key: str = "request_id",
    cap: int | None = None,
    files: DataFrame | None = None,
    listed: DataFrame | None = None,
) -> DataFrame:
    """All dates of a range as tiles: ``key, dt, status, log, data``; a request that fails has one row without a date.

    Bands are matched by date; a date that one plane lacks has status 1 and no block. Band lists must
    name bands by position, names with a slash are read like others, and the part filters are
    ``month … second`` with -1 for any. ``cap`` limits the dates of the table store, ``listed`` is its
    list of dates where it keeps one.
    """
    filters = ["startdt", "stopdt", "month", "day", "hour", "minute", "second"]
    known = requests.withColumn("dt", F.lit(0).cast("bigint"))
    planned = save(
        plan_requests(known, products, bands, None, series=True).select(
            key, "z", "y", "x", "pid", "hTableName", "tileWid", "tileHei", "dataType", "user_file", "source", "log", "slots", *filters
        ),
        "series-requests",
    )
    keys = [key, "z", "y", "x"]
    reads = _plane_reads(planned, bands, keys)
    asked = reads.join(planned.select(key, *filters), key)

    def read(source: DataFrame, rows: DataFrame) -> DataFrame:
        # Only the table store limits the number of dates, and only it keeps a list of them.
        in_files = source is files
        return store.between(source, rows, [key, "htable", "hpid"], None if in_files else cap, None if in_files else listed)

    found = _by_source(asked, cells, files, read)
    dated = never_broadcast(found.select(key, "htable", "hpid", "dt", "data")).join(
        reads, [key, "htable", "hpid"]
    )
    sliced = _sliced(dated, [key, "dt"])
    slots = planned.select(key, F.size("slots").alias("wanted"))
    counted = stack_bands(sliced, [key, "dt"]).join(
        sliced.groupBy(key, "dt").agg(F.count(F.lit(1)).alias("got")), [key, "dt"]
    ).join(slots, key)
    complete = F.col("complete") & (F.col("got") == F.col("wanted"))
    good = counted.select(
        key, "dt", F.when(complete, 0).otherwise(1).alias("status"),
        F.when(complete, "").otherwise(NO_CELL).alias("log"), F.when(complete, F.col("data")).alias("data"),
    )
    # Requests that cannot be read, and those that have no date at all.
    failed = planned.filter(F.col("log").isNotNull()).select(key, "log")
    dateless = planned.filter(F.col("log").isNull()).join(found.select(key).distinct(), key, "left_anti").select(key, F.lit(NO_CELL).alias("log"))
    missing = failed.unionByName(dateless).select(
        key, F.lit(None).cast("bigint").alias("dt"), F.lit(1).alias("status"), "log", F.lit(None).cast("binary").alias("data")
    )
    return good.unionByName(missing)
