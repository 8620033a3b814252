"""The tile cell store: Parquet in one folder per table, product plane and period, which is a date unless a store of
small tiles says otherwise. Planes of a store with very many of them share a fixed number of folders, so
that the number of folders does not grow with the planes.

Inside a folder tiles lie in the order of a space-filling curve, spread over files by ranges of it, so
neighbouring tiles share files and row groups. A small table beside the cells lists the dates of each
plane. Reads take a whole table of requests: folders are pruned by the dates it names, and cells that
nobody asked for are dropped before any block is shuffled. Writes are keyed upserts that read and replace only the
folders a change set touches.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import packed_time as pt
from ..functions.columns import idiv
from ..joins import broadcast_if_small, keep_wanted, never_broadcast, save
from ..operators.dates import first_dates

TILE = ["htable", "hpid", "z", "y", "x"]
CELL = [*TILE, "dt"]
PLANE = ["htable", "hpid"]
# What a folder holds, by the name of its column, and the unit of packed dates that counts it.
PERIODS = {"date": 1, "day": 1_000_000, "month": 100_000_000, "year": 10_000_000_000}
DATE = "date"
DATES_SCHEMA = "htable string, hpid int, dt bigint"


def schema_of(period: str = DATE, groups: int | None = None) -> str:
    group = "" if groups is None else f", {group_name(groups)} int"
    return f"htable string, hpid int, z int, y int, x int, dt bigint, code bigint, data binary{group}, {period} bigint"


def group_name(groups: int) -> str:
    """The column of a plane's group, which says how many groups share the planes of a table."""
    return f"group{groups}"


def period_of(cells: DataFrame) -> str | None:
    """The column of ``cells`` that names folders; none where cells do not come from a store."""
    return next((name for name in PERIODS if name in cells.columns), None)


def groups_of(cells: DataFrame) -> int | None:
    """How many groups share the planes of a store; none where each plane has folders of its own."""
    return next((int(name[5:]) for name in cells.columns if re.fullmatch(r"group[1-9]\d*", name)), None)


def _folders(period: str | None, groups: int | None) -> list[str]:
    """The columns that name folders."""
    planes = PLANE if groups is None else ["htable", group_name(groups)]
    return planes if period is None else [*planes, period]


def _with_folders(keys: DataFrame, period: str | None, groups: int | None) -> DataFrame:
    if period is not None:
        keys = keys.withColumn(period, idiv("dt", F.lit(PERIODS[period])))
    return keys if groups is None else keys.withColumn(group_name(groups), F.pmod("hpid", F.lit(groups)))


def curve_code(y: str, x: str) -> Column:
    """Place of a tile on the Z curve of its level: the bits of row and column in turn."""

    def spread(name: str) -> Column:
        bits = F.col(name).cast("bigint")
        # Each step halves the groups of bits that stand together.
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask))
        return bits

    return F.shiftleft(spread(y), 1).bitwiseOR(spread(x))


def read(spark: SparkSession, path: str, period: str = DATE, groups: int | None = None) -> DataFrame:
    """Stored cells; filters on table, plane (or its group) and period prune folders, on ``hpid, z, code, dt`` row groups."""
    return spark.read.schema(schema_of(period, groups)).parquet(path)


def dates(spark: SparkSession, path: str) -> DataFrame:
    """The dates of each stored plane, ``htable, hpid, dt``, without a look at the cells."""
    return spark.read.schema(DATES_SCHEMA).parquet(_dates_path(path)).distinct()


def _dates_path(path: str) -> str:
    # Folders that begin with an underscore are no part of the table beside them.
    return f"{path.rstrip('/')}/_dates"


def dated(cells: DataFrame, start: int, stop: int) -> DataFrame:
    """Cells of a date range, both ends inclusive; other dates' folders are not read."""
    inside, period = F.col("dt").between(start, stop), period_of(cells)
    if period is not None:
        inside = inside & F.col(period).between(start // PERIODS[period], stop // PERIODS[period])
    return cells.filter(inside)


def write(cells: DataFrame, path: str, keys: DataFrame | None = None, period: str = DATE, groups: int | None = None) -> None:
    """Write cells, replacing the folders they belong to.

    Their dates (or those of ``keys``, if only these are new) are listed first: a date that is listed and has
    no cell does no harm. Tasks get ranges of (folder, plane, level, curve), so a large folder is spread over several tasks and
    files, each a compact part of the map, and small folders share a task. With ``groups`` the planes of a table share
    so many folders for each period. Cells are saved first, as their dates, the ranges and the files each need them.
    """
    cells = save(cells.select(*CELL, curve_code("y", "x").alias("code"), "data"), "cells-written")
    note_dates(path, cells if keys is None else keys)
    folders = _folders(period, groups)
    order = list(dict.fromkeys([*folders, "hpid", "z", "code"]))
    (
        _with_folders(cells, period, groups)
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders).parquet(path)
    )


def note_dates(path: str, cells: DataFrame) -> None:
    """Add the dates of ``cells`` to the list of dates; dates that are listed already may come again."""
    cells.select(*PLANE, "dt").distinct().write.mode("append").parquet(_dates_path(path))


def upsert(
    spark: SparkSession, path: str, changes: DataFrame, order: str, period: str = DATE, groups: int | None = None
) -> None:
    """Last write wins per cell; ``order`` ranks writes to the same cell, of equal ones any stays.

    The last writes are found on keys alone, of changes that are saved first. Only the folders of dates that are written are
    read and replaced. Files are staged and swapped when the job commits, so a lost executor leaves the old folders as
    they were, and an upsert that is repeated gives the same store.
    """
    changes = save(changes.select(*CELL, order, "data"), "changes")
    last = changes.groupBy(*CELL).agg(F.max(order).alias(order))
    newest = changes.join(last, [*CELL, order], "left_semi").select(*CELL, "data").dropDuplicates(CELL)
    final = save(newest, "upsert")
    keys = save(final.select(*CELL), "upsert-keys")
    touched = _with_folders(keys, period, groups).select(*_folders(period, groups))
    kept = keep_wanted(read(spark, path, period, groups), touched, touched.columns, F.col(period) >= 0).select(*CELL, "data")
    kept = kept.join(broadcast_if_small(keys, saved=True), CELL, "left_anti")
    write(kept.unionByName(final), path, keys, period, groups)


def of_planes(cells: DataFrame, planes: DataFrame) -> DataFrame:
    """Cells of the planes, and of the dates where given, that a table names.

    A job names few planes of a large store. Their table is measured and broadcast, so
    other folders are not read and other cells are dropped before any shuffle.
    """
    names = [c for c in (*PLANE, "dt") if c in planes.columns]
    return _wanted(cells, planes.select(*names))


def request_dates(requests: DataFrame, listed: DataFrame) -> DataFrame:
    """Of the ``listed`` dates those that date-range requests reach: ``htable, hpid, dt``."""
    ranges = requests.select("htable", "hpid", "startdt", "stopdt").distinct()
    return listed.join(ranges, ["htable", "hpid"]).filter(F.col("dt").between(F.col("startdt"), F.col("stopdt"))).select(*PLANE, "dt").distinct()


def made_once(cells: DataFrame) -> DataFrame:
    """Cells that several steps read: those of a store as they are, others saved first, so that each is made once."""
    return cells if period_of(cells) is not None else save(cells.select(*CELL, "data"), "cells")


def listed_dates(cells: DataFrame) -> DataFrame:
    """The dates of each plane from the cells' key columns, where no list is kept."""
    return cells.select(*PLANE, "dt").distinct()


def _wanted(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """Cells whose key columns are among ``keys``, from the folders that these name."""
    period = period_of(cells) if "dt" in keys.columns else None
    keys = _with_folders(keys, period, groups_of(cells))
    # Folders are pruned at run time only by a side that carries a comparison; no packed date is negative.
    guard = F.col("dt") >= 0 if "dt" in keys.columns else F.col("hpid") > -(1 << 31)
    if period is not None:
        guard = guard & (F.col(period) >= 0)
    return keep_wanted(cells, keys, keys.columns, guard)


def at(cells: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests on a full cell key with their ``data``, NULL where there is none."""
    wanted = _wanted(cells, requests.select(*CELL)).select(*CELL, "data")
    return requests.join(never_broadcast(wanted), CELL, "left")


def between(
    cells: DataFrame, requests: DataFrame, keys: list[str], cap: int | None = None, listed: DataFrame | None = None
) -> DataFrame:
    """Cells of a tile over a date range and part filter, oldest first, at most ``cap`` of them where given.

    Ranges and parts are decided on the planes' ``listed`` dates (``dates``), so cells are met on their full
    keys only; a cap is applied to keys, before blocks are read.
    """
    names = ["month", "day", "hour", "minute", "second"]
    if listed is None:
        cells = made_once(cells)
        listed = listed_dates(cells)
    possible = requests.join(listed, ["htable", "hpid"]).filter(
        F.col("dt").between(F.col("startdt"), F.col("stopdt"))
        & pt.passes("dt", *(F.col(n) for n in names))
    ).select(*dict.fromkeys([*keys, *CELL]))
    if cap is not None:
        stored = _wanted(cells, possible.select(*CELL)).select(*CELL)
        possible = first_dates(possible.join(stored, CELL, "left_semi"), keys, cap)
    possible = save(possible, "possible")
    return possible.join(never_broadcast(_wanted(cells, possible.select(*CELL)).select(*CELL, "data")), CELL)
