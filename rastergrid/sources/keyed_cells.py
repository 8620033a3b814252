"""Generic binary cells keyed by table, family, qualifier and row key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rowkey, texts
from ..operators.changes import last_per_key
from . import tile_files

KEY = ["tbl", "fam", "qual", "rowkey"]
SCHEMA = "tbl string, fam string, qual binary, rowkey binary, data binary"
# Where region masks are kept.
REGION_TABLES = {"sys": "sys_roi", "user": "user_roi"}
REGION_FAMILY = "hseg.tlv"
REGION_QUALIFIER = 1


def put(snapshot: DataFrame, puts: DataFrame, order: str) -> DataFrame:
    """Snapshot after a table of writes; the last write of a key wins."""
    final = last_per_key(puts, KEY, order).select(*snapshot.columns)
    return snapshot.join(final.select(*KEY), KEY, "left_anti").unionByName(final)


def get(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """Keys with their ``data``, NULL where there is none."""
    return keys.join(cells, KEY, "left")


def region_stores(cells: DataFrame) -> DataFrame:
    """Region masks of both stores as ``(prefix, rid, data)``."""
    prefix = F.lit(None).cast("string")
    for name, table in REGION_TABLES.items():
        prefix = F.when(F.col("tbl") == table, name).otherwise(prefix)
    return cells.filter(
        F.col("tbl").isin(*REGION_TABLES.values()) & (F.col("fam") == REGION_FAMILY)
        & (F.col("qual") == rowkey.big_endian(REGION_QUALIFIER, 4))
    ).select(prefix.alias("prefix"), rowkey.signed_int(F.col("rowkey"), 1, 4).alias("rid"), "data")


def region_cells(masks: DataFrame) -> DataFrame:
    """Region masks ``(prefix, rid, data)`` as cells to put."""
    table = F.lit(None).cast("string")
    for name, stored in REGION_TABLES.items():
        table = F.when(F.col("prefix") == name, stored).otherwise(table)
    return masks.select(
        table.alias("tbl"), F.lit(REGION_FAMILY).alias("fam"),
        rowkey.big_endian(REGION_QUALIFIER, 4).alias("qual"),
        rowkey.big_endian("rid", 4).alias("rowkey"), "data",
    )


def region_files(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """The region files that texts in column ``roi`` name by path below the root: ``path, data``.

    Texts of the two region tables (``sys:n``, ``user:n``) name no file; only files that are named are opened.
    """
    named = wanted.filter(texts.region_route("roi") == "file").select(F.col("roi").alias("path")).distinct()
    return tile_files.open_paths(spark, root, named)
