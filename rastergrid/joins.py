"""Join sides whose size the planner cannot know.

Sizes behind an explode or an Arrow function are guesses, usually far too low, and a
payload side taken for small would be broadcast. Such sides are either kept out of
broadcasts (``never_broadcast``) or measured first (``broadcast_if_small``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .session import shared_folder

BROADCAST_BYTES = 64 << 20
# Bits of the marks of a larger set of keys: 16 MiB whatever the number of keys.
MARK_BITS = 1 << 27


def save(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, and safe from lost executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def never_broadcast(df: DataFrame) -> DataFrame:
    """Sort-merge join, which spills and whose hot keys are split at run time."""
    return df.hint("merge")


def _bytes(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        element = kind.elementType
        fields = len(element.fields) if isinstance(element, T.StructType) else 1
        return F.greatest(F.size(name), F.lit(0)) * (8 * fields + 16) + 16
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """Size of a table in memory, counted by a job over it."""
    row = sum((_bytes(f.name, f.dataType) for f in df.schema.fields), F.lit(16))
    return int(df.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0))).first()[0])


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES, saved: bool = False) -> DataFrame:
    """Broadcast a table that was measured to fit, else keep it out of broadcasts.

    The table is saved first (unless it is ``saved`` already), so it is computed once.
    """
    df = df if saved else save(df, "side")
    return F.broadcast(df) if measured_bytes(df) <= limit else never_broadcast(df)


def keep_wanted(rows: DataFrame, wanted: DataFrame, on: list[str], guard: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` whose key is among ``wanted``, without a shuffle of ``rows``.

    Few keys are broadcast themselves, and folders of ``rows`` that have none are not read; ``guard`` is
    a comparison that holds for all of them. Of more keys a bitmap of their hashes is broadcast, which
    may keep some rows that are not wanted: an exact join has to follow.
    """
    keys = save(wanted.select(*on).distinct(), "wanted")
    if measured_bytes(keys) <= limit:
        return rows.join(F.broadcast(keys.filter(guard)), on, "left_semi")
    place = f"(pmod(xxhash64({', '.join(on)}), {MARK_BITS}L) + 1)"
    marks = keys.groupBy(F.expr(f"bitmap_bucket_number({place})").alias("bucket_")).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position({place}))").alias("bits_")
    )
    bit = F.expr(f"bitmap_bit_position({place})")
    byte = F.conv(F.hex(F.substring("bits_", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    placed = rows.withColumn("bucket_", F.expr(f"bitmap_bucket_number({place})"))
    # At most MARK_BITS / 32768 rows of 4 KiB.
    return placed.join(F.broadcast(marks), "bucket_").filter(F.getbit(byte, (bit % 8).cast("int")) == 1).drop("bucket_", "bits_")
