"""Keyed change sets on table snapshots, dense ids and job registration rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import packed_time as pt
from ..functions import texts

UPSERT, DELETE = "upsert", "delete"
# Task states.
NOT_STARTED, RUNNING, DONE, FAILED = 0, 1, 2, 3


def last_per_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key; the rank limit also runs before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return rows.withColumn("rank_", F.row_number().over(newest)).filter("rank_ <= 1").drop("rank_")


def apply_changes(snapshot: DataFrame, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Snapshot after a change set ``(op, order, columns…)``; one pass for any number."""
    final = last_per_key(changes, keys, order)
    kept = snapshot.join(final.select(*keys), keys, "left_anti")
    return kept.unionByName(final.filter(F.col("op") == UPSERT).select(*snapshot.columns))


def update_columns(snapshot: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Snapshot with the columns of ``updates`` replaced where the key is present.

    Keys that are not in the snapshot change nothing, as in an UPDATE statement.
    """
    names = [c for c in updates.columns if c not in keys]
    marked = updates.select(*keys, F.struct(*names).alias("new_"))
    joined = snapshot.join(marked, keys, "left")
    values = [
        F.when(F.col("new_").isNotNull(), F.col("new_")[c]).otherwise(F.col(c)).alias(c) if c in names else F.col(c)
        for c in snapshot.columns
    ]
    return joined.select(*values)


def dense_ids(rows: DataFrame, key: str, start: Column | int, name: str) -> DataFrame:
    """Consecutive ids above ``start`` in the order (bucket of the key, key).

    Unique keys are spread over buckets by hash and numbered inside them; only one
    row per bucket, a fixed number, meets in the running total.
    """
    bucket = F.substring(F.md5(F.col(key).cast("string")), 1, 3)
    placed = rows.withColumn("bucket_", bucket)
    sizes = placed.groupBy("bucket_").agg(F.count(F.lit(1)).alias("size_"))
    before = Window.orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "bucket_", F.coalesce(F.sum("size_").over(before), F.lit(0)).alias("offset_")
    )
    inside = Window.partitionBy("bucket_").orderBy(key)
    start = F.lit(start) if isinstance(start, int) else start
    numbered = placed.withColumn("number_", F.row_number().over(inside)).join(offsets, "bucket_")
    return numbered.withColumn(name, start + F.col("offset_") + F.col("number_")).drop(
        "bucket_", "number_", "offset_"
    )


def append_with_ids(snapshot: DataFrame, rows: DataFrame, key: str, id_name: str) -> DataFrame:
    """New rows with ids following the snapshot's highest id."""
    top = snapshot.agg(F.coalesce(F.max(id_name), F.lit(0))).scalar()
    numbered = dense_ids(rows, key, top, id_name)
    return numbered.withColumn(id_name, F.col(id_name).cast(snapshot.schema[id_name].dataType))


def band_records(jobs: DataFrame, low: float = 0.0, high: float = 255.0) -> DataFrame:
    """Band rows ``(pid, bindex, info)`` for jobs with ``pid, hpid, bands, fill``."""
    position = F.col("bindex")
    info = F.struct(
        F.col("hpid").alias("hPid"), position.alias("bsqIndex"), texts.band_name(position).alias("bName"),
        F.lit(1).alias("scale"), F.lit(0).alias("offset"),
        F.lit(low).alias("validMin"), F.lit(high).alias("validMax"), F.col("fill").cast("double").alias("noData"),
    )
    return (
        jobs.filter(F.col("bands") > 0)
        .withColumn("bindex", F.explode(F.sequence(F.lit(0), F.col("bands") - 1)))
        .select("pid", "bindex", F.to_json(info).alias("info"))
    )


def data_items(jobs: DataFrame, stamp: Column) -> DataFrame:
    """Data item rows (without ids) for jobs with ``pid, hcol`` and an extent."""
    text = pt.stamp_text(stamp)
    return jobs.select(
        "pid", "hcol", F.col("left").alias("hleft"), F.col("right").alias("hright"),
        F.col("top").alias("htop"), F.col("bottom").alias("hbottom"),
        text.alias("createtime"), text.alias("updatetime"),
    )


def product_updates(jobs: DataFrame) -> DataFrame:
    """Name and info of output products for jobs with ``pid, proj, maxZoom, dataType, htable``."""
    # Output products have no time scale or style and 256-pixel tiles.
    info = F.struct(
        "proj", F.lit(0).alias("minZoom"), "maxZoom", "dataType", F.lit(0).alias("timeType"),
        F.col("htable").alias("hTableName"), F.lit(256).alias("tileWid"), F.lit(256).alias("tileHei"),
        F.lit("deflate").alias("compress"), F.lit(0).alias("styleid"),
    )
    return jobs.select("pid", texts.user_product_name("pid").alias("name"), F.to_json(info).alias("info"))


def task_updates(results: DataFrame, order: str, stamp: Column | None = None) -> DataFrame:
    """Status of each task after its last worker result."""
    last = results.groupBy("ofid").agg(F.max(F.struct(order, "state")).alias("last"))
    status = F.when(F.col("last.state") == 0, DONE).otherwise(FAILED)
    columns = [F.col("ofid"), status.alias("status")]
    if stamp is not None:
        columns.append(pt.stamp_text(stamp).alias("utime"))
    return last.select(*columns)
