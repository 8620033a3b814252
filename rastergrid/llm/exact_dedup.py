"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Each level looks only at rows whose group at the level before has more than one row. Which groups
those are is passed on as a mark table of fixed size, so texts are never shuffled: a row whose mark
is clear is certainly alone, a row that shares a mark by chance is told apart by the next level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mark_table, save, with_mark

PREFIX_CHARS = 256


def exact_dedup(docs: DataFrame, carry: dict[str, Column] | None = None, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept and the carried columns.

    Texts are equal when they are identical. The row with the largest doc_id of a group stays; where
    rows of a group share that id too, exactly one of them. Null ids come last: they stay only where
    a group has no other id. Empty texts are equal to each other; an empty table gives an empty result.
    ``carry`` names further columns, computed from ``docs`` in the last scan.
    """
    carry = carry or {}
    sized = docs.withColumn("__size", F.octet_length("text").cast("bigint"))
    sizes = sized.groupBy("__size").count().where("count > 1")
    sized = with_mark(sized, "__size", save(mark_table(sizes, "__size"), "dedup-sizes"), "__again")
    # Rows of a size of their own have no prefix hash.
    started = sized.withColumn(
        "__prefix", F.when(F.col("__again"), F.xxhash64("__size", F.substring("text", 1, prefix_chars)))
    )
    prefixes = started.where("__prefix is not null").groupBy("__prefix").count().where("count > 1")
    started = with_mark(started, "__prefix", save(mark_table(prefixes, "__prefix"), "dedup-prefixes"), "__same")
    rows = save(
        started.select(
            "doc_id",
            F.when(F.col("__again") & F.col("__same"), F.sha2("text", 256)).alias("__full"),
            *[column.alias(name) for name, column in carry.items()],
        ),
        "dedup-rows",
    )
    groups = save(
        rows.where("__full is not null").groupBy("__full", "doc_id").agg(F.count("*").alias("__n"))
        .groupBy("__full").agg(
            F.sum("__n").alias("group_size"), F.max("doc_id").alias("keep_id"),
            F.max_by("__n", F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("__rows"),
        ).where("group_size > 1"),
        "dedup-groups",
    )
    more = list(carry)
    single = F.lit(1).cast("bigint").alias("group_size")
    hashed = rows.where("__full is not null").join(groups, "__full", "left")
    found = hashed.select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"), "__full", "__rows", *more,
    )
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    if groups.where("__rows > 1").isEmpty():
        decided = found.withColumn("kept", stays)
    else:
        # Rows repeated with their id: number those that could stay.
        repeated = stays & (F.coalesce("__rows", F.lit(1)) > 1)
        first = F.row_number().over(Window.partitionBy("__full", "doc_id").orderBy(F.lit(1))) == 1
        decided = found.where(~repeated).withColumn("kept", stays).unionByName(
            found.where(repeated).withColumn("kept", first)
        )
    alone = rows.where("__full is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), single, F.lit(True).alias("kept"), *more
    )
    return decided.select("doc_id", "keep_id", "group_size", "kept", *more).unionByName(alone)
