"""Datasets, dates and regions a run reports as ``"ds,dt;ds,dt;…"`` texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import texts


def dataset_dates(runs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, ok, position, dsname, dates)``: datasets in first-seen order.

    Works inside each row's own text, without a shuffle. A run with a malformed pair
    gives one row with ``ok`` false.
    """
    pairs = F.transform(texts.nonempty_parts(text), lambda p: texts.split_parts(p, ","))
    parsed = runs.select(key, pairs.alias("pairs")).withColumn(
        "ok", F.forall("pairs", lambda p: F.size(p) == 2)
    )
    names = F.when(F.col("ok"), F.array_distinct(F.transform("pairs", lambda p: p[0])))
    dates = F.transform(
        F.filter("pairs", lambda p: p[0] == F.col("dsname")), lambda p: p[1].try_cast("bigint")
    )
    return parsed.select(key, "ok", "pairs", F.posexplode_outer(names).alias("position", "dsname")).select(
        key, "ok", "position", "dsname", F.when(F.col("ok"), dates).alias("dates")
    )


def region_list(runs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, roi_id)`` for each non-empty part of a region text."""
    return runs.select(key, F.explode(texts.nonempty_parts(text)).alias("roi_id"))
