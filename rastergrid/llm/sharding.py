"""Global shuffle into shards, in two passes over memory-sized buckets.

Pass one scatters rows over buckets by a seeded hash, so every bucket is a uniform sample that fits
in the memory of a task. Pass two shuffles each bucket (Fisher-Yates) and lays the buckets end to
end; shard ``s`` of ``n`` takes the rows from ``s/n`` to ``(s+1)/n`` of that order (law ``rows``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save

# A bucket holds at most BUCKET_BYTES; up to LEAST_BUCKETS they are smaller, so that tasks stay short.
BUCKET_BYTES = 128 << 20
SMALL_BYTES = 4 << 20
LEAST_BUCKETS = 4096
SHARDS = 16
SEED = 20240501


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A uniform permutation of 0..n-1: swap each place, from the last, with one at or before it."""
    order = np.arange(n)
    picks = (np.random.default_rng(seed).random(n) * np.arange(1, n + 1)).astype(np.int64)
    for last in range(n - 1, 0, -1):
        pick = picks[last]
        order[last], order[pick] = order[pick], order[last]
    return order


def _shuffle_bucket(rows: pd.DataFrame, seed: int) -> pd.DataFrame:
    # The order in which rows arrive differs between runs, so it is fixed before it is shuffled.
    rows = rows.sort_values(["__key", "__tie"], kind="stable", na_position="last").reset_index(drop=True)
    rows["__place"] = fisher_yates(len(rows), seed + int(rows["__bucket"].iloc[0]))
    return rows


def shuffle_into_shards(
    rows: DataFrame, id_col: str, size_col: str, shards: int = SHARDS, seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """The rows with ``shard`` and ``slot``, gapless from 0 in each shard; shard counts differ by one at most.

    ``size_col`` has the bytes of a row, for the number of buckets. Rows that repeat entirely are rows of
    their own; rows with the same id are told apart by their content. A null id is an id like another.
    An empty table gives an empty result.
    """
    total = int(rows.agg(F.sum(size_col)).first()[0] or 0)
    buckets = max(1, -(-total // bucket_bytes), min(LEAST_BUCKETS, -(-total // SMALL_BYTES)))
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    spread = F.xxhash64(F.lit(seed), F.col(id_col), tie)
    scattered = rows.withColumns(
        {"__key": F.col(id_col), "__tie": tie, "__bucket": F.pmod(spread, F.lit(buckets)).cast("int")}
    )
    schema = scattered.withColumn("__place", F.lit(0).cast("bigint")).schema
    shuffled = save(
        scattered.groupBy("__bucket").applyInPandas(lambda part: _shuffle_bucket(part, seed), schema), "shards"
    )
    counts = shuffled.groupBy("__bucket").agg(F.count("*").alias("__n"))
    # One row per bucket of BUCKET_BYTES, a few bytes each.
    starts = counts.select(
        "__bucket",
        (F.sum("__n").over(Window.orderBy("__bucket")) - F.col("__n")).alias("__start"),
        F.sum("__n").over(Window.partitionBy()).alias("__total"),
    )
    place = F.col("__start") + F.col("__place")
    placed = shuffled.join(starts, "__bucket").withColumn("__at", place)
    placed = placed.withColumn("shard", F.expr(f"(__at * {shards}) div __total").cast("int"))
    placed = placed.withColumn("slot", F.col("__at") - F.expr(f"(shard * __total + {shards - 1}) div {shards}"))
    return placed.drop("__bucket", "__key", "__tie", "__place", "__start", "__total", "__at")


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1 << 20) -> None:
    """Write whole records as Parquet, a folder per shard, each file a run of slots in order."""
    piece = F.floor(F.col("slot") / rows_per_file)
    (
        sharded.withColumn("__piece", piece)
        .repartition("shard", "__piece").sortWithinPartitions("shard", "slot").drop("__piece")
        .write.partitionBy("shard").mode("overwrite").parquet(path)
    )
