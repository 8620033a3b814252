"""Worker results as a stream that keeps a task status table up to date.

Every batch writes only the tasks it has results for, as a version of its own. From time to time the versions
since the last are merged into a base; readers take the newest base and the versions after it. What a batch costs
thus depends on its results, not on the number of tasks or of batches before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes

VERSION = "version"
# Batches after which versions are merged into a base.
MERGE_EVERY = 16
SCHEMA = "ofid int, state int, seen bigint"


def _newest(results: DataFrame) -> DataFrame:
    """The result of each task with the highest order value (of equal ones the highest state)."""
    last = results.groupBy("ofid").agg(F.max(F.struct("seen", "state")).alias("last"))
    return last.select("ofid", "last.state", "last.seen")


def _versions(spark: SparkSession, path: str, base: int, stop: int) -> DataFrame:
    """Base ``base`` (none for -1) with the versions after it up to ``stop``; folders are named, not listed."""
    folders = [f"{path}/base/{VERSION}={base}"] if base >= 0 else []
    folders += [f"{path}/changes/{VERSION}={k}" for k in range(base + 1, stop + 1)]
    return spark.read.schema(SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], SCHEMA)


def _last_base(number: int) -> int:
    """The version of the base that is there when batch ``number`` is done."""
    return (number + 1) // MERGE_EVERY * MERGE_EVERY - 1


def latest_results(spark: SparkSession, path: str) -> DataFrame:
    """The result that counts of each task, ``ofid, state, seen``, after all batches so far."""
    log = spark.read.schema(f"{VERSION} int").parquet(f"{path}/log")
    number = log.agg(F.max(VERSION)).first()[0]
    return _newest(_versions(spark, path, _last_base(number), number))


def status_table(spark: SparkSession, path: str, tasks: DataFrame) -> DataFrame:
    """``tasks`` with the status that their results give them; tasks without one keep theirs. Adds ``seen``."""
    state = F.when(F.col("state") == 0, changes.DONE).otherwise(changes.FAILED)
    joined = tasks.join(latest_results(spark, path), "ofid", "left")
    return joined.select(
        *(c for c in tasks.columns if c != "status"),
        F.when(F.col("seen").isNotNull(), state).otherwise(F.col("status")).alias("status"), "seen",
    )


def start(results: DataFrame, path: str, checkpoint: str, order: str):
    """Start a stream that notes worker results ``(ofid, state, order)`` under ``path``.

    Batches are numbered without gaps and each replaces its own version, so a batch that is replayed after
    a failure leaves the same. Of a task's results that with the highest ``order`` counts, whenever it
    arrives: one that is late or comes twice changes nothing. Results without a task or an order are left out.
    """

    def note(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.select("ofid", "state", F.col(order).cast("bigint").alias("seen")).filter("ofid IS NOT NULL AND seen IS NOT NULL")

        def put(rows: DataFrame, folder: str) -> None:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{folder}/{VERSION}={number}")

        put(_newest(rows), "changes")
        base = _last_base(number)
        if base == number:
            put(_newest(_versions(spark, path, base - MERGE_EVERY, number)), "base")
        # The batch counts from here on.
        put(spark.range(1).select(F.lit(None).cast("int").alias("nothing")), "log")

    return (
        results.writeStream.foreachBatch(note)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
