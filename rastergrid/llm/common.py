"""Helpers the operators share: plain rows, saved tables, marks of repeated keys, connected groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastergrid.session import shared_folder

# A mark table has one bit per hash value: 2 MiB whatever the size of the input.
MARK_BITS = 1 << 24


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def save(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: a cut of the lineage that survives lost executors."""
    spark = session_of(df)
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plain(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` only, null texts as empty; other columns cannot clash afterwards."""
    return docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def portions(batches, rows: int = 1024):
    """Arrow batches cut to so many rows, so that what Python makes of one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def mark_table(keys: DataFrame, key: str) -> DataFrame:
    """The hash bits of the given long keys, one row of 4 KiB for each 32,768 bits that has any.

    A key that was given always has its bit set; another may share it. At most
    ``MARK_BITS / 32768`` rows, so it may be broadcast at any input size.
    """
    return keys.groupBy(F.expr(f"bitmap_bucket_number({_hash(key)})").alias("__bucket")).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position({_hash(key)}))").alias("__bits")
    )


def _hash(key: str) -> str:
    return f"pmod(xxhash64(`{key}`), {MARK_BITS}L)"


def with_mark(df: DataFrame, key: str, marks: DataFrame, name: str) -> DataFrame:
    """Add a boolean: may the row's key be one of those in ``marks``? (False is certain.)"""
    position = F.expr(f"bitmap_bit_position({_hash(key)})")
    byte = F.conv(F.hex(F.substring("__bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (position % 8).cast("int")) == 1
    with_bits = df.withColumn("__bucket", F.expr(f"bitmap_bucket_number({_hash(key)})")).join(
        F.broadcast(marks), "__bucket", "left"
    )
    return with_bits.withColumn(name, F.coalesce(is_set, F.lit(False))).drop("__bucket", "__bits")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node that each node of the undirected edges can reach.

    Every round takes the smallest label around a node and then the label of that label, so paths
    halve; labels only fall, and their sum tells when nothing changed. Each round is saved.
    """
    both = save(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .union(edges.select(F.col(b).alias("u"), F.col(a).alias("v")))
        .where("u <> v"),
        "edges",
    )
    labels = save(both.groupBy("u").agg(F.least("u", F.min("v")).alias("label")), "labels")
    total = None
    while True:
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels.select(F.col("u").alias("node"), "label")
        total = now
        near = (
            both.join(labels.select(F.col("u").alias("v"), "label"), "v")
            .groupBy("u").agg(F.min("label").alias("near"))
        )
        better = labels.join(near, "u").select("u", F.least("label", "near").alias("label"))
        better = save(better, "labels")
        jump = better.select(F.col("u").alias("label"), F.col("label").alias("next"))
        labels = save(better.join(jump, "label").select("u", F.col("next").alias("label")), "labels")
