"""A corpus pipeline over ``documents``: stages that call the operators of ``rastergrid.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next stage's ``docs``. In all stages a null text is an empty one, a null id or source is a value like
another, texts of any length are read whole, columns besides doc_id, source and text pass through whatever
their names (but for the three results of the last stage, which replace columns of their names), and an
empty table gives an empty one. Of rows with equal id and text the two dedup stages keep one; the other
stages treat them as rows of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from rastergrid.llm import exact_dedup, mixing, near_dedup, pieces, queries, toxicity
from rastergrid.llm.common import plain, save, table, unused
from rastergrid.session import ship_package

# A model is trained and documents are encoded, which SQL cannot express.
ORACLE_SQL = None


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, text) is among ``kept`` (doc_id, text_key), each once."""
    key, n = unused(docs, "text_key"), unused(docs, "copy")
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit("")))).alias("d")
    chosen = kept.select("doc_id", "text_key").distinct().alias("k")
    left = keyed.join(chosen, F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col(f"d.{key}") == F.col("k.text_key")), "left_semi")
    counted = docs.groupBy("doc_id").count().where("count > 1")
    if not counted.isEmpty():
        again = Window.partitionBy("doc_id", key).orderBy(F.lit(1))
        left = left.withColumn(n, F.row_number().over(again)).where(F.col(n) == 1)
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity score does not reject; the model is the query's."""
    ship_package(spark)
    model = queries.toxicity_model(spark, sf_dir)
    score = unused(docs, "score")
    scored = toxicity.score(docs, model, "text", score)
    return scored.where(F.col(score) < toxicity.THRESHOLD).drop(score)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of identical texts."""
    ship_package(spark)
    found = exact_dedup.exact_dedup(plain(docs), {"text_key": F.xxhash64("text")})
    return _only(docs, found.where("kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents."""
    ship_package(spark)
    rows = plain(docs)
    found = near_dedup.near_dedup(rows).where("kept").select("doc_id")
    keys = rows.select("doc_id", F.xxhash64("text").alias("text_key"))
    return _only(docs, keys.join(found.distinct().withColumnRenamed("doc_id", "__k"), F.col("doc_id").eqNullSafe(F.col("__k")), "left_semi"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for each time it takes them, in training order."""
    ship_package(spark)
    mixed = save(mixing.mix(docs.select("doc_id", "source", "text")), "mixed")
    return mixing.training_order(docs, mixed)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its number of ids and the digests of its ids and of the decoded text."""
    import public_tokenizers

    ship_package(spark)
    return pieces.encode_documents(docs, pieces.read_model(public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [
    ("toxicity", toxicity_stage), ("exact dedup", exact_stage), ("near dedup", near_stage), ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not STAGES[-1][1]:
            docs = save(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
