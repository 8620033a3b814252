"""Job orders in and job results out, both as JSON files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tile_files

ORDER_SCHEMA = (
    "jsfile string, roi string, filldata double, dt bigint, sdui string, mpid_hpid int, "
    "out_htable string, out_hcol bigint, out_hpidlen int, out_xylen int"
)


# Characters that make a part of a path a pattern.
WILD = re.compile(r"[*?\[{]")


def _as_regex(pattern: str) -> str:
    """A part of a path with ``* ? [] {}`` as a regular expression over a name."""
    result, depth = "", 0
    for c in pattern.replace("[!", "[^"):
        depth += (c == "{") - (c == "}")
        special = {"*": "[^/]*", "?": "[^/]", "{": "(?:", "}": ")", "[": "[", "]": "]", "^": "^", "-": "-", ",": "|" if depth else ","}
        result += special.get(c) or re.escape(c)
    return f"(^|/){result}$"


def find_files(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """The root and, below it, the files ``path`` of a folder or of what a pattern of names matches, not hidden ones.

    Folders are listed in tasks, part by part of the pattern; a folder that is matched stands for the files in it.
    """
    parts = path.rstrip("/").split("/")
    fixed = next((i for i, part in enumerate(parts) if WILD.search(part)), len(parts))
    root, found = "/".join(parts[:fixed]) or "/", None
    for part in parts[fixed:]:
        level = spark.createDataFrame([("",)], "path string") if found is None else found.filter("NOT is_file")
        found = tile_files.children(level, root).filter(F.col("path").rlike(_as_regex(part)))
    if found is None:
        found = spark.createDataFrame([("", False)], "path string, is_file boolean")
    inside = tile_files.children(found.filter("NOT is_file"), root)
    return root, found.unionByName(inside).filter("is_file").select("path")


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """All orders of a folder or pattern, one per file, with the file they came from.

    Files are listed and opened by tasks, spread evenly. A file that is no JSON gives a row of NULLs, an empty one none, one that
    holds an array a row for each element.
    """
    root, files = find_files(spark, path)
    texts = tile_files.open_paths(spark, root, files).withColumn("text", F.col("data").cast("string")).filter(F.trim("text") != "")
    schema = T.StructType.fromDDL(ORDER_SCHEMA)
    nothing = F.array(F.lit(None).cast(schema))
    parsed = texts.select("path", F.explode(F.coalesce(F.from_json("text", T.ArrayType(schema)), nothing)).alias("order_"))
    return parsed.select("order_.*", F.concat(F.lit(tile_files.qualified(spark, root).rstrip("/") + "/"), "path").alias("order_file"))


def parse_orders(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Orders held as JSON texts in a table, one row each."""
    parsed = rows.select(*keep, F.from_json(text, ORDER_SCHEMA).alias("order_"))
    return parsed.select(*keep, "order_.*")


def write_results(results: DataFrame, path: str) -> None:
    """Job results ``(state, message, …)`` as JSON lines."""
    results.write.mode("overwrite").option("partitionOverwriteMode", "static").json(path)
