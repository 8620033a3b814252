"""Catalog tables from Parquet folders or over JDBC, and their snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The tables of a catalog.
NAMES = (
    "tbcategory", "tbproductdisplay", "tbproduct", "tbproductband", "tbhbasetable", "tbproductdataitem",
    "tbstaticmaplayer", "tbOfflineTask", "tbofftask", "tbstyle", "tbscript", "tbPolygon", "tbRenderTask",
    "area", "tbregion", "tbpreloadmap", "tbroicat", "tbroisys", "tbroiuser",
)


class Catalog:
    """One reader for all catalog tables.

    With ``jdbc`` options, large tables can be read in ranges of a numeric key
    (``partitions={"tbproductdataitem": ("fid", low, high, number)}``) instead of
    through one connection. Connection options stay on the driver and in Spark's
    reader; they are never printed.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        jdbc: dict[str, str] | None = None,
        partitions: dict[str, tuple[str, int, int, int]] | None = None,
    ):
        if (root is None) == (jdbc is None):
            raise ValueError("give either a folder or JDBC options")
        self.spark, self.root, self._jdbc = spark, root, jdbc
        self.partitions = partitions or {}

    def table(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise ValueError(f"unknown catalog table {name}")
        if self.root is not None:
            return self.spark.read.parquet(f"{self.root}/{name}")
        reader = self.spark.read.format("jdbc").options(**self._jdbc).option("dbtable", name)
        if name in self.partitions:
            key, low, high, number = self.partitions[name]
            reader = reader.options(
                partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=number
            )
        return reader.load()

    def append(self, name: str, rows: DataFrame) -> None:
        """Append rows to a table."""
        if name not in NAMES:
            raise ValueError(f"unknown catalog table {name}")
        if self.root is not None:
            rows.write.mode("append").parquet(f"{self.root}/{name}")
        else:
            rows.write.format("jdbc").options(**self._jdbc).option("dbtable", name).mode("append").save()

    def save(self, name: str, rows: DataFrame, folder: str) -> None:
        """Write a new snapshot of a table under another folder."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{folder}/{name}")
