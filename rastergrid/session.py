"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# One row of a packed table carries a whole pixel block (64 KB to a few MB), so Arrow
# batches are limited by bytes rather than rows. UTC keeps packed dates free of
# daylight-saving gaps.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "32m",
}


_shipped: set[tuple[str, str]] = set()


def ship_package(spark: SparkSession, folder: str | None = None) -> None:
    """Make a package folder (this one by default) importable in the Python workers.

    Needed once per application where the package is not installed on the executors.
    """
    folder = os.path.abspath(folder or os.path.dirname(__file__))
    context = spark.sparkContext
    if (context.applicationId, folder) in _shipped:
        return
    name = os.path.basename(folder)
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for place, _, files in os.walk(folder):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(place, file)
                    out.write(path, os.path.join(name, os.path.relpath(path, folder)))
    context.addPyFile(archive)
    _shipped.add((context.applicationId, folder))


def build_session(app_name: str = "rastergrid", master: str | None = None, **extra) -> SparkSession:
    """A session with the engine's settings; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint folder.

    The folder named in ``spark.checkpoint.dir`` is used as it is. Only a session that runs
    on one machine may go without it and then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="rastergrid-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
