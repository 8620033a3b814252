"""Tile files ``root/table/plane/date/tile_z_y_x``, one block per file."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rowkey
from ..joins import never_broadcast, save
from ..operators.dates import date_grid, first_dates
from . import cells

# Fixed value: layout of a tile file's path.
PATH = r"/([^/]+)/(\d+)/(\d+)/tile_(\d+)_(\d+)_(\d+)$"


def _spread(rows: DataFrame) -> DataFrame:
    """Paths dealt evenly over a fixed number of tasks: so few bytes would be put together into one or two."""
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return rows.repartition(tasks, "path")


def children(folders: DataFrame, root: str) -> DataFrame:
    """What the folders ``path`` below the root hold: ``path, is_file``, without hidden names (``_`` or ``.`` first).

    Folders are listed by the tasks that get them, so the driver sees no names.
    """
    base = qualified(folders.sparkSession, root)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import posixpath

        from pyarrow import fs

        files, top = fs.FileSystem.from_uri(base)
        at_once = 10_000  # names in one Arrow batch
        for batch in batches:
            names, kinds = [], []
            for folder in batch.column("path").to_pylist():
                for info in files.get_file_info(fs.FileSelector(posixpath.join(top, folder), allow_not_found=True)):
                    if info.base_name[0] in "_.":
                        continue
                    names.append(posixpath.join(folder, info.base_name))
                    kinds.append(info.type == fs.FileType.File)
                    if len(names) == at_once:
                        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(kinds, pa.bool_())], ["path", "is_file"])
                        names, kinds = [], []
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(kinds, pa.bool_())], ["path", "is_file"])

    return _spread(folders.select("path")).mapInArrow(look, "path string, is_file boolean")


def read(spark: SparkSession, root: str, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Tile files as cells, those of the dates from ``start`` to ``stop`` where given, both inclusive.

    Tables, planes and dates are listed level by level in tasks; folders of other dates are neither listed nor opened.
    """
    level = spark.createDataFrame([("",)], "path string")
    for _ in ("table", "plane", "date"):
        level = children(level, root).filter("NOT is_file")
    date = F.regexp_extract("path", r"/(\d+)$", 1)
    level = level.filter(date != "")
    if start is not None:
        level = level.filter(date.cast("bigint") >= start)
    if stop is not None:
        level = level.filter(date.cast("bigint") <= stop)
    files = children(level, root).filter("is_file").select(F.concat(F.lit("/"), "path").alias("path")).filter(F.col("path").rlike(PATH))
    kinds = {"htable": "string", "hpid": "int", "dt": "bigint", "z": "int", "y": "int", "x": "int"}
    parts = [
        F.regexp_extract("path", PATH, i + 1).cast(kind).alias(name)
        for i, (name, kind) in enumerate(kinds.items())
    ]
    return open_paths(spark, root, files.select(F.substring("path", 2, 1 << 30).alias("path"), *parts)).drop("path")


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` with the scheme and host of its file system, so that every machine means the same place."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    path = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toUri()
    host = path.getAuthority()
    return f"{path.getScheme()}://{host or ''}{path.getPath()}"


def open_paths(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """``wanted`` (with a column ``path`` below the root) with the content of each file as ``data``; files that exist only.

    The root is not listed: paths are spread evenly over tasks, each of which opens its own.
    """
    base = qualified(spark, root)
    names = wanted.columns
    schema = wanted.withColumn("data", F.lit(None).cast("binary")).schema
    batch_files = 64  # at most so many contents in one Arrow batch

    def open_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import posixpath

        from pyarrow import fs

        files, folder = fs.FileSystem.from_uri(base)
        for batch in batches:
            for start in range(0, batch.num_rows, batch_files):
                part = batch.slice(start, batch_files)
                places = [posixpath.join(folder, name) for name in part.column("path").to_pylist()]
                there = [info.type == fs.FileType.File for info in files.get_file_info(places)]
                data = []
                for place, exists in zip(places, there):
                    if exists:
                        with files.open_input_stream(place) as file:
                            data.append(file.read())
                found = part.filter(pa.array(there, pa.bool_()))
                yield pa.RecordBatch.from_arrays([*found.columns, pa.array(data, pa.binary())], names=[*names, "data"])

    return _spread(wanted).mapInArrow(open_files, schema)


def fetch(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """Cells of a table of full keys, read by path: ``htable, hpid, z, y, x, dt, data``, files that exist only.

    Each distinct key is one path, and only files that were asked for are read.
    """
    path = rowkey.tile_path("htable", "hpid", "dt", "z", "y", "x")
    wanted = keys.select(*cells.CELL).distinct().select("*", path.alias("path"))
    return open_paths(spark, root, wanted).drop("path")


def at(spark: SparkSession, root: str, requests: DataFrame) -> DataFrame:
    """Requests on a full cell key with the content of their file, NULL where there is none."""
    return requests.join(never_broadcast(fetch(spark, root, requests)), cells.CELL, "left")


def between(
    spark: SparkSession, root: str, requests: DataFrame, keys: list[str], cap: int | None = None, max_wildcards: int | None = 1
) -> DataFrame:
    """Files of a tile over a date range and part filter; all dates unless a ``cap`` is given.

    The dates are generated from the years of the range and the parts asked for, and each is tried as a path. Requests
    with more open parts than ``max_wildcards`` give no rows; None allows any number.
    """
    names = [*dict.fromkeys([*keys, *cells.TILE])]
    dates = date_grid(requests, names, max_wildcards)
    known = save(dates, "file-dates")
    found = known.join(never_broadcast(fetch(spark, root, known)), cells.CELL)
    if cap is None:
        return found
    chosen = first_dates(found.select(*dict.fromkeys([*keys, *cells.CELL])), keys, cap)
    return found.join(chosen, [*dict.fromkeys([*keys, *cells.CELL])], "left_semi")


def write(tiles: DataFrame, root: str) -> int:
    """Write each cell to its own file; returns the number of files."""
    path = rowkey.tile_path("htable", "hpid", "dt", "z", "y", "x")
    return write_paths(tiles.select(path.alias("path"), "data"), root)


def write_paths(rows: DataFrame, root: str) -> int:
    """Write ``data`` of each row to its ``path`` below the root; returns the number of files.

    A file appears under its name only when complete, so a task that runs twice
    leaves the same files.
    """
    base_uri = qualified(rows.sparkSession, root)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import posixpath
        import uuid

        from pyarrow import fs

        base, folder = fs.FileSystem.from_uri(base_uri)

        def opened(draft: str):
            try:
                return base.open_output_stream(draft)
            except FileNotFoundError:  # the first file of its folder
                base.create_dir(posixpath.dirname(draft), recursive=True)
                return base.open_output_stream(draft)

        for batch in batches:
            for name, data in zip(batch.column("path"), batch.column("data")):
                target = posixpath.join(folder, name.as_py())
                draft = posixpath.join(posixpath.dirname(target), "." + uuid.uuid4().hex)
                with opened(draft) as out:
                    out.write(data.as_buffer())
                base.move(draft, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    saved = _spread(rows.select("path", "data")).mapInArrow(put, "n bigint")
    return saved.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
