"""Tile store, file store and dataset reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from rastergrid.functions import rowkey
from rastergrid.functions.columns import idiv
from rastergrid.operators import pixels as px
from rastergrid.operators import reading, regions
from rastergrid.operators.dates import DATE_CAP
from rastergrid.session import shared_folder
from rastergrid.sources import cells, keyed_cells, tile_files

from .base import query
from .derived import TILE

FILL = 255
# Tiles of 16 pixels: a folder of the store holds a year of a sixteenth of a table's planes.
SMALL_TILES = {"period": "year", "groups": 16}


def totals(tiles, keys):
    """Observed pixels and their sum per key of packed u8 tiles."""
    numbers = px.block_statistics(tiles, keys, 1, skip=FILL)
    return numbers.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").cast("bigint").alias("total"))


CELL_REQUESTS = """
    SELECT o_orderkey AS request_id, 'ht' || (o_custkey % 4 % 5) AS htable, (o_custkey % 4)::int AS hpid, 2 AS z,
           (o_orderkey % 2)::int AS y, (o_custkey // 4 % 4)::int AS x, strftime(o_orderdate, '%Y%m')::bigint * 100000000 AS dt FROM orders"""


def cell_requests(d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return d.table("orders").select(
        k.alias("request_id"), F.concat(F.lit("ht"), (c % 4 % 5).cast("string")).alias("htable"),
        (c % 4).cast("int").alias("hpid"), F.lit(2).alias("z"), (k % 2).cast("int").alias("y"),
        (idiv(c, 4) % 4).cast("int").alias("x"),
        (F.date_format("o_orderdate", "yyyyMM").cast("bigint") * 100000000).alias("dt"),
    )


@query("cell_read", f"""
    SELECT request_id, count(p.dn) AS n, coalesce(sum(p.dn), 0)::bigint AS total
    FROM ({CELL_REQUESTS}) r LEFT JOIN pixels p USING (hpid, z, y, x, dt) GROUP BY request_id""", ("pixels",))
def cell_read(d):
    """Cells of a request table, decoded; missing cells count nothing."""
    return totals(cells.at(d.tile_cells(), cell_requests(d)), ["request_id"])


SERIES_REQUESTS = """
    SELECT s_suppkey AS request_id, (s_suppkey // 25)::int AS hpid, 2 AS z, (s_suppkey % 2)::int AS y, (s_suppkey % 4)::int AS x,
           19950700000000 AS startdt, 20001100000000 AS stopdt, (CASE WHEN s_suppkey % 3 = 0 THEN -1 ELSE 1 + s_suppkey % 12 END)::int AS month
    FROM supplier"""


def series_requests(d):
    k = F.col("s_suppkey")
    hpid = idiv(k, 25).cast("int")
    return d.table("supplier").select(
        k.alias("request_id"), F.concat(F.lit("ht"), (hpid % 5).cast("string")).alias("htable"), hpid.alias("hpid"),
        F.lit(2).alias("z"), (k % 2).cast("int").alias("y"), (k % 4).cast("int").alias("x"),
        F.lit(19950700000000).alias("startdt"), F.lit(20001100000000).alias("stopdt"),
        F.when(k % 3 == 0, -1).otherwise(1 + k % 12).cast("int").alias("month"),
        *(F.lit(-1).alias(n) for n in ("day", "hour", "minute", "second")),
    )


@query("cell_series", f"""
    SELECT request_id, dt, count(*) AS n, sum(dn)::bigint AS total FROM ({SERIES_REQUESTS}) r JOIN pixels p USING (hpid, z, y, x)
    WHERE dt BETWEEN startdt AND stopdt AND (month = -1 OR dt // 100000000 % 100 = month) GROUP BY request_id, dt
    QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY dt) <= 30""", ("pixels",))
def cell_series(d):
    """At most 30 dates of each requested tile, decoded."""
    found = cells.between(d.tile_cells(), series_requests(d), ["request_id"], cap=DATE_CAP)
    return totals(found, ["request_id", "dt"])


@query("cell_series_all", f"""
    SELECT request_id, dt, count(*) AS n, sum(dn)::bigint AS total FROM ({SERIES_REQUESTS}) r JOIN pixels p USING (hpid, z, y, x)
    WHERE dt BETWEEN startdt AND stopdt AND (month = -1 OR dt // 100000000 % 100 = month) GROUP BY request_id, dt""", ("pixels",))
def cell_series_all(d):
    """The same without a cap, as the file store reads."""
    found = cells.between(d.tile_cells(), series_requests(d), ["request_id"])
    return totals(found, ["request_id", "dt"])


def dataset_requests(d):
    k, c = F.col("o_orderkey"), F.col("o_custkey") % 110
    name = F.when(c % 5 == 0, F.concat(F.lit("/user/"), c.cast("string"))).otherwise(
        F.concat(F.lit("sys/Supplier#"), F.lpad(c.cast("string"), 9, "0"))
    )
    lists = [F.array().cast("array<int>"), F.array(F.lit(0)), F.array(F.lit(3), F.lit(12)), F.array(F.lit(25))]
    bands = F.when(k % 4 == 0, lists[0]).when(k % 4 == 1, lists[1]).when(k % 4 == 2, lists[2]).otherwise(lists[3])
    return d.table("orders").select(
        k.alias("request_id"), name.alias("dsname"), bands.alias("bands"), F.lit(2).alias("z"),
        (k % 2).cast("int").alias("y"), (idiv("o_custkey", 4) % 4).cast("int").alias("x"),
        (F.date_format("o_orderdate", "yyyyMM").cast("bigint") * 100000000).alias("dt"),
    )


DATASET_SQL = """
    WITH req AS (
        SELECT o_orderkey AS request_id, o_orderkey % 4 AS kind, o_custkey % 110 AS c, (o_orderkey % 2)::int AS y, (o_custkey // 4 % 4)::int AS x,
               strftime(o_orderdate, '%Y%m')::bigint * 100000000 AS asked FROM orders),
    known AS (
        SELECT req.*, p.pid, name, hTableName, name LIKE '/%' AS user_file,
               CASE WHEN name LIKE '/%' THEN (SELECT min(hcol) FROM data_item i WHERE i.pid = p.pid) ELSE asked END AS dt
        FROM req LEFT JOIN product p ON p.pid = c),
    wanted AS (
        SELECT request_id, y, x, dt, hTableName, b.hPid, b.bsqIndex FROM known JOIN product_band b ON b.pid = known.pid
        WHERE kind <> 3 AND NOT user_file AND (kind = 0 OR (kind = 1 AND bindex = 0) OR (kind = 2 AND bindex IN (3, 12)))
        UNION ALL SELECT request_id, y, x, dt, hTableName, b.hPid, t.k FROM known JOIN product_band b ON b.pid = known.pid AND b.bindex = 0, range(2) AS t(k)
        WHERE kind <> 3 AND user_file),
    tiles AS (SELECT hpid, y, x, dt, count(*) AS cellpixels FROM pixels GROUP BY ALL),
    planes AS (SELECT hpid, y, x, dt, band, count(*) AS n, sum(dn)::bigint AS total FROM pixels GROUP BY ALL),
    got AS (
        SELECT request_id, bool_and(t.hpid IS NOT NULL AND hTableName = 'ht' || (w.hPid % 5)) AS whole,
               coalesce(sum(n), 0)::bigint AS n, coalesce(sum(total), 0)::bigint AS total
        FROM wanted w LEFT JOIN tiles t ON t.hpid = w.hPid AND t.y = w.y AND t.x = w.x AND t.dt = w.dt
        LEFT JOIN planes l ON l.hpid = w.hPid AND l.y = w.y AND l.x = w.x AND l.dt = w.dt AND l.band = w.bsqIndex GROUP BY request_id)
    SELECT request_id, (CASE WHEN whole THEN 0 ELSE 1 END)::int AS status,
           CASE WHEN pid IS NULL THEN 'no such product' WHEN kind = 3 THEN 'band index out of range' WHEN dt IS NULL THEN 'no data item'
                WHEN whole THEN '' ELSE 'no cell data' END AS log,
           CASE WHEN whole THEN n ELSE 0 END AS n, CASE WHEN whole THEN total ELSE 0 END AS total
    FROM known LEFT JOIN got USING (request_id)"""


@query("band_select", DATASET_SQL, ("product", "product_band", "data_item", "pixels"))
def band_select(d):
    """Dataset reads with chosen, all, mixed-plane and impossible band lists."""
    tiles = reading.dataset_tiles(
        dataset_requests(d), d.product(), d.product_band(), d.data_item(), d.tile_cells()
    )
    numbers = px.block_statistics(tiles, ["request_id", "status", "log"], 1, skip=FILL)
    return numbers.select("request_id", "status", "log", "n", F.col("total").cast("bigint").alias("total"))


@query("user_file_read", """
    WITH known AS (SELECT p.pid, (SELECT min(hcol) FROM data_item i WHERE i.pid = p.pid) // 100000000 * 100000000 AS dt FROM product p WHERE name LIKE '/%')
    SELECT k.pid::bigint AS request_id, count(x.dn) AS n, coalesce(sum(x.dn), 0)::bigint AS total FROM known k
    JOIN product_band b ON b.pid = k.pid AND b.bindex = 0 LEFT JOIN pixels x ON x.hpid = b.hPid AND x.dt = k.dt AND x.y = k.pid % 2 AND x.x = k.pid % 4
    GROUP BY ALL""", ("product", "product_band", "data_item", "pixels"))
def user_file_read(d):
    """User files read at the month of their first item, whatever date is asked for."""
    pid = F.col("pid")
    files = d.product().filter(F.col("name").startswith("/"))
    requests = files.select(
        pid.cast("bigint").alias("request_id"), F.col("name").alias("dsname"), F.array().cast("array<int>").alias("bands"),
        F.lit(2).alias("z"), (pid % 2).alias("y"), (pid % 4).alias("x"), F.lit(0).cast("bigint").alias("dt"),
    )
    monthly = d.data_item().withColumn("hcol", idiv("hcol", 100000000) * 100000000)
    tiles = reading.dataset_tiles(requests, d.product(), d.product_band(), monthly, d.tile_cells())
    return totals(tiles, ["request_id"])


@query("dataset_series", """
    WITH b AS (SELECT *, row_number() OVER w - 1 AS position, count(*) OVER (PARTITION BY pid) AS nbands FROM product_band WHERE bindex <> 4 WINDOW w AS (PARTITION BY pid ORDER BY bindex)),
    req AS (SELECT pid AS rid, CASE WHEN pid % 11 = 5 THEN 'nowhere/' || pid ELSE name END AS dsname, pid % 2 AS y, pid % 4 AS x,
                   CASE WHEN pid % 13 = 6 THEN []::int[] WHEN pid % 7 = 3 THEN [1, 25] WHEN pid % 2 = 0 THEN [1, 12] ELSE [1] END AS bands FROM product),
    judged AS (SELECT r.*, p.pid, hTableName,
                      CASE WHEN p.pid IS NULL THEN 'no such product' WHEN len(bands) = 0 THEN 'no band list'
                           WHEN coalesce(list_max(bands) >= (SELECT max(nbands) FROM b WHERE b.pid = p.pid), true) THEN 'band index out of range' ELSE '' END AS log
               FROM req r LEFT JOIN product p ON p.name = r.dsname),
    sel AS (SELECT rid, y, x, hPid, bsqIndex, hTableName = 'ht' || (hPid % 5) AS stored
            FROM (SELECT *, unnest(bands) AS position FROM judged WHERE log = '') j JOIN b USING (pid, position)),
    tiles AS (SELECT hpid, y, x, dt FROM pixels WHERE dt BETWEEN 19960100000000 AND 19991200000000 AND dt // 100000000 % 100 = 7 GROUP BY ALL),
    planes AS (SELECT hpid, y, x, dt, band, count(*) AS n, sum(dn)::bigint AS total FROM pixels GROUP BY ALL),
    got AS (SELECT rid, t.dt, count(*) AS seen, coalesce(sum(n), 0)::bigint AS n, coalesce(sum(total), 0)::bigint AS total
            FROM sel s JOIN tiles t ON t.hpid = s.hPid AND t.y = s.y AND t.x = s.x
            LEFT JOIN planes l ON l.hpid = s.hPid AND l.y = s.y AND l.x = s.x AND l.dt = t.dt AND l.band = s.bsqIndex WHERE stored GROUP BY ALL)
    SELECT rid::bigint AS request_id, dt, (CASE WHEN log = '' AND seen = len(bands) THEN 0 ELSE 1 END)::int AS status,
           CASE WHEN log <> '' THEN log WHEN seen = len(bands) THEN '' ELSE 'no cell data' END AS log,
           CASE WHEN seen = len(bands) THEN n ELSE 0 END AS n, CASE WHEN seen = len(bands) THEN total ELSE 0 END AS total
    FROM judged LEFT JOIN got USING (rid)""",
       ("product", "product_band", "pixels"))
def dataset_series(d):
    """Julys of four years of every product and of unknown ones, bands by position and matched by date, with status rows."""
    pid = F.col("pid")
    bands = (
        F.when(pid % 13 == 6, F.array().cast("array<int>")).when(pid % 7 == 3, F.array(F.lit(1), F.lit(25)))
        .when(pid % 2 == 0, F.array(F.lit(1), F.lit(12))).otherwise(F.array(F.lit(1)))
    )
    name = F.when(pid % 11 == 5, F.concat(F.lit("nowhere/"), pid.cast("string"))).otherwise(F.col("name"))
    requests = d.product().select(
        pid.cast("bigint").alias("request_id"), name.alias("dsname"), bands.alias("bands"), F.lit(2).alias("z"),
        (pid % 2).alias("y"), (pid % 4).alias("x"), F.lit(19960100000000).alias("startdt"), F.lit(19991200000000).alias("stopdt"),
        F.lit(7).alias("month"), *(F.lit(-1).alias(n) for n in ("day", "hour", "minute", "second")),
    )
    # Without its fifth band a product's further bands move up by one position.
    series = reading.dataset_series(requests, d.product(), d.product_band().filter("bindex <> 4"), d.tile_cells())
    numbers = px.block_statistics(series, ["request_id", "dt", "status", "log"], 1, skip=FILL)
    return numbers.select("request_id", "dt", "status", "log", "n", F.col("total").cast("bigint").alias("total"))


@query("store_read", f"""
    SELECT request_id, count(p.dn) AS n, coalesce(sum(p.dn), 0)::bigint AS total
    FROM ({CELL_REQUESTS}) r LEFT JOIN pixels p USING (hpid, z, y, x, dt) GROUP BY request_id""", ("pixels",))
def store_read(d):
    """The requests of cell_read from cells that were written to the store."""
    path = shared_folder(d.spark, "cells")
    cells.write(d.tile_cells(), path, **SMALL_TILES)
    return totals(cells.at(cells.read(d.spark, path, **SMALL_TILES), cell_requests(d)), ["request_id"])


@query("store_series", f"""
    SELECT request_id, dt, count(*) AS n, sum(dn)::bigint AS total FROM ({SERIES_REQUESTS}) r JOIN pixels p USING (hpid, z, y, x)
    WHERE dt BETWEEN startdt AND stopdt AND (month = -1 OR dt // 100000000 % 100 = month) GROUP BY request_id, dt
    QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY dt) <= 12""", ("pixels",))
def store_series(d):
    """The first twelve dates of each tile of the store, chosen on its list of dates."""
    path = shared_folder(d.spark, "cells")
    cells.write(d.tile_cells(), path, **SMALL_TILES)
    stored, listed = cells.read(d.spark, path, **SMALL_TILES), cells.dates(d.spark, path)
    return totals(cells.between(stored, series_requests(d), ["request_id"], cap=12, listed=listed), ["request_id", "dt"])


@query("cell_upsert", """
    SELECT hpid, dt, count(*) AS n, sum(CASE WHEN dt // 10000000000 = 1999 THEN dn + 1 ELSE dn END)::bigint AS total FROM pixels GROUP BY hpid, dt
    UNION ALL SELECT hpid, dt + 15000000, count(*), sum(dn + 1)::bigint FROM pixels WHERE dt // 10000000000 = 1999 GROUP BY hpid, dt""", ("pixels",))
def cell_upsert(d):
    """Write all cells, then overwrite 1999 and add mid-month dates, and read back."""
    path = shared_folder(d.spark, "cells")
    base = d.tile_cells()
    cells.write(base, path, **SMALL_TILES)
    year = cells.dated(cells.read(d.spark, path, **SMALL_TILES), 19990000000000, 19991231235959).select(*cells.CELL, "data")
    raised = px.map_tiles(
        year, cells.CELL, lambda tile: tile + (tile != FILL), 2, TILE, TILE, 1
    ).select(*cells.CELL, "data")
    both = raised.withColumn("dt", F.explode(F.array("dt", F.col("dt") + 15000000)))
    stale = year.withColumn("seq", F.lit(0))
    changes = stale.unionByName(both.withColumn("seq", F.lit(1)))
    cells.upsert(d.spark, path, changes, "seq", **SMALL_TILES)
    return totals(cells.read(d.spark, path, **SMALL_TILES), ["hpid", "dt"])


@query("cell_read_band", f"""
    SELECT request_id, count(p.dn) AS n, coalesce(sum(p.dn), 0)::bigint AS total
    FROM ({CELL_REQUESTS}) r LEFT JOIN pixels p ON p.hpid = r.hpid AND p.y = r.y AND p.x = r.x AND p.dt = r.dt AND p.band = r.request_id % 2 GROUP BY request_id""",
       ("pixels",))
def cell_read_band(d):
    """One band sliced out of each requested cell."""
    found = cells.at(d.tile_cells(), cell_requests(d)).withColumn("bsq", (F.col("request_id") % 2).cast("int"))
    sliced = found.select("request_id", px.band_block("data", "bsq", F.lit(TILE * TILE)).alias("data"))
    return totals(sliced, ["request_id"])


@query("tile_files", """
    SELECT hpid, dt, count(*) AS n, sum(dn)::bigint AS total FROM pixels WHERE dt BETWEEN 19980000000000 AND 19991231000000 GROUP BY hpid, dt""", ("pixels",))
def tile_files_query(d):
    """Cells written one per file, read back by path over a date range."""
    root = shared_folder(d.spark, "tiles")
    tile_files.write(d.tile_cells(), root)
    files = tile_files.read(d.spark, root, 19980000000000, 19991231000000)
    return totals(files, ["hpid", "dt"])


@query("tile_files_at", f"""
    SELECT request_id, count(p.dn) AS n, coalesce(sum(p.dn), 0)::bigint AS total
    FROM ({CELL_REQUESTS}) r LEFT JOIN pixels p USING (hpid, z, y, x, dt) GROUP BY request_id""", ("pixels",))
def tile_files_at(d):
    """The requests of cell_read from files, each opened by its path."""
    root = shared_folder(d.spark, "tiles")
    tile_files.write(d.tile_cells(), root)
    return totals(tile_files.at(d.spark, root, cell_requests(d)), ["request_id"])


@query("tile_files_series", f"""
    SELECT request_id, dt, count(*) AS n, sum(dn)::bigint AS total FROM ({SERIES_REQUESTS}) r JOIN pixels p USING (hpid, z, y, x)
    WHERE dt BETWEEN startdt AND stopdt AND (month = -1 OR dt // 100000000 % 100 = month) GROUP BY request_id, dt""", ("pixels",))
def tile_files_series(d):
    """The series of cell_series_all from files, whose dates are generated with one open part at most."""
    root = shared_folder(d.spark, "tiles")
    tile_files.write(d.tile_cells(), root)
    monthly = series_requests(d).withColumns({name: F.lit(0) for name in ("day", "hour", "minute", "second")})
    return totals(tile_files.between(d.spark, root, monthly, ["request_id"]), ["request_id", "dt"])


@query("keyed_cells", """
    WITH last AS (SELECT lang, doc_id // 2 AS k, arg_max(text, doc_id) AS text FROM documents GROUP BY ALL)
    SELECT d.doc_id, CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE md5(l.text) END AS digest FROM documents d LEFT JOIN last l ON l.lang = d.lang AND l.k = d.doc_id // 2""")
def keyed_cells_query(d):
    """Whole texts put under shared keys, last write kept, then read by key."""
    docs = d.table("documents")
    k = idiv("doc_id", 2)

    def key(qualifier):
        return [
            F.lit("docs").alias("tbl"), F.col("lang").alias("fam"),
            rowkey.big_endian(qualifier, 4).alias("qual"), rowkey.big_endian(k, 4).alias("rowkey"),
        ]

    puts = docs.select(*key(F.lit(1)), F.col("text").cast("binary").alias("data"), F.col("doc_id").alias("seq"))
    empty = puts.drop("seq").filter(F.lit(False))
    stored = keyed_cells.put(empty, puts, "seq")
    asked = docs.select("doc_id", *key(F.when(F.col("doc_id") % 7 == 0, 2).otherwise(1)))
    return keyed_cells.get(stored, asked).select("doc_id", F.md5("data").alias("digest"))


@query("roi_resolve", """
    SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'sys' WHEN 1 THEN 'user' ELSE 'file' END AS route,
           CASE c_custkey % 4 WHEN 0 THEN 'S' || c_custkey WHEN 1 THEN CASE WHEN c_custkey < (SELECT count(*) FROM supplier) THEN 'U' || c_custkey END
                WHEN 2 THEN 'F' || c_custkey END AS mask,
           (CASE c_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN CASE WHEN c_custkey < (SELECT count(*) FROM supplier) THEN 1 ELSE 0 END WHEN 2 THEN 1 ELSE 0 END)::int AS ok
    FROM customer""")
def roi_resolve(d):
    """Region texts resolved to masks from the system, user and file stores."""

    def masks(prefix, letter, rows):
        return rows.select(
            F.lit(prefix).alias("prefix"), "rid", F.concat(F.lit(letter), F.col("rid").cast("string")).cast("binary").alias("data")
        )

    k = F.col("c_custkey").cast("string")
    m = F.col("c_custkey") % 4
    stored = keyed_cells.region_cells(
        masks("sys", "S", d.roi_sys()).unionByName(masks("user", "U", d.roi_user()))
    )
    files = d.table("customer").filter(m == 2).select(
        F.concat(F.lit("roi/"), k).alias("path"), F.concat(F.lit("F"), k).cast("binary").alias("data")
    )
    text = (
        F.when(m == 0, F.concat(F.lit("sys:"), k)).when(m == 1, F.concat(F.lit("user:"), k)).otherwise(F.concat(F.lit("roi/"), k))
    )
    wanted = d.table("customer").select("c_custkey", text.alias("roi"))
    found = regions.resolve(wanted, keyed_cells.region_stores(stored), files)
    return found.select(
        "c_custkey", F.col("prefix").alias("route"), F.col("data").cast("string").alias("mask"), F.col("ok").cast("int").alias("ok")
    )


@query("roi_files", """
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'F' || c_custkey WHEN c_custkey % 3 = 1 THEN 'S' || c_custkey END AS mask FROM customer""")
def roi_files(d):
    """Regions whose masks are files below a root, opened by their path, beside those of the system's table."""
    root = shared_folder(d.spark, "regions")
    k, m = F.col("c_custkey").cast("string"), F.col("c_custkey") % 3
    customers = d.table("customer")
    path = F.concat(F.lit("shp/"), F.substring(k, 1, 1), F.lit("/"), k, F.lit(".tlv"))
    tile_files.write_paths(customers.filter(m == 0).select(path.alias("path"), F.concat(F.lit("F"), k).cast("binary").alias("data")), root)
    # The third kind of text names a file that is not there.
    wanted = customers.select("c_custkey", F.when(m == 1, F.concat(F.lit("sys:"), k)).otherwise(path).alias("roi"))
    stored = d.roi_sys().select(F.lit("sys").alias("prefix"), "rid", F.concat(F.lit("S"), F.col("rid").cast("string")).cast("binary").alias("data"))
    found = regions.resolve(wanted, keyed_cells.region_stores(keyed_cells.region_cells(stored)), keyed_cells.region_files(d.spark, root, wanted))
    return found.select("c_custkey", F.col("data").cast("string").alias("mask"))
