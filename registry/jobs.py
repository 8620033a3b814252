"""Whole jobs and the worker feed."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from rastergrid.functions.columns import idiv
from rastergrid.operators import pixels as px
from rastergrid.joins import save
from rastergrid.plans import ledger, requests, tile_job
from rastergrid.session import shared_folder
from rastergrid.sources import cells, orders, tile_files
from rastergrid.sources.tables import Catalog
from rastergrid.streaming import feed

from .base import query
from .derived import RUN_STAMP, TILE
from .store import SMALL_TILES

FILL = 255

ORDER_TABLES = ("product", "pixels", "pyramid_pixels", "roi_segments")
JOB = """
    WITH ord AS (
        SELECT s_suppkey AS order_id, s_suppkey AS s, CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'sys:' || s_suppkey % 30 ELSE 'sys:' || s_suppkey % 25 END AS roi
        FROM supplier),
    inp AS (
        SELECT order_id, 0 AS position, s AS pid, (1996 + s % 4) * 10000000000 + (1 + s % 12) * 100000000 AS dt FROM ord
        UNION ALL SELECT order_id, 1, s + 1, (1997 + s % 3) * 10000000000 + (1 + s % 11) * 100000000 FROM ord WHERE s % 3 = 0),
    compat AS (
        SELECT order_id, count(DISTINCT proj) AS np, min(maxZoom) AS zmax, count(p.pid) < count(*) AS lost, max(proj) AS proj
        FROM inp LEFT JOIN product p USING (pid) GROUP BY order_id),
    corner AS (
        SELECT roi_id AS roi, min(x0) * 5.625::double - 180 AS l, (max(x1) + 1) * 5.625::double - 180 AS r,
               90 - min(grow) * 5.625::double AS t, 90 - (max(grow) + 1) * 5.625::double AS b FROM roi_segments GROUP BY ALL),
    st AS (
        SELECT o.*, np, zmax, (CASE WHEN lost THEN 21 WHEN np > 1 THEN 22 WHEN o.roi <> '' AND c.l IS NULL THEN 23 ELSE 0 END)::int AS state,
               CASE WHEN o.roi = '' THEN -180 ELSE greatest(-180, l - 0.703125::double) END AS l, CASE WHEN o.roi = '' THEN 180 ELSE least(180, r + 0.703125::double) END AS r,
               CASE WHEN o.roi = '' THEN 90 ELSE least(90, t + 0.703125::double) END AS t, CASE WHEN o.roi = '' THEN -90 ELSE greatest(-90, b - 0.703125::double) END AS b
        FROM ord o JOIN compat USING (order_id) LEFT JOIN corner c ON c.roi = o.roi),
    rng AS (
        SELECT order_id, z::int AS z, least(trunc((l + 180) / (360::double / (pow(2, z) * 16)))::int // 16, pow(2, z)::int - 1) AS xa,
               least(trunc((r + 180) / (360::double / (pow(2, z) * 16)))::int // 16, pow(2, z)::int - 1) AS xb,
               least(trunc((90 - t) / (360::double / (pow(2, z) * 16)))::int // 16, greatest(1, pow(2, z)::int // 2) - 1) AS ya,
               least(trunc((90 - b) / (360::double / (pow(2, z) * 16)))::int // 16, greatest(1, pow(2, z)::int // 2) - 1) AS yb
        FROM st, range(0, 6) AS q(z) WHERE z <= zmax AND state = 0),
    tile AS (SELECT order_id, z, y::int AS y, x::int AS x FROM rng, range(32) AS a(y), range(32) AS c(x) WHERE y BETWEEN ya AND yb AND x BETWEEN xa AND xb),
    have AS (SELECT DISTINCT hpid, dt, z, y, x FROM pyramid_pixels),
    res AS (
        SELECT t.order_id, t.z, t.y, t.x, bool_and(h.hpid IS NOT NULL) AS ok
        FROM tile t JOIN inp i USING (order_id) LEFT JOIN have h ON h.hpid = i.pid // 25 AND h.dt = i.dt AND h.z = t.z AND h.y = t.y AND h.x = t.x GROUP BY ALL),
    firstok AS (
        SELECT i.order_id, bool_and(h.hpid IS NOT NULL) AS dry FROM inp i LEFT JOIN have h ON h.hpid = i.pid // 25 AND h.dt = i.dt AND h.z = 0 GROUP BY ALL)"""


def job_inputs(d):
    k = F.col("s_suppkey")
    suppliers = d.table("supplier")
    roi = (
        F.when(k % 4 == 0, "").when(k % 4 == 1, F.concat(F.lit("sys:"), (k % 30).cast("string")))
        .otherwise(F.concat(F.lit("sys:"), (k % 25).cast("string")))
    )
    order_rows = suppliers.select(
        k.alias("order_id"), ((1996 + k % 4) * 10000000000 + (1 + k % 12) * 100000000).alias("dt"), roi.alias("roi"), F.lit(0.0).alias("filldata"), (idiv(k, 25) + 50000).cast("int").alias("mpid_hpid"),
        F.lit("out").alias("out_htable"), (F.lit(20200101000000) + k % 25 * 1000000).alias("out_hcol"), F.lit(4).alias("out_hpidlen"), F.lit(2).alias("out_xylen"),
    )

    def name(number):
        return F.when(number % 5 == 0, F.concat(F.lit("/user/"), number.cast("string"))).otherwise(
            F.concat(F.lit("sys/Supplier#"), F.lpad(number.cast("string"), 9, "0"))
        )

    def one(position, number, dt):
        return suppliers.select(
            k.alias("order_id"), F.lit(position).alias("position"), name(number).alias("dsname"), dt.alias("dt"),
            F.array(F.lit(0), F.lit(1)).alias("bands"),
        )

    inputs = one(0, k, F.lit(None).cast("bigint")).unionByName(
        one(1, k + 1, (1997 + k % 3) * 10000000000 + (1 + k % 11) * 100000000).filter(F.col("order_id") % 3 == 0)
    )
    # User files would ignore the date asked for; here every product is a plain dataset.
    products = d.product().withColumn("name", F.concat(F.lit("p:"), "name"))
    inputs = inputs.withColumn("dsname", F.concat(F.lit("p:"), "dsname"))
    return tile_job.JobInputs(
        order_rows, inputs, products, d.product_band(), d.data_item(), d.tile_cells(pyramid=True), d.roi_segments()
    )


def brightest(tile):
    """Largest observed value over all bands, 0 where none was observed."""
    return np.where(tile == FILL, 0, tile).max(axis=0)[None]


def run_job(d):
    scratch = shared_folder(d.spark, "job")
    source = f"{scratch}/source"
    job = job_inputs(d)
    job.cells.write.mode("overwrite").parquet(source)
    job.cells = d.spark.read.parquet(source)
    # The output store starts empty.
    cells.write(job.cells.filter(F.lit(False)), f"{scratch}/store", **SMALL_TILES)
    outcome = tile_job.run_jobs(d.spark, job, brightest, f"{scratch}/store", scratch, TILE, **SMALL_TILES)
    return job, outcome, scratch


@query("tile_job", JOB + """
    SELECT s.order_id, (CASE WHEN state = 0 AND NOT dry THEN 20 ELSE state END)::int AS state,
           coalesce(count(CASE WHEN ok AND dry THEN 1 END), 0) AS good, coalesce(count(CASE WHEN NOT ok AND dry THEN 1 END), 0) AS bad,
           CASE WHEN state = 21 THEN 'at least one known dataset is needed' WHEN state = 22 THEN 'datasets differ in projection'
                WHEN state = 23 THEN 'region has no data' WHEN NOT dry THEN 'the first tile could not be computed'
                ELSE 'success done, good:' || count(CASE WHEN ok AND dry THEN 1 END) || ', bad:' || count(CASE WHEN NOT ok AND dry THEN 1 END) END AS message
    FROM st s JOIN firstok f USING (order_id) LEFT JOIN res r ON r.order_id = s.order_id GROUP BY s.order_id, state, dry""", ORDER_TABLES)
def tile_job_query(d):
    """All orders run to the end: state, message and tile counts of each."""
    return run_job(d)[1].select("order_id", "state", "good", "bad", "message")


@query("tile_job_values", JOB + """,
    v AS (
        SELECT r.order_id, r.z, p.grow, p.gcol, max(p.dn) AS dn FROM res r JOIN inp i USING (order_id) JOIN firstok f ON f.order_id = r.order_id
        JOIN pyramid_pixels p ON p.hpid = i.pid // 25 AND p.dt = i.dt AND p.z = r.z AND p.y = r.y AND p.x = r.x WHERE ok AND dry GROUP BY ALL),
    m AS (SELECT DISTINCT roi_id AS roi, (2 - k)::int AS z, grow >> k AS grow, g >> k AS gcol
          FROM roi_segments s, (SELECT unnest(range(3))::int AS k), range(64) AS c(g) WHERE g BETWEEN x0 AND x1)
    SELECT v.order_id, v.z, count(*) AS n, sum(dn)::bigint AS total FROM v JOIN st USING (order_id) LEFT JOIN m ON m.roi = st.roi AND m.z = v.z AND m.grow = v.grow AND m.gcol = v.gcol
    WHERE st.roi = '' OR m.roi IS NOT NULL GROUP BY ALL""", ORDER_TABLES)
def tile_job_values(d):
    """Pixels the jobs stored, read back from the store."""
    _, _, scratch = run_job(d)
    stored = cells.read(d.spark, f"{scratch}/store", **SMALL_TILES).withColumn(
        "order_id", (F.col("hpid") - 50000) * 25 + idiv(F.col("dt") - 20200101000000, 1000000)
    )
    # Zero is what clipped and unobserved pixels hold; values themselves start at 1.
    numbers = px.block_statistics(stored, ["order_id", "z"], 1, skip=0)
    return numbers.filter("n > 0").groupBy("order_id", "z").agg(
        F.sum("n").alias("n"), F.sum("total").cast("bigint").alias("total")
    )


@query("order_parse", """
    SELECT s_suppkey, 'sys:' || s_suppkey AS roi, (s_suppkey % 7)::double AS filldata, 20200101000000 + s_suppkey AS dt, (1000 + s_suppkey)::int AS mpid_hpid,
           NULL::bigint AS out_hcol, 4 AS out_xylen FROM supplier""")
def order_parse(d):
    """Orders from JSON texts; unknown keys are ignored and absent ones are NULL."""
    k = F.col("s_suppkey")
    text = F.to_json(
        F.struct(
            F.concat(F.lit("sys:"), k.cast("string")).alias("roi"), F.lit("a note").alias("roi_comment"), (k % 7).alias("filldata"),
            (20200101000000 + k).alias("dt"), (1000 + k).alias("mpid_hpid"), F.lit(4).alias("out_xylen"),
        )
    )
    rows = d.table("supplier").select("s_suppkey", text.alias("text"))
    return orders.parse_orders(rows, "text", ["s_suppkey"]).select(
        "s_suppkey", "roi", "filldata", "dt", "mpid_hpid", "out_hcol", "out_xylen"
    )


@query("order_files", """
    SELECT s_suppkey, 'sys:' || s_suppkey AS roi, (s_suppkey % 7)::double AS filldata, 20200101000000 + s_suppkey AS dt, (1000 + s_suppkey)::int AS mpid_hpid,
           NULL::bigint AS out_hcol, 'order_' || s_suppkey AS order_file FROM supplier""")
def order_files(d):
    """Orders read from JSON files, one each; the file says which order it is."""
    k = F.col("s_suppkey")
    text = F.to_json(
        F.struct(
            F.concat(F.lit("sys:"), k.cast("string")).alias("roi"), F.lit("a note").alias("roi_comment"), (k % 7).alias("filldata"),
            (20200101000000 + k).alias("dt"), (1000 + k).alias("mpid_hpid"),
        )
    )
    root = shared_folder(d.spark, "orders")
    folder = F.coalesce(k.cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    path = F.concat(F.lit("order="), folder, F.lit("/order.json"))
    tile_files.write_paths(d.table("supplier").select(path.alias("path"), text.cast("binary").alias("data")), root)
    read = orders.read_orders(d.spark, f"{root}/order=*/*")
    number = F.regexp_extract("order_file", r"order=(\d+)/", 1)
    return read.select(
        number.cast("bigint").alias("s_suppkey"), "roi", "filldata", "dt", "mpid_hpid", "out_hcol", F.concat(F.lit("order_"), number).alias("order_file")
    )


@query("composite_requests", """
    WITH o AS (SELECT s_suppkey AS request_id, (s_suppkey // 25)::int AS hpid, s_suppkey % 2 AS usebound, -180 + (s_suppkey * 37 % 300) AS l, 90 - (s_suppkey * 17 % 140) AS t,
                      (1996 + s_suppkey % 3) * 10000000000 AS d0, (1998 + s_suppkey % 3) * 10000000000 AS d1 FROM supplier),
    tl AS (SELECT o.*, z, y::int AS y, x::int AS x FROM o, (SELECT unnest([1, 2])::int AS z), range(2) AS a(y), range(4) AS b(x)
          WHERE y < greatest(1, pow(2, z) / 2) AND x < pow(2, z) AND (usebound = 0 OR (x BETWEEN floor((l + 180) / (360 / pow(2, z))) AND least(floor((l + 220) / (360 / pow(2, z))), pow(2, z) - 1)
            AND y BETWEEN floor((90 - t) / (360 / pow(2, z))) AND least(floor((120 - t) / (360 / pow(2, z))), greatest(1, pow(2, z) / 2) - 1)))),
    v AS (SELECT request_id, tl.z, tl.y, tl.x, band, grow, gcol, max(CASE WHEN dn BETWEEN 5 AND 45 THEN dn END) AS dn
          FROM tl JOIN pyramid_pixels p ON p.hpid = tl.hpid AND p.z = tl.z AND p.y = tl.y AND p.x = tl.x AND dt BETWEEN d0 AND d1 GROUP BY ALL)
    SELECT request_id, z, y, x, count(dn) AS n, coalesce(sum(dn), 0) AS total FROM v GROUP BY ALL""", ("pixels", "pyramid_pixels"))
def composite_requests(d):
    """Largest valid value over two years in the pyramid of each request's box."""
    k = F.col("s_suppkey")
    hpid = (k / 25).cast("int")
    left, top = -180.0 + k * 37 % 300, 90.0 - k * 17 % 140
    asked = d.table("supplier").select(
        k.alias("request_id"), hpid.alias("hpid"), F.concat(F.lit("ht"), (hpid % 5).cast("string")).alias("htable"), (k % 2).alias("usebound"),
        left.alias("left"), (left + 40.0).alias("right"), top.alias("top"), (top - 30.0).alias("bottom"), F.lit(1).alias("zmin"), F.lit(2).alias("zmax"),
        ((1996 + k % 3) * 10000000000).alias("startdt"), ((1998 + k % 3) * 10000000000).alias("stopdt"),
    )
    blocks = requests.composite_requests(asked, d.tile_cells(pyramid=True), "max", 5, 45, 0, TILE, 1)
    return px.block_statistics(blocks, ["request_id", "z", "y", "x"], 1, skip=0).select("request_id", "z", "y", "x", "n", "total")


ZONAL_REQUESTS = """
    WITH o AS (SELECT s_suppkey AS request_id, 'sys:' || s_suppkey % 25 AS roi_id, (s_suppkey // 25)::int AS hpid, s_suppkey % 2 AS band, (1 + s_suppkey % 2)::int AS z,
                      (1996 + s_suppkey % 3) * 10000000000 AS d0, (1998 + s_suppkey % 3) * 10000000000 AS d1,
                      CASE s_suppkey % 3 WHEN 0 THEN 'min' WHEN 1 THEN 'max' ELSE 'ave' END AS method FROM supplier),
    m AS (SELECT DISTINCT roi_id, (2 - k)::int AS z, grow >> k AS grow, g >> k AS gcol
          FROM REGIONS s, (SELECT unnest(range(3))::int AS k), range(64) AS c(g) WHERE g BETWEEN x0 AND x1)
    SELECT request_id, dt, count(*) AS n, min(dn) AS low, max(dn) AS high, avg(dn) AS ave, CASE method WHEN 'min' THEN min(dn) WHEN 'max' THEN max(dn) ELSE avg(dn) END AS value
    FROM o JOIN m USING (roi_id, z) JOIN pyramid_pixels p ON p.hpid = o.hpid AND p.band = o.band AND p.z = o.z AND p.grow = m.grow AND p.gcol = m.gcol AND dt BETWEEN d0 AND d1
    WHERE dn BETWEEN 3 AND 40 AND dn <> 17 GROUP BY request_id, dt, method"""


def zonal_asked(d):
    k = F.col("s_suppkey")
    hpid = (k / 25).cast("int")
    return d.table("supplier").select(
        k.alias("request_id"), F.concat(F.lit("sys:"), (k % 25).cast("string")).alias("roi_id"), hpid.alias("hpid"),
        F.concat(F.lit("ht"), (hpid % 5).cast("string")).alias("htable"), (k % 2).cast("int").alias("bsq"), (1 + k % 2).cast("int").alias("zlevel"),
        ((1996 + k % 3) * 10000000000).alias("startdt"), ((1998 + k % 3) * 10000000000).alias("stopdt"), F.lit(3.0).alias("vmin"), F.lit(60.0).alias("vmax"),
        F.lit(0.0).alias("valid_min"), F.lit(40.0).alias("valid_max"), F.lit(17.0).alias("nodata"),
        F.when(k % 3 == 0, "min").when(k % 3 == 1, "max").otherwise("ave").alias("method"),
    )


@query("zonal_requests", ZONAL_REQUESTS.replace("REGIONS", "roi_segments"), ("pixels", "pyramid_pixels", "roi_segments"))
def zonal_requests(d):
    """Statistics of many requests with their own region, level, dates and method."""
    return requests.zonal_requests(zonal_asked(d), d.tile_cells(pyramid=True), d.roi_segments(), TILE, 1).filter("n > 0")


WIDE_REGIONS = """(SELECT 'sys:' || n_nationkey AS roi_id, unnest(range(n_nationkey % 3 * 8, least(n_nationkey % 3 * 8 + 24, 32))) AS grow,
                          5 * n_nationkey % 24 AS x0, 5 * n_nationkey % 24 + 39 AS x1 FROM nation)"""


def wide_segments(d):
    n = F.col("n_nationkey")
    first = n % 3 * 8
    return d.table("nation").select(
        F.concat(F.lit("sys:"), n.cast("string")).alias("roi_id"), F.lit(2).alias("level"),
        F.explode(F.sequence(first.cast("int"), F.least(first + 23, F.lit(31)).cast("int"))).alias("grow"),
        (5 * n % 24).cast("int").alias("x0"), (5 * n % 24 + 39).cast("int").alias("x1"),
    )


@query("zonal_zones", ZONAL_REQUESTS.replace("REGIONS", WIDE_REGIONS), ("pixels", "pyramid_pixels"))
def zonal_zones(d):
    """The same over wide regions, whose inner tiles are answered from the zone table without their blocks."""
    tiles = save(d.tile_cells(pyramid=True), "zone-cells")
    zones = save(px.zone_table(tiles, cells.CELL, TILE, 1), "zone-table")
    return requests.zonal_requests(zonal_asked(d), tiles, wide_segments(d), TILE, 1, cells.listed_dates(tiles), zones).filter("n > 0")


@query("job_results", """
    SELECT s_suppkey AS order_id, (s_suppkey % 4)::int AS state, 'say "' || s_name || '"' AS message FROM supplier""")
def job_results(d):
    """Results written as JSON and read again; quotes survive."""
    k = F.col("s_suppkey")
    rows = d.table("supplier").select(
        k.alias("order_id"), (k % 4).cast("int").alias("state"), F.concat(F.lit('say "'), "s_name", F.lit('"')).alias("message")
    )
    path = shared_folder(d.spark, "results")
    orders.write_results(rows, path)
    return d.spark.read.schema("order_id bigint, state int, message string").json(path)


@query("job_registration", JOB + """,
    fin AS (SELECT s.order_id, (50000 + s.order_id // 25)::int AS pid, 20200101000000 + s.order_id % 25 * 1000000 AS hcol,
                   CASE WHEN state = 0 AND NOT dry THEN 20 ELSE state END AS state FROM st s JOIN firstok USING (order_id)),
    good AS (SELECT * FROM fin WHERE state = 0)
    SELECT 'band' AS kind, pid::bigint AS pid, bindex::bigint AS part, hPid || '/' || bsqIndex AS text FROM product_band
    UNION ALL SELECT DISTINCT 'band', pid, 0, pid || '/0' FROM good
    UNION ALL SELECT 'item', pid, hcol, 'old' FROM data_item GROUP BY ALL
    UNION ALL SELECT DISTINCT 'item', pid, hcol, '2024/02/01 03:04:05 2024/02/01 03:04:05' FROM good
    UNION ALL SELECT 'item ids', count(*), count(*), 'distinct' FROM (SELECT pid, hcol FROM data_item UNION SELECT pid, hcol FROM good)
    UNION ALL SELECT DISTINCT 'product', pid, 0, CASE WHEN pid IN (SELECT pid FROM good) THEN 'user/' || pid ELSE 'new' END FROM fin WHERE pid % 4 <> 3
    UNION ALL SELECT 'order', order_id, CASE WHEN state = 0 AND pid % 4 = 3 THEN 26 ELSE state END, 'done' FROM fin""", (*ORDER_TABLES, "product_band", "data_item"))
def job_registration(d):
    """The catalog after a real run of all orders was registered twice; some output products do not exist."""
    root = shared_folder(d.spark, "catalog")
    job, outcome, _ = run_job(d)
    old = d.data_item().groupBy("pid", "hcol").agg(F.min("fid").alias("fid"))
    places = [F.lit(0.0).alias(c) for c in ("hleft", "hright", "htop", "hbottom")]
    first = Catalog(d.spark, root=f"{root}/0")
    first.append("tbproductband", d.band_rows())
    first.append("tbproductdataitem", old.select("fid", "pid", "hcol", *places, F.lit("old").alias("createtime"), F.lit("").alias("updatetime")))
    outputs = job.orders.select(F.col("mpid_hpid").alias("pid")).distinct().filter("pid % 4 <> 3")
    first.append("tbproduct", outputs.select("pid", F.lit("new").alias("name"), F.lit("").alias("info")))
    stamp = F.to_timestamp(F.lit(RUN_STAMP))
    outcome = save(outcome, "outcome")
    ledger.start(job.orders, f"{root}/1")
    once = ledger.register(d.spark, first, outcome, job.orders, 1, 1, stamp, f"{root}/1")
    twice = ledger.register(d.spark, once.catalog, outcome, job.orders, 1, 1, stamp, f"{root}/2")
    bands, items, products = (twice.catalog.table(t) for t in ("tbproductband", "tbproductdataitem", "tbproduct"))
    pid = F.col("pid").cast("bigint").alias("pid")

    def rows(table, kind, number, part, text):
        return table.select(F.lit(kind).alias("kind"), number, part.cast("bigint").alias("part"), text.alias("text"))

    ids = items.agg(F.count("*").alias("pid"), F.count_distinct("fid").alias("part"))
    return (
        rows(bands, "band", pid, F.col("bindex"), F.concat(F.get_json_object("info", "$.hPid"), F.lit("/"), F.get_json_object("info", "$.bsqIndex")))
        .unionByName(rows(items, "item", pid, F.col("hcol"), F.concat_ws(" ", "createtime", F.nullif("updatetime", F.lit("")))))
        .unionByName(rows(ids, "item ids", pid, F.col("part"), F.lit("distinct")))
        .unionByName(rows(products, "product", pid, F.lit(0), F.col("name")))
        .unionByName(rows(twice.results, "order", F.col("order_id").alias("pid"), F.col("state"), F.lit("done")))
    )


@query("worker_feed", """
    SELECT t.ofid, mode, uid, (CASE WHEN w.state IS NULL THEN 0 WHEN w.state = 0 THEN 2 ELSE 3 END)::int AS status
    FROM task t LEFT JOIN (SELECT ofid, arg_max(state, event_id) AS state FROM worker_result GROUP BY ofid) w USING (ofid)""",
       ("task", "worker_result"))
def worker_feed(d):
    """Worker results streamed into the task table until all are taken."""
    path = shared_folder(d.spark, "feed")
    events = d.spark.readStream.schema(d.table("events").schema).option("pathGlobFilter", "events.parquet").parquet(d.sf_dir)
    results = events.select(
        "event_id", F.col("user_id").cast("int").alias("ofid"), F.when(F.col("event_type") == "error", 1).otherwise(0).alias("state")
    )
    feed.start(results, f"{path}/status", f"{path}/checkpoint", "event_id").awaitTermination()
    return feed.status_table(d.spark, f"{path}/status", d.task()).drop("seen")
