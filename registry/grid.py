"""Grid and row-key queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rastergrid.functions import grid, rowkey
from rastergrid.operators import extents, pyramid

from .base import query
from .derived import TILE

Z = 5
RES = f"(360.0::double / (pow(2, {Z}) * 256))"
STRICT_X = f"least(trunc((lon + 180) / {RES})::int // 256, {2**Z - 1})::int"
STRICT_Y = f"least(trunc((90 - lat) / {RES})::int // 256, {2 ** (Z - 1) - 1})::int"


def cents(df):
    return df.withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))


@query("tile_heatmap", """
    SELECT z, y, x, count(*) AS n,
           sum(round(value * 100)::bigint)::bigint / 100::double AS sum_value,
           sum(round(value * 100)::bigint)::bigint / 100::double / count(*) AS avg_value,
           printf('%02x%08x%02x%04x%04x', (x + y) % 10, 7, z, y, x) AS rowkey
    FROM (
        SELECT zs.z::int AS z, value,
               least(trunc((lon + 180) / (360.0::double / (pow(2, zs.z) * 256)))::int // 256, pow(2, zs.z)::int - 1)::int AS x,
               least(trunc((90 - lat) / (360.0::double / (pow(2, zs.z) * 256)))::int // 256, greatest(1, pow(2, zs.z)::int // 2) - 1)::int AS y
        FROM points, range(6) AS zs(z))
    GROUP BY z, y, x""", ("points",))
def tile_heatmap(d):
    """Points per tile for levels 0..5 with the row key each tile would be stored under."""
    tiles = pyramid.tile_counts(cents(d.points()), ["cents"], Z)
    total = F.col("cents") / 100.0
    return tiles.select(
        "z", "y", "x", "n",
        total.alias("sum_value"),
        (total / F.col("n")).alias("avg_value"),
        F.lower(F.hex(rowkey.encode(F.lit(7), "z", "y", "x", 4, 2))).alias("rowkey"),
    )


@query("tile_points_strict", f"""
    SELECT event_id, {STRICT_X} AS x, {STRICT_Y} AS y FROM points
    UNION ALL SELECT event_id, NULL, NULL FROM points""", ("points",))
def tile_points_strict(d):
    """Strict placement; positions shifted out of the world have no tile."""
    points = d.points()
    shifted = points.withColumn("lon", F.col("lon") + 400.0)
    tile = grid.strict_tile("lon", "lat", F.lit(Z))
    return points.unionByName(shifted).withColumn("tile", tile).select("event_id", "tile.x", "tile.y")


@query("tile_points_clamped", f"""
    SELECT event_id,
           greatest(0, least(trunc((lon * 1.5::double + 180) / (360::double / 32 / 256) / 256), 31))::int AS x,
           greatest(0, least(trunc((90 - lat * 1.5::double) / (360::double / 32 / 256) / 256), 15))::int AS y
    FROM points""", ("points",))
def tile_points_clamped(d):
    """Clamped placement of positions that reach beyond the world."""
    tile = grid.clamped_tile(F.col("lon") * 1.5, F.col("lat") * 1.5, F.lit(Z))
    return d.points().withColumn("tile", tile).select("event_id", "tile.x", "tile.y")


@query("pixel_lookup", """
    SELECT event_id, fullx // 256 AS x, fully // 256 AS y, fullx % 256 AS col, fully % 256 AS row
    FROM (SELECT event_id,
                 trunc((lon + 180) / (360::double / 32 / 256) + 0.5)::int AS fullx,
                 trunc((90 - lat) / (180::double / 16 / 256) + 0.5)::int AS fully FROM points)""",
       ("points",))
def pixel_lookup(d):
    """Tile and pixel of each point, rounded to the nearest pixel."""
    at = grid.pixel_position("lon", "lat", F.lit(Z))
    return d.points().withColumn("at", at).select("event_id", "at.x", "at.y", "at.col", "at.row")


@query("tile_bounds", f"""
    SELECT event_id, x * 256 * {RES} - 180 AS "left", x * 256 * {RES} - 180 + 256 * {RES} AS "right",
           90 - y * 256 * {RES} AS top, 90 - y * 256 * {RES} - 256 * {RES} AS bottom
    FROM (SELECT event_id, {STRICT_X} AS x, {STRICT_Y} AS y FROM points)""", ("points",))
def tile_bounds(d):
    """Degrees covered by the tile of each point."""
    tile = grid.strict_tile("lon", "lat", F.lit(Z))
    placed = d.points().withColumn("tile", tile)
    bounds = grid.tile_bounds(F.lit(Z), "tile.y", "tile.x")
    return placed.select("event_id", bounds.alias("b")).select("event_id", "b.*")


@query("pixel_values_at", """
    SELECT q.event_id, max(CASE WHEN p.band = 0 THEN p.dn END) AS v0, max(CASE WHEN p.band = 1 THEN p.dn END) AS v1
    FROM (SELECT event_id, (event_id % 4)::int AS hpid,
                 (1997 + event_id % 3) * 10000000000 + (1 + event_id % 12) * 100000000 AS dt,
                 trunc((lon + 180) / (360::double / 4 / 16) + 0.5)::int AS gcol,
                 trunc((90 - lat) / (180::double / 2 / 16) + 0.5)::int AS grow FROM points) q
    LEFT JOIN pixels p ON p.hpid = q.hpid AND p.dt = q.dt AND p.gcol = q.gcol AND p.grow = q.grow
    GROUP BY q.event_id""", ("points", "pixels"))
def pixel_values_at(d):
    """Band values of a product and date at each point (255 means not observed)."""
    e = F.col("event_id")
    hpid = (e % 4).cast("int")
    requests = d.points().select(
        "event_id", "lon", "lat", hpid.alias("hpid"),
        F.concat(F.lit("ht"), (hpid % 5).cast("string")).alias("htable"),
        ((1997 + e % 3) * 10000000000 + (1 + e % 12) * 100000000).alias("dt"),
    )
    found = pyramid.pixels_at(requests, d.tile_cells(), 2, 2, 1, TILE, TILE)
    seen = [F.nullif(F.col("values")[b], F.lit(255.0)).alias(f"v{b}") for b in range(2)]
    return found.select("event_id", *seen)


SUPPLIER_EXTENTS = """
    SELECT s_suppkey::int AS id, 0 AS zmin, (2 + s_suppkey % 4)::int AS zmax,
           -180 + (s_suppkey * 37 % 300)::double AS "left", -140 + (s_suppkey * 37 % 300)::double AS "right",
           90 - (s_suppkey * 17 % 140)::double AS top, 60 - (s_suppkey * 17 % 140)::double AS bottom,
           (s_suppkey % 2)::int AS usebound FROM supplier"""
TILE_RANGES = """
    SELECT id, z::int AS z,
        least(trunc(("left" + 180) / (360::double / (pow(2, z) * 256)))::int // 256, pow(2, z)::int - 1)::int AS xmin,
        least(trunc(("right" + 180) / (360::double / (pow(2, z) * 256)))::int // 256, pow(2, z)::int - 1)::int AS xmax,
        least(trunc((90 - top) / (360::double / (pow(2, z) * 256)))::int // 256, greatest(1, pow(2, z)::int // 2) - 1)::int AS ymin,
        least(trunc((90 - bottom) / (360::double / (pow(2, z) * 256)))::int // 256, greatest(1, pow(2, z)::int // 2) - 1)::int AS ymax
    FROM ext, range(22) AS t(z) WHERE z BETWEEN zmin AND zmax"""
TILE_KEYS = """
    SELECT id, z, y::int AS y, x::int AS x FROM (
        SELECT id, z, unnest(range(ymin, ymax + 1)) AS y, xmin, xmax FROM rng) r,
        LATERAL (SELECT unnest(range(r.xmin, r.xmax + 1)) AS x)"""


def supplier_extents(d):
    k = F.col("s_suppkey")
    return d.table("supplier").select(
        k.cast("int").alias("id"),
        F.lit(0).alias("zmin"),
        (2 + k % 4).cast("int").alias("zmax"),
        (-180.0 + k * 37 % 300).alias("left"),
        (-140.0 + k * 37 % 300).alias("right"),
        (90.0 - k * 17 % 140).alias("top"),
        (60.0 - k * 17 % 140).alias("bottom"),
        (k % 2).cast("int").alias("usebound"),
    )


@query("pyramid_keys", f"WITH ext AS ({SUPPLIER_EXTENTS}), rng AS ({TILE_RANGES}) {TILE_KEYS}")
def pyramid_keys(d):
    """All tiles of each extent from level 0 to its deepest level."""
    return pyramid.enumerate_tiles(supplier_extents(d), ["id"])


@query("pyramid_bounded", f"""
    WITH ext AS (SELECT id, 1 AS zmin, 4 AS zmax,
                 CASE WHEN usebound = 1 THEN "left" ELSE -180 END AS "left",
                 CASE WHEN usebound = 1 THEN "right" ELSE 180 END AS "right",
                 CASE WHEN usebound = 1 THEN top ELSE 90 END AS top,
                 CASE WHEN usebound = 1 THEN bottom ELSE -90 END AS bottom FROM ({SUPPLIER_EXTENTS})),
         rng AS ({TILE_RANGES})
    SELECT id, z, count(*) AS tiles, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax
    FROM ({TILE_KEYS}) GROUP BY id, z""")
def pyramid_bounded(d):
    """Pyramids limited to a box where the request asks for it."""
    requests = supplier_extents(d).withColumns({"zmin": F.lit(1), "zmax": F.lit(4)})
    tiles = pyramid.enumerate_tiles(pyramid.bounded_extents(requests, ["id"]), ["id"])
    return tiles.groupBy("id", "z").agg(
        F.count(F.lit(1)).alias("tiles"),
        F.min("x").alias("xmin"), F.max("x").alias("xmax"),
        F.min("y").alias("ymin"), F.max("y").alias("ymax"),
    )


@query("pyramid_rollup", f"""
    SELECT z::int AS z, y, x, sum(n)::bigint AS n FROM (
        SELECT z, y // pow(2, {Z} - z)::int AS y, x // pow(2, {Z} - z)::int AS x, 1 AS n
        FROM (SELECT {STRICT_X} AS x, {STRICT_Y} AS y FROM points), range(3, {Z} + 1) AS t(z))
    GROUP BY z, y, x""", ("points",))
def pyramid_rollup(d):
    """Tile counts at level 5 rolled up two levels."""
    tile = grid.strict_tile("lon", "lat", F.lit(Z))
    base = d.points().select(tile.alias("t")).groupBy(
        F.lit(Z).alias("z"), F.col("t.y").alias("y"), F.col("t.x").alias("x")
    ).agg(F.count(F.lit(1)).alias("n"))
    return pyramid.roll_up(base, ["n"], 2)


@query("roi_extent", """
    WITH one AS (
        SELECT roi_id, min(x0) * (360::double / 64) - 180 AS "left",
               (max(x1) + 1) * (360::double / 64) - 180 AS "right",
               90 - min(grow) * (360::double / 64) AS top, 90 - (max(grow) + 1) * (360::double / 64) AS bottom
        FROM roi_segments GROUP BY roi_id),
    pairs AS (
        SELECT c_custkey AS order_id, 'sys:' || c_nationkey AS roi_id FROM customer
        UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'sys:' || (c_nationkey + 1) % 25 END FROM customer),
    cut AS (
        SELECT order_id, greatest(-180, max("left")) AS "left", least(180, min("right")) AS "right",
               least(90, min(top)) AS top, greatest(-90, max(bottom)) AS bottom
        FROM pairs LEFT JOIN one USING (roi_id) GROUP BY order_id)
    SELECT order_id, greatest(-180, "left" - 0.703125::double) AS "left", least(180, "right" + 0.703125::double) AS "right",
           least(90, top + 0.703125::double) AS top, greatest(-90, bottom - 0.703125::double) AS bottom FROM cut""",
       ("roi_segments",))
def roi_extent(d):
    """Common extent of each order's regions, grown by half a coarse pixel."""
    c, n = F.col("c_custkey"), F.col("c_nationkey")
    customers = d.table("customer")

    def roi(number):
        return F.concat(F.lit("sys:"), number.cast("string"))

    wanted = customers.select(c.alias("order_id"), roi(n).alias("roi_id")).unionByName(
        customers.select(
            c.alias("order_id"), F.when(c % 3 == 0, "").otherwise(roi((n + 1) % 25)).alias("roi_id")
        )
    )
    corners = extents.segment_extents(d.roi_segments(), TILE)
    cut = extents.intersect(wanted, corners, ["order_id"])
    grown = grid.expand_half_pixel("left", "right", "top", "bottom")
    return cut.select("order_id", grown.alias("e")).select("order_id", "e.*")


@query("input_compat", """
    SELECT o_orderkey // 4 AS order_id, count(DISTINCT proj) AS projections, min(maxZoom) AS max_zoom,
           (CASE WHEN count(pid) < count(*) THEN 21 WHEN count(DISTINCT proj) > 1 THEN 22 ELSE 0 END)::int AS state
    FROM orders LEFT JOIN product ON name = CASE WHEN (o_custkey % 110) % 5 = 0 THEN '/user/' || (o_custkey % 110)
                        ELSE 'sys/Supplier#' || lpad((o_custkey % 110)::varchar, 9, '0') END
    GROUP BY ALL""", ("product",))
def input_compat(d):
    """Projection check and deepest common level over each job's datasets."""
    k = F.col("o_custkey") % 110
    name = F.when(k % 5 == 0, F.concat(F.lit("/user/"), k.cast("string"))).otherwise(
        F.concat(F.lit("sys/Supplier#"), F.lpad(k.cast("string"), 9, "0"))
    )
    inputs = d.table("orders").select(
        F.floor(F.col("o_orderkey") / 4).alias("order_id"), name.alias("dsname")
    )
    return extents.input_compatibility(inputs, d.product(), ["order_id"])


@query("rowkey_hex", """
    SELECT event_id,
        printf('%02x', (event_id * 3 % 1000 + event_id % 500) % 10) || right(printf('%08x', event_id % 120), 2)
            || printf('%02x%04x%04x', event_id % 22, event_id % 500, event_id * 3 % 1000) AS key_1_2,
        printf('%02x%08x%02x%08x%08x', (event_id * 3 % 1000 + event_id % 500) % 10, event_id, event_id % 22,
            event_id % 500, event_id * 3 % 1000) AS key_4_4,
        printf('%02x%08x%02x%04x%04x', 3, event_id, event_id % 22, event_id % 500, event_id * 3 % 1000) AS key_given
    FROM events""")
def rowkey_hex(d):
    """Row keys in two layouts and with a given bucket, as hex text."""
    e = F.col("event_id")
    hpid, z, y, x = e % 120, e % 22, e % 500, (e * 3) % 1000

    def text(column):
        return F.lower(F.hex(column))

    return d.table("events").select(
        "event_id",
        text(rowkey.encode(hpid, z, y, x, 1, 2)).alias("key_1_2"),
        text(rowkey.encode(e, z, y, x, 4, 4)).alias("key_4_4"),
        text(rowkey.encode(e, z, y, x, 4, 2, bucket_id=3)).alias("key_given"),
    )


@query("rowkey_decode", """
    SELECT event_id, ((y + x) % 10)::int AS bucket, hpid, z, y, x, 1 AS bad_is_null FROM (
        SELECT event_id, (event_id - 5000)::int AS hpid, (event_id % 22)::int AS z,
               (event_id % 500)::int AS y, (event_id * 3 % 1000)::int AS x FROM events)""")
def rowkey_decode(d):
    """Round trip through the key, with lengths taken from columns."""
    e = F.col("event_id")
    rows = d.table("events").select(
        "event_id", (e - 5000).alias("hpid"), (e % 22).alias("z"), (e % 500).alias("y"),
        (e * 3 % 1000).alias("x"), F.when(e % 2 == 0, 2).otherwise(4).alias("yx_len"),
    )
    key = rowkey.encode("hpid", "z", "y", "x", 4, "yx_len")
    return rows.select("event_id", "yx_len", key.alias("key")).select(
        "event_id", rowkey.decode("key", 4, "yx_len").alias("k"),
        rowkey.decode(F.concat("key", F.unhex(F.lit("00"))), 4, "yx_len").isNull().cast("int").alias("bad_is_null"),
    ).select("event_id", "k.*", "bad_is_null")


@query("bucket_balance", f"""
    SELECT (x + y) % 10 AS bucket, count(*) AS n
    FROM (SELECT {STRICT_X} AS x, {STRICT_Y} AS y FROM points) GROUP BY ALL""", ("points",))
def bucket_balance(d):
    """Rows per salt value."""
    tile = grid.strict_tile("lon", "lat", F.lit(Z))
    return (
        d.points().withColumn("t", tile)
        .groupBy(rowkey.bucket("t.y", "t.x").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    )
