"""Pixel, region and style queries in long and packed form."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from rastergrid.functions import pixel_types
from rastergrid.functions.columns import idiv
from rastergrid.joins import save
from rastergrid.operators import pixels as px
from rastergrid.operators import pyramid, regions, style
from rastergrid.plans.export import block_rows, export_blocks

from .base import query
from .catalog import STYLES, style_rows
from .derived import LEVEL, TILE

FILL = 255
PIXEL = ["hpid", "band", "grow", "gcol"]
CELL = ["hpid", "z", "y", "x", "dt"]
START, STOP = 19960000000000, 20001200000000


def decoded(tiles, keys, bands, type_code=1, skip=FILL):
    rows = px.unpack_tiles(tiles, [*keys, "y", "x"], bands, TILE, TILE, type_code, skip=skip)
    return px.with_level_position(rows, TILE, TILE).select(*keys, "band", "grow", "gcol", "dn")


@query("pack_unpack", "SELECT hpid, dt, band, grow, gcol, dn FROM pixels", ("pixels",))
def pack_unpack(d):
    """Pixels packed into u8 blocks and taken apart again."""
    return decoded(d.tile_cells(), ["hpid", "dt"], 2)


@query("pixel_decode", """
    SELECT doc_id, ('0x' || substr(h, 2 * i8 + 1, 2))::bigint::double AS u8,
           ('0x' || substr(h, 4 * i16 + 3, 2) || substr(h, 4 * i16 + 1, 2))::bigint::double AS u16,
           CASE WHEN v >= 2147483648 THEN v - 4294967296 ELSE v END::double AS i32, 1 AS outside_is_null, 0::double AS outside_zero
    FROM (SELECT *, CASE WHEN n >= 4 THEN ('0x' || substr(h, 8 * i32 + 7, 2) || substr(h, 8 * i32 + 5, 2) || substr(h, 8 * i32 + 3, 2) || substr(h, 8 * i32 + 1, 2))::bigint END AS v
          FROM (SELECT doc_id, hex(encode(text)) AS h, octet_length(encode(text)) AS n,
                doc_id * 31 % octet_length(encode(text)) AS i8, doc_id * 37 % greatest(octet_length(encode(text)) // 2, 1) AS i16,
                doc_id * 41 % greatest(octet_length(encode(text)) // 4, 1) AS i32 FROM documents))""")
def pixel_decode(d):
    """Numbers of several types decoded at a position of whole binary blocks."""
    docs = d.table("documents").select("doc_id", F.col("text").cast("binary").alias("data"))
    n = F.octet_length("data")

    def at(code, factor, size):
        count = F.greatest(idiv(n, size), F.lit(1)).cast("int")
        col = (F.col("doc_id") * factor % count).cast("int")
        return pixel_types.pixel_value("data", code, count, 1, 1, 0, 0, col)

    outside = pixel_types.pixel_value("data", 1, n, 1, 1, 0, 0, n)
    zero = pixel_types.pixel_value("data", 1, n, 1, 1, 0, 0, n, strict_zero=True)
    return docs.select(
        "doc_id", at(1, 31, 1).alias("u8"), at(2, 37, 2).alias("u16"), at(5, 41, 4).alias("i32"),
        outside.isNull().cast("int").alias("outside_is_null"), zero.alias("outside_zero"),
    )


# Type code, value to store as Spark and as SQL; each type gets values that a narrower one could not hold.
TYPED = [
    (2, lambda v: v * 1000, "dn * 1000"), (3, lambda v: v * 600 - 15000, "dn * 600 - 15000"), (4, lambda v: v * 80000000, "dn * 80000000"),
    (5, lambda v: v * 40000000 - 1000000000, "dn * 40000000 - 1000000000"), (6, lambda v: v / 8 - 2, "dn / 8 - 2"), (7, lambda v: v / 3 - 1, "dn / 3 - 1"),
]


@query("pixel_types", " UNION ALL ".join(
    f"SELECT {code} AS code, hpid, dt, band, grow, gcol, ({sql})::double AS dn, ({sql})::double AS looked_up FROM pixels" for code, _, sql in TYPED
), ("pixels",))
def pixel_types_query(d):
    """Pixels packed as every type of more than a byte, unpacked, and looked up in the blocks one by one."""
    results = None
    # Positions that are not known have no tile to be looked up in.
    rows = save(d.pixels().dropna(subset=CELL), "typed-pixels")
    for code, value, _ in TYPED:
        typed = rows.select(
            "hpid", "z", "y", "x", "dt", "band", (F.col("grow") % TILE).alias("row"), (F.col("gcol") % TILE).alias("col"), value(F.col("dn")).alias("dn")
        )
        tiles = px.pack_tiles(typed, CELL, 2, TILE, TILE, code, -9 if code in (3, 5, 6, 7) else 9)
        pixels = px.unpack_tiles(tiles, CELL, 2, TILE, TILE, code, skip=-9 if code in (3, 5, 6, 7) else 9, carry=("data",))
        looked = pixel_types.pixel_value("data", code, TILE, TILE, 2, "band", "row", "col")
        both = px.with_level_position(pixels, TILE, TILE).select(
            F.lit(code).alias("code"), "hpid", "dt", "band", "grow", "gcol", F.col("dn").cast("double").alias("dn"), looked.alias("looked_up")
        )
        results = both if results is None else results.unionByName(both)
    return results


BAND_OF_PLANE = """
    SELECT hPid AS hpid, bsqIndex AS band, arg_min(scale, pid * 100 + bindex) AS scale, arg_min("offset", pid * 100 + bindex) AS "offset",
           arg_min(validMin, pid * 100 + bindex) AS validMin, arg_min(validMax, pid * 100 + bindex) AS validMax, arg_min(noData, pid * 100 + bindex) AS noData
    FROM product_band GROUP BY ALL"""


def band_of_plane(d):
    """The first band defined on each stored plane."""
    names = ["scale", "offset", "validMin", "validMax", "noData"]
    return (
        d.product_band().groupBy(F.col("hPid").alias("hpid"), F.col("bsqIndex").alias("band"))
        .agg(F.min(F.struct("pid", "bindex", *names)).alias("b"))
        .select("hpid", "band", *(f"b.{n}" for n in names))
    )


@query("physical_values", f"""
    SELECT p.hpid, p.band, dt, grow, gcol, scale * dn + "offset" AS physical FROM pixels p LEFT JOIN ({BAND_OF_PLANE}) b USING (hpid, band)""",
       ("pixels", "product_band"))
def physical_values(d):
    """Scaled values of all pixels."""
    return px.physical(d.pixels(), band_of_plane(d)).select(*PIXEL, "dt", "physical")


@query("valid_mask", f"""
    SELECT p.hpid, p.band, count(*) AS n, count(CASE WHEN dn BETWEEN validMin AND validMax AND dn <> noData THEN 1 END) AS valid,
           sum(CASE WHEN dn BETWEEN validMin AND validMax AND dn <> noData THEN dn END)::bigint AS total
    FROM pixels p LEFT JOIN ({BAND_OF_PLANE}) b USING (hpid, band) GROUP BY ALL""", ("pixels", "product_band"))
def valid_mask(d):
    """Valid pixels per plane and band."""
    known = d.pixels().join(band_of_plane(d), ["hpid", "band"], "left")
    value = px.valid_dn("dn", F.col("validMin"), F.col("validMax"), F.col("noData"))
    return known.withColumn("valid_", value).groupBy("hpid", "band").agg(
        F.count(F.lit(1)).alias("n"), F.count("valid_").alias("valid"), F.sum("valid_").cast("bigint").alias("total")
    )


def _composites():
    functions = {"min": "min", "max": "max", "ave": "avg"}
    for method, name in functions.items():
        value = f"coalesce({name}(CASE WHEN dn BETWEEN 5 AND 45 THEN dn END), -1)"

        def long_form(d, method=method):
            """Composite of pixel rows over a date range."""
            return px.composite(d.pixels(), PIXEL, method, START, STOP, 5.0, 45.0, -1.0)

        query(f"composite_{method}", f"""
            SELECT hpid, band, grow, gcol, {value} AS dn FROM pixels WHERE dt BETWEEN {START} AND {STOP} GROUP BY ALL""",
              ("pixels",))(long_form)

        def packed(d, method=method):
            """The same from packed tiles, reduced in map tasks first."""
            cells = d.tile_cells().filter(F.col("dt").between(START, STOP))
            blocks = px.composite_tiles(cells, ["hpid", "z", "y", "x"], method, 5.0, 45.0, -1.0, 1, out_type=7)
            return decoded(blocks, ["hpid"], 2, 7, skip=-1.0)

        query(f"composite_tiles_{method}", f"""
            SELECT * FROM (SELECT hpid, band, grow, gcol, {value} AS dn FROM pixels WHERE dt BETWEEN {START} AND {STOP} GROUP BY ALL) WHERE dn <> -1""",
              ("pixels",))(packed)


_composites()

@query("overview_blocks", "SELECT hpid, z, dt, band, grow, gcol, dn FROM pyramid_pixels", ("pixels", "pyramid_pixels"))
def overview_blocks(d):
    """All levels of the pyramid as blocks made level by level, each pixel the largest of those below it."""
    blocks = pyramid.overviews(d.tile_cells(), ["htable", "hpid", "dt"], LEVEL, 2, TILE, 1, "max", FILL)
    return px.with_level_position(px.unpack_tiles(blocks, CELL, 2, TILE, TILE, 1, skip=FILL), TILE, TILE).select(
        "hpid", "z", "dt", "band", "grow", "gcol", "dn"
    )


ZONAL = """
    SELECT roi_id, hpid, band, dt, count(*) AS n, sum(dn) AS total, min(dn) AS low, max(dn) AS high, avg(dn) AS ave
    FROM pixels p JOIN roi_segments s ON p.z = s.level AND p.grow = s.grow AND p.gcol BETWEEN s.x0 AND s.x1
    WHERE dn BETWEEN 0 AND 40 GROUP BY ALL"""


def zonal_rows(d):
    return px.zonal(d.pixels(), d.roi_segments(), TILE, ["hpid", "band", "dt"], 0.0, 40.0)


@query("zonal_stats", ZONAL, ("pixels", "roi_segments"))
def zonal_stats(d):
    """Statistics per region, plane, band and date."""
    return zonal_rows(d)


@query("zonal_tiles", f"SELECT roi_id, hpid, dt, n, total, low, high, ave FROM ({ZONAL}) WHERE band = 1", ("pixels", "roi_segments"))
def zonal_tiles(d):
    """The same for one band, straight from packed tiles."""
    region_tiles = regions.by_tile(d.roi_segments(), TILE)
    return regions.zonal_tiles(d.tile_cells(), region_tiles, ["hpid", "dt"], 1, 0.0, 40.0, TILE, TILE, 1)


@query("series_stats", f"""
    SELECT roi_id, hpid, band, dt, ave, (row_number() OVER w)::int AS step, ave - lag(ave) OVER w AS change
    FROM ({ZONAL}) WINDOW w AS (PARTITION BY roi_id, hpid, band ORDER BY dt)""", ("pixels", "roi_segments"))
def series_stats(d):
    """Means in date order with their change."""
    return px.series(zonal_rows(d), ["roi_id", "hpid", "band"]).select(
        "roi_id", "hpid", "band", "dt", "ave", "step", "change"
    )


@query("export_grid", """
    WITH o AS (SELECT s_suppkey AS order_id, (s_suppkey // 25)::int AS hpid, (1996 + s_suppkey % 4) * 10000000000 + (1 + s_suppkey % 12) * 100000000 AS dt,
                      -180 + (s_suppkey * 37 % 300) AS l, 90 - (s_suppkey * 17 % 140) AS t FROM supplier),
    g AS (SELECT order_id, hpid, dt, band, grow, gcol FROM o, range(2) AS b(band), range(32) AS a(grow), range(64) AS c(gcol)
          WHERE grow >= floor((90 - t) / 5.625::double) AND grow < ceil((120 - t) / 5.625::double)
            AND gcol >= floor((l + 180) / 5.625::double) AND gcol < ceil((l + 220) / 5.625::double)),
    tiles AS (SELECT DISTINCT hpid, dt, y, x FROM pixels)
    SELECT order_id, g.grow::int AS grow, count(*) AS n,
           sum(CASE WHEN p.dn IS NOT NULL THEN p.dn WHEN t.y IS NOT NULL THEN 255 ELSE 7 END)::bigint AS total
    FROM g LEFT JOIN pixels p ON p.hpid = g.hpid AND p.dt = g.dt AND p.band = g.band AND p.grow = g.grow AND p.gcol = g.gcol
    LEFT JOIN tiles t ON t.hpid = g.hpid AND t.dt = g.dt AND t.y = g.grow // 16 AND t.x = g.gcol // 16
    GROUP BY ALL""", ("pixels",))
def export_grid_query(d):
    """Mosaics of boxes at level 2 in blocks of 10 pixels, cut to the box; tiles that are not stored hold the fill value."""
    k = F.col("s_suppkey")
    hpid = idiv(k, 25).cast("int")
    left, top = -180.0 + k * 37 % 300, 90.0 - k * 17 % 140
    orders = d.table("supplier").select(
        k.alias("order_id"), F.concat(F.lit("ht"), (hpid % 5).cast("string")).alias("htable"), hpid.alias("hpid"),
        ((1996 + k % 4) * 10000000000 + (1 + k % 12) * 100000000).alias("dt"), F.lit(LEVEL).alias("level"),
        left.alias("left"), (left + 40.0).alias("right"), top.alias("top"), (top - 30.0).alias("bottom"),
    )
    blocks = export_blocks(orders, d.tile_cells(), ["order_id"], 2, TILE, 1, 7, block=10)
    rows = block_rows(blocks, ["order_id"], 2, 1)
    return rows.groupBy("order_id", "grow").agg(F.sum("n").alias("n"), F.sum("total").cast("bigint").alias("total"))


def _colored(rows, color):
    return rows.withColumn("c", color).select(*PIXEL, "dt", "c.r", "c.g", "c.b", "c.a")


@query("style_discrete", """
    SELECT hpid, band, grow, gcol, dt, 0 AS r, (least(trunc(dn / 25), 9) * 25)::int AS g, 0 AS b, 255 AS a FROM pixels""", ("pixels",))
def style_discrete(d):
    """The green ramp on all pixels."""
    return _colored(d.pixels(), style.discrete(F.col("dn"), style.GREEN_RAMP))


@query("style_linear", """
    SELECT hpid, band, grow, gcol, dt, v AS r, v AS g, v AS b, 255 AS a FROM (
        SELECT *, CASE WHEN dn <= 1 THEN 0 ELSE floor(255 * ((dn - 1.0::double) / 254) + 0.5::double) END::int AS v FROM pixels)""", ("pixels",))
def style_linear(d):
    """Black to white on all pixels."""
    return _colored(d.pixels(), style.linear(F.col("dn"), style.GRAY_LINEAR))


@query("style_exact", """
    SELECT hpid, band, grow, gcol, dt, (CASE WHEN dn = 7 THEN 10 WHEN dn = 21 THEN 20 ELSE 0 END)::int AS r, 0 AS g, 0 AS b,
           (CASE WHEN dn IN (7, 21) THEN 255 ELSE 0 END)::int AS a FROM pixels""", ("pixels",))
def style_exact(d):
    """Two values coloured, all others transparent."""
    stops = [{"val": 7.0, "r": 10, "g": 0, "b": 0, "a": 255}, {"val": 21.0, "r": 20, "g": 0, "b": 0, "a": 255}]
    return _colored(d.pixels(), style.exact(F.col("dn"), stops))


@query("style_stretch", """
    SELECT hpid, grow, gcol, dt, v0 AS r, v1 AS g, v0 AS b, 255 AS a, v0 AS gray FROM (
        SELECT hpid, grow, gcol, dt, greatest(0, least(255, floor((max(CASE WHEN band = 0 THEN dn END) - 10) / 30::double * 255 + 0.5::double)))::int AS v0,
               greatest(0, least(255, floor((max(CASE WHEN band = 1 THEN dn END) - 0) / 40::double * 255 + 0.5::double)))::int AS v1
        FROM pixels GROUP BY hpid, grow, gcol, dt HAVING count(DISTINCT band) = 2)""", ("pixels",))
def style_stretch(d):
    """Gray and red-green-blue from stretched bands, where both bands were seen."""
    both = px.pivot_bands(d.pixels(), ["hpid", "grow", "gcol", "dt"], 2).filter("b0 IS NOT NULL AND b1 IS NOT NULL")
    b0, b1 = F.col("b0"), F.col("b1")
    rgb = style.composed([b0, b1, b0], [(10, 40), (0, 40), (10, 40)])
    gray = style.composed([b0], [(10, 40)])
    return both.withColumns({"c": rgb, "q": gray}).select("hpid", "grow", "gcol", "dt", "c.*", F.col("q.r").alias("gray"))


def _stretched(value, low, high):
    return (
        f"CASE WHEN {high} = {low} THEN CASE WHEN {value} >= {low} THEN 255 ELSE 0 END "
        f"ELSE greatest(0, least(255, floor(({value} - {low}) / ({high} - {low}) * 255 + 0.5::double))) END"
    )


def _composed(values):
    """SQL of the parts of a colour from bands, each stretched by the range of its place; all 0 where a band is missing."""
    ranges = [("5::double", "(styleid % 40 + 5)::double"), ("0::double", "40::double"), ("10::double", "30::double"), ("0::double", "50::double")]
    known = " AND ".join(f"{v} IS NOT NULL" for v in set(values))
    parts = [_stretched(v, *ranges[k]) for k, v in enumerate(values)]
    parts = parts * 3 if len(parts) == 1 else parts
    return [f"CASE WHEN {known} THEN {part} ELSE 0 END" for part in (parts if len(parts) == 4 else [*parts, "255"])]


def _table_part(k, part):
    mixed = f"floor(lo.{part} + (hi.{part} - lo.{part}) * ((dn - lv) / (hv - lv)) + 0.5::double)"
    return f"""(CASE kind WHEN 'discrete' THEN coalesce(lo.{part}, 0) WHEN 'exact' THEN coalesce(same.{part}, 0)
        WHEN 'linear' THEN CASE WHEN lv IS NULL THEN hi.{part} WHEN hv IS NULL THEN lo.{part} ELSE {mixed} END
        WHEN 'gray' THEN {_composed(['b1'])[k]} WHEN 'rgb' THEN {_composed(['b1', 'b0', 'b1'])[k]}
        WHEN 'rgba' THEN {_composed(['b0', 'b1', 'b0', 'b1'])[k]} ELSE 0 END)::int AS {part}"""


@query("style_table", f"""
    WITH st AS ({STYLES}),
    p AS (SELECT *, 1 + (hpid * 7 + grow) % 90 AS styleid, max(CASE WHEN band = 0 THEN dn END) OVER w AS b0, max(CASE WHEN band = 1 THEN dn END) OVER w AS b1
          FROM pixels WINDOW w AS (PARTITION BY hpid, grow, gcol, dt)),
    found AS (
        SELECT p.hpid, p.band, p.grow, p.gcol, p.dt, p.dn, p.styleid, p.b0, p.b1, any_value(s.type) AS kind,
               arg_max({{'r': s.r, 'g': s.g, 'b': s.b, 'a': s.a}}, s.val) FILTER (s.val <= p.dn) AS lo, max(s.val) FILTER (s.val <= p.dn) AS lv,
               arg_min({{'r': s.r, 'g': s.g, 'b': s.b, 'a': s.a}}, s.val) FILTER (s.val > p.dn) AS hi, min(s.val) FILTER (s.val > p.dn) AS hv,
               any_value({{'r': s.r, 'g': s.g, 'b': s.b, 'a': s.a}}) FILTER (s.val = p.dn) AS same
        FROM p LEFT JOIN st s USING (styleid) GROUP BY ALL)
    SELECT hpid, band, grow, gcol, dt, {", ".join(_table_part(k, part) for k, part in enumerate("rgba"))} FROM found""", ("pixels",))
def style_table(d):
    """Pixels coloured by styles of all six types from a table; gray, rgb and rgba take both bands of a position."""
    bands = px.pivot_bands(d.pixels(), ["hpid", "grow", "gcol", "dt"], 2)
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("band"), F.col(f"b{k}").alias("dn")) for k in range(2))))
    rows = bands.select("hpid", "grow", "gcol", "dt", F.array("b0", "b1").alias("both"), each.alias("one")).select("*", "one.*").filter("dn IS NOT NULL")
    rows = rows.withColumn("styleid", F.lit(1) + (F.col("hpid") * 7 + F.col("grow")) % 90)
    return style.apply_styles(rows, style.parse_styles(style_rows(d)), values="both").select(*PIXEL, "dt", "color.*")


@query("band_expr", """
    SELECT hpid, grow, gcol, dt, (b1 - b0) / (b1 + b0 + 0.5::double) * 2::double AS dn FROM (
        SELECT hpid, grow, gcol, dt, max(CASE WHEN band = 0 THEN dn END) AS b0, max(CASE WHEN band = 1 THEN dn END) AS b1
        FROM pixels GROUP BY ALL)""", ("pixels",))
def band_expr(d):
    """A ratio of bands as SQL text with named parameters."""
    bands = px.pivot_bands(d.pixels(), ["hpid", "grow", "gcol", "dt"], 2)
    return px.band_expression(bands, "(b1 - b0) / (b1 + b0 + soil) * gain", {"soil": 0.5, "gain": 2.0}).select(
        "hpid", "grow", "gcol", "dt", "dn"
    )


CLIP = """
    SELECT p.hpid, p.band, p.grow, p.gcol, p.dt, CASE WHEN s.x0 IS NULL THEN 99 ELSE dn END::double AS dn
    FROM pixels p LEFT JOIN roi_segments s ON s.roi_id = 'sys:' || (p.hpid % 30) AND s.level = p.z AND s.grow = p.grow AND p.gcol BETWEEN s.x0 AND s.x1"""


@query("roi_clip", CLIP, ("pixels", "roi_segments"))
def roi_clip(d):
    """Pixels of each plane clipped by a region of its own."""
    named = d.pixels().withColumn("roi", F.concat(F.lit("sys:"), (F.col("hpid") % 30).cast("string")))
    return regions.clip(named, d.roi_segments(), "roi", TILE, 99.0).select(*PIXEL, "dt", "dn")


@query("roi_clip_tiles", f"SELECT hpid, band, grow, gcol, dt, dn FROM ({CLIP}) WHERE dn <> 99", ("pixels", "roi_segments"))
def roi_clip_tiles(d):
    """The same on packed tiles."""
    named = d.tile_cells().select(
        *CELL, "data", F.concat(F.lit("sys:"), (F.col("hpid") % 30).cast("string")).alias("roi_id"), F.lit(255.0).alias("fill")
    )
    clipped = regions.clip_tiles(named, regions.by_tile(d.roi_segments(), TILE), TILE, TILE, 1)
    return decoded(clipped, ["hpid", "dt"], 2)


@query("segment_levels", """
    WITH px AS (SELECT roi_id, grow, unnest(range(x0, x1 + 1)) AS gcol FROM roi_segments),
    up AS (SELECT DISTINCT roi_id, grow // 2 AS grow, gcol // 2 AS gcol FROM px)
    SELECT roi_id, 1 AS level, grow::int AS grow, count(*) AS n FROM up GROUP BY ALL
    UNION ALL SELECT roi_id, 2, grow::int, count(*) FROM px GROUP BY ALL
    UNION ALL SELECT roi_id, 3, (grow * 2 + k)::int, count(*) * 2 FROM px, range(2) AS t(k) GROUP BY roi_id, grow, k""", ("roi_segments",))
def segment_levels(d):
    """Regions carried to a coarser and a finer level, as pixels per row."""
    rows = regions.at_levels(d.roi_segments(), 1, 3)
    return rows.groupBy("roi_id", "level", "grow").agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("n"))


POLYGON = """
    SELECT c_custkey AS id, lon0 + dx AS lon, lat0 + dy AS lat, lon0 + nx AS lon2, lat0 + ny AS lat2 FROM (
        SELECT c_custkey, -170 + c_custkey * 53 % 300 AS lon0, -70 + c_custkey * 31 % 130 AS lat0, c_custkey % 23 + 9 AS w, c_custkey % 17 + 5 AS h FROM customer) c,
        LATERAL (SELECT * FROM (VALUES (0, 0, w, h // 3), (w, h // 3, w // 2, h), (w // 2, h, w // 4, h // 2), (w // 4, h // 2, 0, 0)) AS v(dx, dy, nx, ny))"""


@query("polygon_segments", f"""
    WITH e AS (SELECT id, (lon + 180) / 5.625::double AS px, (90 - lat) / 5.625::double AS py, (lon2 + 180) / 5.625::double AS qx, (90 - lat2) / 5.625::double AS qy FROM ({POLYGON})),
    x AS (SELECT id, grow, px + (grow + 0.5::double - py) * (qx - px) / (qy - py) AS cx FROM e, range(32) AS r(grow)
          WHERE py <> qy AND grow + 0.5::double >= least(py, qy) AND grow + 0.5::double < greatest(py, qy))
    SELECT 'p' || id AS roi_id, grow::int AS grow, count(*) AS n FROM (
        SELECT id, grow, gcol FROM x, range(64) AS c(gcol) WHERE cx <= gcol + 0.5::double GROUP BY id, grow, gcol HAVING count(*) % 2 = 1)
    GROUP BY ALL""")
def polygon_segments(d):
    """Row segments of concave outlines against a test of every pixel centre."""
    k = F.col("c_custkey")
    w, h = k % 23 + 9, k % 17 + 5
    corners = [(F.lit(0), F.lit(0)), (w, idiv(h, 3)), (idiv(w, 2), h), (idiv(w, 4), idiv(h, 2))]
    vertices = d.table("customer").select(
        k,
        F.posexplode(
            F.array(
                *(
                    F.struct(
                        (F.lit(-170) + k * 53 % 300 + dx).cast("double").alias("lon"),
                        (F.lit(-70) + k * 31 % 130 + dy).cast("double").alias("lat"),
                    )
                    for dx, dy in corners
                )
            )
        ).alias("seq", "v"),
    ).select(F.concat(F.lit("p"), k.cast("string")).alias("roi_id"), F.lit(0).alias("ring"), "seq", "v.lon", "v.lat")
    segments = regions.polygon_segments(vertices, LEVEL, TILE)
    return segments.groupBy("roi_id", "grow").agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("n"))


@query("tile_map", """
    SELECT hpid, dt, 0 AS band, grow, gcol, ((b1 - b0)::float / (b1 + b0)::float)::double AS dn FROM (
        SELECT hpid, dt, grow, gcol, max(CASE WHEN band = 0 THEN dn END) AS b0, max(CASE WHEN band = 1 THEN dn END) AS b1 FROM pixels GROUP BY ALL)
    WHERE b0 IS NOT NULL AND b1 IS NOT NULL""", ("pixels",))
def tile_map(d):
    """A normalised difference by numpy on packed tiles, as 4-byte floats."""

    def ratio(tile):
        b = tile.astype("<f4")
        seen = (tile != FILL).all(axis=0)
        return np.where(seen, (b[1] - b[0]) / np.maximum(b[1] + b[0], 1), -9)[None]

    tiles = px.map_tiles(d.tile_cells(), CELL, ratio, 2, TILE, TILE, 1, out_type=6)
    return decoded(tiles.filter("status = 0"), ["hpid", "dt"], 1, 6, skip=-9)


@query("tile_reduce", "SELECT hpid, band, grow, gcol, sum(dn) AS dn FROM pixels GROUP BY ALL", ("pixels",))
def tile_reduce(d):
    """A numpy function over all dates of each tile."""

    def total(dates, series):
        return np.where(series == FILL, 0, series).sum(axis=0, dtype=np.int64)

    tiles = px.reduce_dates(d.tile_cells(), ["hpid", "y", "x"], total, 2, TILE, TILE, 1, out_type=5)
    return decoded(tiles, ["hpid"], 2, 5, skip=0)
