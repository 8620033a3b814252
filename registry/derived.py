"""Raster, catalog and request tables derived from the driver tables.

The driver tables hold no rasters, so each engine table is a deterministic formula
over them, written once as a DataFrame and once as SQL. Sizes grow with the driver
tables; only the region tables (nations) and the grid itself are fixed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastergrid.functions.columns import idiv
from rastergrid.operators import pixels as px
from rastergrid.operators.pyramid import overviews

TILE = 16
LEVEL = 2
RUN_STAMP = "2024-02-01 03:04:05"

SQL = {
    "points": """
        SELECT event_id, ((event_id * 7919) % 36001) / 100::double - 180 AS lon,
               ((event_id * 104729) % 18001) / 100::double - 90 AS lat, value
        FROM events""",
    "product": """
        SELECT s_suppkey::int AS pid,
               CASE WHEN s_suppkey % 5 = 0 THEN '/user/' || s_suppkey ELSE 'sys/' || s_name END AS name,
               CASE WHEN s_suppkey % 25 = 24 THEN 'EPSG:3857' ELSE 'EPSG:4326' END AS proj,
               0 AS minZoom, (1 + s_suppkey % 4)::int AS maxZoom,
               1 AS dataType, (1 + s_suppkey % 7)::int AS timeType,
               'ht' || ((s_suppkey // 25) % 5) AS hTableName, 16 AS tileWid, 16 AS tileHei,
               'deflate' AS compress, (s_suppkey % 3)::int AS styleid, (s_suppkey % 2)::int AS userid,
               CASE WHEN s_suppkey % 3 = 1 THEN 'file' ELSE 'hbase' END AS source
        FROM supplier""",
    "product_band": """
        SELECT (p_partkey // 20)::int AS pid, (p_partkey % 20)::int AS bindex,
               (CASE WHEN p_partkey % 20 < 10 THEN p_partkey // 500
                     ELSE greatest(p_partkey // 500 - 1, 0) END)::int AS hPid,
               (p_partkey % 2)::int AS bsqIndex, 'B' || (p_partkey % 20 + 1) AS bName,
               1 + (p_size % 4) * 0.5::double AS scale, (p_size % 3)::double AS "offset",
               0::double AS validMin, 40::double AS validMax, 45::double AS noData
        FROM part""",
    "storage_table": """
        SELECT 'ht' || r_regionkey AS hTableName, 'tiles' AS hFamily,
               CASE WHEN r_regionkey % 2 = 0 THEN 1 ELSE 4 END AS hPidByteNum,
               CASE WHEN r_regionkey % 2 = 0 THEN 2 ELSE 4 END AS hYXByteNum
        FROM region""",
    "product_display": """
        SELECT c_custkey::int AS dpid, (c_custkey // 15)::int AS pid,
               CASE WHEN c_custkey % 3 = 0 THEN 'xyz' ELSE 'wmts' END AS type,
               c_name || CASE WHEN c_custkey % 3 = 0 THEN ' {{{DATE-' || (c_custkey % 9) || '}}}' ELSE '' END
                   AS productname,
               'd={{{DATE}}}&s=' || c_mktsegment AS params,
               CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END AS visible,
               (c_nationkey % 10)::int AS cat, ((c_custkey * 7919) % 1000)::int AS iorder
        FROM customer""",
    "data_item": """
        SELECT o_orderkey::int AS fid, (o_custkey // 15)::int AS pid,
               strftime(o_orderdate, '%Y%m%d')::bigint * 1000000 AS hcol
        FROM orders""",
    "asof_request": """
        SELECT event_id, user_id::int AS pid,
               19950000000000 + (event_id % 7) * 10000000000 + (event_id % 13) * 100000000 AS h
        FROM events""",
    "category": """
        SELECT n_nationkey AS catid, n_name AS catname, (n_nationkey * 7) % 25 AS iorder,
               CASE WHEN n_nationkey % 4 = 0 THEN 0 ELSE 1 END AS visible
        FROM nation""",
    "area": """
        SELECT r_regionkey AS id, 'R' || r_regionkey AS code, r_name AS name, '0' AS parent_code,
               'geo/R' || r_regionkey AS path FROM region
        UNION ALL
        SELECT 1000 + n_nationkey, 'N' || n_nationkey, n_name, 'R' || n_regionkey,
               'geo/N' || n_nationkey FROM nation
        UNION ALL
        SELECT (100000 + c_custkey)::int, 'C' || c_custkey, c_name, 'N' || c_nationkey,
               'geo/C' || c_custkey FROM customer""",
    "region_row": """
        SELECT s_suppkey::int AS rid, s_name AS name, 'shp/' || s_suppkey AS shp,
               'geo/' || s_suppkey AS geojson, s_nationkey AS uid FROM supplier""",
    "roi_sys": """
        SELECT c_custkey::int AS rid, c_nationkey AS rcid, c_name AS name, c_mktsegment AS name2,
               'geo/' || c_custkey AS geojson FROM customer""",
    "roi_user": """
        SELECT s_suppkey::int AS rid, s_name AS name, 'shp/' || s_suppkey AS shp,
               'geo/' || s_suppkey AS geojson, s_nationkey AS uid FROM supplier""",
    "preload": """
        SELECT o_orderkey::int AS premapid, CASE WHEN o_custkey % 3 = 0 THEN 0
                    ELSE o_custkey END::int AS uid,
               'list-' || o_orderkey AS preloadlist FROM orders""",
    "script": """
        SELECT o_orderkey::int AS sid, (o_custkey % 100)::int AS uid, 'script-' || o_orderkey AS title
        FROM orders""",
    "lineage": """
        SELECT o_orderkey AS run_id,
               'ds' || (o_custkey % 5) || ',' || strftime(o_orderdate, '%Y%m%d') || '000000;;ds'
               || (o_custkey % 3) || ',20200500000000;ds' || (o_custkey % 5)
               || CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE ',20210101000000;' END AS ds_text
        FROM orders""",
    "pixels": """
        SELECT (l_suppkey // 25)::int AS hpid, 2 AS z,
               (((7 * l_orderkey + l_suppkey) % 32) // 16)::int AS y,
               (((13 * l_partkey + l_linenumber) % 64) // 16)::int AS x,
               l_linenumber % 2 AS band,
               strftime(l_shipdate, '%Y%m')::bigint * 100000000 AS dt,
               ((7 * l_orderkey + l_suppkey) % 32)::int AS grow,
               ((13 * l_partkey + l_linenumber) % 64)::int AS gcol,
               max(trunc(l_quantity)) AS dn
        FROM lineitem GROUP BY ALL""",
    "pyramid_pixels": """
        SELECT hpid, (2 - k)::int AS z, ((grow >> k) // 16)::int AS y, ((gcol >> k) // 16)::int AS x, band, dt,
               (grow >> k)::int AS grow, (gcol >> k)::int AS gcol, max(dn) AS dn
        FROM pixels, (SELECT unnest(range(3))::int AS k) GROUP BY ALL""",
    "roi_segments": """
        SELECT 'sys:' || n_nationkey AS roi_id, 2 AS level, ((n_nationkey + k) % 32)::int AS grow,
               ((5 * n_nationkey + k) % 48)::int AS x0,
               ((5 * n_nationkey + k) % 48 + 3 + n_nationkey % 12)::int AS x1
        FROM nation, range(8) AS t(k)""",
    "worker_result": """
        SELECT event_id, user_id::int AS ofid, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS state
        FROM events""",
    "task": """
        SELECT c_custkey::int AS ofid, (c_custkey % 3)::int AS mode, c_nationkey AS uid, 0 AS status
        FROM customer""",
}


def derived_sql(names: tuple[str, ...], body: str) -> str:
    """``body`` with a WITH clause for the derived tables it needs."""
    if not names:
        return body
    ctes = ",\n".join(f"{name} AS ({SQL[name]})" for name in names)
    body = body.strip()
    if re.match(r"(?i)with\s", body):
        return f"WITH {ctes},\n{body[4:]}"
    return f"WITH {ctes}\n{body}"


def _int(column):
    return column.cast("int")


class Derived:
    """The derived tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def points(self) -> DataFrame:
        e = F.col("event_id")
        return self.table("events").select(
            "event_id",
            (((e * 7919) % 36001) / 100.0 - 180.0).alias("lon"),
            (((e * 104729) % 18001) / 100.0 - 90.0).alias("lat"),
            "value",
        )

    def product(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.table("supplier").select(
            _int(k).alias("pid"),
            F.when(k % 5 == 0, F.concat(F.lit("/user/"), k.cast("string")))
            .otherwise(F.concat(F.lit("sys/"), "s_name"))
            .alias("name"),
            F.when(k % 25 == 24, "EPSG:3857").otherwise("EPSG:4326").alias("proj"),
            F.lit(0).alias("minZoom"),
            _int(1 + k % 4).alias("maxZoom"),
            F.lit(1).alias("dataType"),
            _int(1 + k % 7).alias("timeType"),
            F.concat(F.lit("ht"), (idiv(k, 25) % 5).cast("string")).alias("hTableName"),
            F.lit(TILE).alias("tileWid"),
            F.lit(TILE).alias("tileHei"),
            F.lit("deflate").alias("compress"),
            _int(k % 3).alias("styleid"),
            _int(k % 2).alias("userid"),
            F.when(k % 3 == 1, "file").otherwise("hbase").alias("source"),
        )

    def product_rows(self) -> DataFrame:
        """Products as the catalog stores them: key columns and a JSON text."""
        info = [
            "proj", "minZoom", "maxZoom", "dataType", "timeType", "hTableName",
            "tileWid", "tileHei", "compress", "styleid",
        ]
        return self.product().select(
            "pid", "name", "userid", "source", F.to_json(F.struct(*info)).alias("info")
        )

    def product_band(self) -> DataFrame:
        k, size = F.col("p_partkey"), F.col("p_size")
        own = idiv(k, 500)
        return self.table("part").select(
            _int(idiv(k, 20)).alias("pid"),
            _int(k % 20).alias("bindex"),
            _int(F.when(k % 20 < 10, own).otherwise(F.greatest(own - 1, F.lit(0)))).alias("hPid"),
            _int(k % 2).alias("bsqIndex"),
            F.concat(F.lit("B"), (k % 20 + 1).cast("string")).alias("bName"),
            (1.0 + (size % 4) * 0.5).alias("scale"),
            (size % 3).cast("double").alias("offset"),
            F.lit(0.0).alias("validMin"),
            F.lit(40.0).alias("validMax"),
            F.lit(45.0).alias("noData"),
        )

    def band_rows(self) -> DataFrame:
        """Bands as the catalog stores them."""
        info = [
            "hPid", "bsqIndex", "bName", "scale", "offset", "validMin", "validMax", "noData",
        ]
        return self.product_band().select(
            "pid", "bindex", F.to_json(F.struct(*info)).alias("info")
        )

    def storage_table(self) -> DataFrame:
        k = F.col("r_regionkey")
        even = k % 2 == 0
        return self.table("region").select(
            F.concat(F.lit("ht"), k.cast("string")).alias("hTableName"),
            F.lit("tiles").alias("hFamily"),
            F.when(even, 1).otherwise(4).alias("hPidByteNum"),
            F.when(even, 2).otherwise(4).alias("hYXByteNum"),
        )

    def product_display(self) -> DataFrame:
        k = F.col("c_custkey")
        xyz = k % 3 == 0
        mark = F.concat(F.lit(" {{{DATE-"), (k % 9).cast("string"), F.lit("}}}"))
        return self.table("customer").select(
            _int(k).alias("dpid"),
            _int(idiv(k, 15)).alias("pid"),
            F.when(xyz, "xyz").otherwise("wmts").alias("type"),
            F.concat("c_name", F.when(xyz, mark).otherwise("")).alias("productname"),
            F.concat(F.lit("d={{{DATE}}}&s="), "c_mktsegment").alias("params"),
            F.when(k % 4 == 0, 0).otherwise(1).alias("visible"),
            _int(F.col("c_nationkey") % 10).alias("cat"),
            _int((k * 7919) % 1000).alias("iorder"),
        )

    def data_item(self) -> DataFrame:
        day = F.date_format("o_orderdate", "yyyyMMdd").cast("bigint")
        return self.table("orders").select(
            _int(F.col("o_orderkey")).alias("fid"),
            _int(idiv("o_custkey", 15)).alias("pid"),
            (day * 1000000).alias("hcol"),
        )

    def asof_request(self) -> DataFrame:
        e = F.col("event_id")
        h = F.lit(19950000000000) + (e % 7) * 10000000000 + (e % 13) * 100000000
        return self.table("events").select(
            "event_id", _int(F.col("user_id")).alias("pid"), h.alias("h")
        )

    def category(self) -> DataFrame:
        k = F.col("n_nationkey")
        return self.table("nation").select(
            k.alias("catid"),
            F.col("n_name").alias("catname"),
            ((k * 7) % 25).alias("iorder"),
            F.when(k % 4 == 0, 0).otherwise(1).alias("visible"),
        )

    def area(self) -> DataFrame:
        def rows(table, key, id_offset, letter, name, parent):
            k = F.col(key)
            code = F.concat(F.lit(letter), k.cast("string"))
            return self.table(table).select(
                _int(k + id_offset).alias("id"),
                code.alias("code"),
                F.col(name).alias("name"),
                parent.alias("parent_code"),
                F.concat(F.lit("geo/"), code).alias("path"),
            )

        def parent(letter, key):
            return F.concat(F.lit(letter), F.col(key).cast("string"))

        return (
            rows("region", "r_regionkey", 0, "R", "r_name", F.lit("0"))
            .unionByName(
                rows("nation", "n_nationkey", 1000, "N", "n_name", parent("R", "n_regionkey"))
            )
            .unionByName(
                rows("customer", "c_custkey", 100000, "C", "c_name", parent("N", "c_nationkey"))
            )
        )

    def region_row(self) -> DataFrame:
        return self.roi_user()

    def roi_sys(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.table("customer").select(
            _int(k).alias("rid"),
            F.col("c_nationkey").alias("rcid"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("name2"),
            F.concat(F.lit("geo/"), k.cast("string")).alias("geojson"),
        )

    def roi_user(self) -> DataFrame:
        k = F.col("s_suppkey").cast("string")
        return self.table("supplier").select(
            _int(F.col("s_suppkey")).alias("rid"),
            F.col("s_name").alias("name"),
            F.concat(F.lit("shp/"), k).alias("shp"),
            F.concat(F.lit("geo/"), k).alias("geojson"),
            F.col("s_nationkey").alias("uid"),
        )

    def preload(self) -> DataFrame:
        return self.table("orders").select(
            _int(F.col("o_orderkey")).alias("premapid"),
            _int(F.when(F.col("o_custkey") % 3 == 0, 0).otherwise(F.col("o_custkey"))).alias("uid"),
            F.concat(F.lit("list-"), F.col("o_orderkey").cast("string")).alias("preloadlist"),
        )

    def script(self) -> DataFrame:
        return self.table("orders").select(
            _int(F.col("o_orderkey")).alias("sid"),
            _int(F.col("o_custkey") % 100).alias("uid"),
            F.concat(F.lit("script-"), F.col("o_orderkey").cast("string")).alias("title"),
        )

    def lineage(self) -> DataFrame:
        def ds(modulus):
            return F.concat(F.lit("ds"), (F.col("o_custkey") % modulus).cast("string"))

        return self.table("orders").select(
            F.col("o_orderkey").alias("run_id"),
            F.concat(
                ds(5), F.lit(","), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("000000;;"),
                ds(3), F.lit(",20200500000000;"),
                ds(5),
                F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(",20210101000000;"),
            ).alias("ds_text"),
        )

    def observations(self) -> DataFrame:
        """All observations of pixels, in positions of the whole level; a pixel may have several of a month."""
        grow = _int((F.col("l_orderkey") * 7 + F.col("l_suppkey")) % 32)
        gcol = _int((F.col("l_partkey") * 13 + F.col("l_linenumber")) % 64)
        return (
            self.table("lineitem")
            .select(
                _int(idiv("l_suppkey", 25)).alias("hpid"),
                F.lit(LEVEL).alias("z"),
                _int(idiv(grow, TILE)).alias("y"),
                _int(idiv(gcol, TILE)).alias("x"),
                (F.col("l_linenumber") % 2).alias("band"),
                ((F.year("l_shipdate").cast("bigint") * 100 + F.month("l_shipdate")) * 100000000).alias("dt"),
                grow.alias("grow"),
                gcol.alias("gcol"),
                F.col("l_quantity").cast("int").cast("double").alias("dn"),
            )
        )

    def pixels(self) -> DataFrame:
        """One row per observed pixel and month, its largest value."""
        return self.observations().groupBy("hpid", "z", "y", "x", "band", "dt", "grow", "gcol").agg(F.max("dn").alias("dn"))

    def tile_cells(self, pyramid: bool = False) -> DataFrame:
        """The pixels packed as two-band u8 blocks, 255 where nothing was observed; of a pyramid the coarser levels too.

        Observations meet once, where their tile is packed. Coarser levels are made of blocks, not of pixels.
        """
        packed = px.pack_tiles(
            self.observations().select(
                "hpid", "z", "y", "x", "dt", "band",
                (F.col("grow") % TILE).alias("row"),
                (F.col("gcol") % TILE).alias("col"),
                "dn",
            ),
            keys=["hpid", "z", "y", "x", "dt"],
            bands=2, width=TILE, height=TILE, type_code=1, fill=255, largest=True,
        )
        if pyramid:
            packed = overviews(packed, ["hpid", "dt"], LEVEL, 2, TILE, 1, "max", 255)
        return packed.select(
            F.concat(F.lit("ht"), (F.col("hpid") % 5).cast("string")).alias("htable"), "hpid", "z", "y", "x", "dt", "data"
        )

    def roi_segments(self) -> DataFrame:
        n = F.col("n_nationkey")
        k = F.col("k")
        x0 = (n * 5 + k) % 48
        return (
            self.table("nation")
            .select(n, F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k"))
            .select(
                F.concat(F.lit("sys:"), n.cast("string")).alias("roi_id"),
                F.lit(LEVEL).alias("level"),
                _int((n + k) % 32).alias("grow"),
                _int(x0).alias("x0"),
                _int(x0 + 3 + n % 12).alias("x1"),
            )
        )

    def worker_result(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            _int(F.col("user_id")).alias("ofid"),
            F.when(F.col("event_type") == "error", 1).otherwise(0).alias("state"),
        )

    def task(self) -> DataFrame:
        return self.table("customer").select(
            _int(F.col("c_custkey")).alias("ofid"),
            _int(F.col("c_custkey") % 3).alias("mode"),
            F.col("c_nationkey").alias("uid"),
            F.lit(0).alias("status"),
        )
