"""Catalog lists, assembly, lookups and change sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from rastergrid.functions import texts
from rastergrid.functions.columns import idiv
from rastergrid.operators import catalog, changes, lineage, style
from rastergrid.session import shared_folder
from rastergrid.sources import tables

from .base import query
from .derived import RUN_STAMP

STYLES = """
    SELECT styleid, k, k * (10 + styleid % 5)::double AS val, (styleid * 37 + k * 60) % 256 AS r, (k * 90) % 256 AS g,
           (255 - k * 40)::int AS b, 255 AS a, ['discrete', 'linear', 'exact', 'gray', 'rgb', 'rgba'][styleid % 6 + 1] AS type
    FROM (SELECT s_suppkey::int AS styleid FROM supplier), (SELECT unnest(range(1, 5))::int AS k)"""


def style_rows(d):
    """Styles as the catalog stores them, four stops each."""
    k = F.col("s_suppkey").cast("int")
    stops = F.transform(
        F.sequence(F.lit(1), F.lit(4)),
        lambda i: F.struct(
            (i * (k % 5 + 10)).cast("double").alias("val"), ((k * 37 + i * 60) % 256).alias("r"),
            ((i * 90) % 256).alias("g"), (F.lit(255) - i * 40).alias("b"), F.lit(255).alias("a"),
        ),
    )
    kinds = [("discrete", [0]), ("linear", [0]), ("exact", [0]), ("gray", [1]), ("rgb", [1, 0, 1]), ("rgba", [0, 1, 0, 1])]
    kind = F.get(F.array(*(F.lit(name) for name, _ in kinds)), k % 6)
    bands = F.get(F.array(*(F.array(*map(F.lit, own)) for _, own in kinds)), k % 6)
    # The first range of every fortieth style has no width.
    limits = [(F.lit(5.0), (k % 40 + 5).cast("double")), *((F.lit(low), F.lit(high)) for low, high in ((0.0, 40.0), (10.0, 30.0), (0.0, 50.0)))]
    ranges = F.array(*(F.struct(low.alias("minval"), high.alias("maxval")) for low, high in limits))
    content = F.to_json(F.struct(bands.alias("bands"), kind.alias("type"), stops.alias("colors"), ranges.alias("vranges")))
    return d.table("supplier").select(k.alias("styleid"), content.alias("styleContent"))


@query("product_assembly", """
    SELECT p.pid, name, userid, source, proj, minZoom, maxZoom, dataType, timeType, tileWid, tileHei, compress, styleid,
           hTableName, bindex, hPid, bsqIndex, bName, scale, "offset", validMin, validMax, noData, hFamily, hPidByteNum, hYXByteNum
    FROM product p LEFT JOIN product_band b ON p.pid = b.pid LEFT JOIN storage_table s USING (hTableName)""",
       ("product", "product_band", "storage_table"))
def product_assembly(d):
    """Products with their bands and storage, one row per band, parsed from JSON."""
    return catalog.with_bands(
        catalog.parse_products(d.product_rows()), catalog.parse_bands(d.band_rows()), d.storage_table()
    )


@query("product_nested", """
    SELECT p.pid, name, string_agg(bName || '@' || hPid || '.' || bsqIndex, ',' ORDER BY bindex) AS bands, any_value(hPidByteNum) AS hPidByteNum
    FROM product p LEFT JOIN product_band b ON p.pid = b.pid LEFT JOIN storage_table s USING (hTableName) GROUP BY p.pid, name""",
       ("product", "product_band", "storage_table"))
def product_nested(d):
    """Products with an ordered band list."""
    rows = catalog.nested(d.product(), d.product_band(), d.storage_table())
    text = F.transform(
        "bands", lambda b: F.concat(b["bName"], F.lit("@"), b["hPid"].cast("string"), F.lit("."), b["bsqIndex"].cast("string"))
    )
    return rows.select("pid", "name", F.array_join(text, ",").alias("bands"), "storage.hPidByteNum")


@query("product_by_name", """
    SELECT o_orderkey, p.pid, p.maxZoom FROM (SELECT o_orderkey, '/user/' || o_custkey % 130 AS dsname FROM orders)
    LEFT JOIN product p ON name = dsname""", ("product",))
def product_by_name(d):
    """Product of each requested name, NULL when unknown."""
    names = d.table("orders").select(
        "o_orderkey", F.concat(F.lit("/user/"), (F.col("o_custkey") % 130).cast("string")).alias("dsname")
    )
    return catalog.by_name(names, d.product()).select("o_orderkey", "pid", "maxZoom")


LAYER_SQL = """
    WITH bt AS (SELECT pid, count(*) AS bands, arg_min(bName, bindex) AS first_band FROM product_band GROUP BY pid),
         dd AS (SELECT * FROM product_display QUALIFY row_number() OVER (PARTITION BY pid ORDER BY dpid) = 1),
         li AS (SELECT pid, hcol, max(fid) AS fid FROM data_item WHERE (pid, hcol) IN (SELECT (pid, max(hcol)) FROM data_item GROUP BY pid) GROUP BY ALL)
    SELECT p.pid, p.name, p.userid, bands, first_band, hFamily, dpid, productname, fid AS last_fid, hcol AS last_hcol,
           CASE timeType WHEN 1 THEN strftime(dt, '%Y年%m月%d日 00:00:00') WHEN 2 THEN strftime(dt, '%Y年%m月%d日 00:00')
             WHEN 3 THEN strftime(dt, '%Y年%m月%d日 00时') WHEN 4 THEN strftime(dt, '%Y年%m月%d日') WHEN 5 THEN strftime(dt, '%Y年%m月')
             WHEN 6 THEN CASE month(dt) WHEN 3 THEN year(dt) || '年春季' WHEN 6 THEN year(dt) || '年夏季'
                  WHEN 9 THEN year(dt) || '年秋季' WHEN 12 THEN year(dt) || '年冬季' ELSE hcol::varchar END
             WHEN 7 THEN strftime(dt, '%Y年') ELSE hcol::varchar END AS last_text
    FROM product p LEFT JOIN bt USING (pid) LEFT JOIN storage_table USING (hTableName) LEFT JOIN dd USING (pid)
    LEFT JOIN (SELECT *, strptime((hcol // 1000000)::varchar, '%Y%m%d') AS dt FROM li) USING (pid)"""
LAYER_TABLES = ("product", "product_band", "storage_table", "product_display", "data_item")
LAYER_COLUMNS = ["pid", "name", "userid", "bands", "first_band", "hFamily", "dpid", "productname", "last_fid", "last_hcol", "last_text"]


@query("product_layer", LAYER_SQL, LAYER_TABLES)
def product_layer(d):
    """All that a map layer needs about each product."""
    return catalog.layers(
        d.product(), d.product_band(), d.storage_table(), d.product_display(), d.data_item()
    ).select(*LAYER_COLUMNS)


@query("system_products", f"SELECT *, 'zs,xl,co,ex,st,dt' AS caps FROM ({LAYER_SQL}) WHERE userid = 0", LAYER_TABLES)
def system_products(d):
    """Layers of system products with their capabilities."""
    return catalog.system_layers(
        d.product(), d.product_band(), d.storage_table(), d.product_display(), d.data_item()
    ).select(*LAYER_COLUMNS, F.array_join("caps", ",").alias("caps"))


@query("categories_visible", "SELECT * FROM category WHERE visible = 1 ORDER BY iorder", ("category",))
def categories_visible(d):
    """Visible categories in order."""
    return catalog.visible(d.category())


@query("display_ids", "SELECT cat, dpid FROM product_display WHERE visible = 1", ("product_display",))
def display_ids(d):
    """Visible layers of every category."""
    return catalog.visible(d.product_display()).select("cat", "dpid")


@query("category_display_ids", "SELECT dpid FROM product_display WHERE visible = 1 AND cat = 3 ORDER BY iorder", ("product_display",))
def category_display_ids(d):
    """Visible layers of one category."""
    return catalog.visible(catalog.owned_by(d.product_display(), "cat", 3)).select("dpid")


@query("keyword_layers", "SELECT dpid, productname FROM product_display WHERE contains(productname, '{DATE-3}')", ("product_display",))
def keyword_layers(d):
    """Layers whose name holds a word, braces taken literally."""
    return catalog.containing(d.product_display(), "productname", "{DATE-3}").select("dpid", "productname")


@query("area_children", """
    SELECT a.id, a.code, a.parent_code, CASE WHEN a.code IN (SELECT parent_code FROM area) THEN 1 ELSE 0 END AS children FROM area a""",
       ("area",))
def area_children(d):
    """Areas with a flag for having children."""
    return catalog.with_children_flag(d.area()).select("id", "code", "parent_code", "children")


@query("roi_union", """
    SELECT 'area' AS rtype, id AS rid, name, '' AS shp, path AS geojson, 0 AS uid, code, parent_code,
           CASE WHEN code IN (SELECT parent_code FROM area) THEN 1 ELSE 0 END AS children FROM area
    UNION ALL SELECT 'roi', rid, name, shp, geojson, uid, '0', '0', 0 FROM region_row""", ("area", "region_row"))
def roi_union(d):
    """Areas and free regions in one form."""
    return catalog.unified_regions(d.area(), d.region_row())


@query("roi_page", "SELECT * FROM roi_sys QUALIFY row_number() OVER (PARTITION BY rcid ORDER BY rid) BETWEEN 21 AND 40", ("roi_sys",))
def roi_page(d):
    """Rows 20 to 39 of every region category."""
    return catalog.region_pages(d.roi_sys(), 20, catalog.PAGE_ROWS)


@query("roi_page_one", "SELECT * FROM roi_sys WHERE rcid = 7 ORDER BY rid LIMIT 20 OFFSET 5", ("roi_sys",))
def roi_page_one(d):
    """A page of one category."""
    return catalog.region_page(d.roi_sys(), 7, 5, catalog.PAGE_ROWS)


@query("roi_counts", """
    SELECT catid AS rcid, catname, count(rid) AS records FROM category LEFT JOIN roi_sys ON catid = rcid GROUP BY ALL""",
       ("category", "roi_sys"))
def roi_counts(d):
    """Region categories with their record counts."""
    categories = d.category().select(F.col("catid").alias("rcid"), "catname")
    return catalog.category_counts(categories, d.roi_sys())


@query("user_rois", "SELECT rid, name, shp, geojson, uid FROM roi_user WHERE uid = 5 ORDER BY rid", ("roi_user",))
def user_rois(d):
    """Regions of one user."""
    return catalog.owned_by(d.roi_user(), "uid", 5).orderBy("rid")


@query("preload_fallback", """
    WITH own AS (SELECT uid, max(premapid) AS premapid, arg_max(preloadlist, premapid) AS preloadlist FROM preload GROUP BY uid)
    SELECT c_custkey::int AS uid, CASE WHEN o.uid IS NULL THEN 0 ELSE o.uid END AS list_uid,
           coalesce(o.premapid, z.premapid) AS premapid, coalesce(o.preloadlist, z.preloadlist) AS preloadlist
    FROM customer LEFT JOIN own o ON o.uid = c_custkey LEFT JOIN own z ON z.uid = 0""", ("preload",))
def preload_fallback(d):
    """Newest preload list of each user, or the shared one."""
    users = d.table("customer").select(F.col("c_custkey").cast("int").alias("uid"))
    return catalog.preload_lists(users, d.preload())


@query("owner_json", """
    SELECT uid, ((k - 1) // 200)::int AS part, to_json({'scripts': list({'sid': sid, 'title': title, 'uid': uid} ORDER BY sid)})::varchar AS json
    FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY sid) AS k FROM script) GROUP BY ALL""", ("script",))
def owner_json(d):
    """All of each user's scripts as JSON texts of 200 each."""
    return catalog.owner_lists(d.script(), "sid", ["sid", "title", "uid"], "scripts")


@query("keyed_lookup", """
    SELECT event_id, k.sid, CASE WHEN s.sid IS NULL THEN NULL ELSE to_json({'sid': s.sid, 'uid': uid, 'title': title})::varchar END AS json
    FROM (SELECT event_id, (event_id * 2)::int AS sid FROM events) k LEFT JOIN script s USING (sid)""", ("script",))
def keyed_lookup(d):
    """Scripts for a table of keys as JSON texts."""
    keys = d.table("events").select("event_id", (F.col("event_id") * 2).cast("int").alias("sid"))
    return catalog.lookup(d.script(), keys, ["sid"], as_json=True)


@query("style_parse", f"SELECT styleid, type, (k - 1)::int AS pos, val, r, g, b, a FROM ({STYLES})")
def style_parse(d):
    """Styles parsed from JSON, one row per colour stop."""
    parsed = style.parse_styles(style_rows(d))
    return parsed.select("styleid", "type", F.posexplode("colors").alias("pos", "c")).select(
        "styleid", "type", "pos", "c.val", "c.r", "c.g", "c.b", "c.a"
    )


@query("upsert_products", """
    WITH ch AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'delete' ELSE 'upsert' END AS op, (o_custkey // 10)::int AS pid,
                       'p' || o_orderkey AS name, (o_orderkey % 7)::int AS userid FROM orders
                QUALIFY row_number() OVER (PARTITION BY o_custkey // 10 ORDER BY o_orderkey DESC) = 1)
    SELECT pid, name, userid FROM product WHERE pid NOT IN (SELECT pid FROM ch)
    UNION ALL SELECT pid, name, userid FROM ch WHERE op = 'upsert'""", ("product",))
def upsert_products(d):
    """A change set with inserts, updates and deletes on the product table."""
    k = F.col("o_orderkey")
    edits = d.table("orders").select(
        F.when(k % 10 == 0, changes.DELETE).otherwise(changes.UPSERT).alias("op"), k.alias("seq"),
        idiv("o_custkey", 10).cast("int").alias("pid"), F.concat(F.lit("p"), k.cast("string")).alias("name"),
        (k % 7).cast("int").alias("userid"),
    )
    return changes.apply_changes(d.product().select("pid", "name", "userid"), edits, ["pid"], "seq")


@query("delete_roi", "SELECT * FROM roi_user WHERE rid NOT IN (SELECT event_id // 3 FROM events)", ("roi_user",))
def delete_roi(d):
    """Regions removed by a table of keys."""
    edits = d.table("events").select(
        F.lit(changes.DELETE).alias("op"), F.col("event_id").alias("seq"), idiv("event_id", 3).cast("int").alias("rid"),
        *(F.lit(None).cast("string").alias(c) for c in ("name", "shp", "geojson")), F.lit(None).cast("int").alias("uid"),
    )
    return changes.apply_changes(d.roi_user(), edits, ["rid"], "seq")


def jobs(d):
    k = F.col("s_suppkey")
    return d.table("supplier").select(
        (k + 10000).cast("int").alias("pid"), (k + 10000).cast("int").alias("hpid"),
        (1 + k % 4).cast("int").alias("bands"), F.lit(0.0).alias("fill"), (20200101000000 + k).alias("hcol"),
        F.lit(-180.0).alias("left"), F.lit(180.0).alias("right"), F.lit(90.0).alias("top"), F.lit(-90.0).alias("bottom"),
        F.lit("EPSG:4326").alias("proj"), (k % 5).cast("int").alias("maxZoom"), F.lit(1).alias("dataType"),
        F.lit("out").alias("htable"),
    )


@query("band_records", """
    SELECT pid, b AS bindex, '{"hPid":' || pid || ',"bsqIndex":' || b || ',"bName":"B' || (b + 1)
           || '","scale":1,"offset":0,"validMin":0.0,"validMax":255.0,"noData":0.0}' AS info
    FROM (SELECT (10000 + s_suppkey)::int AS pid, unnest(range(0, 1 + s_suppkey % 4))::int AS b FROM supplier)""")
def band_records(d):
    """Band rows a job registers."""
    return changes.band_records(jobs(d))


@query("data_item_append", """
    SELECT fid, pid, hcol FROM data_item UNION ALL
    SELECT ((SELECT max(fid) FROM data_item) + row_number() OVER (ORDER BY substr(md5((10000 + s_suppkey)::varchar), 1, 3), s_suppkey))::int,
           (10000 + s_suppkey)::int, 20200101000000 + s_suppkey FROM supplier""", ("data_item",))
def data_item_append(d):
    """New data items numbered after the highest id."""
    rows = changes.data_items(jobs(d), F.to_timestamp(F.lit(RUN_STAMP)))
    items = d.data_item()
    return items.unionByName(changes.append_with_ids(items, rows, "pid", "fid").select(*items.columns))


@query("product_update", """
    SELECT pid, 'user/' || pid AS name, '{"proj":"EPSG:4326","minZoom":0,"maxZoom":' || pid % 5
        || ',"dataType":1,"timeType":0,"hTableName":"out","tileWid":256,"tileHei":256,"compress":"deflate","styleid":0}' AS info
    FROM (SELECT (10000 + s_suppkey)::int AS pid FROM supplier WHERE s_suppkey % 3 <> 0)
    UNION ALL SELECT (10000 + s_suppkey)::int, 'empty', NULL FROM supplier WHERE s_suppkey % 3 = 0""")
def product_update(d):
    """Name and info of finished jobs written over empty product rows."""
    k = F.col("pid")
    empty = jobs(d).select("pid", F.lit("empty").alias("name"), F.lit(None).cast("string").alias("info"))
    finished = jobs(d).filter((k - 10000) % 3 != 0)
    return changes.update_columns(empty, changes.product_updates(finished), ["pid"])


@query("task_status", """
    SELECT t.ofid, mode, uid, (CASE WHEN w.state IS NULL THEN 0 WHEN w.state = 0 THEN 2 ELSE 3 END)::int AS status
    FROM task t LEFT JOIN (SELECT ofid, arg_max(state, event_id) AS state FROM worker_result GROUP BY ofid) w USING (ofid)""",
       ("task", "worker_result"))
def task_status(d):
    """Task status after the last worker result of each task."""
    updates = changes.task_updates(d.worker_result(), "event_id")
    return changes.update_columns(d.task(), updates, ["ofid"])


@query("lineage_dates", """
    WITH parts AS (SELECT run_id, unnest(string_split(ds_text, ';')) AS p, generate_subscripts(string_split(ds_text, ';'), 1) AS i FROM lineage),
         pairs AS (SELECT run_id, i, split_part(p, ',', 1) AS ds, split_part(p, ',', 2) AS dt, contains(p, ',') AS good FROM parts WHERE p <> ''),
         runs AS (SELECT run_id, bool_and(good) AS ok FROM pairs GROUP BY run_id)
    SELECT run_id, 1 AS ok, (row_number() OVER (PARTITION BY run_id ORDER BY min(i)) - 1)::int AS position, ds AS dsname, string_agg(dt, ',' ORDER BY i) AS dates
    FROM pairs JOIN runs USING (run_id) WHERE ok GROUP BY run_id, ds
    UNION ALL SELECT run_id, 0, NULL, NULL, NULL FROM runs WHERE NOT ok""", ("lineage",))
def lineage_dates(d):
    """Dates per dataset of each run, in first-seen order; malformed runs flagged."""
    rows = lineage.dataset_dates(d.lineage(), "run_id", "ds_text")
    return rows.select(
        "run_id", F.col("ok").cast("int").alias("ok"), "position", "dsname",
        F.array_join(F.transform("dates", lambda x: x.cast("string")), ",").alias("dates"),
    )


@query("lineage_regions", """
    SELECT o_orderkey AS run_id, 'sys:' || o_custkey % 25 AS roi_id FROM orders
    UNION ALL SELECT o_orderkey, 'user:' || o_custkey % 7 FROM orders WHERE o_orderkey % 2 = 0""")
def lineage_regions(d):
    """Regions each run reports, empty parts skipped."""
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    second = F.when(k % 2 == 0, F.concat(F.lit("user:"), (c % 7).cast("string"), F.lit(";"))).otherwise("")
    text = F.concat(F.lit(";sys:"), (c % 25).cast("string"), F.lit(";;"), second)
    runs = d.table("orders").select(k.alias("run_id"), text.alias("text"))
    return lineage.region_list(runs, "run_id", "text")


@query("md5_keys", "SELECT doc_id, md5(text) AS digest, length(text) AS chars FROM documents")
def md5_keys(d):
    """Digest of whole texts."""
    return d.table("documents").select("doc_id", texts.digest("text").alias("digest"), F.length("text").cast("bigint").alias("chars"))


@query("roi_text_parse", """
    SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'sys' WHEN 1 THEN 'user' WHEN 2 THEN 'file' WHEN 3 THEN NULL ELSE 'sys' END AS route,
           CASE c_custkey % 5 WHEN 0 THEN c_custkey WHEN 1 THEN c_custkey END::int AS rid,
           CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 180 - 0.5 END::double AS "left",
           CASE WHEN c_custkey % 2 = 0 THEN -1 END::double AS bottom
    FROM customer""")
def roi_text_parse(d):
    """Region texts and extent texts, good and bad ones."""
    k = F.col("c_custkey").cast("string")
    m = F.col("c_custkey") % 5
    text = (
        F.when(m == 0, F.concat(F.lit("sys:"), k)).when(m == 1, F.concat(F.lit("user:"), k))
        .when(m == 2, F.concat(F.lit("roi/"), k)).when(m == 3, "").otherwise(F.concat(F.lit("sys:x"), k))
    )
    box = F.when(
        F.col("c_custkey") % 2 == 0,
        F.concat(F.lit(""), (F.col("c_custkey") % 180 - 0.5).cast("string"), F.lit(",10,5,-1")),
    ).otherwise("1,2,three,4")
    return d.table("customer").select(
        "c_custkey", texts.region_route(text).alias("route"), texts.region_id(text)["id"].alias("rid"),
        texts.extent(box)["left"].alias("left"), texts.extent(box)["bottom"].alias("bottom"),
    )


@query("catalog_tables", """
    SELECT 'tbproduct' AS name, count(*) AS n, sum(pid)::bigint AS total FROM product UNION ALL SELECT 'tbproductband', count(*), sum(pid)::bigint FROM product_band
    UNION ALL SELECT 'tbroisys', count(*), sum(rid)::bigint FROM roi_sys UNION ALL SELECT 'area', 2 * count(*), sum(2 * id)::bigint FROM area""",
       ("product", "product_band", "roi_sys", "area"))
def catalog_tables(d):
    """Tables written through the catalog, one of them in two parts, and read back."""
    catalog_ = tables.Catalog(d.spark, root=shared_folder(d.spark, "catalog"))
    for name, rows in (("tbproduct", d.product_rows()), ("tbproductband", d.band_rows()), ("tbroisys", d.roi_sys()), ("area", d.area()), ("area", d.area())):
        catalog_.append(name, rows)
    keys = {"tbproduct": "pid", "tbproductband": "pid", "tbroisys": "rid", "area": "id"}
    parts = [catalog_.table(t).agg(F.lit(t).alias("name"), F.count("*").alias("n"), F.sum(k).cast("bigint").alias("total")) for t, k in keys.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).select("name", "n", "total")
