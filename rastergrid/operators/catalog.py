"""Product catalog: assembly joins, lists, lookups and pages.

Every relation the catalog follows is one join over whole tables, never a query per
product. No join is hinted as broadcast: the small side is broadcast when its measured
size allows it, and a sort-merge join with skew splitting covers the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import packed_time as pt
from ..functions.columns import idiv
from . import dates

# Rows of one page and of one JSON list; lists go on in further parts.
PAGE_ROWS = 20
LIST_ROWS = 200
SYSTEM_USER = 0
# What every system product offers (zonal statistics, series, composite,
# export, style, date choice).
CAPABILITIES = ("zs", "xl", "co", "ex", "st", "dt")

PRODUCT_INFO = T.StructType(
    [
        T.StructField("proj", T.StringType()),
        T.StructField("minZoom", T.IntegerType()),
        T.StructField("maxZoom", T.IntegerType()),
        T.StructField("dataType", T.IntegerType()),
        T.StructField("timeType", T.IntegerType()),
        T.StructField("hTableName", T.StringType()),
        T.StructField("tileWid", T.IntegerType()),
        T.StructField("tileHei", T.IntegerType()),
        T.StructField("compress", T.StringType()),
        T.StructField("styleid", T.IntegerType()),
    ]
)
BAND_INFO = T.StructType(
    [
        T.StructField("hPid", T.IntegerType()),
        T.StructField("bsqIndex", T.IntegerType()),
        T.StructField("bName", T.StringType()),
        T.StructField("scale", T.DoubleType()),
        T.StructField("offset", T.DoubleType()),
        T.StructField("validMin", T.DoubleType()),
        T.StructField("validMax", T.DoubleType()),
        T.StructField("noData", T.DoubleType()),
    ]
)


def _parsed(rows: DataFrame, schema: T.StructType, keep: list[str]) -> DataFrame:
    """Columns of a JSON ``info`` text; missing numbers are 0 as in the stored form."""
    info = rows.select(*keep, F.from_json("info", schema).alias("i"))

    def field(f: T.StructField) -> Column:
        value = F.col("i")[f.name]
        if not isinstance(f.dataType, T.StringType):
            value = F.coalesce(value, F.lit(0).cast(f.dataType))
        return value.alias(f.name)

    return info.select(*keep, *(field(f) for f in schema.fields))


def parse_products(rows: DataFrame) -> DataFrame:
    """Product columns from ``(pid, name, userid, source, info)``."""
    return _parsed(rows, PRODUCT_INFO, ["pid", "name", "userid", "source"])


def parse_bands(rows: DataFrame) -> DataFrame:
    """Band columns from ``(pid, bindex, info)``."""
    return _parsed(rows, BAND_INFO, ["pid", "bindex"])


def visible(rows: DataFrame) -> DataFrame:
    """Visible rows in display order."""
    return rows.filter(F.col("visible") == 1).orderBy("iorder")


def containing(rows: DataFrame, column: str, word: str) -> DataFrame:
    """Rows whose text contains a word, taken literally; an empty word keeps all."""
    return (rows.filter(F.col(column).contains(word)) if word else rows).orderBy("iorder")


def owned_by(rows: DataFrame, column: str, user: int) -> DataFrame:
    return rows.filter(F.col(column) == user)


def with_bands(products: DataFrame, bands: DataFrame, storage: DataFrame) -> DataFrame:
    """One row per product and band, with the storage table; products without bands stay."""
    return products.join(bands, "pid", "left").join(storage, "hTableName", "left")


def nested(products: DataFrame, bands: DataFrame, storage: DataFrame) -> DataFrame:
    """One row per product with its ordered band list and storage as a struct.

    A product's bands are the planes of its tile blocks, so the list is short.
    """
    names = [c for c in bands.columns if c != "pid"]
    lists = bands.groupBy("pid").agg(
        F.array_sort(F.collect_list(F.struct("bindex", *(n for n in names if n != "bindex")))).alias("bands")
    )
    store = storage.select("hTableName", F.struct("hFamily", "hPidByteNum", "hYXByteNum").alias("storage"))
    return products.join(lists, "pid", "left").join(store, "hTableName", "left")


def by_name(names: DataFrame, products: DataFrame) -> DataFrame:
    """Product of each ``dsname``; the lowest pid where several share a name."""
    others = [c for c in products.columns if c not in ("pid", "name")]
    first = products.groupBy(F.col("name").alias("dsname")).agg(F.min(F.struct("pid", *others)).alias("p"))
    known = first.select("dsname", F.col("dsname").alias("name"), "p.*")
    return names.join(known, "dsname", "left")


def first_display(displays: DataFrame) -> DataFrame:
    """The display row with the lowest id of each product."""
    others = [c for c in displays.columns if c not in ("dpid", "pid")]
    return displays.groupBy("pid").agg(F.min(F.struct("dpid", *others)).alias("d")).select("pid", "d.*")


def layers(products: DataFrame, bands: DataFrame, storage: DataFrame, displays: DataFrame, items: DataFrame) -> DataFrame:
    """Products with band totals, storage, display row and latest item with its text."""
    totals = bands.groupBy("pid").agg(
        F.count(F.lit(1)).alias("bands"), F.min_by("bName", "bindex").alias("first_band")
    )
    last = dates.latest(items).select("pid", F.col("fid").alias("last_fid"), F.col("hcol").alias("last_hcol"))
    return (
        products.join(totals, "pid", "left")
        .join(storage, "hTableName", "left")
        .join(first_display(displays), "pid", "left")
        .join(last, "pid", "left")
        .withColumn("last_text", pt.label("last_hcol", "timeType"))
    )


def system_layers(products: DataFrame, *others: DataFrame) -> DataFrame:
    """Layers of the products that belong to no user, with their capabilities."""
    return layers(owned_by(products, "userid", SYSTEM_USER), *others).withColumn(
        "caps", F.array(*(F.lit(c) for c in CAPABILITIES))
    )


def fill_display_dates(displays: DataFrame, today: Column) -> DataFrame:
    """Fill the date marks of name and parameters for layers of type ``xyz``."""
    xyz = F.col("type") == "xyz"
    return displays.withColumns(
        {
            name: F.when(xyz, pt.fill_template(name, today)).otherwise(F.col(name))
            for name in ("productname", "params")
        }
    )


def with_children_flag(areas: DataFrame) -> DataFrame:
    """Areas with ``children`` 1 where another area names them as parent."""
    parents = areas.select(F.col("parent_code").alias("code")).distinct().withColumn("has", F.lit(1))
    return areas.join(parents, "code", "left").withColumn("children", F.coalesce("has", F.lit(0))).drop("has")


def unified_regions(areas: DataFrame, regions: DataFrame) -> DataFrame:
    """Areas and free regions in one form, told apart by ``rtype``."""
    flagged = with_children_flag(areas).select(
        F.lit("area").alias("rtype"), F.col("id").alias("rid"), "name", F.lit("").alias("shp"),
        F.col("path").alias("geojson"), F.lit(SYSTEM_USER).alias("uid"), "code",
        F.col("parent_code").alias("parent_code"), "children",
    )
    free = regions.select(
        F.lit("roi").alias("rtype"), "rid", "name", "shp", "geojson", "uid",
        F.lit("0").alias("code"), F.lit("0").alias("parent_code"), F.lit(0).alias("children"),
    )
    return flagged.unionByName(free)


def region_page(regions: DataFrame, category: int, offset: int, rows: int) -> DataFrame:
    """``rows`` regions of a category from a row offset."""
    return regions.filter(F.col("rcid") == category).orderBy("rid").offset(offset).limit(rows)


def region_pages(regions: DataFrame, offset: int, rows: int) -> DataFrame:
    """The same page of every category."""
    order = Window.partitionBy("rcid").orderBy("rid")
    ranked = regions.withColumn("rank_", F.row_number().over(order))
    return ranked.filter(
        (F.col("rank_") <= offset + rows) & (F.col("rank_") > offset)
    ).drop("rank_")


def category_counts(categories: DataFrame, regions: DataFrame) -> DataFrame:
    """Categories with the number of their regions."""
    counts = regions.groupBy("rcid").agg(F.count("rid").alias("records"))
    return categories.join(counts, "rcid", "left").withColumn("records", F.coalesce("records", F.lit(0)))


def preload_lists(users: DataFrame, preload: DataFrame) -> DataFrame:
    """Newest preload row of each user; users without one get that of user 0."""
    def newest(rows: DataFrame, *keys) -> DataFrame:
        return rows.groupBy(*keys).agg(F.max(F.struct("premapid", "preloadlist")).alias("row"))

    own = newest(preload, "uid")
    shared = newest(preload.filter(F.col("uid") == SYSTEM_USER)).scalar()
    return (
        users.join(own, "uid", "left")
        .select(
            "uid",
            F.coalesce(F.col("row"), shared).alias("r"),
            F.when(F.col("row").isNull(), SYSTEM_USER).otherwise(F.col("uid")).alias("list_uid"),
        )
        .select("uid", "list_uid", "r.premapid", "r.preloadlist")
        .filter(F.col("premapid").isNotNull())
    )


def owner_lists(
    rows: DataFrame, key: str, columns: list[str], name: str, owner: str = "uid", cap: int | None = None
) -> DataFrame:
    """Each owner's rows by key as JSON texts ``{name: [...]}`` of at most ``LIST_ROWS`` rows: ``owner, part, json``.

    All rows are listed unless a ``cap`` is given; an owner with more than LIST_ROWS has several texts,
    ``part`` 0, 1, …, so no list grows without a bound.
    """
    order = Window.partitionBy(owner).orderBy(key)
    ranked = rows.withColumn("rank_", F.row_number().over(order))
    if cap is not None:
        ranked = ranked.filter(F.col("rank_") <= cap)
    part = idiv(F.col("rank_") - 1, LIST_ROWS).cast("int")
    items = F.transform(
        F.array_sort(F.collect_list(F.struct("rank_", F.struct(*columns).alias("row")))), lambda item: item["row"]
    )
    return ranked.groupBy(owner, part.alias("part")).agg(F.to_json(F.struct(items.alias(name))).alias("json"))


def lookup(table: DataFrame, keys: DataFrame, on: list[str], as_json: bool = False) -> DataFrame:
    """Rows of a table for a table of keys, optionally as one JSON text per row.

    Keys that are not found stay, with NULLs.
    """
    if as_json:
        table = table.select(*on, F.to_json(F.struct(*table.columns)).alias("json"))
    return keys.join(table, on, "left")
