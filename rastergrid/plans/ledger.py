"""Registration of finished orders in the catalog: bands, then data items, then products, each repeatable.

The steps run in this order, and an order that fails in one takes no part in the later ones; what it
registered before stays. Every step is keyed, so a run that is repeated, after a failure or later, replaces its rows and
adds none. Tables are written as new snapshots in a folder of the run; the snapshot before is not touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid
from ..joins import save
from ..operators import changes, extents
from ..sources import orders as order_files
from ..sources.tables import Catalog

BANDS, ITEMS, PRODUCTS = "tbproductband", "tbproductdataitem", "tbproduct"
# States of orders whose registration failed.
STATE_BANDS, STATE_ITEM, STATE_PRODUCT = 24, 25, 26
MESSAGES = {
    STATE_BANDS: "bands could not be registered", STATE_ITEM: "the data item could not be registered",
    STATE_PRODUCT: "the product could not be updated",
}
STARTED = "started"


@dataclass
class Registered:
    """The catalog after a run, and one row per order with its final state and message."""

    catalog: Catalog
    results: DataFrame


def start(orders: DataFrame, folder: str) -> None:
    """Note every order as started (state 1), before any work is done."""
    started = orders.select("order_id", F.lit(extents.STATE_STARTED).alias("state"), F.lit(STARTED).alias("message"))
    order_files.write_results(started, f"{folder}/results")


def _last_order(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of several orders that write one key the last one's row."""
    return changes.last_per_key(rows, keys, "order_id")


def register(
    spark: SparkSession, catalog: Catalog, outcome: DataFrame, orders: DataFrame, out_bands: int, out_type: int, stamp: Column, folder: str
) -> Registered:
    """Register the orders that succeeded; ``outcome`` is what ``run_jobs`` returns.

    Bands are keyed by (pid, bindex), data items by (pid, hcol), products by pid. An item that is there keeps its
    id and its time of creation. State 24: an order without bands; 25: without a date of output; 26: without a
    product to update. Results are written last, over those that say started.
    """
    done = outcome.join(orders.drop("dt"), "order_id", "left")
    missing = catalog.table(PRODUCTS).select("pid", F.lit(True).alias("known"))
    judged = done.join(missing, F.col("mpid_hpid") == F.col("pid"), "left").drop("pid")
    good = F.col("state") == extents.STATE_OK
    state = (
        F.when(good & (F.lit(out_bands) < 1), STATE_BANDS).when(good & F.col("out_hcol").isNull(), STATE_ITEM)
        .when(good & F.col("known").isNull(), STATE_PRODUCT).otherwise(F.col("state"))
    )
    judged = save(judged.withColumn("final", state), "register-orders")
    rows = judged.filter(good).select(
        "order_id", "final", F.col("mpid_hpid").alias("pid"), F.col("mpid_hpid").alias("hpid"), F.lit(out_bands).alias("bands"),
        F.col("filldata").alias("fill"), F.col("out_hcol").alias("hcol"), *grid.WORLD, "proj",
        F.col("max_zoom").alias("maxZoom"), F.lit(out_type).alias("dataType"), F.col("out_htable").alias("htable"),
    )
    here = Catalog(spark, root=folder)

    # Bands.
    reached = rows.filter(F.col("final") != STATE_BANDS)
    old = catalog.table(BANDS)
    made = changes.band_records(_last_order(reached, ["pid"]))
    kept = old.join(made.select("pid", "bindex"), ["pid", "bindex"], "left_anti")
    catalog.save(BANDS, kept.unionByName(made.select([F.col(c).cast(old.schema[c].dataType).alias(c) for c in old.columns])), folder)

    # Data items: new ones get ids behind the highest, known ones a new time of update.
    reached = reached.filter(F.col("final") != STATE_ITEM)
    old = catalog.table(ITEMS)
    made = save(changes.data_items(_last_order(reached, ["pid", "hcol"]), stamp), "register-items")
    known = made.join(old.select("pid", "hcol"), ["pid", "hcol"], "left_semi").select("pid", "hcol", F.col("updatetime"))
    fresh = made.join(old.select("pid", "hcol"), ["pid", "hcol"], "left_anti")
    key = F.concat_ws("/", F.col("pid").cast("string"), F.col("hcol").cast("string"))
    numbered = changes.append_with_ids(old, fresh.withColumn("item_key", key), "item_key", "fid")
    updated = changes.update_columns(old, known, ["pid", "hcol"])
    catalog.save(ITEMS, updated.unionByName(numbered.select([F.col(c).cast(old.schema[c].dataType).alias(c) for c in old.columns])), folder)

    # Products.
    reached = reached.filter(F.col("final") != STATE_PRODUCT)
    catalog.save(PRODUCTS, changes.update_columns(catalog.table(PRODUCTS), changes.product_updates(_last_order(reached, ["pid"])), ["pid"]), folder)

    message = F.col("message")
    for code, text in MESSAGES.items():
        message = F.when(F.col("final") == code, F.lit(text)).otherwise(message)
    results = judged.select("order_id", F.col("final").alias("state"), message.alias("message"), "good", "bad")
    order_files.write_results(results, f"{folder}/results")
    return Registered(here, spark.read.schema(results.schema).json(f"{folder}/results"))
