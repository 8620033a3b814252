"""Date selections: filters, caps, calendars, as-of and latest issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import packed_time as pt
from ..functions.columns import idiv

# Fixed value: the number of dates that reads of the table store were limited to; no default.
DATE_CAP = 30
DAY = 1_000_000
STEP_BLOCK = 256


def in_range(dt: str, start, stop) -> Column:
    """Both ends inclusive; with literal ends this reaches the Parquet scan."""
    return F.col(dt).between(start, stop)


def first_dates(rows: DataFrame, keys: list[str], cap: int | None = None, dt: str = "dt") -> DataFrame:
    """The first ``cap`` dates per key, ascending; all of them unless a cap is given.

    Run on key columns only and join the payload afterwards: the rank limit is
    applied before the shuffle, so a hot key sends at most ``cap`` rows per task.
    """
    if cap is None:
        return rows
    order = Window.partitionBy(*keys).orderBy(dt)
    return (
        rows.withColumn("rank_", F.row_number().over(order)).filter(F.col("rank_") <= cap).drop("rank_")
    )


def date_grid(requests: DataFrame, keys: list[str], max_wildcards: int | None = 1) -> DataFrame:
    """Every packed date of a request's years that fits its fixed parts and range.

    Parts of ``-1`` run over all their values; days run to 31 in every month.
    Requests with more wildcards than ``max_wildcards`` give no rows.
    """
    # First and last value of a part left open.
    open_ranges = {"month": (1, 12), "day": (1, 31), "hour": (0, 23), "minute": (0, 59), "second": (0, 59)}
    wildcards = sum(
        (F.when(F.col(name) == pt.IGNORE, 1).otherwise(0) for name in open_ranges), F.lit(0)
    )
    grid = requests if max_wildcards is None else requests.filter(wildcards <= max_wildcards)
    grid = grid.filter(F.col("startdt") <= F.col("stopdt")).withColumn(
        "year_", F.explode(F.sequence(pt.part("startdt", "year"), pt.part("stopdt", "year")))
    )
    total = F.col("year_").cast("bigint") * pt.PART_UNITS["year"]
    for name, (first, last) in open_ranges.items():
        value = F.col(name)
        grid = grid.withColumn(
            f"{name}_",
            F.explode(
                F.when(value == pt.IGNORE, F.sequence(F.lit(first), F.lit(last))).otherwise(
                    F.array(value)
                )
            ),
        )
        total = total + F.col(f"{name}_").cast("bigint") * pt.PART_UNITS[name]
    return grid.select(*keys, "startdt", "stopdt", total.alias("dt")).filter(
        F.col("dt").between(F.col("startdt"), F.col("stopdt"))
    ).drop("startdt", "stopdt")


def every_n(requests: DataFrame, keys: list[str]) -> DataFrame:
    """Packed dates from ``startdt`` to ``stopdt`` at a calendar step.

    The step columns are ``years, months, days, hours, minutes, seconds``; the ends
    count unless ``start_inclusive`` / ``stop_inclusive`` is false. Requests without
    a step, or with ends that are not real dates, give no rows.
    """
    # A step of seconds over years is a long list, so dates come in blocks: the list of
    # blocks is expanded first, then the steps of one block at a time.
    month_step = F.col("years") * 12 + F.col("months")
    second_step = (
        F.col("days").cast("bigint") * 86400 + F.col("hours") * 3600 + F.col("minutes") * 60 + F.col("seconds")
    )
    first, last = pt.to_timestamp("startdt"), pt.to_timestamp("stopdt")
    span = F.unix_timestamp("last_") - F.unix_timestamp("first_")
    # Never fewer than the steps that fit: no month has less than 28 days.
    most = idiv(span, month_step * 28 * 86400 + second_step)
    number = F.col("block_") * STEP_BLOCK + F.col("step_")
    interval = F.make_interval(
        years=F.col("years") * F.col("number_"), months=F.col("months") * F.col("number_"),
        days=F.col("days") * F.col("number_"), hours=F.col("hours") * F.col("number_"),
        mins=F.col("minutes") * F.col("number_"), secs=F.col("seconds") * F.col("number_"),
    )
    return (
        requests.withColumns({"first_": first, "last_": last})
        .filter((month_step + second_step > 0) & (F.col("first_") <= F.col("last_")))
        .withColumn("block_", F.explode(F.sequence(F.lit(0).cast("bigint"), idiv(most, STEP_BLOCK))))
        .withColumn("step_", F.explode(F.sequence(F.lit(0), F.lit(STEP_BLOCK - 1))))
        .withColumn("number_", number.cast("int"))
        .withColumn("ts_", F.col("first_") + interval)
        .filter(F.col("ts_") <= F.col("last_"))
        .filter(
            (F.col("start_inclusive") | (F.col("ts_") > F.col("first_")))
            & (F.col("stop_inclusive") | (F.col("ts_") < F.col("last_")))
        )
        .select(*keys, pt.pack("ts_").alias("dt"))
    )


def years(items: DataFrame) -> DataFrame:
    """Distinct years per product, ascending."""
    return items.select("pid", pt.part("hcol", "year").alias("year")).distinct().orderBy("pid", "year")


def months(items: DataFrame) -> DataFrame:
    """Distinct months per product and year, ascending."""
    return items.select(
        "pid", pt.part("hcol", "year").alias("year"), pt.part("hcol", "month").alias("month")
    ).distinct().orderBy("pid", "year", "month")


def month_items(items: DataFrame, year: int, month: int) -> DataFrame:
    """Items of one month, as a half-open range that reaches the scan."""
    first = (year * 100 + month) * pt.PART_UNITS["month"]
    return items.filter(
        (F.col("hcol") >= first) & (F.col("hcol") < first + pt.PART_UNITS["month"])
    )


def latest(items: DataFrame) -> DataFrame:
    """Latest item per product (highest ``fid`` among equals), by partial aggregation."""
    return (
        items.groupBy("pid").agg(F.max(F.struct("hcol", "fid")).alias("last"))
        .select("pid", "last.fid", "last.hcol")
    )


def page(items: DataFrame, number: int, size: int, descending: bool = False) -> DataFrame:
    """One page of each product's items, in date order."""
    by = F.col("hcol").desc() if descending else F.col("hcol").asc()
    order = Window.partitionBy("pid").orderBy(by, F.col("fid").asc())
    ranked = items.withColumn("rank_", F.row_number().over(order))
    # The upper bound alone is what lets the rank limit run before the shuffle.
    return ranked.filter(
        (F.col("rank_") <= (number + 1) * size) & (F.col("rank_") > number * size)
    ).drop("rank_")


def at_or_before(requests: DataFrame, items: DataFrame, at: str = "h") -> DataFrame:
    """For each request ``(pid, at, …)`` the nearest item not after it (as-of join).

    A product may own a third of all rows, so no window spans a whole product. Items
    and request times are made distinct, then split by day: inside a day a window
    sees at most one row per second and side; across days the last item is carried
    over one row per (product, day). Both windows are bounded by the calendar.
    """
    item = F.struct("hcol", "fid")
    events = items.groupBy("pid", "hcol").agg(F.max("fid").alias("fid")).select(
        "pid", idiv("hcol", DAY).alias("day"), F.col("hcol").alias("t"), F.lit(0).alias("kind"),
        item.alias("item"),
    )
    asked = requests.select("pid", F.col(at).alias("t")).filter(F.col("t").isNotNull()).distinct()
    asked = asked.select(
        "pid", idiv("t", DAY).alias("day"), "t", F.lit(1).alias("kind"),
        F.lit(None).cast(events.schema["item"].dataType).alias("item"),
    )
    both = events.unionByName(asked)
    before = Window.partitionBy("pid").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        both.groupBy("pid", "day").agg(F.max("item").alias("last"))
        .withColumn("carried", F.last("last", ignorenulls=True).over(before))
        .select("pid", "day", "carried")
    )
    upto = (
        Window.partitionBy("pid", "day").orderBy("t", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = (
        both.withColumn("found", F.last("item", ignorenulls=True).over(upto))
        .filter("kind = 1")
        .join(carried, ["pid", "day"])
        .select("pid", F.col("t").alias(at), F.coalesce("found", "carried").alias("found"))
    )
    return requests.join(answers, ["pid", at], "left").select(
        *requests.columns, "found.fid", "found.hcol"
    )
