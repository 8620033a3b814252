"""Packed-date and data-item queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rastergrid.functions import packed_time as pt
from rastergrid.operators import dates

from .base import query

ORDER_DT = "strftime(o_orderdate, '%Y%m%d')::bigint * 1000000 + (o_orderkey % 24) * 10000 + (o_orderkey % 60) * 100 + o_orderkey % 59"


def order_dates(d):
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyyMMdd").cast("bigint") * 1000000
    return d.table("orders").select(
        "o_orderkey", "o_custkey", (day + (k % 24) * 10000 + (k % 60) * 100 + k % 59).alias("dt")
    )


@query("date_parts", f"""
    SELECT o_orderkey, (dt // 10000000000)::int AS year, (dt // 100000000 % 100)::int AS month,
           (dt // 1000000 % 100)::int AS day, (dt // 10000 % 100)::int AS hour,
           (dt // 100 % 100)::int AS minute, (dt % 100)::int AS second
    FROM (SELECT o_orderkey, {ORDER_DT} AS dt FROM orders)""")
def date_parts(d):
    """The six parts of packed dates."""
    return order_dates(d).select("o_orderkey", pt.parts("dt").alias("p")).select("o_orderkey", "p.*")


@query("date_filter", f"""
    SELECT o_orderkey, dt FROM (SELECT o_orderkey, {ORDER_DT} AS dt FROM orders)
    WHERE dt BETWEEN 19960301000000 AND 20000715120000 AND dt // 100000000 % 100 = 6 AND dt // 10000 % 100 = 8""")
def date_filter(d):
    """Range and part filter: June, 8 o'clock."""
    rows = order_dates(d).select("o_orderkey", "dt")
    return rows.filter(dates.in_range("dt", 19960301000000, 20000715120000)).filter(
        pt.passes("dt", month=6, hour=8)
    )


@query("date_cap30", """
    SELECT hpid, y, x, band, dt FROM (
        SELECT DISTINCT hpid, y, x, band, dt FROM pixels WHERE dt BETWEEN 19950000000000 AND 20010000000000)
    QUALIFY row_number() OVER (PARTITION BY hpid, y, x, band ORDER BY dt) <= 30""", ("pixels",))
def date_cap30(d):
    """The first 30 dates of every tile and band."""
    keys = ["hpid", "y", "x", "band"]
    rows = d.pixels().filter(dates.in_range("dt", 19950000000000, 20010000000000))
    return dates.first_dates(rows.select(*keys, "dt").distinct(), keys, dates.DATE_CAP)


@query("date_grid", """
    SELECT c_custkey, dt FROM (
        SELECT c_custkey, startdt, stopdt, yr * 10000000000 + m * 100000000 + dd * 1000000 + 6 * 10000 AS dt
        FROM (SELECT c_custkey, c_custkey % 13 AS month, c_custkey % 30 AS day,
                     (1996 + c_custkey % 3) * 10000000000 + 200000000 AS startdt, 19990315000000 AS stopdt FROM customer) r,
             range(1996, 2000) AS t1(yr), range(1, 13) AS t2(m), range(1, 32) AS t3(dd)
        WHERE yr >= startdt // 10000000000 AND (month = 0 OR month = m) AND (day = 0 OR day = dd)
          AND NOT (month = 0 AND day = 0))
    WHERE dt BETWEEN startdt AND stopdt""")
def date_grid(d):
    """Generated dates with one open part; two open parts give nothing."""
    k = F.col("c_custkey")

    def part(modulus):
        value = (k % modulus).cast("int")
        return F.when(value == 0, pt.IGNORE).otherwise(value)

    requests = d.table("customer").select(
        "c_custkey",
        ((1996 + k % 3) * 10000000000 + 200000000).alias("startdt"),
        F.lit(19990315000000).alias("stopdt"),
        part(13).alias("month"), part(30).alias("day"),
        F.lit(6).alias("hour"), F.lit(0).alias("minute"), F.lit(0).alias("second"),
    )
    return dates.date_grid(requests, ["c_custkey"])


@query("date_labels", """
    SELECT fid, CASE (fid % 9) WHEN 1 THEN strftime(d, '%Y年%m月%d日 00:00:00') WHEN 2 THEN strftime(d, '%Y年%m月%d日 00:00')
        WHEN 3 THEN strftime(d, '%Y年%m月%d日 00时') WHEN 4 THEN strftime(d, '%Y年%m月%d日')
        WHEN 5 THEN strftime(d, '%Y年%m月')
        WHEN 6 THEN CASE month(d) WHEN 3 THEN year(d) || '年春季' WHEN 6 THEN year(d) || '年夏季'
             WHEN 9 THEN year(d) || '年秋季' WHEN 12 THEN year(d) || '年冬季' ELSE hcol::varchar END
        WHEN 7 THEN strftime(d, '%Y年') ELSE hcol::varchar END AS label
    FROM (SELECT fid, hcol, strptime((hcol // 1000000)::varchar, '%Y%m%d') AS d FROM data_item)""", ("data_item",))
def date_labels(d):
    """Display text of items for every time scale."""
    return d.data_item().select("fid", pt.label("hcol", F.col("fid") % 9).alias("label"))


@query("date_template", """
    SELECT dpid,
        CASE WHEN type = 'xyz' AND dpid % 9 < 8 THEN replace(productname, '{{{DATE-' || dpid % 9 || '}}}',
             strftime(DATE '2024-02-01' - (dpid % 9)::int, '%Y%m%d')) ELSE productname END AS productname,
        CASE WHEN type = 'xyz' THEN replace(params, '{{{DATE}}}', '20240201') ELSE params END AS params
    FROM product_display""", ("product_display",))
def date_template(d):
    """Date marks filled in for layers of type xyz only."""
    from rastergrid.operators import catalog

    rows = catalog.fill_display_dates(d.product_display(), F.to_date(F.lit("2024-02-01")))
    return rows.select("dpid", "productname", "params")


@query("date_every_n", """
    SELECT c_custkey, strftime(ts, '%Y%m%d%H%M%S')::bigint AS dt FROM (
        SELECT c_custkey, c_custkey % 2 AS kind, TIMESTAMP '2020-01-15 00:00:00' AS t0, TIMESTAMP '2020-07-15 00:00:00' AS t1,
               unnest(CASE WHEN c_custkey % 2 = 0
                 THEN generate_series(TIMESTAMP '2020-01-15 00:00:00', TIMESTAMP '2020-07-15 00:00:00', to_months((1 + c_custkey % 3)::int))
                 ELSE generate_series(TIMESTAMP '2020-01-15 00:00:00', TIMESTAMP '2020-07-15 00:00:00', to_days((7 + c_custkey % 5)::int)) END) AS ts
        FROM customer WHERE c_custkey % 7 <> 0)
    WHERE ts > t0 OR c_custkey % 3 <> 0""")
def date_every_n(d):
    """Dates at a step of months or days; a start with day 00 gives none."""
    k = F.col("c_custkey")
    zero = F.lit(0)
    requests = d.table("customer").select(
        "c_custkey",
        F.when(k % 7 == 0, F.lit(20200100000000)).otherwise(F.lit(20200115000000)).alias("startdt"),
        F.lit(20200715000000).alias("stopdt"),
        (k % 3 != 0).alias("start_inclusive"), F.lit(True).alias("stop_inclusive"),
        zero.alias("years"), F.when(k % 2 == 0, 1 + k % 3).otherwise(0).cast("int").alias("months"),
        F.when(k % 2 == 1, 7 + k % 5).otherwise(0).cast("int").alias("days"),
        zero.alias("hours"), zero.alias("minutes"), zero.alias("seconds"),
    )
    return dates.every_n(requests, ["c_custkey"])


@query("run_stamp", """
    SELECT event_id, strftime(ts, '%Y%m%d%H%M%S')::bigint AS packed, strftime(ts, '%Y/%m/%d %H:%M:%S') AS text
    FROM events""")
def run_stamp(d):
    """Packed and text stamps of event times."""
    return d.table("events").select(
        "event_id", pt.pack("ts").alias("packed"), pt.stamp_text("ts").alias("text")
    )


@query("item_years", "SELECT DISTINCT pid, (hcol // 10000000000)::int AS year FROM data_item", ("data_item",))
def item_years(d):
    """Years with items, per product."""
    return dates.years(d.data_item())


@query("item_months", """
    SELECT DISTINCT pid, (hcol // 10000000000)::int AS year, (hcol // 100000000 % 100)::int AS month FROM data_item""",
       ("data_item",))
def item_months(d):
    """Months with items, per product and year."""
    return dates.months(d.data_item())


@query("item_month_list", """
    SELECT fid, pid, hcol, strftime(strptime((hcol // 1000000)::varchar, '%Y%m%d'), '%Y年%m月%d日') AS label
    FROM data_item WHERE hcol >= 19980500000000 AND hcol < 19980600000000""", ("data_item",))
def item_month_list(d):
    """Items of May 1998 with their display text."""
    return dates.month_items(d.data_item(), 1998, 5).withColumn("label", pt.label("hcol", F.lit(4)))


@query("item_asof", """
    SELECT r.event_id, r.pid, r.h, i.fid, i.hcol FROM asof_request r
    ASOF LEFT JOIN (SELECT pid, hcol, max(fid) AS fid FROM data_item GROUP BY ALL) i
      ON r.pid = i.pid AND r.h >= i.hcol""", ("asof_request", "data_item"))
def item_asof(d):
    """Nearest item at or before each request."""
    return dates.at_or_before(d.asof_request(), d.data_item())


@query("item_latest", """
    SELECT pid, max(fid) AS fid, hcol FROM data_item
    WHERE (pid, hcol) IN (SELECT (pid, max(hcol)) FROM data_item GROUP BY pid) GROUP BY pid, hcol""", ("data_item",))
def item_latest(d):
    """Latest item of each product."""
    return dates.latest(d.data_item())


@query("item_page", """
    SELECT pid, fid, hcol FROM data_item
    QUALIFY row_number() OVER (PARTITION BY pid ORDER BY hcol DESC, fid) BETWEEN 11 AND 20""", ("data_item",))
def item_page(d):
    """Second page of ten items per product, newest first."""
    return dates.page(d.data_item(), 1, 10, descending=True).select("pid", "fid", "hcol")
