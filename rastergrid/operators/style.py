"""Colours of values: discrete, linear, exact, gray, rgb and rgba styles.

A style known when the query is built becomes one CASE expression, which code
generation handles; styles that differ per row come from a table and are searched
inside the row. Neither way multiplies pixel rows by colour stops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STYLE_SCHEMA = (
    "bands array<int>, type string, "
    "colors array<struct<val:double,r:int,g:int,b:int,a:int,lbl:string>>, "
    "nodatacolor struct<val:double,r:int,g:int,b:int,a:int,lbl:string>, "
    "vranges array<struct<minval:double,maxval:double>>"
)
PARTS = ("r", "g", "b", "a")
# The ramp and the style used when none is given.
GREEN_RAMP = [{"val": 25.0 * i, "r": 0, "g": 25 * i, "b": 0, "a": 255, "lbl": "ll"} for i in range(10)]
GRAY_LINEAR = [
    {"val": 1.0, "r": 0, "g": 0, "b": 0, "a": 255},
    {"val": 255.0, "r": 255, "g": 255, "b": 255, "a": 255},
]
TRANSPARENT = {"r": 0, "g": 0, "b": 0, "a": 0}


def parse_styles(rows: DataFrame) -> DataFrame:
    """Style columns from ``(styleid, styleContent)``."""
    return rows.select("styleid", F.from_json("styleContent", STYLE_SCHEMA).alias("s")).select("styleid", "s.*")


def _struct(values) -> Column:
    return F.struct(*(values[p].cast("int").alias(p) for p in PARTS))


def _literal(color: dict) -> Column:
    return _struct({p: F.lit(color[p]) for p in PARTS})


def discrete(value: Column, stops: list[dict], nodata: dict = TRANSPARENT) -> Column:
    """Colour of the highest stop not above the value; nodata colour below the first."""
    result = F.when(value.isNull(), _literal(nodata))
    for stop in sorted(stops, key=lambda s: -s["val"]):
        result = result.when(value >= stop["val"], _literal(stop))
    return result.otherwise(_literal(nodata))


def exact(value: Column, stops: list[dict], nodata: dict = TRANSPARENT) -> Column:
    """Colour of the stop equal to the value, else the nodata colour."""
    result = F.when(value.isNull(), _literal(nodata))
    for stop in stops:
        result = result.when(value == stop["val"], _literal(stop))
    return result.otherwise(_literal(nodata))


def _between(value: Column, low_value, high_value, low, high) -> Column:
    share = (value - low_value) / (high_value - low_value)
    return F.floor(low + (high - low) * share + 0.5)


def linear(value: Column, stops: list[dict], nodata: dict = TRANSPARENT) -> Column:
    """Colour interpolated between neighbouring stops, the end colours beyond them."""
    ordered = sorted(stops, key=lambda s: s["val"])
    result = F.when(value.isNull(), _literal(nodata)).when(value <= ordered[0]["val"], _literal(ordered[0]))
    for low, high in zip(ordered, ordered[1:]):
        mixed = {
            p: _between(value, low["val"], high["val"], F.lit(low[p]), F.lit(high[p])) for p in PARTS
        }
        result = result.when(value < high["val"], _struct(mixed))
    return result.otherwise(_literal(ordered[-1]))


def stretch(value: Column, low, high) -> Column:
    """Value range to 0..255; of a range without width, 255 from its value on and 0 below."""
    low, high = (v if isinstance(v, Column) else F.lit(float(v)) for v in (low, high))
    share = F.try_divide(value - low, F.when(high == low, F.lit(None)).otherwise(high - low))
    flat = F.when(value >= low, F.lit(255)).when(value < low, F.lit(0))
    return F.when(high == low, flat).otherwise(
        F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.floor(share * 255 + 0.5))).cast("int"))
    )


def composed(values: list[Column], ranges: list[tuple[float, float]]) -> Column:
    """Colour of one (gray), three (rgb) or four (rgba) stretched bands."""
    parts = [stretch(v, low, high) for v, (low, high) in zip(values, ranges)]
    if len(parts) == 1:
        parts = parts * 3
    if len(parts) == 3:
        parts.append(F.lit(255))
    return _struct(dict(zip(PARTS, parts)))


def table_color(value: Column, kind: Column, colors: Column, nodata: Column, values: Column, ranges: Column) -> Column:
    """Colour by a style held in the row: its type, its stops sorted by value, its value ranges.

    Discrete, linear and exact styles look at ``value``; gray, rgb and rgba stretch the first one,
    three or four of ``values`` by the range of the same place (0 to 255 where the style has none). Where a value is
    NULL or missing the colour is that of nodata.
    """
    below = F.filter(colors, lambda c: c["val"] <= value)
    above = F.filter(colors, lambda c: c["val"] > value)
    low = F.try_element_at(below, F.lit(-1))
    high = F.try_element_at(above, F.lit(1))
    same = F.try_element_at(F.filter(colors, lambda c: c["val"] == value), F.lit(1))
    mixed = _struct({p: _between(value, low["val"], high["val"], low[p], high[p]) for p in PARTS})
    none = _struct({p: F.coalesce(nodata[p], F.lit(0)) for p in PARTS})

    def whole(stop: Column) -> Column:
        return F.when(stop.isNotNull(), _struct({p: stop[p] for p in PARTS}))

    def band(place: int) -> Column:
        limits = F.get(ranges, F.lit(place))
        low_, high_ = F.coalesce(limits["minval"], F.lit(0.0)), F.coalesce(limits["maxval"], F.lit(255.0))
        return stretch(F.get(values, F.lit(place)), low_, high_)

    def bands(*parts: Column) -> Column:
        known = parts[0].isNotNull()
        for part in parts[1:]:
            known = known & part.isNotNull()
        four = [*parts, F.lit(255)] if len(parts) == 3 else parts
        return F.when(known, _struct(dict(zip(PARTS, four))))

    stepped = (
        F.when(kind == "discrete", whole(low))
        .when(kind == "exact", whole(same))
        .when(
            kind == "linear",
            F.when(low.isNull(), whole(high)).when(high.isNull(), whole(low)).otherwise(mixed),
        )
    )
    by_kind = (
        F.when(kind == "gray", bands(band(0), band(0), band(0)))
        .when(kind == "rgb", bands(band(0), band(1), band(2)))
        .when(kind == "rgba", bands(band(0), band(1), band(2), band(3)))
        .otherwise(F.when(value.isNotNull(), stepped))
    )
    return F.coalesce(by_kind, none)


def apply_styles(pixels: DataFrame, styles: DataFrame, value: str = "dn", values: str | None = None) -> DataFrame:
    """Add ``color`` to pixels with a ``styleid`` from a parsed style table.

    ``value`` is what stops are compared with. ``values`` names an array with the pixel's bands, of which the
    style's ``bands`` choose those to stretch (the first ones where it has none); without it the only band is ``value``.
    """
    sorted_styles = styles.select(
        "styleid",
        F.col("type").alias("kind_"),
        F.array_sort("colors").alias("colors_"),
        F.col("nodatacolor").alias("nodata_"),
        F.col("bands").alias("bands_"),
        F.col("vranges").alias("ranges_"),
    )
    own = F.array(F.col(value).cast("double")) if values is None else F.col(values)
    chosen = F.when(F.size("bands_") > 0, F.transform("bands_", lambda b: F.get(own, b))).otherwise(own)
    color = table_color(F.col(value), F.col("kind_"), F.col("colors_"), F.col("nodata_"), chosen, F.col("ranges_"))
    joined = pixels.join(sorted_styles, "styleid", "left")
    return joined.withColumn("color", color).drop("kind_", "colors_", "nodata_", "bands_", "ranges_")
