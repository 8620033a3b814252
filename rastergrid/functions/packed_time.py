"""Packed ``yyyyMMddHHmmss`` BIGINT dates.

A packed date need not be a real timestamp (a monthly product uses day 00), so it is
kept as a number throughout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnLike, as_column, idiv

# Place of each part inside the packed number.
PART_UNITS = {
    "year": 10_000_000_000,
    "month": 100_000_000,
    "day": 1_000_000,
    "hour": 10_000,
    "minute": 100,
    "second": 1,
}
IGNORE = -1

# Display text per time scale (1 second, 2 minute, 3 hour, 4 day,
# 5 month, 6 season, 7 year) and per season month.
LABEL_FORMATS = {
    1: ("%04d年%02d月%02d日 %02d:%02d:%02d", ("year", "month", "day", "hour", "minute", "second")),
    2: ("%04d年%02d月%02d日 %02d:%02d", ("year", "month", "day", "hour", "minute")),
    3: ("%04d年%02d月%02d日 %02d时", ("year", "month", "day", "hour")),
    4: ("%04d年%02d月%02d日", ("year", "month", "day")),
    5: ("%04d年%02d月", ("year", "month")),
    7: ("%04d年", ("year",)),
}
SEASON_SCALE = 6
SEASON_FORMATS = {3: "%04d年春季", 6: "%04d年夏季", 9: "%04d年秋季", 12: "%04d年冬季"}

TEMPLATE_DAYS = 7


def part(dt: ColumnLike, name: str) -> Column:
    """One part of a packed date as INT."""
    value = idiv(dt, F.lit(PART_UNITS[name]))
    return (value if name == "year" else value % 100).cast("int")


def parts(dt: ColumnLike) -> Column:
    """Struct of all six parts."""
    return F.struct(*(part(dt, name).alias(name) for name in PART_UNITS))


def pack(ts: ColumnLike) -> Column:
    """Packed form of a timestamp."""
    return F.date_format(as_column(ts), "yyyyMMddHHmmss").cast("bigint")


def to_timestamp(dt: ColumnLike) -> Column:
    """Timestamp of a packed date; NULL when it is not a real one (day 00)."""
    return F.try_to_timestamp(
        F.lpad(as_column(dt).cast("string"), 14, "0"), F.lit("yyyyMMddHHmmss")
    )


def stamp_text(ts: ColumnLike) -> Column:
    """Run stamp text ``yyyy/MM/dd HH:mm:ss``."""
    return F.date_format(as_column(ts), "yyyy/MM/dd HH:mm:ss")


def passes(
    dt: ColumnLike,
    month: ColumnLike = IGNORE,
    day: ColumnLike = IGNORE,
    hour: ColumnLike = IGNORE,
    minute: ColumnLike = IGNORE,
    second: ColumnLike = IGNORE,
) -> Column:
    """True when every part that is not ``-1`` matches."""
    wanted = {"month": month, "day": day, "hour": hour, "minute": minute, "second": second}
    result = F.lit(True)
    for name, value in wanted.items():
        if isinstance(value, int) and value == IGNORE:
            continue
        value = as_column(value)
        result = result & ((value == IGNORE) | (part(dt, name) == value))
    return result


def label(dt: ColumnLike, time_scale: ColumnLike) -> Column:
    """Display text of a packed date for a time scale; other scales give the number."""
    dt, time_scale = as_column(dt), as_column(time_scale)
    raw = dt.cast("string")
    month = part(dt, "month")
    season = F.when(F.lit(False), raw)
    for number, pattern in SEASON_FORMATS.items():
        season = season.when(month == number, F.format_string(pattern, part(dt, "year")))
    text = F.when(time_scale == SEASON_SCALE, season.otherwise(raw))
    for scale, (pattern, names) in LABEL_FORMATS.items():
        text = text.when(
            time_scale == scale, F.format_string(pattern, *(part(dt, n) for n in names))
        )
    return text.otherwise(raw)


def fill_template(text: ColumnLike, today: ColumnLike) -> Column:
    """Replace ``{{{DATE}}}`` and ``{{{DATE-n}}}`` (n = 0..7) by ``yyyyMMdd`` texts."""
    result, today = as_column(text), as_column(today)
    for days in range(TEMPLATE_DAYS + 1):
        value = F.date_format(F.date_sub(today, days), "yyyyMMdd")
        if days == 0:
            result = F.replace(result, F.lit("{{{DATE}}}"), value)
        result = F.replace(result, F.lit("{{{DATE-%d}}}" % days), value)
    return result
