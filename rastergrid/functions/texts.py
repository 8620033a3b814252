"""Small text formats: region ids, extents, pair lists and formatted names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnLike, as_column


def split_parts(text: ColumnLike, separator: str) -> Column:
    """Split where trailing empty parts do not count."""
    return F.split(F.rtrim(as_column(text), F.lit(separator)), separator)


def nonempty_parts(text: ColumnLike, separator: str = ";") -> Column:
    """Split and drop all empty parts."""
    return F.filter(F.split(as_column(text), separator), lambda part: part != "")


def region_id(text: ColumnLike) -> Column:
    """Struct ``prefix, id`` of ``"prefix:number"``; NULL for any other form."""
    bits = split_parts(text, ":")
    number = F.try_element_at(bits, F.lit(2)).try_cast("int")
    return F.when(
        (F.size(bits) == 2) & number.isNotNull(),
        F.struct(F.element_at(bits, 1).alias("prefix"), number.alias("id")),
    )


def region_route(text: ColumnLike) -> Column:
    """Which store a region text names: ``user``, ``sys``, ``file``; NULL when empty."""
    text = as_column(text)
    return (
        F.when(F.length(text) == 0, F.lit(None).cast("string"))
        .when(text.contains("user:"), "user")
        .when(text.contains("sys:"), "sys")
        .otherwise("file")
    )


def extent(text: ColumnLike) -> Column:
    """Struct ``left, right, top, bottom`` of ``"l,r,t,b"``; NULL for any other form."""
    bits = split_parts(text, ",")
    names = ("left", "right", "top", "bottom")
    numbers = [
        F.trim(F.try_element_at(bits, F.lit(i + 1))).try_cast("double") for i in range(4)
    ]
    valid = F.size(bits) == 4
    for number in numbers:
        valid = valid & number.isNotNull()
    return F.when(valid, F.struct(*(n.alias(name) for n, name in zip(numbers, names))))


def is_user_file(name: ColumnLike) -> Column:
    """True for the names of user files, which begin with a slash."""
    return as_column(name).startswith("/")


def digest(text: ColumnLike) -> Column:
    """MD5 as 32 lower-case hex digits."""
    return F.md5(as_column(text))


def user_product_name(pid: ColumnLike) -> Column:
    return F.concat(F.lit("user/"), as_column(pid).cast("string"))


def band_name(position: ColumnLike) -> Column:
    """``B1`` for the band at position 0, and so on."""
    return F.concat(F.lit("B"), (as_column(position) + 1).cast("string"))
