"""Small helpers shared by the column-expression modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str | int | float


def as_column(value: ColumnLike) -> Column:
    """A column for a column, a column name, or a literal number."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def idiv(a: ColumnLike, b: ColumnLike) -> Column:
    """Integer division (BIGINT), truncating towards zero."""
    return F.call_function("div", as_column(a), as_column(b))
