"""Salted binary row keys: ``bucket | hpid | z | y | x``, big-endian.

The product id takes 1 or 4 bytes and each of y and x 2 or 4 bytes; the lengths
may be literals or columns, so one query can mix storage tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnLike, as_column

BUCKETS = 10


def bucket(y: ColumnLike, x: ColumnLike) -> Column:
    """Salt of a tile."""
    return (as_column(x) + as_column(y)) % BUCKETS


def big_endian(value: ColumnLike, length: int) -> Column:
    """The low ``length`` bytes of an integer, most significant first."""
    # hex() of a BIGINT is two's complement, so the low digits are right for
    # negative numbers too; lpad alone would keep the wrong end of them.
    digits = F.lpad(F.hex(as_column(value).cast("bigint")), 16, "0")
    return F.unhex(F.substring(digits, 17 - 2 * length, 2 * length))


def signed_int(data: Column, start: Column | int, length: int) -> Column:
    """Signed integer from ``length`` big-endian bytes at 1-based ``start``."""
    part = F.substring(data, start, length)
    unsigned = F.conv(F.hex(part), 16, 10).cast("bigint")
    top = 1 << (8 * length - 1)
    return F.when(unsigned >= top, unsigned - 2 * top).otherwise(unsigned).cast("int")


def _pick(length: Column, short: int, when_short: Column, otherwise: Column) -> Column:
    return F.when(length == short, when_short).otherwise(otherwise)


def encode(
    hpid: ColumnLike,
    z: ColumnLike,
    y: ColumnLike,
    x: ColumnLike,
    hpid_len: ColumnLike = 4,
    yx_len: ColumnLike = 4,
    bucket_id: ColumnLike | None = None,
) -> Column:
    """Row key of a tile; ``bucket_id`` overrides the computed salt."""
    salt = bucket(y, x) if bucket_id is None else as_column(bucket_id)
    hpid_len, yx_len = as_column(hpid_len), as_column(yx_len)
    return F.concat(
        big_endian(salt, 1),
        _pick(hpid_len, 1, big_endian(hpid, 1), big_endian(hpid, 4)),
        big_endian(z, 1),
        _pick(yx_len, 2, big_endian(y, 2), big_endian(y, 4)),
        _pick(yx_len, 2, big_endian(x, 2), big_endian(x, 4)),
    )


def decode(key: ColumnLike, hpid_len: ColumnLike = 4, yx_len: ColumnLike = 4) -> Column:
    """Struct ``bucket, hpid, z, y, x`` of a row key; NULL when its length is wrong.

    All parts are signed, as the key bytes are.
    """
    key, hpid_len, yx_len = as_column(key), as_column(hpid_len), as_column(yx_len)
    short_id, short_yx = hpid_len == 1, yx_len == 2
    id_bytes = F.when(short_id, 1).otherwise(4)
    yx_bytes = F.when(short_yx, 2).otherwise(4)
    z_at = id_bytes + 2
    y_at = z_at + 1
    x_at = y_at + yx_bytes

    def coordinate(at: Column) -> Column:
        return F.when(short_yx, signed_int(key, at, 2)).otherwise(signed_int(key, at, 4))

    parts = F.struct(
        signed_int(key, 1, 1).alias("bucket"),
        F.when(short_id, signed_int(key, 2, 1)).otherwise(signed_int(key, 2, 4)).alias("hpid"),
        signed_int(key, z_at, 1).alias("z"),
        coordinate(y_at).alias("y"),
        coordinate(x_at).alias("x"),
    )
    return F.when(F.octet_length(key) == F.lit(2) + id_bytes + yx_bytes * 2, parts)


def tile_path(
    htable: ColumnLike, hpid: ColumnLike, dt: ColumnLike, z: ColumnLike, y: ColumnLike, x: ColumnLike
) -> Column:
    """Relative path of a tile file."""
    return F.format_string(
        "%s/%d/%d/tile_%d_%d_%d", *map(as_column, (htable, hpid, dt, z, y, x))
    )
