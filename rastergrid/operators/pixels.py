"""Packed tiles and pixel rows: conversion, masks, composites and zonal statistics.

Two forms of the same data are used. Long form, one row per pixel, is for SQL-like
analytics and stays in the JVM. Packed form, one row per tile with its block of
bytes, is what is stored; its kernels run in numpy over Arrow batches and never
turn pixels into rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pixel_types import PIXEL_TYPES
from ..joins import broadcast_if_small, never_broadcast

# Memory one task may hold in open blocks or unpacked rows.
WORKING_BYTES = 32 << 20


def numpy_type(type_code: int) -> np.dtype:
    return np.dtype(PIXEL_TYPES[type_code][2])


def fields_of(df: DataFrame, names: list[str]) -> list[T.StructField]:
    return [T.StructField(name, df.schema[name].dataType) for name in names]


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def run_starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Positions where any key differs from the row before; position 0 included, and NULL equals NULL."""
    changed = np.zeros(batch.num_rows, dtype=bool)
    changed[0] = True
    for key in keys:
        values = _column(batch, key)
        differs = values[1:] != values[:-1]
        if batch.column(key).null_count:
            missing = batch.column(key).is_null().to_numpy(zero_copy_only=False)
            differs &= ~(missing[1:] & missing[:-1])
        changed[1:] |= differs
    return np.flatnonzero(changed)


def block_lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each block of a column."""
    return pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)


def block_matrix(column: pa.Array, dtype: np.dtype) -> np.ndarray:
    """Blocks of one length as the rows of one array, which shares their memory."""
    lengths = block_lengths(column)
    if column.null_count or (lengths != lengths[:1]).any():
        raise ValueError("blocks are missing or differ in length")
    if not lengths[:1].any():
        return np.empty((len(column), 0), dtype)
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    first = int(np.frombuffer(offsets, kind)[column.offset])
    taken = np.frombuffer(data, np.uint8, int(lengths.sum()), first)
    return taken.view(dtype).reshape(len(column), -1)


def block_array(blocks: np.ndarray) -> pa.Array:
    """The blocks of an array whose first axis counts them, as a column of bytes."""
    blocks = np.ascontiguousarray(blocks)
    each = blocks.nbytes // max(1, len(blocks))
    offsets = np.arange(len(blocks) + 1, dtype=np.int32) * np.int32(each)
    return pa.Array.from_buffers(pa.binary(), len(blocks), [None, pa.py_buffer(offsets), pa.py_buffer(blocks)])


WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _halves(name: str) -> list[Column]:
    """A long as two doubles, each of which holds its 32 bits exactly."""
    return [F.shiftright(name, 32).cast("double"), F.col(name).bitwiseAND(F.lit(0xFFFFFFFF)).cast("double")]


def _long(halves: np.ndarray) -> np.ndarray:
    """The longs that ``_halves`` made, of the two columns of an array; 0 where they are missing."""
    known = np.where(np.isfinite(halves), halves, 0).astype(np.int64)
    return (known[:, 0] << 32) | known[:, 1]


def _key_starts(numbers: np.ndarray, codes: list[np.ndarray]) -> np.ndarray:
    """Positions where a row of ``numbers`` or a code differs from the one before; position 0 included."""
    changed = np.ones(len(numbers), bool)
    changed[1:] = (numbers[1:] != numbers[:-1]).any(axis=1)
    for code in codes:
        changed[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(changed)


class _OpenTile:
    """A tile that may go on in the next batch: its keys, as a batch of one row, its block and the value at each position so far."""

    def __init__(self, named: pa.RecordBatch, empty: np.ndarray):
        self.named, self.block = named, empty
        self.dn, self.rank = np.zeros(empty.shape[1]), np.zeros(empty.shape[1], np.int8)

    def add(self, at: np.ndarray, dn: np.ndarray, stored: np.ndarray, known: np.ndarray, largest: bool) -> None:
        """Rows that come later; of ``largest`` ones each comes after all smaller rows of its position."""
        at = np.where(at < 0, at + len(self.dn), at)
        place, last = np.unique(at[::-1], return_index=True)
        last = len(at) - 1 - last
        rank = np.where(known[last], 2, 1)
        if largest:
            before, level = self.dn[place], self.rank[place]
            higher = (rank > level) | ((rank == level) & ((dn[last] >= before) | np.isnan(dn[last])))
            place, last, rank = place[higher], last[higher], rank[higher]
        self.dn[place], self.rank[place], self.block[0, place] = dn[last], rank, stored[last]


def pack_tiles(
    pixels: DataFrame,
    keys: list[str],
    bands: int,
    width: int,
    height: int,
    type_code: int,
    fill: float,
    largest: bool = False,
) -> DataFrame:
    """Pixel rows ``(keys…, band, row, col, dn)`` to one block per key.

    Positions must be unique per key, unless of several values at one the ``largest`` is to stay.
    Rows arrive sorted by one hash of their key, which takes no comparisons of rows, and are scattered many
    tiles at a time; keys of equal hashes are told apart here. A task holds a bounded number of open blocks. Whole
    numbers travel to Python as one array column: Spark measures each column of a batch again for every row.
    """
    dtype = numpy_type(type_code)
    cells = bands * width * height
    at_once = max(1, WORKING_BYTES // (cells * dtype.itemsize))
    key_fields = fields_of(pixels, keys)
    schema = T.StructType([*key_fields, T.StructField("data", T.BinaryType())])
    whole = [f.name for f in key_fields if isinstance(f.dataType, WHOLE)]
    others = [k for k in keys if k not in whole]
    # The hash, the keys that are whole numbers, the position and the value.
    numbers, places = _halves("hash_"), {}
    for field in key_fields:
        if field.name in whole:
            parts = _halves(field.name) if isinstance(field.dataType, T.LongType) else [F.col(field.name).cast("double")]
            places[field.name] = (len(numbers), len(numbers) + len(parts))
            numbers = [*numbers, *parts]
    end = len(numbers)
    numbers = [*numbers, F.col("at_").cast("double"), F.col("dn").cast("double")]
    kinds = {T.ByteType: pa.int8(), T.ShortType: pa.int16(), T.IntegerType: pa.int32(), T.LongType: pa.int64()}
    types = {f.name: kinds[type(f.dataType)] for f in key_fields if f.name in whole}

    def key_column(batch, matrix, key, rows):
        if key not in places:
            return batch.column(key).take(pa.array(rows))
        first, stop = places[key]
        found = matrix[rows, first:stop]
        missing = np.isinf(found[:, 0])
        values = _long(found) if stop - first == 2 else np.where(missing, 0, found[:, 0]).astype(np.int64)
        return pa.array(values, pa.int64(), mask=missing).cast(types[key])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The tiles of the last hash of a batch, by key.
        open_hash, open_tiles = None, {}

        def emit(found, blocks):
            return pa.RecordBatch.from_arrays([*found.columns, block_array(blocks)], [*keys, "data"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            values = batch.column("numbers_").flatten()
            matrix = values.to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            known = np.ones(batch.num_rows, bool)
            if values.null_count:
                missing = values.is_null().to_numpy(zero_copy_only=False).reshape(matrix.shape)
                if missing[:, end].any():
                    raise IndexError("the band, row or column of a pixel is missing")
                known = ~missing[:, end + 1]
                # No whole number is infinite, and a missing key equals a missing key.
                matrix = np.where(missing & (np.arange(matrix.shape[1]) < end), np.inf, matrix)
            codes = [pc.dictionary_encode(batch.column(k), null_encoding="encode").indices.to_numpy() for k in others]

            hashes, starts = _key_starts(matrix[:, :2], []), _key_starts(matrix[:, :end], codes)
            if len(starts) != len(hashes):
                # Keys of one hash: their rows are brought together, in the order in which they came.
                run = np.repeat(np.arange(len(hashes)), np.diff(np.append(hashes, len(matrix))))
                order = np.lexsort((*codes, *matrix[:, 2:end].T, run))
                batch, matrix, known, codes = batch.take(pa.array(order)), matrix[order], known[order], [c[order] for c in codes]
                starts = _key_starts(matrix[:, :end], codes)
            named = pa.RecordBatch.from_arrays([key_column(batch, matrix, k, starts) for k in keys], keys)
            bounds = np.append(starts, len(matrix))
            at, dn = matrix[:, end].astype(np.int64), np.ascontiguousarray(matrix[:, end + 1])
            stored = dn.astype(dtype)
            if (outside := (at < -cells) | (at >= cells)).any():
                raise IndexError(f"position {at[outside][0]} is outside a tile of {cells}")

            def ordered(lo, hi):
                """Rows so that of a position the one that stays comes last: the largest, a missing value before all others."""
                if not largest:
                    return np.arange(lo, hi)
                return lo + (np.argsort(dn[lo:hi]) if known[lo:hi].all() else np.lexsort((dn[lo:hi], known[lo:hi])))

            def hold(first, stop):
                for k in range(first, stop):
                    rows, key = ordered(bounds[k], bounds[k + 1]), tuple(c[k].as_py() for c in named.columns)
                    if key not in open_tiles:
                        open_tiles[key] = _OpenTile(named.slice(k, 1), np.full((1, cells), fill, dtype))
                    open_tiles[key].add(at[rows], dn[rows], stored[rows], known[rows], largest)

            first_of_last = int(np.searchsorted(starts, hashes[-1]))
            first_hash, last_hash = (tuple(matrix[r, :2]) for r in (0, -1))
            done = 0
            if open_hash == first_hash:
                done = len(starts) if len(hashes) == 1 else int(np.searchsorted(starts, hashes[1]))
                hold(0, done)
            if open_hash != last_hash:
                for tile in open_tiles.values():
                    yield emit(tile.named, tile.block)
                open_hash, open_tiles = last_hash, {}
                for first in range(done, first_of_last, at_once):
                    stop = min(first + at_once, first_of_last)
                    lo, hi = bounds[first], bounds[stop]
                    blocks = np.full((stop - first, cells), fill, dtype)
                    owner = np.repeat(np.arange(stop - first), np.diff(bounds[first : stop + 1]))
                    rows = ordered(lo, hi)
                    blocks[owner[rows - lo], at[rows]] = stored[rows]
                    yield emit(named.slice(first, stop - first), blocks)
                hold(max(done, first_of_last), len(starts))
        for tile in open_tiles.values():
            yield emit(tile.named, tile.block)

    position = (F.col("band").cast("bigint") * height + F.col("row")) * width + F.col("col")
    rows = pixels.select(*keys, position.cast("bigint").alias("at_"), "dn").repartition(*keys)
    rows = rows.withColumn("hash_", F.xxhash64(*keys)).sortWithinPartitions("hash_")
    return rows.select(*others, F.array(*numbers).alias("numbers_")).mapInArrow(pack, schema)


def unpack_tiles(
    cells: DataFrame,
    keys: list[str],
    bands: int,
    width: int,
    height: int,
    type_code: int,
    skip: float | None = None,
    missing: float = 0,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Blocks to pixel rows ``(keys…, carry…, band, row, col, dn)``.

    ``skip`` drops a fill value; a NULL block counts as one full of ``missing``. Columns to ``carry``, such as the block itself,
    leave Python once a tile and become columns of its pixels without a join.
    """
    dtype = numpy_type(type_code)
    size = bands * width * height
    at_once = max(1, WORKING_BYTES // (size * 32))
    pixel = T.StructType(
        [
            T.StructField("band", T.IntegerType()),
            T.StructField("row", T.IntegerType()),
            T.StructField("col", T.IntegerType()),
            T.StructField("dn", T.DoubleType()),
        ]
    )
    schema = T.StructType([*fields_of(cells, keys), *pixel.fields])
    lists = T.StructType([*fields_of(cells, [*keys, *carry]), T.StructField("pixels", T.ArrayType(pixel))])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = np.arange(size, dtype=np.int32)
        band, row, col = index // (width * height), index // width % height, index % width
        absent = np.full(size, missing, dtype)
        for batch in batches:
            for first in range(0, batch.num_rows, at_once):
                part = batch.slice(first, at_once)
                blocks = [
                    np.frombuffer(b.as_buffer(), dtype) if b.is_valid else absent
                    for b in part.column("data")
                ]
                dn = np.concatenate(blocks).astype(np.float64)
                owner = np.repeat(np.arange(part.num_rows), size)
                place = np.tile(index, part.num_rows)
                if skip is not None:
                    keep = dn != skip
                    dn, owner, place = dn[keep], owner[keep], place[keep]
                if carry:
                    ends = np.append(0, np.cumsum(np.bincount(owner, minlength=part.num_rows))).astype(np.int32)
                    found = pa.StructArray.from_arrays([pa.array(v) for v in (band[place], row[place], col[place], dn)], pixel.names)
                    of_tiles = pa.ListArray.from_arrays(pa.array(ends), found)
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in (*keys, *carry)], of_tiles], lists.names)
                    continue
                taken = [part.column(k).take(pa.array(owner)) for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [*taken, pa.array(band[place]), pa.array(row[place]), pa.array(col[place]), pa.array(dn)],
                    schema.names,
                )

    if carry:
        tiles = cells.select(*dict.fromkeys([*keys, *carry, "data"])).mapInArrow(unpack, lists)
        return tiles.select(*keys, *carry, F.inline("pixels"))
    return cells.select(*keys, "data").mapInArrow(unpack, schema)


def block_statistics(
    cells: DataFrame, keys: list[str], type_code: int, skip: float | None = None
) -> DataFrame:
    """``n, total, low, high`` of every block, without turning pixels into rows.

    ``skip`` leaves out a fill value; a NULL block counts nothing.
    """
    dtype = numpy_type(type_code)
    schema = T.StructType(
        [
            *fields_of(cells, keys),
            T.StructField("n", T.LongType()),
            T.StructField("total", T.DoubleType()),
            T.StructField("low", T.DoubleType()),
            T.StructField("high", T.DoubleType()),
        ]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = block_lengths(batch.column("data"))
            # Sums of small integers do not depend on their order.
            if dtype.kind in "iu" and dtype.itemsize <= 4 and not batch.column("data").null_count and (lengths == lengths[:1]).all() and lengths[:1].any():
                at_once = max(1, WORKING_BYTES // (int(lengths[0]) // dtype.itemsize * 16))
                for first in range(0, batch.num_rows, at_once):
                    part = batch.slice(first, at_once)
                    numbers = matrix_numbers(block_matrix(part.column("data"), dtype), skip)
                    yield pa.RecordBatch.from_arrays([*[part.column(k) for k in keys], *numbers], schema.names)
                continue
            rows = [block_numbers(_values(cell, dtype, skip)) for cell in batch.column("data")]
            yield numbers_batch([batch.column(k) for k in keys], rows, schema.names)

    return cells.select(*keys, "data").mapInArrow(measure, schema)


def matrix_numbers(blocks: np.ndarray, skip: float | None) -> list[pa.Array]:
    """Count, sum, minimum and maximum of each row of a matrix of integers."""
    limits = np.iinfo(blocks.dtype)
    seen = np.ones(blocks.shape, bool) if skip is None else blocks != skip
    n = seen.sum(axis=1)
    low, high = (np.where(seen, blocks, edge) for edge in (limits.max, limits.min))
    total = np.where(seen, blocks, 0).sum(axis=1, dtype=np.float64)
    ends = [pa.array(v.astype(np.float64), mask=n == 0) for v in (low.min(axis=1), high.max(axis=1))]
    return [pa.array(n.astype(np.int64)), pa.array(total), *ends]


def _values(cell: pa.Scalar, dtype: np.dtype, skip: float | None) -> np.ndarray:
    if not cell.is_valid:
        return np.empty(0, dtype)
    values = np.frombuffer(cell.as_buffer(), dtype)
    return values if skip is None else values[values != skip]


def block_numbers(values: np.ndarray) -> tuple:
    """Count, sum, minimum and maximum of a numpy array."""
    if not len(values):
        return 0, 0.0, None, None
    return len(values), float(values.sum(dtype=np.float64)), float(values.min()), float(values.max())


def numbers_batch(columns: list, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = (pa.int64(), pa.float64(), pa.float64(), pa.float64())
    numbers = zip(*rows) if rows else ([], [], [], [])
    return pa.RecordBatch.from_arrays(
        [*columns, *(pa.array(list(c), t) for c, t in zip(numbers, types))], names
    )


def stack_bands(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Join single-band blocks ``(keys…, slot, data)`` in slot order into one block.

    A group holds the bands one request names. ``complete`` is false when any of them
    is missing, and then there is no block.
    """
    ordered = F.array_sort(F.collect_list(F.struct("slot", "data")))
    joined = F.aggregate(
        F.col("parts"), F.lit(b""), lambda whole, part: F.concat(whole, part["data"])
    )
    return (
        blocks.groupBy(*keys)
        .agg(ordered.alias("parts"), F.bool_and(F.col("data").isNotNull()).alias("complete"))
        .select(*keys, "complete", F.when(F.col("complete"), joined).alias("data"))
    )


def band_block(data: str, band: str, band_bytes: Column) -> Column:
    """Bytes of one band out of a block; NULL when the block is too short."""
    start = F.col(band) * band_bytes
    part = F.substring(F.col(data), (start + 1).cast("int"), band_bytes.cast("int"))
    return F.when(F.octet_length(data) >= start + band_bytes, part)


def physical(pixels: DataFrame, bands: DataFrame) -> DataFrame:
    """Add ``physical = scale * dn + offset`` from a band table on ``(hpid, band)``."""
    known = pixels.join(bands, ["hpid", "band"], "left")
    return known.withColumn("physical", F.col("scale") * F.col("dn") + F.col("offset"))


def valid_dn(dn: str = "dn", low: Column | float = 0.0, high: Column | float = 255.0, nodata=None) -> Column:
    """The value inside its valid range (ends included) and not nodata, else NULL."""
    valid = F.col(dn).between(low, high)
    if nodata is not None:
        valid = valid & (F.col(dn) != nodata)
    return F.when(valid, F.col(dn))


AGGREGATES: dict[str, Callable[[Column], Column]] = {"min": F.min, "max": F.max, "ave": F.avg}


def composite(
    pixels: DataFrame,
    keys: list[str],
    method: str,
    start: int,
    stop: int,
    vmin: float,
    vmax: float,
    fill: float,
) -> DataFrame:
    """One value per pixel over the dates of a range; ``fill`` where none is valid."""
    inside = pixels.filter(F.col("dt").between(start, stop))
    value = AGGREGATES[method](valid_dn("dn", vmin, vmax))
    return inside.groupBy(*keys).agg(F.coalesce(value, F.lit(fill)).alias("dn"))


def composite_tiles(
    cells: DataFrame,
    keys: list[str],
    method: str,
    vmin: float,
    vmax: float,
    fill: float,
    type_code: int,
    out_type: int | None = None,
    fan_in: int = 16,
    askers: DataFrame | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """The composite of packed tiles, one block per key.

    With ``askers``, rows with the ``keys`` that they ask for and their own key ``by``, the blocks of each key are folded once for
    all of them, and one block per ``by`` is returned, of all that its rows ask for.

    Blocks are folded in the map tasks first, then by (key, salt), then by key, so a
    tile holding a large share of all cells is reduced in parallel before it meets in
    one place. Each step streams: blocks of a key that stand in one batch are reduced together, and a task keeps a bounded
    number of accumulators. Extremes travel as
    values of the source's type with a bit each, averages as sums and counts, in four bytes each for types of a byte.
    Averages are rounded half up for integer results; ``fill`` must be a value of the result's type.
    """
    source, target = numpy_type(type_code), numpy_type(out_type or type_code)
    if target.kind in "iu" and not (np.iinfo(target).min <= fill <= np.iinfo(target).max and fill == int(fill)):
        raise ValueError(f"{fill} is no value of the result's type")
    mean = method == "ave"
    # Sums over the dates of a tile: integers stay exact, four bytes hold the bytes of eight million dates.
    total = source if not mean else np.dtype("<i4") if source.itemsize == 1 else np.dtype("<i8") if source.kind in "iu" else np.dtype("<f8")
    partial = T.StructType(
        [
            *fields_of(cells, keys),
            T.StructField("salt", T.IntegerType()),
            T.StructField("total", T.BinaryType()),
            T.StructField("seen", T.BinaryType()),
        ]
    )
    extreme = {"min": np.minimum, "max": np.maximum}.get(method)
    # What takes no part in an extreme.
    limits = np.finfo(source) if source.kind == "f" else np.iinfo(source)
    edge = source.type(limits.max if method == "min" else limits.min)

    def read_cells(batch):
        dn = block_matrix(batch.column("data"), source)
        valid = (dn >= vmin) & (dn <= vmax)
        return (np.where(valid, dn, 0).astype(total), valid.astype("<i4")) if mean else (dn, valid)

    def read_partials(batch):
        value = block_matrix(batch.column("total"), total)
        if mean:
            return value, block_matrix(batch.column("seen"), np.dtype("<i4"))
        bits = block_matrix(batch.column("seen"), np.dtype(np.uint8))
        return value, np.unpackbits(bits, axis=1, count=value.shape[1]).astype(bool)

    def reduced(value, seen, starts):
        """Rows that stand together in one."""
        if mean:
            return np.add.reduceat(value, starts, axis=0, dtype=total), np.add.reduceat(seen, starts, axis=0, dtype=seen.dtype)
        return extreme.reduceat(np.where(seen, value, edge), starts, axis=0), np.logical_or.reduceat(seen, starts, axis=0)

    def combine(mine, value, seen):
        if mean:
            return [mine[0] + value, mine[1] + seen]
        both = np.where(mine[1] & seen, extreme(mine[0], value), np.where(seen, value, mine[0]))
        return [both, mine[1] | seen]

    def parts(batch, payload, in_order):
        """Rows of blocks of one length, so many at a time as a task may hold."""
        lengths = block_lengths(batch.column(payload))
        if in_order:
            bounds = [0, *(np.flatnonzero(np.diff(lengths)) + 1), batch.num_rows]
            stretches = [batch.slice(lo, hi - lo) for lo, hi in zip(bounds, bounds[1:])]
        else:
            stretches = [batch.filter(pa.array(lengths == length)) for length in np.unique(lengths)]
        for same in stretches:
            at_once = max(1, WORKING_BYTES // max(1, 16 * block_lengths(same.column(payload).slice(0, 1))[0]))
            for first in range(0, same.num_rows, at_once):
                yield same.slice(first, at_once)

    def folded(batches, keys, read, payload, in_order):
        """Tables of keys and accumulators. Rows in order of their keys give each key once; others may give it again after
        a table got full."""
        table: dict[tuple, list] = {}
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            for part in parts(batch, payload, in_order):
                if not in_order:
                    codes = [part.column(k).dictionary_encode().indices.fill_null(-1).to_numpy() for k in keys]
                    part = part.take(pa.array(np.lexsort(codes)))
                starts = run_starts(part, keys)
                value, seen = reduced(*read(part), starts)
                names = zip(*(part.column(k).take(pa.array(starts)).to_pylist() for k in keys))
                for key, one, bits in zip(names, value, seen):
                    if key in table:
                        table[key] = combine(table[key], one, bits)
                        continue
                    size = one.nbytes + bits.nbytes
                    if table and held + size > WORKING_BYTES:
                        yield table
                        table, held = {}, 0
                    table[key] = [one.copy(), bits.copy()]
                    held += size
        if table:
            yield table

    def stage(keys, read, payload, in_order, final=False):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            salt = TaskContext.get().partitionId() % fan_in
            types: list = []

            def watched():
                for batch in batches:
                    types[:] = [batch.schema.field(k).type for k in keys]
                    yield batch

            def of_one_length(table):
                by_length: dict[int, list] = {}
                for key, kept in table.items():
                    by_length.setdefault(len(kept[0]), []).append((key, *kept))
                return by_length.values()

            for table in folded(watched(), keys, read, payload, in_order):
                for rows in of_one_length(table):
                    found, value, seen = zip(*rows)
                    value, seen = np.stack(value), np.stack(seen)
                    columns = [pa.array(list(c), type=t) for c, t in zip(zip(*found), types)]
                    if final:
                        result = value / np.maximum(seen, 1) if mean else value
                        if mean and target.kind in "iu":
                            result = np.floor(result + 0.5)
                        blocks = [np.where(seen > 0, result, fill).astype(target)]
                    else:
                        columns.append(pa.array([salt] * len(rows), type=pa.int32()))
                        blocks = [value, seen if mean else np.packbits(seen, axis=1)]
                    yield pa.RecordBatch.from_arrays([*columns, *map(block_array, blocks)], [*keys, "data"] if final else partial.names)

        return run

    mapped = cells.select(*keys, "data").mapInArrow(stage(keys, read_cells, "data", False), partial)
    partials = mapped.repartition(*keys, "salt").sortWithinPartitions(*keys).mapInArrow(stage(keys, read_partials, "total", True), partial)
    if askers is not None:
        partials, keys = never_broadcast(askers).join(partials, keys).select(*by, "total", "seen"), by
    done = T.StructType([*fields_of(partials, keys), T.StructField("data", T.BinaryType())])
    return partials.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(stage(keys, read_partials, "total", True, final=True), done)


def map_tiles(
    cells: DataFrame,
    keys: list[str],
    function: Callable[[np.ndarray], np.ndarray],
    bands: int,
    width: int,
    height: int,
    type_code: int,
    out_type: int | None = None,
) -> DataFrame:
    """Apply a numpy function ``(bands, h, w) -> (bands, h, w)`` to every block.

    A tile without data, or one the function fails on, gets ``status`` 1 and the
    reason in ``log``; it does not stop the job.
    """
    source, target = numpy_type(type_code), numpy_type(out_type or type_code)
    schema = T.StructType(
        [
            *fields_of(cells, keys),
            T.StructField("status", T.IntegerType()),
            T.StructField("log", T.StringType()),
            T.StructField("data", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            status, log, data = [], [], []
            for cell in batch.column("data"):
                block, problem = None, None
                if not cell.is_valid:
                    problem = "no data"
                else:
                    try:
                        tile = np.frombuffer(cell.as_buffer(), source).reshape(bands, height, width)
                        block = np.ascontiguousarray(function(tile), dtype=target).tobytes()
                    except Exception as error:  # one bad tile must not fail the others
                        problem = f"{type(error).__name__}: {error}"
                status.append(0 if problem is None else 1)
                log.append(problem or "")
                data.append(block)
            columns = [batch.column(k) for k in keys]
            columns += [pa.array(status, pa.int32()), pa.array(log, pa.string()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return cells.select(*keys, "data").mapInArrow(run, schema)


def reduce_dates(
    cells: DataFrame,
    keys: list[str],
    function: Callable[[np.ndarray, np.ndarray], np.ndarray],
    bands: int,
    width: int,
    height: int,
    type_code: int,
    out_type: int | None = None,
    cap: int | None = None,
) -> DataFrame:
    """Apply ``(dates, (dates, bands, h, w)) -> (bands, h, w)`` to each tile's dates, or to its first ``cap``.

    The function sees all dates of one tile at once, so a tile's series has to fit in a task. Functions
    over any number of dates that can be folded belong in :func:`composite_tiles`.
    """
    from .dates import first_dates

    source, target = numpy_type(type_code), numpy_type(out_type or type_code)
    schema = T.StructType([*fields_of(cells, keys), T.StructField("data", T.BinaryType())])

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("dt").to_numpy())
        dates = table.column("dt").to_numpy()[order]
        blocks = table.column("data").combine_chunks()
        series = np.stack(
            [np.frombuffer(blocks[int(i)].as_buffer(), source).reshape(bands, height, width) for i in order]
        )
        result = np.ascontiguousarray(function(dates, series), dtype=target)
        columns = [pa.array([k.as_py()], type=k.type) for k in key]
        return pa.Table.from_arrays(
            [*columns, pa.array([result.tobytes()], pa.binary())], names=schema.names
        )

    chosen = cells
    if cap is not None:
        first = first_dates(cells.select(*keys, "dt"), keys, cap)
        chosen = never_broadcast(cells).join(first, [*keys, "dt"], "left_semi")
    return chosen.select(*keys, "dt", "data").groupBy(*keys).applyInArrow(run, schema)


def pivot_bands(pixels: DataFrame, keys: list[str], bands: int) -> DataFrame:
    """Pixel rows with one column ``b0 … bn`` per band."""
    return pixels.groupBy(*keys).agg(
        *(F.max(F.when(F.col("band") == b, F.col("dn"))).alias(f"b{b}") for b in range(bands))
    )


def band_expression(
    pixels: DataFrame, text: str, parameters: dict[str, float] | None = None, name: str = "dn"
) -> DataFrame:
    """Evaluate SQL text over the band columns and named parameters."""
    known = pixels.withColumns({k: F.lit(v) for k, v in (parameters or {}).items()})
    return known.withColumn(name, F.expr(text)).drop(*(parameters or {}))


def zonal(
    pixels: DataFrame, segments: DataFrame, size: int, by: list[str], vmin: float, vmax: float
) -> DataFrame:
    """Count, sum, min, max and mean of valid pixels per region and ``by`` columns.

    Segments are cut at tile borders first, so level, row and tile column form the
    equality key of the join and only the columns inside one tile row are compared.
    """
    from .regions import cut_at_tiles

    cut = broadcast_if_small(cut_at_tiles(segments, size))
    inside = (F.col("gcol") >= F.col("x0")) & (F.col("gcol") <= F.col("x1"))
    hit = (
        pixels.withColumn("dn", valid_dn("dn", vmin, vmax))
        .filter(F.col("dn").isNotNull())
        .join(cut, ["z", "grow", "x"]).filter(inside)
    )
    return hit.groupBy("roi_id", *by).agg(
        F.count("dn").alias("n"), F.sum("dn").alias("total"),
        F.min("dn").alias("low"), F.max("dn").alias("high"), F.avg("dn").alias("ave"),
    )


def series(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Zonal statistics in date order with the change of the mean since the date before.

    The input is one row per region and date, so a window is bounded by the calendar.
    """
    from pyspark.sql.window import Window

    order = Window.partitionBy(*keys).orderBy("dt")
    return stats.withColumn("step", F.row_number().over(order)).withColumn(
        "change", F.col("ave") - F.lag("ave").over(order)
    )


def with_level_position(pixels: DataFrame, width: int, height: int) -> DataFrame:
    """Add ``grow, gcol``: the pixel's row and column in the whole level."""
    return pixels.withColumns(
        {
            "grow": F.col("y") * height + F.col("row"),
            "gcol": F.col("x") * width + F.col("col"),
        }
    )


# Distinct values of one band of a tile that a zone table lists; a byte has no more.
ZONE_VALUES = 256


def zone_table(cells: DataFrame, keys: list[str], size: int, type_code: int) -> DataFrame:
    """What whole tiles hold, beside their blocks: ``(keys…, bsq, values, counts)``, one row per band.

    ``values`` are the distinct values in order and ``counts`` how often each occurs, so statistics of
    any value range follow exactly and rows of several tiles or dates can be added up. A band with more than ZONE_VALUES distinct
    values has NULL in both, and its block has to be read.
    """
    dtype = numpy_type(type_code)
    schema = T.StructType([
        *fields_of(cells, keys), T.StructField("bsq", T.IntegerType()),
        T.StructField("values", T.ArrayType(T.DoubleType())), T.StructField("counts", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, bsq, values, counts = [], [], [], []
            for k, cell in enumerate(batch.column("data")):
                if not cell.is_valid:
                    continue
                for b, plane in enumerate(np.frombuffer(cell.as_buffer(), dtype).reshape(-1, size * size)):
                    found, often = np.unique(plane, return_counts=True)
                    few = len(found) <= ZONE_VALUES
                    own.append(k)
                    bsq.append(b)
                    values.append(found.astype("<f8").tolist() if few else None)
                    counts.append(often.tolist() if few else None)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(pa.array(own, pa.int64())) for c in keys], pa.array(bsq, pa.int32()),
                 pa.array(values, pa.list_(pa.float64())), pa.array(counts, pa.list_(pa.int64()))],
                names=schema.names,
            )

    return cells.select(*keys, "data").mapInArrow(run, schema)
