"""Column expressions against hand cases and plain Python."""

import math
import struct

import pytest
from pyspark.sql import functions as F

from rastergrid.functions import grid, packed_time, pixel_types, rowkey, texts


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_strict_tile_edges(spark):
    cases = [
        ((180.0, 0.0, 3), (7, 2)), ((-180.0, 90.0, 3), (0, 0)), ((0.0, -90.0, 1), (1, 0)), ((12.0, 3.0, 0), (0, 0)),
        ((0.0, 0.0, 22), None), ((180.1, 0.0, 3), None), ((0.0, -90.1, 3), None), ((0.0, 0.0, -1), None),
        ((179.9999, -89.9999, 21), (2**21 - 1, 2**20 - 1)),
    ]
    df = spark.createDataFrame([c[0] for c in cases], "lon double, lat double, z int")
    got = [r[0] for r in df.select(grid.strict_tile("lon", "lat", "z")).collect()]
    assert [None if g is None else (g["x"], g["y"]) for g in got] == [c[1] for c in cases]


def test_clamped_tile_never_null(spark):
    df = spark.createDataFrame([(999.0, 0.0), (-999.0, 99.0), (1e300, -1e300)], "lon double, lat double")
    got = [tuple(r[0]) for r in df.select(grid.clamped_tile("lon", "lat", F.lit(3))).collect()]
    assert got == [(7, 2), (0, 0), (7, 3)]


def test_pixel_position_rounds_without_clamp(spark):
    ((x, y, col, row),) = one(spark, grid.pixel_position(F.lit(180.0), F.lit(-90.0), F.lit(2)))
    assert (x, y, col, row) == (4, 2, 0, 0)


@pytest.mark.parametrize("z", [0, 1, 2, 7, 15, 21])
def test_tile_centre_returns_tile(spark, z):
    nx, ny = 2**z, max(1, 2**z // 2)
    rows = [(x, y) for x in {0, nx // 3, nx - 1} for y in {0, ny // 2, ny - 1}]
    df = spark.createDataFrame(rows, "x int, y int").withColumn("b", grid.tile_bounds(F.lit(z), "y", "x"))
    centre = df.withColumns({"lon": (F.col("b.left") + F.col("b.right")) / 2, "lat": (F.col("b.top") + F.col("b.bottom")) / 2})
    # Level 0 is a square that reaches beyond the south pole.
    centre = centre.withColumn("lat", F.greatest("lat", F.lit(-90.0)))
    back = centre.select("x", "y", grid.strict_tile("lon", "lat", F.lit(z)).alias("t")).collect()
    assert all((r["x"], r["y"]) == tuple(r["t"]) for r in back)


def test_tile_range_and_expansion(spark):
    (r, e) = one(
        spark,
        grid.tile_range(F.lit(-10.0), F.lit(10.0), F.lit(10.0), F.lit(-10.0), F.lit(2)),
        grid.expand_half_pixel(F.lit(-180.0), F.lit(0.0), F.lit(89.5), F.lit(-90.0)),
    )
    assert (r["xmin"], r["xmax"], r["ymin"], r["ymax"]) == (1, 2, 0, 1)
    assert tuple(e) == (-180.0, 0.703125, 90.0, -90.0)


@pytest.mark.parametrize("hpid_len", [1, 4])
@pytest.mark.parametrize("yx_len", [2, 4])
def test_row_key_round_trip(spark, hpid_len, yx_len):
    rows = [(h, z, y, x) for h in (0, 5, -2, 127) for z in (0, 21) for y, x in ((0, 0), (300, 7), (32767, 32766))]
    df = spark.createDataFrame(rows, "hpid int, z int, y int, x int")
    back = df.withColumn("k", rowkey.decode(rowkey.encode("hpid", "z", "y", "x", hpid_len, yx_len), hpid_len, yx_len))
    for r in back.collect():
        assert tuple(r["k"]) == ((r["x"] + r["y"]) % 10, r["hpid"], r["z"], r["y"], r["x"])


def test_row_key_bytes(spark):
    key, short = one(
        spark, rowkey.encode(F.lit(1001), F.lit(3), F.lit(258), F.lit(-1), 4, 2, bucket_id=9),
        rowkey.decode(F.unhex(F.lit("0011")), 4, 4),
    )
    assert bytes(key) == struct.pack(">bibhh", 9, 1001, 3, 258, -1) and short is None


def test_season_label_only_in_four_months(spark):
    df = spark.createDataFrame([(20200300000000,), (20200400000000,), (20201231235959,)], "dt bigint")
    got = df.select(packed_time.label("dt", F.lit(6)), packed_time.label("dt", F.lit(11)), packed_time.label("dt", F.lit(2))).collect()
    assert [g[0] for g in got] == ["2020年春季", "20200400000000", "2020年冬季"]
    assert got[0][1] == "20200300000000" and got[2][2] == "2020年12月31日 23:59"


def test_packed_dates_need_not_be_real(spark):
    bad, good = one(
        spark, packed_time.to_timestamp(F.lit(20200500000000)), packed_time.pack(packed_time.to_timestamp(F.lit(20200501020304)))
    )
    assert bad is None and good == 20200501020304


def test_part_filter(spark):
    dt = F.lit(20200506070809)
    ok, no, skipped = one(
        spark, packed_time.passes(dt, 5, 6, 7, 8, 9), packed_time.passes(dt, 5, 6, 7, 8, 10), packed_time.passes(dt)
    )
    assert ok and not no and skipped


def test_date_marks(spark):
    (text,) = one(
        spark, packed_time.fill_template(F.lit("{{{DATE}}}/{{{DATE-0}}}/{{{DATE-7}}}/{{{DATE-8}}}"), F.to_date(F.lit("2020-03-03")))
    )
    assert text == "20200303/20200303/20200225/{{{DATE-8}}}"


def test_region_and_extent_texts(spark):
    rows = ["sys:12", "user:3", "a:b:c", "sys:x", "", "roi/a.tlv", "user:7:"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = df.select(texts.region_route("t"), texts.region_id("t")).collect()
    assert [g[0] for g in got] == ["sys", "user", "file", "sys", None, "file", "user"]
    assert [g[1] and g[1]["id"] for g in got] == [12, 3, None, None, None, None, 7]
    boxes = spark.createDataFrame([("1,2,3,4",), (" 1.5, 2 ,3,4",), ("1,2,3",), ("1,2,3,x",)], "t string")
    assert [g[0] and g[0]["left"] for g in boxes.select(texts.extent("t")).collect()] == [1.0, 1.5, None, None]


FLOATS = [0.0, -0.0, 1.0, -2.5, 1e-40, 3.4e38, 1 / 3, float("inf"), float("-inf"), float("nan"), 5e-324, 1.7e308, -1e-310]


@pytest.mark.parametrize("code,fmt", [(6, "<f"), (7, "<d")])
def test_float_decoding(spark, code, fmt):
    values = [v for v in FLOATS if code == 7 or not (math.isfinite(v) and abs(v) > 3.5e38)]
    raw = [struct.pack(fmt, v) for v in values]
    df = spark.createDataFrame([(i, b"".join(raw)) for i in range(len(raw))], "i int, data binary")
    n = len(raw)
    got = [r[1] for r in df.select("i", pixel_types.pixel_value("data", code, n, 1, 1, 0, 0, "i")).orderBy("i").collect()]
    for g, r in zip(got, raw):
        (want,) = struct.unpack(fmt, r)
        assert (math.isnan(g) and math.isnan(want)) or g == want


@pytest.mark.parametrize("code", [1, 2, 3, 4, 5])
def test_integer_decoding(spark, code):
    fmt = {1: "<B", 2: "<H", 3: "<h", 4: "<I", 5: "<i"}[code]
    size = struct.calcsize(fmt)
    raw = bytes(range(200, 200 + 2 * size)) if size < 4 else bytes([255, 254, 1, 128, 4, 3, 2, 1])
    df = spark.createDataFrame([(raw, 0), (raw, 1), (raw, 2), (raw, -1)], "data binary, i int")
    got = [r[0] for r in df.select(pixel_types.pixel_value("data", code, 2, 1, 1, 0, 0, "i")).collect()]
    assert got == [float(struct.unpack_from(fmt, raw, 0)[0]), float(struct.unpack_from(fmt, raw, size)[0]), None, None]


def test_unknown_pixel_type(spark):
    data = F.lit(b"abcd")
    got = one(
        spark, pixel_types.pixel_value(data, 9, 2, 2, 1, 0, 0, 0), pixel_types.pixel_value(data, 9, 2, 2, 1, 0, 0, 0, strict_zero=True),
        pixel_types.bytes_per_pixel(F.lit(9)), pixel_types.bytes_per_pixel(F.lit(7)),
    )
    assert got == (None, 0.0, 0, 8)
