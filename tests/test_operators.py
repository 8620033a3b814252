"""Operators against brute force on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastergrid.functions.pixel_types import PIXEL_TYPES
from rastergrid.operators import catalog, changes, dates, extents, pixels, pyramid, regions, style


def test_whole_pyramid_count(spark):
    world = spark.createDataFrame([(1, 0, 9, -180.0, 180.0, 90.0, -90.0)], "id int, zmin int, zmax int, left double, right double, top double, bottom double")
    tiles = pyramid.enumerate_tiles(world, ["id"])
    assert tiles.count() == 174_763
    # One extent is spread over all tasks before its columns are expanded.
    sizes = [n for n in tiles.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()]
    assert max(sizes) < 0.5 * sum(sizes)


def test_inverted_or_outside_extents_give_no_tiles(spark):
    rows = [(1, 0, 3, 10.0, -10.0, 50.0, 0.0), (2, 0, 3, -200.0, 10.0, 50.0, 0.0), (3, 4, 3, -10.0, 10.0, 50.0, 0.0), (4, 2, 2, 100.0, -100.0, 50.0, 0.0)]
    df = spark.createDataFrame(rows, "id int, zmin int, zmax int, left double, right double, top double, bottom double")
    got = {(r["id"], r["z"]) for r in pyramid.enumerate_tiles(df, ["id"]).collect()}
    # An inverted box still names one tile where both corners fall into it.
    assert got == {(1, 0)}


def test_roll_up_equals_direct_counts(spark):
    rng = random.Random(3)
    rows = [(rng.uniform(-180, 180), rng.uniform(-90, 90), 1) for _ in range(500)] + [(180.0, -90.0, 1), (-180.0, 90.0, 1)]
    df = spark.createDataFrame(rows, "lon double, lat double, v int")
    from rastergrid.functions import grid

    got = {(r.z, r.y, r.x): r.n for r in pyramid.tile_counts(df, ["v"], 6).collect()}
    direct = {}
    for z in range(7):
        for r in df.select(grid.strict_tile("lon", "lat", F.lit(z)).alias("t")).collect():
            key = (z, r.t["y"], r.t["x"])
            direct[key] = direct.get(key, 0) + 1
    assert got == direct


def test_extent_order_does_not_matter(spark):
    boxes = [("a", -10.0, 40.0, 50.0, 0.0), ("b", 0.0, 90.0, 60.0, -10.0), ("c", -170.0, 20.0, 45.0, -80.0)]
    areas = spark.createDataFrame(boxes, "roi_id string, left double, right double, top double, bottom double")
    out = []
    for order in (["a", "b", "c", ""], ["c", "", "b", "a"]):
        wanted = spark.createDataFrame([(1, r) for r in order], "id int, roi_id string")
        out.append(tuple(extents.intersect(wanted, areas, ["id"]).first()))
    assert out[0] == out[1] == (1, 0.0, 20.0, 45.0, 0.0, 3, 0)
    missing = spark.createDataFrame([(1, "zz"), (2, "")], "id int, roi_id string")
    got = {r.id: (r.named, r.missing, r.left) for r in extents.intersect(missing, areas, ["id"]).collect()}
    assert got == {1: (1, 1, -180.0), 2: (0, 0, -180.0)}


def test_as_of_with_a_hot_product(spark):
    rng = random.Random(5)
    items = [(i, 1 if i % 3 else rng.randrange(5), 20200101000000 + rng.randrange(28) * 1000000 + rng.randrange(24) * 10000) for i in range(600)]
    asks = [(i, 1 if i % 3 else rng.randrange(6), 20200101000000 + rng.randrange(-1, 30) * 1000000 + rng.randrange(24) * 10000) for i in range(400)]
    a = spark.createDataFrame(asks, "rid int, pid int, h bigint")
    b = spark.createDataFrame(items, "fid int, pid int, hcol bigint")
    got = {r.rid: (r.hcol, r.fid) for r in dates.at_or_before(a, b).collect()}
    assert len(got) == len(asks)
    for rid, pid, h in asks:
        fits = [(hc, f) for f, p, hc in items if p == pid and hc <= h]
        assert got[rid] == (max(fits) if fits else (None, None))


def test_date_grid_keeps_impossible_dates_and_rejects_two_wildcards(spark):
    rows = [(1, 20200101000000, 20201231235959, 2, -1, 0, 0, 0), (2, 20200101000000, 20201231235959, -1, -1, 0, 0, 0), (3, 20191231000000, 20210101000000, 1, 1, 0, 0, 0)]
    df = spark.createDataFrame(rows, "id int, startdt bigint, stopdt bigint, month int, day int, hour int, minute int, second int")
    got = {}
    for r in dates.date_grid(df, ["id"]).collect():
        got.setdefault(r.id, []).append(r.dt)
    assert sorted(got[1]) == [20200200000000 + d * 1000000 for d in range(1, 32)]
    assert 2 not in got and sorted(got[3]) == [20200101000000, 20210101000000]
    assert dates.date_grid(df.filter("id = 2"), ["id"], max_wildcards=None).count() == 12 * 31


def test_dates_at_a_step(spark):
    steps = "years int, months int, days int, hours int, minutes int, seconds int"
    rows = [
        (1, 20200101000000, 20200101003000, True, True, 0, 0, 0, 0, 0, 1), (2, 20200131000000, 20210131000000, False, True, 0, 1, 0, 0, 0, 0),
        (3, 20200101000000, 20230101000000, True, False, 1, 0, 0, 0, 0, 0), (4, 20200101000000, 20230101000000, True, True, 0, 0, 0, 0, 0, 0),
        (5, 20200500000000, 20230101000000, True, True, 1, 0, 0, 0, 0, 0),
    ]
    df = spark.createDataFrame(rows, f"id int, startdt bigint, stopdt bigint, start_inclusive boolean, stop_inclusive boolean, {steps}")
    got = {}
    for r in dates.every_n(df, ["id"]).collect():
        got.setdefault(r.id, []).append(r.dt)
    assert len(got[1]) == 1801 and max(got[1]) == 20200101003000
    assert sorted(got[2])[:3] == [20200229000000, 20200331000000, 20200430000000] and len(got[2]) == 12
    assert sorted(got[3]) == [20200101000000, 20210101000000, 20220101000000] and set(got) == {1, 2, 3}


def test_cap_keeps_the_earliest_dates_of_a_hot_tile(spark):
    rows = [("hot", d) for d in range(1000)] + [("cold", d) for d in range(5)]
    df = spark.createDataFrame(rows, "k string, dt bigint").repartition(4)
    got = {}
    for r in dates.first_dates(df, ["k"], dates.DATE_CAP).collect():
        got.setdefault(r.k, []).append(r.dt)
    assert sorted(got["hot"]) == list(range(30)) and sorted(got["cold"]) == list(range(5))


def test_dense_ids_are_consecutive(spark):
    snapshot = spark.createDataFrame([(7, "x"), (3, "y")], "fid int, pid string")
    rows = spark.range(1000).select(F.col("id").cast("string").alias("pid"))
    got = changes.append_with_ids(snapshot, rows, "pid", "fid").collect()
    assert sorted(r.fid for r in got) == list(range(8, 1008)) and len({r.pid for r in got}) == 1000


def test_change_set_last_write_wins(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    edits = [("upsert", 1, 1, "A"), ("delete", 2, 1, None), ("upsert", 3, 3, "C2"), ("delete", 2, 3, None), ("delete", 1, 4, None), ("upsert", 2, 4, "new")]
    df = spark.createDataFrame(edits, "op string, seq int, k int, v string")
    assert sorted(map(tuple, changes.apply_changes(old, df, ["k"], "seq").collect())) == [(2, "b"), (3, "C2"), (4, "new")]


def test_owner_list_is_capped_at_200(spark):
    rows = spark.range(1000).select(F.col("id").cast("int").alias("sid"), F.lit(1).alias("uid"))
    import json

    text = catalog.owner_lists(rows, "sid", ["sid"], "scripts").first().json
    assert [r["sid"] for r in json.loads(text)["scripts"]] == list(range(200))


def test_nested_products(spark):
    p = spark.createDataFrame([(1, "a", "t1"), (2, "b", "none")], "pid int, name string, hTableName string")
    b = spark.createDataFrame([(1, 1, "B2"), (1, 0, "B1")], "pid int, bindex int, bName string")
    s = spark.createDataFrame([("t1", "tiles", 4, 2)], "hTableName string, hFamily string, hPidByteNum int, hYXByteNum int")
    got = {r.pid: r for r in catalog.nested(p, b, s).collect()}
    assert [x.bName for x in got[1].bands] == ["B1", "B2"] and got[1].storage.hYXByteNum == 2
    assert got[2].bands is None and got[2].storage is None


@pytest.mark.parametrize("code", sorted(PIXEL_TYPES))
def test_pack_and_unpack_all_types(spark, code):
    dtype = pixels.numpy_type(code)
    rng = np.random.default_rng(code)
    w, h, bands = 5, 3, 2
    rows = []
    for tile in range(7):
        for at in rng.choice(w * h * bands, 11, replace=False):
            value = rng.normal() * 100 if code > 5 else rng.integers(1, 120) * (-1 if code in (3, 5) else 1)
            rows.append((tile, int(at // (w * h)), int(at // w % h), int(at % w), float(np.array(value).astype(dtype))))
    df = spark.createDataFrame(rows, "t int, band int, row int, col int, dn double").repartition(3)
    packed = pixels.pack_tiles(df, ["t"], bands, w, h, code, 0)
    assert packed.count() == 7
    assert packed.filter(F.octet_length("data") != w * h * bands * dtype.itemsize).count() == 0
    back = pixels.unpack_tiles(packed, ["t"], bands, w, h, code, skip=0)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_pack_across_arrow_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = [(t, 0, p // 8, p % 8, float(t + p + 1)) for t in range(5) for p in range(64) if (t + p) % 3]
        df = spark.createDataFrame(rows, "t int, band int, row int, col int, dn double")
        back = pixels.unpack_tiles(pixels.pack_tiles(df, ["t"], 1, 8, 8, 2, 0), ["t"], 1, 8, 8, 2, skip=0)
        assert sorted(map(tuple, back.collect())) == sorted(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("method", ["min", "max", "ave"])
def test_packed_composite_with_a_hot_tile(spark, method):
    rng = np.random.default_rng(1)
    tiles = [(0 if i % 3 else i % 7, rng.integers(0, 256, 12, dtype=np.uint8)) for i in range(300)]
    df = spark.createDataFrame([(k, bytearray(b.tobytes())) for k, b in tiles], "t int, data binary").repartition(6)
    got = {r.t: np.frombuffer(r.data, "<f8") for r in pixels.composite_tiles(df, ["t"], method, 50, 200, -1, 1, out_type=7, fan_in=3).collect()}
    for key in {k for k, _ in tiles}:
        stack = np.ma.masked_outside(np.stack([b for k, b in tiles if k == key]).astype(float), 50, 200)
        want = {"min": stack.min, "max": stack.max, "ave": stack.mean}[method](axis=0).filled(-1)
        assert np.allclose(got[key], want)


def test_bad_tiles_do_not_stop_the_others(spark):
    df = spark.createDataFrame([(1, bytearray(4)), (2, None), (3, bytearray(3))], "t int, data binary")
    got = {r.t: (r.status, r.log[:7]) for r in pixels.map_tiles(df, ["t"], lambda tile: tile + 1, 1, 2, 2, 1).collect()}
    assert got == {1: (0, ""), 2: (1, "no data"), 3: (1, "ValueEr")}


def brute(rows):
    cover = {}
    for roi, level, grow, x0, x1 in rows:
        cover.setdefault((roi, level, grow), set()).update(range(x0, x1 + 1))
    return cover


def test_merged_cut_and_levelled_segments(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(300):
        x0 = rng.randrange(60)
        rows.append((f"r{rng.randrange(3)}", 3, rng.randrange(16), x0, min(63, x0 + rng.randrange(9))))
    df = spark.createDataFrame(rows, "roi_id string, level int, grow int, x0 int, x1 int")
    want = brute(rows)
    merged = [tuple(r) for r in regions.merge_segments(df).select("roi_id", "level", "grow", "x0", "x1").collect()]
    assert brute(merged) == want and sum(b - a + 1 for *_, a, b in merged) == sum(map(len, want.values()))
    cut = regions.cut_at_tiles(df, 8).collect()
    assert all(r.x0 // 8 == r.x == r.x1 // 8 for r in cut)
    assert brute([(r.roi_id, r.z, r.grow, r.x0, r.x1) for r in cut]) == want
    coarse = [tuple(r) for r in regions.at_levels(df, 2, 2).select("roi_id", "level", "grow", "x0", "x1").collect()]
    up = {}
    for (roi, _, grow), xs in want.items():
        up.setdefault((roi, 2, grow // 2), set()).update(x // 2 for x in xs)
    assert brute(coarse) == up


def test_polygon_with_a_hole(spark):
    outer = [(-90, 60), (90, 60), (90, -60), (-90, -60)]
    inner = [(-45, 30), (45, 30), (45, -30), (-45, -30)]
    rows = [("p", ring, i, float(x), float(y)) for ring, pts in enumerate((outer, inner)) for i, (x, y) in enumerate(pts)]
    df = spark.createDataFrame(rows, "roi_id string, ring int, seq int, lon double, lat double")
    got = brute([tuple(r) for r in regions.polygon_segments(df, 1, 16).select("roi_id", "level", "grow", "x0", "x1").collect()])
    res = 360 / 32
    for grow in range(16):
        lat = 90 - (grow + 0.5) * res
        want = {c for c in range(32) for lon in [(c + 0.5) * res - 180] if -90 < lon < 90 and -60 < lat < 60 and not (-45 < lon < 45 and -30 < lat < 30)}
        assert got.get(("p", 1, grow), set()) == want


def test_packed_clip_and_zonal_agree_with_masks(spark):
    rng = np.random.default_rng(4)
    blocks = [rng.integers(0, 100, 32, dtype=np.uint8) for _ in range(4)]
    rows = [("r", 1, 0, t % 2, t, 7.0, bytearray(b.tobytes())) for t, b in enumerate(blocks)]
    tiles = spark.createDataFrame(rows, "roi_id string, z int, y int, x int, t int, fill double, data binary")
    segments = spark.createDataFrame([("r", 1, 0, 1, 5), ("r", 1, 2, 4, 4), ("q", 1, 3, 0, 7)], "roi_id string, level int, grow int, x0 int, x1 int")
    by_tile = regions.by_tile(segments, 4)
    masks = {0: np.zeros((4, 4), bool), 1: np.zeros((4, 4), bool)}
    masks[0][0, 1:] = True
    masks[1][0, :2] = True
    masks[1][2, 0] = True
    got = {r.t: np.frombuffer(r.data, np.uint8).reshape(2, 4, 4) for r in regions.clip_tiles(tiles, by_tile, 4, 4, 1).collect()}
    for t, b in enumerate(blocks):
        assert (got[t] == np.where(masks[t % 2], b.reshape(2, 4, 4), 7)).all()
    stats = {(r.roi_id, r.t): r for r in regions.zonal_tiles(tiles.drop("roi_id"), by_tile, ["t"], 1, 10, 90, 4, 4, 1).collect()}
    for t, b in enumerate(blocks):
        inside = [v for v in b.reshape(2, 4, 4)[1][masks[t % 2]].tolist() if 10 <= v <= 90]
        if inside:
            assert (stats["r", t].n, stats["r", t].total) == (len(inside), float(sum(inside)))
        else:
            assert ("r", t) not in stats


def test_style_rules(spark):
    df = spark.createDataFrame([(v,) for v in (None, -5.0, 0.0, 24.9, 25.0, 300.0)], "v double")
    got = [r[0]["g"] for r in df.select(style.discrete(F.col("v"), style.GREEN_RAMP)).collect()]
    assert got == [0, 0, 0, 0, 25, 225]
    stops = [{"val": 0.0, "r": 0, "g": 10, "b": 0, "a": 255}, {"val": 10.0, "r": 100, "g": 0, "b": 0, "a": 255}]
    values = spark.createDataFrame([(-1.0,), (5.0,), (10.0,), (99.0,)], "v double")
    assert [(r[0]["r"], r[0]["g"]) for r in values.select(style.linear(F.col("v"), stops)).collect()] == [(0, 10), (50, 5), (100, 0), (100, 0)]


def test_series_change(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 3, 9.0), ("a", 2, 4.0)], "roi_id string, dt bigint, ave double")
    assert [(r.step, r.change) for r in pixels.series(df, ["roi_id"]).orderBy("dt").collect()] == [(1, None), (2, -1.0), (3, 5.0)]


def test_cover_tiles_against_pixels(spark):
    """A quadtree of covered tiles and border segments has the pixels of the region at every level."""
    size, level = 4, 2
    rows = [("a", level, r, 3, 13) for r in range(2, 8)] + [("a", level, 8, 0, 15), ("b", level, 0, 0, 3), ("b", 3, 31, 60, 63)]
    rows += [("b", level, r, 0, 3) for r in range(1, 4)]
    segments = spark.createDataFrame(rows, "roi_id string, level int, grow int, x0 int, x1 int")
    got, tiles = {}, {}
    for r in regions.cover_tiles(segments, F.lit(1), F.lit(4), size).collect():
        assert r.covered == (r.segments is None) and (r.roi_id, r.z, r.y, r.x) not in tiles
        tiles[r.roi_id, r.z, r.y, r.x] = r.covered
        inside = [(i, j) for i in range(size) for j in range(size)] if r.covered else [(s.row, j) for s in r.segments for j in range(s.c0, s.c1 + 1)]
        assert len(inside) == len(set(inside)) and r.covered == (len(inside) == size * size)
        got.setdefault((r.roi_id, r.z), set()).update((r.y * size + i, r.x * size + j) for i, j in inside)
    want = {}
    for roi, z, grow, x0, x1 in rows:
        for to in range(1, 5):
            for col in range(x0, x1 + 1):
                if to <= z:
                    want.setdefault((roi, to), set()).add((grow >> z - to, col >> z - to))
                else:
                    d = to - z
                    want.setdefault((roi, to), set()).update((i, j) for i in range(grow << d, grow + 1 << d) for j in range(col << d, col + 1 << d))
    assert got == want
    assert any(tiles.values()) and not all(tiles.values())


def test_overviews_level_by_level(spark):
    rng, size, fill = np.random.default_rng(3), 4, -9
    world = rng.integers(-50, 50, (2, 2 * size, 4 * size)).astype("<i2")
    world[rng.random(world.shape) < 0.3] = fill
    rows = [(7, 2, y, x, bytearray(world[:, y * size : (y + 1) * size, x * size : (x + 1) * size].tobytes())) for y in range(2) for x in range(4) if (y, x) != (1, 3)]
    world[:, size:, 3 * size :] = fill
    cells = spark.createDataFrame(rows, "k int, z int, y int, x int, data binary")

    def parent(level, method):
        height = max(size, level.shape[1] // 2)
        out = np.full((2, height, level.shape[2] // 2), fill, "<i2")
        for b, r, c in np.ndindex(2, level.shape[1] // 2, level.shape[2] // 2):
            four = level[b, 2 * r : 2 * r + 2, 2 * c : 2 * c + 2].ravel()
            seen = four[four != fill]
            if method == "nearest":
                out[b, r, c] = four[0]
            elif len(seen):
                out[b, r, c] = seen.max() if method == "max" else np.floor(seen.mean() + 0.5)
        return out

    for method in ("nearest", "max", "mean"):
        want, level = {2: world}, world
        for z in (1, 0):
            level = want[z] = parent(level, method)
        got = pyramid.overviews(cells, ["k"], 3, 2, size, 3, method, fill).collect()
        assert sorted((r.z, r.y, r.x) for r in got) == [(0, 0, 0), (1, 0, 0), (1, 0, 1), *((r[1], r[2], r[3]) for r in rows)]
        for r in got:
            part = want[r.z][:, r.y * size : (r.y + 1) * size, r.x * size : (r.x + 1) * size]
            assert (np.frombuffer(r.data, "<i2").reshape(2, size, size) == part).all()


def test_composites_round_and_refuse_fills_that_do_not_fit(spark):
    cells = spark.createDataFrame([(1, bytearray(v)) for v in ([1, 9, 200], [2, 200, 200], [2, 4, 200])], "k int, data binary").repartition(3)
    got = {m: pixels.composite_tiles(cells, ["k"], m, 0, 100, 7, 1, fan_in=2).first().data for m in ("min", "max", "ave")}
    assert {m: list(v) for m, v in got.items()} == {"min": [1, 4, 7], "max": [2, 9, 7], "ave": [2, 7, 7]}
    with pytest.raises(ValueError):
        pixels.composite_tiles(cells, ["k"], "ave", 0, 100, 300, 1)
    many = spark.range(3000).selectExpr("1 AS k", "unhex('FF00') AS data")
    assert np.frombuffer(pixels.composite_tiles(many, ["k"], "ave", 1, 255, -1, 1, out_type=7).first().data).tolist() == [255.0, -1.0]


def test_zone_table_lists_few_values(spark):
    rng = np.random.default_rng(2)
    few, many = rng.integers(0, 5, 256).astype("<u2"), np.arange(1000, 1512)[:512].astype("<u2")
    cells = spark.createDataFrame([(1, bytearray(few.tobytes() + few[::-1].tobytes())), (2, None), (3, bytearray(many.tobytes()))], "k int, data binary")
    rows = {(r.k, r.bsq): r for r in pixels.zone_table(cells, ["k"], 16, 2).collect()}
    assert set(rows) == {(1, 0), (1, 1), (3, 0), (3, 1)}
    assert dict(zip(rows[1, 1]["values"], rows[1, 1]["counts"])) == {float(v): int((few == v).sum()) for v in range(5)}
    assert rows[3, 0]["values"] == [float(v) for v in many[:256]]
    assert rows[3, 1].asDict()["counts"] == [1] * 256
    assert pixels.zone_table(spark.createDataFrame([(1, bytearray(np.arange(1024, dtype="<u2").tobytes()))], "k int, data binary"), ["k"], 32, 2).first()["counts"] is None
