"""Stores and files whose cost must not grow with the number of planes, folders or files, on small tables."""

import numpy as np
from pyspark.sql import functions as F

from rastergrid.operators import pixels, pyramid, regions
from rastergrid.plans import requests
from rastergrid.sources import cells, orders, tile_files

CELLS = "htable string, hpid int, z int, y int, x int, dt bigint, data binary"


def test_planes_share_folders(spark, tmp_path):
    """Forty planes in four groups: folders by group and year, every cell found, upserts by folder."""
    path, layout = str(tmp_path / "cells"), {"period": "year", "groups": 4}
    dates = [y * 10**10 + m * 10**8 for y in (2019, 2020) for m in (1, 7)]
    rows = [("t", p, 1, 0, x, d, bytearray([p, x])) for p in range(40) for x in range(2) for d in dates]
    cells.write(spark.createDataFrame(rows, CELLS), path, **layout)

    def folders():
        return {f.relative_to(path).parent.as_posix(): f.name for f in (tmp_path / "cells").rglob("htable=t/**/*.parquet")}

    before = folders()
    assert set(before) == {f"htable=t/group4={g}/year={y}" for g in range(4) for y in (2019, 2020)}
    stored = cells.read(spark, path, **layout)
    assert {tuple(r)[:6]: bytes(r.data) for r in stored.select(*cells.CELL, "data").collect()} == {r[:6]: bytes(r[6]) for r in rows}
    asked = spark.createDataFrame([(p, "t", p, 1, 0, 1, dates[2]) for p in (1, 5, 39, 77)], "rid int, htable string, hpid int, z int, y int, x int, dt bigint")
    found = cells.at(stored, asked)
    assert {r.rid: r.data and bytes(r.data) for r in found.collect()} == {1: b"\x01\x01", 5: b"\x05\x01", 39: b"'\x01", 77: None}
    pruned = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in pruned and "group4" in pruned
    series = asked.drop("dt").selectExpr("*", f"{dates[0]}L startdt", f"{dates[3]}L stopdt", *(f"-1 {n}" for n in ("month", "day", "hour", "minute", "second")))
    got = cells.between(stored, series, ["rid"], 3, cells.dates(spark, path)).collect()
    assert {(r.rid, r.dt) for r in got} == {(p, d) for p in (1, 5, 39) for d in dates[:3]}
    edits = [(*rows[-1][:6], bytearray(b"new"), 1), ("t", 43, 1, 0, 0, dates[3], bytearray(b"add"), 1)]
    cells.upsert(spark, path, spark.createDataFrame(edits, CELLS + ", seq int"), "seq", **layout)
    after = folders()
    assert [k for k in before if before[k] != after[k]] == ["htable=t/group4=3/year=2020"] and set(after) == set(before)
    got = {tuple(r)[:6]: bytes(r.data) for r in cells.read(spark, path, **layout).select(*cells.CELL, "data").collect()}
    assert len(got) == len(rows) + 1 and got[rows[-1][:6]] == b"new" and got[("t", 43, 1, 0, 0, dates[3])] == b"add"


def test_a_write_evaluates_its_cells_once(spark, tmp_path):
    """Dates, ranges and files come from cells that were computed once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    made = spark.createDataFrame([("t", p, 1, 0, 0, 20200100000000, bytearray(b"x")) for p in range(50)], CELLS).mapInArrow(count, CELLS)
    cells.write(made, str(tmp_path / "cells"))
    assert seen.value == 50
    assert cells.read(spark, str(tmp_path / "cells")).filter(F.col("hpid") < 5).count() == 5


def test_order_files_are_listed_and_opened_by_tasks(spark, tmp_path):
    """Patterns, arrays, broken, empty and hidden files; no file is listed by the driver."""
    texts = {"order=1/a.json": '{"roi": "r1",\n "dt": 5}', "order=2/a.json": '[{"roi": "r2"}, {"roi": "r3"}]', "order=3/a.json": "{no json", "order=4/a.json": " ",
             "order=5/_hidden": '{"roi": "no"}', "other/a.json": '{"roi": "r4"}'}
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    read = orders.read_orders(spark, f"{tmp_path}/order=*/*")
    got = sorted(((r.order_file.rsplit("/", 2)[1], r.roi, r.dt) for r in read.collect()), key=str)
    assert got == [("order=1", "r1", 5), ("order=2", "r2", None), ("order=2", "r3", None), ("order=3", None, None)]
    assert read.filter("roi = 'r1'").first().order_file == f"file://{tmp_path}/order=1/a.json"
    assert "FileScan" not in read._jdf.queryExecution().executedPlan().toString()
    assert [r.roi for r in orders.read_orders(spark, f"{tmp_path}/{{other,none}}").collect()] == ["r4"]
    assert orders.read_orders(spark, f"{tmp_path}/order=[13]").count() == 2


def test_tile_files_of_other_dates_are_not_opened(spark, tmp_path):
    rows = [("t", p, 1, 0, 0, 20200000000000 + m * 10**8, bytearray([p, m])) for p in (1, 2) for m in range(1, 6)]
    assert tile_files.write(spark.createDataFrame(rows, CELLS), str(tmp_path)) == 10
    for file in tmp_path.glob("t/*/20200500000000/*"):
        file.chmod(0)
    for date in tmp_path.glob("t/2/20200100000000"):
        (date / "tile_0_0_0").mkdir()
    read = tile_files.read(spark, str(tmp_path), 20200100000000, 20200300000000)
    assert sorted((r.hpid, r.z, r.dt, bytes(r.data)) for r in read.collect()) == [(p, 1, d, bytes(b)) for _, p, _, _, _, d, b in rows if b[1] <= 3]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "BinaryFile" not in plan


def test_unpacked_pixels_carry_their_block(spark):
    """Pixels with the block they came from equal those joined to their tiles; no join, no shuffle."""
    rng = np.random.default_rng(3)
    rows = [("t", p, 1, 0, 0, 5, bytearray(rng.integers(0, 4, 2 * 9).astype("<i2").tobytes())) for p in range(7)] + [("t", 7, 1, 0, 0, 5, None)]
    tiles = spark.createDataFrame(rows, CELLS)
    plain = pixels.unpack_tiles(tiles, cells.CELL, 2, 3, 3, 3, skip=2)
    carried = pixels.unpack_tiles(tiles, cells.CELL, 2, 3, 3, 3, skip=2, carry=("data",))
    joined = plain.join(tiles, cells.CELL).select(*carried.columns)
    assert sorted(map(str, carried.collect())) == sorted(map(str, joined.collect()))
    plan = carried._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def _counted(spark, rows, schema=CELLS):
    """A table of ``rows`` made in a task, and the count of the rows that were made so far."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return spark.createDataFrame(rows, schema).repartition(2, "hpid", "x", "dt").mapInArrow(count, schema), seen


def test_requests_share_composites_of_cells_made_once(spark):
    """Requests for the same dates of a tile get one composite; cells are made once though their dates are listed too."""
    rng = np.random.default_rng(5)
    rows = [("t", p, 1, 0, x, d, bytearray(rng.integers(0, 60, 8).astype(np.uint8).tobytes())) for p in range(2) for x in range(2) for d in range(20200, 20212)]
    made, seen = _counted(spark, rows)
    # The third comes twice and the fifth asks for two ranges, which are folded together.
    spans = {1: [(20200, 20204)], 2: [(20200, 20204)], 3: [(20203, 20211)] * 2, 4: [(20300, 20301)], 5: [(20200, 20204), (20203, 20206)]}
    asked = spark.createDataFrame(
        [(p * 10 + r, "t", p, *span, 0, 1, 1, 0.0, 0.0, 0.0, 0.0) for p in range(2) for r, some in spans.items() for span in some],
        "request_id int, htable string, hpid int, startdt bigint, stopdt bigint, usebound int, zmin int, zmax int, left double, right double, top double, bottom double",
    )
    for method, fold in (("max", np.max), ("min", np.min), ("ave", np.mean)):
        seen.value = 0
        got = requests.composite_requests(asked, made, method, 5, 45, 0, 2, 1).collect()
        assert seen.value == len(rows)
        assert len(got) == 2 * 4 * 2 and {r.request_id % 10 for r in got} == {1, 2, 3, 5}
        for r in got:
            tile = [c for c in rows if c[1] == r.request_id // 10 and c[4] == r.x]
            series = np.array([np.frombuffer(bytes(c[6]), np.uint8) for start, stop in spans[r.request_id % 10] for c in tile if start <= c[5] <= stop])
            want = [int(np.floor(fold(v[(v >= 5) & (v <= 45)]) + 0.5)) if ((v >= 5) & (v <= 45)).any() else 0 for v in series.T]
            assert list(r.data) == want


def test_composites_of_several_sizes_and_batches(spark):
    """Keys whose rows go on in further batches come out once, blocks may differ in size between keys, nothing seen gives the fill."""
    rng = np.random.default_rng(6)
    rows = [("t", k, 1, 0, 0, d, bytearray(rng.integers(-40, 40, 4 + 4 * (k % 3)).astype("<i2").tobytes())) for k in range(30) for d in range(40)]
    cells_ = spark.createDataFrame(rows, CELLS)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for method, fold in (("max", np.max), ("min", np.min)):
            got = pixels.composite_tiles(cells_, ["hpid"], method, -20, 20, -99, 3).collect()
            assert sorted(r.hpid for r in got) == list(range(30))
            for r in got:
                series = np.array([np.frombuffer(bytes(c[6]), "<i2") for c in rows if c[1] == r.hpid])
                want = [fold(v[abs(v) <= 20]) for v in series.T]
                assert np.frombuffer(bytes(r.data), "<i2").tolist() == want
        assert {bytes(r.data) for r in pixels.composite_tiles(cells_.filter("hpid = 0"), ["hpid"], "max", 90, 99, -1, 3).collect()} == {b"\xff" * 8}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_crossings_bound_the_tasks_of_polygons(spark, monkeypatch):
    """Tasks grow with the crossings of all polygons, whatever the partitions of the vertices; one shuffle serves pairs and cancelling."""
    ring = [(-170.0, 80.0), (-20.0, 75.0), (-90.0, 10.0), (-100.0, -60.0)]
    rows = [(f"p{k}", 0, n, lon + k, lat) for k in range(40) for n, (lon, lat) in enumerate(ring)]
    vertices = spark.createDataFrame(rows, "roi_id string, ring int, seq int, lon double, lat double").coalesce(1)
    plain = regions.polygon_segments(vertices, 3, 16)
    crossings = sum(r.x1 - r.x0 + 1 for r in plain.collect())
    assert crossings
    monkeypatch.setattr(regions, "CROSSINGS", 64)
    spread = regions.polygon_segments(vertices, 3, 16)
    assert sorted(spread.collect()) == sorted(plain.collect())
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange") == 1 and "BroadcastHashJoin" not in plan
    tasks = spread.selectExpr("spark_partition_id() AS t").distinct().count()
    assert tasks > 2 * spark.sparkContext.defaultParallelism


def test_requests_are_not_broadcast(spark):
    """Of zonal requests and tiles of regions the measured tiles are broadcast, and cells without a list of dates are made once."""
    block = bytearray(np.arange(4, dtype=np.uint8).tobytes())
    made, seen = _counted(spark, [("t", 1, 1, 0, x, d, block) for x in range(2) for d in (5, 6, 9)])
    asked = spark.createDataFrame(
        [(r, "a", "t", 1, 0, 1, 5, 6, 0.0, 9.0, 0.0, 9.0, 8.0, "max") for r in range(50)],
        "request_id int, roi_id string, htable string, hpid int, bsq int, zlevel int, startdt bigint, stopdt bigint, vmin double, vmax double, valid_min double, valid_max double, nodata double, method string",
    )
    segments = spark.createDataFrame([("a", 1, 0, 1, 2)], "roi_id string, level int, grow int, x0 int, x1 int")
    found = requests.zonal_requests(asked, made, segments, 2, 1)
    assert "BuildLeft" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == sorted((r, d, 2, 0.0, 1.0, 0.5, 1.0) for r in range(50) for d in (5, 6))
    assert seen.value == 6


def test_overviews_make_the_given_level_once(spark):
    """Three levels of many tiles, quarters cut between batches, against single pixels; the given cells are made once."""
    rng = np.random.default_rng(8)
    rows = [("t", p, 2, y, x, 5, bytearray(rng.integers(250, 256, 16).astype(np.uint8).tobytes())) for p in range(40) for y in range(2) for x in range(4) if rng.random() < 0.7]
    made, seen = _counted(spark, rows)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = pyramid.overviews(made, ["hpid"], 2, 1, 4, 1, "max", 255).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert seen.value == len(rows)
    want = {}
    for _, p, z, y, x, _, data in rows:
        for up in range(3):
            tile = want.setdefault((p, z - up, y >> up, x >> up), {})
            for n, v in enumerate(data):
                at = ((y * 4 + n // 4) >> up) % 4 * 4 + ((x * 4 + n % 4) >> up) % 4
                tile[at] = max(tile.get(at, -1), v if v != 255 else -1)
    assert len(got) == len(want)
    for r in got:
        tile = want[(r.hpid, r.z, r.y, r.x)]
        assert list(r.data) == [255 if tile.get(n, -1) < 0 else tile[n] for n in range(16)]


def test_packing_keeps_the_largest_value(spark):
    """Of several values of a pixel the largest stays; a tile whose key is partly NULL is one block."""
    rows = [(1, 0, 0, 0, 3.0), (1, 0, 0, 0, 9.0), (1, 0, 0, 0, 4.0), (1, 0, 1, 1, 7.0), (None, 0, 0, 1, 2.0), (None, 0, 0, 1, 6.0), (None, 0, 0, 0, 5.0)]
    table = spark.createDataFrame(rows, "k int, band int, row int, col int, dn double").repartition(3, "dn")
    got = pixels.pack_tiles(table, ["k"], 1, 2, 2, 1, 255, largest=True).collect()
    assert sorted(((r.k, list(r.data)) for r in got), key=str) == [(1, [9, 255, 255, 7]), (None, [5, 6, 255, 255])]


def test_series_without_a_list_of_dates_make_cells_once(spark):
    """Dates, the cap and blocks come from cells that were made once."""
    made, seen = _counted(spark, [("t", p, 1, 0, 0, 20200000000000 + d * 10**8, bytearray([p, d])) for p in range(5) for d in range(1, 8)])
    asked = spark.createDataFrame([(p, "t", p, 1, 0, 0) for p in range(4)], "rid int, htable string, hpid int, z int, y int, x int").selectExpr(
        "*", "20200200000000L startdt", "20200700000000L stopdt", *(f"-1 {n}" for n in ("month", "day", "hour", "minute", "second")))
    got = cells.between(made, asked, ["rid"], 3).collect()
    assert sorted((r.rid, bytes(r.data)) for r in got) == [(p, bytes([p, d])) for p in range(4) for d in (2, 3, 4)]
    assert seen.value == 35


def test_packing_tells_keys_of_one_hash_apart(spark, monkeypatch):
    """Tiles go on over many batches and their hashes are equal: one block a key, largest values, whatever the kinds of keys."""
    rows = [(k, s, d, 0, p // 4, p % 4, float((p * 7 + v * 3 + (k or 0)) % 90))
            for k in (3, None, -5) for s in ("a", None) for d in (20200100000000, -(1 << 62) - 1) for p in range(0, 16, 3) for v in range(4)]
    rows.append((3, "a", 20200100000000, 0, 0, 0, None))
    table = spark.createDataFrame(rows, "k int, s string, d bigint, band int, row int, col int, dn double").repartition(5)
    want = {}
    for k, s, d, _, r, c, v in rows:
        tile = want.setdefault((k, s, d), [255] * 16)
        tile[r * 4 + c] = v if tile[r * 4 + c] == 255 else max(tile[r * 4 + c], v or 0)

    def packed():
        got = pixels.pack_tiles(table, ["k", "s", "d"], 1, 4, 4, 1, 255, largest=True).collect()
        assert len(got) == len(want) and {(r.k, r.s, r.d): list(r.data) for r in got} == want

    packed()
    monkeypatch.setattr(pixels.F, "xxhash64", lambda *names: F.lit(7).cast("bigint") + F.col("k").isNull().cast("bigint"))
    packed()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        packed()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_packing_sorts_one_column_and_sends_few(spark):
    """No comparison of rows decides the order, and the number of columns that go to Python does not grow with the keys."""
    table = spark.createDataFrame([(1, 2, 3, 4, 5, 0, 0, 0, 1.0)], "hpid int, z int, y int, x int, dt bigint, band int, row int, col int, dn double")
    plan = pixels.pack_tiles(table, ["hpid", "z", "y", "x", "dt"], 1, 2, 2, 1, 255, largest=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [hash_" in plan and plan.count("ASC") == 1
    sent = [line for line in plan.splitlines() if "numbers_" in line and "Project" in line]
    assert len(sent) == 1 and sent[0].count(" AS ") == 1
