"""Stores, orders, jobs and the feed on small tables in temporary folders."""

import json

import numpy as np
from pyspark.sql import functions as F

from rastergrid import joins
from rastergrid.operators import reading, style
from rastergrid.plans import export, tile_job
from rastergrid.sources import cells, keyed_cells, orders, tables, tile_files
from rastergrid.streaming import feed

CELLS = "htable string, hpid int, z int, y int, x int, dt bigint, data binary"


def scans(df):
    """Files read by each scan of a stored table under ``df``, which is run first."""
    df.collect()
    found = []

    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(plan.plan())
        if name == "FileSourceScanExec" and "cells" in str(plan.relation().location().rootPaths()):
            found.append(plan.metrics().apply("numFiles").value())
        for k in range(plan.children().size()):
            walk(plan.children().apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_upsert_touches_only_its_folders(spark, tmp_path):
    path = str(tmp_path / "cells")
    dates = [y * 10**10 + m * 10**8 for y in (2019, 2020) for m in (1, 2, 3)]
    rows = [("t", p, 1, 0, x, d, bytearray([p, x])) for p in (1, 2) for x in range(3) for d in dates]
    cells.write(spark.createDataFrame(rows, CELLS), path)

    def files(plane, date):
        return sorted((tmp_path / "cells" / "htable=t" / f"hpid={plane}" / f"date={date}").glob("*.parquet"))

    before = {(p, d): files(p, d) for p in (1, 2) for d in dates}
    edits = [(*rows[-1][:6], bytearray(b"old"), 1), (*rows[-1][:6], bytearray(b"new"), 2), (*rows[-1][:6], bytearray(b"new"), 2), ("t", 3, 0, 0, 0, 1, bytearray(b"add"), 1)]
    cells.upsert(spark, path, spark.createDataFrame(edits, CELLS + ", seq int"), "seq")
    got = {tuple(r)[:6]: bytes(r.data) for r in cells.read(spark, path).select(*cells.CELL, "data").collect()}
    assert len(got) == 37 and got[rows[-1][:6]] == b"new" and got[("t", 3, 0, 0, 0, 1)] == b"add"
    assert got[rows[0][:6]] == bytes(rows[0][6])
    assert [k for k, names in before.items() if files(*k) != names] == [(2, dates[-1])]
    listed = {tuple(r) for r in cells.dates(spark, path).select("htable", "hpid", "dt").collect()}
    assert listed == {("t", p, d) for p in (1, 2) for d in dates} | {("t", 3, 1)}
    stored = cells.read(spark, path)
    plan = cells.dated(stored, 20200000000000, 20201231000000)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    planes = spark.createDataFrame([("t", 2, dates[3])], "htable string, hpid int, dt bigint")
    named = cells.of_planes(stored, planes)
    assert {(r.hpid, r.dt) for r in named.collect()} == {(2, dates[3])}
    assert scans(cells.of_planes(stored, planes)) == [1]
    ranged = spark.createDataFrame([("t", 1, 20190000000000, 20200150000000)], "htable string, hpid int, startdt bigint, stopdt bigint")
    reached = cells.request_dates(ranged, cells.dates(spark, path))
    assert sorted(r.dt for r in reached.collect()) == dates[:4]
    assert cells.of_planes(stored, reached).count() == 12


def test_reads_open_only_the_folders_of_their_dates(spark, tmp_path):
    path = str(tmp_path / "cells")
    dates = [20200100000000 + k * 10**8 for k in range(8)]
    rows = [("t", p, 2, y, x, d, bytearray([p, y, x])) for p in (1, 2) for y in range(2) for x in range(4) for d in dates]
    cells.write(spark.createDataFrame(rows, CELLS), path)
    stored = cells.read(spark, path)
    asked = [(k, "t", 1 + k % 2, 2, 1, 3, dates[2 + k % 2]) for k in range(50)] + [(50, "t", 1, 2, 9, 9, dates[2]), (51, "u", 1, 2, 0, 0, dates[2])]
    requests = spark.createDataFrame(asked, "rid int, htable string, hpid int, z int, y int, x int, dt bigint")
    found = cells.at(stored, requests)
    # Of 16 folders those of two planes and two dates, as every column of a folder is pruned for itself.
    assert scans(found) == [4]
    assert {r.rid: r.data and bytes(r.data) for r in found.collect()} == {k: bytes([1 + k % 2, 1, 3]) if k < 50 else None for k in range(52)}
    series = requests.drop("dt").selectExpr(
        "*", f"{dates[1]}L startdt", f"{dates[6]}L stopdt", "CASE WHEN rid % 2 = 0 THEN 4 ELSE -1 END AS month", *(f"-1 {n}" for n in ("day", "hour", "minute", "second"))
    )
    want = {(k, d) for k in range(50) for d in ([dates[3]] if k % 2 == 0 else dates[1:7])}
    listed = cells.dates(spark, path)
    for cap, kept in ((None, want), (2, {(k, d) for k, d in want if k % 2 == 0 or d <= dates[2]})):
        got = cells.between(stored, series, ["rid"], cap, listed)
        assert {(r.rid, r.dt) for r in got.collect()} == kept
        # Dates that no request can have are not opened: six of eight, or the three that the cap leaves, of two planes.
        assert scans(cells.between(stored, series, ["rid"], cap, listed)) == [12 if cap is None else 6]


def test_folders_of_years(spark, tmp_path):
    """A store of small tiles keeps a year in a folder; reads and upserts go by years then."""
    path = str(tmp_path / "cells")
    dates = [y * 10**10 + m * 10**8 for y in (2019, 2020) for m in range(1, 13)]
    cells.write(spark.createDataFrame([("t", 1, 1, 0, x, d, bytearray([x])) for x in range(2) for d in dates], CELLS), path, period="year")
    edit = spark.createDataFrame([("t", 1, 1, 0, 1, dates[13], bytearray(b"new"), 1)], CELLS + ", seq int")
    untouched = sorted((tmp_path / "cells" / "htable=t" / "hpid=1" / "year=2019").iterdir())
    cells.upsert(spark, path, edit, "seq", "year")
    assert sorted((tmp_path / "cells" / "htable=t" / "hpid=1" / "year=2019").iterdir()) == untouched
    stored = cells.read(spark, path, "year")
    assert stored.count() == 48 and cells.dated(stored, dates[12], dates[14]).count() == 6
    requests = spark.createDataFrame([(7, "t", 1, 1, 0, 1, dates[13])], "rid int, htable string, hpid int, z int, y int, x int, dt bigint")
    found = cells.at(stored, requests)
    assert bytes(found.first().data) == b"new" and scans(cells.at(stored, requests)) == [1]


def test_wanted_keys_beyond_a_broadcast(spark):
    rows = spark.range(2000).selectExpr("id AS a", "id % 7 AS b", "id * 2 AS v")
    wanted = spark.range(100, 130).selectExpr("id AS a", "id % 7 AS b")
    few = joins.keep_wanted(rows, wanted, ["a", "b"], F.col("a") >= 0)
    marked = joins.keep_wanted(rows, wanted, ["a", "b"], F.col("a") >= 0, limit=0)
    assert {r.a for r in few.collect()} == set(range(100, 130))
    assert {r.a for r in marked.collect()} >= set(range(100, 130)) and marked.count() < 60
    assert joins.keep_wanted(rows, wanted.limit(0), ["a", "b"], F.col("a") >= 0, limit=-1).count() == 0


def test_curve_code_interleaves_bits(spark):
    rows = [(y, x) for y in (0, 1, 2, 5, 1023, (1 << 20) + 7) for x in (0, 1, 3, 6, 2047, (1 << 21) - 1)]
    got = spark.createDataFrame(rows, "y int, x int").select("y", "x", cells.curve_code("y", "x").alias("c")).collect()
    for r in got:
        assert r.c == sum(((r.y >> k & 1) << (2 * k + 1)) | ((r.x >> k & 1) << (2 * k)) for k in range(22))


def test_tile_files_by_path(spark, tmp_path):
    root = str(tmp_path / "tiles")
    rows = [("t", 1, 2, 0, x, d, bytearray(b"%d-%d" % (x, d))) for x in range(3) for d in range(20200100000000, 20201300000000, 100000000)]
    assert tile_files.write(spark.createDataFrame(rows, CELLS), root) == len(rows)
    (tmp_path / "tiles" / "t" / "1" / "tile_bad").write_bytes(b"zz")
    files = tile_files.read(spark, root)
    assert files.count() == len(rows)
    asked = spark.createDataFrame([(1, "t", 1, 2, 0, 1, 20200300000000), (2, "t", 1, 2, 0, 9, 20200300000000)], "rid int, htable string, hpid int, z int, y int, x int, dt bigint")
    got = {r.rid: r.data and bytes(r.data) for r in tile_files.at(spark, root, asked).collect()}
    assert got == {1: b"1-20200300000000", 2: None}
    plan = tile_files.at(spark, root, asked)._jdf.queryExecution().toString()
    assert "binaryFile" not in plan and "BinaryFile" not in plan
    series = asked.drop("dt").selectExpr(
        "*", "20200200000000L startdt", "20201100000000L stopdt", "CASE rid WHEN 1 THEN -1 ELSE 3 END AS month", *(f"0 {n}" for n in ("day", "hour", "minute", "second"))
    )
    assert tile_files.between(spark, root, series, ["rid"]).count() == 10
    first = tile_files.between(spark, root, series, ["rid"], cap=3).collect()
    assert sorted(r.dt for r in first) == [20200200000000, 20200300000000, 20200400000000]
    # Two open parts are one too many, unless that is allowed; no day but 0 is stored.
    open_days = series.withColumn("day", F.lit(-1))
    assert tile_files.between(spark, root, open_days, ["rid"]).count() == 0
    assert tile_files.between(spark, root, open_days, ["rid"], max_wildcards=None).count() == 0


def test_mosaic_blocks_against_slices_of_the_level(spark):
    """Blocks of any size put together give the box, cut from the whole level with fill where no tile is."""
    rng, size, level = np.random.default_rng(8), 4, 2
    whole = np.full((2, 8, 16), 9, "<i2")
    rows = []
    for y in range(2):
        for x in range(4):
            if (y, x) != (1, 2):
                tile = rng.integers(-300, 300, (2, size, size)).astype("<i2")
                whole[:, y * size : y * size + size, x * size : x * size + size] = tile
                rows.append(("t", 1, level, y, x, 5, bytearray(tile.tobytes())))
    stored = spark.createDataFrame(rows, CELLS)
    boxes = [(1, -180.0, 180.0, 90.0, -90.0), (2, -100.0, 33.0, 41.0, -60.0), (3, 10.0, 10.5, 0.0, -0.5), (4, 170.0, 400.0, 100.0, 80.0), (5, 40.0, 10.0, 5.0, 0.0)]
    orders = spark.createDataFrame([(k, "t", 1, 5, level, *box) for k, *box in boxes], "k int, htable string, hpid int, dt bigint, level int, left double, right double, top double, bottom double")
    degrees = 360 / 16
    for block in (3, 5, 64):
        got = {}
        for r in export.export_blocks(orders, stored, ["k"], 2, size, 3, 9, block=block).collect():
            assert r.rows <= block and r.cols <= block
            got.setdefault(r.k, []).append(r)
        assert set(got) == {1, 2, 3, 4}
        for k, left, right, top, bottom in boxes[:4]:
            r0, c0 = int(max(0, np.floor((90 - top) / degrees))), int(np.floor((left + 180) / degrees))
            r1, c1 = int(np.ceil((90 - bottom) / degrees)), int(min(16, np.ceil((right + 180) / degrees)))
            seen = np.full((2, r1 - r0, c1 - c0), -1000, "<i2")
            for r in got[k]:
                part = seen[:, r.row0 - r0 : r.row0 - r0 + r.rows, r.col0 - c0 : r.col0 - c0 + r.cols]
                assert (part == -1000).all()
                part[:] = np.frombuffer(r.data, "<i2").reshape(2, r.rows, r.cols)
            assert (seen == whole[:, r0:r1, c0:c1]).all()


def test_keyed_cells_put_and_get(spark):
    kv = spark.createDataFrame([], keyed_cells.SCHEMA)
    put = spark.createDataFrame([("t", "f", bytearray(b"q"), bytearray(b"k"), bytearray(v), i) for i, v in enumerate((b"1", b"2"))], keyed_cells.SCHEMA + ", seq int")
    stored = keyed_cells.put(kv, put, "seq")
    assert [bytes(r.data) for r in keyed_cells.get(stored, put.select(*keyed_cells.KEY).distinct()).collect()] == [b"2"]


def test_orders_and_results(spark, tmp_path):
    (tmp_path / "o").mkdir()
    order = {"jsfile": "a.js", "roi": "sys:1", "roi_comment": "ignored", "filldata": 0, "dt": 20200101000000, "sdui": "", "mpid_hpid": 1001, "out_htable": "out", "out_hcol": 1, "out_hpidlen": 4, "out_xylen": 4}
    for i in range(2):
        (tmp_path / "o" / f"{i}.json").write_text(json.dumps({**order, "mpid_hpid": i}, indent=2))
    got = orders.read_orders(spark, str(tmp_path / "o")).orderBy("mpid_hpid").collect()
    assert [r.mpid_hpid for r in got] == [0, 1] and got[0].filldata == 0.0 and got[0].order_file.endswith("0.json")
    orders.write_results(spark.createDataFrame([(0, 'done "ok"')], "state int, message string"), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).first().message == 'done "ok"'


def test_catalog_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "pid int, name string")
    catalog = tables.Catalog(spark, root=str(tmp_path))
    catalog.append("tbproduct", rows)
    catalog.append("tbproduct", rows)
    assert catalog.table("tbproduct").count() == 2
    catalog.save("tbproduct", catalog.table("tbproduct").distinct(), str(tmp_path / "next"))
    assert tables.Catalog(spark, root=str(tmp_path / "next")).table("tbproduct").count() == 1


SIZE = 4


def small_job(spark, order_rows, input_rows, cell_rows, segments=(("sys:1", 1, 0, 0, 1),)):
    products = spark.createDataFrame(
        [(1, "a", "P", 1), (2, "b", "P", 2), (3, "c", "Q", 1)], "pid int, name string, proj string, maxZoom int"
    ).selectExpr("*", "0 minZoom", "1 dataType", "1 timeType", "'t' hTableName", f"{SIZE} tileWid", f"{SIZE} tileHei", "'hbase' source")
    bands = spark.createDataFrame([(p, b, p * 10, b) for p in (1, 2, 3) for b in (0, 1)], "pid int, bindex int, hPid int, bsqIndex int")
    return tile_job.JobInputs(
        spark.createDataFrame(
            [(o, 7, roi, 9.0, 100 + o, "out", 5, 4, 2) for o, roi in order_rows],
            "order_id bigint, dt bigint, roi string, filldata double, mpid_hpid int, out_htable string, out_hcol bigint, out_hpidlen int, out_xylen int",
        ),
        spark.createDataFrame(input_rows, "order_id bigint, position int, dsname string, dt bigint, bands array<int>"),
        products, bands, spark.createDataFrame([], "fid int, pid int, hcol bigint"),
        spark.createDataFrame(cell_rows, CELLS),
        spark.createDataFrame(list(segments), "roi_id string, level int, grow int, x0 int, x1 int"),
    )


def test_job_states_values_and_registration(spark, tmp_path):
    def block(low):
        return bytearray(range(low, low + 2 * SIZE * SIZE))

    tiles = [(0, 0, 0), (1, 0, 0), (1, 0, 1)]
    cell_rows = [("t", 10, *t, 7, block(i)) for i, t in enumerate(tiles)] + [("t", 20, *t, 8, block(50 + i)) for i, t in enumerate(tiles[:2])]
    order_rows = [(1, ""), (2, "sys:1"), (3, "sys:9"), (4, ""), (5, ""), (6, ""), (7, ""), (8, "")]
    inputs = [
        (1, 0, "a", None, [1]), (2, 0, "a", 7, []), (3, 0, "a", 7, []), (4, 0, "a", 7, []), (4, 1, "c", 7, []), (5, 0, "zz", 7, []),
        (6, 0, "a", 99, []), (7, 0, "a", 7, [0]), (7, 1, "b", 8, [1, 0]), (8, 0, "a", 7, [2]),
    ]
    job = small_job(spark, order_rows, inputs, cell_rows)
    job.script_regions = spark.createDataFrame([(2, "")], "order_id bigint, roi_id string")
    scratch, store = str(tmp_path / "scratch"), str(tmp_path / "store")
    cells.write(job.cells.filter(F.lit(False)), store)
    outcome = tile_job.run_jobs(spark, job, lambda tile: tile.max(axis=0)[None], store, scratch, SIZE)
    got = {r.order_id: (r.state, r.good, r.bad) for r in outcome.collect()}
    assert got == {1: (0, 3, 0), 2: (0, 2, 0), 3: (23, 0, 0), 4: (22, 0, 0), 5: (21, 0, 0), 6: (20, 0, 0), 7: (0, 2, 1), 8: (20, 0, 0)}
    stored = {(r.hpid, r.z, r.y, r.x): np.frombuffer(r.data, np.uint8).reshape(SIZE, SIZE) for r in cells.read(spark, store).collect()}
    plane = np.arange(SIZE * SIZE, dtype=np.uint8).reshape(SIZE, SIZE)
    assert (stored[101, 1, 0, 1] == plane + 2 + 16).all()
    clipped = np.full((SIZE, SIZE), 9)
    clipped[0, :2] = (plane + 1 + 16)[0, :2]
    assert (stored[102, 1, 0, 0] == clipped).all()
    # Three bands of two datasets, in the order they were listed.
    assert (stored[107, 1, 0, 0] == plane + 51 + 16).all()
    made = tile_job.registrations(outcome, job, 1, 1, F.to_timestamp(F.lit("2024-01-02 03:04:05")))
    assert {r.pid for r in made["bands"].collect()} == {101, 102, 107}
    assert made["items"].first().createtime == "2024/01/02 03:04:05"
    assert {r.name for r in made["products"].collect()} == {"user/101", "user/102", "user/107"}
    keyed = tile_job.with_row_keys(spark.read.schema(tile_job.RESULT_SCHEMA).parquet(f"{scratch}/tiles"))
    assert {bytes(r.rowkey).hex() for r in keyed.filter("order_id = 1 AND x = 1").collect()} == {"0100000065010000" + "0001"}


def test_message_of_a_good_job(spark, tmp_path):
    job = small_job(spark, [(1, "")], [(1, 0, "a", 7, [0])], [("t", 10, 0, 0, 0, 7, bytearray(32))])
    store = str(tmp_path / "store")
    cells.write(job.cells.filter(F.lit(False)), store)
    row = tile_job.run_jobs(spark, job, lambda tile: tile, store, str(tmp_path / "s"), SIZE).first()
    assert (row.state, row.message) == (0, "success done, good:1, bad:2")


def test_dataset_reads_by_source(spark):
    products = spark.createDataFrame(
        [(1, "a", "hbase"), (2, "b", "file"), (3, "c", "other"), (4, "/u", "hbase")], "pid int, name string, source string"
    ).selectExpr("*", "'t' hTableName", "1 tileWid", "1 tileHei", "1 dataType")
    bands = spark.createDataFrame([(p, b, p, b) for p in (1, 2, 3, 4) for b in (0, 1)], "pid int, bindex int, hPid int, bsqIndex int")
    items = spark.createDataFrame([(1, 4, 5), (2, 4, 3)], "fid int, pid int, hcol bigint")
    stored = spark.createDataFrame([("t", 1, 0, 0, 0, 9, bytearray(b"ab")), ("t", 4, 0, 0, 0, 3, bytearray(b"uv"))], CELLS)
    files = spark.createDataFrame([("t", 2, 0, 0, 0, 9, bytearray(b"cd"))], CELLS)
    asked = [(1, "a", [1, 0]), (2, "b", []), (3, "c", []), (4, "/u", [1]), (5, "a", [2]), (6, "x", []), (7, "a", [0])]
    requests = spark.createDataFrame([(i, n, b, 0, 0, 0, 9 if i < 7 else 8) for i, n, b in asked], "request_id int, dsname string, bands array<int>, z int, y int, x int, dt bigint")
    got = {r.request_id: (r.status, r.log, r.data and bytes(r.data)) for r in reading.dataset_tiles(requests, products, bands, items, stored, files=files).collect()}
    assert got == {
        1: (0, "", b"ba"), 2: (0, "", b"cd"), 3: (1, reading.NO_SOURCE, None), 4: (0, "", b"uv"), 5: (1, reading.NO_BAND, None),
        6: (1, reading.NO_PRODUCT, None), 7: (1, reading.NO_CELL, None),
    }


def test_feed_in_several_batches_with_late_and_double_results(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feed, "MERGE_EVERY", 2)
    tasks = spark.createDataFrame([(i, 0) for i in range(4)], "ofid int, status int")
    schema = "ofid int, state int, event_id bigint"
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        feed.start(stream, out, check, "event_id").awaitTermination()
        return {r.ofid: r.status for r in feed.status_table(spark, out, tasks).collect()}

    assert run([(1, 0, 10), (2, 1, 11), (9, 0, 12), (None, 0, 13), (3, 0, None)]) == {0: 0, 1: 2, 2: 3, 3: 0}
    assert run([(1, 1, 5), (2, 0, 20)]) == {0: 0, 1: 2, 2: 2, 3: 0}
    assert run([(2, 0, 20), (2, 1, 11), (1, 1, 10)]) == {0: 0, 1: 3, 2: 2, 3: 0}
    assert run([(3, 1, 1)]) == {0: 0, 1: 3, 2: 2, 3: 3}
    assert run([(0, 0, 7), (3, 0, 1)]) == {0: 2, 1: 3, 2: 2, 3: 3}
    # A version has the tasks of its batch only; the base after four batches has each task once.
    assert spark.read.parquet(f"{out}/changes/version=3").count() == 1
    assert spark.read.parquet(f"{out}/base/version=3").count() == 4


def test_series_by_position_with_a_status_for_every_request(spark):
    products = spark.createDataFrame(
        [(1, "a", "hbase"), (2, "/u/b", "file"), (3, "c", "other"), (4, "d", "hbase")], "pid int, name string, source string"
    ).selectExpr("*", "'t' hTableName", "1 tileWid", "1 tileHei", "1 dataType")
    # Bands are numbered by position, so bindex 5 and 9 are bands 0 and 1.
    bands = spark.createDataFrame([(p, b, p * 10 + k, 0) for p in (1, 2, 3, 4) for k, b in enumerate((5, 9))], "pid int, bindex int, hPid int, bsqIndex int")
    stored = spark.createDataFrame([("t", 10, 0, 0, 0, d, bytearray(b"x%d" % d)) for d in (3, 1, 2)] + [("t", 11, 0, 0, 0, 2, bytearray(b"y"))], CELLS)
    files = spark.createDataFrame([("t", 21, 0, 0, 0, d, bytearray(b"f")) for d in (1, 2, 3, 9)], CELLS)
    asked = [(1, "a", [0]), (2, "a", [1, 0]), (3, "/u/b", [1]), (4, "zz", [0]), (5, "a", []), (6, "a", [5]), (7, "c", [0]), (8, "d", [0]), (9, "a", None)]
    requests = spark.createDataFrame([(i, n, b, 0, 0, 0, 1, 3) for i, n, b in asked], "request_id int, dsname string, bands array<int>, z int, y int, x int, startdt bigint, stopdt bigint").selectExpr(
        "*", *(f"-1 {n}" for n in ("month", "day", "hour", "minute", "second"))
    )
    got = sorted((r.request_id, r.dt or 0, r.status, r.log, r.data and bytes(r.data)) for r in reading.dataset_series(requests, products, bands, stored, files=files, cap=2).collect())
    assert got == [
        (1, 1, 0, "", b"x"), (1, 2, 0, "", b"x"), (2, 1, 1, reading.NO_CELL, None), (2, 2, 0, "", b"yx"),
        (3, 1, 0, "", b"f"), (3, 2, 0, "", b"f"), (3, 3, 0, "", b"f"), (4, 0, 1, reading.NO_PRODUCT, None), (5, 0, 1, reading.NO_LIST, None),
        (6, 0, 1, reading.NO_BAND, None), (7, 0, 1, reading.NO_SOURCE, None), (8, 0, 1, reading.NO_CELL, None), (9, 0, 1, reading.NO_LIST, None),
    ]


def test_styles_of_bands_from_a_table(spark):
    styles = spark.createDataFrame(
        [(1, [0], "gray", [(0.0, 200.0)]), (2, [1, 0, 1], "rgb", [(0.0, 100.0), (0.0, 0.0)]), (3, [], "rgba", None), (4, [0], "odd", None)],
        "styleid int, bands array<int>, type string, vranges array<struct<minval:double,maxval:double>>",
    ).selectExpr("*", "CAST(NULL AS array<struct<val:double,r:int,g:int,b:int,a:int,lbl:string>>) AS colors",
                 "named_struct('val', 0D, 'r', 7, 'g', 7, 'b', 7, 'a', 7, 'lbl', '') AS nodatacolor")
    pixels = spark.createDataFrame(
        [(1, 100.0, [100.0, 50.0]), (2, 100.0, [100.0, 50.0]), (3, 1.0, [1.0, 2.0, 300.0, 4.0]), (3, 1.0, [1.0, 2.0, 3.0]), (1, None, [None]), (4, 1.0, [1.0]), (9, 1.0, [1.0])],
        "styleid int, dn double, every array<double>",
    )
    got = [tuple(r.color) for r in style.apply_styles(pixels.coalesce(1), styles, values="every").select("styleid", "color").collect()]
    assert sorted(got) == sorted([(128, 128, 128, 255), (128, 255, 50, 255), (1, 2, 255, 4), (7, 7, 7, 7), (7, 7, 7, 7), (7, 7, 7, 7), (0, 0, 0, 0)])
