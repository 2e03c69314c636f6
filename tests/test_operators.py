import json
import os
import random
import struct

import duckdb
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tilewright import fixtures
from tilewright.fixtures import fixture
from tilewright.functions import text
from tilewright.operators import catalog as cat
from tilewright.operators import raster as ra
from tilewright.operators import regions as reg
from tilewright.operators import tiles as tl
from tilewright.operators.steps import cut, in_order, new_folder, scratch
from tilewright.plans import jobs, relational
from tilewright.sources import headers, tables, volumes


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=25))
def test_rectangles_cover_the_tiles_once(spark, keys):
    t = spark.createDataFrame([(5, x, y) for x, y in keys], "z int, x long, y long")
    covered = [(x, y) for r in tl.tile_rectangles(t).collect() for x in range(r.x_min, r.x_max + 1) for y in range(r.y_min, r.y_max + 1)]
    assert sorted(covered) == sorted(keys)


def test_cover(spark):
    boxes = spark.createDataFrame([(1, 179.0, 10.0, -179.0, -10.0, 3, 4), (2, 0.0, 1.0, 1.0, 0.5, 0, 0)], "chart_id long, west double, north double, east double, south double, zmin int, zmax int")
    got = tl.tile_cover(boxes).collect()
    assert {(r.x) for r in got if r.chart_id == 1 and r.z == 4} == {15, 0} and len(got) == len({tuple(r) for r in got})
    assert [tuple(r) for r in got if r.chart_id == 2] == [(2, 0, 0, 0)]
    assert {r.z for r in tl.tile_cover(boxes, overshoot=True).collect() if r.chart_id == 2} == {0, 1}


def test_ancestors_stop_at_a_missing_level(spark):
    t = spark.createDataFrame([(9, 8, 8), (6, 40, 40)], "z int, x long, y long")
    pool = spark.createDataFrame([(7, 2, 2), (8, 4, 4), (3, 5, 5), (5, 20, 20)], "z int, x long, y long")
    got = {(r.z, r.k) for r in tl.ancestor_lookup(t, pool).collect()}
    assert got == {(9, 1), (6, 1)}
    far = spark.createDataFrame([(3, 5, 5)], "z int, x long, y long")
    assert tl.ancestor_lookup(t.filter("z = 6"), far).first().k is None  # level 5 is missing, and lies below 6
    assert tl.ancestor_lookup(t.filter("z = 9"), spark.createDataFrame([(5, 0, 0)], "z int, x long, y long")).first().k == 4


def test_verify_and_resume(spark):
    t = spark.createDataFrame([(1, 3, 0, 0, 1), (1, 3, 1, 0, 0)], "chart_id long, z int, x long, y long, transp int")
    charts = spark.createDataFrame([(1,), (2,)], "chart_id long")
    got = {r.chart_id: (r.ok, r.reason) for r in tl.verify_catalog(charts, t).collect()}
    assert got == {1: (False, "empty column"), 2: (False, "no tiles")}
    assert tl.resume_missing(t, t).isEmpty()
    v = tl.verify_optimized(t, t.limit(0)).first()
    assert not v.sets_equal and v.missing == 2


def test_region_edges(spark):
    ring = [(0.0, 0.0), (0.0, 10.0), (10.0, 10.0), (10.0, 0.0), (0.0, 0.0)]
    polygons = reg.region_polygons(spark, {"R": ring})
    charts = spark.createDataFrame(
        [("/a/in.tif", 2.0, 3.0, 3.0, 2.0), ("/a/out.tif", 20.0, 3.0, 21.0, 2.0), ("/a/around.tif", -5.0, 15.0, 15.0, -5.0), ("/a/touch.tif", 10.0, 5.0, 12.0, 4.0), ("/a/40x.tif", 2.0, 3.0, 3.0, 2.0), ("/a/gone.tif", 2.0, 3.0, 3.0, 2.0)],
        "path string, west double, north double, east double, south double",
    )
    excludes = spark.createDataFrame([("R", "gone")], "region string, name string")
    want = {"/a/in.tif", "/a/around.tif", "/a/touch.tif"}
    assert {r.path for r in reg.assign_regions(charts, polygons, excludes).collect()} == want
    gridded = reg.assign_regions(charts, polygons, excludes, most=0).collect()
    assert sorted(r.path for r in gridded) == sorted(want)


@pytest.mark.parametrize("most", [0, 64])
def test_regions_at_the_dateline(spark, most):
    """Boxes with west beyond east are two boxes; inner cells, edge cells and boxes of any size."""
    rings = {"E": [(-60.0, -180.0), (60.0, -180.0), (50.0, -170.0), (-50.0, -172.0), (-60.0, -180.0)], "W": [(-60.0, 100.0), (60.0, 100.0), (60.0, 180.0), (-60.0, 180.0), (-60.0, 100.0)]}
    boxes = [("both", 179.0, 5.0, -179.0, 4.0), ("w", 179.0, 5.0, 179.5, 4.0), ("e", -179.9, 5.0, -179.0, 4.0), ("far", 90.0, 5.0, 99.9, 4.0), ("touch", 90.0, 5.0, 100.0, 4.0), ("world", -180.0, 85.0, 180.0, -85.0), ("north", 179.0, 70.0, -179.0, 61.0), ("tiny", 140.0, 0.00001, 140.00001, 0.0), ("point", 100.0, 60.0, 100.0, 60.0)]
    charts = spark.createDataFrame([(f"/a/{n}.tif", *b) for n, *b in boxes], "path string, west double, north double, east double, south double")
    got = reg.assign_regions(charts, reg.region_polygons(spark, rings), reg.region_excludes(spark), most=most).collect()
    found = {n: {r.region for r in got if r.name_ == n} for n, *_ in boxes}
    assert found == {"both": {"E", "W"}, "w": {"W"}, "e": {"E"}, "far": set(), "touch": {"W"}, "world": {"E", "W"}, "north": set(), "tiny": {"W"}, "point": {"W"}}
    assert len(got) == sum(map(len, found.values()))


def test_skipped_zooms(spark):
    """Every second zoom from the top goes, if the two highest are neighbours."""
    t = spark.createDataFrame([(c, z, 0, 0) for c, zs in ((1, (9, 10, 11, 12)), (2, (9, 10, 12)), (3, (5,)), (4, (3, 7, 8))) for z in zs], "chart_id long, z int, x long, y long")
    got = {c: sorted(r.z for r in tl.skip_zooms(t).filter(F.col("chart_id") == c).collect()) for c in (1, 2, 3, 4)}
    assert got == {1: [10, 12], 2: [9, 10, 12], 3: [5], 4: [3, 8]}


def test_manifests(spark):
    a, b = (spark.createDataFrame(rows, "region string, v int") for rows in ([("A", 1), ("B", 1)], [("B", 2), ("C", 2)]))
    assert {(r.region, r.side) for r in reg.manifest_diff(a, b).collect()} == {("A", "now"), ("C", "before")}
    assert reg.manifest_diff(a, a).isEmpty()
    assert {tuple(r) for r in reg.merge_manifests(a, b).collect()} == {("A", 1), ("B", 2), ("C", 2)}


def text_of(folder):
    return "".join(p.read_text() for p in sorted(folder.glob("part-*.txt")))


@pytest.mark.parametrize("n", [0, 1, 40])
def test_manifest_files(spark, tmp_path, n):
    """The files in order are one JSON text, whatever is in the names, and are read back by lines."""
    rows = [(f'R "{i}" \\\u00e9]}}', i, None if i % 3 else "x\ny") for i in range(n)]
    df = spark.createDataFrame(rows, "region string, v long, w string").repartition(3)
    tables.write_manifest(df, str(tmp_path / "m"))
    assert json.loads(text_of(tmp_path / "m")) == {"manifest_version": 1, "regions": {r: {"v": v} | ({"w": w} if w else {}) for r, v, w in rows}}
    assert sorted(map(tuple, tables.read_manifest(spark, str(tmp_path / "m"), "v long, w string").collect())) == sorted(rows)
    tables.write_manifest(df, str(tmp_path / "c"), "charts")
    assert [x["region"] for x in json.loads(text_of(tmp_path / "c"))["charts"]] == sorted(r for r, _, _ in rows)
    assert sorted(map(tuple, tables.read_manifest(spark, str(tmp_path / "c"), "region string, v long, w string", "charts").collect())) == sorted(rows)


@pytest.mark.parametrize("n", [0, 1, 300])
def test_region_files(spark, tmp_path, n):
    """A region with most paths is written and read in pieces; odd names and paths that repeat are kept."""
    rows = [("A" if i % 3 else f'b "{i % 7}"\\', f'/p "{i // 2}":["\\') for i in range(n)]
    tables.write_region_files(spark.createDataFrame(rows, "region string, path string").repartition(3), str(tmp_path / "r"))
    want = {}
    for r, p in sorted(rows):
        want.setdefault(r, []).append(p)
    assert json.loads(text_of(tmp_path / "r")) == want
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert sorted(map(tuple, tables.read_region_files(spark, str(tmp_path / "r")).collect())) == sorted(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_dedup_order(spark):
    files = spark.createDataFrame([("/x/2706-2_UD.tif",), ("/x/2706-2_W.tif",), ("/x/9-1_UD.tif",), ("/x/9-1.tif",)], "path string")
    assert {r.path for r in reg.dedup_charts(files).filter("kept").collect()} == {"/x/2706-2_W.tif", "/x/9-1.tif"}
    assert reg.has_duplicates(files)


def test_stage_log(spark):
    log = spark.createDataFrame([(1, "R:::P:::CHECKPOINT_MERGE"), (2, "bad"), (3, "R:::P:::nonsense")], "line_no long, line string")
    assert [tuple(r) for r in cat.latest_stage(log).collect()] == [("R", "P", 0)]
    jobs_ = spark.createDataFrame([("R", "P"), ("S", "P")], "region string, profile string")
    assert {(r.region, r.pending) for r in cat.pending_stage(jobs_, log.filter("line_no = 1"), 3).collect()} == {("R", False), ("S", True)}


def tile(value, n=4):
    return np.full((n, n, 4), value, np.uint8).tobytes()


def test_helpers():
    rng = np.random.default_rng(0)
    top, low = rng.integers(0, 256, (2, 4, 4, 4), dtype=np.uint8)
    exact = np.round((top.astype(float) * top[..., 3:] + low.astype(float) * (255.0 - top[..., 3:])) / 255)
    assert np.abs(ra.blend(top, low).astype(int) - exact).max() <= 1
    assert ra.layer_step(None, 1, low) is low and (ra.halve(np.full((4, 4, 4), 7, np.uint8)) == 7).all()
    assert (ra.resample(low, 4) == low).all() and ra.resample(low, 2).shape == (2, 2, 4)
    assert ra.class_of(np.zeros((2, 2, 4), np.uint8)) == 0


def test_pyramid(spark):
    rows = [(3, x, y, tile(255), 1) for x in range(4) for y in range(2)] + [(2, 0, 0, tile(9), -1)]
    t = spark.createDataFrame(rows, "z int, x long, y long, content binary, transp int")
    got = {(r.z, r.x, r.y): r for r in ra.build_pyramid(t, 1, 3).collect()}
    assert set(got) == {(3, x, y) for x in range(4) for y in range(2)} | {(2, 0, 0), (2, 1, 0), (1, 0, 0)}
    assert bytes(got[2, 0, 0].content) == tile(9) and bytes(got[2, 1, 0].content) == tile(255)


def test_per_chart_pyramid(spark):
    rows = [(c, 2, 3, 1, tile(255), 1) for c in (5, 900)]
    t = spark.createDataFrame(rows, "chart_id long, z int, x long, y long, content binary, transp int")
    got = {(r.chart_id, r.z, r.x, r.y) for r in jobs.per_chart_pyramid(t, 0, 2).collect()}
    assert got == {(c, z, x, y) for c in (5, 900) for z, x, y in ((2, 3, 1), (1, 1, 0), (0, 0, 0))}


def test_burn_and_mask(spark):
    b = spark.createDataFrame([("c", 0, 0, tile(1)), ("c", 1, 0, tile(1))], "chart string, bx long, by long, content binary")
    r = spark.createDataFrame([("c", 3, 0, 2, 1, 9, 9, 9)], "chart string, x_off int, y_off int, width int, height int, r int, g int, b int")
    got = {x.bx: ra.image(bytes(x.content)) for x in ra.burn_rectangles(b, r, 4).collect()}
    assert got[0][0, 3].tolist() == [9, 9, 9, 255] and got[1][0, 0].tolist() == [9, 9, 9, 255] and got[1][0, 1].tolist() == [1, 1, 1, 1]


def test_hole_filling_takes_the_ancestor(spark):
    rows = [(7, 2, 2, -1, np.array([[[0, 0, 0, 0]] * 4] * 4, np.uint8).tobytes()), (6, 1, 1, 1, tile(255))]
    t = spark.createDataFrame(rows, "z int, x long, y long, transp int, content binary")
    got = {r.z: bytes(r.content) for r in ra.fill_holes(t).collect()}
    assert got[7] == tile(255)


def test_sources(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "1_1.KAP").write_bytes(b"!h\nKNP/SC=5000,GD=WGS84\nBSB/NA=X,NU=1\n\x1a\x00\xff\n")
    (tmp_path / "c" / "2.txt").write_text("no")
    (tmp_path / "c" / ".kap").write_text("no")
    assert [r.name for r in tables.scan_files(spark, str(tmp_path / "c")).collect()] == ["1_1.KAP"]
    head = tables.read_chart_headers(spark, str(tmp_path / "c" / "1_1.KAP"))
    assert head.first().lines == ["!h", "KNP/SC=5000,GD=WGS84", "BSB/NA=X,NU=1"] and cat.parse_headers(head).first().scale == 5000
    for name, content in (("ply", "PLY/1,38.9,-76.6\nPLY/2,39,-76\n"), ("dmm", "55 30.0,-005 30.0\n56 00.0,-005 00.0\n"), ("plain", "1,2\n3,4\n1,2\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / ("k.txt" if name == "plain" else "k")).write_text(content)
    rings = {n: tables.read_overrides(spark, str(tmp_path / n), n).first() for n in ("ply", "dmm", "plain")}
    assert rings["ply"].key == rings["plain"].key == "k" and len(rings["ply"].ring) == 3 and rings["dmm"].ring[0].lng == -5.5 and len(rings["plain"].ring) == 3
    tree = tmp_path / "set1" / "3" / "4"
    tree.mkdir(parents=True)
    (tree / "5.png").write_bytes(b"x")
    assert tuple(tables.read_tile_tree(spark, str(tmp_path / "set1")).first())[:4] == ("set1", 3, 4, 5)


def region_inputs(spark):
    charts = spark.createDataFrame([(1, 100, "A", "/c/1.KAP"), (2, 50, "B", "/c/2.KAP"), (3, 10, "Cover for Chart", "/c/3.KAP")], "chart_id long, scale int, name string, path string").withColumns({k: F.lit("") for k in ("date", "outline", "depths", "max_zoom")})
    empty = np.zeros((4, 4, 4), np.uint8)
    half = empty.copy()
    half[:2] = 255
    rows = [(1, 4, 0, 0, 1, tile(255)), (2, 4, 0, 0, -1, half.tobytes()), (2, 4, 1, 0, 1, tile(255)), (1, 3, 0, 0, 1, tile(255))]
    return charts, spark.createDataFrame(rows, "chart_id long, z int, x long, y long, transp int, content binary")


def test_jobs(spark, tmp_path):
    charts, t = region_inputs(spark)
    done = jobs.compile_region("MX_REGION", charts, t, limit=200)
    assert {(r.z, r.x, r.y) for r in done.merged.collect()} == {(4, 0, 0), (4, 1, 0), (3, 0, 0)}
    assert [r.line_no for r in done.script.orderBy("line_no").collect()] == [-2, -1, 1, 2]
    assert {r.zoom_level for r in jobs.compile_region("MB_CHARTS", charts, t).mbtiles.collect()} == {4}
    with pytest.raises(ValueError, match="no tiles"):
        jobs.compile_region("MB_REGION", charts, t.filter("chart_id = 1"))
    some = jobs.compile_region("MX_REGION", charts, t.filter("chart_id = 1"), on_failure="drop")
    assert {(r.chart_id, r.ok) for r in some.verdicts.collect()} == {(1, True), (2, False)} and [(r.chart_id, r.rank) for r in some.catalog.collect()] == [(1, 1)]
    assert jobs.run_region(str(tmp_path / "drop"), "MX_REGION", charts, t.filter("chart_id = 1"), on_failure="drop") == 5
    assert spark.read.parquet(str(tmp_path / "drop" / "merged")).count() == 2 and spark.read.parquet(str(tmp_path / "drop" / "script")).count() == 3
    with pytest.raises(ValueError, match="unknown choice"):
        jobs.compile_region("MB_REGION", charts, t, on_failure="x")
    with pytest.raises(ValueError, match="without tiles"):
        ra.merge_region(cat.catalog_order(charts), t)
    with pytest.raises(ValueError, match="unknown profile"):
        jobs.compile_region("X", charts, t)


@pytest.mark.parametrize("limit", [200, 260, 10_000])
def test_an_archive_can_be_read(spark, tmp_path, limit):
    """Volumes as files, the header parsed as a reader would, and each tile found by its offset."""
    charts, t = region_inputs(spark)
    merged = jobs.compile_region("MX_REGION", charts, t, region="REG", limit=limit)
    tables.write_archive(merged.archive, str(tmp_path / "a"))
    volumes: dict[int, bytes] = {}
    for r in tables.read_archive(spark, str(tmp_path / "a")).orderBy("volume", "part", "seq_no").collect():
        volumes[r.volume] = volumes.get(r.volume, b"") + bytes(r.bytes)
    head = volumes[0]
    version, size, sources, index, length = struct.unpack_from(">5I", head)
    assert (version, size, sources, index, head[20 : 20 + length]) == (4, 256, 1, 0, b"REG")
    at = 20 + length
    (n,) = struct.unpack_from(">I", head, at)
    ranges = [struct.unpack_from(">6IQ", head, at + 4 + 32 * i) for i in range(n)]
    stream, found = b"".join(volumes[v] for v in sorted(volumes)), {}
    for z, x1, x2, y1, y2, _, place in ranges:
        for x in range(x1, x2 + 1):
            for y in range(y1, y2 + 1):
                offset, n_bytes = struct.unpack_from(">QI", head, place)
                found[z, x, y] = stream[offset : offset + n_bytes]
                place += 12
    assert found == {(r.z, r.x, r.y): bytes(r.content) for r in merged.merged.collect()}
    tiles_of = [len(v) for k, v in volumes.items() if k]
    assert all(x <= limit for x in tiles_of) and (limit < 10_000) == (len(volumes) > 1)


def test_volume_cuts_are_the_greedy_ones(spark):
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 400, 400).tolist()
    offsets = (1000 + np.r_[0, np.cumsum(sizes)[:-1]]).tolist()
    df = spark.createDataFrame(list(zip(offsets, sizes, strict=True)), "offset long, n_bytes long")
    for limit in (390, 5000, 20_000):
        want, start = [], 0
        for o, n in zip(offsets, sizes, strict=True):
            if o + n - start > limit and o > (want[-1] if want else -1):
                want.append(o)
                start = o
        for fan in (2, 4, 16):
            assert sorted(r.offset for r in tl.volume_cuts(df, limit, fan).collect()) == want
        got = {r.offset: (r.volume, r.at) for r in tl.archive_volumes(df.filter("n_bytes > 0"), limit).collect()}
        starts = [0, *want]
        assert got == {o: (v := sum(c <= o for c in want), o - starts[v]) for o, n in zip(offsets, sizes, strict=True) if n}
    assert tl.archive_volumes(df.limit(0), 10).isEmpty()


def test_the_uid_does_not_count_in_the_first_volume(spark):
    df = spark.createDataFrame([(116, 50), (166, 50), (216, 50)], "offset long, n_bytes long")
    assert [r.offset for r in tl.volume_cuts(df, 150, uid=16).collect()] == [166]
    assert [r.offset for r in tl.volume_cuts(df, 150).collect()] == [116]


def placed_archive(spark, n, limit, uid=b""):
    """An archive of two sources with n by n tiles each, as rows, and what its tiles hold."""
    rows = [(s, 5, x + s, y, f"{s}.{x}.{y}".encode() * (1 + (x * 7 + y) % 5)) for s in range(2) for x in range(n) for y in range(n) if (x + y) % 7]
    t = spark.createDataFrame(rows, "source_index int, z int, x long, y long, content binary").withColumn("n_bytes", F.octet_length("content").cast("long"))
    rects = tl.tile_rectangles(t.filter("source_index = 0"), 0).unionByName(tl.tile_rectangles(t.filter("source_index = 1"), 1))
    ranges = tl.range_offsets(rects, tl.source_list_size(["A", "LONGER"]), len(uid))
    placed = tl.archive_volumes(tl.tile_offsets(ranges, t.drop("content")), limit, len(uid))
    head = tl.archive_head(ranges, placed, ["A", "LONGER"], uid=uid)
    return tables.archive_rows(head, placed.join(t.select("source_index", "z", "x", "y", "content"), ["source_index", "z", "x", "y"])), {(("A", "LONGER")[s], z, x, y): c for s, z, x, y, c in rows}


@pytest.mark.parametrize("uid", [b"", b"0123456789abcdef"])
def test_volumes_are_files_that_a_header_leads_through(spark, tmp_path, uid):
    rows, want = placed_archive(spark, 9, 4000, uid)
    path = str(tmp_path / "REGION.gemf")
    volumes.write_volumes(rows, path)
    files = volumes.volumes_of(path)
    assert sorted(f.name for f in tmp_path.iterdir()) == sorted(f.rsplit("/", 1)[1] for f in files)
    assert files == [volumes.volume_path(path, i) for i in range(len(files))]
    stream = b"".join(open(f, "rb").read() for f in files)
    at, found, names = len(uid) + 12, {}, []
    assert stream.startswith(uid) and struct.unpack_from(">3I", stream, len(uid)) == (4, 256, 2)
    for i in range(2):
        index, size = struct.unpack_from(">2I", stream, at)
        names.append(stream[at + 8 : at + 8 + size].decode())
        at += 8 + size
    (n,) = struct.unpack_from(">I", stream, at)
    for i in range(n):
        z, x1, x2, y1, y2, source, place = struct.unpack_from(">6IQ", stream, at + 4 + 32 * i)
        for x in range(x1, x2 + 1):
            for y in range(y1, y2 + 1):
                offset, size = struct.unpack_from(">QI", stream, place)
                found[names[source], z, x, y] = stream[offset : offset + size]
                place += 12
    assert found == want
    for tiles in (1, 7, 10_000):
        assert {(r.source, r.z, r.x, r.y): bytes(r.content) for r in volumes.read_volumes(spark, path, tiles, len(uid)).collect()} == want
    # a shorter archive of the same name leaves no volume of the longer one
    rows, want = placed_archive(spark, 3, 10_000, uid)
    volumes.write_volumes(rows, path)
    assert volumes.volumes_of(path) == [path]
    assert {(r.source, r.z, r.x, r.y): bytes(r.content) for r in volumes.read_volumes(spark, path, uid=len(uid)).collect()} == want


def test_a_failed_write_leaves_the_old_archive(spark, tmp_path):
    rows, want = placed_archive(spark, 4, 4000)
    path = str(tmp_path / "R.gemf")
    volumes.write_volumes(rows, path)
    before = {f.name: f.read_bytes() for f in tmp_path.iterdir()}
    broken = rows.withColumn("bytes", F.when(F.col("part") < 3, F.col("bytes")).otherwise(F.expr("case when seq_no = 5 then unhex(cast(raise_error('lost') as string)) else bytes end")))
    for bad in (broken, rows.filter("part <> 2"), rows.filter("seq_no <> 3")):
        with pytest.raises(Exception):  # noqa: B017
            volumes.write_volumes(bad, path)
        assert {f.name: f.read_bytes() for f in tmp_path.iterdir()} == before
    with pytest.raises(ValueError, match="mounted"):
        volumes.local_path("hdfs://host/a")


def test_places_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 5).alias("v"))
    rows = sorted((r.k, r.v, r.place, r.before) for r in in_order(df, F.col("k").desc(), sums={"before": "v"}).collect())[::-1]
    total = 0
    for i, (_, v, place, before) in enumerate(rows):
        assert (place, before) == (i, total)
        total += v
    assert in_order(df.limit(0), "k").isEmpty()


def test_a_job_goes_on_where_it_ended(spark, tmp_path, monkeypatch):
    """A job that fails behind the merge goes on from the merged table; with other inputs it begins anew."""
    charts, t = region_inputs(spark)
    folder, merges = str(tmp_path / "job"), []
    real = jobs.merged_tiles
    monkeypatch.setattr(jobs, "merged_tiles", lambda *a: merges.append(1) or real(*a))
    with monkeypatch.context() as m, pytest.raises(OSError, match="full"):
        m.setattr(jobs.volumes, "write_volumes", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
        jobs.run_region(folder, "MX_REGION", charts, t, limit=1000)
    lines = [r.line for r in spark.read.json(f"{folder}/log").orderBy("line_no").collect()]
    assert [x.rsplit("_", 1)[1] for x in lines] == ["CATALOG", "VERIFY", "MERGE"] and lines[0] == "REGION:::MX_REGION:::CHECKPOINT_CATALOG"
    assert jobs.run_region(folder, "MX_REGION", charts, t, limit=1000) == 2 and merges == [1]
    assert jobs.run_region(folder, "MX_REGION", charts, t, limit=1000) == 0
    want = {(r.z, r.x, r.y): bytes(r.content) for r in jobs.compile_region("MX_REGION", charts, t).merged.collect()}
    assert {(r.z, r.x, r.y): bytes(r.content) for r in volumes.read_volumes(spark, f"{folder}/archive/REGION.gemf").collect()} == want
    assert spark.read.parquet(f"{folder}/script").count() == 4
    assert jobs.run_region(folder, "MX_REGION", charts, t, limit=2000) == 5
    assert jobs.run_region(str(tmp_path / "mb"), "MB_REGION", charts, t) == 4 and jobs.run_region(str(tmp_path / "ch"), "MB_CHARTS", charts, t) == 3
    with pytest.raises(ValueError, match="no tiles"):
        jobs.run_region(str(tmp_path / "bad"), "MB_REGION", charts, t.filter("chart_id = 1"))


def test_checkpoints_are_deleted_when_a_block_ends_well(spark, tmp_path):
    with scratch(spark):
        path = cut(spark.range(5))._jdf.queryExecution().logical().rdd().getCheckpointFile().get()
        folder = new_folder(spark, "x")
        spark.range(3).write.parquet(folder)
        assert spark.read.parquet(folder).count() == 3 and os.path.isdir(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:")) and not os.path.exists(folder.removeprefix("file:"))
    with pytest.raises(KeyError), scratch(spark):
        kept = cut(spark.range(5))
        raise KeyError
    assert kept.count() == 5


def test_headers_of_large_files(spark, tmp_path, monkeypatch):
    """A file of three GiB is read up to the end of its header, which spans blocks."""
    big, plain, odd = tmp_path / "a" / "BIG.KAP", tmp_path / "b c.kap", tmp_path / "none.kap"
    big.parent.mkdir()
    lines = ["BSB/NA=X" + "y" * 300] * 100
    with open(big, "wb") as file:
        file.write("\n".join([*lines, "cut"]).encode() + b"\x1a\x00\n")
        file.truncate(3 << 30)
    plain.write_bytes(b"one\n\xe9two\n")
    odd.write_bytes(b"")
    (tmp_path / "_hidden").write_bytes(b"x")
    got = {r.path.rsplit("/", 1)[1]: r.lines for r in tables.read_chart_headers(spark, str(tmp_path)).collect()}
    assert got == {"BIG.KAP": lines, "b c.kap": ["one", "two"], "none.kap": []}
    small = tables.read_chart_headers(spark, [str(plain), f"file:{odd}"]).collect()
    by_spark = spark.read.format("binaryFile").load([str(plain)]).select("path", tables.header_lines_of(F.col("content")).alias("lines")).collect()
    assert {(r.path, *r.lines) for r in small} == {(r.path, *r.lines) for r in by_spark} | {(f"file:{odd}",)}
    reads = []
    real = open

    class Counted:
        def __init__(self, *a, **k):
            self.file = real(*a, **k)

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.file.close()

        def read(self, n):
            part = self.file.read(n)
            reads.append(len(part))
            return part

    monkeypatch.setattr(headers, "open", Counted, raising=False)
    assert headers.lines_of(headers.read_header(str(big))) == lines and sum(reads) <= 3 * headers.BLOCK


def test_charts_are_cut_from_their_rasters(spark):
    """A raster of 2 by 2 blocks that covers one tile of zoom 2 exactly, enlarged or shrunk to four pixels, with overviews."""
    edge = 20037508.342789244
    size = edge / 2 / 8  # metres a pixel: eight pixels make the tile
    gt = [0.0, size, 0.0, edge / 2, 0.0, -size]
    charts = spark.createDataFrame([(7, 1.0, 60.0, 80.0, 10.0)], "chart_id long, west double, north double, east double, south double")
    rasters = spark.createDataFrame([(7, gt, 8, 8)], "chart_id long, gt array<double>, xsize int, ysize int")
    blocks = spark.createDataFrame([(7, bx, by, tile(40 * (1 + bx + 2 * by))) for bx in (0, 1) for by in (0, 1)], "chart_id long, bx long, by long, content binary")
    got = {(r.z, r.x, r.y): ra.image(bytes(r.content)) for r in jobs.cut_charts(charts, rasters, blocks, 1, 2, 4, 4).collect()}
    assert set(got) == {(2, 2, 1), (1, 1, 0)}
    assert [int(got[2, 2, 1][r, c, 3]) for r in (0, 3) for c in (0, 3)] == [40, 80, 120, 160]
    assert got[1, 1, 0][2:, :2, 3].tolist() == [[40, 80], [120, 160]] and not got[1, 1, 0][:2].any()


def test_catalog_and_product_files(spark, tmp_path):
    rows = spark.createDataFrame([("/c/1.KAP", "A", 3, 3, 100, "1/1/2020", "FEET", "1.0,2.0:3.0,4.0", 1), ("/c/2.KAP", "B", 3, 3, 50, "1/1/2020", "FEET", "", 2)], tables.CATALOG_SCHEMA)
    tables.write_catalog(rows, str(tmp_path / "c"))
    assert [tuple(r)[:9] for r in tables.read_catalog(spark, str(tmp_path / "c")).drop("ring").orderBy("rank").collect()] == [tuple(r) for r in rows.collect()]
    (tmp_path / "p.json").write_text('[\n {"path": "/c/1.KAP",\n  "rank": 1},\n {"path": "/c/2.KAP", "rank": 2}\n]')
    assert tables.read_catalog(spark, str(tmp_path / "p.json"), pretty=True).count() == 2
    (tmp_path / "x.xml").write_text("<a>file name: 9_9.KAP</a><gmd:EX_Extent id='1'>\n<s>title, file name: 1_1.KAP</s></gmd:EX_Extent><b/><EX_Extent><s>file name: 2_1.KAP</s></EX_Extent> file name: 8_8.KAP")
    assert sorted(r.name for r in tables.read_product_catalog(spark, str(tmp_path / "x.xml")).collect()) == ["1_1.KAP", "2_1.KAP"]


def test_headers_are_parsed_by_many_tasks(spark, tmp_path):
    """A table of one split, whose rows each have a header; the catalog's order samples what is written, not the parsers."""
    spark.range(12_000).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "1 AS p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    charts = relational.headers(fixture(spark, str(tmp_path), "chart_headers"))
    assert charts.rdd.getNumPartitions() == 3 and charts.select("scale").distinct().count() == 12_000
    ordered = cat.build_catalog(charts.withColumn("path", F.col("chart_id").cast("string")))
    assert "regexp" not in ordered._jdf.queryExecution().optimizedPlan().toString() and ordered.agg(F.max("rank")).first()[0] == 12_000


def test_charts_are_told_from_others_in_many_tasks(spark, tmp_path):
    """A filter on parsed fields is not moved before the rows are dealt out, where one task would parse all headers."""
    spark.range(12_000).selectExpr("id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "1 AS p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    charts = cat.valid_charts(relational.headers(fixture(spark, str(tmp_path), "chart_headers"))).select("scale", "name")
    above, below = charts._jdf.queryExecution().optimizedPlan().toString().split("Repartition")
    assert "Cover for Chart" in above and "Filter" not in below and charts.count() == 12_000


def test_fields_of_classed_lines_are_those_of_each_function(spark):
    heads = ["", "x\ny", "KNP/SC=5,GD=A\nKNP/GD=B\r\nBSB/NA=a,b\nBSB/NA=c", "UN=\nUN=FEET,z\nCED/SE=1,ED=01/02/2003x\nCED/SE", "PLY/1,1,2\nREF/1,a\r\nPLY/2,x,2\nPLY/3,3,4\nREF/PLY/4,5,6", "BSB/NAKNP/SC=7"]
    lines = spark.createDataFrame([(h,) for h in heads], "header string").union(spark.sql("SELECT CAST(NULL AS STRING)")).withColumn("lines", text.header_lines(F.col("header")))
    each = {n: getattr(text, f"header_{n}")(F.col("lines")) for n in ("scale", "projection", "datum", "units", "updated", "name", "ring", "refs")}
    assert [r.asDict() for r in cat.parse_headers(lines).select("header", *each).collect()] == [r.asDict() for r in lines.select("header", *(v.alias(k) for k, v in each.items())).collect()]


def test_ring_overrides_of_long_chart_numbers(spark):
    """A key of seven digits is not cut to six, which would be another chart's."""
    d = spark.createDataFrame([(i, f"KNP/SC=1\nPLY/1,{i % 80}.5,1\nPLY/2,8,1\nPLY/3,8,9\n") for i in (120_006, 1_200_061)], "chart_id long, header string")
    assert {r.chart_id: r.lat0 for r in relational.f2(d).collect()} == {120_006: 1.0, 1_200_061: 61.5}


def test_charts_named_40_have_no_region_in_the_sql_either(spark, tmp_path):
    """f3_own_boxes and its SQL on charts 40000_1 and their neighbours, which sf0.1 has not."""
    part = spark.range(29_990, 30_020).selectExpr("id AS p_partkey", "'A' AS p_type", "'n' AS p_name", "1 AS p_size")
    part.write.parquet(str(tmp_path / "part.parquet"))
    got = {tuple(r) for r in relational.QUERIES["f3_own_boxes"](spark, str(tmp_path)).collect()}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    assert got == set(db.execute(relational.ORACLE["f3_own_boxes"]).fetchall()) and got and max(i for i, _ in got) < 30_000


def test_boxes_meet_few_edges(spark):
    """Rings of 3904 edges: a box is held against those of its slabs only, in many tasks; f3_own_boxes did all, in one."""
    spark.range(40_000).selectExpr("id AS p_partkey", "'A' AS p_type", "'n' AS p_name", "id % 50 + 1 AS p_size").coalesce(1).createOrReplaceTempView("part")
    boxes = reg.split_boxes(spark.sql(fixtures.SQL["chart_boxes"]).withColumn("_id", F.col("chart_id")))
    pairs = reg.near_edges(boxes, reg.region_polygons(spark, relational.MANY_POINTS))
    assert pairs.rdd.getNumPartitions() == 3 and 40_000 < pairs.count() < 40 * boxes.count()


def test_odd_boxes_have_the_regions_of_the_sql(spark, tmp_path):
    """Boxes whose sides are slabs' sides, points of rings, wide, beyond the map, inverted, empty or null."""
    rnd = random.Random(5)
    points = [p for ring in relational.MANY_POINTS.values() for p in ring]
    lngs = [lambda: rnd.choice(points)[1], lambda: rnd.randrange(2**12) * 360 / 2**12 - 180, lambda: rnd.uniform(-200, 200), lambda: rnd.choice([-180.0, 180.0, 170.0, None])]
    lats = [lambda: rnd.choice(points)[0], lambda: rnd.uniform(-95, 95), lambda: rnd.choice([-90.0, 0.0, 90.0, None])]
    width = lambda v: None if v is None else v + rnd.choice([0, 1e-7, 0.1, 1, 5, 45, 360, -1]) * rnd.choice([1, rnd.random()])
    rows = []
    for i in range(3000):
        w, s = (rnd.choices(f, k)[0]() for f, k in ((lngs, (6, 6, 6, 1)), (lats, (6, 6, 1))))
        e, n = (v if rnd.random() > 0.02 else None for v in (width(w), width(s)))
        rows.append((i, f"/a/{30_000 + i % 12_000}.tif", w, n, rnd.choice([e, e, e, w, 180.0]), s))
    spark.createDataFrame(rows, "chart_id long, path string, west double, north double, east double, south double").write.parquet(str(tmp_path / "b"))
    charts = spark.read.parquet(str(tmp_path / "b"))
    got = [tuple(r) for r in reg.assign_regions(charts, reg.region_polygons(spark, relational.MANY_POINTS), reg.region_excludes(spark)).select("chart_id", "region").collect()]
    sql = relational.ORACLE["f3_own_boxes"].removeprefix(fixtures.with_fixtures("chart_boxes"))
    want = duckdb.sql(f"WITH chart_boxes AS (FROM '{tmp_path}/b/*.parquet'){sql}").fetchall()
    assert sorted(got) == sorted(want) and len({i for i, _ in got}) > 900


@pytest.mark.parametrize("query", ["a2", "ply", "dmm", "plain"])
def test_charts_have_files_but_no_folders_of_their_own(spark, tmp_path, monkeypatch, query):
    monkeypatch.setattr(relational, "new_folder", lambda *_: str(tmp_path / "f"))
    d = spark.range(6000).selectExpr("id AS chart_id", "concat('KNP/SC=', id, ',PR=MERCATOR\nPLY/1,', id % 80, '.25,-1.5\nPLY/2,8,1\nPLY/3,8,9\n') AS header")
    rows = (relational.a2 if query == "a2" else relational.a6(query))(d).collect()
    assert len(rows) == 6000 and len(os.listdir(tmp_path / "f")) == headers.FOLDERS
    assert sum(not n.startswith(".") for _, _, names in os.walk(tmp_path / "f") for n in names) == sum(len(names) for _, _, names in os.walk(tmp_path / "f")) == 6000
    if query == "a2":
        assert {(r.chart_id, r.scale, r.n_lines) for r in rows} == {(i, i, 4) for i in range(6000)}
    else:
        assert all(r.n == 4 and r.closed and r.lng1 == 1 for r in rows) and {r.lat0 for r in rows} == {i + 0.25 for i in range(80)}


def test_tile_sets_share_files(spark, tmp_path):
    """No file for each set, zoom and task; the tables are those of before."""
    t = spark.range(240).selectExpr("concat('set ', id % 40) AS tileset", "CAST(id % 3 AS INT) AS z", "id % 2 AS x", "id % 2 AS y", "encode('x', 'UTF-8') AS content").repartition(4)
    about = spark.range(40).selectExpr("concat('set ', id) AS tileset", "'n' AS name", "0 AS min_zoom", "2 AS max_zoom", "'b' AS bounds")
    tables.to_mbtiles_tables(t, about, str(tmp_path))
    assert sum(n.endswith(".parquet") for _, _, names in os.walk(tmp_path / "tiles") for n in names) <= 4
    got = spark.read.parquet(str(tmp_path / "tiles"))
    assert {f"{r.tileset} {r.zoom_level} {r.n}" for r in got.groupBy("tileset", "zoom_level").agg(F.count("*").alias("n")).collect()} == {f"set_{i % 40} {i % 3} 2" for i in range(240)}
    assert spark.read.parquet(str(tmp_path / "metadata")).count() == 40 * 7
