import math
import random

import pytest
from pyspark.sql import functions as F

from tilewright.functions import geo, text
from tilewright.functions import tilemath as tm


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_tiles_match_the_written_out_formula(spark):
    rng = random.Random(1)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180), rng.randrange(0, 19)) for _ in range(500)] + [(90.0, 180.0, 5), (-90.0, -180.0, 5), (0.0, 0.0, 0), (85.05112878, 180.0, 23)]
    df = spark.createDataFrame(points, "lat double, lng double, z int")
    for r in df.select("*", tm.lat_lng_to_tile(F.col("lat"), F.col("lng"), F.col("z")).alias("t")).collect():
        lat, m = max(-85.05112878, min(85.05112878, r.lat)), 256 * 2**r.z
        s = math.sin(math.radians(lat))
        x = min(max((r.lng + 180) / 360 * m + 0.5, 0), m - 1)
        y = min(max((0.5 - math.log((1 + s) / (1 - s)) / (4 * math.pi)) * m + 0.5, 0), m - 1)
        assert (r.t.x, r.t.y) == (int(x) // 256, int(y) // 256)


def test_null_gives_null(spark):
    null = F.lit(None).cast("double")
    r = one(spark, tm.clip(null, 0, 1).alias("a"), tm.ground_resolution(null, 3).alias("b"), tm.lng_to_pixel_x(null, 3).alias("c"), geo.zoom_from_true_scale(null).alias("d"), geo.zoom_for_scale(null, null).alias("e"))
    assert tuple(r) == (None, None, None, None, 0)


def test_flips_are_their_own_inverse(spark):
    r = one(spark, tm.flip_tile_y(tm.flip_tile_y(F.lit(5), 4), 4).alias("t"), tm.flip_pixel_y(tm.flip_pixel_y(F.lit(77), 4), 4).alias("p"))
    assert tuple(r) == (5, 77)


def test_pixel_of_tile_of_pixel(spark):
    r = one(spark, tm.tile_to_pixel(7, 9).alias("p"), tm.pixel_to_tile(7 * 256 + 255, 9 * 256).alias("t"))
    assert tuple(r.p) == (1792, 2304) and tuple(r.t) == (7, 9)


def test_box_over_the_dateline(spark):
    b = one(spark, tm.bounds_to_tile_bounds(179.0, 10.0, -179.0, -10.0, 4).alias("b")).b
    assert b.wraps and b.x_min == 15 and b.x_max == 0 and b.n_x == 2 and b.y_min < b.y_max


def test_zoom_halving(spark):
    def loop(s):
        t, v = 30, s * 0.70
        while v > 1:
            v /= 2
            t -= 1
        return t

    values = [1.0, 1.5, 2.0, 1e3, 80000.0, 1e9, 0.0]
    got = spark.createDataFrame([(v,) for v in values], "s double").select("s", geo.zoom_from_true_scale(F.col("s")).alias("z")).collect()
    assert all(r.z == loop(r.s) for r in got)


def test_geotransform_inverse(spark):
    gt = geo.geotransform(100.0, 2.0, 0.5, 50.0, 0.25, -3.0)
    m = geo.apply_geotransform(gt, 12, 7)
    back = one(spark, geo.apply_geotransform(geo.invert_geotransform(gt), m["x"], m["y"]).alias("p")).p
    assert back.x == pytest.approx(12) and back.y == pytest.approx(7)
    flat = geo.geotransform(0.0, 0.0, 0.0, 0.0, 0.0, 0.0)
    assert one(spark, geo.map_to_pixel(flat, 1.0, 1.0).alias("p")).p.x is None


def test_header(spark):
    head = "!x\nBSB/NA=Bay 'A',NU=1\nKNP/SC=80000,GD=WGS84,PR=MERCATOR\n    PI=0,UN=FEET,SD=X\nCED/SE=1,RE=1,ED=01/15/2020\nREF/1,1,2\nREF/2,1,2\nPLY/1,10,20\nPLY/2,11,20\nPLY/3,bad"
    lines = text.header_lines(F.lit(head))
    r = one(spark, text.header_scale(lines).alias("s"), text.header_name(lines).alias("n"), text.header_units(lines).alias("u"), text.header_updated(lines).alias("d"), text.has_duplicate_refs(lines).alias("dup"), text.header_ring(lines).alias("ring"))
    assert (r.s, r.n, r.u, r.d, r.dup) == (80000, "Bay A", "FEET", "01/15/2020", True)
    assert [tuple(p) for p in r.ring] == [(10.0, 20.0), (11.0, 20.0), (10.0, 20.0)]
    empty = text.header_lines(F.lit(""))
    r = one(spark, text.header_scale(empty).alias("s"), text.header_name(empty).alias("n"), text.header_units(empty).alias("u"), text.header_ring(empty).alias("ring"))
    assert tuple(r) == (None, None, "Unknown", [])


@pytest.mark.parametrize(
    ("name", "want"),
    [("2706-2_W.tif", ("2706", "-", "2")), ("0035A-0.tif", ("35", "A", "0")), ("12-3-4_UD.tif", ("12", "-", "3")), ("77.tif", ("77", "-", "0")), ("77B_W", ("77", "B", "0"))],
)
def test_file_names(spark, name, want):
    assert tuple(one(spark, text.decode_chart_file_name(F.lit(name)).alias("d")).d) == want


@pytest.mark.parametrize(("cell", "want"), [("-28 59.803", -28 - 59.803 / 60), ("048 06.998", 48 + 6.998 / 60), ("-00 30", -0.5)])
def test_degrees(spark, cell, want):
    assert one(spark, text.dmm_to_degrees(F.lit(cell)).alias("d")).d == pytest.approx(want)


def test_chart_sql_has_one_line_end(spark):
    line = one(spark, text.format_chart_sql(F.lit("REGION_15"), F.lit("/foo/bar/18476_1.KAP"), F.lit("O'Hare\n"), F.lit("d"), F.lit(10000), F.lit("o\n"), F.lit("FEET\r\n"), F.lit("1\n")).alias("s")).s
    assert line.count("\n") == 1 and line.endswith(";\n") and "'18476_1.KAP'" in line and "O''Hare" in line


def test_names(spark):
    r = one(spark, text.sanitize_file_name(F.lit("a b & c.d,e.tif")).alias("a"), text.tileset_name(F.lit("My Chart-1")).alias("b"), text.edition_date(F.lit(43845)).alias("c"), F.hex(text.uint_be(258, 4)).alias("d"), text.unpublish_name(F.lit("TS_2020-01-01_T_00_00_REGION_02.gemf")).alias("e"))
    assert tuple(r) == ("a_b_And_cde.tif", "my_chart_1", "1/15/2020", "00000102", "REGION_02.gemf")


def test_a_zoom_computes_scale_and_latitude_once(spark):
    """They may be whole parsers of headers, and were in the loop over the powers of two."""
    rows = spark.createDataFrame([(40000.0, 10.0), (-1.0, 60.0), (None, 1.0)], "s double, a double")
    zooms = rows.select(geo.zoom_for_scale(F.abs("s"), F.abs("a")).alias("z"))
    plan = zooms._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("abs(a") == 1 and plan.count("abs(s") <= 2
    assert [r.z for r in zooms.collect()] == [15, 29, 0]


def test_numbers_of_more_bytes_keep_the_last(spark):
    r = one(spark, *(F.hex(text.uint_be(F.lit(v), n)) for v, n in ((0x1_2345_6789, 4), (-2, 4), (258, 4), (258, 9))))
    assert tuple(r) == ("23456789", "FFFFFFFE", "00000102", "000000000000000102")
