"""Registered queries of the scalar functions: each runs one over a whole fixture, beside the formula as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixtures import fixture, with_fixtures
from ..functions import geo, text
from ..functions import tilemath as tm

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
c = F.col


def r6(x: Column) -> Column:
    return F.round(x, 6)


def add(name: str, source: str, key: str, columns: Callable[[], dict[str, Column]], sql: dict[str, str], before: Callable[[DataFrame], DataFrame] = lambda d: d, source_sql: str | None = None) -> None:
    """columns: name -> Column over the fixture, which `before` may prepare; sql: the same names in SQL over it (or over source_sql)."""

    def query(spark, sf_dir: str) -> DataFrame:
        return before(fixture(spark, sf_dir, source)).select(key, *(v.alias(k) for k, v in columns().items()))

    query.__name__ = name
    QUERIES[name] = query
    ORACLE[name] = f"{with_fixtures(source)}\nSELECT {key}, {', '.join(f'{v} AS {k}' for k, v in sql.items())} FROM {source_sql or source}"


# ---- the tile system: SQL pieces over (lat, lng, z)
LAT = "least(greatest({lat}, -85.05112878), 85.05112878)"
M = "(256 * pow(2.0, z))"
PX = "CAST(floor(least(greatest((least(greatest({lng}, -180.0), 180.0) + 180.0) / 360.0 * {m} + 0.5, 0.0), {m} - 1)) AS BIGINT)"
PY = "CAST(floor(least(greatest((0.5 - ln((1.0 + sin({lat} * (pi() / 180))) / (1.0 - sin({lat} * (pi() / 180)))) / (4 * pi())) * {m} + 0.5, 0.0), {m} - 1)) AS BIGINT)"


def px(lng: str = "lng", m: str = M) -> str:
    return PX.format(lng=lng, m=m)


def py(lat: str = "lat", m: str = M) -> str:
    return PY.format(lat=LAT.format(lat=lat), m=m)


RES = f"(cos({LAT.format(lat='lat')} * (pi() / 180)) * (2 * pi() * 6378137.0) / {M})"
EQ = f"(2 * pi() * 6378137.0 / {M})"
P, Z = "geo_points", "point_id"

add("b1_clip", P, Z, lambda: {"clipped": tm.clip(c("lat"), -30, 40)}, {"clipped": "CASE WHEN lat < -30 THEN -30 WHEN lat > 40 THEN 40 ELSE lat END"})
add("b2_map_size", P, Z, lambda: {"pixels": tm.map_size(c("z")), "tiles": tm.map_size_tiles(c("z"))}, {"pixels": M, "tiles": "CAST(1 AS BIGINT) << z"})
add("b3_ground_resolution", P, Z, lambda: {"resolution": r6(tm.ground_resolution(c("lat"), c("z")))}, {"resolution": f"round({RES}, 6)"})
add("b4_map_scale", P, Z, lambda: {"map_scale": F.round(tm.map_scale(c("lat"), c("z"), 96), 4)}, {"map_scale": f"round({RES} * 96 / 0.0254, 4)"})
add("b5_lat_lng_to_pixel", P, Z, lambda: {"px": tm.lat_lng_to_pixel(c("lat"), c("lng"), c("z"))["x"], "py": tm.lat_lng_to_pixel(c("lat"), c("lng"), c("z"))["y"]}, {"px": px(), "py": py()})
add("b6_lat_lng_to_tile", P, Z, lambda: {"x": tm.lat_lng_to_tile(c("lat"), c("lng"), c("z"))["x"], "y": tm.lat_lng_to_tile(c("lat"), c("lng"), c("z"))["y"]}, {"x": f"{px()} // 256", "y": f"{py()} // 256"})
PIX = f"(SELECT *, (point_id * 7919) % CAST({M} AS BIGINT) AS px, (point_id * 104729) % CAST({M} AS BIGINT) AS py FROM geo_points)"


def with_pixels(d: DataFrame) -> DataFrame:
    return d.withColumn("px", F.pmod(c("point_id") * 7919, tm.map_size(c("z")).cast("long"))).withColumn("py", F.pmod(c("point_id") * 104729, tm.map_size(c("z")).cast("long")))


add(
    "b7_pixel_to_lat_lng", P, Z, lambda: {"lat": r6(tm.pixel_to_lat_lng(c("px"), c("py"), c("z"))["lat"]), "lng": r6(tm.pixel_to_lat_lng(c("px"), c("py"), c("z"))["lng"])},
    {"lat": f"round(90.0 - 360.0 * atan(exp((0.5 - py / {M}) * (-2 * pi()))) / pi(), 6)", "lng": f"round((px / {M} - 0.5) * 360.0, 6)"}, with_pixels, PIX,
)
add(
    "b8_pixel_tile", P, Z, lambda: {"x": tm.pixel_to_tile(c("px"), c("py"))["x"], "y": tm.pixel_to_tile(c("px"), c("py"))["y"], "px0": tm.tile_to_pixel(c("px"), c("py"))["x"], "py0": tm.tile_to_pixel(c("px"), c("py"))["y"]},
    {"x": "px // 256", "y": "py // 256", "px0": "px * 256", "py0": "py * 256"}, with_pixels, PIX,
)
add(
    "b9_zoom_for_pixel_size", P, Z, lambda: {"zoom": tm.zoom_for_pixel_size(c("lat"), c("true_scale") / 100)},
    {"zoom": "list_filter(range(0, 23), lambda k: true_scale / 100 > cos(lat * (pi() / 180)) * (2 * pi() * 6378137.0) / (256 * pow(2.0, k)))[1]::INT"},
)
add("b10_pixels_to_meters", P, Z, lambda: {"mx": F.round(tm.pixels_to_meters(c("px"), c("py"), c("z"))["x"], 4), "my": F.round(tm.pixels_to_meters(c("px"), c("py"), c("z"))["y"], 4)},
    {"mx": f"round(px * {EQ} - pi() * 6378137.0, 4)", "my": f"round(py * {EQ} - pi() * 6378137.0, 4)"}, with_pixels, PIX)
MET = "(SELECT *, CAST((point_id * 104729) % 40000000 AS DOUBLE) - 20000000 AS mx, CAST((point_id * 7919) % 40000000 AS DOUBLE) - 20000000 AS my FROM geo_points)"
MPX, MPY = f"CAST(trunc((mx + pi() * 6378137.0) / {EQ}) AS BIGINT)", f"(CAST({M} AS BIGINT) - CAST(trunc((my + pi() * 6378137.0) / {EQ}) AS BIGINT) - 1)"
add(
    "b11_meters", P, Z,
    lambda: {
        "px": tm.meters_to_pixel(c("mx"), c("my"), c("z"))["x"], "py": tm.meters_to_pixel(c("mx"), c("my"), c("z"))["y"], "x": tm.meters_to_tile(c("mx"), c("my"), c("z"))["x"],
        "y": tm.meters_to_tile(c("mx"), c("my"), c("z"))["y"], "lat": r6(tm.meters_to_lat_lng(c("mx"), c("my"))["lat"]), "lng": r6(tm.meters_to_lat_lng(c("mx"), c("my"))["lng"]),
    },
    {"px": MPX, "py": MPY, "x": f"{MPX} // 256", "y": f"CAST(floor({MPY} / 256.0) AS BIGINT)", "lat": "round((2 * atan(exp(my / 6378137.0)) - pi() / 2) * 180 / pi(), 6)", "lng": "round(mx / (pi() * 6378137.0) * 180, 6)"},
    lambda d: d.withColumn("mx", ((c("point_id") * 104729) % 40000000).cast("double") - 20000000).withColumn("my", ((c("point_id") * 7919) % 40000000).cast("double") - 20000000), MET,
)
add(
    "b12_flip_y", P, Z, lambda: {"pixel_row": tm.flip_pixel_y(c("py"), c("z")), "tile_row": tm.flip_tile_y(F.floor(c("py") / 256).cast("long"), c("z"))},
    {"pixel_row": f"CAST({M} AS BIGINT) - py - 1", "tile_row": "(CAST(1 AS BIGINT) << z) - 1 - py // 256"}, with_pixels, PIX,
)

# ---- boxes
M9 = "(256 * pow(2.0, 9))"
BOX = f"(SELECT *, {px('west', M9)} AS x1, {px('east', M9)} AS x2, {py('north', M9)} AS y1, {py('south', M9)} AS y2 FROM chart_boxes)"
box = lambda f: f(c("west"), c("north"), c("east"), c("south"), 9)
PARTS = ("x_min", "x_max", "y_min", "y_max", "n_x", "n_y", "wraps")
add("b13_pixel_bounds", "chart_boxes", "chart_id", lambda: {p: box(tm.bounds_to_pixel_bounds)[p] for p in PARTS},
    {"x_min": "x1", "x_max": "x2", "y_min": "y1", "y_max": "y2", "n_x": "CASE WHEN x1 > x2 THEN 131072 - x1 + x2 + 1 ELSE x2 - x1 + 1 END", "n_y": "y2 - y1 + 1", "wraps": "x1 > x2"}, source_sql=BOX)
add("b14_tile_bounds", "chart_boxes", "chart_id", lambda: {p: box(tm.bounds_to_tile_bounds)[p] for p in PARTS},
    {"x_min": "x1 // 256", "x_max": "x2 // 256", "y_min": "y1 // 256", "y_max": "y2 // 256", "n_x": "CASE WHEN x1 // 256 > x2 // 256 THEN 512 - x1 // 256 + x2 // 256 + 1 ELSE x2 // 256 - x1 // 256 + 1 END",
     "n_y": "y2 // 256 - y1 // 256 + 1", "wraps": "x1 // 256 > x2 // 256"}, source_sql=BOX)

# ---- distances and zooms
HAV = "(2 * 6371 * 1000 * atan2(sqrt({a}), sqrt(1 - {a})))"
DEG = HAV.format(a="(pow(cos(radians(lat)), 2) * pow(sin(radians(1.0) / 2), 2))")
A1 = "(pow(sin(radians(10 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(10)) * pow(sin(radians(20 - lng) / 2), 2))"
MY = "(ln(tan(({lat} + 90.0) * (pi() / 360))) * 6378137.0)"
add("c1_haversine", P, Z, lambda: {"meters": F.round(geo.haversine(c("lng"), c("lat"), F.lit(20.0), F.lit(10.0)), 4)}, {"meters": f"round({HAV.format(a=A1)}, 4)"})
add("c2_mercator_distance", P, Z, lambda: {"meters": F.round(geo.mercator_distance(c("lng"), c("lat"), F.lit(20.0), F.lit(10.0)), 4)},
    {"meters": f"round(sqrt(pow((lng - 20) * pi() * 6378137.0 / 180, 2) + pow({MY.format(lat='lat')} - {MY.format(lat='10')}, 2)), 4)"})
add("c3_latitude_distortion", P, Z, lambda: {"factor": r6(geo.latitude_distortion(c("lat")))}, {"factor": f"round(6378137.0 * pi() / 180 / {DEG}, 6)"})
ZOOM = "30 - len(list_filter(range(0, 63), lambda k: {s} * 0.70 > pow(2.0, k)))"
add("c4_zoom_from_true_scale", P, Z, lambda: {"zoom": geo.zoom_from_true_scale(c("true_scale")).cast("long")}, {"zoom": ZOOM.format(s="true_scale")})
add("c5_zoom_for_scale", P, Z, lambda: {"zoom": geo.zoom_for_scale(F.when(c("point_id") % 7 != 0, c("true_scale")), c("lat")).cast("long")},
    {"zoom": f"CASE WHEN point_id % 7 = 0 THEN 0 ELSE {ZOOM.format(s=f'(true_scale * (6378137.0 * pi() / 180 / {DEG}))')} END"})

# ---- rasters
R, RID = "raster_meta", "chart_id"
gt = lambda: geo.geotransform(*(c(f"gt{i}") for i in range(6)))
tilted = lambda: geo.geotransform(c("gt0"), c("gt1"), c("gt1") / 4, c("gt3"), c("gt1") / 8, c("gt5"))
DET = "(gt1 * gt5 - gt1 / 4 * (gt1 / 8))"
IX = f"CAST(trunc((gt1 / 4 * gt3 - gt0 * gt5) / {DET} + mx * (gt5 / {DET}) + my * (-(gt1 / 4) / {DET})) AS BIGINT)"
IY = f"CAST(trunc((gt0 * (gt1 / 8) - gt1 * gt3) / {DET} + mx * (-(gt1 / 8) / {DET}) + my * (gt1 / {DET})) AS BIGINT)"
add(
    "c6_geotransform", R, RID,
    lambda: {
        "map_x": r6(geo.apply_geotransform(tilted(), c("xsize"), c("ysize"))["x"]), "map_y": r6(geo.apply_geotransform(tilted(), c("xsize"), c("ysize"))["y"]),
        "px": geo.map_to_pixel(gt(), c("gt0") + 1000, c("gt3") - 777)["x"], "py": geo.map_to_pixel(gt(), c("gt0") + 1000, c("gt3") - 777)["y"],
        "tilted_px": geo.map_to_pixel(tilted(), c("gt0") + 1000, c("gt3") - 777)["x"], "tilted_py": geo.map_to_pixel(tilted(), c("gt0") + 1000, c("gt3") - 777)["y"],
    },
    {
        "map_x": "round(gt0 + xsize * gt1 + ysize * (gt1 / 4), 6)", "map_y": "round(gt3 + xsize * (gt1 / 8) + ysize * gt5, 6)", "px": "CAST(trunc((mx - gt0) / gt1) AS BIGINT)", "py": "CAST(trunc((my - gt3) / gt5) AS BIGINT)",
        "tilted_px": IX, "tilted_py": IY,
    },
    source_sql="(SELECT *, gt0 + 1000 AS mx, gt3 - 777 AS my FROM raster_meta)",
)
ROT = "(degrees(({t})) % 360 + 360) % 360"
add("c7_rotation", R, RID, lambda: {"plain": r6(geo.rotation(gt())), "north_up": geo.is_north_up(gt()), "tilted": r6(geo.rotation(tilted())), "tilted_north_up": geo.is_north_up(tilted())},
    {"plain": "0.0::DOUBLE", "north_up": "true", "tilted": f"round({ROT.format(t='(exp(2 * (gt1 / 4 / gt5)) - 1) / (exp(2 * (gt1 / 4 / gt5)) + 1)')}, 6)", "tilted_north_up": "false"})
LATM = "((2 * atan(exp({y} / 6378137.0)) - pi() / 2) * 180 / pi())"
bounds = lambda to: geo.raster_bounds(gt(), c("xsize"), c("ysize"), to)
add("c8_raster_bounds", R, RID, lambda: {s: r6(bounds("degrees")[s]) for s in ("west", "north", "east", "south")} | {f"{s}_m": r6(bounds("meters")[s]) for s in ("west", "north", "east", "south")},
    {"west": "round(gt0 / (pi() * 6378137.0) * 180, 6)", "north": f"round({LATM.format(y='gt3')}, 6)", "east": "round((gt0 + xsize * gt1) / (pi() * 6378137.0) * 180, 6)", "south": f"round({LATM.format(y='(gt3 - ysize * gt1)')}, 6)",
     "west_m": "gt0", "north_m": "gt3", "east_m": "gt0 + xsize * gt1", "south_m": "gt3 - ysize * gt1"})
add("c9_true_scale", R, RID, lambda: {"plain": r6(geo.true_scale(c("gt0"), c("gt0") + c("xsize") * c("gt1"), c("xsize"), c("dpi"))), "wrapped": r6(geo.true_scale(F.lit(2e7), c("gt1") - 2e7, c("xsize"), c("dpi")))},
    {"plain": "round((xsize * gt1) / (xsize / dpi / 39.3701), 6)", "wrapped": "round(((20037508.3428 - abs(gt1 - 2e7)) + (20037508.3428 - 2e7)) / (xsize / dpi / 39.3701), 6)"})
CORNERS = (("north", "west"), ("north", "east"), ("south", "east"), ("south", "west"), ("north", "west"))


def _parsed(i: int, part: str) -> Column:
    return F.get(text.parse_outline(geo.bounds_to_cutline(c("west"), c("north"), c("east"), c("south"))), F.lit(i))[part]


add("c10_bounds_to_cutline", "chart_boxes", "chart_id", lambda: {f"{p}{i}": _parsed(i, p) for i in range(5) for p in ("lat", "lng")}, {f"{p}{i}": CORNERS[i][k] for i in range(5) for k, p in enumerate(("lat", "lng"))})
OUT = "concat(CAST(chart_id % 60 AS STRING), '.25,', CAST(chart_id % 170 AS STRING), '.5:', CAST(chart_id % 60 + 1 AS STRING), '.5,-', CAST(chart_id % 99 AS STRING), '.75')"
PXY = "CAST(CAST(trunc(({x} - gt0) / gt1) AS BIGINT) AS VARCHAR) || ' ' || CAST(CAST(trunc(({y} - gt3) / gt5) AS BIGINT) AS VARCHAR)"
LNX = "(({g}) * (pi() * 6378137.0 / 180))"
FIRST = PXY.format(x=LNX.format(g="chart_id % 170 + 0.5"), y=MY.format(lat="(chart_id % 60 + 0.25)"))
SECOND = PXY.format(x=LNX.format(g="-(chart_id % 99 + 0.75)"), y=MY.format(lat="(chart_id % 60 + 1.5)"))
add("c11_cutline_polygon", R, RID, lambda: {"polygon": geo.cutline_to_pixel_polygon(F.expr(OUT), gt())}, {"polygon": f"'POLYGON ((' || {FIRST} || ',' || {SECOND} || '))'"})

# ---- headers
H, HID = "chart_headers", "chart_id"
with_lines = lambda d: d.withColumn("lines", text.header_lines(c("header")))
PLY = "CAST(regexp_extract(header, 'PLY/{i},([^,]*),', 1) AS DOUBLE)", "CAST(regexp_extract(header, 'PLY/{i},[^,]*,([^\\n]*)', 1) AS DOUBLE)"
LATS, LNGS = ([PLY[k].format(i=i) for i in (1, 2, 3)] for k in (0, 1))
ring = lambda: text.header_ring(c("lines"))
add("c12_ring_center", H, HID, lambda: {"lng": geo.ring_center(ring())["lng"], "lat": geo.ring_center(ring())["lat"]},
    {"lng": f"(least({', '.join(LNGS)}) + greatest({', '.join(LNGS)})) / 2", "lat": f"(least({', '.join(LATS)}) + greatest({', '.join(LATS)})) / 2"}, with_lines)
add("c13_crosses_dateline", H, HID, lambda: {"crosses": geo.crosses_dateline(ring())}, {"crosses": f"least({', '.join(LNGS)}) < 0 AND greatest({', '.join(LNGS)}) > 0"}, with_lines)

WINDOW = ("x0", "y0", "x1", "y1", "width", "height", "x_off", "y_off", "scaling_up")
TX = "(CAST(trunc((gt0 + pi() * 6378137.0) / (2 * pi() * 6378137.0 / (256 * pow(2.0, 11)))) AS BIGINT) // 256)"
TY = "((524288 - CAST(trunc((gt3 + pi() * 6378137.0) / (2 * pi() * 6378137.0 / (256 * pow(2.0, 11)))) AS BIGINT) - 1) // 256)"
LNG11, LAT11 = "(({x} * 256) / 524288.0 - 0.5) * 360.0", "(90.0 - 360.0 * atan(exp((0.5 - ({y} * 256) / 524288.0) * (-2 * pi()))) / pi())"
CX, CY = f"CAST(trunc((({LNG11}) * (pi() * 6378137.0 / 180) - gt0) / gt1) AS BIGINT)", f"CAST(trunc(({MY.format(lat=LAT11)} - gt3) / gt5) AS BIGINT)"


def with_window(d: DataFrame) -> DataFrame:
    d = d.withColumn("tile", tm.meters_to_tile(c("gt0"), c("gt3"), 11))
    return d.withColumn("w", geo.tile_raster_window(11, c("tile.x"), c("tile.y"), gt(), c("xsize"), c("ysize")))


add("c14_tile_raster_window", R, RID, lambda: {p: c(f"w.{p}") for p in WINDOW},
    {p: f"CASE WHEN width > 0 AND height > 0 THEN {p} END" for p in WINDOW[:6]} | {"x_off": "CASE WHEN width > 0 AND height > 0 THEN greatest(x0, 0) - x0 END", "y_off": "CASE WHEN width > 0 AND height > 0 THEN greatest(y0, 0) - y0 END",
     "scaling_up": "CASE WHEN width > 0 AND height > 0 THEN x1 - x0 < 256 OR y1 - y0 < 256 END"}, before=with_window,
    source_sql=f"(SELECT *, least(x1, xsize) - greatest(x0, 0) AS width, least(y1, ysize) - greatest(y0, 0) AS height FROM (SELECT *, {CX.format(x=TX)} AS x0, {CY.format(y=TY)} AS y0, {CX.format(x=f'({TX} + 1)')} AS x1, {CY.format(y=f'({TY} + 1)')} AS y1 FROM raster_meta))")

line = lambda x: f"regexp_extract(header, '{x}', 1)"
add("d1_header_fields", H, HID, lambda: {"scale": text.header_scale(c("lines")), "projection": text.header_projection(c("lines")), "datum": text.header_datum(c("lines"))},
    {"scale": f"CAST({line('KNP/SC=([0-9]+)')} AS INT)", "projection": line("PR=([^,\\n]*)"), "datum": line("GD=([^,\\n]*)")}, with_lines)
add("d2_header_units", H, HID, lambda: {"units": text.header_units(c("lines"))}, {"units": f"CASE WHEN contains(header, 'UN=') THEN {line('UN=([^,]*),')} ELSE 'Unknown' END"}, with_lines)
add("d3_header_updated", H, HID, lambda: {"updated": text.header_updated(c("lines"))}, {"updated": f"trim({line('ED=([^\\n]{1,11})')})"}, with_lines)
add("d4_header_name", H, HID, lambda: {"name": text.header_name(c("lines"))}, {"name": f"trim(replace({line('BSB/NA=([^,]*),')}, '''', ''))"}, with_lines)
add("d5_header_refs", H, HID, lambda: {"first_ref": F.get(text.header_refs(c("lines")), F.lit(0)), "n": F.size(text.header_refs(c("lines"))).cast("long"), "dup": text.has_duplicate_refs(c("lines"))},
    {"first_ref": line("REF/1,([^\\n]*)"), "n": "CAST(2 AS BIGINT)", "dup": f"{line('REF/1,([^\\n]*)')} = {line('REF/2,([^\\n]*)')}"}, with_lines)
add("d6_header_ring", H, HID, lambda: {"n": F.size(ring()).cast("long")} | {f"{p}{i}": F.get(ring(), F.lit(i))[p] for i in range(4) for p in ("lat", "lng")},
    {"n": "CAST(4 AS BIGINT)"} | {f"lat{i}": LATS[i % 3] for i in range(4)} | {f"lng{i}": LNGS[i % 3] for i in range(4)}, with_lines)
add("d7_format_outline", H, HID, lambda: {"n": F.size(text.parse_outline(text.format_outline(ring()))).cast("long"), "lat1": F.get(text.parse_outline(text.format_outline(ring())), F.lit(1))["lat"], "lng2": F.get(text.parse_outline(text.format_outline(ring())), F.lit(2))["lng"]},
    {"n": "CAST(4 AS BIGINT)", "lat1": LATS[1], "lng2": LNGS[2]}, with_lines)

# ---- names
FI, FID = "chart_files", "file_id"
BASE = "regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\\.[^.]*$', '')"
decoded = lambda: text.decode_chart_file_name(c("path"))
SUFFIX = f"CASE WHEN regexp_extract({BASE}, '^[0-9]*([^-]*)-', 1) = '' THEN '-' ELSE regexp_extract({BASE}, '^[0-9]*([^-]*)-', 1) END"
add("d8_decode_file_name", FI, FID, lambda: {"number": decoded()["number"], "suffix": decoded()["suffix"], "panel": decoded()["panel"], "stamp": text.file_stamp(c("path"))},
    {"number": f"ltrim(regexp_extract({BASE}, '^([0-9]*)', 1), '0')", "suffix": SUFFIX, "panel": f"regexp_extract({BASE}, '-([^_-]*)', 1)",
     "stamp": f"ltrim(regexp_extract({BASE}, '^([0-9]*)', 1), '0') || '_' || {SUFFIX} || '_' || regexp_extract({BASE}, '-([^_-]*)', 1)"})
NAME = "replace(replace(replace(path, '/', '.x'), ' ', '_'), '&', 'And')"
add("d9_sanitize_file_name", FI, FID, lambda: {"clean": text.sanitize_file_name(F.replace(c("path"), F.lit("/"), F.lit(".x")))},
    {"clean": f"regexp_replace(regexp_extract({NAME}, '^(.*)\\.[^.]*$', 1), '[^_a-zA-Z0-9]', '', 'g') || '.' || regexp_replace(regexp_extract({NAME}, '\\.([^.]*)$', 1), '[^_a-zA-Z0-9]', '', 'g')"})
V, VID = "sheet_vertices", "row_no"
DEGREE = "CASE WHEN regexp_extract({x}, '^(.*)[0-9]{{2}}\\.', 1) IN ('', '-') THEN regexp_extract({x}, '^(.*)[0-9]{{2}}\\.', 1) || '0' ELSE regexp_extract({x}, '^(.*)[0-9]{{2}}\\.', 1) END"
MINUTE = "regexp_extract({x}, '([0-9]{{2}}\\..*)$', 1)"
cell = lambda x: f"({DEGREE.format(x=x)} || ' ' || {MINUTE.format(x=x)})"
DD = "round(CAST({d} AS DOUBLE) + CASE WHEN {x} LIKE '-%' THEN -1 ELSE 1 END * CAST({m} AS DOUBLE) / 60, 6)"
add("d10_dmm_to_degrees", V, VID, lambda: {"lat": r6(text.dmm_to_degrees(text.split_dmm_cell(c("lat_cell")))), "lng": r6(text.dmm_to_degrees(text.split_dmm_cell(c("lng_cell"))))},
    {k: DD.format(d=f"({DEGREE.format(x=f'{k}_cell')})", m=MINUTE.format(x=f"{k}_cell"), x=f"{k}_cell") for k in ("lat", "lng")})
add("d11_split_dmm_cell", V, VID, lambda: {"lat_dmm": text.split_dmm_cell(c("lat_cell")), "lng_dmm": text.split_dmm_cell(c("lng_cell"))}, {"lat_dmm": cell("lat_cell"), "lng_dmm": cell("lng_cell")})
AF, AID = "archive_files", "id"
add("d12_name_and_number", AF, AID, lambda: {"name": text.name_and_number(c("numbered_file"))["name"], "number": text.name_and_number(c("numbered_file"))["number"]},
    {"name": "regexp_replace(numbered_file, '[0-9]', '', 'g')", "number": "CAST(regexp_replace(numbered_file, '[^0-9]', '', 'g') AS BIGINT)"})
add("d13_tileset_name", FI, FID, lambda: {"tileset": text.tileset_name(c("path"))}, {"tileset": "lower(regexp_replace(path, '\\W+', '_', 'g'))"})
add("d14_publish_name", AF, AID, lambda: {"stamp": text.publish_stamp(c("epoch")), "published": text.publish_name(c("epoch"), c("file"))},
    {k: f"strftime(make_timestamp(epoch * 1000000), 'TS_%Y-%m-%d_T_%H_%M'){rest}" for k, rest in (("stamp", ""), ("published", " || '_' || file"))})
add("d15_region_from_file", AF, AID, lambda: {"region": text.region_from_file(c("file")), "unpublished": text.unpublish_name(c("file"))},
    {"region": "regexp_extract(file, '(REGION[^.]*)', 1)", "unpublished": "regexp_extract(file, '(REGION.*)', 1)"})
chart_sql = lambda: text.format_chart_sql(F.lit("REGION_02"), c("path"), c("name"), F.lit(" 01/15/2020\n"), F.coalesce(c("scale").cast("string"), F.lit("0")), F.lit("1,2:3,4"), F.lit("FEET\r\n"), F.lit("12\n"))
add("d16_chart_sql", "chart_boxes", "chart_id", lambda: {"line": chart_sql(), "upd": text.region_update_sql(F.lit("REGION_02"), c("chart_id")), "clr": text.region_clear_sql(F.lit("REGION_02")), "custom": text.custom_region_sql(F.lit("MY_AREA"), c("name"), c("chart_id"), F.lit(7))},
    {"line": "'INSERT INTO [charts] ([region], [file], [name], [updated], [scale], [outline], [depths], [zoom]) VALUES (''REGION_02'', ''' || regexp_extract(path, '([^/]*)$', 1) || ''', ''' || replace(name, '''', '''''') || ''', ''01/15/2020'', ' || coalesce(CAST(scale AS VARCHAR), '0') || ', ''1,2:3,4'', ''FEET'', ''12'');' || chr(10)",
     "upd": "'UPDATE regions SET installeddate=''' || chart_id || ''' WHERE name=''REGION_02'';' || chr(10)", "clr": "'DELETE from charts where region=''REGION_02'';' || chr(10)",
     "custom": "'DELETE from regions WHERE name=''MY_AREA'';' || chr(10) || 'INSERT into [regions] ([name], [description], [image], [size], [installeddate] ) VALUES (''MY_AREA'', ''' || name || ''', ''myarea'', ''' || chart_id || ''', ''7'');' || chr(10)"})
script = lambda: F.when(c("id") % 2 == 0, F.array(F.lit("--version"), text.region_update_sql(text.region_from_file(c("file")), c("epoch")))).otherwise(F.array(F.lit("--version"), F.lit("DELETE from regions WHERE name='X';")))
add("d17_installed_epoch", AF, AID, lambda: {"installed": text.installed_epoch(script())}, {"installed": "CASE WHEN id % 2 = 0 THEN CAST(epoch AS VARCHAR) END"})
add("d18_checksum", AF, AID, lambda: {"sha1": text.checksum(c("content")), "size": F.octet_length(c("content")).cast("long")}, {"sha1": "sha1(content)", "size": "CAST(strlen(content) AS BIGINT)"})
add("d19_uint_be", AF, AID, lambda: {"u4": F.hex(text.uint_be(c("epoch"), 4)), "u8": F.hex(text.uint_be(c("epoch") * 1000, 8))}, {"u4": "printf('%08X', epoch & 4294967295)", "u8": "printf('%016X', epoch * 1000)"})
add("d20_tilejson", "chart_boxes", "chart_id", lambda: {"bounds_west": F.get(F.split(F.get_json_object(text.tilejson(c("name"), F.lit(3), F.lit(9), c("west"), c("south"), c("east"), c("north")), "$.bounds"), ","), F.lit(0)).cast("double"),
                                                        "max_zoom": F.get_json_object(text.tilejson(c("name"), F.lit(3), F.lit(9), c("west"), c("south"), c("east"), c("north")), "$.maxzoom")}, {"bounds_west": "west", "max_zoom": "'9'"})
add("d21_clean_title", "sheet_charts", "row_no", lambda: {"clean": text.clean_title(c("title")), "label": text.depth_label(F.concat(c("suffix"), F.lit("/feet ")))},
    {"clean": "replace(regexp_replace(title, '\\s+', ' ', 'g'), '''', '')", "label": "trim(replace(upper(suffix || '/feet '), '/', ' AND '))"})
add("d22_edition_date", "sheet_editions", "row_no", lambda: {"edition": text.edition_date(c("serial"))}, {"edition": "strftime(DATE '1899-12-30' + CAST(serial AS INT), '%-m/%-d/%Y')"})
add("d24_parse_burn_name", "burn_names", "id", lambda: {k: text.parse_burn_name(c("file"))[k] for k in ("chart", "crest", "score", "x_off", "y_off")},
    {"chart": "split_part(file, ':', 1)", "crest": "split_part(file, ':', 2)", "score": "CAST(split_part(file, ':', 3) AS INT)", "x_off": "CAST(split_part(file, ':', 4) AS INT)", "y_off": "CAST(replace(split_part(file, ':', 5), '.png', '') AS INT)"})
add("d25_chart_base_name", FI, FID, lambda: {"base": text.chart_base_name(c("path"))}, {"base": BASE})
