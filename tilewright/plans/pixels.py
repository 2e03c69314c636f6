"""Registered queries of the raster operators over tiles of four by four pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import fixture, with_fixtures
from ..operators import cells as ce
from ..operators import raster as ra
from ..operators.steps import cut
from ..sources.tile_tables import laid_out
from .jobs import compile_region

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
c = F.col
HEXED = "array_to_string(list_transform({px}, lambda v: printf('%02X', CAST(v AS INT))), '')"
TP = with_fixtures("tile_pixels")
ALPHA = "list_filter(px, lambda v, i: i % 4 = 0)"
CLASS = f"CASE WHEN list_min({ALPHA}) = 255 THEN 1 WHEN list_max({ALPHA}) = 0 THEN 0 ELSE -1 END"


def add(name: str, build, sql: str | None) -> None:
    def query(spark, sf_dir: str) -> DataFrame:
        return build(fixture(spark, sf_dir, "tile_pixels"))

    query.__name__ = name
    QUERIES[name] = query
    if sql:
        ORACLE[name] = TP + sql


def layers(d: DataFrame) -> DataFrame:
    return d.select("chart_id", c("z").cast("int").alias("z"), c("x").cast("long").alias("x"), c("y").cast("long").alias("y"), ra.transparency_class_of_array(c("px")).alias("transp"), ra.to_bytes(c("px")).alias("content"))


add("k1_transparency_class", lambda d: d.select("chart_id", ra.transparency_class_of_array(c("px")).alias("from_array"), ra.transparency_class(ra.to_bytes(c("px"))).alias("from_bytes"), ra.has_any_byte(ra.to_bytes(c("px"))).alias("any_byte")),
    f" SELECT chart_id, CAST({CLASS} AS INT) AS from_array, CAST({CLASS} AS INT) AS from_bytes, list_max(px) > 0 AS any_byte FROM tile_pixels")
T = "(s[i] * s[(i - 1) // 4 * 4 + 4] + d[i] * (255 - s[(i - 1) // 4 * 4 + 4]) + 128)"
MERGED = f""", l AS (SELECT *, {CLASS} AS transp FROM tile_pixels), v AS (SELECT z, x, y, list(px ORDER BY chart_id) AS ls FROM l WHERE transp <> 0 GROUP BY 1, 2, 3),
    m AS (SELECT z, x, y, list_reduce(ls, lambda d, s: list_transform(range(1, 65), lambda i: CASE WHEN list_min(list_filter(s, lambda q, j: j % 4 = 0)) = 255 THEN s[i] ELSE CAST(({T} + ({T} >> 8)) >> 8 AS INT) END)) AS px FROM v)"""
OUT = f"{MERGED} SELECT CAST(z AS INT) AS z, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, {HEXED.format(px='px')} AS pixels FROM m"
hexed = lambda d: d.select("z", "x", "y", F.hex("content").alias("pixels"))
rank = lambda d: d.select("chart_id", c("chart_id").alias("rank")).distinct()
add("k2_composite_tiles", lambda d: hexed(ra.composite_tiles(layers(d).filter("transp <> 0").withColumn("rank", c("chart_id")))), OUT)
add("k3_merge_region", lambda d: hexed(ra.merge_region(rank(d), layers(d))), OUT)


add("k4_overview_level", lambda d: hexed(ra.overview_level(ra.merge_region(rank(d), layers(d)))), "")


def up(source: str) -> str:
    """Tiles one zoom lower: means of two by two pixels of the children, colours weighted by alpha, all in whole numbers."""
    kid = "(CASE ((i // 4) % 4) // 2 * 2 + i // 32 WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 ELSE p3 END)"
    at = lambda r, c_, ch: f"coalesce({kid}[((i // 16) % 2 * 2 + {r}) * 16 + ((i // 4) % 2 * 2 + {c_}) * 4 + {ch} + 1], 0)"
    four = [(r, c_) for r in (0, 1) for c_ in (0, 1)]
    alpha = "(" + " + ".join(at(r, c_, 3) for r, c_ in four) + ")"
    colour = "(" + " + ".join(f"{at(r, c_, '(i % 4)')} * {at(r, c_, 3)}" for r, c_ in four) + ")"
    value = f"CASE WHEN i % 4 = 3 THEN ({alpha} + 2) // 4 WHEN {alpha} > 0 THEN ({colour} + {alpha} // 2) // {alpha} ELSE 0 END"
    kids = ", ".join(f"any_value(px) FILTER (x % 2 * 2 + y % 2 = {q}) AS p{q}" for q in range(4))
    return f"(SELECT z, x, y, list_transform(range(0, 64), lambda i: {value}) AS px FROM (SELECT z - 1 AS z, x // 2 AS x, y // 2 AS y, {kids} FROM {source} GROUP BY 1, 2, 3))"


KEYED = f"CAST(z AS INT) AS z, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, {HEXED.format(px='px')} AS pixels"
ORACLE["k4_overview_level"] = f"{TP}{MERGED}, u AS {up('m')} SELECT {KEYED} FROM u"
add("k5_build_pyramid", lambda d: hexed(ra.build_pyramid(ra.merge_region(rank(d), layers(d)), 9, 12)),
    f"{MERGED}, u AS MATERIALIZED {up('m')}, u2 AS MATERIALIZED {up('u')}, u3 AS {up('u2')} SELECT {KEYED} FROM (SELECT z, x, y, px FROM m UNION ALL SELECT z, x, y, px FROM u UNION ALL SELECT z, x, y, px FROM u2 UNION ALL SELECT z, x, y, px FROM u3)")
# the same from tables that are bucketed by cell
add("k3_merge_in_cells", lambda d: hexed(ce.merge_in_cells(laid_out(layers(d).withColumn("rank", c("chart_id")), 10))), OUT)
add("k5_pyramid_in_cells", lambda d: hexed(ce.pyramid_in_cells(laid_out(ra.merge_region(rank(d), layers(d)), 10), 9, 12, 10)), "")
ORACLE["k5_pyramid_in_cells"] = ORACLE["k5_build_pyramid"]
PAL = lambda: F.transform(F.sequence(F.lit(0), F.lit(199)), lambda i: F.array(i, (i * 7) % 256, (i * 13) % 256, F.when(i == 3, 0).otherwise(255)))
EXP = "list_transform(px, lambda v: CASE WHEN v < 200 THEN printf('%02X%02X%02X%02X', CAST(v AS INT), CAST(v * 7 % 256 AS INT), CAST(v * 13 % 256 AS INT), CASE WHEN v = 3 THEN 0 ELSE 255 END) ELSE '00000000' END)"
add("k7_expand_palette", lambda d: d.select("chart_id", F.hex(ra.to_bytes(ra.expand_palette(c("px"), PAL()))).alias("rgba")), f" SELECT chart_id, array_to_string({EXP}, '') AS rgba FROM tile_pixels")
RING = ((1, 1), (9, 2), (7, 7))
PX, PY = "((i - 1) // 4 % 4 + chart_id % 3 * 4 + 0.5)", "((i - 1) // 16 + chart_id % 2 * 4 + 0.5)"
CROSS = " + ".join(
    f"CAST((({y1} > {PY}) <> ({y2} > {PY})) AND {PX} < CAST({x2 - x1} AS DOUBLE) * ({PY} - {y1}) / {y2 - y1} + {x1} AS INT)" for (x1, y1), (x2, y2) in zip(RING, RING[1:] + RING[:1], strict=True)
)


def k8(d: DataFrame) -> DataFrame:
    ring = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in RING))
    blocks = layers(d).select("chart_id", (c("chart_id") % 3).alias("bx"), (c("chart_id") % 2).alias("by"), "content", ring.alias("ring"))
    return ra.mask_cutline(blocks, 4).select("chart_id", F.hex("content").alias("pixels"))


add("k8_mask_cutline", k8, f" SELECT chart_id, array_to_string(list_transform(px, lambda v, i: CASE WHEN ({CROSS}) % 2 = 1 THEN printf('%02X', CAST(v AS INT)) ELSE '00' END), '') AS pixels FROM tile_pixels")


def k9(d: DataFrame) -> DataFrame:
    """Merged tiles and their overviews: the former are filled from above, the latter from below."""
    merged = cut(ra.merge_region(rank(d), layers(d)))
    return hexed(ra.fill_holes(merged.unionByName(ra.overview_level(merged))))


LEAST = "list_min(list_filter({px}, lambda v, j: j % 4 = 0))"
GREATEST = "list_max(list_filter({px}, lambda v, j: j % 4 = 0))"
OVER = "list_transform(range(1, 65), lambda i: CAST(({t} + ({t} >> 8)) >> 8 AS INT))".format(t="(px[i] * px[(i - 1) // 4 * 4 + 4] + un[i] * (255 - px[(i - 1) // 4 * 4 + 4]) + 128)")
CROP = "list_transform(range(0, 64), lambda i: u.px[(m.y % 2 * 2 + i // 32) * 16 + (m.x % 2 * 2 + (i // 4) % 4 // 2) * 4 + i % 4 + 1])"
# under a tile lies its children's mosaic, or if that is missing, the part of the tile above it if that has no hole
add("k9_fill_holes", k9,
    f"""{MERGED}, u AS MATERIALIZED {up('m')}, t AS (SELECT m.z, m.x, m.y, m.px, {CROP} AS un, true AS above FROM m JOIN u ON u.x = m.x // 2 AND u.y = m.y // 2 UNION ALL SELECT z, x, y, px, px, false FROM u),
    h AS (SELECT *, {LEAST.format(px='px')} = 0 OR {GREATEST.format(px='px')} = 0 AS holed, above AND ({LEAST.format(px='un')} = 0 OR {GREATEST.format(px='un')} = 0) AS useless FROM t)
    SELECT CAST(z AS INT) AS z, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, {HEXED.format(px=f"(CASE WHEN holed AND NOT useless THEN {OVER} ELSE px END)")} AS pixels FROM h""")  # fmt: skip
add("k10_burn_rectangles", lambda d: ra.burn_rectangles(layers(d).select(c("chart_id").alias("chart"), (c("chart_id") % 3).alias("bx"), F.lit(0).cast("long").alias("by"), "content"), d.select(c("chart_id").alias("chart"), *(F.lit(v).alias(k) for k, v in (("x_off", 2), ("y_off", 1), ("width", 4), ("height", 2), ("r", 9), ("g", 8), ("b", 7)))), 4).select("chart", F.hex("content").alias("pixels")),
    " SELECT chart_id AS chart, array_to_string(list_transform(px, lambda v, i: CASE WHEN (i - 1) // 16 BETWEEN 1 AND 2 AND (i - 1) // 4 % 4 + chart_id % 3 * 4 BETWEEN 2 AND 5 THEN CASE (i - 1) % 4 WHEN 0 THEN '09' WHEN 1 THEN '08' WHEN 2 THEN '07' ELSE 'FF' END ELSE printf('%02X', CAST(v AS INT)) END), '') AS pixels FROM tile_pixels")


def charted(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All charts, a third of which fail verification as their tile is empty, and their tiles."""
    t = layers(d)
    fields = {"scale": (c("chart_id") * 100).cast("int"), "name": F.lit("chart"), "path": F.concat(F.lit("/c/"), c("chart_id"), F.lit(".KAP")), "date": F.lit("1/1/2020"), "outline": F.lit(""), "depths": F.lit("FEET"), "max_zoom": F.lit(12)}
    return t.select("chart_id").distinct().withColumns(fields), t


add("k11_compile_region", lambda d: compile_region("MB_REGION", *charted(d), on_failure="drop").mbtiles.select("zoom_level", "tile_column", "tile_row", F.hex("tile_data").alias("pixels")),
    MERGED.replace("ORDER BY chart_id", "ORDER BY chart_id DESC") + f" SELECT CAST(z AS INT) AS zoom_level, CAST(x AS BIGINT) AS tile_column, CAST(4095 - y AS BIGINT) AS tile_row, {HEXED.format(px='px')} AS pixels FROM m")
add("k11_compile_charts", lambda d: compile_region("MB_CHARTS", *charted(d), on_failure="drop").mbtiles.select("zoom_level", "tile_column", "tile_row", F.hex("tile_data").alias("pixels")),
    f", l AS (SELECT *, {CLASS} AS transp FROM tile_pixels) SELECT CAST(z AS INT) AS zoom_level, CAST(x AS BIGINT) AS tile_column, CAST(4095 - y AS BIGINT) AS tile_row, {HEXED.format(px='px')} AS pixels FROM l WHERE transp <> 0")
add("k11_verdicts", lambda d: compile_region("MB_REGION", *charted(d), on_failure="drop").verdicts.select("chart_id", "ok", "reason", c("zooms").cast("long").alias("zooms"), c("blank").cast("long").alias("blank")),
    f", l AS (SELECT chart_id, {CLASS} AS transp FROM tile_pixels) SELECT chart_id, transp <> 0 AS ok, CASE WHEN transp = 0 THEN 'empty column' ELSE '' END AS reason, CAST(1 AS BIGINT) AS zooms, CAST(CASE WHEN transp = 0 THEN 1 ELSE 0 END AS BIGINT) AS blank FROM l")
# all merged tiles lie in one rectangle, or the columns that are whole do; each is 64 bytes
add("k11_compile_archive", lambda d: compile_region("MX_REGION", *charted(d), region="R", limit=1000, on_failure="drop").archive.filter("part = 3").select("volume", "seq_no", F.hex("bytes").alias("pixels")),
    MERGED.replace("ORDER BY chart_id", "ORDER BY chart_id DESC") + f""", s AS (SELECT x, list(y ORDER BY y) AS ys FROM m GROUP BY x), yr AS (SELECT x, min(y) AS y_min, max(y) AS y_max FROM (SELECT x, y, y - row_number() OVER (PARTITION BY x ORDER BY y) AS g FROM m) GROUP BY x, g),
    xr AS (SELECT ys, min(x) AS x_min, max(x) AS x_max FROM (SELECT *, x - row_number() OVER (PARTITION BY ys ORDER BY x) AS g FROM s) GROUP BY ys, g), rect AS (SELECT x_min, x_max, y_min, y_max FROM xr JOIN yr ON yr.x = xr.x_min),
    o AS (SELECT px, row_number() OVER (ORDER BY x_min, y_min, m.x, m.y) - 1 AS seq_no, (SELECT count(*) FROM rect) AS r, count(*) OVER () AS n FROM m JOIN rect ON m.x BETWEEN x_min AND x_max AND m.y BETWEEN y_min AND y_max),
    h AS (SELECT px, seq_no, 25 + 32 * r + 12 * n AS head FROM o), f AS (SELECT *, greatest(0, (1000 - head) // 64) AS first FROM h)
    SELECT CAST(CASE WHEN seq_no < first THEN 0 ELSE (seq_no - first) // 15 + 1 END AS INT) AS volume, seq_no, {HEXED.format(px='px')} AS pixels FROM f""")  # fmt: skip


def k6(d: DataFrame) -> DataFrame:
    """Each tile as a raster of one block, cut one pixel up and left of its corner."""
    numbers = {"x0": -1, "y0": -1, "x1": 3, "y1": 3, "width": 3, "height": 3, "x_off": 1, "y_off": 1}
    w = F.struct(*(F.lit(v).cast("long").alias(k) for k, v in numbers.items()))
    t = layers(d)
    blocks = t.select("chart_id", F.lit(0).cast("long").alias("bx"), F.lit(0).cast("long").alias("by"), "content")
    return ra.cut_tiles(blocks, t.select("chart_id", "z", "x", "y", w.alias("w")), 4, 4).select("chart_id", F.hex("content").alias("pixels"))


MOVED = "list_transform(range(1, 65), lambda i: CASE WHEN (i - 1) // 16 >= 1 AND (i - 1) // 4 % 4 >= 1 THEN px[i - 20] ELSE 0 END)"
add("k6_cut_tiles", k6, f", m AS (SELECT chart_id, {MOVED} AS px FROM tile_pixels) SELECT chart_id, {HEXED.format(px='px')} AS pixels FROM m WHERE list_max(px) > 0")


def resampled(size: int):
    """Each tile cut through a window of size pixels from its corner, which is shrunk or enlarged to four."""
    numbers = {"x0": 0, "y0": 0, "x1": size, "y1": size, "width": min(size, 4), "height": min(size, 4), "x_off": 0, "y_off": 0}

    def build(d: DataFrame) -> DataFrame:
        w = F.struct(*(F.lit(v).cast("long").alias(k) for k, v in numbers.items()))
        t = layers(d)
        blocks = t.select("chart_id", F.lit(0).cast("long").alias("bx"), F.lit(0).cast("long").alias("by"), "content")
        return ra.cut_tiles(blocks, t.select("chart_id", "z", "x", "y", w.alias("w")), 4, 4).select("chart_id", F.hex("content").alias("pixels"))

    return build


ENLARGED = "list_transform(range(0, 64), lambda i: px[i // 32 * 16 + (i // 4) % 4 // 2 * 4 + i % 4 + 1])"
CORNER = "list_concat(" + ", ".join(f"px[{r * 16 + 1}:{r * 16 + 8}]" for r in range(2)) + ")"
add("k6_enlarged_tiles", resampled(2), f", m AS (SELECT chart_id, {ENLARGED} AS px, list_max({CORNER}) AS top FROM tile_pixels) SELECT chart_id, {HEXED.format(px='px')} AS pixels FROM m WHERE top > 0")
# a window of twice the size holds the tile in its first quarter: means of two by two, halves to even
CELL = [f"px[(i // 16 * 2 + {r}) * 16 + ((i // 4) % 4 * 2 + {k}) * 4 + {{ch}} + 1]" for r in (0, 1) for k in (0, 1)]
SUM_A = "(" + " + ".join(x.format(ch=3) for x in CELL) + ")"
SUM_C = "(" + " + ".join(f"{x.format(ch='i % 4')} * {x.format(ch=3)}" for x in CELL) + ")"
SHRUNK = f"list_transform(range(0, 64), lambda i: CASE WHEN i // 32 = 1 OR (i // 4) % 4 > 1 THEN 0 WHEN i % 4 = 3 THEN CAST(round_even(CAST({SUM_A} AS DOUBLE) / 4, 0) AS INT) WHEN {SUM_A} > 0 THEN CAST(round_even(CAST({SUM_C} AS DOUBLE) / {SUM_A}, 0) AS INT) ELSE 0 END)"
add("k6_shrunk_tiles", resampled(8), f", m AS (SELECT chart_id, {SHRUNK} AS px, list_max(px) AS top FROM tile_pixels) SELECT chart_id, {HEXED.format(px='px')} AS pixels FROM m WHERE top > 0")
