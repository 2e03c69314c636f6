"""Registered queries of filters, joins, aggregates, windows, sorts and set operations, beside their SQL."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixtures import fixture, with_fixtures
from ..functions import geo, text
from ..operators import catalog as cat
from ..operators import cells as ce
from ..operators import regions as reg
from ..operators import tiles as tl
from ..operators.steps import dealt, new_folder
from ..sources import tables, volumes
from ..sources.headers import write_files
from ..sources.tile_tables import laid_out
from .scalars import BASE, DEG, LATS, LNGS, ZOOM, px, py

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
c = F.col


def add(name: str, sources: str, build: Callable[..., DataFrame], sql: str) -> None:
    """build gets the fixtures in the order of sources; sql follows a WITH that names them."""
    names = sources.split()

    def query(spark, sf_dir: str) -> DataFrame:
        return build(*(fixture(spark, sf_dir, n) for n in names))

    query.__name__ = name
    QUERIES[name], ORACLE[name] = query, f"{with_fixtures(*names)}{sql}"


CATALOG = "(SELECT *, row_number() OVER (ORDER BY scale DESC NULLS LAST, path) AS rank FROM chart_boxes)"


def ranked(boxes: DataFrame) -> DataFrame:
    return cat.catalog_order(boxes)


# ---- E, I1
line = lambda x: f"regexp_extract(header, '{x}', 1)"
headers = lambda d: cat.parse_headers(dealt(d).withColumn("lines", text.header_lines(c("header"))))
add("e1_valid_charts", "chart_boxes", lambda d: cat.valid_charts(d).select("chart_id", "name", "scale"), " SELECT chart_id, name, scale FROM chart_boxes WHERE scale IS NOT NULL AND name NOT LIKE '%Cover for Chart%'")
LATC = f"((least({', '.join(LATS)}) + greatest({', '.join(LATS)})) / 2)"
add("e2_build_catalog", "chart_headers", lambda d: cat.build_catalog(headers(d).withColumn("path", F.concat(F.lit("/c/"), c("chart_id"), F.lit(".KAP")))).select("path", "name", "min_zoom", "max_zoom", "scale", "date", "depths", c("rank").cast("long").alias("rank")),
    f""", h AS (SELECT concat('/c/', chart_id, '.KAP') AS path, trim(replace({line('BSB/NA=([^,]*),')}, '''', '')) AS name, CAST({line('KNP/SC=([0-9]+)')} AS INT) AS scale, trim({line('ED=([^\\n]{1,11})')}) AS date,
      CASE WHEN contains(header, 'UN=') THEN {line('UN=([^,]*),')} ELSE 'Unknown' END AS depths, {LATC} AS lat FROM chart_headers)
    SELECT path, name, CAST({ZOOM.format(s=f"(scale * (6378137.0 * pi() / 180 / {DEG}))")} AS INT) AS min_zoom, CAST({ZOOM.format(s=f"(scale * (6378137.0 * pi() / 180 / {DEG}))")} AS INT) AS max_zoom, scale, date, depths,
      row_number() OVER (ORDER BY scale DESC, path) AS rank FROM h WHERE name NOT LIKE '%Cover for Chart%'""")  # fmt: skip


def providers(d: DataFrame) -> DataFrame:
    d = d.withColumns({"lat": (c("south") + c("north")) / 2, "date": F.lit("d"), "depths": F.lit("FEET"), "outline": F.lit("o"), "bounds_outline": F.lit("b"), "today": F.lit("t"), "xsize": F.lit(1024), "span": (c("chart_id") % 90 + 1) * 1000.0})
    d = d.withColumn("path", F.when(c("chart_id") % 3 == 0, F.replace("path", F.lit(".KAP"), F.lit(".tif"))).otherwise(c("path")))
    return cat.catalog_fields_by_provider(d).select("chart_id", *(c(x) for x in ("c_name", "c_min_zoom", "c_max_zoom", "c_scale", "c_date", "c_depths", "c_outline")))


TRUE = "(span / (1024 / {dpi} / 39.3701))"
TIF, FAA = "(provider IN ('brazil', 'wavey-lines') AND path LIKE '%.tif')", "provider = 'faa'"
SC = {d: f"CAST(trunc({TRUE.format(dpi=d)}) AS BIGINT)" for d in (300, 400)}
LOW = f"CASE WHEN provider = 'ukho' THEN {ZOOM.format(s=TRUE.format(dpi=127))} WHEN {FAA} THEN greatest(0, {ZOOM.format(s=SC[300])} - 8) WHEN {TIF} THEN {ZOOM.format(s=SC[400])} + 1 WHEN scale IS NULL THEN 0 ELSE {ZOOM.format(s=f'(scale * (6378137.0 * pi() / 180 / {DEG}))')} END"
add("e3_catalog_fields", "chart_boxes", providers,
    f""", p AS (SELECT * REPLACE (CASE WHEN chart_id % 3 = 0 THEN replace(path, '.KAP', '.tif') ELSE path END AS path), (south + north) / 2 AS lat, (chart_id % 90 + 1) * 1000.0::DOUBLE AS span FROM chart_boxes)
    SELECT chart_id, CASE WHEN {FAA} OR {TIF} THEN {BASE} ELSE name END AS c_name, CAST({LOW} AS INT) AS c_min_zoom, CAST(CASE WHEN {FAA} THEN {ZOOM.format(s=SC[300])} ELSE {LOW} END AS INT) AS c_max_zoom,
      CASE WHEN {FAA} THEN {SC[300]} WHEN {TIF} THEN {SC[400]} ELSE CAST(scale AS BIGINT) END AS c_scale, CASE WHEN {FAA} OR {TIF} THEN 't' ELSE 'd' END AS c_date,
      CASE WHEN {FAA} THEN 'None' WHEN {TIF} AND provider = 'brazil' THEN 'Unknown' WHEN {TIF} THEN 'Meters' ELSE 'FEET' END AS c_depths, CASE WHEN {FAA} OR {TIF} THEN 'b' ELSE 'o' END AS c_outline FROM p""")  # fmt: skip
add("e4_drop_transparent", "tile_layers", tl.drop_transparent, " SELECT * FROM tile_layers WHERE transp <> 0")
VALUES = ", ".join(str((r, p, d, t, cat.PROVIDERS[p])).replace('"', "'") for r, p, d, t in cat.REGIONS)
add("e5_region_attributes", "stage_log", lambda d: cat.region_attributes(d.select("line_no", F.substring_index("line", ":::", 1).alias("region"))),
    f", r(rg, provider, description, map_type, map_dir) AS (VALUES {VALUES}) SELECT line_no, split_part(line, ':::', 1) AS region, provider, description, map_type, map_dir, rg IS NOT NULL AS valid FROM stage_log LEFT JOIN r ON upper(split_part(line, ':::', 1)) = rg")
cover_box = lambda d: d.withColumns({"zmin": F.lit(4), "zmax": F.lit(9)})
zs = [str(z) for z in range(4, 10)]
BX = ", ".join(f"({z})" for z in zs)
MZ = "(256 * pow(2.0, z))"
COVER = f"""b AS (SELECT chart_id, z, {px('west', MZ)} // 256 AS x1, {px('east', MZ)} // 256 AS x2, {py('north', MZ)} // 256 AS y1, {py('south', MZ)} // 256 AS y2 FROM chart_boxes, (VALUES {BX}) v(z)),
    r AS (SELECT chart_id, z, y1, y2, x1 AS a, CASE WHEN x1 > x2 THEN (CAST(1 AS BIGINT) << z) - 1 ELSE x2 END AS o FROM b UNION ALL SELECT chart_id, z, y1, y2, 0, x2 FROM b WHERE x1 > x2),
    t AS (SELECT chart_id, z, x, unnest(range(y1, y2 + 1)) AS y FROM (SELECT chart_id, z, y1, y2, unnest(range(a, o + 1)) AS x FROM r))"""
add("e6_tile_cover", "chart_boxes", lambda d: tl.tile_cover(cover_box(d)), f", {COVER} SELECT chart_id, z, x, y FROM t")
add("e7_needs_encryption", "chart_boxes", lambda d: d.select("chart_id", cat.needs_encryption(c("provider")).alias("encrypted"), F.when(cat.needs_encryption(c("provider")), ".sgemf").otherwise(".gemf").alias("ext")),
    " SELECT chart_id, provider IN ('ukho', 'wavey-lines') AS encrypted, CASE WHEN provider IN ('ukho', 'wavey-lines') THEN '.sgemf' ELSE '.gemf' END AS ext FROM chart_boxes")
add("i1_catalog_order", "chart_boxes", lambda d: cat.catalog_order(d).select("chart_id", "scale", c("rank").cast("long").alias("rank")), f" SELECT chart_id, scale, rank FROM {CATALOG}")


# ---- F
def f1(files: DataFrame, nodes: DataFrame) -> DataFrame:
    files = files.withColumn("name", F.concat(10000 + c("file_id") % 1800, F.lit("_"), 1 + c("file_id") % 3, F.lit(".KAP")))
    product = cat.product_names(nodes)
    return cat.region_chart_files(files, product, product.filter("node_id % 10 = 3").select("name"), product.filter("node_id % 10 = 4").select("name"), product.filter("node_id % 20 = 3").select("name")).select("file_id", "name")


add("f1_region_chart_files", "chart_files product_texts", f1,
    """, n AS (SELECT node_id, regexp_extract(xml, 'file name: ([^<]*?\\.KAP)', 1) AS name FROM product_texts), f AS (SELECT file_id, concat(10000 + file_id % 1800, '_', 1 + file_id % 3, '.KAP') AS name FROM chart_files),
    w AS (SELECT name FROM n WHERE name NOT IN (SELECT name FROM n WHERE node_id % 10 IN (3, 4)) UNION SELECT name FROM n WHERE node_id % 20 = 3) SELECT file_id, name FROM f WHERE name IN (SELECT name FROM w)""")  # fmt: skip


def f2(d: DataFrame) -> DataFrame:
    charts = headers(d).withColumn("base", F.format_string("%06d", "chart_id"))
    vertex = lambda a, b: text.point(F.lit(float(a)), F.lit(float(b)))
    overrides = d.filter("chart_id % 9 = 0").select(c("chart_id").cast("string").alias("base"), F.array(vertex(1, 2), vertex(1, 3), vertex(2, 3)).alias("ring"))
    r = cat.apply_ring_overrides(charts, overrides)
    return r.select("chart_id", F.size("ring").cast("long").alias("n"), F.get("ring", F.lit(0))["lat"].alias("lat0"), F.element_at("ring", -1)["lng"].alias("lng_last"))


add("f2_ring_overrides", "chart_headers", f2, f" SELECT chart_id, CAST(4 AS BIGINT) AS n, CASE WHEN chart_id % 9 = 0 THEN 1.0 ELSE {LATS[0]} END AS lat0, CASE WHEN chart_id % 9 = 0 THEN 2.0 ELSE {LNGS[0]} END AS lng_last FROM chart_headers")
POLY = ", ".join(f"('{r}', {i}, {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for r, ring in reg.POLYGONS.items() for i, (a, b) in enumerate(zip(ring, ring[1:], strict=False)))
EXC = ", ".join(f"('{r}', '{n}')" for r, ns in reg.EXCLUDES.items() for n in ns)
SIDE = "((lng2 - lng1) * ({a} - lat1) - (lat2 - lat1) * ({o} - lng1))"
SIDES = ", ".join(SIDE.format(a=a, o=o) for a, o in (("north", "west"), ("north", "east"), ("south", "east"), ("south", "west")))
# a denser grid of boxes over the polygons, so that they meet often
SHIFTED = "(SELECT chart_id, concat('/x/', CASE chart_id % 13 WHEN 0 THEN '40' WHEN 1 THEN '4102-0' WHEN 2 THEN '1123-0' ELSE CAST(chart_id AS STRING) END, '.tif') AS path, -20 + chart_id % 97 * 0.3 AS west, -20 + chart_id % 97 * 0.3 + 0.4 + chart_id % 7 AS east, 45 + chart_id % 89 * 0.2 AS south, 45 + chart_id % 89 * 0.2 + 0.3 + chart_id % 5 AS north FROM chart_boxes)"
SHIFTED_D = SHIFTED.replace("* 0.3", "* CAST(0.3 AS DOUBLE)").replace("* 0.2", "* CAST(0.2 AS DOUBLE)").replace("+ 0.4", "+ CAST(0.4 AS DOUBLE)").replace("+ 0.3 +", "+ CAST(0.3 AS DOUBLE) +")


def shifted(d: DataFrame) -> DataFrame:
    return d.sparkSession.sql(SHIFTED_D[1:-1].replace("FROM chart_boxes", "FROM {d}"), d=d)


def f3(d: DataFrame) -> DataFrame:
    spark = d.sparkSession
    return reg.assign_regions(shifted(d), reg.region_polygons(spark), reg.region_excludes(spark))


F3 = f""", ch AS (SELECT *, {BASE} AS nm FROM {SHIFTED_D}), e(region, i, lat1, lng1, lat2, lng2) AS (VALUES {POLY}), x(region, nm) AS (VALUES {EXC}),
    hit AS (SELECT chart_id, region,
      bool_or(least(lng1, lng2) <= east AND greatest(lng1, lng2) >= west AND least(lat1, lat2) <= north AND greatest(lat1, lat2) >= south AND least({SIDES}) <= 0 AND greatest({SIDES}) >= 0) AS meets,
      sum(CASE WHEN (lng1 > west) <> (lng2 > west) AND north < (lat2 - lat1) * (west - lng1) / (lng2 - lng1) + lat1 THEN 1 ELSE 0 END) % 2 = 1 AS inside
      FROM ch, e WHERE nm NOT LIKE '40%' GROUP BY ALL),
    got AS (SELECT chart_id, region, path FROM hit JOIN ch USING (chart_id) WHERE (meets OR inside) AND (region, nm) NOT IN (SELECT (region, nm) FROM x))"""
add("f3_assign_regions", "chart_boxes", lambda d: f3(d).select("chart_id", "region"), f"{F3} SELECT chart_id, region FROM got")


def ring_of(n: int, lat: float, lng: float, a: float, b: float) -> list[tuple[float, float]]:
    """A closed star of n points around a place."""
    radius = [1 + 0.3 * math.sin(9 * math.tau * i / n) for i in range(n)]
    points = [(round(lat + a * r * math.sin(math.tau * i / n), 6), round(lng + b * r * math.cos(math.tau * i / n), 6)) for i, r in enumerate(radius)]
    return [*points, points[0]]


#: Polygons of many points, and two that share the dateline
MANY_POINTS = {"STAR": ring_of(1500, 10, 20, 30, 60), "SMALL_STAR": ring_of(400, -30, -100, 6, 9), "DATELINE_WEST": ring_of(2000, 0, 140, 40, 30), "DATELINE_EAST": [(-60.0, -180.0), (60.0, -180.0), (50.0, -170.0), (-50.0, -172.0), (-60.0, -180.0)]}
RINGS = ", ".join(f"('{r}', [{', '.join(str(a) for a, _ in ring)}]::DOUBLE[], [{', '.join(str(b) for _, b in ring)}]::DOUBLE[])" for r, ring in MANY_POINTS.items())
add("f3_own_boxes", "chart_boxes", lambda d: reg.assign_regions(d.select("chart_id", "path", "west", "north", "east", "south"), reg.region_polygons(d.sparkSession, MANY_POINTS), reg.region_excludes(d.sparkSession)).select("chart_id", "region"),
    f""", g(region, lats, lngs) AS (VALUES {RINGS}), n AS (SELECT region, lats, lngs, unnest(range(1, len(lats))) AS i FROM g), e AS (SELECT region, lats[i] AS lat1, lngs[i] AS lng1, lats[i + 1] AS lat2, lngs[i + 1] AS lng2 FROM n),
    x(region, nm) AS (VALUES {EXC}), nb AS (SELECT *, {BASE} AS nm FROM chart_boxes WHERE {BASE} NOT LIKE '40%'),
    ch AS (SELECT chart_id, nm, 0 AS part, west, CASE WHEN west > east THEN 180 ELSE east END AS east, south, north FROM nb UNION ALL SELECT chart_id, nm, 1, -180, east, south, north FROM nb WHERE west > east),
    hit AS (SELECT chart_id, nm, part, region,
      bool_or(least(lng1, lng2) <= east AND greatest(lng1, lng2) >= west AND least(lat1, lat2) <= north AND greatest(lat1, lat2) >= south AND least({SIDES}) <= 0 AND greatest({SIDES}) >= 0) AS meets,
      sum(CASE WHEN (lng1 > west) <> (lng2 > west) AND north < (lat2 - lat1) * (west - lng1) / (lng2 - lng1) + lat1 THEN 1 ELSE 0 END) % 2 = 1 AS inside
      FROM ch, e GROUP BY ALL)
    SELECT DISTINCT chart_id, region FROM hit WHERE (meets OR inside) AND (region, nm) NOT IN (SELECT (region, nm) FROM x)""")  # fmt: skip
CH = "suffix, CAST({p} AS VARCHAR) AS panel"
F4 = f""", a AS (SELECT row_no, CAST(number AS VARCHAR) AS number, suffix, '0' AS panel, title, scale, depth_code, 0 AS o FROM sheet_charts WHERE prefix = '---'
      UNION ALL SELECT row_no, CAST(number AS VARCHAR), suffix, CAST(panel AS VARCHAR), title, scale, depth_code, 1 FROM sheet_panels WHERE prefix = '---'),
    s AS (SELECT *, number || '_' || suffix || '_' || panel AS stamp FROM a QUALIFY row_number() OVER (PARTITION BY number, suffix, panel ORDER BY o DESC, row_no DESC) = 1),
    m AS (SELECT stamp, number, suffix, panel, replace(regexp_replace(title, '\\s+', ' ', 'g'), '''', '') AS name, scale, coalesce(trim(replace(upper(unit), '/', ' AND ')), 'UNKNOWN') AS depths FROM s LEFT JOIN sheet_depth_codes ON depth_code = code)"""
SHEETS = "sheet_charts sheet_panels sheet_depth_codes"
add("f4_spreadsheet_charts", SHEETS, cat.spreadsheet_charts, f"{F4} SELECT * FROM m")
ED = ", ed AS (SELECT CAST(number AS VARCHAR) AS number, arg_max(serial, row_no) AS serial FROM sheet_editions WHERE prefix = '---' AND serial IS NOT NULL GROUP BY 1)"
add("f5_apply_editions", f"{SHEETS} sheet_editions", lambda a, b, d, e: cat.apply_editions(cat.spreadsheet_charts(a, b, d), e).select("stamp", "updated"),
    f"{F4}{ED} SELECT stamp, strftime(DATE '1899-12-30' + CAST(serial AS INT), '%-m/%-d/%Y') AS updated FROM m LEFT JOIN ed USING (number)")
DMM = "(CAST(CASE WHEN d IN ('', '-') THEN d || '0' ELSE d END AS DOUBLE) + CASE WHEN d LIKE '-%' THEN -1 ELSE 1 END * CAST(m AS DOUBLE) / 60)"
deg = lambda x: DMM.replace("CASE WHEN d IN", f"CASE WHEN regexp_extract({x}, '^(.*)[0-9]{{2}}\\.', 1) IN").replace("THEN d ||", f"THEN regexp_extract({x}, '^(.*)[0-9]{{2}}\\.', 1) ||").replace("ELSE d END", f"ELSE regexp_extract({x}, '^(.*)[0-9]{{2}}\\.', 1) END").replace("WHEN d LIKE", f"WHEN {x} LIKE").replace("CAST(m", f"CAST(regexp_extract({x}, '([0-9]{{2}}\\..*)$', 1)")
VX = f", v AS (SELECT CAST(number AS VARCHAR) || '_' || suffix || '_' || CAST(panel AS VARCHAR) AS stamp, {deg('lat_cell')} AS lat, {deg('lng_cell')} AS lng, row_no, lat_cell, lng_cell FROM sheet_vertices)"
add("f6_attach_vertices", f"{SHEETS} sheet_vertices",
    lambda a, b, d, v: cat.attach_vertices(cat.spreadsheet_charts(a, b, d), v).select("stamp", F.size("ring").cast("long").alias("n"), F.round(F.get("ring", F.lit(0))["lat"], 6).alias("lat0"), F.round(F.element_at("ring", -1)["lng"], 6).alias("lng_last")),
    f"{F4}{VX} SELECT stamp, count(*) + 1 AS n, round(first(lat ORDER BY row_no, lat_cell, lng_cell), 6) AS lat0, round(first(lng ORDER BY row_no, lat_cell, lng_cell), 6) AS lng_last FROM v JOIN m USING (stamp) GROUP BY stamp")


def f7(files, a, b, d) -> DataFrame:
    got, lost = cat.metadata_for_files(files, cat.spreadsheet_charts(a, b, d))
    return got.select("file_id", "stamp", "name").unionByName(lost.select("file_id", "stamp", F.lit(None).cast("string").alias("name")))


SUF = f"CASE WHEN regexp_extract({BASE}, '^[0-9]*([^-]*)-', 1) = '' THEN '-' ELSE regexp_extract({BASE}, '^[0-9]*([^-]*)-', 1) END"
STAMP = f"ltrim(regexp_extract({BASE}, '^([0-9]*)', 1), '0') || '_' || {SUF} || '_' || regexp_extract({BASE}, '-([^_-]*)', 1)"
add("f7_metadata_for_files", f"chart_files {SHEETS}", f7, f"{F4}, fs AS (SELECT file_id, {STAMP} AS stamp FROM chart_files) SELECT file_id, stamp, name FROM fs LEFT JOIN m USING (stamp)")
add("f8_verify_catalog", "chart_boxes tile_layers", lambda b, t: tl.verify_catalog(b.select("chart_id"), t),
    """, v AS (SELECT chart_id, z, x, bool_or(transp <> 0) AS visible FROM tile_layers GROUP BY ALL), s AS (SELECT chart_id, count(DISTINCT z) AS zooms, sum(CASE WHEN NOT visible THEN 1 ELSE 0 END)::BIGINT AS blank FROM v GROUP BY 1),
    j AS (SELECT b.chart_id, zooms, blank FROM chart_boxes b LEFT JOIN s USING (chart_id))
    SELECT chart_id, zooms IS NOT NULL AND blank = 0 AS ok, CASE WHEN zooms IS NULL THEN 'no tiles' WHEN blank > 0 THEN 'empty column' ELSE '' END AS reason, coalesce(zooms, 0) AS zooms, coalesce(blank, 0) AS blank FROM j""")  # fmt: skip
add("f9_verify_optimized", "tile_layers", lambda t: tl.verify_optimized(t.filter("transp <> 0"), t.filter("n_bytes > 500")),
    """, a AS (SELECT DISTINCT z, x, y, 1 AS a FROM tile_layers WHERE transp <> 0), b AS (SELECT DISTINCT z, x, y, 1 AS b FROM tile_layers WHERE n_bytes > 500),
    j AS (SELECT count(a) AS n_before, count(b) AS n_after, count(*) FILTER (a IS NULL OR b IS NULL) AS missing FROM a FULL JOIN b USING (z, x, y))
    SELECT *, n_before = n_after AND n_before > 0 AS counts_equal, n_before = n_after AND n_before > 0 AND missing = 0 AS sets_equal FROM j""")  # fmt: skip
add("f10_resume_missing", "tile_layers", lambda t: tl.resume_missing(t, t.filter("n_bytes % 3 = 0")), " SELECT * FROM tile_layers WHERE n_bytes % 3 <> 0")
KEYS = "t AS (SELECT DISTINCT z, x, y FROM tile_layers), p AS (SELECT DISTINCT z, x, y FROM tile_layers UNION SELECT DISTINCT z - 3, x >> 3, y >> 3 FROM tile_layers WHERE z = 12 UNION SELECT DISTINCT z - 5, x >> 5, y >> 5 FROM tile_layers WHERE z = 11)"


def keys_and_ancestors(layers: DataFrame) -> tuple[DataFrame, DataFrame]:
    t = layers.select("z", "x", "y").distinct()
    up = lambda z, k: t.filter(c("z") == z).select((c("z") - k).alias("z"), F.shiftright("x", k).alias("x"), F.shiftright("y", k).alias("y"))
    return t, up(12, 3).unionByName(up(11, 5))


def f11(layers: DataFrame) -> DataFrame:
    t, higher = keys_and_ancestors(layers)
    return tl.ancestor_lookup(t, t.unionByName(higher))


def f11_cells(layers: DataFrame) -> DataFrame:
    """The same from a table that is bucketed by cell, with tiles to look for and tiles to find side by side."""
    t, higher = keys_and_ancestors(layers)
    table = laid_out(t.withColumn("asked", F.lit(True)).unionByName(higher.withColumn("asked", F.lit(False))))
    return ce.ancestors_in_cells(table, c("asked"))


def f12_cells(layers: DataFrame) -> DataFrame:
    up = layers.select((c("z") - 1).alias("z"), F.shiftright("x", 1).alias("x"), F.shiftright("y", 1).alias("y"), F.lit(True).alias("asked")).distinct()
    return ce.children_in_cells(laid_out(up.unionByName(layers.select("z", "x", "y", F.lit(False).alias("asked")))), c("asked"), ~c("asked"))


add("f11_ancestor_lookup", "tile_layers", f11,
    f""", {KEYS}, k AS (SELECT t.*, CAST(k AS INT) AS k FROM t, range(1, 8) r(k)), f AS (SELECT k.*, p.z AS az, p.x AS ax, p.y AS ay FROM k JOIN p ON p.z = k.z - k.k AND p.x = k.x >> k.k AND p.y = k.y >> k.k WHERE k.k = 1 OR k.z - k.k + 1 >= 6),
    b AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY z, x, y ORDER BY k) = 1) SELECT t.z, t.x, t.y, b.k, b.az, b.ax, b.ay FROM t LEFT JOIN b USING (z, x, y)""")  # fmt: skip
add("f12_children_lookup", "tile_layers", lambda t: tl.children_lookup(t.select("z", "x", "y").distinct().withColumns({"x": F.shiftright("x", 1), "y": F.shiftright("y", 1), "z": c("z") - 1}).distinct(), t),
    """, k AS (SELECT DISTINCT z, x, y FROM tile_layers), t AS (SELECT DISTINCT z - 1 AS z, x >> 1 AS x, y >> 1 AS y FROM k) SELECT t.z, t.x, t.y, k.x AS cx, k.y AS cy, CAST(k.x % 2 * 2 + k.y % 2 AS INT) AS quadrant
    FROM t JOIN k ON k.z = t.z + 1 AND k.x >> 1 = t.x AND k.y >> 1 = t.y""")  # fmt: skip
add("f11_ancestors_in_cells", "tile_layers", f11_cells, "")
add("f12_children_in_cells", "tile_layers", f12_cells, "")
ORACLE["f11_ancestors_in_cells"], ORACLE["f12_children_in_cells"] = ORACLE["f11_ancestor_lookup"], ORACLE["f12_children_lookup"]
add("f13_burn_rects", "burn_names", lambda d: tl.burn_rects_to_tiles(d.select("id", text.parse_burn_name(c("file")).alias("b")).select("id", "b.x_off", "b.y_off").withColumns({"width": (c("id") % 700).cast("int"), "height": (c("id") % 300).cast("int")})).select("id", "cell_x", "cell_y"),
    """, r AS (SELECT id, CAST(split_part(file, ':', 4) AS INT) AS x, CAST(replace(split_part(file, ':', 5), '.png', '') AS INT) AS y, id % 700 AS w, id % 300 AS h FROM burn_names)
    SELECT id, cell_x, unnest(range(y // 256, (y + h - 1) // 256 + 1)) AS cell_y FROM (SELECT *, unnest(range(x // 256, (x + w - 1) // 256 + 1)) AS cell_x FROM r WHERE w > 0 AND h > 0)""")  # fmt: skip
add("f14_custom_region_files", "chart_files", lambda d: cat.custom_region_files(d, "my area & more").select("file_id"), " SELECT file_id FROM chart_files WHERE path LIKE '%/my area & more/%' AND upper(path) LIKE '%.KAP'")

# ---- G
add("g1_column_ysets", "tile_layers", lambda t: tl.column_ysets(t).select("z", "x", F.posexplode("ys").alias("i", "y")), " SELECT z, x, CAST(row_number() OVER (PARTITION BY z, x ORDER BY y) - 1 AS INT) AS i, y FROM (SELECT DISTINCT z, x, y FROM tile_layers)")
# the archive's tiles: those of charts whose tile there is not empty
block = tl.drop_transparent
BLOCK = "k AS (SELECT DISTINCT z, x, y FROM tile_layers WHERE transp <> 0), s AS (SELECT z, x, list(y ORDER BY y) AS ys FROM k GROUP BY 1, 2)"
add("g2_xs_by_yset", "tile_layers", lambda t: tl.xs_by_yset(block(t)).select("z", F.size("xs").cast("long").alias("n"), F.explode("xs").alias("x")), f", {BLOCK} SELECT z, count(*) OVER (PARTITION BY z, ys) AS n, x FROM s")
add("g3_zoom_bounds", "tile_layers", tl.zoom_bounds, " SELECT z, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max FROM tile_layers GROUP BY z")
add("g4_tile_counts", "tile_layers", tl.tile_counts, " SELECT z, count(*) AS n FROM (SELECT DISTINCT z, x, y FROM tile_layers) GROUP BY ROLLUP (z)")
add("g5_column_visibility", "tile_layers", tl.column_visibility, " SELECT chart_id, z, x, bool_or(transp <> 0) AS visible FROM tile_layers GROUP BY ALL")
add("g6_duplicate_stamps", "chart_files", lambda d: reg.duplicate_stamps(d).select("stamp", "n", F.get("paths", F.lit(0)).alias("first_path")), f" SELECT stamp, count(*) AS n, min(path) AS first_path FROM (SELECT path, {STAMP} AS stamp FROM chart_files) GROUP BY stamp HAVING count(*) > 1")
add("g7_latest_links", "archive_files", lambda d: cat.latest_links(d.select(c("numbered_file").alias("file"), c("id").alias("pos")), d.filter("id % 11 = 0").select(text.name_and_number(c("numbered_file"))["name"].alias("name")).distinct()),
    """, p AS (SELECT numbered_file AS file, id AS pos, regexp_replace(numbered_file, '[0-9]', '', 'g') AS name, CAST(regexp_replace(numbered_file, '[^0-9]', '', 'g') AS BIGINT) AS number FROM archive_files)
    SELECT name, file, pos, number FROM p WHERE name NOT IN (SELECT name FROM p WHERE pos % 11 = 0) QUALIFY row_number() OVER (PARTITION BY name ORDER BY number DESC, pos) = 1""")  # fmt: skip
A4 = """ SELECT node_id, unnest(regexp_extract_all(xml, 'file name: ([^<]*?\\.KAP)', 1)) AS name FROM product_texts"""
add("a4_product_names", "product_texts", lambda d: cat.product_names(d).select("node_id", "name"), A4)


def g8(spark, sf_dir: str) -> DataFrame:
    return cat.extract_links(spark.read.parquet(f"{sf_dir}/pages.parquet"), "e")


QUERIES["g8_extract_links"] = g8
LINKS = r"""WITH l AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["'']', 1) AS hs FROM pages), e AS (SELECT page_id, url, unnest(hs) AS href, CAST(unnest(range(len(hs))) AS INT) AS pos FROM l)
SELECT page_id, pos, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^([^/]*//[^/]*)', 1) || href WHEN starts_with(href, url) THEN href ELSE url || '/' || href END AS link FROM e WHERE href LIKE '%e'"""
ORACLE["g8_extract_links"] = LINKS


def d23(spark, sf_dir: str) -> DataFrame:
    """Addresses of each page's kinds: relative to the site, relative to the page, and below the page's own address."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    refs = F.array(F.lit("/a/b.zip"), F.concat("url", F.lit("/c.zip")), F.lit("d/e.zip"), F.lit("http://other.org/f.zip"))
    return pages.select("page_id", "url", F.posexplode(refs).alias("kind", "href")).select("page_id", "kind", text.resolve_link(c("url"), c("href")).alias("link"))


QUERIES["d23_resolve_link"] = d23
ORACLE["d23_resolve_link"] = r"""WITH r AS (SELECT page_id, url, ['/a/b.zip', url || '/c.zip', 'd/e.zip', 'http://other.org/f.zip'] AS hs FROM pages), e AS (SELECT page_id, url, unnest(hs) AS href, CAST(unnest(range(4)) AS INT) AS kind FROM r)
SELECT page_id, kind, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^([^/]*//[^/]*)', 1) || href WHEN starts_with(href, url) THEN href ELSE url || '/' || href END AS link FROM e"""
add("g9_burns_by_chart", "burn_names", lambda d: reg.burns_by_chart(d).select("chart", F.size("burns").cast("long").alias("n"), F.element_at("burns", -1)["score"].alias("top_score"), F.get("burns", F.lit(0))["x_off"].alias("first_x")),
    """, b AS (SELECT split_part(file, ':', 1) AS chart, split_part(file, ':', 2) AS crest, CAST(split_part(file, ':', 3) AS INT) AS score, CAST(split_part(file, ':', 4) AS INT) AS x_off, CAST(replace(split_part(file, ':', 5), '.png', '') AS INT) AS y_off FROM burn_names)
    SELECT chart, count(*) AS n, max(score) AS top_score, first(x_off ORDER BY score, x_off, y_off, crest) AS first_x FROM b GROUP BY chart""")  # fmt: skip
add("g10_region_match_counts", "chart_boxes", lambda d: reg.region_match_counts(f3(d), shifted(d)), f"{F3} SELECT region, count(*) AS matched, (SELECT count(*) FROM got) AS total, greatest((SELECT count(*) FROM ch) - (SELECT count(*) FROM got), 0) AS skipped FROM got GROUP BY region")
STAGE = "CASE upper(split_part(line, ':::', 3)) " + " ".join(f"WHEN 'CHECKPOINT_{s}' THEN {i + 1}" for i, s in enumerate(cat.STAGES)) + " ELSE 0 END"
G11 = f", s AS (SELECT split_part(line, ':::', 1) AS region, split_part(line, ':::', 2) AS profile, CAST(arg_max({STAGE}, line_no) AS INT) AS stage FROM stage_log WHERE line LIKE '%:::%:::%' GROUP BY 1, 2)"
add("g11_latest_stage", "stage_log", cat.latest_stage, f"{G11} SELECT * FROM s")
jobs = lambda d: d.select(F.concat(F.lit("REGION_"), c("line_no") % 40).alias("region"), F.lit("MX_REGION").alias("profile")).distinct()
add("g11_pending_stage", "stage_log", lambda d: cat.pending_stage(jobs(d), d, 4), f"{G11}, j AS (SELECT DISTINCT 'REGION_' || line_no % 40 AS region, 'MX_REGION' AS profile FROM stage_log) SELECT region, profile, coalesce(stage, 0) AS stage, coalesce(stage, 0) < 4 AS pending FROM j LEFT JOIN s USING (region, profile)")

# ---- H
YR = f"{BLOCK}, yr AS (SELECT z, x, min(y) AS y_min, max(y) AS y_max FROM (SELECT *, y - row_number() OVER (PARTITION BY z, x ORDER BY y) AS g FROM k) GROUP BY z, x, g)"
XR = f"{YR}, xr AS (SELECT z, ys, min(x) AS x_min, max(x) AS x_max FROM (SELECT *, x - row_number() OVER (PARTITION BY z, ys ORDER BY x) AS g FROM s) GROUP BY z, ys, g)"
RECT = f"{XR}, rect AS (SELECT xr.z, x_min, x_max, y_min, y_max, 0 AS source_index FROM xr JOIN yr ON yr.z = xr.z AND yr.x = xr.x_min)"
add("h1_x_runs", "tile_layers", lambda t: tl.x_runs(block(t)).select("z", "x_min", "x_max", F.size("runs").cast("long").alias("n_runs")), f", {XR} SELECT xr.z, x_min, x_max, count(*) AS n_runs FROM xr JOIN yr ON yr.z = xr.z AND yr.x = xr.x_min GROUP BY xr.z, x_min, x_max")
add("h2_y_runs", "tile_layers", lambda t: tl.y_runs(block(t)), f", {YR} SELECT * FROM yr")
add("h3_tile_rectangles", "tile_layers", lambda t: tl.tile_rectangles(block(t)), f", {RECT} SELECT * FROM rect")
add("h4_skip_zooms", "tile_layers", lambda t: tl.skip_zooms(block(t)),
    """, t AS (SELECT * FROM tile_layers WHERE transp <> 0), n AS (SELECT chart_id, z, row_number() OVER w AS i, max(z) OVER (PARTITION BY chart_id) AS a FROM (SELECT DISTINCT chart_id, z FROM t) WINDOW w AS (PARTITION BY chart_id ORDER BY z DESC)),
    m AS (SELECT *, max(CASE WHEN i = 2 THEN z END) OVER (PARTITION BY chart_id) AS b FROM n) SELECT t.* FROM t JOIN m USING (chart_id, z) WHERE NOT coalesce(a - b = 1 AND i % 2 = 0, false)""")  # fmt: skip
OFF = f"""{RECT}, o AS (SELECT *, (x_max - x_min + 1) * (y_max - y_min + 1) AS n, row_number() OVER (ORDER BY z, x_min, y_min) - 1 AS range_id FROM rect),
    g AS (SELECT *, coalesce(sum(n) OVER (ORDER BY range_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first_tile, (36 + 32 * count(*) OVER ())::BIGINT AS pre, (36 + 32 * count(*) OVER () + 12 * sum(n) OVER ())::BIGINT AS header_size FROM o)"""
ranges = lambda t: tl.range_offsets(tl.tile_rectangles(block(t)), 20)
add("h5_range_offsets", "tile_layers", lambda t: ranges(t).select("z", "x_min", "y_min", "n", c("range_id").cast("long").alias("range_id"), "first_tile", "offset", "header_size"), f", {OFF} SELECT z, x_min, y_min, n, range_id, first_tile, pre + 12 * first_tile AS \"offset\", header_size FROM g")
sizes = lambda t: block(t).groupBy("z", "x", "y").agg(F.max("n_bytes").alias("n_bytes"))
TOFF = f"""{OFF}, sz AS (SELECT z, x, y, max(n_bytes) AS n_bytes FROM tile_layers WHERE transp <> 0 GROUP BY 1, 2, 3),
    pl AS (SELECT sz.*, range_id, header_size, (sz.x - x_min) * (y_max - y_min + 1) + sz.y - y_min AS seq FROM sz JOIN g ON g.z = sz.z AND sz.x BETWEEN x_min AND x_max AND sz.y BETWEEN y_min AND y_max),
    tf AS (SELECT z, x, y, n_bytes, range_id, (header_size + coalesce(sum(n_bytes) OVER (ORDER BY range_id, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS off, seq FROM pl)"""
add("h6_tile_offsets", "tile_layers", lambda t: tl.tile_offsets(ranges(t), sizes(t)).select("z", "x", "y", "n_bytes", c("range_id").cast("long").alias("range_id"), "offset"), f", {TOFF} SELECT z, x, y, n_bytes, range_id, off AS \"offset\" FROM tf")
LIMIT = 3_000_000
add("h7_archive_volumes", "tile_layers", lambda t: tl.archive_volumes(tl.tile_offsets(ranges(t), sizes(t)), LIMIT).select("z", "x", "y", c("volume").cast("int").alias("volume")), "")
ORACLE["h7_archive_volumes"] = with_fixtures("tile_layers").replace("WITH ", "WITH RECURSIVE ", 1) + f""", {TOFF}, tm AS MATERIALIZED (SELECT * FROM tf),
    cuts(v, cut) AS (SELECT 0, CAST(0 AS BIGINT) UNION ALL SELECT v + 1, (SELECT min(off) FROM tm WHERE off + n_bytes - cut > {LIMIT} AND off > CASE WHEN v = 0 THEN -1 ELSE cut END) FROM cuts WHERE (SELECT min(off) FROM tm WHERE off + n_bytes - cut > {LIMIT} AND off > CASE WHEN v = 0 THEN -1 ELSE cut END) IS NOT NULL)
    SELECT z, x, y, CAST((SELECT count(*) FROM cuts WHERE v > 0 AND cut <= off) AS INT) AS volume FROM tm"""
SOURCE = "REGION_TEST1"


def h8(t: DataFrame) -> DataFrame:
    found = ranges(t)
    return tl.archive_head(found, tl.tile_offsets(found, sizes(t)), SOURCE).select("part", "seq_no", F.hex("bytes").alias("bytes"))


HEAD = f"""SELECT 0 AS part, CAST(0 AS BIGINT) AS seq_no, printf('%08X%08X%08X%08X%08X', 4, 256, 1, 0, {len(SOURCE)}) || hex('{SOURCE}') || printf('%08X', (SELECT count(*) FROM g)) AS bytes, CAST(0 AS BIGINT) AS "at"
    UNION ALL SELECT 1, range_id, printf('%08X%08X%08X%08X%08X%08X%016X', z, x_min, x_max, y_min, y_max, source_index, pre + 12 * first_tile), 36 + 32 * range_id FROM g
    UNION ALL SELECT 2, row_number() OVER (ORDER BY range_id, seq) - 1, printf('%016X%08X', off, n_bytes), (SELECT min(pre) FROM g) + 12 * (row_number() OVER (ORDER BY range_id, seq) - 1) FROM tf"""
add("h8_archive_header", "tile_layers", h8, f", {TOFF}, head AS ({HEAD}) SELECT part, seq_no, bytes FROM head")
TWO = ["EVEN", "ODD_ONE"]  # sources of one archive: charts by their last digit


def two_sources(t: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranges and offsets of the tiles of two sources."""
    found = block(t).groupBy((c("chart_id") % 2).cast("int").alias("source_index"), "z", "x", "y").agg(F.max("n_bytes").alias("n_bytes"))
    each = [tl.tile_rectangles(found.filter(c("source_index") == i), i) for i in range(2)]
    ranged = tl.range_offsets(each[0].unionByName(each[1]), tl.source_list_size(TWO))
    return ranged, tl.tile_offsets(ranged, found)


def h8_sources(t: DataFrame) -> DataFrame:
    found, placed = two_sources(t)
    return tl.archive_head(found, placed, TWO).select("part", "seq_no", F.hex("bytes").alias("bytes"), "at")


# in the SQL, a zoom of the second source counts as a hundred more, so the order by zoom is that by source and zoom
TWO_BYTES = 16 + tl.source_list_size(TWO)
TOFF2 = "two AS (SELECT * REPLACE (CAST(z + 100 * (chart_id % 2) AS INT) AS z) FROM tile_layers), " + TOFF.replace("tile_layers", "two").replace("(36 + 32", f"({TWO_BYTES} + 32")
NAMES = " || ".join(f"printf('%08X%08X', {i}, {len(n)}) || hex('{n}')" for i, n in enumerate(TWO))
add("h8_archive_sources", "tile_layers", h8_sources,
    f""", {TOFF2} SELECT 0 AS part, CAST(0 AS BIGINT) AS seq_no, printf('%08X%08X%08X', 4, 256, 2) || {NAMES} || printf('%08X', (SELECT count(*) FROM g)) AS bytes, CAST(0 AS BIGINT) AS "at"
    UNION ALL SELECT 1, range_id, printf('%08X%08X%08X%08X%08X%08X%016X', z % 100, x_min, x_max, y_min, y_max, z // 100, pre + 12 * first_tile), {TWO_BYTES} + 32 * range_id FROM g
    UNION ALL SELECT 2, row_number() OVER (ORDER BY range_id, seq) - 1, printf('%016X%08X', off, n_bytes), (SELECT min(pre) FROM g) + 12 * (row_number() OVER (ORDER BY range_id, seq) - 1) FROM tf""")  # fmt: skip
KIND = f"CASE WHEN NOT contains({BASE}, '_') THEN 0 WHEN contains({BASE}, '_W') THEN 1 WHEN contains({BASE}, '_UD') THEN 2 ELSE 3 END"
add("h9_dedup_charts", "chart_files", lambda d: reg.dedup_charts(d).select("file_id", "stamp", "kept"), f" SELECT file_id, stamp, row_number() OVER (PARTITION BY stamp ORDER BY kind, path, file_id) = 1 AS kept FROM (SELECT *, {STAMP} AS stamp, {KIND} AS kind FROM chart_files)")
LAYERS = f"r AS (SELECT t.*, rank FROM tile_layers t JOIN {CATALOG} USING (chart_id) WHERE transp <> 0)"
add("h10_merge_layers", "chart_boxes tile_layers", lambda b, t: tl.merge_layers(t, ranked(b)).select("chart_id", "z", "x", "y", c("rank").cast("long").alias("rank")),
    f", {LAYERS} SELECT chart_id, z, x, y, rank FROM r QUALIFY rank >= coalesce(max(CASE WHEN transp = 1 THEN rank END) OVER (PARTITION BY z, x, y), 0)")
add("h10_layers_in_cells", "chart_boxes tile_layers", lambda b, t: ce.layers_in_cells(laid_out(tl.with_rank(t, ranked(b)))).select("chart_id", "z", "x", "y", c("rank").cast("long").alias("rank")), "")
ORACLE["h10_layers_in_cells"] = ORACLE["h10_merge_layers"]
add("i2_archive_order", "tile_layers", lambda t: tl.archive_order(tl.tiles_in_ranges(ranges(t), sizes(t))).select("z", "x", "y", c("tile_no").alias("position")), f", {TOFF} SELECT z, x, y, row_number() OVER (ORDER BY range_id, seq) - 1 AS position FROM tf")
add("i3_top_layer", "chart_boxes tile_layers", lambda b, t: tl.top_layer(t, ranked(b)).select("z", "x", "y", "chart_id"), f", {LAYERS} SELECT z, x, y, arg_max(chart_id, rank) AS chart_id FROM r GROUP BY 1, 2, 3")


def flagship(b: DataFrame) -> DataFrame:
    rows = cat.catalog_order(cat.valid_charts(b).withColumn("zoom", F.greatest(F.lit(4), F.least(F.lit(9), geo.zoom_for_scale(c("scale") * 40, (c("south") + c("north")) / 2)))))
    cover = tl.tile_cover(rows.withColumns({"zmin": F.lit(4), "zmax": c("zoom").cast("int")}), carry=("rank",)).withColumn("transp", F.lit(1))
    return tl.top_layer(cover, rows).groupBy("z", "chart_id").agg(F.count("*").alias("tiles"))


add("top_layer_counts", "chart_boxes", flagship,
    f""", v AS (SELECT *, row_number() OVER (ORDER BY scale DESC, path) AS rank, (south + north) / 2 AS lat FROM chart_boxes WHERE scale IS NOT NULL AND name NOT LIKE '%Cover for Chart%'),
    q AS (SELECT chart_id, rank, greatest(4, least(9, {ZOOM.format(s=f"(scale * 40 * (6378137.0 * pi() / 180 / {DEG}))")})) AS zoom FROM v), {COVER},
    w AS (SELECT t.z, t.x, t.y, arg_max(chart_id, rank) AS chart_id FROM t JOIN q USING (chart_id) WHERE t.z <= zoom GROUP BY 1, 2, 3) SELECT z, chart_id, count(*) AS tiles FROM w GROUP BY 1, 2""")  # fmt: skip

# ---- J
add("j1_manifest_diff", "manifest_new manifest_old", reg.manifest_diff, " SELECT region, 'now' AS side FROM manifest_new WHERE region NOT IN (SELECT region FROM manifest_old) UNION ALL SELECT region, 'before' FROM manifest_old WHERE region NOT IN (SELECT region FROM manifest_new)")
add("j2_merge_manifests", "manifest_old manifest_new", reg.merge_manifests, " SELECT * FROM manifest_new UNION ALL SELECT * FROM manifest_old WHERE region NOT IN (SELECT region FROM manifest_new)")
add("j3_union_regions", "chart_boxes", lambda d: reg.union_regions(f3(d), d.filter("chart_id % 5 = 0"), "REGION_WL2"), f"{F3} SELECT region, path FROM got UNION ALL SELECT 'REGION_WL2', path FROM chart_boxes WHERE chart_id % 5 = 0")


def archives(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    d = d.withColumn("stem", F.concat(F.lit("REGION_"), c("id")))
    zdat = d.select(F.concat("stem", F.lit(".zdat")).alias("file"), F.concat("content", F.lit("z")).alias("content"), F.array(F.lit("--v"), text.region_update_sql(c("stem"), c("epoch"))).alias("lines"))
    return d.select(F.concat("stem", F.lit(".gemf")).alias("file"), "content"), zdat


PUB = "concat('http://h/', strftime(make_timestamp(epoch * 1000000), 'TS_%Y-%m-%d_T_%H_%M'), '_', {f})"
add("j4_publish_regions", "archive_files", lambda d: reg.publish_regions(*archives(d), "http://h"),
    f" SELECT 'REGION_' || id AS region, {PUB.format(f=chr(39) + 'REGION_' + chr(39) + ', id, ' + chr(39) + '.gemf' + chr(39))} AS gemf_url, {PUB.format(f=chr(39) + 'REGION_' + chr(39) + ', id, ' + chr(39) + '.zdat' + chr(39))} AS data_url, sha1(content) AS gemf_checksum, sha1(content || 'z') AS data_checksum, CAST(strlen(content) AS BIGINT) AS size_bytes, epoch FROM archive_files")
add("j4_publish_charts", "archive_files", lambda d: reg.publish_charts(d, "http://h"), f" SELECT split_part(file, '.', 1) AS name, {PUB.format(f='file')} AS url, sha1(content) AS check_sum, CAST(strlen(content) AS BIGINT) AS size_bytes, epoch FROM archive_files")
add("j5_update_script", "manifest_old", lambda d: reg.update_script(d).select(c("line_no").cast("long").alias("line_no"), "line"), " SELECT row_number() OVER (ORDER BY region, epoch, size_bytes) AS line_no, 'update regions set latestdate=''' || epoch || ''', size=''' || size_bytes || ''' where name=''' || region || ''';' AS line FROM manifest_old")
add("k5_pyramid_keys", "tile_layers", lambda t: tl.overview_keys(t, 4, 12), ", t AS (SELECT DISTINCT z, x, y FROM tile_layers) SELECT DISTINCT z - CAST(k AS INT) AS z, x >> CAST(k AS INT) AS x, y >> CAST(k AS INT) AS y FROM t, range(0, 9) r(k) WHERE z - k >= 4")
HOLES = """t AS (SELECT z, x, y, max(transp) AS mx, min(CASE WHEN transp <> 1 THEN 0 END) AS hole FROM tile_layers GROUP BY 1, 2, 3), h AS (SELECT z, x, y FROM t WHERE hole = 0),
    kid AS (SELECT z - 1 AS z, x >> 1 AS x, y >> 1 AS y, count(*) AS children FROM t GROUP BY 1, 2, 3),
    up AS (SELECT h.*, CAST(k AS INT) AS k, t.mx FROM h, range(1, 8) r(k), t WHERE t.z = h.z - k AND t.x = h.x >> CAST(k AS INT) AND t.y = h.y >> CAST(k AS INT) AND (k = 1 OR h.z - k + 1 >= 6) QUALIFY row_number() OVER (PARTITION BY h.z, h.x, h.y ORDER BY k) = 1)"""
add("k9_hole_sources", "tile_layers", lambda t: tl.hole_sources(_lowered(t)),
    f""", {HOLES.replace('tile_layers', "(SELECT z, x, y, transp FROM tile_layers UNION ALL SELECT z - 2, x >> 2, y >> 2, transp FROM tile_layers WHERE z = 12 AND x % 3 = 0)")}
    SELECT h.z, h.x, h.y, coalesce(children, 0) AS children, k, coalesce(mx = 1, false) AS usable, CASE WHEN mx = 1 THEN h.x % (1 << k) * (256 >> k) END AS crop_x, CASE WHEN mx = 1 THEN h.y % (1 << k) * (256 >> k) END AS crop_y, CASE WHEN mx = 1 THEN CAST(256 >> k AS INT) END AS crop_size
    FROM h LEFT JOIN up USING (z, x, y) LEFT JOIN kid USING (z, x, y)""")  # fmt: skip


def _lowered(t: DataFrame) -> DataFrame:
    low = t.filter("z = 12 and x % 3 = 0").select((c("z") - 2).alias("z"), F.shiftright("x", 2).alias("x"), F.shiftright("y", 2).alias("y"), "transp")
    return t.select("z", "x", "y", "transp").unionByName(low)


# ---- A, on rows
add("a1_scan_files", "chart_files", lambda d: tables.with_extension(d, ("kap", "tif")).select("file_id", "name", "ext"), " SELECT file_id, regexp_extract(path, '([^/]*)$', 1) AS name, regexp_extract(path, '\\.([^./]*)$', 1) AS ext FROM chart_files WHERE regexp_matches(upper(path), '[^/]\\.(KAP|TIF)$')")
add("a7_mbtiles", "tile_layers", lambda t: tables.mbtiles_rows(t.select("z", "x", "y").distinct()), " SELECT DISTINCT z AS zoom_level, x AS tile_column, (CAST(1 AS BIGINT) << z) - 1 - y AS tile_row FROM tile_layers")
PATHS = "concat('/set', chart_id, '/', z, '/', x, '/', y, CASE WHEN n_bytes % 300 = 0 THEN '.jpg' ELSE '.png' END)"
add("a5_tile_key", "tile_layers", lambda t: t.select(tables.tile_key(F.expr(PATHS)).alias("k")).filter("k.z is not null").select("k.*"), " SELECT 'set' || chart_id AS tileset, z, x, y FROM tile_layers WHERE n_bytes % 300 <> 0")


def a9(d: DataFrame) -> DataFrame:
    rows = cat.catalog_order(cat.valid_charts(d)).withColumns({"date": F.lit("1/1/2020"), "outline": F.lit(""), "depths": F.lit("FEET"), "max_zoom": F.lit(9)})
    return tables.region_script(rows, "REGION_02", 7, "--DBVERSION:3")


A9_HEAD = "'UPDATE regions SET installeddate=''7'' WHERE name=''REGION_02'';' || chr(10) || 'DELETE from charts where region=''REGION_02'';' || chr(10)"
A9_ROW = (
    "'INSERT INTO [charts] ([region], [file], [name], [updated], [scale], [outline], [depths], [zoom]) VALUES (''REGION_02'', ''' || regexp_extract(path, '([^/]*)$', 1) || ''', ''' || replace(name, chr(39), chr(39) || chr(39))"
    " || ''', ''1/1/2020'', ' || scale || ', '''', ''FEET'', ''9'');' || chr(10)"
)
add("a9_region_script", "chart_boxes", a9,
    f""", v AS (SELECT *, row_number() OVER (ORDER BY scale DESC, path) AS rank FROM chart_boxes WHERE scale IS NOT NULL AND name NOT LIKE '%Cover for Chart%')
    SELECT CAST(-2 AS BIGINT) AS line_no, '--DBVERSION:3' || chr(10) AS line UNION ALL SELECT -1, {A9_HEAD} UNION ALL SELECT rank, {A9_ROW} FROM v""")  # fmt: skip
def a12(d: DataFrame) -> DataFrame:
    """The map of regions' files, written as JSON and read again."""
    folder = new_folder(d.sparkSession, "regions")
    tables.write_region_files(f3(d).select("region", "path"), folder)
    return tables.read_region_files(d.sparkSession, folder).groupBy("region").agg(F.count("*").alias("n"), F.min("path").alias("first_path"))


add("a12_region_files", "chart_boxes", a12, f"{F3} SELECT region, count(*) AS n, min(path) AS first_path FROM got GROUP BY region")


# ---- A, through files that the query writes to the shared folder
def chart_file(ext: str) -> Column:
    return F.concat(F.lit("chart_id="), c("chart_id"), F.lit(ext)).alias("name")


def a2(d: DataFrame) -> DataFrame:
    """Chart files with a raster behind their header, one for each chart."""
    folder = new_folder(d.sparkSession, "headers")
    write_files(d.select(chart_file(".KAP"), F.concat("header", F.lit("cut\x1a\u00e9 not a line\nnor this")).alias("value")), folder)
    read = tables.read_chart_headers(d.sparkSession, folder).withColumn("chart_id", F.regexp_extract("path", "chart_id=([0-9]+)", 1).cast("long"))
    return cat.parse_headers(read).select("chart_id", F.size("lines").cast("long").alias("n_lines"), "scale", "projection", "datum")


add("a2_chart_headers", "chart_headers", a2, f" SELECT chart_id, len(string_split(header, chr(10))) - 1 AS n_lines, CAST({line('KNP/SC=([0-9]+)')} AS INT) AS scale, 'MERCATOR' AS projection, 'WGS84' AS datum FROM chart_headers")


def a3(d: DataFrame) -> DataFrame:
    folder = new_folder(d.sparkSession, "catalog")
    tables.write_catalog(cat.build_catalog(headers(d).withColumn("path", F.concat(F.lit("/c/"), c("chart_id"), F.lit(".KAP")))), folder)
    back = tables.read_catalog(d.sparkSession, folder)
    return back.select("path", "name", "scale", "depths", c("rank").cast("long").alias("rank"), F.size("ring").cast("long").alias("n"), F.round(F.get("ring", F.lit(0))["lat"], 6).alias("lat0"))


add("a3_catalog", "chart_headers", a3,
    f""", h AS (SELECT concat('/c/', chart_id, '.KAP') AS path, trim(replace({line('BSB/NA=([^,]*),')}, '''', '')) AS name, CAST({line('KNP/SC=([0-9]+)')} AS INT) AS scale, CASE WHEN contains(header, 'UN=') THEN {line('UN=([^,]*),')} ELSE 'Unknown' END AS depths, round({LATS[0]}, 6) AS lat0 FROM chart_headers)
    SELECT path, name, scale, depths, row_number() OVER (ORDER BY scale DESC, path) AS rank, CAST(4 AS BIGINT) AS n, lat0 FROM h WHERE name NOT LIKE '%Cover for Chart%'""")  # fmt: skip


def a4(d: DataFrame) -> DataFrame:
    folder = new_folder(d.sparkSession, "product")
    d.select(F.concat(F.lit("<x>file name: 1_1.KAP</x>"), F.when(c("node_id") % 2 == 0, F.replace("xml", F.lit("EX_Extent"), F.lit("gmd:EX_Extent"))).otherwise(c("xml")))).write.text(folder)
    return tables.read_product_catalog(d.sparkSession, folder).groupBy("name").agg(F.count("*").alias("n"))


add("a4_product_catalog", "product_texts", a4, " SELECT regexp_extract(xml, 'file name: ([^<]*?\\.KAP)', 1) AS name, count(*) AS n FROM product_texts GROUP BY 1")


def dmm(degrees: Column) -> Column:
    """Degrees as whole degrees and minutes, with the sign before them."""
    size = F.abs(degrees)
    return F.concat(F.when(degrees < 0, "-").otherwise(""), F.lpad(F.floor(size).cast("string"), 3, "0"), F.lit(" "), F.format_string("%.3f", (size - F.floor(size)) * 60))


def a6(layout: str) -> Callable[[DataFrame], DataFrame]:
    """Outlines of all charts as override files in one of the layouts: lines of headers, degrees and minutes, or plain ones,
    which alone list the first point again."""

    def lines() -> Column:
        ring = text.header_ring(F.split("header", "\n"))
        if layout == "dmm":
            return F.array_join(F.transform(F.slice(ring, 1, F.size(ring) - 1), lambda p: F.concat(dmm(p["lat"]), F.lit(","), dmm(p["lng"]))), "\n")
        return c("header") if layout == "ply" else F.array_join(F.transform(ring, lambda p: F.concat(p["lat"], F.lit(","), p["lng"])), "\n")

    def build(d: DataFrame) -> DataFrame:
        folder = new_folder(d.sparkSession, "overrides")
        write_files(dealt(d).select(chart_file(".txt"), lines().alias("value")), folder)
        rings = tables.read_overrides(d.sparkSession, folder, layout)
        return rings.select(F.size("ring").cast("long").alias("n"), F.get("ring", F.lit(0))["lat"].alias("lat0"), F.get("ring", F.lit(1))["lng"].alias("lng1"), (F.get("ring", F.lit(0)) == F.element_at("ring", -1)).alias("closed"), c("key").endswith(".txt").alias("named"))

    return build


A6 = f" SELECT CAST(4 AS BIGINT) AS n, {LATS[0]} AS lat0, {LNGS[1]} AS lng1, true AS closed, {{named}} AS named FROM chart_headers"
add("a6_overrides", "chart_headers", a6("ply"), A6.format(named="true"))
add("a6_overrides_in_minutes", "chart_headers", a6("dmm"), A6.format(named="true"))
add("a6_overrides_plain", "chart_headers", a6("plain"), A6.format(named="false"))


def a7(t: DataFrame) -> DataFrame:
    """Both tables of a tile set's file: tiles by their number of bytes, and metadata."""
    folder = new_folder(t.sparkSession, "mbtiles")
    sets = t.select(F.concat(F.lit("set "), c("chart_id")).alias("tileset"), "z", "x", "y", F.encode(F.lpad(F.lit(""), 3, "x"), "UTF-8").alias("content"))
    about = t.groupBy(F.concat(F.lit("set "), c("chart_id")).alias("tileset")).agg(F.min("z").alias("min_zoom"), F.max("z").alias("max_zoom")).withColumns({"name": F.lit("n"), "bounds": F.lit("b")})
    tables.to_mbtiles_tables(sets, about, folder)
    back = t.sparkSession.read.parquet(f"{folder}/tiles").groupBy("tileset").agg(F.count("*").alias("n"), F.max(F.octet_length("tile_data")).cast("long").alias("bytes"))
    meta = t.sparkSession.read.parquet(f"{folder}/metadata").filter("name in ('minzoom', 'format', 'type')").groupBy("tileset").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "name", "value"))), ",").alias("about"))
    return back.join(meta, "tileset")


add("a7_mbtiles_tables", "tile_layers", a7, f""", r AS (SELECT 'set ' || chart_id AS s, count(*) AS n, min(z) AS z FROM tile_layers GROUP BY 1) SELECT replace(s, ' ', '_') AS tileset, n, CAST(3 AS BIGINT) AS bytes, 'format=png,minzoom=' || z || ',type=overlay' AS about FROM r""")


def padded() -> Column:
    """A tile's content of n_bytes, which tells what tile it is."""
    return F.unhex(F.rpad(F.hex(F.concat_ws(",", "z", "x", "y")), F.lit(2) * c("n_bytes").cast("int"), F.lit("00")))


def a8(t: DataFrame) -> DataFrame:
    """An archive's stream, written and read again: where each piece of header, index and tiles begins, and what it is."""
    folder = new_folder(t.sparkSession, "archive")
    found = ranges(t)
    placed = tl.archive_volumes(tl.tile_offsets(found, sizes(t)), LIMIT)
    tables.write_archive(tables.archive_rows(tl.archive_head(found, placed, SOURCE), placed.withColumn("content", padded())), folder)
    back = tables.read_archive(t.sparkSession, folder)
    return back.select("volume", "part", "seq_no", "at", F.octet_length("bytes").cast("long").alias("size"), F.sha1("bytes").alias("sum"))


PADDED = "(concat(z, ',', x, ',', y)::BLOB || unhex(repeat('00', CAST(n_bytes - length(concat(z, ',', x, ',', y)) AS INT))))"
add("a8_archive", "tile_layers", a8, "")
ORACLE["a8_archive"] = ORACLE["h7_archive_volumes"].rsplit("SELECT z, x, y, CAST", 1)[0] + f""", head AS ({HEAD}), v AS (SELECT *, (SELECT count(*) FROM cuts WHERE v > 0 AND cut <= off) AS volume, row_number() OVER (ORDER BY range_id, seq) - 1 AS seq_no FROM tm)
    SELECT CAST(volume AS INT) AS volume, 3 AS part, seq_no, off - CASE WHEN volume = 0 THEN 0 ELSE min(off) OVER (PARTITION BY volume) END AS "at", n_bytes AS size, sha1{PADDED} AS sum FROM v
    UNION ALL SELECT 0, part, seq_no, "at", length(bytes) // 2, sha1(unhex(bytes)) FROM head"""


def a8_volumes(t: DataFrame) -> DataFrame:
    """An archive of two sources as byte files in volumes, and what a reader finds in them that follows the header alone."""
    path = new_folder(t.sparkSession, "tiles") + ".gemf"
    found, placed = two_sources(t)
    placed = tl.archive_volumes(placed, LIMIT)
    volumes.write_volumes(tables.archive_rows(tl.archive_head(found, placed, TWO), placed.withColumn("content", padded())), path)
    back = volumes.read_volumes(t.sparkSession, path, tiles=5000)
    return back.select("source", "z", "x", "y", F.octet_length("content").cast("long").alias("size"), F.sha1("content").alias("sum"))


add("a8_archive_volumes", "tile_layers", a8_volumes,
    f""", k AS (SELECT chart_id % 2 AS s, z, x, y, max(n_bytes) AS n_bytes FROM tile_layers WHERE transp <> 0 GROUP BY 1, 2, 3, 4)
    SELECT CASE s WHEN 0 THEN '{TWO[0]}' ELSE '{TWO[1]}' END AS source, z, x, y, n_bytes AS size, sha1{PADDED} AS sum FROM k""")  # fmt: skip


def a10(new: DataFrame) -> DataFrame:
    folder = new_folder(new.sparkSession, "manifest")
    tables.write_manifest(new, folder)
    return tables.read_manifest(new.sparkSession, folder, "size_bytes long, epoch long").select(F.lit(1).alias("version"), "region", "size_bytes", "epoch")


add("a10_manifest", "manifest_new", a10, " SELECT 1 AS version, region, size_bytes, epoch FROM manifest_new")


def a11(d: DataFrame) -> DataFrame:
    folder = new_folder(d.sparkSession, "regions")
    tables.write_region_manifest(f3(d).select("region", "path"), folder)
    png = shifted(d).filter("chart_id % 3 = 0").select(F.replace("path", F.lit(".tif"), F.lit(".png")).alias("path"))
    tif = shifted(d).filter("chart_id % 3 < 2 and chart_id % 13 > 2").select("path")
    return tables.read_region_manifest(d.sparkSession, folder, png.distinct(), tif.distinct())


add("a11_region_manifest", "chart_boxes", a11,
    f"""{F3}, png AS (SELECT DISTINCT nm, replace(path, '.tif', '.png') AS png FROM ch WHERE chart_id % 3 = 0), tif AS (SELECT DISTINCT nm, path AS tif FROM ch WHERE chart_id % 3 < 2 AND chart_id % 13 > 2)
    SELECT region, ch.nm AS name, coalesce(png, tif) AS path FROM got JOIN ch USING (chart_id) LEFT JOIN png ON png.nm = ch.nm LEFT JOIN tif ON tif.nm = ch.nm""")  # fmt: skip
