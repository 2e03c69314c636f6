"""Region assignment, duplicates, manifests and publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .steps import cut, dealt, in_order

# fixed values: region polygons, vertices (lat, lng)
POLYGONS = {
    "REGION_UK1": [
        (60.432475243, -6.312084094), (61.7815364, 0.77050051), (55.232640709, 3.514615661), (53.991841279, -1.970770244), (55.318427775, -2.913842661),
        (56.50474705, -4.761153867), (58.677242823, -4.989699171), (60.432475243, -6.312084094),
    ],
    "REGION_UK2": [
        (53.991841279, -1.970770244), (55.232640709, 3.514615661), (51.209816332, 4.979579361), (47.000448924, -4.086128932), (46.952325482, -8.282052045),
        (49.475693247, -7.168619247), (50.806726787, -3.806672546), (51.091490479, -2.355807505), (52.024815432, -0.61793567), (53.991841279, -1.970770244),
    ],
    "REGION_UK3": [
        (60.432475243, -6.312084094), (59.562319205, -15.742039595), (46.723720352, -15.580151947), (46.952325482, -8.282052045), (49.475693247, -7.168619247),
        (51.873368713, -8.840058188), (53.136809109, -7.567761152), (55.213543445, -7.277588144), (55.982797256, -7.210625142), (56.50474705, -4.761153867),
        (58.677242823, -4.989699171), (60.432475243, -6.312084094),
    ],
    "REGION_UK4": [
        (56.50474705, -4.761153867), (55.982797256, -7.210625142), (55.213543445, -7.277588144), (53.136809109, -7.567761152), (51.873368713, -8.840058188),
        (49.475693247, -7.168619247), (50.806726787, -3.801092295), (51.094995182, -2.350227255), (52.024815432, -0.61793567), (53.991841279, -1.970770244),
        (55.318427775, -2.913842661), (56.50474705, -4.761153867),
    ],
    "REGION_WL1": [(20.653346, -75.816650), (27.973699, -71.410607), (27.973699, -81.793212), (20.653346, -81.793212), (20.653346, -75.816650)],
    "REGION_WL2": [(20.653346, -75.816661), (16.445521, -75.816661), (16.445521, -66.040652), (28.030423, -66.040652), (27.030423, -71.381531), (20.653346, -75.816661)],
}
# fixed values: charts that a region leaves out
EXCLUDES = {
    "REGION_UK1": ("4102-0", "0245-0", "1121-0", "2724-0"),
    "REGION_UK2": ("4102-0", "1123-0", "1179-0", "1178-0"),
    "REGION_UK3": ("1123-0",),
    "REGION_UK4": ("2182A-0", "2182B-0", "1407-0", "1125-0_UD", "1127-0", "2656-0"),
}


def region_polygons(spark, polygons: dict = POLYGONS) -> DataFrame:
    return spark.createDataFrame([(r, [{"lat": a, "lng": b} for a, b in ring]) for r, ring in polygons.items()], "region string, ring array<struct<lat:double,lng:double>>")


def region_excludes(spark, excludes: dict = EXCLUDES) -> DataFrame:
    return spark.createDataFrame([(r, n) for r, names in excludes.items() for n in names], "region string, name string")


def edges(ring: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, i + 1).alias("b")))


def in_ring(lat: Column, lng: Column, ring: Column) -> Column:
    """Is the point inside the closed ring? By the number of edges that a ray to the north crosses."""
    crossed = F.filter(
        edges(ring),
        lambda e: ((e["a"]["lng"] > lng) != (e["b"]["lng"] > lng)) & (lat < (e["b"]["lat"] - e["a"]["lat"]) * (lng - e["a"]["lng"]) / (e["b"]["lng"] - e["a"]["lng"]) + e["a"]["lat"]),
    )
    return F.size(crossed) % 2 == 1


def edge_meets_box(e: Column, west: Column, north: Column, east: Column, south: Column) -> Column:
    """Does a segment meet a box, touching included? Their extents overlap, and the box's corners are not all on one side
    of the segment's line."""
    a, b = e["a"], e["b"]
    overlap = (F.least(a["lng"], b["lng"]) <= east) & (F.greatest(a["lng"], b["lng"]) >= west) & (F.least(a["lat"], b["lat"]) <= north) & (F.greatest(a["lat"], b["lat"]) >= south)
    side = lambda lat, lng: (b["lng"] - a["lng"]) * (lat - a["lat"]) - (b["lat"] - a["lat"]) * (lng - a["lng"])
    s = [side(north, west), side(north, east), side(south, east), side(south, west)]
    return overlap & (F.least(*s) <= 0) & (F.greatest(*s) >= 0)


LOW_LEVEL, HIGH_LEVEL = 3, 9  # cells of 45 down to 0.7 degrees
CELL_EDGES = 8  # a cell with more edges is cut in four, down to HIGH_LEVEL


def cell_size(level: Column) -> Column:
    return F.lit(360.0) / F.pow(F.lit(2.0), level)


def cell_box(level: Column, cx: Column, cy: Column) -> tuple[Column, Column, Column, Column]:
    """west, north, east, south of a cell."""
    size = cell_size(level)
    return cx * size - 180, (cy + 1) * size - 180, (cx + 1) * size - 180, cy * size - 180


def in_cells(rows: DataFrame, level: Column, west: Column, north: Column, east: Column, south: Column) -> DataFrame:
    """rows with each cell (level, cx, cy) that a box touches."""
    at = lambda v: F.floor((v + 180) / cell_size(F.col("level"))).cast("long")
    levelled = rows.withColumn("level", level.cast("int"))
    return levelled.withColumn("cx", F.explode(F.sequence(at(west), at(east)))).withColumn("cy", F.explode(F.sequence(at(south), at(north))))


def polygon_cells(regions: DataFrame) -> DataFrame:
    """A cover of each region's polygon (region, ring) by cells of several sizes: region, level, cx, cy and edges, those of the ring that
    meet the cell. Cells without any lie inside: a box that touches one meets the polygon. Cells with many edges are cut in
    four, so a ring of thousands of points is spread over as many small lists as it needs."""
    e = F.col("e")
    low = lambda f, c: f(e["a"][c], e["b"][c])
    box = (low(F.least, "lng"), low(F.greatest, "lat"), low(F.greatest, "lng"), low(F.least, "lat"))
    meets = edge_meets_box(e, *cell_box(F.col("level"), F.col("cx"), F.col("cy")))
    key = ["region", "level", "cx", "cy"]
    pairs = cut(in_cells(regions.select("region", F.explode(edges(F.col("ring"))).alias("e")), F.lit(LOW_LEVEL), *box).filter(meets))
    around = lambda c, f: f(F.transform("ring", lambda p: p[c]))
    whole = in_cells(regions.select("region", around("lng", F.array_min).alias("w"), around("lat", F.array_max).alias("n"), around("lng", F.array_max).alias("e"), around("lat", F.array_min).alias("s")), F.lit(LOW_LEVEL), *(F.col(c) for c in "wnes")).select(key)
    bare = whole.join(pairs.select(key).distinct(), key, "left_anti")
    done = None
    for level in range(LOW_LEVEL, HIGH_LEVEL + 1):
        cells = pairs.groupBy(key).agg(F.collect_list("e").alias("edges"))
        full = cells.filter(F.size("edges") <= CELL_EDGES) if level < HIGH_LEVEL else cells
        done = full if done is None else done.unionByName(full)
        if level == HIGH_LEVEL:
            break
        crowded = cut(cells.filter(F.size("edges") > CELL_EDGES))
        quarters = crowded.select("region", (F.col("level") + 1).alias("level"), (F.col("cx") * 2).alias("_x"), (F.col("cy") * 2).alias("_y"), "edges")
        kids = quarters.withColumn("cx", F.explode(F.array("_x", F.col("_x") + 1))).withColumn("cy", F.explode(F.array("_y", F.col("_y") + 1)))
        pairs = cut(kids.select(*key, F.explode("edges").alias("e")).filter(meets))
        bare = bare.unionByName(kids.select(key).join(pairs.select(key).distinct(), key, "left_anti"))
    west, north, _, _ = cell_box(F.col("level"), F.col("cx"), F.col("cy"))
    inner = bare.join(regions.select("region", "ring"), "region").filter(in_ring(north, west, F.col("ring"))).select(key)
    return done.unionByName(inner.withColumn("edges", F.array().cast(dict(done.dtypes)["edges"])))


def meets_by_cells(boxes: DataFrame, regions: DataFrame) -> DataFrame:
    """_id and region of boxes (_id, _part, west, north, east, south) that meet a region's polygon. Boxes and polygons meet in cells; a
    box in an inner cell needs no test, one in a cell with edges is held against those, and only one that meets none of
    them is looked for in the whole ring."""
    cells = cut(polygon_cells(regions))
    key = ["level", "cx", "cy"]
    above = lambda rows, flag: rows.withColumn("_up", F.explode(F.sequence(F.lit(0), F.col("level") - LOW_LEVEL))).withColumn(flag, F.col("_up") == 0).withColumns({"level": F.col("level") - F.col("_up"), "cx": F.expr("shiftright(cx, _up)"), "cy": F.expr("shiftright(cy, _up)")}).drop("_up")
    far = zip(("_w", "_n", "_e", "_s"), cell_box(F.col("level"), F.col("cx"), F.col("cy")), strict=True)
    leaves = above(cells.withColumns(dict(far)), "_leaf")
    extent = F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south"), F.lit(1e-9))
    level = F.least(F.greatest(F.floor(F.log2(F.lit(360.0) / extent)), F.lit(LOW_LEVEL)), F.lit(HIGH_LEVEL))
    dealt = in_cells(boxes, level, *(F.col(c) for c in ("west", "north", "east", "south")))
    asked = above(dealt, "_own").distinct()
    touch = (F.col("_w") <= F.col("east")) & (F.col("_e") >= F.col("west")) & (F.col("_s") <= F.col("north")) & (F.col("_n") >= F.col("south"))
    pairs = asked.join(leaves, key).filter((F.col("_leaf") | F.col("_own")) & touch)
    box = [F.col(c) for c in ("west", "north", "east", "south")]
    hit = (F.size("edges") == 0) | F.exists("edges", lambda e: edge_meets_box(e, *box))
    told = cut(pairs.groupBy("_id", "_part", "region", "west", "north").agg(F.bool_or(hit).alias("hit")))
    unsure = told.filter("not hit").join(regions.select("region", "ring"), "region").filter(in_ring(F.col("north"), F.col("west"), F.col("ring")))
    return told.filter("hit").select("_id", "region").unionByName(unsure.select("_id", "region")).distinct()


MOST_LEVEL = 16  # slabs down to 0.005 degrees of longitude
SLAB_COPIES = 4  # there are narrower slabs as long as the edges, each listed in every slab that it touches, are at most so many times their number
SLAB_BOXES = 20_000  # boxes a task


def on_map(lng: Column) -> Column:
    return F.least(F.greatest(lng, F.lit(-180.0)), F.lit(180.0))


def slab(n: Column, lng: Column) -> Column:
    """Which of n slabs of longitude a place lies in; the outermost ones hold what lies beyond -180 and 180. It never falls where lng
    grows, so what overlaps shares a slab."""
    return F.least(F.floor((on_map(lng) + 180) / 360 * n), n - 1).cast("long")


def in_slabs(rows: DataFrame, level: Column, west: Column, east: Column) -> DataFrame:
    """rows with each slab from west to east: _slab, 2^level and its number among the 2^level of the level, and _first, is it the western one?"""
    ranged = rows.withColumn("_of", F.pow(F.lit(2.0), level)).withColumns({"_from": slab(F.col("_of"), west), "_to": slab(F.col("_of"), east)})
    at = ranged.withColumn("_at", F.explode(F.sequence("_from", F.greatest("_from", "_to"))))
    return at.withColumns({"_slab": F.col("_of").cast("long") + F.col("_at"), "_first": F.col("_at") == F.col("_from")}).drop("_of", "_from", "_to", "_at")


def near_edges(boxes: DataFrame, regions: DataFrame) -> DataFrame:
    """boxes with each edge of a ring, in plain columns, that shares a slab with them: the edges are broadcast by slabs of all levels, and
    a box meets those of the one or two slabs that it touches, of a level whose slabs are as wide as the box at least. _first: is
    the slab that of the box's western side? An edge is there once for each slab shared."""
    a, b = F.col("e")["a"], F.col("e")["b"]
    plain = {"_lat": a["lat"], "_lng": a["lng"], "_lng2": b["lng"], "_dlat": b["lat"] - a["lat"], "_dlng": b["lng"] - a["lng"]}
    extent = {"_w": F.least(a["lng"], b["lng"]), "_e": F.greatest(a["lng"], b["lng"]), "_s": F.least(a["lat"], b["lat"]), "_n": F.greatest(a["lat"], b["lat"])}
    lined = regions.select("region", F.array_min(F.transform("ring", lambda p: p["lat"])).alias("_low"), F.explode(edges(F.col("ring"))).alias("e")).withColumns(plain | extent).drop("e")
    w, e = F.col("_w"), F.col("_e")
    levels = range(1, MOST_LEVEL + 1)
    copies = lined.agg(F.count("*"), *(F.sum(slab(F.lit(2.0**n), e) - slab(F.lit(2.0**n), w) + 1) for n in levels)).first()
    finest = F.lit(max([0, *(n for n in levels if (copies[n] or 0) <= SLAB_COPIES * copies[0])]))
    listed = in_slabs(lined.withColumn("_level", F.explode(F.sequence(F.lit(0), finest))), F.col("_level"), w, e).drop("_level", "_first")
    west, east = F.col("west"), F.col("east")
    level = F.least(F.floor(F.log2(360 / F.greatest(on_map(east) - on_map(west), F.lit(1e-9)))), finest)
    return in_slabs(dealt(boxes, SLAB_BOXES), level, west, east).join(F.broadcast(listed), "_slab")


def meets_by_slabs(boxes: DataFrame, regions: DataFrame) -> DataFrame:
    """_id and region of boxes (_id, _part, west, north, east, south) that meet a region's polygon: an edge meets the box, or the box's
    corner lies inside the ring. (A ring inside the box has edges that meet it.) The tests are those of edge_meets_box and in_ring
    with what depends on the edge alone worked out before; only what passes a cheap part of them is tested in full."""
    west, north, east, south = (F.col(c) for c in ("west", "north", "east", "south"))
    lat, lng, dlat, dlng = (F.col(c) for c in ("_lat", "_lng", "_dlat", "_dlng"))
    overlap = (F.col("_w") <= east) & (F.col("_e") >= west) & (F.col("_s") <= north) & (F.col("_n") >= south)
    side = [dlng * (y - lat) - dlat * (x - lng) for y, x in ((north, west), (north, east), (south, east), (south, west))]
    meets = overlap & (F.least(*side) <= 0) & (F.greatest(*side) >= 0)
    spans = F.col("_first") & (F.col("_low") <= north) & ((lng > west) != (F.col("_lng2") > west))
    above = spans & (north < dlat * (west - lng) / dlng + lat)
    odd = lambda part: F.count_if(above & (F.col("_part") == part)) % 2 == 1
    told = near_edges(boxes, regions).filter(overlap | spans).groupBy("_id", "region").agg((F.bool_or(meets) | odd(0) | odd(1)).alias("hit"))
    return told.filter("hit").drop("hit")


def split_boxes(rows: DataFrame) -> DataFrame:
    """rows with one box each (_part, west, north, east, south), or two where west lies beyond east: up to the dateline, and on from it."""
    box = lambda part, west, east: F.struct(F.lit(part).alias("_part"), west.alias("west"), F.col("north").alias("north"), east.alias("east"), F.col("south").alias("south"))
    both = F.array(box(0, F.col("west"), F.lit(180.0)), box(1, F.lit(-180.0), F.col("east")))
    boxes = F.when(F.col("west") > F.col("east"), both).otherwise(F.array(box(0, F.col("west"), F.col("east"))))
    return rows.select("_id", F.explode(boxes).alias("_b")).select("_id", "_b.*")


def assign_regions(charts: DataFrame, regions: DataFrame, excludes: DataFrame, most: int = 64, most_points: int = 4096) -> DataFrame:
    """charts (path, west, north, east, south) with each region whose polygon their box meets; one with west beyond east crosses the
    dateline.

    Charts whose name starts with 40 have none, nor those that the region excludes. Up to `most` polygons of most_points points
    together are broadcast, see meets_by_slabs. Beyond, see meets_by_cells. Rings are closed and stay within -180 to 180 degrees."""
    named = cut(charts.withColumn("name_", text.chart_base_name(F.col("path"))).filter(~F.col("name_").startswith("40")).withColumn("_id", F.monotonically_increasing_id()))
    boxes = split_boxes(named)
    size = regions.agg(F.count("*"), F.sum(F.size("ring"))).first()
    small = size[0] <= most and (size[1] or 0) <= most_points
    met = meets_by_slabs(boxes, regions) if small else meets_by_cells(boxes, regions)
    gone = excludes.withColumnRenamed("name", "name_")
    return named.join(met, "_id").drop("_id").join(gone, ["region", "name_"], "left_anti")


def region_match_counts(assigned: DataFrame, charts: DataFrame) -> DataFrame:
    """Matches of each region, with all matches and the charts left over (matches count, so this is clamped at 0)."""
    per = assigned.groupBy("region").agg(F.count("*").alias("matched"))
    totals = charts.agg(F.count("*").alias("charts")).crossJoin(assigned.agg(F.count("*").alias("total")))  # one row each
    return per.crossJoin(F.broadcast(totals)).select("region", "matched", "total", F.greatest(F.col("charts") - F.col("total"), F.lit(0)).alias("skipped"))


def stamped(files: DataFrame) -> DataFrame:
    return files.withColumn("stamp", text.file_stamp(F.col("path")))


def duplicate_stamps(files: DataFrame) -> DataFrame:
    """Stamps that more than one file has, with their paths."""
    return stamped(files).groupBy("stamp").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("path")).alias("paths")).filter("n > 1")


def has_duplicates(files: DataFrame) -> bool:
    return not duplicate_stamps(files).isEmpty()


def dedup_charts(files: DataFrame) -> DataFrame:
    """files with stamp and kept: of a stamp's files the plain one stays, else one with _W, else one with _UD; equals by path."""
    base = text.chart_base_name(F.col("path"))
    kind = F.when(~base.contains("_"), 0).when(base.contains("_W"), 1).when(base.contains("_UD"), 2).otherwise(3)
    w = Window.partitionBy("stamp").orderBy(kind, "path", *(c for c in files.columns if c != "path"))
    return stamped(files).withColumn("kept", F.row_number().over(w) == 1)


def manifest_diff(now: DataFrame, before: DataFrame, name: str = "region") -> DataFrame:
    """Names on one side only, and on which."""
    a, b = now.select(name).distinct(), before.select(name).distinct()
    return a.join(b, name, "left_anti").withColumn("side", F.lit("now")).unionByName(b.join(a, name, "left_anti").withColumn("side", F.lit("before")))


def merge_manifests(old: DataFrame, new: DataFrame, key: str = "region") -> DataFrame:
    """new's rows, and old's of other keys."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"))


def union_regions(box_matches: DataFrame, product_files: DataFrame, region: str) -> DataFrame:
    """(region, path): the matches, and for one region another's product files as well; duplicates stay."""
    return product_files.select(F.lit(region).alias("region"), "path").unionByName(box_matches.select("region", "path"))


def publish_regions(archives: DataFrame, metas: DataFrame, base_url: str = "") -> DataFrame:
    """Per archive (file, content) with its metadata (file, content, lines): region, both addresses and checksums, size, epoch."""
    stem = lambda c: F.substring_index(c, ".", 1)
    m = metas.select(stem(F.col("file")).alias("stem"), F.col("file").alias("m_file"), text.checksum(F.col("content")).alias("data_checksum"), text.installed_epoch(F.col("lines")).try_cast("long").alias("epoch"))
    a = archives.select(stem(F.col("file")).alias("stem"), "file", text.checksum(F.col("content")).alias("gemf_checksum"), F.octet_length("content").cast("long").alias("size_bytes"))
    url = lambda f: F.concat(F.lit(f"{base_url}/"), text.publish_name(F.col("epoch"), F.col(f)))
    return a.join(m, "stem").select(text.region_from_file(F.col("file")).alias("region"), url("file").alias("gemf_url"), url("m_file").alias("data_url"), "gemf_checksum", "data_checksum", "size_bytes", "epoch")


def publish_charts(files: DataFrame, base_url: str = "") -> DataFrame:
    """Per tile set (file, content, epoch): name, address, checksum, size, epoch."""
    return files.select(
        F.substring_index("file", ".", 1).alias("name"), F.concat(F.lit(f"{base_url}/"), text.publish_name(F.col("epoch"), F.col("file"))).alias("url"), text.checksum(F.col("content")).alias("check_sum"),
        F.octet_length("content").cast("long").alias("size_bytes"), "epoch",
    )


def update_script(archives: DataFrame) -> DataFrame:
    """archives (region, epoch, size_bytes) as numbered UPDATE lines, by region."""
    line = F.format_string("update regions set latestdate='%s', size='%s' where name='%s';", F.col("epoch").cast("string"), F.col("size_bytes").cast("string"), F.col("region"))
    return in_order(archives, "region", "epoch", "size_bytes").select((F.col("place") + 1).cast("int").alias("line_no"), line.alias("line"))


def burns_by_chart(names: DataFrame) -> DataFrame:
    """Per chart its burn rectangles in order of score, then place."""
    b = names.withColumn("b", text.parse_burn_name(F.col("file"))).select("b.*")
    return b.groupBy("chart").agg(F.sort_array(F.collect_list(F.struct("score", "x_off", "y_off", "crest"))).alias("burns"))
