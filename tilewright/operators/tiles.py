"""Tiles as rows: covers, layers, completeness, ancestors, rectangles, offsets and volumes.

A tile row has (chart_id,) z, x, y; transp is 1 for an opaque tile, 0 for an empty one and -1 for a mixed one, so that
pixels need not be read or shuffled for any of this."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions import tilemath as tm
from .steps import cut, in_order

KEY = ("z", "x", "y")


def drop_transparent(tiles: DataFrame) -> DataFrame:
    return tiles.filter(F.col("transp") != 0)


BLOCK_SIDE = 64  # rows and columns of tiles that one row of blocks stands for
TASK_TILES = 1 << 17


def cover_blocks(boxes: DataFrame, overshoot: bool = False, carry: tuple[str, ...] = (), side: int = BLOCK_SIDE) -> DataFrame:
    """boxes by zoom and block of side x side tiles: chart_id, z, xa, xb, ya, yb. A box with west beyond east has the columns from west
    to the edge and from the edge to east."""
    top = F.col("zmax") + (1 if overshoot else 0)
    zoomed = boxes.filter(F.col("zmin") <= top).withColumn("z", F.explode(F.sequence(F.col("zmin"), top)))
    bounds = tm.bounds_to_tile_bounds(F.col("west"), F.col("north"), F.col("east"), F.col("south"), F.col("z"))
    b = zoomed.select("chart_id", *carry, F.col("z").cast("int").alias("z"), bounds.alias("b")).select("chart_id", *carry, "z", "b.x_min", "b.x_max", "b.y_min", "b.y_max", "b.wraps")
    edge = tm.map_size_tiles(F.col("z")) - 1
    run = lambda a, o: F.struct(a.cast("long").alias("x1"), o.cast("long").alias("x2"))
    runs = F.when(F.col("wraps"), F.array(run(F.col("x_min"), edge), run(F.lit(0), F.col("x_max")))).otherwise(F.array(run(F.col("x_min"), F.col("x_max"))))
    ranged = b.select("chart_id", *carry, "z", "y_min", "y_max", F.explode(runs).alias("r")).select("chart_id", *carry, "z", "y_min", "y_max", "r.*").filter("x1 <= x2 and y_min <= y_max")
    starts = lambda a, o: F.explode(F.sequence(F.col(a), F.col(o), F.lit(side)))
    cells = ranged.withColumn("xa", starts("x1", "x2")).withColumn("ya", starts("y_min", "y_max"))
    end = lambda a, o: F.least(F.col(a) + side - 1, F.col(o))
    return cells.select("chart_id", *carry, "z", "xa", end("xa", "x2").alias("xb"), "ya", end("ya", "y_max").alias("yb"))


def tile_cover(boxes: DataFrame, overshoot: bool = False, carry: tuple[str, ...] = (), side: int = BLOCK_SIDE, task_tiles: int = TASK_TILES) -> DataFrame:
    """boxes (chart_id, west, north, east, south, zmin, zmax) as rows chart_id, z, x, y: all tiles that a box touches.

    A world chart has a million times a harbour's tiles. So boxes become blocks of tiles first (see cover_blocks), and where
    these stand for more than task_tiles tiles together, which is counted before, blocks are dealt out evenly: as many
    partitions as have task_tiles each. overshoot: one zoom more than zmax, for work that throws it away. carry: other
    columns that each tile is to have."""
    blocks = cover_blocks(boxes, overshoot, carry, side)
    tiles = blocks.agg(F.sum((F.col("xb") - F.col("xa") + 1) * (F.col("yb") - F.col("ya") + 1))).first()[0] or 0
    if tiles > task_tiles:
        blocks = blocks.repartition(-(-tiles // task_tiles))
    columns = blocks.withColumn("x", F.explode(F.sequence("xa", "xb")))
    return columns.select("chart_id", *carry, "z", "x", F.explode(F.sequence("ya", "yb")).alias("y"))


def with_rank(tiles: DataFrame, catalog: DataFrame) -> DataFrame:
    """tiles with their chart's rank; those that carry it already stay as they are."""
    return tiles if "rank" in tiles.columns else tiles.join(catalog.select("chart_id", "rank"), "chart_id")


def merge_layers(tiles: DataFrame, catalog: DataFrame) -> DataFrame:
    """The layers of each tile that show: ranked by the catalog, from the last opaque one upward, without empty ones.
    Pruning on metadata leaves few layers a tile before any pixels move."""
    here = Window.partitionBy(*KEY)
    ranked = with_rank(drop_transparent(tiles), catalog).withColumn("_o", F.max(F.when(F.col("transp") == 1, F.col("rank"))).over(here))
    return ranked.filter(F.col("_o").isNull() | (F.col("rank") >= F.col("_o"))).drop("_o")


def top_layer(tiles: DataFrame, catalog: DataFrame) -> DataFrame:
    """z, x, y and the chart of the highest rank that is not empty there. An aggregate with map-side combine."""
    return with_rank(drop_transparent(tiles), catalog).groupBy(*KEY).agg(F.max_by("chart_id", "rank").alias("chart_id"), F.max("rank").alias("rank"))


def column_visibility(tiles: DataFrame) -> DataFrame:
    """Per chart, zoom and column: has it a tile that is not empty?"""
    return tiles.groupBy("chart_id", "z", "x").agg(F.bool_or(F.col("transp") != 0).alias("visible"))


def verify_catalog(catalog: DataFrame, tiles: DataFrame) -> DataFrame:
    """Each chart of the catalog with ok and a reason: no tiles, or a column that is all empty. Reads metadata only."""
    seen = column_visibility(tiles).groupBy("chart_id").agg(F.countDistinct("z").alias("zooms"), F.sum(F.when(~F.col("visible"), 1).otherwise(0)).alias("blank"))
    joined = catalog.select("chart_id").join(seen, "chart_id", "left")
    reason = F.when(F.col("zooms").isNull(), "no tiles").when(F.col("blank") > 0, "empty column").otherwise("")
    return joined.select("chart_id", (reason == "").alias("ok"), reason.alias("reason"), F.coalesce("zooms", F.lit(0)).alias("zooms"), F.coalesce("blank", F.lit(0)).alias("blank"))


def verify_optimized(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: counts before and after, the keys missing on either side, and whether the sets are equal and not empty."""
    a, b = before.select(*KEY).distinct().withColumn("a", F.lit(1)), after.select(*KEY).distinct().withColumn("b", F.lit(1))
    both = a.join(b, list(KEY), "full").agg(F.count("a").alias("n_before"), F.count("b").alias("n_after"), F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("missing"))
    equal = (F.col("n_before") == F.col("n_after")) & (F.col("n_before") > 0)
    return both.withColumn("counts_equal", equal).withColumn("sets_equal", equal & (F.col("missing") == 0))


def resume_missing(wanted: DataFrame, existing: DataFrame, key: tuple[str, ...] = ("chart_id", *KEY)) -> DataFrame:
    return wanted.join(existing.select(*key), list(key), "left_anti")


def ancestor_codes(keys: DataFrame, *by: str) -> DataFrame:
    """Different keys z, x, y with asks (true: an ancestor is looked for, false: the tile may be one) and the columns `by`, and code,
    their place along a Z curve."""
    typed = keys.select(*by, F.col("z").cast("int").alias("z"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "asks").distinct()
    shift = F.pow(F.lit(4.0), F.lit(tm.Z_ORDER_ZOOM) - F.col("z")).cast("long")
    return typed.withColumn("code", tm.z_order(F.col("x"), F.col("y")) * shift)


def nearest_ancestor(most: int, least_zoom: int) -> Column:
    """How many levels up the nearest ancestor of a row (z, code) is, from _last: by zoom, the code of the last tile of the pool
    that came before. Null if there is none, or it lies behind a missing level below least_zoom."""

    def at(k: int) -> Column:
        bits = f"(2 * ({tm.Z_ORDER_ZOOM} - z + {k}))"
        may = (F.col("z") >= k) & (F.lit(k == 1) | (F.col("z") - k + 1 >= least_zoom))
        return may & (F.expr(f"shiftleft(shiftright(code, {bits}), {bits})") == F.element_at("_last", F.col("z") - k))

    return F.coalesce(*(F.when(at(k), k) for k in range(1, most + 1)))


def ancestor_lookup(tiles: DataFrame, pool: DataFrame, most: int = 7, least_zoom: int = 6) -> DataFrame:
    """tiles with the nearest ancestor in pool: k levels up, and its key. Levels are asked for one after the other up to
    `most`; going past a missing one needs its zoom to be least_zoom or more. Tiles without any have nulls.

    Along a Z curve a tile's ancestors come before it, and of each zoom the last one seen is the only one that can be an
    ancestor. So tiles and pool are sorted together once, by ranges of the curve, and one pass keeps the last place of each
    zoom; what is open where a partition begins comes from a table of a row a partition. A tile is one row throughout, and
    an ancestor above millions of tiles is one, too."""
    both = ancestor_codes(tiles.select(*KEY, F.lit(True).alias("asks")).unionByName(pool.select(*KEY, F.lit(False).alias("asks"))))
    dealt = cut(both.repartitionByRange("code", "z", "asks").withColumn("_part", F.spark_partition_id()))
    levels = [r[0] for r in dealt.filter("not asks").select("z").distinct().orderBy("z").collect()]  # at most 31
    if not levels:
        return tiles.select("*", *(F.lit(None).cast(t).alias(n) for n, t in (("k", "int"), ("az", "int"), ("ax", "long"), ("ay", "long"))))
    of = lambda z: F.when(~F.col("asks") & (F.col("z") == z), F.col("code"))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    ends = dealt.groupBy("_part").agg(*(F.max(of(z)).alias(f"_e{z}") for z in levels))
    opened = ends.select("_part", *(F.max(f"_e{z}").over(upto).alias(f"_o{z}") for z in levels))
    here = Window.partitionBy("_part").orderBy("code", "z", "asks")
    seen = dealt.select("*", *(F.max(of(z)).over(here).alias(f"_s{z}") for z in levels)).filter("asks").join(F.broadcast(opened), "_part", "left")
    last = F.create_map(*(x for z in levels for x in (F.lit(z), F.greatest(f"_s{z}", f"_o{z}"))))
    found = seen.withColumn("_last", last).select(*KEY, nearest_ancestor(most, least_zoom).alias("k")).filter("k is not null")
    half = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("k"))).cast("long")
    best = found.select(*KEY, "k", (F.col("z") - F.col("k")).cast("int").alias("az"), half("x").alias("ax"), half("y").alias("ay"))
    return tiles.join(best, list(KEY), "left")


def children_lookup(tiles: DataFrame, pool: DataFrame) -> DataFrame:
    """Rows of tiles with each of their children in pool: cx, cy, and quadrant (0 to 3, columns first)."""
    kids = pool.select(*(F.col(c).alias(f"c{c}") for c in KEY)).distinct().withColumns({"z": F.col("cz") - 1, "x": F.shiftright("cx", 1), "y": F.shiftright("cy", 1)})
    return tiles.join(kids, list(KEY)).withColumn("quadrant", ((F.col("cx") % 2) * 2 + F.col("cy") % 2).cast("int")).drop("cz")


def burn_rects_to_tiles(rects: DataFrame, size: int = 256) -> DataFrame:
    """rects (id, x_off, y_off, width, height) with each grid cell (cell_x, cell_y) that they touch."""
    cells = lambda o, n: F.sequence(F.floor(F.col(o) / size), F.floor((F.col(o) + F.col(n) - 1) / size))
    return rects.filter("width > 0 and height > 0").withColumn("cell_x", F.explode(cells("x_off", "width"))).withColumn("cell_y", F.explode(cells("y_off", "height")))


def column_ysets(tiles: DataFrame) -> DataFrame:
    """Per zoom and column the sorted rows that it has."""
    return tiles.groupBy("z", "x").agg(F.sort_array(F.collect_set("y")).alias("ys"))


def y_runs(tiles: DataFrame) -> DataFrame:
    """Per zoom and column its maximal runs of rows: y_min, y_max. Gaps and islands, by a window over one column."""
    w = Window.partitionBy("z", "x").orderBy("y")
    keyed = tiles.select(*KEY).distinct().withColumn("g", F.col("y") - F.row_number().over(w))
    return keyed.groupBy("z", "x", "g").agg(F.min("y").alias("y_min"), F.max("y").alias("y_max")).drop("g")


def xs_by_yset(tiles: DataFrame) -> DataFrame:
    """Per zoom and set of rows, written as its list of runs, the columns that share it. A run list stands for the set and
    is short where the set is long."""
    runs = y_runs(tiles).groupBy("z", "x").agg(F.sort_array(F.collect_list(F.struct("y_min", "y_max"))).alias("runs"))
    return runs.groupBy("z", "runs").agg(F.sort_array(F.collect_list("x")).alias("xs"))


def x_runs(tiles: DataFrame) -> DataFrame:
    """Per zoom and set of rows its maximal runs of columns: x_min, x_max, with the set's runs."""
    runs = y_runs(tiles).groupBy("z", "x").agg(F.sort_array(F.collect_list(F.struct("y_min", "y_max"))).alias("runs"))
    w = Window.partitionBy("z", "runs").orderBy("x")
    keyed = runs.withColumn("g", F.col("x") - F.row_number().over(w))
    return keyed.groupBy("z", "runs", "g").agg(F.min("x").alias("x_min"), F.max("x").alias("x_max")).drop("g")


def tile_rectangles(tiles: DataFrame, source_index: int = 0) -> DataFrame:
    """Disjoint rectangles z, x_min, x_max, y_min, y_max that hold just the tiles."""
    return x_runs(tiles).select("z", "x_min", "x_max", F.explode("runs").alias("r")).select("z", "x_min", "x_max", "r.*", F.lit(source_index).alias("source_index"))


def zoom_bounds(tiles: DataFrame) -> DataFrame:
    """The bounding rectangle of each zoom, holes included."""
    return tiles.groupBy("z").agg(F.min("x").alias("x_min"), F.max("x").alias("x_max"), F.min("y").alias("y_min"), F.max("y").alias("y_max"))


def tile_counts(tiles: DataFrame) -> DataFrame:
    """Tiles of each zoom, and of all with z null."""
    return tiles.select(*KEY).distinct().rollup("z").agg(F.count("*").alias("n"))


def skip_zooms(tiles: DataFrame) -> DataFrame:
    """tiles without each chart's second, fourth, ... zoom from the top, if its two highest are neighbours."""
    zooms = tiles.select("chart_id", "z").distinct()
    w = Window.partitionBy("chart_id").orderBy(F.col("z").desc())
    numbered = zooms.withColumn("i", F.row_number().over(w)).withColumn("second", F.max(F.when(F.col("i") == 2, F.col("z"))).over(Window.partitionBy("chart_id"))).withColumn("first", F.max("z").over(Window.partitionBy("chart_id")))
    kept = numbered.filter(~F.coalesce((F.col("first") - F.col("second") == 1) & (F.col("i") % 2 == 0), F.lit(False)))
    return tiles.join(kept.select("chart_id", "z"), ["chart_id", "z"], "left_semi")


def source_list_size(sources: list[str]) -> int:
    """Bytes that an archive's list of sources takes."""
    return sum(8 + len(name.encode()) for name in sources)


def range_offsets(rects: DataFrame, source_list_size: int, uid: int = 0) -> DataFrame:
    """rects with range_id (by source, zoom, x_min, y_min), n tiles, first_tile, offset (the address of the range's index entries)
    and header_size. source_list_size: bytes that the archive's list of sources takes."""
    n = (F.col("x_max") - F.col("x_min") + 1) * (F.col("y_max") - F.col("y_min") + 1)
    by = ("source_index", "z", "x_min", "y_min") if "source_index" in rects.columns else ("z", "x_min", "y_min")
    listed = in_order(rects.withColumn("n", n), *by, place="range_id", sums={"first_tile": "n"})
    whole = listed.agg(F.count("*").alias("_ranges"), F.sum("n").alias("_tiles"))  # one row
    pre = F.lit(uid + 16 + source_list_size) + F.col("_ranges") * 32
    return listed.crossJoin(F.broadcast(whole)).withColumn("offset", pre + F.col("first_tile") * 12).withColumn("header_size", pre + F.col("_tiles") * 12).drop("_ranges", "_tiles")


def tiles_in_ranges(ranges: DataFrame, sizes: DataFrame) -> DataFrame:
    """sizes (z, x, y, n_bytes, and source_index where there are several) with their range and place: ranges are spread to tiles,
    which meet by key."""
    spread = ranges.withColumn("x", F.explode(F.sequence("x_min", "x_max"))).withColumn("y", F.explode(F.sequence("y_min", "y_max")))
    seq = (F.col("x") - F.col("x_min")) * (F.col("y_max") - F.col("y_min") + 1) + F.col("y") - F.col("y_min")
    by = [*KEY, "source_index"] if "source_index" in sizes.columns else list(KEY)
    return sizes.join(spread.select(*by, "range_id", seq.alias("seq"), (F.col("first_tile") + seq).alias("tile_no"), "header_size"), by)


def tile_offsets(ranges: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each tile's offset in the archive: header, then all tiles by range, column and row. A range of a million tiles is
    spread over as many partitions as it needs; see in_order."""
    placed = in_order(tiles_in_ranges(ranges, sizes), "range_id", "seq", sums={"_before": "n_bytes"})
    return placed.withColumn("offset", F.col("header_size") + F.col("_before")).drop("_before", "place")


LONGS = "offset long, end long, jump long"


def _sorted(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    offset, end, jump = (table.column(c).to_numpy() for c in ("offset", "end", "jump"))
    order = np.lexsort((end, offset))
    return offset[order], end[order], jump[order]


def volume_cuts(offsets: DataFrame, limit: int, fan: int = 4, uid: int = 0) -> DataFrame:
    """offset: where a new volume begins, at the first tile that would pass the limit, counted from the last cut; the first volume's
    uid, bytes that stand before the header, is not counted.

    Each cut depends on the last one, so stretches of the archive tell where a volume leads that has its first cut at any of the
    tiles at the stretch's begin: the last cut in the stretch. Tables of `fan` stretches make one of a longer stretch, level
    by level up to the whole archive; from there the true cuts are handed down again. A task holds the narrow rows of the
    tiles of `fan` volumes, and levels grow with the logarithm of the number of volumes."""
    rows = cut(offsets.select("offset", (F.col("offset") + F.col("n_bytes")).alias("end"), F.col("offset").alias("jump")))
    top = rows.agg(F.max("offset")).first()[0]
    levels, width = [rows], limit * fan

    def next_cut(offset: np.ndarray, end: np.ndarray, start: np.ndarray | int) -> np.ndarray:
        """Which tile opens the volume after one that begins at start, which is -1 before the first cut."""
        return np.maximum(np.searchsorted(end, np.maximum(start, uid) + limit, side="right"), np.searchsorted(offset, start, side="right"))

    def lead_on(width: int):
        def run(key: tuple, table: pa.Table) -> pa.Table:
            offset, end, jump = _sorted(table)
            entry = offset < key[0].as_py() * width + limit + uid
            entry[0] = True
            at = jump[entry]
            while True:
                i = next_cut(offset, end, at)
                more = i < len(offset)
                if not more.any():
                    break
                at[more] = jump[i[more]]
            return pa.table({"offset": offset[entry], "end": end[entry], "jump": at})

        return run

    def hand_down(part: int | None):
        """From what a stretch begins with: what its parts of that width begin with, or (for None) all cuts in it."""

        def run(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
            offset, end, jump = _sorted(table)
            at, found, last = told.column("start")[0].as_py(), [], -1
            i = int(next_cut(offset, end, at))
            for place, stretch in enumerate((offset // part).tolist()) if part else ():
                if stretch != last:
                    found.append((stretch, at))
                    last = stretch
                if place == i:
                    at = int(jump[i])
                    i = int(next_cut(offset, end, at))
            while not part and i < len(offset):
                at = int(offset[i])
                found.append((at, at))
                i = int(next_cut(offset, end, at))
            return pa.table({"_stretch": pa.array([a for a, _ in found], pa.int64()), "start": pa.array([b for _, b in found], pa.int64())})

        return run

    by = lambda width: F.expr(f"offset div {width}")
    while top is not None and top >= width:
        levels.append(cut(levels[-1].withColumn("_stretch", by(width)).groupBy("_stretch").applyInArrow(lead_on(width), LONGS)))
        width *= fan
    told = rows.sparkSession.createDataFrame([(0, -1)], "_stretch long, start long")
    for i in reversed(range(len(levels))):
        stretches = levels[i].withColumn("_stretch", by(width)).groupBy("_stretch")
        told = cut(stretches.cogroup(told.groupBy("_stretch")).applyInArrow(hand_down(width // fan if i else None), "_stretch long, start long"))
        width //= fan
    return told.select(F.col("start").alias("offset"))


def archive_volumes(offsets: DataFrame, limit: int, uid: int = 0) -> DataFrame:
    """offsets with volume and at, the place in it: a tile opens a new one when it would pass the limit; the first volume holds the
    header too. Tiles meet their volume by the stretch of `limit` bytes in which they lie."""
    offsets = cut(offsets)
    numbered = in_order(volume_cuts(offsets, limit, uid=uid), "offset", place="volume").select((F.col("volume") + 1).cast("int").alias("volume"), F.col("offset").alias("_from"))
    volumes = numbered.unionByName(offsets.sparkSession.createDataFrame([(0, 0)], "volume int, _from long"))
    after = volumes.select((F.col("volume") - 1).alias("volume"), F.col("_from").alias("_to"))
    top = offsets.agg((F.max("offset") + 1).alias("_top"))  # one row
    spans = volumes.join(after, "volume", "left").crossJoin(F.broadcast(top)).withColumn("_to", F.coalesce("_to", "_top")).drop("_top").filter("_to > _from")
    spread = spans.withColumn("_stretch", F.explode(F.sequence(F.expr(f"_from div {limit}"), F.expr(f"(_to - 1) div {limit}"))))
    joined = offsets.withColumn("_stretch", F.expr(f"offset div {limit}")).join(spread, "_stretch").filter("offset >= _from and offset < _to")
    return joined.withColumn("at", F.col("offset") - F.col("_from")).drop("_stretch", "_from", "_to")


def archive_head(ranges: DataFrame, offsets: DataFrame, sources: str | list[str], tile_size: int = 256, uid: bytes = b"") -> DataFrame:
    """The archive's header as rows part, seq_no, bytes, at: 0 what comes first (a uid if there is one, version 4, tile size,
    sources, how many ranges), 1 a range each, 2 the offset and length of a tile each, all big-endian. sources: names, by
    source_index."""
    number = lambda v, size: text.uint_be(v.cast("long"), size)
    names = [sources] if isinstance(sources, str) else sources
    count = ranges.agg(F.count("*").alias("n"))
    listed = [x for i, name in enumerate(names) for x in (number(F.lit(i), 4), number(F.lit(len(name.encode())), 4), F.lit(name.encode()))]
    first = F.concat(F.lit(uid), *(number(F.lit(v), 4) for v in (4, tile_size, len(names))), *listed, number(F.col("n"), 4))
    entry = F.concat(*(number(F.col(c), 4) for c in ("z", "x_min", "x_max", "y_min", "y_max", "source_index")), number(F.col("offset"), 8))
    part = lambda d, i, no, data, at: d.select(F.lit(i).alias("part"), no.cast("long").alias("seq_no"), data.alias("bytes"), at.cast("long").alias("at"))
    index = F.concat(number(F.col("offset"), 8), number(F.col("n_bytes"), 4))
    begin = F.lit(len(uid) + 16 + source_list_size(names))
    pre = F.col("range_offset") - F.col("first_tile") * 12  # where the index begins
    placed = offsets.crossJoin(F.broadcast(ranges.select(F.col("offset").alias("range_offset"), "first_tile").filter("first_tile = 0").limit(1)))
    rows = part(count, 0, F.lit(0), first, F.lit(0)).unionByName(part(ranges, 1, F.col("range_id"), entry, begin + F.col("range_id") * 32))
    return rows.unionByName(part(placed, 2, F.col("tile_no"), index, pre + F.col("tile_no") * 12))


def archive_order(tiles: DataFrame) -> DataFrame:
    """tiles by range and place: range-partitioned, into as many partitions as the session and the size ask for, and sorted within
    them."""
    return tiles.repartitionByRange("range_id", "seq").sortWithinPartitions("range_id", "seq")


def overview_keys(tiles: DataFrame, zmin: int, zmax: int) -> DataFrame:
    """The keys of a pyramid: each tile and all its ancestors down to zmin. One shift per level, then distinct: no loop."""
    tiles = tiles.filter(F.col("z").between(zmin, zmax))
    up = tiles.select(*KEY).distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.col("z") - zmin)))
    half = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("k"))).cast("long")
    return up.select((F.col("z") - F.col("k")).cast("int").alias("z"), half("x").alias("x"), half("y").alias("y")).distinct()


def hole_sources(tiles: DataFrame) -> DataFrame:
    """For each tile with transparency what its holes are filled from: how many of its four children there are, and the
    nearest ancestor with the crop (crop_x, crop_y, crop_size of 256) that lies under it. An ancestor that is not opaque
    is no source."""
    holes = tiles.filter(F.col("transp") != 1).select(*KEY).distinct()
    kids = children_lookup(holes, tiles).groupBy(*KEY).agg(F.count("*").alias("children"))
    above = ancestor_lookup(holes, tiles)
    opaque = tiles.groupBy(*KEY).agg(F.max("transp").alias("t")).filter("t = 1").select(F.col("z").alias("az"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.lit(True).alias("usable"))
    size = (F.lit(256) / F.pow(F.lit(2.0), F.col("k"))).cast("int")
    part = lambda c: (F.pmod(F.col(c), F.pow(F.lit(2.0), F.col("k")).cast("long")) * size).cast("long")
    full = above.join(opaque, ["az", "ax", "ay"], "left").join(kids, list(KEY), "left")
    usable = F.coalesce("usable", F.lit(False))
    return full.select(*KEY, F.coalesce("children", F.lit(0)).alias("children"), "k", usable.alias("usable"), F.when(usable, part("x")).alias("crop_x"), F.when(usable, part("y")).alias("crop_y"), F.when(usable, size).alias("crop_size"))
