"""Tiles kept by cells, so that the work on them needs no further shuffle.

A cell is a tile of zoom `depth` with all tiles below it; a tile of a lower zoom is a cell of its own. Its number is its
quadkey behind a leading one. Layers of a tile, its children, its overviews and nearly all of its ancestors lie in its
cell, so tables that are bucketed by cell (see write_tile_table), or dealt by it once, serve all of these where they lie.
A cell spreads over zooms, not over tasks: depth is chosen so that 4 ** depth cells are many more than tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tilemath as tm
from . import raster
from .steps import cut
from .tiles import KEY, ancestor_codes, children_lookup, drop_transparent, nearest_ancestor

DEPTH = 8
AT = ("cell", *KEY)


def quad_number(z: Column, x: Column, y: Column) -> Column:
    """A tile's quadkey as a number behind a leading one, which tells zooms apart."""
    return F.pow(F.lit(4.0), z).cast("long") + tm.z_order(x, y)


def cell_of(z: Column, x: Column, y: Column, depth: int = DEPTH) -> Column:
    """The number of the cell that a tile lies in."""
    if depth < 1:
        raise ValueError("cells have a zoom of 1 or more")
    number = quad_number(z, x, y)
    return F.when(z > depth, F.floor(number / F.pow(F.lit(4.0), z - depth)).cast("long")).otherwise(number)


def with_cells(tiles: DataFrame, depth: int = DEPTH) -> DataFrame:
    """tiles with cell as their first column; z, x and y become int, long and long."""
    typed = tiles.withColumns({"z": F.col("z").cast("int"), "x": F.col("x").cast("long"), "y": F.col("y").cast("long")})
    return typed.select(cell_of(F.col("z"), F.col("x"), F.col("y"), depth).alias("cell"), *typed.columns)


def layers_in_cells(tiles: DataFrame) -> DataFrame:
    """The layers of each tile that show, as of merge_layers, and n, how many its tile has. tiles carry cell and rank."""
    here = Window.partitionBy(*AT)
    ranked = drop_transparent(tiles).withColumn("_o", F.max(F.when(F.col("transp") == 1, F.col("rank"))).over(here))
    return ranked.filter(F.col("_o").isNull() | (F.col("rank") >= F.col("_o"))).drop("_o").withColumn("n", F.count("*").over(here))


def merge_in_cells(tiles: DataFrame) -> DataFrame:
    """All charts' tiles (cell, z, x, y, rank, transp, content) as one tile set, as of merge_region: pixels stay where they lie.
    Tiles of one layer stay in the JVM. The window that counts layers brings a tile's layers to one partition, or finds
    them there; they are sorted and folded in that partition."""
    layers = layers_in_cells(tiles)
    alone = layers.filter("n = 1").select(*KEY, "content", F.col("transp").cast("int").alias("transp"))
    mixed = layers.filter("n > 1").select(*KEY, "rank", "content").sortWithinPartitions(*KEY, "rank")
    return alone.unionByName(mixed.mapInArrow(raster.fold_batches("rank", raster.layer_step), raster.TILE_OUT))


def children_in_cells(tiles: DataFrame, asked: Column | None = None, pool: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """The tiles (z, x, y) for which the condition asked holds, each with those of its children for which pool holds: cx, cy and
    quadrant, as of children_lookup; a key that repeats counts once. Both are rows of one table, which is read once: a row
    stands for itself and for its parent. Parents and children of a cell meet there by an aggregate, which keeps four
    flags a parent. Only what lies above the cells, 4 ** depth tiles at most, is joined."""
    asked, pool = (F.lit(True) if v is None else F.coalesce(v, F.lit(False)) for v in (asked, pool))
    quadrant = ((F.col("x") % 2) * 2 + F.col("y") % 2).cast("int")
    role = lambda z, x, y, q: F.struct(z.alias("z"), x.alias("x"), y.alias("y"), q.cast("int").alias("quadrant"))
    own = F.when(asked & (F.col("z") >= depth), role(F.col("z"), F.col("x"), F.col("y"), F.lit(None)))
    kid = F.when(pool & (F.col("z") > depth), role(F.col("z") - 1, F.shiftright("x", 1), F.shiftright("y", 1), quadrant))
    both = tiles.select("cell", F.explode(F.array(own, kid)).alias("r")).filter("r is not null").select("cell", "r.*")
    both = both.groupBy(*AT).agg(F.bool_or(F.col("quadrant").isNull()).alias("asked"), *(F.bool_or(F.col("quadrant") == q).alias(f"q{q}") for q in range(4)))
    found = F.filter(F.array(*(F.when(F.col(f"q{q}"), q) for q in range(4))), lambda q: q.isNotNull())
    spread = both.filter("asked").select(*KEY, F.explode(found).alias("quadrant"))
    inside = spread.select(*KEY, (F.col("x") * 2 + F.shiftright("quadrant", 1)).alias("cx"), (F.col("y") * 2 + F.col("quadrant") % 2).alias("cy"), "quadrant")
    above = children_lookup(tiles.filter(asked & (F.col("z") < depth)).select(*KEY).distinct(), tiles.filter(pool & (F.col("z") <= depth)).select(*KEY))
    return inside.unionByName(above.select(inside.columns))


def ancestors_in_cells(tiles: DataFrame, asked: Column | None = None, pool: Column | None = None, depth: int = DEPTH, most: int = 7, least_zoom: int = 6) -> DataFrame:
    """Each key for which the condition asked holds once, with k, az, ax and ay of its nearest ancestor for which pool holds, by the
    rules of ancestor_lookup, or nulls. Both are rows of one table.

    Along the Z curve of a cell its ancestors come before a tile, so a running window over the cell tells them. The pool's
    tiles above the cells, (4 ** depth - 1) / 3 of them at most, are broadcast."""
    asked, pool = (F.lit(True) if v is None else F.coalesce(v, F.lit(False)) for v in (asked, pool))
    roles = F.explode(F.array(F.when(asked, True), F.when(pool, False))).alias("asks")
    seen = ancestor_codes(tiles.select(*AT, roles).filter("asks is not null"), "cell")
    upper = tiles.filter(pool & (F.col("z") < depth)).select(*(F.col(c).alias(f"a{c}") for c in KEY)).distinct().withColumn("_there", F.lit(True))
    levels = [r[0] for r in seen.filter("not asks").select("z").distinct().orderBy("z").collect()]  # at most 31
    here = Window.partitionBy("cell").orderBy("code", "z", "asks")
    last = F.create_map(*(v for z in levels for v in (F.lit(z), F.max(F.when(~F.col("asks") & (F.col("z") == z), F.col("code"))).over(here)))) if levels else F.lit(None).cast("map<int,long>")
    inner = seen.withColumn("_last", last).filter("asks").select(*AT, nearest_ancestor(most, least_zoom).alias("k_in"))
    levels_up = F.when(F.col("k_in").isNull() & (F.col("z") > 0) & (F.col("z") - most < depth), F.sequence(F.greatest(F.lit(1), F.col("z") - depth + 1), F.least(F.lit(most), F.col("z"))))
    may = (F.col("k") == 1) | (F.col("z") - F.col("k") + 1 >= least_zoom)
    half = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("k"))).cast("long")
    higher = inner.withColumn("k", F.explode_outer(levels_up)).select(*AT, "k_in", F.when(may, F.col("k")).alias("k"))
    joined = higher.withColumns({"az": F.col("z") - F.col("k"), "ax": half("x"), "ay": half("y")}).join(F.broadcast(upper), ["az", "ax", "ay"], "left")
    best = joined.groupBy(*AT).agg(F.min(F.coalesce("k_in", F.when(F.col("_there"), F.col("k")))).cast("int").alias("k"))
    return best.select(*KEY, "k", (F.col("z") - F.col("k")).cast("int").alias("az"), half("x").alias("ax"), half("y").alias("ay"))


def overviews_in_cells(tiles: DataFrame, top: int) -> DataFrame:
    """New overviews of zooms below the tiles' down to top, which is not above the cells. Blocks of all tiles below one of zoom top
    are made as by overview_blocks, each from rows that lie in its cell already; a task holds one block: 4 ** levels tiles
    and a third more."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.sort_by([("_place", "ascending"), ("z", "descending")])
        made: Iterator[pa.RecordBatch] = raster.block_batches(())(iter(rows.to_batches()))
        return pa.Table.from_batches(list(made), raster.TILE_SCHEMA)

    keyed = raster.block_rows(tiles.withColumn("_top", F.lit(top)), ("cell",))
    return keyed.groupBy("cell", "_top", "_gx", "_gy").applyInArrow(run, raster.TILE_OUT)


def pyramid_in_cells(tiles: DataFrame, zmin: int, zmax: int, depth: int = DEPTH, levels: int = 4) -> DataFrame:
    """tiles (cell, z, x, y, content, transp) with overviews down to zmin, as of build_pyramid. The first step, which reads all but
    a 4 ** levels-th of the pixels, needs no shuffle; what it made goes on as in build_pyramid."""
    first = max(zmin, zmax - levels, depth)
    columns = [*KEY, "content", "transp"]
    own = tiles.filter(F.col("z").between(zmin, zmax))
    if first >= zmax:
        return raster.build_pyramid(own.select(columns), zmin, zmax, levels=levels)
    made = cut(overviews_in_cells(own.filter(F.col("z") >= first), first))
    rest = own.filter(F.col("z") <= first).select(columns).unionByName(made.filter(F.col("z") == first))
    out = own.filter(F.col("z") > first).select(columns).unionByName(made.filter(F.col("z") > first))
    return out.unionByName(raster.build_pyramid(rest, zmin, first, levels=levels))
