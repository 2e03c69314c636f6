"""Pixel work: tiles are RGBA bytes, row by row, of n x n pixels. Small numpy helpers, called where Spark groups tiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import tilemath as tm
from . import tiles as tl
from .steps import cut

TILE_OUT = "z int, x long, y long, content binary, transp int"


def image(content: bytes) -> np.ndarray:
    n = int(round((len(content) / 4) ** 0.5))
    return np.frombuffer(content, np.uint8).reshape(n, n, 4)


def class_of(img: np.ndarray) -> int:
    """1 opaque, 0 empty, -1 mixed, by alpha alone."""
    a = img[..., 3]
    return 1 if a.min() == 255 else 0 if a.max() == 0 else -1


def blend(top: np.ndarray, below: np.ndarray) -> np.ndarray:
    """top over below by top's alpha, in eight bits, the alpha band like the others."""
    a = top[..., 3:4].astype(np.int32)
    t = top.astype(np.int32) * a + below.astype(np.int32) * (255 - a) + 128
    return ((t + (t >> 8)) >> 8).astype(np.uint8)


def halve(img: np.ndarray) -> np.ndarray:
    """Half the size: means of two by two pixels, colours weighted by alpha, rounded."""
    n = img.shape[0] // 2
    four = img.astype(np.int64).reshape(n, 2, n, 2, 4).transpose(0, 2, 1, 3, 4).reshape(n, n, 4, 4)
    alpha = four[..., 3:4].sum(axis=2)
    colour = (four[..., :3] * four[..., 3:4]).sum(axis=2)
    out = np.zeros((n, n, 4), np.uint8)
    out[..., 3:] = (alpha + 2) // 4
    out[..., :3] = np.where(alpha > 0, (colour + alpha // 2) // np.maximum(alpha, 1), 0)
    return out


@F.pandas_udf(T.IntegerType())
def transparency_class(content: pd.Series) -> pd.Series:
    return content.map(lambda c: None if c is None else class_of(image(c)))


@F.pandas_udf(T.BooleanType())
def has_any_byte(content: pd.Series) -> pd.Series:
    """A byte that is not zero, in any band."""
    return content.map(lambda c: None if c is None else bool(np.frombuffer(c, np.uint8).any()))


def transparency_class_of_array(px: Column) -> Column:
    """The same for a tile as an array of numbers."""
    alpha = F.filter(px, lambda v, i: i % 4 == 3)
    return F.when(F.array_min(alpha) == 255, 1).when(F.array_max(alpha) == 0, 0).otherwise(-1)


def to_bytes(px: Column) -> Column:
    return F.unhex(F.array_join(F.transform(px, lambda v: F.lpad(F.hex(v.cast("long")), 2, "0")), ""))


def _tile(key: tuple, img: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"z": [key[0]], "x": [key[1]], "y": [key[2]], "content": [img.tobytes()], "transp": [class_of(img)]})


TILE_SCHEMA = pa.schema([("z", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("content", pa.binary()), ("transp", pa.int32())])


def tile_batch(keys: list[tuple], images: list[np.ndarray]) -> pa.RecordBatch:
    """Tiles of (z, x, y) as rows of TILE_OUT."""
    z, x, y = zip(*keys, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(z, pa.int32()), pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array([i.tobytes() for i in images], pa.binary()), pa.array([class_of(i) for i in images], pa.int32())], schema=TILE_SCHEMA)


def fold_batches(order: str, step: Callable, end: Callable | None = None, more: tuple[str, ...] = ()) -> Callable:
    """For mapInArrow: batches (z, x, y, order, content and the columns `more`) in order of these as one tile each.

    Batches are read as they come and a tile may go on in the next one: only what has been made of it is carried. step(made
    so far or None, order, image, *more) -> what is made; end(that, (z, x, y)) -> the tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = made = None
        for b in batches:
            keys, images = [], []
            for z, x, y, place, *others, c in zip(*(b.column(n).to_pylist() for n in ("z", "x", "y", order, *more)), b.column("content"), strict=True):
                if (z, x, y) != key:
                    if key is not None:
                        keys.append(key)
                        images.append(end(made, key) if end else made)
                    key, made = (z, x, y), None
                made = step(made, place, image(c.as_buffer()), *others)
            if keys:
                yield tile_batch(keys, images)
        if key is not None:
            yield tile_batch([key], [end(made, key) if end else made])

    return run


def folded(rows: DataFrame, order: str, step: Callable, end: Callable | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """rows (z, x, y, order, content and the columns `more`), sorted within partitions of (z, x, y), as one tile each; see
    fold_batches."""
    sorted_rows = rows.select("z", "x", "y", order, *more, "content").repartition("z", "x", "y").sortWithinPartitions("z", "x", "y", order)
    return sorted_rows.mapInArrow(fold_batches(order, step, end, more), TILE_OUT)


def layer_step(below: np.ndarray | None, rank: int, img: np.ndarray) -> np.ndarray:
    """An opaque layer covers what lies below; the first is taken as it is."""
    return img if below is None or class_of(img) == 1 else blend(img, below)


def composite_counted(layers: DataFrame) -> DataFrame:
    """layers (z, x, y, rank, content, transp, n: how many layers its tile has): tiles of one layer, such as those that an opaque
    one covers, stay in the JVM, and only those that blend go through Python, one call a batch."""
    alone = layers.filter("n = 1").select("z", "x", "y", "content", F.col("transp").cast("int").alias("transp"))
    return alone.unionByName(folded(layers.filter("n > 1"), "rank", layer_step))


def composite_tiles(layers: DataFrame) -> DataFrame:
    """layers (z, x, y, rank, content, and transp if it is known) folded tile by tile, from the lowest rank up. Eight-bit blending
    depends on the order; prune with merge_layers first, which leaves few layers a tile."""
    known = layers if "transp" in layers.columns else layers.withColumn("transp", transparency_class("content"))
    keyed = known.select(F.col("z").cast("int").alias("z"), "x", "y", "rank", "content", "transp")
    return composite_counted(keyed.withColumn("n", F.count("*").over(Window.partitionBy("z", "x", "y"))))


def charts_without_tiles(catalog: DataFrame, tiles: DataFrame) -> DataFrame:
    """Charts that have no tile: an error of the cutting stage."""
    return catalog.join(tiles.select("chart_id").distinct(), "chart_id", "left_anti")


def merge_region(catalog: DataFrame, tiles: DataFrame) -> DataFrame:
    """All charts' tiles (chart_id, z, x, y, transp, content) as one tile set: layers are chosen on metadata, and only the
    pixels of those that show are shuffled and blended. A chart of the catalog without tiles is an error."""
    missing = [r["chart_id"] for r in charts_without_tiles(catalog.select("chart_id"), tiles).limit(5).collect()]
    if missing:
        raise ValueError(f"charts without tiles: {missing}")
    shown = tl.merge_layers(tiles.drop("content"), catalog).groupBy("z", "x", "y").agg(F.map_from_entries(F.collect_set(F.struct("chart_id", "rank"))).alias("ranks"), F.count("*").alias("n"))
    layers = tiles.select("chart_id", "z", "x", "y", "transp", "content").join(shown, ["z", "x", "y"]).withColumn("rank", F.element_at("ranks", F.col("chart_id")))
    return composite_counted(layers.filter("rank is not null and transp <> 0"))


def overview_level(tiles: DataFrame, by: tuple[str, ...] = (), method: str = "box") -> DataFrame:
    """The tiles one zoom lower, of each set that the columns `by` tell apart: each from up to four children. method: box, means of
    two by two pixels, or lanczos; see lanczos_level."""
    if method == "lanczos":
        return lanczos_level(tiles, by)
    if method != "box":
        raise ValueError(f"unknown method {method}")
    return overview_blocks(tiles.withColumn("_top", F.col("z") - 1), by)


def block_rows(tiles: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """tiles (z, x, y, content, and _top, the lowest zoom to make) with their block, the tile _gx, _gy of that zoom, and _place,
    along a Z curve the last place below a tile: the tile itself comes behind its descendants."""
    depth = F.col("z") - F.col("_top")
    place = (tm.z_order(F.col("x"), F.col("y")) + 1) * F.pow(F.lit(4.0), F.lit(tm.Z_ORDER_ZOOM) - F.col("z")).cast("long") - 1
    up = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), depth)).cast("long")
    return tiles.select(*by, F.col("_top").cast("int").alias("_top"), up("x").alias("_gx"), up("y").alias("_gy"), F.col("z").cast("int").alias("z"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), place.alias("_place"), "content")


def block_batches(by: tuple[str, ...]) -> Callable:
    """For mapInArrow: rows of block_rows, block by block and in order of _place, as new overviews."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canvases: dict[int, tuple[int, int, np.ndarray]] = {}  # by zoom: x, y and pixels of a tile that is being made
        group = None
        made: list[tuple] = []

        def paste(z: int, x: int, y: int, img: np.ndarray, top: int) -> None:
            """Draws a tile on its parent, which is opened if it isn't open."""
            if z > top:
                n = img.shape[0]
                if z - 1 not in canvases:
                    canvases[z - 1] = (x >> 1, y >> 1, np.zeros((n, n, 4), np.uint8))
                h, canvas = n // 2, canvases[z - 1][2]
                canvas[(y & 1) * h : (y & 1) * h + h, (x & 1) * h : (x & 1) * h + h] = halve(img)

        def close(z: int) -> None:
            x, y, canvas = canvases.pop(z)
            made.append(((*group[0], z, x, y), canvas))
            paste(z, x, y, canvas, group[1])

        def out() -> pa.RecordBatch:
            batch = tile_batch([k[-3:] for k, _ in made], [i for _, i in made])
            names = [pa.array([k[j] for k, _ in made], first.schema.field(c).type) for j, c in enumerate(by)]
            made.clear()
            return pa.RecordBatch.from_arrays([*names, *batch.columns], [*by, *batch.schema.names])

        first = None
        for b in batches:
            first = b if first is None else first
            for *sets, top, gx, gy, z, x, y, c in zip(*(b.column(n).to_pylist() for n in (*by, "_top", "_gx", "_gy", "z", "x", "y")), b.column("content"), strict=True):
                here = (tuple(sets), top, gx, gy)
                for low in range(max(canvases, default=-1), -1, -1):  # from the deepest: those that this tile does not lie in are done
                    if low in canvases and (here != group or low > z or (x >> (z - low), y >> (z - low)) != canvases[low][:2]):
                        close(low)
                group = here
                canvases.pop(z, None)  # it was made of its children, but is there
                paste(z, x, y, image(c.as_buffer()), top)
            if made:
                yield out()
        while canvases:
            close(max(canvases))
        if made:
            yield out()

    return run


def overview_blocks(tiles: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Overviews of several levels by one shuffle. tiles have _top, the lowest zoom to make: all tiles below one tile of that zoom
    are a block, read children before parents along a Z curve. One canvas a level is open, so a block needs no more memory
    than a few tiles, whatever its size. Tiles that are there already are kept and not made; only new ones are returned."""
    kinds = dict(tiles.dtypes)
    block = [*by, "_top", "_gx", "_gy"]
    dealt = block_rows(tiles, by).repartition(*block).sortWithinPartitions(*block, "_place", F.col("z").desc())
    return dealt.mapInArrow(block_batches(by), ", ".join([*(f"{c} {kinds[c]}" for c in by), TILE_OUT]))


def build_pyramid(tiles: DataFrame, zmin: int, zmax: int, by: tuple[str, ...] = (), levels: int = 4) -> DataFrame:
    """tiles of one set, or of each that the columns `by` tell apart, with the overviews of zmax - 1 down to zmin added; tiles
    that a level has already are kept. `levels` zooms are made at a time, each such step with one shuffle and one write to
    the shared checkpoint folder, so that none is computed twice."""
    columns = [*by, "z", "x", "y", "content", "transp"]
    own = tiles.filter(F.col("z").between(zmin, zmax)).select(columns)
    out, made = own, None
    for high in range(zmax, zmin, -levels):
        top = max(zmin, high - levels)
        source = own.filter(F.col("z").between(top, high))
        if made is not None:
            source = source.unionByName(made.filter(F.col("z") == high))
        made = cut(overview_blocks(source.withColumn("_top", F.lit(top)), by))
        out = out.unionByName(made)
    return out


LANCZOS = 3  # lobes
HALO = 2 * LANCZOS  # pixels of a neighbour that a tile's edge needs


def lanczos_weights() -> np.ndarray:
    """Weights of the twelve source pixels around the middle between two, at half the scale, which add up to one."""
    at = (np.arange(2 * HALO) - HALO + 0.5) / 2
    w = np.sinc(at) * np.sinc(at / LANCZOS)
    return w / w.sum()


def lanczos_halve(img: np.ndarray) -> np.ndarray:
    """An image with HALO pixels around it, half the size without them: a separable filter over colours weighted by alpha."""
    x = img.astype(np.float64)
    x[..., :3] *= x[..., 3:] / 255
    w = lanczos_weights()
    for axis in (0, 1):
        n = (x.shape[axis] - 2 * HALO) // 2
        x = sum(w[i] * x.take(np.arange(n) * 2 + i + 1, axis=axis) for i in range(2 * HALO))
    alpha = x[..., 3:].clip(0, 255)
    colour = np.divide(x[..., :3] * 255, alpha, out=np.zeros_like(x[..., :3]), where=alpha > 0.5)
    colour[np.broadcast_to(alpha <= 0.5, colour.shape)] = 0
    return np.concatenate([colour, alpha], axis=2).round().clip(0, 255).astype(np.uint8)


def strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each tile for its parent, and its edges for the parents next to it: rows with the place (px, py) of the piece in the parent's
    canvas of children, negative or beyond it for a neighbour's, and the piece's height."""
    for b in batches:
        n_columns = len(b.schema) - 4
        rows: list[list] = [[] for _ in range(n_columns)]
        z_out, xs, ys, px, py, heights, contents = ([] for _ in range(7))
        for i, (z, x, y, c) in enumerate(zip(*(b.column(v).to_pylist() for v in ("z", "x", "y")), b.column("content"), strict=True)):
            img = image(c.as_buffer())
            n, last = img.shape[0], 1 << (z - 1)
            if n < HALO:
                raise ValueError(f"the filter needs tiles of {HALO} pixels or more")
            for dx in (-1, 0, 1):
                for dy in (-1, 0, 1):
                    # a tile reaches a parent on its other side only across its inner edge
                    if (dx and (x & 1) != (dx > 0)) or (dy and (y & 1) != (dy > 0)):
                        continue
                    gx, gy = (x >> 1) + dx, (y >> 1) + dy
                    if not (0 <= gx < last and 0 <= gy < last):
                        continue
                    a, e = (n - HALO, n) if dx > 0 else (0, HALO) if dx < 0 else (0, n)
                    t, d = (n - HALO, n) if dy > 0 else (0, HALO) if dy < 0 else (0, n)
                    for j in range(n_columns):
                        rows[j].append(i)
                    for values, v in zip((z_out, xs, ys, px, py, heights, contents), (z - 1, gx, gy, x * n + a - 2 * gx * n, y * n + t - 2 * gy * n, d - t, img[t:d, a:e].tobytes()), strict=True):
                        values.append(v)
        sets = [b.column(j).take(pa.array(rows[j], pa.int64())) for j in range(n_columns)]
        ints = [pa.array(v, pa.int64()) for v in (xs, ys, px, py)]
        yield pa.RecordBatch.from_arrays([*sets, pa.array(z_out, pa.int32()), *ints, pa.array(heights, pa.int32()), pa.array(contents, pa.binary())], [*b.schema.names[:n_columns], "z", "x", "y", "px", "py", "height", "content"])


def lanczos_level(tiles: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """As overview_level, by a Lanczos filter of three lobes over colours weighted by alpha. A parent reads six pixels of the tiles
    around its children, too, so there are no seams; only these strips are copied. What has no tile is transparent."""
    kinds = dict(tiles.dtypes)
    sets = ", ".join(f"{c} {kinds[c]}" for c in by)
    schema = f"{sets}{', ' * bool(by)}z int, x long, y long, px long, py long, height int, content binary"
    keyed = tiles.select(*by, F.col("z").cast("int").alias("z"), F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "content").filter("z > 0")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        own = [(px, py, h, c) for px, py, h, c in zip(*(table.column(v).to_pylist() for v in ("px", "py", "height", "content")), strict=True)]
        whole = [h for px, py, h, c in own if len(c) == h * h * 4 and px >= 0 and py >= 0 and px % h == 0 and py % h == 0 and px < 2 * h and py < 2 * h]
        z, x, y = (key[len(by) + i].as_py() for i in range(3))
        if not whole:  # neighbours alone make no tile
            return pa.table({c: pa.array([], table.schema.field(c).type) for c in by} | {c: pa.array([], TILE_SCHEMA.field(c).type) for c in TILE_SCHEMA.names})
        n = max(whole)
        canvas = np.zeros((2 * n + 2 * HALO, 2 * n + 2 * HALO, 4), np.uint8)
        for px, py, h, c in own:
            piece = np.frombuffer(c, np.uint8).reshape(h, -1, 4)
            canvas[py + HALO : py + HALO + h, px + HALO : px + HALO + piece.shape[1]] = piece
        made = tile_batch([(z, x, y)], [lanczos_halve(canvas)])
        return pa.table([pa.array([key[j].as_py()], table.schema.field(c).type) for j, c in enumerate(by)] + made.columns, [*by, *made.schema.names])

    return keyed.mapInArrow(strips, schema).groupBy(*by, "z", "x", "y").applyInArrow(run, f"{sets}{', ' * bool(by)}{TILE_OUT}")


def block_keys(windows: DataFrame, block: int) -> DataFrame:
    """windows (chart_id, z, x, y, w) with each block (bx, by) that the part of w inside the raster touches."""
    left, top = F.col("w.x0") + F.col("w.x_off"), F.col("w.y0") + F.col("w.y_off")
    span = lambda a, n: F.sequence(F.floor(a / block), F.floor((a + n - 1) / block))
    return windows.filter("w is not null").withColumn("bx", F.explode(span(left, F.col("w.width")))).withColumn("by", F.explode(span(top, F.col("w.height"))))


def resample(img: np.ndarray, n: int) -> np.ndarray:
    """To n x n: nearest neighbour when it grows, area means (colours weighted by alpha) when it shrinks."""
    h, w = img.shape[:2]
    if h <= n and w <= n:
        return img[np.arange(n) * h // n][:, np.arange(n) * w // n]
    ys, xs = np.linspace(0, h, n + 1).astype(int), np.linspace(0, w, n + 1).astype(int)
    total = np.zeros((h + 1, w + 1, 5))
    total[1:, 1:, :3] = img[..., :3].astype(float) * img[..., 3:]
    total[1:, 1:, 3] = img[..., 3]
    total[1:, 1:, 4] = 1
    total = total.cumsum(axis=0).cumsum(axis=1)
    y0, x0, y1, x1 = ys[:-1], xs[:-1], np.maximum(ys[1:], ys[:-1] + 1).clip(max=h), np.maximum(xs[1:], xs[:-1] + 1).clip(max=w)
    s = total[y1][:, x1] - total[y0][:, x1] - total[y1][:, x0] + total[y0][:, x0]
    out = np.zeros((n, n, 4), np.uint8)
    out[..., 3] = np.round(s[..., 3] / np.maximum(s[..., 4], 1))
    out[..., :3] = np.where(s[..., 3:4] > 0, np.round(s[..., :3] / np.maximum(s[..., 3:4], 1)), 0)
    return out


def cut_tiles(blocks: DataFrame, windows: DataFrame, block: int = 256, n: int = 256) -> DataFrame:
    """blocks (chart_id, bx, by, content) of rasters, cut into the tiles that windows (chart_id, z, x, y, w of
    tile_raster_window) ask for; tiles without any byte are left out. Only the highest zoom is cut: there a window touches
    few blocks; lower zooms come from build_pyramid."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        w = pdf.iloc[0]
        canvas = np.zeros((max(1, int(w["y1"] - w["y0"])), max(1, int(w["x1"] - w["x0"])), 4), np.uint8)
        left, top, right, low = w["x0"] + w["x_off"], w["y0"] + w["y_off"], w["x0"] + w["x_off"] + w["width"], w["y0"] + w["y_off"] + w["height"]
        for bx, by, c in zip(pdf["bx"], pdf["by"], pdf["content"], strict=True):
            img = image(c)
            a, b, e, d = max(left, bx * block), max(top, by * block), min(right, (bx + 1) * block), min(low, (by + 1) * block)
            if a < e and b < d:
                canvas[b - w["y0"] : d - w["y0"], a - w["x0"] : e - w["x0"]] = img[b - by * block : d - by * block, a - bx * block : e - bx * block]
        if not canvas.any():
            return pd.DataFrame(columns=["chart_id", "z", "x", "y", "content", "transp"])
        return _tile(key[1:], resample(canvas, n)).assign(chart_id=key[0])

    asked = block_keys(windows, block).select("chart_id", "z", "x", "y", "bx", "by", "w.x0", "w.y0", "w.x1", "w.y1", "w.x_off", "w.y_off", "w.width", "w.height")
    return asked.join(blocks, ["chart_id", "bx", "by"]).groupBy("chart_id", "z", "x", "y").applyInPandas(run, f"chart_id long, {TILE_OUT}")


def expand_palette(px: Column, palette: Column) -> Column:
    """An array of colour numbers as RGBA, by a palette: array of arrays of four. Unknown numbers are transparent."""
    return F.flatten(F.transform(px, lambda v: F.coalesce(F.get(palette, v.cast("int")), F.array(*(F.lit(0),) * 4))))


def inside(ring: list[tuple[float, float]], xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """Which points lie in a ring of (x, y), by the even-odd rule."""
    out = np.zeros(xs.shape, bool)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if y1 != y2:
            out ^= ((y1 > ys) != (y2 > ys)) & (xs < (x2 - x1) * (ys - y1) / (y2 - y1) + x1)
    return out


def mask_cutline(blocks: DataFrame, block: int = 256) -> DataFrame:
    """blocks (bx, by, content, ring: array of struct(x, y) in raster pixels) with pixels whose centre is outside made 0."""

    def run(batches):
        for pdf in batches:
            contents = []
            for bx, by, c, ring in zip(pdf["bx"], pdf["by"], pdf["content"], pdf["ring"], strict=True):
                img = image(c).copy()
                n = img.shape[0]
                ys, xs = np.mgrid[0:n, 0:n]
                points = [(p["x"], p["y"]) for p in ring]
                img[~inside(points, xs + bx * block + 0.5, ys + by * block + 0.5)] = 0
                contents.append(img.tobytes())
            yield pdf.assign(content=contents)

    return blocks.mapInPandas(run, blocks.schema)


def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """content halved: a quarter of the bytes."""
    for b in batches:
        at = b.schema.get_field_index("content")
        small = pa.array([halve(image(c.as_buffer())).tobytes() for c in b.column(at)], pa.binary())
        yield b.set_column(at, "content", small)


def crops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ancestors (content, asked: array of z, x, y, k) as what lies under each tile that asks; a part with a hole is left out."""
    for b in batches:
        keys, parts = [], []
        for c, asked in zip(b.column("content"), b.column("asked").to_pylist(), strict=True):
            big = image(c.as_buffer())
            size = big.shape[0]
            for a in asked:
                n = max(1, size >> a["k"])
                left, top = ((a[v] % (1 << a["k"])) * size >> a["k"] for v in ("x", "y"))
                part = big[top : top + n, left : left + n]
                if part[..., 3].min() > 0:
                    keys.append((a["z"], a["x"], a["y"]))
                    parts.append(part.tobytes())
        if keys:
            z, x, y = zip(*keys, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(z, pa.int32()), pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(parts, pa.binary())], ["z", "x", "y", "content"])


def fill_step(made: tuple | None, slot: int, img: np.ndarray) -> tuple:
    """Gathers a tile's pieces: 0 the tile itself, 1 to 4 its halved children by quadrant, 5 what an ancestor has under it."""
    top, kids, crop = made or (None, None, None)
    if slot == 0:
        return img, kids, crop
    n = top.shape[0]
    if slot == 5:
        return top, kids, enlarge_to(img, n)
    if kids is None:
        kids = np.zeros((n, n, 4), np.uint8)
    h, q = n // 2, slot - 1
    kids[(q % 2) * h : (q % 2) * h + h, (q // 2) * h : (q // 2) * h + h] = img
    return top, kids, crop


def enlarge_to(img: np.ndarray, n: int) -> np.ndarray:
    """To n x n by nearest neighbour."""
    return img[np.arange(n) * img.shape[0] // n][:, np.arange(n) * img.shape[1] // n]


def fill_end(made: tuple, key: tuple) -> np.ndarray:
    top, under, crop = made
    holed = lambda t: t[..., 3].min() == 0 or t[..., 3].max() == 0
    if (under is None or holed(under)) and crop is not None:
        under = crop if under is None else blend(under, crop)
    return top if under is None or not holed(top) else blend(top, under)


def fill_holes(tiles: DataFrame) -> DataFrame:
    """tiles (z, x, y, transp, content) with the holes of those that have some filled from below: by their children's
    mosaic, and where that is missing or has holes, by the nearest ancestor's part under them if that has none. All is
    read from the tiles as they were.

    Pixels are made small before they are shuffled: children are halved where they are read, and an ancestor meets the list of
    the tiles that ask for it and sends each its part, all parts of one level together one tile at most."""
    pool = tiles.select(F.col("z").cast("int").alias("z"), "x", "y", "content")
    holes = tiles.filter("transp <> 1").select(F.col("z").cast("int").alias("z"), "x", "y", "content")
    keys = holes.select("z", "x", "y")
    kids = pool.mapInArrow(halves, "z int, x long, y long, content binary").select((F.col("z") - 1).alias("z"), F.shiftright("x", 1).alias("x"), F.shiftright("y", 1).alias("y"), ((F.col("x") % 2) * 2 + F.col("y") % 2 + 1).cast("int").alias("slot"), "content").join(keys, ["z", "x", "y"], "left_semi")
    asked = tl.ancestor_lookup(keys, pool.drop("content")).filter("k is not null").groupBy("az", "ax", "ay").agg(F.collect_list(F.struct("z", "x", "y", "k")).alias("asked"))
    big = pool.join(asked, (pool["z"] == asked["az"]) & (pool["x"] == asked["ax"]) & (pool["y"] == asked["ay"])).select("content", "asked")
    parts = big.mapInArrow(crops, "z int, x long, y long, content binary")
    pieces = holes.withColumn("slot", F.lit(0)).unionByName(kids).unionByName(parts.withColumn("slot", F.lit(5)))
    return tiles.filter("transp = 1").select("z", "x", "y", "content", "transp").unionByName(folded(pieces, "slot", fill_step, fill_end))


def burn_rectangles(blocks: DataFrame, rects: DataFrame, block: int = 256) -> DataFrame:
    """blocks (chart, bx, by, content) with rectangles (chart, x_off, y_off, width, height, r, g, b) painted over, opaque.
    A block meets the rectangles of its own cell, in order of place."""
    cells = tl.burn_rects_to_tiles(rects, block).groupBy("chart", F.col("cell_x").alias("bx"), F.col("cell_y").alias("by"))
    lists = cells.agg(F.sort_array(F.collect_list(F.struct("x_off", "y_off", "width", "height", "r", "g", "b"))).alias("rects"))

    def run(batches):
        for pdf in batches:
            contents = []
            for bx, by, c, found in zip(pdf["bx"], pdf["by"], pdf["content"], pdf["rects"], strict=True):
                img = image(c).copy()
                for r in [] if found is None else found:
                    x, y = r["x_off"] - bx * block, r["y_off"] - by * block
                    img[max(0, y) : max(0, y + r["height"]), max(0, x) : max(0, x + r["width"])] = (r["r"], r["g"], r["b"], 255)
                contents.append(img.tobytes())
            yield pdf.assign(content=contents).drop(columns="rects")

    return blocks.join(lists, ["chart", "bx", "by"], "left").select(*blocks.columns, "rects").mapInPandas(run, blocks.schema)
