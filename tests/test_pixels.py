"""Pixel operators against plain loops over all tiles."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.operators import raster as ra
from tilewright.operators import tiles as tl

TILES = "z int, x long, y long, content binary, transp int"


@pytest.fixture
def small_batches(spark):
    """Three rows a batch, so that tiles and blocks go on from one batch to the next."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def picture(rng, n=4):
    """Opaque, empty or mixed pixels."""
    img = rng.integers(0, 256, (n, n, 4), dtype=np.uint8)
    kind = rng.integers(0, 3)
    if kind < 2:
        img[..., 3] = 255 * (1 - kind)
    elif rng.integers(0, 2):
        img[0, 0, 3] = 0
    return img


def pixels(df):
    rows = df.collect()
    got = {(r.z, r.x, r.y): bytes(r.content) for r in rows}
    assert len(got) == len(rows)
    assert all(r.transp == ra.class_of(ra.image(bytes(r.content))) for r in rows)
    return got


def frame(spark, tiles):
    return spark.createDataFrame([(*k, i.tobytes(), ra.class_of(i)) for k, i in tiles.items()], TILES)


def test_layers_are_folded_over_batches(spark, small_batches):
    rng = np.random.default_rng(1)
    rows = [(z, x, y, r, picture(rng)) for z in (1, 2) for x in range(2) for y in range(2) for r in range(rng.integers(1, 9))]
    want = {}
    for z, x, y, _, img in sorted(rows, key=lambda r: r[:4]):
        below = want.get((z, x, y))
        want[z, x, y] = img if below is None or ra.class_of(img) == 1 else ra.blend(img, below)
    rows = [(z, x, y, r, i.tobytes()) for z, x, y, r, i in rows]
    random.Random(1).shuffle(rows)
    layers = spark.createDataFrame(rows, "z int, x long, y long, rank int, content binary")
    assert pixels(ra.composite_tiles(layers)) == {k: i.tobytes() for k, i in want.items()}


def test_single_layers_stay_out_of_python(spark):
    """A merge in which nothing blends has no tile for Python to see, and moves pixels once."""
    tiles = spark.createDataFrame([(c, 3, x, 0, 1, bytes([c]) * 64) for c in range(3) for x in range(4)], "chart_id int, z int, x long, y long, transp int, content binary")
    catalog = spark.createDataFrame([(c, c) for c in range(3)], "chart_id int, rank int")
    merged = ra.merge_region(catalog, tiles)
    assert {bytes(r.content)[0] for r in merged.collect()} == {2}
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "n#" in plan
    layers = tiles.withColumn("rank", F.col("chart_id")).withColumn("n", F.lit(1))
    seen = spark.sparkContext.accumulator(0)

    def step(below, rank, img):
        seen.add(1)
        return img

    ra.folded(layers.filter("n > 1"), "rank", step).collect()
    assert seen.value == 0


@pytest.mark.parametrize("levels", [1, 2, 4])
@pytest.mark.parametrize("by", [(), ("chart_id", "name")])
def test_pyramid_by_blocks(spark, small_batches, levels, by):
    rng, pick = np.random.default_rng(levels), random.Random(levels)
    sets = [(), ()] if not by else [(5, "a"), (900, None)]
    want, rows = {}, []
    for s in dict.fromkeys(sets):
        level = {}
        for z in range(7, 0, -1):
            own = {(x, y): picture(rng) for x in range(1 << z) for y in range(1 << z) if pick.random() < (0.02 if z == 7 else 0.1 if z in (6, 3) else 0)}
            made = {}
            for (x, y), img in level.items():
                canvas = made.setdefault((x >> 1, y >> 1), np.zeros((4, 4, 4), np.uint8))
                canvas[y % 2 * 2 : y % 2 * 2 + 2, x % 2 * 2 : x % 2 * 2 + 2] = ra.halve(img)
            rows += [(*s, z, x, y, i.tobytes(), ra.class_of(i)) for (x, y), i in own.items()]
            level = made | own
            want |= {(*s, z, x, y): i.tobytes() for (x, y), i in level.items()}
    named = "".join(f"{c}, " for c in ("chart_id long", "name string")[: len(by)])
    got = ra.build_pyramid(spark.createDataFrame(rows, named + TILES), 1, 7, by, levels).collect()
    assert {(*(r[c] for c in by), r.z, r.x, r.y): bytes(r.content) for r in got} == want and len(got) == len(want)


def test_lanczos_has_no_seams(spark):
    """Against one float64 filter over the whole picture, at most one step off; a smooth picture stays smooth over tile edges."""
    n, side = 16, 4
    rng = np.random.default_rng(3)
    ys, xs = np.mgrid[0 : n * side, 0 : n * side]
    whole = np.stack([xs * 3 % 256, ys * 3 % 256, (xs + ys) % 256, np.where((xs // 9 + ys // 7) % 3, 255, rng.integers(0, 256, xs.shape))], axis=2).astype(np.uint8)
    tiles = {(5, 8 + x, 12 + y): whole[y * n : y * n + n, x * n : x * n + n] for x in range(side) for y in range(side)}
    got = pixels(ra.overview_level(frame(spark, tiles), method="lanczos"))
    w = ra.lanczos_weights()
    x = np.pad(whole.astype(float), ((6, 6), (6, 6), (0, 0)))
    x[..., :3] *= x[..., 3:] / 255
    half = n * side // 2
    x = np.array([sum(w[i] * x[2 * r + i + 1] for i in range(12)) for r in range(half)])
    x = np.stack([sum(w[i] * x[:, 2 * r + i + 1] for i in range(12)) for r in range(half)], axis=1)
    alpha = np.clip(x[..., 3:], 0, 255)
    colour = np.where(alpha > 0.5, x[..., :3] * 255 / np.maximum(alpha, 0.5), 0)
    want = np.concatenate([colour, alpha], axis=2).round().clip(0, 255)
    assert set(got) == {(4, 4 + a, 6 + b) for a in range(2) for b in range(2)}
    for (_, a, b), content in got.items():
        part = want[(b - 6) * n : (b - 6) * n + n, (a - 4) * n : (a - 4) * n + n]
        assert np.abs(ra.image(content).astype(float) - part).max() <= 1
    assert abs(w.sum() - 1) < 1e-12 and (w == w[::-1]).all()
    with pytest.raises(ValueError, match="unknown method"):
        ra.overview_level(frame(spark, tiles), method="x")


def random_tree(pick, n):
    """Tiles of zooms 0 to 16, many of them below one another."""
    keys = set()
    while len(keys) < n:
        z = pick.choice([0, 3, 5, 6, 7, 8, 9, 11, 16])
        x, y = (pick.randrange(min(1 << z, 3)) << max(0, z - 4) >> pick.randrange(3) for _ in range(2))
        keys.add((z, min(x, (1 << z) - 1), min(y, (1 << z) - 1)))
        keys |= {(z - k, x >> k, y >> k) for k in range(1, z + 1) if pick.random() < 0.1}
    return sorted(keys)


def nearest(key, pool):
    z, x, y = key
    for k in range(1, 8):
        if z - k < 0 or (k > 1 and z - k + 1 < 6):
            return None
        if (z - k, x >> k, y >> k) in pool:
            return k, z - k, x >> k, y >> k
    return None


@pytest.mark.parametrize("partitions", ["1", "4", "30"])
def test_nearest_ancestors(spark, partitions):
    pick = random.Random(7)
    keys = random_tree(pick, 300)
    pool = {k for k in keys if pick.random() < 0.4}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        make = lambda ks: spark.createDataFrame(sorted(ks), "z int, x long, y long")
        got = {(r.z, r.x, r.y): (r.k, r.az, r.ax, r.ay) if r.k else None for r in tl.ancestor_lookup(make(keys), make(pool)).collect()}
        assert tl.ancestor_lookup(make(keys), make(pool).limit(0)).filter("k is not null").isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == {k: nearest(k, pool) for k in keys}


def test_holes_are_filled_as_by_a_loop(spark, small_batches):
    rng, pick = np.random.default_rng(2), random.Random(2)
    tiles = {k: picture(rng, 8) for k in random_tree(pick, 150)}
    want = {}
    for (z, x, y), top in tiles.items():
        holed = lambda t: t[..., 3].min() == 0 or t[..., 3].max() == 0
        under = None
        for q in range(4):
            kid = tiles.get((z + 1, 2 * x + q // 2, 2 * y + q % 2))
            if kid is not None:
                under = np.zeros((8, 8, 4), np.uint8) if under is None else under
                under[q % 2 * 4 : q % 2 * 4 + 4, q // 2 * 4 : q // 2 * 4 + 4] = ra.halve(kid)
        found = nearest((z, x, y), tiles)
        if (under is None or holed(under)) and found:
            k, part = found[0], max(1, 8 >> found[0])
            left, low = (x % (1 << k)) * 8 >> k, (y % (1 << k)) * 8 >> k
            crop = ra.enlarge_to(tiles[found[1:]][low : low + part, left : left + part], 8)
            if not holed(crop):
                under = crop if under is None else ra.blend(under, crop)
        full = ra.class_of(top) == 1
        want[z, x, y] = (top if full or under is None or not holed(top) else ra.blend(top, under)).tobytes()
    assert pixels(ra.fill_holes(frame(spark, tiles))) == want


def test_covers_are_dealt_evenly(spark):
    """Forty harbours and a chart of the world."""
    rows = [(i, i * 0.5, 10.0, i * 0.5 + 0.2, 9.9, 9, 9) for i in range(40)] + [(99, -180.0, 85.0, 180.0, -85.0, 9, 9)]
    boxes = spark.createDataFrame(rows, "chart_id long, west double, north double, east double, south double, zmin int, zmax int")
    cover = tl.tile_cover(boxes, task_tiles=20_000)
    sizes = [r.n for r in cover.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    total = sum(sizes)
    assert total > 250_000 and len(sizes) == -(-total // 20_000) and max(sizes) <= 1.5 * total / len(sizes)
    assert cover.distinct().count() == total
    assert tl.tile_cover(boxes.filter("chart_id < 40"), task_tiles=20_000).count() == tl.tile_cover(boxes.filter("chart_id < 40"), side=1).count()
