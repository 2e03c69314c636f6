import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.operators import cells as ce
from tilewright.operators import raster as ra
from tilewright.operators import tiles as tl
from tilewright.operators.steps import new_folder
from tilewright.sources import tile_tables

from .test_pixels import random_tree

DEPTH = 5


def layers(spark, seed=3, n=250):
    """Layers of random tiles of four by four pixels, some opaque, some empty."""
    pick, rows = random.Random(seed), []
    for z, x, y in random_tree(pick, n):
        for chart in range(pick.choice([1, 1, 2, 4])):
            px = np.frombuffer(pick.randbytes(64), np.uint8).copy().reshape(4, 4, 4)
            kind = pick.choice([1, 0, -1, -1])
            px[..., 3] = {1: 255, 0: 0, -1: px[..., 3]}[kind]
            rows.append((chart, chart * 7 % 5, z, x, y, int(ra.class_of(px)), px.tobytes()))
    return spark.createDataFrame(rows, "chart_id long, rank long, z int, x long, y long, transp int, content binary")


@pytest.fixture(params=[1, DEPTH, 9])
def laid(spark, request):
    rows = layers(spark).repartition(5)
    tile_tables.write_tile_table(rows, "laid_tiles", new_folder(spark, "laid"), request.param, 4)
    table, depth = tile_tables.read_tile_table(spark, "laid_tiles")
    assert depth == request.param
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # plans are final then
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield rows, table, depth
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql("DROP TABLE laid_tiles")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    key = lambda r: tuple(-1 if v is None else bytes(v) if isinstance(v, bytearray) else v for v in r)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.select(a.columns).collect()))


def test_cells_hold_what_is_below():
    of = lambda z, x, y: 4**z + sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(z))
    assert of(3, 5, 6) >> 2 == of(2, 2, 3)


def test_cell_numbers(spark):
    rows = spark.createDataFrame([(7, 100, 77), (5, 25, 19), (4, 12, 9), (0, 0, 0)], "z int, x long, y long")
    got = [r.cell for r in ce.with_cells(rows, 5).collect()]
    assert got[0] == got[1] and len(set(got)) == 3 and got[3] == 1
    with pytest.raises(ValueError, match="zoom"):
        ce.with_cells(rows, 0)


def test_layers_and_merge(spark, laid):
    rows, table, _ = laid
    catalog = rows.select("chart_id", "rank").distinct()
    shown = ce.layers_in_cells(table)
    same(tl.merge_layers(rows, catalog).select("chart_id", "z", "x", "y"), shown)
    merged = ce.merge_in_cells(table)
    assert "Exchange" not in plan_of(shown) and "Exchange" not in plan_of(merged)
    same(ra.merge_region(catalog, rows).select("z", "x", "y", "content", "transp"), merged)
    same(merged, ce.merge_in_cells(ce.with_cells(rows)))  # not laid out yet: dealt first


def test_children(spark, laid):
    rows, table, depth = laid
    keys = rows.select("z", "x", "y").distinct()
    same(tl.children_lookup(keys, rows), ce.children_in_cells(table, depth=depth))
    some, others = F.col("x") % 3 > 0, (F.col("y") % 2 == 0) & (F.col("rank") > 0)
    same(tl.children_lookup(keys.filter(some), rows.filter(others)), ce.children_in_cells(table, some, others, depth))
    inside = plan_of(ce.children_in_cells(table.filter(F.col("z") >= depth), depth=depth))
    assert "Exchange" not in inside


def test_ancestors(spark, laid):
    rows, table, depth = laid
    pool = F.expr("chart_id = 0 and rank = 0 and (x + y) % 3 > 0")
    keys = rows.select("z", "x", "y").distinct()
    got = ce.ancestors_in_cells(table, pool=pool, depth=depth)
    same(tl.ancestor_lookup(keys, rows.filter(pool)).select(got.columns), got)
    outside = plan_of(got).split("BroadcastExchange")
    assert "Exchange" not in outside[0] and outside[1].count("Exchange") == 1  # that of the upper tiles' distinct
    none = ce.ancestors_in_cells(table, pool=F.lit(False), depth=depth)
    assert none.filter("k is not null").isEmpty() and none.count() == keys.count()


@pytest.mark.parametrize("levels", [2, 4])
def test_pyramid(spark, laid, levels):
    rows, table, depth = laid
    one = rows.filter("chart_id = 0").select("z", "x", "y", "content", "transp")
    same(ra.build_pyramid(one, 3, 11), ce.pyramid_in_cells(table.filter("chart_id = 0"), 3, 11, depth, levels))
    made = ce.overviews_in_cells(table.filter("chart_id = 0 and z between 9 and 11"), 9)
    assert "Exchange" not in plan_of(made)


def test_a_table_has_a_file_a_bucket(spark, laid):
    _, table, _ = laid
    files = [f.rsplit("_", 1)[1] for f in table.inputFiles()]
    assert len(files) == len(set(files)) <= 4
    assert table.select("cell", F.spark_partition_id().alias("p")).distinct().groupBy("cell").count().filter("count > 1").isEmpty()
