"""Tile tables that are bucketed by cell: what the operators of `operators/cells.py` read without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.cells import DEPTH, with_cells
from ..operators.steps import new_folder


def write_tile_table(tiles: DataFrame, name: str, path: str, depth: int = DEPTH, buckets: int = 1024) -> None:
    """tiles (z, x, y and any others) as table `name` under path, with cell, in so many buckets by cell, each sorted by cell
    and zoom. They are dealt by cell first, so a bucket is one file; a table of that name is replaced. buckets: as many
    that one holds what a task can sort. The table keeps its depth as a property."""
    dealt = with_cells(tiles, depth).repartition(buckets, "cell")
    spark = tiles.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt.write.bucketBy(buckets, "cell").sortBy("cell", "z").option("path", path).mode("overwrite").format("parquet").saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('cell_depth' = '{depth}')")


def read_tile_table(spark: SparkSession, name: str) -> tuple[DataFrame, int]:
    """The table and the depth of its cells."""
    depth = spark.sql(f"SHOW TBLPROPERTIES {name} ('cell_depth')").first()["value"]
    return spark.table(name), int(depth)


def laid_out(tiles: DataFrame, depth: int = DEPTH, buckets: int | None = None) -> DataFrame:
    """tiles as a bucketed table in the shared folder, of a name that no other has: for jobs with several steps over the same tiles.
    buckets: as many as the session has shuffle partitions, unless told."""
    spark = tiles.sparkSession
    path = new_folder(spark, "laid")
    name = "tiles_" + path.rsplit("-", 1)[1]
    write_tile_table(tiles, name, path, depth, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    return read_tile_table(spark, name)[0]
