"""Whole jobs: from a region's charts and rasters to merged tiles, archives and scripts."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import catalog as cat
from ..operators import raster
from ..operators import tiles as tl
from ..operators.steps import cut, scratch
from ..sources import tables, volumes


@dataclass
class Compiled:
    """What a job made; parts that its profile has not are None."""

    catalog: DataFrame
    tiles: DataFrame
    verdicts: DataFrame
    merged: DataFrame | None = None
    archive: DataFrame | None = None
    script: DataFrame | None = None
    mbtiles: DataFrame | None = None


def chart_tiles(charts: DataFrame, rasters: DataFrame, blocks: DataFrame, z: int, block: int = 256, n: int = 256) -> DataFrame:
    """Tiles of zoom z: charts (chart_id, west, north, east, south), rasters (chart_id, gt, xsize, ysize), blocks of pixels."""
    cover = tl.tile_cover(charts.withColumns({"zmin": F.lit(z), "zmax": F.lit(z)})).join(rasters, "chart_id")
    windows = cover.withColumn("w", geo.tile_raster_window(F.col("z"), F.col("x"), F.col("y"), F.col("gt"), F.col("xsize"), F.col("ysize"))).select("chart_id", "z", "x", "y", "w")
    return raster.cut_tiles(blocks, windows, block, n)


def per_chart_pyramid(tiles: DataFrame, zmin: int, zmax: int) -> DataFrame:
    """Overviews chart by chart, all charts in one pass."""
    return raster.build_pyramid(tiles, zmin, zmax, by=("chart_id",))


def cut_charts(charts: DataFrame, rasters: DataFrame, blocks: DataFrame, zmin: int, zmax: int, block: int = 256, n: int = 256) -> DataFrame:
    """The cutting stage: each chart's tiles of zoom zmax from its raster, and their overviews down to zmin."""
    return per_chart_pyramid(cut(chart_tiles(charts, rasters, blocks, zmax, block, n)), zmin, zmax)


def archive_of(merged: DataFrame, region: str, limit: int) -> DataFrame:
    """The archive of a tile set (z, x, y, content) as rows volume, part, seq_no, bytes."""
    sizes = merged.select("z", "x", "y", F.octet_length("content").cast("long").alias("n_bytes"))
    ranges = cut(tl.range_offsets(tl.tile_rectangles(sizes), 8 + len(region.encode())))
    placed = cut(tl.archive_volumes(tl.tile_offsets(ranges, sizes), limit))
    return tables.archive_rows(tl.archive_head(ranges, placed, region), placed.join(merged.select("z", "x", "y", "content"), ["z", "x", "y"]))


def checked(profile: str) -> str:
    if profile not in ("MX_REGION", "MB_REGION", "MB_CHARTS"):
        raise ValueError(f"unknown profile {profile}")
    return profile


def ordered_catalog(charts: DataFrame) -> DataFrame:
    return cat.catalog_order(cat.valid_charts(charts))


def gate(verdicts: DataFrame, on_failure: str) -> DataFrame:
    """Charts that don't pass verification (chart_id): an error, or for on_failure "drop" what later stages leave out."""
    if on_failure not in ("error", "drop"):
        raise ValueError(f"unknown choice {on_failure}")
    failed = verdicts.filter("not ok").limit(5).collect() if on_failure == "error" else []
    if failed:
        raise ValueError("charts that fail verification: " + ", ".join(f"{r['chart_id']} ({r['reason']})" for r in failed))
    return verdicts.filter("not ok").select("chart_id")


def without(rows: DataFrame, failed: DataFrame) -> DataFrame:
    """Catalog rows or tiles without those of failed charts; a catalog is ranked anew."""
    left = rows.join(failed, "chart_id", "left_anti")
    return cat.catalog_order(left.drop("rank")) if "rank" in rows.columns else left


def merged_tiles(catalog: DataFrame, tiles: DataFrame, fill: bool) -> DataFrame:
    merged = raster.merge_region(catalog, tiles)
    return raster.fill_holes(cut(merged)) if fill else merged


def compile_region(profile: str, charts: DataFrame, tiles: DataFrame, region: str = "REGION", epoch: int = 0, fill: bool = False, limit: int = 2_000_000_000, on_failure: str = "error") -> Compiled:
    """profile MX_REGION: merged tiles, archive rows and script; MB_REGION: merged tiles as mbtiles rows; MB_CHARTS: each
    chart's tiles as mbtiles rows, without every second zoom. charts: catalog fields with chart_id; tiles: chart_id, z, x,
    y, transp, content. Holes are filled only if asked for. Charts that don't pass verification are an error, or with
    on_failure "drop" left out; verdicts tell of all charts in either case."""
    checked(profile)
    ordered = cut(ordered_catalog(charts))
    out = Compiled(ordered, tiles, cut(tl.verify_catalog(ordered, tiles.drop("content"))))
    failed = gate(out.verdicts, on_failure)
    if profile == "MB_CHARTS":
        out.mbtiles = tables.mbtiles_rows(tl.skip_zooms(without(tiles, failed) if on_failure == "drop" else tiles))
        return out
    if on_failure == "drop":  # tiles of charts that the catalog has not are not merged
        out.catalog = ordered = cut(without(ordered, failed))
    out.merged = merged_tiles(ordered, tiles, fill)
    if profile == "MB_REGION":
        out.mbtiles = tables.mbtiles_rows(out.merged)
    else:
        out.merged = cut(out.merged)
        out.archive = archive_of(out.merged, region, limit)
        out.script = tables.region_script(ordered, region, epoch, "--DBVERSION:3")
    return out


def fingerprint(charts: DataFrame, tiles: DataFrame, *parameters) -> str:
    """Tells a job's inputs from other ones by all that is in them but pixels, whatever the order of rows."""
    told = []
    for df in (charts, tiles):
        plain = [F.col(c) for c, kind in df.dtypes if kind != "binary"]
        told += df.select(F.xxhash64(*plain).alias("h")).agg(F.count("*"), F.bit_xor("h"), F.sum(F.col("h").cast("decimal(20,0)"))).first()
    return hashlib.sha256(repr([*map(str, told), *parameters]).encode()).hexdigest()


LOG = "line_no long, line string, inputs string"


def run_region(folder: str, profile: str, charts: DataFrame, tiles: DataFrame, region: str = "REGION", epoch: int = 0, fill: bool = False, limit: int = 2_000_000_000, on_failure: str = "error") -> int:
    """What compile_region makes, as files under folder, stage by stage: catalog, verdicts, merged, archive (byte volumes
    archive/<region>.gemf, ...), script and mbtiles. Returns how many stages ran.

    Each stage reads the tables that earlier ones have written, and a log tells which are whole. So a job that was stopped goes
    on behind its last finished stage and repeats none of the work before it; its checkpoints are deleted when it ends well.
    The log holds a fingerprint of the inputs: with other charts, tiles or parameters the job begins anew. on_failure: see
    compile_region; the table catalog has all charts, what follows from it only those that pass."""
    checked(profile)
    spark = charts.sparkSession
    log, ran, inputs = f"{folder}/log", 0, fingerprint(charts, tiles, profile, region, epoch, fill, limit, on_failure)
    table = lambda name: spark.read.parquet(f"{folder}/{name}")
    write = lambda name, df: df.write.mode("overwrite").parquet(f"{folder}/{name}")

    def catalog() -> None:
        write("catalog", ordered_catalog(charts))

    def verify() -> None:
        write("verdicts", tl.verify_catalog(table("catalog"), tiles.drop("content")))
        gate(table("verdicts"), on_failure)

    def passed(rows: DataFrame) -> DataFrame:
        return without(rows, gate(table("verdicts"), on_failure)) if on_failure == "drop" else rows

    def merge() -> None:
        write("merged", merged_tiles(passed(table("catalog")), tiles, fill))

    def archive() -> None:
        volumes.write_volumes(archive_of(table("merged"), region, limit), f"{folder}/archive/{region}.gemf")

    def metadata() -> None:
        write("script", tables.region_script(passed(table("catalog")), region, epoch, "--DBVERSION:3"))

    def publish() -> None:
        write("mbtiles", tables.mbtiles_rows(tl.skip_zooms(passed(tiles)) if profile == "MB_CHARTS" else table("merged")))

    steps = {"CATALOG": catalog, "TILE_VERIFY": verify}
    steps |= {} if profile == "MB_CHARTS" else {"MERGE": merge}
    steps |= {"ARCHIVE": archive, "METADATA": metadata} if profile == "MX_REGION" else {"PUBLISHED": publish}
    with scratch(spark):
        done = spark.createDataFrame([], LOG)
        try:
            done = cut(spark.read.json(log, schema=LOG).filter(F.col("inputs") == inputs))
        except AnalysisException:
            pass  # no stage has run
        jobs = spark.createDataFrame([(region, profile)], "region string, profile string")
        reached = cat.pending_stage(jobs, done, len(cat.STAGES)).first()["stage"]
        for number, stage in enumerate(cat.STAGES, 1):
            if number > reached and stage in steps:
                steps[stage]()
                spark.createDataFrame([(number, f"{region}:::{profile}:::CHECKPOINT_{stage}", inputs)], LOG).write.mode("append").json(log)
                ran += 1
    return ran
