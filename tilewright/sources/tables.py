"""Sources and sinks of catalogs, headers, overrides, tiles, manifests and scripts."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions import tilemath as tm
from ..operators.steps import cut, in_order
from .headers import ChartHeaders

CATALOG_SCHEMA = "path string, name string, min_zoom int, max_zoom int, scale int, date string, depths string, outline string, rank int"


def with_extension(files: DataFrame, exts: tuple[str, ...] = ("kap", "tif")) -> DataFrame:
    """files (path) with name and ext, those with one of the extensions in any case; a name must stand before the dot."""
    named = files.withColumn("name", text.base_name(F.col("path"))).withColumn("ext", F.regexp_extract("name", r"^.+\.([^.]*)$", 1))
    return named.filter(F.upper("ext").isin(*(e.upper() for e in exts)))


def scan_files(spark: SparkSession, folder: str, exts: tuple[str, ...] = ("kap", "tif"), include_only: DataFrame | None = None) -> DataFrame:
    """path, name, ext of the files under folder with one of the extensions, and only those of include_only (name) if given.
    Contents are not read."""
    found = with_extension(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path"), exts)
    return found if include_only is None else found.join(include_only.select("name").distinct(), "name", "left_semi")


def header_lines_of(content: Column) -> Column:
    """The lines before the first one with the byte 0x1A; bytes that are not ASCII are dropped. What follows that byte, the
    raster, is cut off in the JVM."""
    whole = F.decode(content, "ISO-8859-1")
    head = F.regexp_replace(F.substring_index(whole, "\x1a", 1), r"[^\x00-\x7F]", "")
    lines = F.split(head, "\n")
    closed = F.contains(whole, F.lit("\x1a")) | (F.element_at(lines, -1) == "")  # the last piece is no whole line
    return F.when(closed, F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)


def mounted(paths: list[str]) -> bool:
    return all(urlparse(p).scheme in ("", "file") for p in paths)


def read_chart_headers(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """path and lines, one row a chart file. On a mounted file system a file is read up to the end of its header only, however large
    it is; stores that only Spark reaches give it whole files, whose contents end in the task that reads them."""
    asked = [paths] if isinstance(paths, str) else paths
    if mounted(asked):
        spark.dataSource.register(ChartHeaders)
        return spark.read.format("chart_headers").option("paths", "\n".join(asked)).load()
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(asked).select("path", header_lines_of(F.col("content")).alias("lines"))


def read_catalog(spark: SparkSession, path: str, pretty: bool = False) -> DataFrame:
    """A catalog with its rank, and the ring of its outline; a missing one is an error. Its JSON has a row a line, as
    write_catalog leaves it, or is an array; pretty: one that is laid out over many lines, which a single task reads."""
    return spark.read.schema(CATALOG_SCHEMA).option("multiLine", pretty).json(path).withColumn("ring", text.parse_outline(F.col("outline")))


def write_catalog(df: DataFrame, path: str) -> None:
    """Replaces the catalog at path, ordered by rank."""
    df.select(*(c.split()[0] for c in CATALOG_SCHEMA.split(", "))).orderBy("rank").write.mode("overwrite").json(path)


def read_product_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Names of the chart files that a product catalog's extents list. The file is cut at the ends of extents, so that a large
    one is read by many tasks."""
    extents = spark.read.option("lineSep", "EX_Extent>").text(path).filter(F.col("value").rlike(r"</([A-Za-z0-9]+:)?$"))
    inside = F.regexp_replace("value", r"(?s)^.*<([A-Za-z0-9]+:)?EX_Extent\b", "")
    return extents.select(F.explode(F.regexp_extract_all(inside, F.lit(r"(?s)file name: ([^<]*?\.KAP)"), 1)).alias("name"))


def tile_key(path: Column) -> Column:
    """(tile set, z, x, y) of a path .../set/z/x/y.png; nulls if it is none."""
    part = lambda i: F.regexp_extract(path, r"([^/]+)/([0-9]+)/([0-9]+)/([0-9]+)\.png$", i)
    return F.struct(F.nullif(part(1), F.lit("")).alias("tileset"), part(2).try_cast("int").alias("z"), part(3).try_cast("long").alias("x"), part(4).try_cast("long").alias("y"))


def read_tile_tree(spark: SparkSession, folder: str) -> DataFrame:
    """tileset, z, x, y, content of the tiles under folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(tile_key(F.col("path")).alias("k"), "content").filter("k.z is not null").select("k.*", "content")


def read_overrides(spark: SparkSession, folder: str, layout: str) -> DataFrame:
    """key and closed ring of each override file. Layouts: ply (PLY/n,lat,lng), dmm (DD MM.mmm,DDD MM.mmm), plain (lat,lng,
    closed already; the key is the name without .txt). On a mounted file system a task reads many of these small files."""
    if mounted([folder]):
        spark.dataSource.register(ChartHeaders)
        files = spark.read.format("chart_headers").option("paths", folder).option("whole", "true").load().select(text.base_name(F.col("path")).alias("key"), "lines")
    else:
        files = spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("key"), F.split("value", r"\r?\n").alias("lines"))
    field = lambda x, i: F.trim(F.get(F.split(x, ","), F.lit(i)))
    if layout == "ply":
        ring = text.header_ring(F.col("lines"))
    else:
        read = text.dmm_to_degrees if layout == "dmm" else lambda s: s.try_cast("double")
        points = F.filter(F.transform("lines", lambda x: text.point(read(field(x, 0)), read(field(x, 1)))), lambda p: p["lat"].isNotNull() & p["lng"].isNotNull())
        ring = text.close_ring(points) if layout == "dmm" else points
    key = F.regexp_replace("key", r"\.txt$", "") if layout == "plain" else F.col("key")
    return files.select(key.alias("key"), ring.alias("ring"))


def mbtiles_rows(tiles: DataFrame) -> DataFrame:
    """Tiles as rows of an mbtiles file: rows count from the bottom. A content column becomes tile_data."""
    data = [F.col("content").alias("tile_data")] if "content" in tiles.columns else []
    return tiles.select(F.col("z").alias("zoom_level"), F.col("x").alias("tile_column"), tm.flip_tile_y(F.col("y"), F.col("z")).alias("tile_row"), *data)


def metadata_rows(sets: DataFrame) -> DataFrame:
    """sets (tileset, name, min_zoom, max_zoom, bounds) as rows tileset, name, value."""
    pairs = F.array(*(F.struct(F.lit(n).alias("name"), v.cast("string").alias("value")) for n, v in (("name", F.col("name")), ("type", F.lit("overlay")), ("version", F.lit("1.0.0")), ("format", F.lit("png")), ("minzoom", F.col("min_zoom")), ("maxzoom", F.col("max_zoom")), ("bounds", F.col("bounds")))))
    return sets.select("tileset", F.explode(pairs).alias("p")).select("tileset", "p.*")


def to_mbtiles_tables(tiles: DataFrame, sets: DataFrame, path: str) -> None:
    """tiles (tileset, z, x, y, content) and their sets' metadata as two Parquet tables. Tiles lie in order of set, zoom, column and
    row, so that who asks for a set reads the few row groups that may have it. A folder for each set and zoom would be
    hundreds of thousands, with a file in each from every task."""
    named = tiles.withColumn("tileset", text.tileset_name(F.col("tileset")))
    rows = named.select("tileset", F.col("z").alias("zoom_level"), F.col("x").alias("tile_column"), tm.flip_tile_y(F.col("y"), F.col("z")).alias("tile_row"), F.col("content").alias("tile_data"))
    order = ("tileset", "zoom_level", "tile_column", "tile_row")
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/tiles")
    metadata_rows(sets.withColumn("tileset", text.tileset_name(F.col("tileset")))).write.mode("overwrite").parquet(f"{path}/metadata")


def archive_rows(head: DataFrame, tiles: DataFrame) -> DataFrame:
    """An archive as rows volume, part, seq_no, at, bytes: head (part, seq_no, bytes, at; see archive_head) opens volume 0, tiles
    (volume, tile_no, at, content) are part 3. write_volumes makes files of them."""
    body = tiles.select("volume", F.lit(3).alias("part"), F.col("tile_no").cast("long").alias("seq_no"), "at", F.col("content").alias("bytes"))
    return head.select(F.lit(0).alias("volume"), "part", "seq_no", "at", "bytes").unionByName(body)


def write_archive(rows: DataFrame, path: str) -> None:
    """An archive as Parquet, a folder a volume: column bytes, in order of at, is the volume's stream."""
    rows.repartitionByRange("volume", "at").sortWithinPartitions("volume", "at").write.mode("overwrite").partitionBy("volume").parquet(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The rows of an archive, with the place in its volume at which each begins."""
    return spark.read.parquet(path)


def region_script(catalog: DataFrame, region: str, epoch: int, version_line: str, custom: tuple[str, int] | None = None) -> DataFrame:
    """line_no and line of a region's script: the version line, the region's statements (custom: its description and the
    archive's size), then an INSERT a chart in the catalog's order."""
    spark = catalog.sparkSession
    first = text.custom_region_sql(F.lit(region), F.lit(custom[0]), F.lit(custom[1]), F.lit(epoch)) if custom else F.concat(text.region_update_sql(F.lit(region), F.lit(epoch)), text.region_clear_sql(F.lit(region)))
    head = spark.range(1).select(F.posexplode(F.array(F.lit(version_line + "\n"), first)).alias("line_no", "line")).withColumn("line_no", F.col("line_no") - 2)
    rows = catalog.select(F.col("rank").alias("line_no"), text.format_chart_sql(F.lit(region), *(F.col(x) for x in ("path", "name", "date", "scale", "outline", "depths", "max_zoom"))).alias("line"))
    return head.select(F.col("line_no").cast("long"), "line").unionByName(rows.select(F.col("line_no").cast("long"), "line"))


def write_region_sql(catalog: DataFrame, region: str, path: str, epoch: int, version_line: str = "--DBVERSION:3", custom: tuple[str, int] | None = None) -> None:
    """The script as text, in order."""
    region_script(catalog, region.strip().upper(), epoch, version_line, custom).orderBy("line_no").select(F.regexp_replace("line", r"\n$", "")).write.mode("overwrite").text(path)


def json_text(value: Column) -> Column:
    """A string as JSON text, with its quotes."""
    return F.regexp_extract(F.to_json(F.array(value)), r"(?s)^\[(.*)\]$", 1)


def ended(lines: DataFrame, head: str, tail: str) -> DataFrame:
    """Lines of a JSON text (place, from 0, and line) with one before and one behind them."""
    ends = lines.agg(F.count("*").alias("n")).select(F.explode(F.array(*(F.struct(p.cast("long").alias("place"), F.lit(v).alias("line")) for p, v in ((F.lit(-1), head), (F.col("n"), tail))))).alias("e"))
    return lines.select(F.col("place").cast("long").alias("place"), "line").unionByName(ends.select("e.*"))


def manifest_lines(df: DataFrame, kind: str = "regions") -> DataFrame:
    """place and line of a manifest's JSON: a map of region to its fields, or the list of charts, each on a line of its own, with
    manifest_version 1. A region occurs once."""
    if kind == "regions":
        entry = F.concat(json_text(F.col("region")), F.lit(":"), F.to_json(F.struct(*(c for c in df.columns if c != "region"))))
        rows, ends = in_order(df, "region"), "{}"
    else:
        entry, ends = F.to_json(F.struct(*df.columns)), "[]"
        rows = in_order(df, *df.columns)
    line = F.concat(F.when(F.col("place") == 0, "").otherwise(","), entry)
    return ended(rows.select("place", line.alias("line")), f'{{"manifest_version":1,"{kind}":{ends[0]}', ends[1] + "}")


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines in order of place as text: files by ranges, which make one text in order of their names."""
    lines.orderBy("place").select("line").write.mode("overwrite").text(path)


def write_manifest(df: DataFrame, path: str, kind: str = "regions") -> None:
    write_lines(manifest_lines(df, kind), path)


def read_manifest(spark: SparkSession, path: str, fields: str, kind: str = "regions") -> DataFrame:
    """The rows of a manifest that write_manifest wrote, as a table of those fields (and region), read by lines."""
    body = F.regexp_replace(F.col("value"), "^,", "")
    rows = spark.read.text(path).filter(~F.col("value").startswith('{"manifest_version"') & ~F.col("value").isin("}}", "]}"))
    if kind == "regions":
        entries = F.from_json(F.concat(F.lit("{"), body, F.lit("}")), f"map<string, struct<{fields}>>")
        return rows.select(F.explode(entries).alias("region", "_f")).select("region", "_f.*")
    return rows.select(F.from_json(body, f"struct<{fields}>").alias("_f")).select("_f.*")


def write_region_manifest(assigned: DataFrame, path: str) -> None:
    """Chart names by region, one a line."""
    assigned.select("region", text.chart_base_name(F.col("path")).alias("value")).orderBy("region", "value").write.mode("overwrite").partitionBy("region").text(path)


def read_region_manifest(spark: SparkSession, path: str, png: DataFrame, tif: DataFrame) -> DataFrame:
    """region, name and the chart's path: its png if there is one, else its tif, else null (an error to its reader)."""
    names = spark.read.text(path).select("region", F.trim("value").alias("name"))
    keyed = lambda d, c: d.select(text.chart_base_name(F.col("path")).alias("name"), F.col("path").alias(c))
    return names.join(keyed(png, "_png"), "name", "left").join(keyed(tif, "_tif"), "name", "left").select("region", "name", F.coalesce("_png", "_tif").alias("path"))


def region_files_map(assigned: DataFrame) -> DataFrame:
    """place and line of the JSON {region: [paths]}, a path a line, so that a region may have any number of them. A path that
    repeats is listed as often."""
    placed = in_order(assigned.select("region", "path"), "region", "path")
    opening = placed.groupBy("region").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("_opens"))
    opener = F.concat(F.when(F.col("place") == 0, "").otherwise("],"), json_text(F.col("region")), F.lit(":["))
    line = F.concat(F.when(F.col("_opens"), opener).otherwise(","), json_text(F.col("path")))
    lines = ended(placed.join(opening, "place", "left").select("place", line.alias("line")), "{", "]}")
    return lines.withColumn("line", F.when((F.col("line") == "]}") & (F.col("place") == 0), "}").otherwise(F.col("line")))


def write_region_files(assigned: DataFrame, path: str) -> None:
    write_lines(region_files_map(assigned), path)


def read_region_files(spark: SparkSession, path: str) -> DataFrame:
    """region and path of what write_region_files wrote. A line's region is on the last line before it that opens one: within a
    split that is a running window, and what lies before a split comes from a table of a row a split."""
    quoted = r'"(?:[^"\\]|\\.)*"'
    plain = lambda text: F.get(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>"), F.lit(0))
    split = ["_file", "_start"]
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_no"), "value")
    opener = F.nullif(F.regexp_extract("value", rf"^(?:\],)?({quoted}):\[", 1), F.lit(""))
    read = cut(lines.withColumns({"_opens": plain(opener), "path": plain(F.regexp_extract("value", rf"({quoted})$", 1))}).drop("value"))
    last = read.groupBy(*split).agg(F.max_by("_opens", F.when(F.col("_opens").isNotNull(), F.col("_no"))).alias("_last"))
    before = last.select(*split, F.last("_last", ignorenulls=True).over(Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    here = F.last("_opens", ignorenulls=True).over(Window.partitionBy(*split).orderBy("_no"))
    found = read.withColumn("_here", here).join(F.broadcast(before), split)
    return found.filter("path is not null").select(F.coalesce("_here", "_before").alias("region"), "path")
