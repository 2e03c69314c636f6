"""Charts: validity, the ranked catalog, provider rules, regions, overrides, joins with sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, text
from .steps import cut, in_order

# fixed values: providers and regions
PROVIDERS = {"noaa": "noaa/bsb", "brazil": "brazil/bsb", "linz": "linz/bsb", "ukho": "ukho/geotiff", "wavey-lines": "wavey-lines/geotiff", "faa": "faa/geotiff"}
REGIONS = [
    ("REGION_02", "noaa", "Block Island RI to the Canadian Border", "kap"),
    ("REGION_03", "noaa", "New York to Nantucket and Cape May NJ", "kap"),
    ("REGION_04", "noaa", "Chesapeake and Delaware Bays", "kap"),
    ("REGION_06", "noaa", "Norfolk VA to Florida including the ICW", "kap"),
    ("REGION_07", "noaa", "Florida East Coast and the Keys", "kap"),
    ("REGION_08", "noaa", "Florida West Coast and the Keys", "kap"),
    ("REGION_10", "noaa", "Puerto Rico and the U.S. Virgin Islands", "kap"),
    ("REGION_12", "noaa", "Southern California, Point Arena to the Mexican Border", "kap"),
    ("REGION_13", "noaa", "Lake Michigan", "kap"),
    ("REGION_14", "noaa", "San Francisco to Cape Flattery", "kap"),
    ("REGION_15", "noaa", "Pacific Northwest, Puget Sound to the Canadian Border", "kap"),
    ("REGION_17", "noaa", "Mobile AL to the Mexican Border", "kap"),
    ("REGION_22", "noaa", "Lake Superior and Lake Huron (U.S. Waters)", "kap"),
    ("REGION_24", "noaa", "Lake Erie (U.S. Waters)", "kap"),
    ("REGION_26", "noaa", "Lake Ontario (U.S. Waters)", "kap"),
    ("REGION_30", "noaa", "Southeast Alaska", "kap"),
    ("REGION_32", "noaa", "South Central Alaska, Yakutat to Kodiak", "kap"),
    ("REGION_34", "noaa", "Alaska, The Aleutians and Bristol Bay", "kap"),
    ("REGION_36", "noaa", "Alaska, Norton Sound to Beaufort Sea", "kap"),
    ("REGION_40", "noaa", "Hawaiian Islands and U.S. Territories", "kap"),
    ("REGION_BR", "brazil", "Brazil: Guyana to Uruguay", "kap"),
    ("REGION_NZ", "linz", "New Zealand and South Pacific: Samoa to Ross Sea", "kap"),
    ("REGION_UK1", "ukho", "United Kingdom North East Coast to Shetland Islands", "tif"),
    ("REGION_UK2", "ukho", "United Kingdom South East Coast and Channel Islands", "tif"),
    ("REGION_UK3", "ukho", "United Kingdom North West Coast and Ireland West Coast", "tif"),
    ("REGION_UK4", "ukho", "United Kingdom South West Coast and Ireland East Coast - Irish Sea", "tif"),
    ("REGION_WL1", "wavey-lines", "Caribbean West Florida and Bahamas to Long Island", "tif"),
    ("REGION_WL2", "wavey-lines", "Caribbean East Turks And Caicos Islands Crooked Island to Dominican Republic", "tif"),
    ("REGION_FAA_PLANNING", "faa", "FAA VFR Planning Charts", "tif"),
    ("REGION_FAA_SECTIONAL", "faa", "FAA VFR Sectional Charts", "tif"),
    ("REGION_FAA_TERMINAL", "faa", "FAA VFR Terminal Charts", "tif"),
    ("REGION_FAA_HELICOPTER", "faa", "FAA VFR Helicopter charts", "tif"),
    ("REGION_FAA_CARIBBEAN", "faa", "FAA VFR Caribbean Charts", "tif"),
]
ENCRYPTED = ("wavey-lines", "ukho")


def valid_charts(headers: DataFrame) -> DataFrame:
    """Headers (with scale and name) of charts proper: a scale, and no cover sheet. A missing name is no cover."""
    return headers.filter(F.col("scale").isNotNull() & ~F.coalesce(F.col("name").contains("Cover for Chart"), F.lit(False)))


def parse_headers(files: DataFrame, lines: str = "lines") -> DataFrame:
    """files with the fields of their header lines. Lines are classed once, and what several fields are read from is a column."""
    x, col = F.col("_classed"), F.col
    found = files.withColumn("_classed", text.classed_lines(F.col(lines))).withColumns({
        "_un": text.last_of(x, "UN=", True), "_ced": text.last_of(x, "CED/SE", True), "_bsb": text.last_of(x, "BSB/NA", True),
        "_knp": text.knp_fields(x, True), "_ply": text.ply_points(x, True),
    })
    return found.withColumns({
        "scale": text.knp_field(col("_knp"), "SC").try_cast("int"), "projection": text.knp_field(col("_knp"), "PR"), "datum": text.knp_field(col("_knp"), "GD"), "units": text.units_in(col("_un")),
        "updated": text.updated_in(col("_ced")), "name": text.name_in(col("_bsb")), "ring": text.close_ring(col("_ply")), "refs": text.header_refs(x, True),
    }).drop("_classed", "_un", "_ced", "_bsb", "_knp", "_ply")


def apply_ring_overrides(charts: DataFrame, overrides: DataFrame, key: str = "base") -> DataFrame:
    """charts (key, ring) with the override's ring, closed, in place of their own where overrides (key, ring) has one.
    Leading zeros of the key don't count. Spark broadcasts overrides, a hand-made table, as long as they are small."""
    bare = lambda c: F.regexp_replace(c, "^0+", "")
    o = overrides.select(bare(F.col(key)).alias("_k"), F.col("ring").alias("_ring"))
    closed = F.when(F.element_at("_ring", 1) == F.element_at("_ring", -1), F.col("_ring")).otherwise(text.close_ring(F.col("_ring")))
    return charts.join(o, bare(F.col(key)) == F.col("_k"), "left").withColumn("ring", F.coalesce(F.when(F.size("_ring") > 0, closed), "ring")).drop("_k", "_ring")


def catalog_order(df: DataFrame) -> DataFrame:
    """df with rank: 1 for the greatest scale; equal scales by path, nulls last. The order is global: see in_order."""
    return in_order(df, F.col("scale").desc_nulls_last(), F.col("path"), place="_place").withColumn("rank", (F.col("_place") + 1).cast("int")).drop("_place")


def build_catalog(headers: DataFrame) -> DataFrame:
    """Headers (path, name, scale, updated, units, ring) as catalog rows with rank. Charts are told from others once rows are written:
    a filter on parsed fields would parse them a second time, and before rows are dealt out (see dealt)."""
    center = geo.ring_center(F.col("ring"))
    zoom = geo.zoom_for_scale(F.col("scale"), center["lat"])
    rows = headers.withColumn("zoom", zoom.cast("int"))
    rows = rows.select("path", "name", F.col("zoom").alias("min_zoom"), F.col("zoom").alias("max_zoom"), "scale", F.col("updated").alias("date"), F.col("units").alias("depths"), text.format_outline(F.col("ring")).alias("outline"), "ring")
    return catalog_order(valid_charts(cut(rows)))  # ranges are sampled first, which would parse all headers twice


def catalog_fields_by_provider(df: DataFrame) -> DataFrame:
    """df (provider, path, name, scale, lat, date, depths, outline, bounds_outline, span: metres that the raster spans,
    xsize, today) with the fields of a catalog by the provider's rule."""
    provider, is_kap = F.col("provider"), F.upper(F.col("path")).endswith("KAP")
    by_header = geo.zoom_for_scale(F.col("scale"), F.col("lat"))
    true = lambda dpi: F.col("span") / (F.col("xsize") / dpi / 39.3701)
    zoom_of = lambda s: geo.zoom_from_true_scale(s)
    tif_scale = lambda dpi: true(dpi).cast("long")
    mixed = provider.isin("brazil", "wavey-lines")
    tif = mixed & ~is_kap
    low = F.when(provider == "ukho", zoom_of(true(127))).when(provider == "faa", F.greatest(F.lit(0), zoom_of(tif_scale(300)) - 8)).when(tif, zoom_of(tif_scale(400)) + 1).otherwise(by_header)
    high = F.when(provider == "faa", zoom_of(tif_scale(300))).otherwise(F.col("low"))
    by_file = (provider == "faa") | tif
    return df.withColumn("low", low.cast("int")).select(
        "*",
        F.when(by_file, text.chart_base_name(F.col("path"))).otherwise(F.col("name")).alias("c_name"), F.col("low").alias("c_min_zoom"), high.cast("int").alias("c_max_zoom"),
        F.when(provider == "faa", tif_scale(300)).when(tif, tif_scale(400)).otherwise(F.col("scale").cast("long")).alias("c_scale"),
        F.when(by_file, F.col("today")).otherwise(F.col("date")).alias("c_date"),
        F.when(provider == "faa", "None").when(tif & (provider == "brazil"), "Unknown").when(tif, "Meters").otherwise(F.col("depths")).alias("c_depths"),
        F.when(by_file, F.col("bounds_outline")).otherwise(F.col("outline")).alias("c_outline"),
    ).drop("low")


def region_table(spark) -> DataFrame:
    rows = [(r, p, d, t, PROVIDERS[p]) for r, p, d, t in REGIONS]
    return spark.createDataFrame(rows, "region string, provider string, description string, map_type string, map_dir string")


def region_attributes(df: DataFrame, region: str = "region") -> DataFrame:
    """df with provider, description, map_type, map_dir and valid by its region, upper or lower case; unknown: nulls, false."""
    table = F.broadcast(region_table(df.sparkSession).withColumnRenamed("region", "_region"))  # 33 rows
    return df.join(table, F.upper(F.col(region)) == F.col("_region"), "left").withColumn("valid", F.col("_region").isNotNull()).drop("_region")


def needs_encryption(provider: Column) -> Column:
    """Whether archives of the provider's charts are encrypted, and so get another extension."""
    return F.coalesce(provider.isin(*ENCRYPTED), F.lit(False))


def region_chart_files(files: DataFrame, product: DataFrame, covers: DataFrame, problems: DataFrame, additions: DataFrame) -> DataFrame:
    """files (path, name) whose name the product catalog lists, less covers and problem charts, plus the additions, which
    may bring one back. All but files have a column name. A row a file."""
    wanted = product.select("name").join(covers, "name", "left_anti").join(problems, "name", "left_anti").unionByName(additions.select("name")).distinct()
    return files.join(wanted, "name", "left_semi")


def custom_region_files(files: DataFrame, region: str) -> DataFrame:
    """The chart files (column path, kap alone) anywhere under a directory named like the region."""
    parts = F.split(F.col("path"), "/")
    return files.filter(F.array_contains(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), region) & F.upper(F.col("path")).endswith(".KAP"))


def product_names(nodes: DataFrame, xml: str = "xml") -> DataFrame:
    """nodes with name: the chart files that their text lists after 'file name: ', one row each."""
    return nodes.withColumn("name", F.explode(F.regexp_extract_all(xml, F.lit(r"file name: ([^<]*?\.KAP)"), 1)))


def spreadsheet_charts(charts: DataFrame, panels: DataFrame, depth_codes: DataFrame) -> DataFrame:
    """Charts (panel 0) and panels with prefix ---, one row a stamp: a panel row beats a chart row, a later row an earlier."""
    part = lambda d, panel, order: d.filter(F.trim("prefix") == "---").select("row_no", F.col("number").cast("string").alias("number"), "suffix", panel.cast("string").alias("panel"), "title", "scale", "depth_code", F.lit(order).alias("_o"))
    rows = part(charts, F.lit("0"), 0).unionByName(part(panels, F.col("panel"), 1)).withColumn("stamp", text.stamp_of(F.col("number"), F.col("suffix"), F.col("panel")))
    last = Window.partitionBy("stamp").orderBy(F.col("_o").desc(), F.col("row_no").desc())
    rows = rows.withColumn("_n", F.row_number().over(last)).filter("_n = 1")
    units = depth_codes.select(F.col("code").alias("depth_code"), text.depth_label(F.col("unit")).alias("depths"))
    return rows.join(units, "depth_code", "left").select("stamp", "number", "suffix", "panel", text.clean_title(F.col("title")).alias("name"), "scale", F.coalesce("depths", F.lit("UNKNOWN")).alias("depths"))


def apply_editions(charts: DataFrame, editions: DataFrame) -> DataFrame:
    """charts with updated: the date of the last readable edition row of their number, whatever suffix and panel."""
    dates = editions.filter((F.trim("prefix") == "---") & F.col("serial").isNotNull()).groupBy(F.col("number").cast("string").alias("number")).agg(F.max_by("serial", "row_no").alias("serial"))
    return charts.join(dates.select("number", text.edition_date(F.col("serial")).alias("updated")), "number", "left")


def attach_vertices(charts: DataFrame, vertices: DataFrame, order: tuple[str, ...] = ("row_no", "lat_cell", "lng_cell")) -> DataFrame:
    """charts (stamp) with ring: their vertices in sheet order, closed; unreadable cells and unknown stamps are left out."""
    degrees = lambda c: text.dmm_to_degrees(text.split_dmm_cell(F.col(c)))
    points = vertices.select(text.stamp_of(F.col("number"), F.trim("suffix"), F.col("panel")).alias("stamp"), *order, degrees("lat_cell").alias("lat"), degrees("lng_cell").alias("lng")).dropna(subset=["lat", "lng"])
    rings = points.groupBy("stamp").agg(F.sort_array(F.collect_list(F.struct(*order, "lat", "lng"))).alias("v"))
    ring = text.close_ring(F.transform("v", lambda p: text.point(p["lat"], p["lng"])))
    return charts.join(rings.select("stamp", ring.alias("ring")), "stamp")


def metadata_for_files(files: DataFrame, charts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files with their chart's metadata by stamp, files without any)."""
    stamped = files.withColumn("stamp", text.file_stamp(F.col("path")))
    return stamped.join(charts, "stamp"), stamped.join(charts, "stamp", "left_anti")


def extract_links(pages: DataFrame, ext: str) -> DataFrame:
    """(page_id, pos, link): addresses in <a href> that end in ext, resolved against the page."""
    found = pages.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), 1)).alias("pos", "href"))
    return found.filter(F.col("href").endswith(ext)).select("page_id", "pos", text.resolve_link(F.col("url"), F.col("href")).alias("link"))


def latest_links(links: DataFrame, excludes: DataFrame, file: str = "file", pos: str = "pos") -> DataFrame:
    """Per name without digits, the link with the greatest number (the first of equals), less excludes (name)."""
    parsed = links.withColumn("_p", text.name_and_number(F.col(file))).select("*", "_p.name", "_p.number").drop("_p")
    best = parsed.groupBy("name").agg(F.max_by(F.struct(*links.columns, "number"), F.struct("number", -F.col(pos))).alias("b"))
    return best.select("name", "b.*").join(excludes, "name", "left_anti")


STAGES = ("CATALOG", "TILE_VERIFY", "MERGE", "OPT", "ENCRYPTED", "ARCHIVE", "METADATA", "PUBLISHED")  # fixed values after CHECKPOINT_, in order from 1; 0 is not started


def latest_stage(log: DataFrame, stages: tuple[str, ...] = STAGES) -> DataFrame:
    """(region, profile, stage) of the last line of each: lines are region:::profile:::stage; others are ignored, an unknown
    stage is 0."""
    part = F.split(F.col("line"), ":::")
    number = F.coalesce(F.nullif(F.array_position(F.array(*(F.lit(f"CHECKPOINT_{s}") for s in stages)), F.upper(F.trim(part[2]))), F.lit(0)), F.lit(0))
    rows = log.filter(F.size(part) == 3).select("line_no", F.upper(F.trim(part[0])).alias("region"), F.upper(F.trim(part[1])).alias("profile"), number.cast("int").alias("stage"))
    return rows.groupBy("region", "profile").agg(F.max_by("stage", "line_no").alias("stage"))


def pending_stage(jobs: DataFrame, log: DataFrame, stage: int) -> DataFrame:
    """jobs (region, profile) with the stage they reached (0 if none) and whether this one is still to do."""
    reached = jobs.join(latest_stage(log), ["region", "profile"], "left").withColumn("stage", F.coalesce("stage", F.lit(0)))
    return reached.withColumn("pending", F.col("stage") < stage)
