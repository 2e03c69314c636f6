"""Header lines, file names, outlines, dates and generated texts as Column functions.

Where a name says `lines`, it is the array of a chart header's lines. A line has one class, the first of these marks that
it contains: KNP/SC, REF/, UN=, CED/SE, BSB/NA, PLY/."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .tilemath import Value, col

CLASSES = ("KNP/SC", "REF/", "UN=", "CED/SE", "BSB/NA", "PLY/")


def line_class(line: Column) -> Column:
    out = F.when(line.contains(CLASSES[0]), CLASSES[0])
    for mark in CLASSES[1:]:
        out = out.when(line.contains(mark), mark)
    return out


def classed_lines(lines: Column) -> Column:
    """The lines that have a class, each with it (mark, line)."""
    return F.filter(F.transform(lines, lambda x: F.struct(line_class(x).alias("mark"), x.alias("line"))), lambda x: x["mark"].isNotNull())


def of_class(lines: Column, mark: str, classed: bool = False) -> Column:
    """classed: lines are those of classed_lines, so that who reads many fields classes lines once."""
    if not classed:
        return F.filter(lines, lambda x: line_class(x) == mark)
    return F.transform(F.filter(lines, lambda x: x["mark"] == mark), lambda x: x["line"])


def last_of(lines: Column, mark: str, classed: bool = False) -> Column:
    return F.try_element_at(of_class(lines, mark, classed), F.lit(-1))


def after(text: Column, mark: str) -> Column:
    """What follows the first mark in text; text from place len(mark) on if there is none, as positions count from -1."""
    return F.when(F.locate(mark, text) > 0, F.substr(text, F.locate(mark, text) + F.lit(len(mark)))).otherwise(F.substr(text, F.lit(len(mark))))


def header_lines(text: Column) -> Column:
    return F.split(text, "\n")


def knp_fields(lines: Column, classed: bool = False) -> Column:
    """The fields of all scale lines, in order."""
    return F.flatten(F.transform(of_class(lines, "KNP/SC", classed), lambda x: F.split(F.ltrim(x, F.lit("KNP/")), ",")))


def knp_field(fields: Column, key: str) -> Column:
    """The last field key=... of the last scale line that has one."""
    found = F.filter(fields, lambda f: f.startswith(f"{key}="))
    return F.trim(F.rtrim(F.substr(F.try_element_at(found, F.lit(-1)), F.lit(len(key) + 2)), F.lit("\r\n")))


def header_scale(lines: Column) -> Column:
    return knp_field(knp_fields(lines), "SC").try_cast("int")


def header_projection(lines: Column) -> Column:
    return knp_field(knp_fields(lines), "PR")


def header_datum(lines: Column) -> Column:
    return knp_field(knp_fields(lines), "GD")


def header_units(lines: Column) -> Column:
    return units_in(last_of(lines, "UN="))


def units_in(line: Column) -> Column:
    """What stands after UN= up to the next comma; without one, all but the line's last character. Unknown if no line says."""
    rest = after(line, "UN=")
    cut = F.when(F.locate(",", rest) > 0, F.substr(rest, F.lit(1), F.locate(",", rest) - 1)).otherwise(F.substr(rest, F.lit(1), F.greatest(F.length(rest) - 1, F.lit(0))))
    return F.coalesce(cut, F.lit("Unknown"))


def header_updated(lines: Column) -> Column:
    return updated_in(last_of(lines, "CED/SE"))


def updated_in(line: Column) -> Column:
    """The eleven characters after ED=, trimmed."""
    return F.trim(F.substr(after(line, "ED="), F.lit(1), F.lit(11)))


def header_name(lines: Column) -> Column:
    return name_in(last_of(lines, "BSB/NA"))


def name_in(line: Column) -> Column:
    """What stands between BSB/NA= and the line's first comma, without apostrophes."""
    start, comma = F.locate("BSB/NA=", line) + 7, F.locate(",", line)
    stop = F.when(comma > 0, comma).otherwise(F.length(line))
    return F.trim(F.replace(F.substr(line, start, F.greatest(stop - start, F.lit(0))), F.lit("'"), F.lit("")))


def header_refs(lines: Column, classed: bool = False) -> Column:
    return F.transform(of_class(lines, "REF/", classed), lambda x: F.regexp_replace(F.regexp_replace(x, "REF/[0-9]*,", ""), r"[\r\n]+$", ""))


def has_duplicate_refs(lines: Column) -> Column:
    refs = header_refs(lines)
    return F.size(F.array_distinct(refs)) < F.size(refs)


def point(lat: Column, lng: Column) -> Column:
    return F.struct(lat.alias("lat"), lng.alias("lng"))


def close_ring(ring: Column) -> Column:
    """ring with its first vertex again at its end; an empty one stays empty."""
    return F.when(F.size(ring) > 0, F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)


def header_ring(lines: Column) -> Column:
    """The closed ring of the PLY lines, in order. Lines whose numbers can't be read are left out."""
    return close_ring(ply_points(lines))


def ply_points(lines: Column, classed: bool = False) -> Column:
    """The points of the PLY lines, not closed."""
    return points_of(F.transform(of_class(lines, "PLY/", classed), lambda x: F.split(x, ",")), 1)


def points_of(rows: Column, first: int) -> Column:
    """Points from arrays of strings, latitudes at place first and longitudes behind them; unreadable ones are left out."""
    number = lambda x, i: F.trim(F.get(x, F.lit(i))).try_cast("double")
    return F.filter(F.transform(rows, lambda x: point(number(x, first), number(x, first + 1))), lambda p: p["lat"].isNotNull() & p["lng"].isNotNull())


def parse_outline(outline: Column) -> Column:
    """'lat,lng:lat,lng:...' as a ring; null or empty gives an empty one."""
    return points_of(F.transform(F.split(F.coalesce(outline, F.lit("")), ":"), lambda s: F.split(s, ",")), 0)


def format_outline(ring: Column) -> Column:
    return F.array_join(F.transform(ring, lambda p: F.concat_ws(",", p["lat"].cast("string"), p["lng"].cast("string"))), ":")


def base_name(path: Column) -> Column:
    """The last segment of a path."""
    return F.element_at(F.split(path, "/"), -1)


def drop_extension(name: Column) -> Column:
    """name up to its last dot; all of it if there is none."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def chart_base_name(path: Column) -> Column:
    return drop_extension(base_name(path))


def decode_chart_file_name(name: Column) -> Column:
    """struct(number, suffix, panel) of a file name (or path): leading digits without leading zeros; the text from there to
    the first hyphen, or - if there is none; the text from the hyphen to an underscore or a further hyphen, or the end.
    Without a hyphen the suffix ends at an underscore and the panel is 0."""
    base = chart_base_name(name)
    digits = F.regexp_extract(base, "^([0-9]*)", 1)
    rest = F.substr(base, F.length(digits) + 1)
    hyphen = F.locate("-", rest)
    suffix = F.when(hyphen > 0, F.substr(rest, F.lit(1), hyphen - 1)).otherwise(F.regexp_extract(rest, "^([^_]*)", 1))
    panel = F.when(hyphen > 0, F.regexp_extract(F.substr(rest, hyphen + 1), "^([^_-]*)", 1)).otherwise(F.lit("0"))
    return F.struct(
        F.regexp_replace(digits, "^0+", "").alias("number"), F.when(suffix == "", F.lit("-")).otherwise(suffix).alias("suffix"), panel.alias("panel")
    )


def stamp_of(number: Value, suffix: Value, panel: Value) -> Column:
    return F.concat_ws("_", col(number).cast("string"), col(suffix).cast("string"), col(panel).cast("string"))


def file_stamp(name: Column) -> Column:
    d = decode_chart_file_name(name)
    return stamp_of(d["number"], d["suffix"], d["panel"])


def sanitize_file_name(name: Column) -> Column:
    """Blanks become _, & becomes And; of the rest only letters, digits, _ and the last dot stay."""
    return F.regexp_replace(F.replace(F.replace(name, F.lit(" "), F.lit("_")), F.lit("&"), F.lit("And")), r"[^_a-zA-Z0-9.]|\.(?=.*\.)", "")


def dmm_to_degrees(text: Column) -> Column:
    """'DD MM.mmm' in degrees; with a leading minus the minutes count down too, also below one degree."""
    degrees, minutes = (F.get(F.split(F.trim(text), " +"), F.lit(i)).try_cast("double") for i in (0, 1))
    return F.when(F.trim(text).startswith("-"), degrees - minutes / 60).otherwise(degrees + minutes / 60)


def split_dmm_cell(cell: Column) -> Column:
    """'DDMM.mmm' as 'DD MM.mmm': degrees end two characters before the dot; none, or a lone minus, get a 0."""
    i = F.greatest(F.locate(".", cell) - 3, F.lit(0))
    degrees = F.substr(cell, F.lit(1), i)
    return F.concat(F.when(degrees.isin("", "-"), F.concat(degrees, F.lit("0"))).otherwise(degrees), F.lit(" "), F.substr(cell, i + 1))


def name_and_number(file: Column) -> Column:
    """struct(name, number): the name without digits, and all its digits as one number, 0 if there are none."""
    return F.struct(F.regexp_replace(file, "[0-9]", "").alias("name"), F.coalesce(F.regexp_replace(file, "[^0-9]", "").try_cast("long"), F.lit(0).cast("long")).alias("number"))


def tileset_name(chart: Column) -> Column:
    return F.lower(F.regexp_replace(chart, r"\W+", "_"))


def publish_stamp(epoch: Column) -> Column:
    """TS_year-month-day_T_hour_minute in the session's time zone."""
    return F.date_format(F.timestamp_seconds(epoch), "'TS_'yyyy-MM-dd'_T_'HH_mm")


def publish_name(epoch: Column, file: Column) -> Column:
    return F.concat(publish_stamp(epoch), F.lit("_"), file)


def region_from_file(name: Column) -> Column:
    """From REGION on, up to the first dot; without REGION, the last character before the dot (places count from -1)."""
    stem = F.substring_index(name, ".", 1)
    return F.when(F.locate("REGION", stem) > 0, F.substr(stem, F.locate("REGION", stem))).otherwise(F.right(stem, F.lit(1)))


def unpublish_name(name: Column) -> Column:
    """The region's file name without its time stamp."""
    return F.concat(region_from_file(name), F.substr(name, F.locate(".", name)))


def sql_quote(value: Column) -> Column:
    return F.replace(F.trim(F.regexp_replace(value.cast("string"), r"^\s+|\s+$", "")), F.lit("'"), F.lit("''"))


def format_chart_sql(region: Value, path: Column, name: Column, date: Column, scale: Column, outline: Column, depths: Column, zoom: Column) -> Column:
    """The INSERT of one chart; its only line end is at its end."""
    text = [sql_quote(c) for c in (col(region), base_name(F.regexp_replace(path, r"^\s+|\s+$", "")), name, date, scale, outline, depths, zoom)]
    return F.format_string(
        "INSERT INTO [charts] ([region], [file], [name], [updated], [scale], [outline], [depths], [zoom]) VALUES ('%s', '%s', '%s', '%s', %s, '%s', '%s', '%s');\n", *text
    )


def region_update_sql(region: Value, epoch: Value) -> Column:
    return F.format_string("UPDATE regions SET installeddate='%s' WHERE name='%s';\n", col(epoch).cast("string"), sql_quote(col(region)))


def region_clear_sql(region: Value) -> Column:
    return F.format_string("DELETE from charts where region='%s';\n", sql_quote(col(region)))


def custom_region_sql(region: Value, description: Value, size: Value, epoch: Value) -> Column:
    """Two lines: a custom region is deleted and inserted anew."""
    r = col(region)
    return F.format_string(
        "DELETE from regions WHERE name='%s';\nINSERT into [regions] ([name], [description], [image], [size], [installeddate] ) VALUES ('%s', '%s', '%s', '%s', '%s');\n",
        sql_quote(r), sql_quote(r), sql_quote(col(description)), F.replace(F.lower(sql_quote(r)), F.lit("_"), F.lit("")), col(size).cast("string"), col(epoch).cast("string"),
    )


def installed_epoch(lines: Column) -> Column:
    """What the second line has between its first two apostrophes, if that is a region's update; else null."""
    line = F.get(lines, F.lit(1))
    return F.when(line.startswith("UPDATE regions"), F.get(F.split(line, "'"), F.lit(1)))


def checksum(content: Column) -> Column:
    return F.sha1(content.cast("binary"))


def uint_be(value: Value, n: int) -> Column:
    """The n-byte big-endian form of a number; of a larger one its last n bytes, as the reference's."""
    return F.unhex(F.right(F.lpad(F.hex(col(value).cast("long")), max(2 * n, 16), "0"), F.lit(2 * n)))


def tilejson(name: Column, min_zoom: Column, max_zoom: Column, west: Column, south: Column, east: Column, north: Column, image: str = "png") -> Column:
    """A tile set's metadata as JSON; bounds are west, south, east, north."""
    bounds = F.array_join(F.array(*(c.cast("string") for c in (west, south, east, north))), ",")
    return F.to_json(
        F.struct(name.alias("name"), F.lit("overlay").alias("type"), F.lit("1.0.0").alias("version"), F.lit("").alias("description"), F.lit(image).alias("format"),
                 bounds.alias("bounds"), F.lit("xyz").alias("scheme"), min_zoom.cast("string").alias("minzoom"), max_zoom.cast("string").alias("maxzoom"))
    )


def clean_title(s: Column) -> Column:
    return F.replace(F.regexp_replace(s, r"\s+", " "), F.lit("'"), F.lit(""))


def depth_label(s: Column) -> Column:
    return F.trim(F.replace(F.upper(s), F.lit("/"), F.lit(" AND ")))


def edition_date(serial: Column) -> Column:
    """A spreadsheet's day number as month/day/year; null for what is none."""
    day = F.date_add(F.lit("1899-12-30").cast("date"), serial.try_cast("int"))
    return F.when(serial.isNotNull(), F.concat_ws("/", F.month(day), F.day(day), F.year(day)))


def resolve_link(page: Column, href: Column) -> Column:
    """A link as an absolute address: a leading / is put behind the page's scheme and host, an address under the page
    stays, anything else is put behind the page."""
    host = F.regexp_extract(page, "^([^/]*//[^/]*)", 1)
    return F.when(href.startswith("/"), F.concat(host, href)).when(href.startswith(page), href).otherwise(F.concat(page, F.lit("/"), href))


def parse_burn_name(file: Column) -> Column:
    """struct(chart, crest, score, x_off, y_off) of 'chart:crest:score:x:y.png'."""
    part = lambda i: F.get(F.split(drop_extension(file), ":"), F.lit(i))
    return F.struct(part(0).alias("chart"), part(1).alias("crest"), part(2).try_cast("int").alias("score"), part(3).try_cast("int").alias("x_off"), part(4).try_cast("int").alias("y_off"))
