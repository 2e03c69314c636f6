"""Distances, scales, zooms, geotransforms and rings as Column functions.

A ring is an array of struct(lat, lng), a geotransform an array of six doubles: origin x, pixel width, row rotation,
origin y, column rotation, pixel height (negative when north is up)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import tilemath as tm
from .tilemath import Value, col

EARTH_KM = 6371  # fixed value of the distance formula


def let(value: Column, then) -> Column:
    """then(value), with value as a variable, so that an expression which uses it often does not grow."""
    return F.element_at(F.transform(F.array(value), then), 1)


def haversine(lng1: Value, lat1: Value, lng2: Value, lat2: Value) -> Column:
    """Metres between two points on a sphere."""
    a1, a2 = F.radians(col(lat1)), F.radians(col(lat2))
    d_lat, d_lng = a2 - a1, F.radians(col(lng2)) - F.radians(col(lng1))
    a = F.pow(F.sin(d_lat / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin(d_lng / 2), 2)
    return F.atan2(F.sqrt(a), F.sqrt(1 - a)) * (2 * EARTH_KM * 1000)


def mercator_distance(lng1: Value, lat1: Value, lng2: Value, lat2: Value) -> Column:
    """Metres between two points on the Mercator map."""
    a, b = tm.lat_lng_to_meters(lat1, lng1), tm.lat_lng_to_meters(lat2, lng2)
    return F.sqrt(F.pow(a["x"] - b["x"], 2) + F.pow(a["y"] - b["y"], 2))


def latitude_distortion(lat: Value) -> Column:
    """How much longer a degree of longitude is on the map than on the sphere."""
    return F.lit(tm.RADIUS * math.pi / 180) / let(col(lat), lambda a: haversine(F.lit(0.0), a, F.lit(1.0), a))


def zoom_from_true_scale(scale: Value) -> Column:
    """30 less the halvings that bring 70 % of the scale to one or below, 63 at most: the binary digits of the greatest whole
    number below it. The scale is a variable, as it would else be computed several times."""
    halvings = lambda s: F.when(s > 1, F.least(F.length(F.bin(F.ceil(s) - 1)), F.lit(63))).otherwise(0)
    return let((col(scale) * 0.70).cast("double"), lambda s: F.when(s.isNotNull(), F.lit(30) - halvings(s)))


def zoom_for_scale(scale: Value, lat: Value) -> Column:
    """Zoom of a chart of this scale at this latitude; 0 without a scale."""
    return F.when(col(scale).isNull(), F.lit(0)).otherwise(zoom_from_true_scale(col(scale) * latitude_distortion(lat)))


def geotransform(*six: Value) -> Column:
    return F.array(*(col(x).cast("double") for x in six))


def apply_geotransform(gt: Column, x: Value, y: Value) -> Column:
    """struct(x, y): from pixel to map."""
    return F.struct((gt[0] + col(x) * gt[1] + col(y) * gt[2]).alias("x"), (gt[3] + col(x) * gt[4] + col(y) * gt[5]).alias("y"))


def invert_geotransform(gt: Column) -> Column:
    """The geotransform from map to pixel; null where there is none."""
    det = F.nullif(gt[1] * gt[5] - gt[2] * gt[4], F.lit(0.0))
    return F.when(
        det.isNotNull(),
        F.array((gt[2] * gt[3] - gt[0] * gt[5]) / det, gt[5] / det, -gt[2] / det, (gt[0] * gt[4] - gt[1] * gt[3]) / det, -gt[4] / det, gt[1] / det),
    )


def map_to_pixel(gt: Column, mx: Value, my: Value) -> Column:
    """struct(x, y) of whole pixels, truncated toward zero."""
    plain = gt[2] + gt[4] == 0
    inverse = apply_geotransform(invert_geotransform(gt), mx, my)
    x = F.when(plain, (col(mx) - gt[0]) / F.nullif(gt[1], F.lit(0.0))).otherwise(inverse["x"])
    y = F.when(plain, (col(my) - gt[3]) / F.nullif(gt[5], F.lit(0.0))).otherwise(inverse["y"])
    return F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))


def rotation(gt: Column) -> Column:
    """Degrees from 0 up to 360; 0 if the pixel height is 0."""
    return F.coalesce(F.pmod(F.degrees(F.tanh(gt[2] / F.nullif(gt[5], F.lit(0.0)))), F.lit(360.0)), F.lit(0.0))


def is_north_up(gt: Column) -> Column:
    return F.coalesce((rotation(gt) < 0.5) | (rotation(gt) > 359.5), F.lit(False))


def raster_bounds(gt: Column, x_size: Value, y_size: Value, to: str = "degrees", y_resolution: Value | None = None) -> Column:
    """struct(west, north, east, south) of a north-up raster in Mercator metres, in degrees or metres. Pixels are square
    unless y_resolution is given."""
    west, north = gt[0], gt[3]
    east, south = west + col(x_size) * gt[1], north - col(y_size) * (gt[1] if y_resolution is None else col(y_resolution))
    if to == "meters":
        return F.struct(west.alias("west"), north.alias("north"), east.alias("east"), south.alias("south"))
    a, b = tm.meters_to_lat_lng(west, north), tm.meters_to_lat_lng(east, south)
    return F.struct(a["lng"].alias("west"), a["lat"].alias("north"), b["lng"].alias("east"), b["lat"].alias("south"))


def true_scale(west: Value, east: Value, x_size: Value, dpi: Value) -> Column:
    """Metres that a raster spans, over the metres it is wide when printed. West beyond east: it crosses the dateline."""
    half = 20037508.3428
    span = F.when(col(west) <= col(east), col(east) - col(west)).otherwise((half - F.abs(col(east))) + (half - F.abs(col(west))))
    return span / (col(x_size) / col(dpi) / 39.3701)


def bounds_to_ring(west: Value, north: Value, east: Value, south: Value) -> Column:
    """The closed ring north-west, north-east, south-east, south-west, north-west."""
    corner = lambda lat, lng: F.struct(col(lat).cast("double").alias("lat"), col(lng).cast("double").alias("lng"))
    return F.array(corner(north, west), corner(north, east), corner(south, east), corner(south, west), corner(north, west))


def bounds_to_cutline(west: Value, north: Value, east: Value, south: Value) -> Column:
    """That ring as an outline text."""
    from .text import format_outline

    return format_outline(bounds_to_ring(west, north, east, south))


def cutline_to_pixel_polygon(outline: Column, gt: Column) -> Column:
    """An outline text as a polygon text in pixels of a Mercator raster."""
    from .text import parse_outline

    def vertex(p: Column) -> Column:
        m = tm.lat_lng_to_meters(p["lat"], p["lng"])
        px = apply_geotransform(invert_geotransform(gt), m["x"], m["y"])
        return F.concat_ws(" ", px["x"].cast("long"), px["y"].cast("long"))

    return F.concat(F.lit("POLYGON (("), F.array_join(F.transform(parse_outline(outline), vertex), ","), F.lit("))"))


def ring_center(ring: Column) -> Column:
    """struct(lng, lat): the middle of the least and greatest of each; (0, 0) for an empty or missing ring."""

    def middle(name: str) -> Column:
        values = F.transform(ring, lambda p: p[name])
        return F.coalesce((F.array_min(values) + F.array_max(values)) / 2, F.lit(0.0))

    return F.struct(middle("lng").alias("lng"), middle("lat").alias("lat"))


def crosses_dateline(ring: Column) -> Column:
    """Has longitudes on both sides of 0: true across Greenwich too, so tile_cover does not use it."""
    lngs = F.transform(ring, lambda p: p["lng"])
    return F.coalesce((F.array_min(lngs) < 0) & (F.array_max(lngs) > 0), F.lit(False))


def tile_raster_window(z: Value, x: Value, y: Value, gt: Column, x_size: Value, y_size: Value) -> Column:
    """What a tile takes of a Mercator raster: struct(x0, y0, x1, y1, width, height, x_off, y_off, scaling_up), or null
    if they don't meet. (x0, y0) to (x1, y1) is the tile in raster pixels, width and height what is left of it inside the
    raster, the offsets where that begins in the tile, in raster pixels."""

    def corner(tx: Column, ty: Column) -> Column:
        at = let(tm.tile_to_pixel(tx, ty), lambda p: tm.pixel_to_lat_lng(p["x"], p["y"], z))
        return let(let(at, lambda q: tm.lat_lng_to_meters(q["lat"], q["lng"])), lambda m: map_to_pixel(gt, m["x"], m["y"]))

    corners = F.struct(corner(col(x), col(y)).alias("first"), corner(col(x) + 1, col(y) + 1).alias("last"))
    return let(corners, lambda c: _window(c["first"], c["last"], col(x_size).cast("long"), col(y_size).cast("long")))


def _window(first: Column, last: Column, x_size: Column, y_size: Column) -> Column:
    x0, y0, x1, y1 = first["x"], first["y"], last["x"], last["y"]
    left, top = F.greatest(x0, F.lit(0)), F.greatest(y0, F.lit(0))
    width, height = F.least(x1, x_size) - left, F.least(y1, y_size) - top
    window = F.struct(
        x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), width.alias("width"), height.alias("height"), (left - x0).alias("x_off"), (top - y0).alias("y_off"),
        ((x1 - x0 < tm.TILE) | (y1 - y0 < tm.TILE)).alias("scaling_up"),
    )
    return F.when((width > 0) & (height > 0), window)
