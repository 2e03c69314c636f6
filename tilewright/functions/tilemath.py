"""The web-map tile system as Column functions: latitude and longitude, pixels, tiles and Mercator metres.

All take and give Columns (numbers are taken as literals); null in gives null out. Pixel and tile (0, 0) is at the top
left. Tiles are 256 pixels wide, so a map of zoom z is 256 * 2^z pixels wide."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values of the tile system
TILE = 256
RADIUS = 6378137.0
MAX_LAT = 85.05112878
MAX_LNG = 180.0
MAX_ZOOM = 23
SHIFT = math.pi * RADIUS  # half the equator, in metres

Value = Column | float | int


def col(x: Value) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def clip(c: Value, low: Value, high: Value) -> Column:
    """c, but low at least and high at most."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, col(low)), col(high)))


def map_size(z: Value) -> Column:
    """Pixels across a map of zoom z, as a double."""
    return F.pow(F.lit(2.0), col(z)) * TILE


def map_size_tiles(z: Value) -> Column:
    return F.pow(F.lit(2.0), col(z)).cast("long")


def ground_resolution(lat: Value, z: Value) -> Column:
    """Metres a pixel at a latitude."""
    return F.cos(clip(lat, -MAX_LAT, MAX_LAT) * (math.pi / 180)) * (2 * math.pi * RADIUS) / map_size(z)


def map_scale(lat: Value, z: Value, dpi: Value) -> Column:
    return ground_resolution(lat, z) * col(dpi) / 0.0254


def _to_pixel(share: Column, z: Value) -> Column:
    size = map_size(z)
    return F.floor(clip(share * size + 0.5, F.lit(0.0), size - 1)).cast("long")


def lng_to_pixel_x(lng: Value, z: Value) -> Column:
    return _to_pixel((clip(lng, -MAX_LNG, MAX_LNG) + 180.0) / 360.0, z)


def lat_to_pixel_y(lat: Value, z: Value) -> Column:
    s = F.sin(clip(lat, -MAX_LAT, MAX_LAT) * (math.pi / 180))
    return _to_pixel(F.lit(0.5) - F.log((1.0 + s) / (1.0 - s)) / (4 * math.pi), z)


def lat_lng_to_pixel(lat: Value, lng: Value, z: Value) -> Column:
    """struct(x, y)"""
    return F.struct(lng_to_pixel_x(lng, z).alias("x"), lat_to_pixel_y(lat, z).alias("y"))


def pixel_to_tile(px: Value, py: Value) -> Column:
    """struct(x, y) of the tile in which a pixel lies."""
    return F.struct(F.floor(col(px) / TILE).cast("long").alias("x"), F.floor(col(py) / TILE).cast("long").alias("y"))


def tile_to_pixel(x: Value, y: Value) -> Column:
    """struct(x, y) of the tile's upper left pixel."""
    return F.struct((col(x).cast("long") * TILE).alias("x"), (col(y).cast("long") * TILE).alias("y"))


def lat_lng_to_tile(lat: Value, lng: Value, z: Value) -> Column:
    return pixel_to_tile(lng_to_pixel_x(lng, z), lat_to_pixel_y(lat, z))


def pixel_to_lat_lng(px: Value, py: Value, z: Value) -> Column:
    """struct(lat, lng)"""
    size = map_size(z)
    x = clip(px, F.lit(0.0), size - 1) / size - 0.5
    y = F.lit(0.5) - clip(py, F.lit(0.0), size - 1) / size
    return F.struct((F.lit(90.0) - F.atan(F.exp(y * (-2 * math.pi))) * 360.0 / math.pi).alias("lat"), (x * 360.0).alias("lng"))


def zoom_for_pixel_size(lat: Value, size: Value) -> Column:
    """The first zoom of 0 to 22 whose pixels are smaller than size metres; null if none."""
    zooms = F.sequence(F.lit(0), F.lit(MAX_ZOOM - 1))
    return F.get(F.filter(zooms, lambda z: col(size) > ground_resolution(lat, z)), 0)


def resolution(z: Value) -> Column:
    """Metres a pixel at the equator."""
    return F.lit(2 * math.pi * RADIUS) / map_size(z)


def pixels_to_meters(px: Value, py: Value, z: Value) -> Column:
    """struct(x, y) in metres; both axes run the same way as the pixels do."""
    return F.struct((col(px) * resolution(z) - SHIFT).alias("x"), (col(py) * resolution(z) - SHIFT).alias("y"))


def flip_pixel_y(py: Value, z: Value) -> Column:
    """Between pixel rows counted from the top and from the bottom; its own inverse."""
    return map_size_tiles(z) * TILE - col(py) - 1


def flip_tile_y(ty: Value, z: Value) -> Column:
    return map_size_tiles(z) - 1 - col(ty)


def meters_to_pixel(mx: Value, my: Value, z: Value) -> Column:
    """struct(x, y); truncated toward zero before y is flipped."""
    x, y = ((col(m) + SHIFT) / resolution(z) for m in (mx, my))
    return F.struct(x.cast("long").alias("x"), flip_pixel_y(y.cast("long"), z).alias("y"))


def meters_to_tile(mx: Value, my: Value, z: Value) -> Column:
    p = meters_to_pixel(mx, my, z)
    return pixel_to_tile(p["x"], p["y"])


def meters_to_lat_lng(mx: Value, my: Value) -> Column:
    """struct(lat, lng)"""
    y = col(my) / SHIFT * math.pi
    return F.struct(((F.atan(F.exp(y)) * 2 - math.pi / 2) * (180 / math.pi)).alias("lat"), (col(mx) / SHIFT * 180.0).alias("lng"))


def lat_lng_to_meters(lat: Value, lng: Value) -> Column:
    """struct(x, y) in spherical Mercator metres."""
    y = F.log(F.tan((clip(lat, -MAX_LAT, MAX_LAT) + 90.0) * (math.pi / 360))) * RADIUS
    return F.struct((col(lng) * (SHIFT / 180.0)).alias("x"), y.alias("y"))


def _bounds(west: Column, east: Column, y_top: Column, y_bottom: Column, across: Column) -> Column:
    wraps = west > east
    return F.struct(
        west.alias("x_min"), east.alias("x_max"), y_top.alias("y_min"), y_bottom.alias("y_max"),
        F.when(wraps, across - west + east + 1).otherwise(east - west + 1).alias("n_x"), (y_bottom - y_top + 1).alias("n_y"), wraps.alias("wraps"),
    )


def bounds_to_pixel_bounds(west: Value, north: Value, east: Value, south: Value, z: Value) -> Column:
    """struct(x_min, x_max, y_min, y_max, n_x, n_y, wraps). A box whose west lies east of its east crosses the dateline:
    wraps is true, and it has the pixels from x_min to the right edge and from the left edge to x_max."""
    return _bounds(lng_to_pixel_x(west, z), lng_to_pixel_x(east, z), lat_to_pixel_y(north, z), lat_to_pixel_y(south, z), map_size_tiles(z) * TILE)


def bounds_to_tile_bounds(west: Value, north: Value, east: Value, south: Value, z: Value) -> Column:
    """The same in tiles."""
    tile = lambda p: F.floor(p / TILE).cast("long")
    x1, x2, y1, y2 = lng_to_pixel_x(west, z), lng_to_pixel_x(east, z), lat_to_pixel_y(north, z), lat_to_pixel_y(south, z)
    return _bounds(tile(x1), tile(x2), tile(y1), tile(y2), map_size_tiles(z))


Z_ORDER_ZOOM = 30  # codes of this zoom fit into a long


def z_order(x: Column, y: Column) -> Column:
    """A tile's place on the Z curve of its zoom: its quadkey as a number, with a bit of y before each bit of x. Binary digits read
    to the base of four are spread bits."""
    spread = lambda v: F.conv(F.bin(v.cast("long")), 4, 10).cast("long")
    return spread(x) + 2 * spread(y)
