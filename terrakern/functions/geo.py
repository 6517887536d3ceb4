"""Boxes, grids, zones and latitude weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TILE, PIXEL = 2048, 10
#: Tokens of a pixel-year by a band's lower latitude (step table).
LATITUDE_STEPS = ((60.0, 208.0), (40.0, 176.0), (20.0, 168.0), (0.0, 120.0), (-20.0, 104.0), (-40.0, 128.0), (-80.0, 104.0))


def split_box(west: Column, east: Column) -> Column:
    """Array of (west, east): two boxes where west > east, else one."""
    pair = lambda a, b: F.struct(a.cast("double").alias("west"), b.cast("double").alias("east"))
    return F.when(west > east, F.array(pair(west, F.lit(180.0)), pair(F.lit(-180.0), east))).otherwise(F.array(pair(west, east)))


def overlaps(west: Column, south: Column, east: Column, north: Column, box: tuple[float, float, float, float]) -> Column:
    """Plain overlap of a tile's box with (west, south, east, north)."""
    w, s, e, n = box
    return (west <= e) & (east >= w) & (south <= n) & (north >= s)


def overlaps_wrapped(west: Column, south: Column, east: Column, north: Column, box: tuple[float, float, float, float]) -> Column:
    """As :func:`overlaps`, for tiles that may cross the antimeridian."""
    w, s, e, n = box
    end = F.when(east < west, east + 360).otherwise(east)
    return (((west <= e) & (end >= w)) | ((west - 360 <= e) & (end - 360 >= w))) & (south <= n) & (north >= s)


def inside_wrapped(lon: Column, west: Column, east: Column) -> Column:
    return F.when(west <= east, lon.between(west, east)).otherwise((lon >= west) | (lon <= east))


def zone_number(lon: Column, lat: Column) -> Column:
    """6-degree zone with the Norwegian and Svalbard exceptions."""
    plain = F.least(F.lit(60), F.floor((lon + 180) / 6) + 1)
    svalbard = F.when(lon < 9, 31).when(lon < 21, 33).when(lon < 33, 35).otherwise(37)
    return F.when((lat >= 56) & (lat < 64) & (lon >= 3) & (lon < 12), 32).when((lat >= 72) & (lat <= 84) & (lon >= 0) & (lon < 42), svalbard).otherwise(plain).cast("int")


def latitude_weight(lat: Column) -> Column:
    """Step (as-of) lookup: the band that starts at or below the latitude; null below all."""
    found = F.lit(None).cast("double")
    for lower, weight in reversed(LATITUDE_STEPS):
        found = F.when(lat >= lower, F.lit(weight)).otherwise(found)
    return found


def pixel_centre(origin: Column, index: Column, size: float = PIXEL) -> Column:
    return origin + (index + 0.5) * size


def tiles_across(pixels: Column, tile: int = TILE) -> Column:
    return F.ceil(pixels / tile).cast("int")
