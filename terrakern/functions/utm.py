"""UTM projection by the Krueger series, as plain numpy and as an Arrow-batched UDF."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: WGS 84 ellipsoid, UTM scale and false origins.
RADIUS, FLATTENING, SCALE, EAST, SOUTH = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0
_N = FLATTENING / (2 - FLATTENING)
_A = RADIUS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def forward(lon, lat, zone):
    """Easting and northing (10,000 km added south of the equator)."""
    lam, phi = np.radians(np.asarray(lon, float) - (6.0 * np.asarray(zone, float) - 183.0)), np.radians(np.asarray(lat, float))
    c = 2 * np.sqrt(_N) / (1 + _N)
    t = np.sinh(np.arctanh(np.sin(phi)) - c * np.arctanh(c * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
    x = eta + sum(a * np.cos(2 * k * xi) * np.sinh(2 * k * eta) for k, a in enumerate(_ALPHA, 1))
    y = xi + sum(a * np.sin(2 * k * xi) * np.cosh(2 * k * eta) for k, a in enumerate(_ALPHA, 1))
    return EAST + SCALE * _A * x, SCALE * _A * y + np.where(phi < 0, SOUTH, 0.0)


def inverse(east, north, zone, southern=False):
    """Longitude and latitude of UTM coordinates."""
    xi = (np.asarray(north, float) - np.where(southern, SOUTH, 0.0)) / (SCALE * _A)
    eta = (np.asarray(east, float) - EAST) / (SCALE * _A)
    x = xi - sum(b * np.sin(2 * k * xi) * np.cosh(2 * k * eta) for k, b in enumerate(_BETA, 1))
    e = eta - sum(b * np.cos(2 * k * xi) * np.sinh(2 * k * eta) for k, b in enumerate(_BETA, 1))
    chi = np.arcsin(np.sin(x) / np.cosh(e))
    phi = chi + sum(d * np.sin(2 * k * chi) for k, d in enumerate(_DELTA, 1))
    return 6.0 * np.asarray(zone, float) - 183.0 + np.degrees(np.arctan2(np.sinh(e), np.cos(x))), np.degrees(phi)


def tile_box(zone: int, west: float, south: float, size: float, southern: bool = False, steps: int = 16) -> tuple[float, float, float, float]:
    """WGS 84 box of a square tile from its densified rim; west > east if it crosses the antimeridian."""
    edge = np.linspace(0, size, steps + 1)
    x = np.concatenate((west + edge, np.full_like(edge, west + size), west + edge, np.full_like(edge, west)))
    y = np.concatenate((np.full_like(edge, south), south + edge, np.full_like(edge, south + size), south + edge))
    lon, lat = inverse(x, y, zone, southern)
    wrap = lambda v: (v + 180) % 360 - 180
    return float(wrap(lon.min())), float(lat.min()), float(wrap(lon.max())), float(lat.max())


def projected(lon: Column, lat: Column, zone: Column) -> Column:
    """struct(easting, northing) of points."""

    @F.pandas_udf("easting double, northing double")
    def run(lon: pd.Series, lat: pd.Series, zone: pd.Series) -> pd.DataFrame:
        east, north = forward(lon, lat, zone)
        return pd.DataFrame({"easting": east, "northing": north})

    return run(lon.cast("double"), lat.cast("double"), zone.cast("double"))


def row_latitude(northing: Column, southern: Column) -> Column:
    """Latitude of a northing on the zone's central meridian."""
    xi = (northing - F.when(southern, SOUTH).otherwise(0.0)) / (SCALE * _A)
    chi = xi - sum((b * F.sin(2 * k * xi) for k, b in enumerate(_BETA, 1)), F.lit(0.0))
    return F.degrees(chi + sum((d * F.sin(2 * k * chi) for k, d in enumerate(_DELTA, 1)), F.lit(0.0)))


#: The same as SQL, with {n} for the northing less its false origin.
ROW_LATITUDE_SQL = "(SELECT degrees(chi" + "".join(f" + {d!r} * sin({2 * k} * chi)" for k, d in enumerate(_DELTA, 1)) + ") FROM (SELECT xi" + "".join(f" - {b!r} * sin({2 * k} * xi)" for k, b in enumerate(_BETA, 1)) + f" AS chi FROM (SELECT ({{n}}) / {SCALE * _A!r} AS xi)))"
