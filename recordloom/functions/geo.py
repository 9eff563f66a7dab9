"""Distances and grid cells on the sphere."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_column

# Mean Earth radius and the international mile, in metres.
EARTH_RADIUS_M = 6_371_008.8
METRES_PER_MILE = 1_609.344

_METRES_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180


def haversine_m(
    lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str
) -> Column:
    """Great-circle distance in metres; NULL if any coordinate is NULL."""
    a, b, c, d = (as_column(x).cast("double") for x in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(c - a) / 2)
    half_lon = F.sin(F.radians(d - b) / 2)
    h = half_lat * half_lat + F.cos(F.radians(a)) * F.cos(F.radians(c)) * half_lon * half_lon
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def bounding_box(
    lat: Column | str, lon: Column | str, centre: tuple[float, float], metres: float
) -> Column:
    """Plain comparisons that hold for every point within ``metres``; they reach the scan."""
    y, x = as_column(lat), as_column(lon)
    lat0, lon0 = centre
    reach = metres / _METRES_PER_DEGREE * (1 + 1e-9) + 1e-9
    condition = y.between(lat0 - reach, lat0 + reach)
    if abs(lat0) + reach >= 90:
        return condition
    ratio = math.sin(math.radians(min(reach, 90))) / math.cos(math.radians(lat0))
    if ratio >= 1:
        return condition
    width = math.degrees(math.asin(ratio)) + 1e-9
    west, east = lon0 - width, lon0 + width
    if west < -180:
        return condition & ((x >= west + 360) | (x <= east))
    if east > 180:
        return condition & ((x >= west) | (x <= east - 360))
    return condition & x.between(west, east)


class Grid:
    """Cells no wider and no higher than ``side`` metres, as (row, column) numbers.

    The column count of a row shrinks toward the poles and the columns of a row
    divide the circle evenly, so the wrap at 180 degrees is a plain modulo.
    """

    def __init__(self, side: float):
        self.side = side
        self.step = side / _METRES_PER_DEGREE

    def row(self, lat: Column | str) -> Column:
        return F.floor((as_column(lat).cast("double") + 90) / self.step)

    def columns_in(self, row: Column) -> Column:
        low = row * self.step - 90
        high = low + self.step
        nearest = F.when((low <= 0) & (high >= 0), F.lit(0.0)).otherwise(
            F.least(F.abs(low), F.abs(high))
        )
        widest = F.greatest(F.cos(F.radians(F.least(nearest, F.lit(90.0)))), F.lit(0.0))
        return F.greatest(F.ceil(F.lit(360 * _METRES_PER_DEGREE / self.side) * widest), F.lit(1))

    def column(self, lon: Column | str, row: Column) -> Column:
        count = self.columns_in(row)
        turned = F.pmod(as_column(lon).cast("double") + 180, F.lit(360.0))
        return F.least(F.floor(turned / 360 * count), count - 1)

    def cell(self, lat: Column | str, lon: Column | str) -> Column:
        row = self.row(lat)
        return F.struct(row.alias("row"), self.column(lon, row).alias("column"))

    def cells_within(self, lat: Column | str, lon: Column | str, metres: float) -> Column:
        """Array of every cell that can hold a point within ``metres``, each once."""
        y, x = as_column(lat).cast("double"), as_column(lon).cast("double")
        reach = metres / _METRES_PER_DEGREE * (1 + 1e-9) + 1e-9
        edge = F.least(F.abs(y) + reach, F.lit(90.0))
        ratio = F.lit(math.sin(math.radians(min(reach, 90)))) / F.greatest(
            F.cos(F.radians(edge)), F.lit(1e-12)
        )
        width = F.when(ratio >= 1, F.lit(180.0)).otherwise(
            F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) + 1e-9
        )
        first = F.floor((F.greatest(y - reach, F.lit(-90.0)) + 90) / self.step)
        last = F.floor((F.least(y + reach, F.lit(90.0)) + 90) / self.step)

        def in_row(row: Column) -> Column:
            count = self.columns_in(row)
            start = F.floor((x + 180 - width) / 360 * count)
            stop = F.floor((x + 180 + width) / 360 * count)
            stop = F.least(stop, start + count - 1)
            return F.transform(
                F.sequence(start, stop),
                lambda k: F.struct(row.alias("row"), F.pmod(k, count).alias("column")),
            )

        return F.flatten(F.transform(F.sequence(first, last), in_row))
