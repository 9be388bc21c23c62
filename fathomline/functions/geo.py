"""Geometry on plain coordinates: projection, boxes, polygons, lengths."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lambert conformal conic with two standard parallels on GRS80 (EPSG:3034).
A, INVERSE_FLATTENING = 6378137.0, 298.257222101
LAT1, LAT2, LAT0, LON0 = 35.0, 65.0, 52.0, 10.0
FALSE_EAST, FALSE_NORTH = 4000000.0, 2800000.0

_E = math.sqrt(2 / INVERSE_FLATTENING - 1 / INVERSE_FLATTENING**2)


def _m(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - (_E * math.sin(lat)) ** 2)


def _t(lat: float) -> float:
    s = _E * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (_E / 2)


_LAT1, _LAT2, _LAT0 = map(math.radians, (LAT1, LAT2, LAT0))
N = (math.log(_m(_LAT1)) - math.log(_m(_LAT2))) / (math.log(_t(_LAT1)) - math.log(_t(_LAT2)))
AF = A * _m(_LAT1) / (N * _t(_LAT1) ** N)
RHO0 = AF * _t(_LAT0) ** N


def project(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Metres east and north."""
    phi = F.radians(lat)
    s = F.sin(phi) * _E
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(_E / 2))
    rho, theta = F.pow(t, F.lit(N)) * AF, F.radians(lon - LON0) * N
    return rho * F.sin(theta) + FALSE_EAST, F.lit(FALSE_NORTH + RHO0) - rho * F.cos(theta)


def unproject(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude; five fixed-point steps, below a nanodegree in the domain."""
    dx, dy = x - FALSE_EAST, F.lit(RHO0 + FALSE_NORTH) - y
    t = F.pow(F.hypot(dx, dy) / AF, F.lit(1 / N))
    phi = F.lit(math.pi / 2) - F.atan(t) * 2
    for _ in range(5):
        s = F.sin(phi) * _E
        phi = F.lit(math.pi / 2) - F.atan(t * F.pow((1 - s) / (1 + s), F.lit(_E / 2))) * 2
    return F.degrees(F.atan2(dx, dy) / N) + LON0, F.degrees(phi)


def inside_polygon(x: Column, y: Column, ring: list[tuple[float, float]]) -> Column:
    """Strictly inside a simple ring: box first, then crossings of a ray, then not on the boundary."""
    if ring[0] != ring[-1]:
        ring = [*ring, ring[0]]
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    inside, edge = F.lit(False), F.lit(False)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        side = (x - x1) * (y2 - y1) - (y - y1) * (x2 - x1)
        edge = edge | ((side == 0) & x.between(min(x1, x2), max(x1, x2)) & y.between(min(y1, y2), max(y1, y2)))
        if y1 != y2:
            crosses = ((y < y1) != (y < y2)) & ((side < 0) if y2 > y1 else (side > 0))
            inside = inside != crosses
    box = (x > min(xs)) & (x < max(xs)) & (y > min(ys)) & (y < max(ys))
    return box & inside & ~edge


def box_polygon(xmin: float, ymin: float, xmax: float, ymax: float) -> list[tuple[float, float]]:
    return [(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)]


def boxes_meet(xmin: float, ymin: float, xmax: float, ymax: float, names=("xmin", "ymin", "xmax", "ymax")) -> Column:
    """Closed overlap with the box columns of a row, as plain comparisons that reach the scan."""
    a, b, c, d = map(F.col, names)
    return (c >= xmin) & (a <= xmax) & (d >= ymin) & (b <= ymax)


def times_meet(start, end, upper_inclusive: bool, names=("tmin", "tmax")) -> Column:
    """Overlap of [tmin, tmax] with [start, end] or [start, end)."""
    lo, hi = map(F.col, names)
    return (hi >= F.lit(start)) & ((lo <= F.lit(end)) if upper_inclusive else (lo < F.lit(end)))


def path_length(points: Column) -> Column:
    """Of an array of points with x and y; fewer than two give 0."""
    first, rest = F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0)))
    steps = F.zip_with(first, rest, lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"]))
    return F.aggregate(steps, F.lit(0.0), lambda s, v: s + v)


def azimuth(dx: Column, dy: Column) -> Column:
    """Degrees clockwise from north, 0 to 360; null without movement."""
    turn = F.degrees(F.atan2(dx, dy))
    return F.when((dx == 0) & (dy == 0), F.lit(None)).when(turn < 0, turn + 360).otherwise(turn)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.hypot(x2 - x1, y2 - y1)
