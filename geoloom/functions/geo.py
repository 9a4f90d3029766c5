"""Planar and spherical geometry on columns. A line is an array of structs (x, y). Functions on numbers stay in generated code;
those that walk a line's legs use higher-order functions, which Spark interprets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_METRES = 6_371_000
DEGREE_METRES = 111_320


def point_segment(px: Column, py: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Distance of a point to a segment."""
    dx, dy = x1 - x0, y1 - y0
    square = dx * dx + dy * dy
    t = F.when(square > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x0) * dx + (py - y0) * dy) / square))).otherwise(0.0)
    ex, ey = px - (x0 + t * dx), py - (y0 + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def point_line(px: Column, py: Column, line: Column) -> Column:
    """Distance of a point to a line of at least two vertices."""
    legs = F.zip_with(F.slice(line, 1, F.size(line) - 1), F.slice(line, 2, F.size(line) - 1), lambda a, b: point_segment(px, py, a["x"], a["y"], b["x"], b["y"]))
    return F.array_min(legs)


def _side(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def segment_segment(a: list[Column], b: list[Column]) -> Column:
    """Distance of two segments given as [x0, y0, x1, y1]; 0 where they cross."""
    s1, s2 = _side(*a, b[0], b[1]), _side(*a, b[2], b[3])
    s3, s4 = _side(*b, a[0], a[1]), _side(*b, a[2], a[3])
    near = F.least(point_segment(a[0], a[1], *b), point_segment(a[2], a[3], *b), point_segment(b[0], b[1], *a), point_segment(b[2], b[3], *a))
    return F.when((s1 * s2 < 0) & (s3 * s4 < 0), 0.0).otherwise(near)


def line_line(a: Column, b: Column) -> Column:
    """Distance of two lines: the least over all pairs of legs."""

    def legs(line: Column) -> Column:
        return F.zip_with(F.slice(line, 1, F.size(line) - 1), F.slice(line, 2, F.size(line) - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))

    def flat(s: Column) -> list[Column]:
        return [s["p"]["x"], s["p"]["y"], s["q"]["x"], s["q"]["y"]]

    return F.array_min(F.transform(legs(a), lambda s: F.array_min(F.transform(legs(b), lambda t: segment_segment(flat(s), flat(t))))))


def azimuth(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Degrees clockwise from north, 0 to 360."""
    return F.pmod(F.degrees(F.atan2(x1 - x0, y1 - y0)), F.lit(360.0))


def haversine(lat0: Column, lon0: Column, lat1: Column, lon1: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat1 - lat0) / 2), 2) + F.cos(F.radians(lat0)) * F.cos(F.radians(lat1)) * F.pow(F.sin(F.radians(lon1 - lon0) / 2), 2)
    return F.lit(2.0 * EARTH_METRES) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def local_metres(x: Column, y: Column, mean_latitude: Column) -> tuple[Column, Column]:
    """Equirectangular metres around a mean latitude."""
    return x * DEGREE_METRES * F.cos(F.radians(mean_latitude)), y * DEGREE_METRES


def snap(value: Column, cell: float) -> Column:
    return F.round(value / cell) * cell


def cell_of(value: Column, cell: float) -> Column:
    return F.floor(value / cell).cast("long")


def turn(bearing_in: Column, bearing_out: Column) -> tuple[Column, Column]:
    """(unsigned angle in degrees, cross product: negative to the right, positive to the left)."""
    wide = F.pmod(F.abs(F.degrees(bearing_out - bearing_in)), F.lit(360.0))
    cross = F.sin(bearing_in) * F.cos(bearing_out) - F.cos(bearing_in) * F.sin(bearing_out)
    return F.when(wide <= 180, wide).otherwise(360 - wide), cross


def oriented_line(legs: Column) -> Column:
    """One line of an ordered array of lines: a leg whose far end is nearer to where the line stands is flipped, and a
    repeated joint is dropped."""

    def step(line: Column, leg: Column) -> Column:
        end, first, last = F.element_at(line, -1), F.element_at(leg, 1), F.element_at(leg, -1)
        far = lambda p: (p["x"] - end["x"]) * (p["x"] - end["x"]) + (p["y"] - end["y"]) * (p["y"] - end["y"])
        way = F.when(far(last) < far(first), F.reverse(leg)).otherwise(leg)
        same = (F.element_at(way, 1)["x"] == end["x"]) & (F.element_at(way, 1)["y"] == end["y"])
        return F.concat(line, F.when(same, F.slice(way, 2, F.size(way))).otherwise(way))

    return F.aggregate(F.slice(legs, 2, F.size(legs)), F.element_at(legs, 1), step)
