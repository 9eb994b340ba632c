"""Plane geometry on columns. All of it is built-in expressions, so that it stays in generated code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .angles import unit_x, unit_y

NOWHERE = 1e-12


def homography(matrix: Sequence[float], x: Column, y: Column) -> tuple[Column, Column]:
    """A point through a 3 x 3 plane homography, given row by row; null on the line that it sends to infinity."""
    a, b, c, d, e, f, g, h, i = (F.lit(float(m)) for m in matrix)
    w = x * g + y * h + i
    fine = F.abs(w) >= NOWHERE
    return F.when(fine, (x * a + y * b + c) / w), F.when(fine, (x * d + y * e + f) / w)


def point_in_polygon(x: Column, y: Column, ring: Sequence[tuple[Column | float, Column | float]]) -> Column:
    """Even-odd ray casting with half-open edges, unrolled over a polygon of few vertices."""
    if len(ring) < 3:
        raise ValueError("a polygon has three vertices or more")
    lit = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    crossings = []
    for k, (xi, yi) in enumerate(ring):
        xj, yj = ring[k - 1]
        xi, yi, xj, yj = lit(xi), lit(yi), lit(xj), lit(yj)
        rise = yj - yi
        cross = (xj - xi) * (y - yi) / F.when(rise != 0, rise) + xi
        crossings.append(F.coalesce(((yi > y) != (yj > y)) & (x < cross), F.lit(False)))
    return reduce(lambda a, b: a != b, crossings)


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """The same for a ring held as array<struct<x, y>>."""
    n = F.size(ring)

    def crosses(p: Column, k: Column) -> Column:
        q = F.element_at(ring, F.when(k == 0, n).otherwise(k))
        cross = (q["x"] - p["x"]) * (y - p["y"]) / F.when(q["y"] != p["y"], q["y"] - p["y"]) + p["x"]
        return F.coalesce(((p["y"] > y) != (q["y"] > y)) & (x < cross), F.lit(False))

    return F.aggregate(F.transform(ring, crosses), F.lit(False), lambda odd, c: odd != c)


def ray_segment(ox: Column, oy: Column, yaw: Column, ax: Column, ay: Column, bx: Column, by: Column, reach: float) -> Column:
    """Distance along a ray to a segment; null if it misses, is parallel, or the segment is beyond ``reach``."""
    return ray_distance(ox, oy, unit_x(yaw), unit_y(yaw), ax, ay, bx, by, reach)


def ray_distance(ox: Column, oy: Column, dx: Column, dy: Column, ax: Column, ay: Column, bx: Column, by: Column, reach: float) -> Column:
    """The same for a ray given by its direction."""
    ex, ey = bx - ax, by - ay
    det = dx * ey - dy * ex
    t = ((ax - ox) * ey - (ay - oy) * ex) / F.when(F.abs(det) >= NOWHERE, det)
    u = ((ax - ox) * dy - (ay - oy) * dx) / F.when(F.abs(det) >= NOWHERE, det)
    return F.when((t >= 0) & (t <= reach) & (u >= 0) & (u <= 1), t)


def ray_level(ox: Column, oy: Column, yaw: Column, ax: Column, bx: Column, level: Column, reach: float) -> Column:
    """Distance along a ray to a segment from ax to bx > ax at height ``level``; null as in ``ray_segment``.

    The place that is hit is compared with the ends as it stands, not as a share of the segment, so that a ray through an end is not lost to rounding.
    """
    dx, dy = unit_x(yaw), unit_y(yaw)
    slope = F.when(F.abs(dy) * (bx - ax) >= NOWHERE, dy)
    t = (level - oy) / slope
    return F.when(t.between(0, reach) & (ox + dx * (level - oy) / slope).between(ax, bx), t)


def end_distance(ox: Column, oy: Column, yaw: Column, half: float, px: Column, py: Column, reach: float) -> Column:
    """Distance to a segment's end; null if it is beyond ``reach`` or outside the sector."""
    d = F.hypot(px - ox, py - oy)
    turn = F.abs(F.pmod(F.degrees(F.atan2(py - oy, px - ox)) - yaw + 180.0, F.lit(360.0)) - 180.0)
    return F.when((d <= reach) & (d >= NOWHERE) & (turn <= half), d)


def sector_hit(ox: Column, oy: Column, yaw: Column, half: float, ax: Column, ay: Column, bx: Column, by: Column, reach: float) -> Column:
    """struct(dist, rank, hx, hy) of where a sector meets a segment; null if it does not.

    The left, middle and right ray are tried; the nearest hit counts, the earlier ray of equals. If all miss, the nearer of the
    segment's ends inside the sector counts.
    """

    def ray(rank: int, offset: float) -> Column:
        d = ray_segment(ox, oy, yaw + offset, ax, ay, bx, by, reach)
        hit = F.struct(F.round(d, 9).alias("dist"), F.lit(rank).alias("rank"), (ox + d * unit_x(yaw + offset)).alias("hx"), (oy + d * unit_y(yaw + offset)).alias("hy"))
        return F.when(d.isNotNull(), hit)

    def end(rank: int, px: Column, py: Column) -> Column:
        d = end_distance(ox, oy, yaw, half, px, py, reach)
        return F.when(d.isNotNull(), F.struct(F.round(d, 9).alias("dist"), F.lit(rank).alias("rank"), px.alias("hx"), py.alias("hy")))

    rays = F.array_min(F.filter(F.array(ray(0, -half), ray(1, 0.0), ray(2, half)), lambda h: h.isNotNull()))
    ends = F.array_min(F.filter(F.array(end(3, ax, ay), end(4, bx, by)), lambda h: h.isNotNull()))
    return F.coalesce(rays, ends)


def grazing_angle(hx: Column, hy: Column, ox: Column, oy: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Angle in [0, 90] between the line of sight to a hit and the segment's normal; 90 if either has no length."""
    sx, sy, vx, vy = bx - ax, by - ay, hx - ox, hy - oy
    size = F.hypot(sx, sy) * F.hypot(vx, vy)
    along = F.abs(vx * -sy + vy * sx) / F.when(size >= NOWHERE, size)
    return F.coalesce(F.degrees(F.acos(F.least(F.lit(1.0), along))), F.lit(90.0))


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of a point to a segment."""
    ex, ey = bx - ax, by - ay
    size = ex * ex + ey * ey
    t = F.when(size >= NOWHERE, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - ax) * ex + (py - ay) * ey) / size))).otherwise(F.lit(0.0))
    return F.hypot(px - (ax + t * ex), py - (ay + t * ey))


def line_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of a point to the line through two points; null if they coincide."""
    size = F.hypot(bx - ax, by - ay)
    return F.abs((bx - ax) * (ay - py) - (ax - px) * (by - ay)) / F.when(size >= NOWHERE, size)


def box_iou(ax1: Column, ay1: Column, ax2: Column, ay2: Column, bx1: Column, by1: Column, bx2: Column, by2: Column) -> Column:
    """Intersection over union of two boxes; 0 where the union is empty."""
    both = F.greatest(F.lit(0.0), F.least(ax2, bx2) - F.greatest(ax1, bx1)) * F.greatest(F.lit(0.0), F.least(ay2, by2) - F.greatest(ay1, by1))
    union = (ax2 - ax1) * (ay2 - ay1) + (bx2 - bx1) * (by2 - by1) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def pair_yaw(matrix: Sequence[float], lx: Column, ly: Column, rx: Column, ry: Column) -> Column:
    """Heading of a body from its left and right pixel: the ground direction from left to right, turned by a quarter.

    Null where the two lie on different sides of the horizon or coincide on the ground.
    """
    g, h, i = (float(m) for m in matrix[6:])
    wl, wr = lx * g + ly * h + i, rx * g + ry * h + i
    (lgx, lgy), (rgx, rgy) = homography(matrix, lx, ly), homography(matrix, rx, ry)
    dx, dy = rgx - lgx, rgy - lgy
    fine = (wl * wr > 0) & (F.hypot(dx, dy) >= 1e-9)
    return F.when(fine, F.pmod(F.degrees(F.atan2(dx, -dy)), F.lit(360.0)))


def shoelace(ring: Column) -> Column:
    """Area of a ring held as array<struct<x, y>>."""
    n = F.size(ring)
    terms = F.transform(ring, lambda p, k: p["x"] * F.element_at(ring, F.when(k + 1 == n, 1).otherwise(k + 2))["y"] - F.element_at(ring, F.when(k + 1 == n, 1).otherwise(k + 2))["x"] * p["y"])
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)) / 2.0


def turn_signs(ring: Column) -> Column:
    """Sign of the turn at each vertex of a ring; all equal and not 0 for a convex one."""
    n = F.size(ring)
    at = lambda k: F.element_at(ring, (k % n + 1).cast("int"))

    def turn(p: Column, k: Column) -> Column:
        q, r = at(k + 1), at(k + 2)
        return F.signum((q["x"] - p["x"]) * (r["y"] - q["y"]) - (q["y"] - p["y"]) * (r["x"] - q["x"]))

    return F.transform(ring, turn)
