"""Polygons of a few vertices on the driver: zones are traced by hand."""

from __future__ import annotations

Point = tuple[float, float]


def area(ring: list[Point]) -> float:
    return abs(sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True))) / 2


def _side(p: Point, a: Point, b: Point) -> float:
    return (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])


def clip(subject: list[Point], window: list[Point]) -> list[Point]:
    """The part of a polygon inside a convex one, cut by one edge after another."""
    turn = 1.0 if sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(window, window[1:] + window[:1], strict=True)) > 0 else -1.0
    out = subject
    for a, b in zip(window, window[1:] + window[:1], strict=True):
        points, out = out, []
        for p, q in zip(points, points[1:] + points[:1], strict=True):
            sp, sq = turn * _side(p, a, b), turn * _side(q, a, b)
            if sp >= 0:
                out.append(p)
            if sp * sq < 0:
                t = sp / (sp - sq)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
    return out


def overlap_share(a: list[Point], b: list[Point]) -> float:
    """Common area over the smaller polygon's."""
    common = clip(a, b)
    least = min(area(a), area(b))
    return area(common) / least if len(common) >= 3 and least > 0 else 0.0


def hull(points: list[Point]) -> list[Point]:
    """Convex hull, counter-clockwise from the leftmost point."""
    ordered = sorted(set(points))
    if len(ordered) < 3:
        return ordered

    def half(run: list[Point]) -> list[Point]:
        out: list[Point] = []
        for p in run:
            while len(out) > 1 and _side(p, out[-2], out[-1]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return half(ordered) + half(ordered[::-1])
