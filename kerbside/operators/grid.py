"""A grid index of many zones: points meet zones through the cell they share, and only cells on an edge test the polygon.

Zones are rows (zone_id, ring), rings arrays of (x, y) corners in order, convex or not. A cell is inside a zone, on an edge, or outside; only
the first two are kept, so the index grows with the zones' area in cells. The joins are equal ones and sorted merges: Spark's guess of an
index is that of the zones it comes from, without their cells, and would have the driver gather and send out a large one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sides(ring: Column) -> Column:
    """A ring's sides as (ax, ay, bx, by)."""
    n = F.size(ring)

    def side(p: Column, k: Column) -> Column:
        q = F.element_at(ring, (k + 1) % n + 1)
        return F.struct(p["x"].alias("ax"), p["y"].alias("ay"), q["x"].alias("bx"), q["y"].alias("by"))

    return F.transform(ring, side)


def in_ring(x: Column, y: Column, sides: Column) -> Column:
    """Whether a point lies in a ring, by the parity of the sides above or below it; half open, as for single zones."""

    def crosses(s: Column) -> Column:
        at = (s["bx"] - s["ax"]) * (y - s["ay"]) / (s["by"] - s["ay"]) + s["ax"]
        return F.when((s["ay"] > y) != (s["by"] > y), x < at).otherwise(F.lit(False))

    return F.size(F.filter(sides, crosses)) % 2 == 1


def _touches(s: Column, x0: Column, y0: Column, cell: float) -> Column:
    """Whether a side meets a cell, its border included: their extents overlap, and its line does not leave all corners on one side."""
    x1, y1 = x0 + cell, y0 + cell
    near = (F.greatest(s["ax"], s["bx"]) >= x0) & (F.least(s["ax"], s["bx"]) <= x1) & (F.greatest(s["ay"], s["by"]) >= y0) & (F.least(s["ay"], s["by"]) <= y1)
    turns = [(s["bx"] - s["ax"]) * (v - s["ay"]) - (s["by"] - s["ay"]) * (u - s["ax"]) for u, v in ((x0, y0), (x1, y0), (x0, y1), (x1, y1))]
    return near & (F.least(*turns) <= 0) & (F.greatest(*turns) >= 0)


def zone_cells(zones: DataFrame, cell: float) -> DataFrame:
    """(zone_id, cx, cy, sides): the cells that a zone reaches; ``sides`` is null where the whole cell lies inside."""
    sides = zones.select("zone_id", _sides(F.col("ring")).alias("all_sides"))
    low = lambda c: F.floor(F.array_min(F.transform("all_sides", lambda s: s[c])) / cell)
    high = lambda c: F.floor(F.array_max(F.transform("all_sides", lambda s: s[c])) / cell)
    columns = sides.select("*", F.explode(F.sequence(low("ax"), high("ax"))).alias("cx"), low("ay").alias("y0"), high("ay").alias("y1"))
    cells = columns.select("zone_id", "all_sides", "cx", F.explode(F.sequence("y0", "y1")).alias("cy"))
    left, bottom = F.col("cx") * cell, F.col("cy") * cell
    edge = F.exists("all_sides", lambda s: _touches(s, left, bottom, cell))
    kept = cells.withColumn("edge", edge).where(F.col("edge") | in_ring(left + cell / 2, bottom + cell / 2, F.col("all_sides")))
    return kept.select("zone_id", "cx", "cy", F.when(F.col("edge"), F.col("all_sides")).alias("sides"))


def points_in_zones(points: DataFrame, zones: DataFrame, cell: float, x: str = "x", y: str = "y") -> DataFrame:
    """Every point with every zone that holds it. Points without a position are in none, and zones that overlap all count.

    Points of one position are tested once, and then meet its zones; rows are as many as there are such pairs.
    """
    placed = points.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    spots = placed.select(F.col(x).alias("spot_x"), F.col(y).alias("spot_y")).distinct()
    celled = spots.withColumns({"cx": F.floor(F.col("spot_x") / cell), "cy": F.floor(F.col("spot_y") / cell)})
    met = celled.join(zone_cells(zones, cell).hint("merge"), ["cx", "cy"])
    held = met.where(F.col("sides").isNull() | in_ring(F.col("spot_x"), F.col("spot_y"), F.col("sides"))).select("spot_x", "spot_y", "zone_id")
    return placed.join(held.hint("merge"), (placed[x] == held["spot_x"]) & (placed[y] == held["spot_y"])).drop("spot_x", "spot_y")
