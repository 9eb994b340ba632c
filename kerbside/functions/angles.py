"""Angles in degrees, counter-clockwise from +x, and hues on OpenCV's half circle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_yaw(yaw: Column) -> Column:
    """The angle in [0, 360)."""
    return F.pmod(yaw, F.lit(360.0))


def yaw_difference(a: Column, b: Column) -> Column:
    """Signed shortest turn from b to a, in (-180, 180]."""
    turn = F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0
    return F.when(turn == -180.0, F.lit(180.0)).otherwise(turn)


def hue_distance(a: Column, b: Column) -> Column:
    """Distance of two hues on the circle [0, 180)."""
    gap = F.pmod(F.abs(a - b), F.lit(180.0))
    return F.least(gap, 180.0 - gap)


def unit_x(yaw: Column) -> Column:
    return F.cos(F.radians(yaw))


def unit_y(yaw: Column) -> Column:
    return F.sin(F.radians(yaw))


def circular_median(values: Column) -> Column:
    """The element with the least sum of angular distances to all; the first of equals; null of an empty array."""

    def cost(v: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, o: acc + F.abs(yaw_difference(o, v)))

    ranked = F.transform(values, lambda v, i: F.struct(F.round(cost(v), 9).alias("cost"), i.alias("place"), v.alias("value")))
    return F.array_min(ranked)["value"]
