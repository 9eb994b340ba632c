"""Quality gates: one row a check, with what was measured. Unmeasured is a standing of its own, not a failure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gate(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, violations) of a table, in one pass: the number of rows that break each rule."""
    counts = df.agg(*(F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in checks.items()))
    return counts.select(F.inline(F.array(*(F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in checks))))


def standing(value: Column, low: float, high: float) -> Column:
    """``unmeasured`` for null, else ``pass`` or ``fail``."""
    return F.when(value.isNull(), "unmeasured").when(value.between(low, high), "pass").otherwise("fail")


def passed(standings: list[str], allow_unmeasured: bool = False) -> bool:
    """Whether a gate opens: nothing failed, and nothing unmeasured unless that is allowed."""
    return all(s == "pass" or allow_unmeasured and s == "unmeasured" for s in standings)


def agrees(stored: Column, computed: Column, share: float = 0.02, least: float = 1e-4) -> Column:
    """Whether a stored figure is the recomputed one, within a tolerance."""
    return F.abs(stored - computed) <= F.greatest(F.lit(least), F.abs(computed) * share)


def unsupported(declared: DataFrame, offered: DataFrame, key: str) -> DataFrame:
    """Declared claims that no candidate supports."""
    return declared.select(key).distinct().join(offered.select(key), key, "left_anti")


def polygon_problems(rows: DataFrame, roi: tuple[float, float, float, float], least_edge: float) -> DataFrame:
    """(zone_id, problems): everything that is wrong with a traced quadrilateral, at once. ``ring`` is array<struct<x, y>>."""
    from ..functions.geometry import shoelace, turn_signs

    x0, y0, x1, y1 = roi
    turns = turn_signs(F.col("ring"))
    bottom = F.hypot(F.col("ring")[3]["x"] - F.col("ring")[2]["x"], F.col("ring")[3]["y"] - F.col("ring")[2]["y"])
    found = {
        "flat": shoelace(F.col("ring")) < 1.0,
        "not convex": ~F.forall(turns, lambda t: (t == F.element_at(turns, 1)) & (t != 0)),
        "upside down": F.col("ring")[0]["y"] >= F.col("ring")[3]["y"],
        "short base": bottom < least_edge,
        "outside": F.exists("ring", lambda p: (p["x"] < x0) | (p["x"] > x1) | (p["y"] < y0) | (p["y"] > y1)),
    }
    return rows.select("zone_id", F.filter(F.array(*(F.when(c, n) for n, c in found.items())), lambda n: n.isNotNull()).alias("problems"))


def all_of(*rules: Column) -> Column:
    return reduce(lambda a, b: a & b, rules)


def drift(lines: DataFrame, computed: DataFrame, pattern: str) -> DataFrame:
    """Computed (zone_id, computed) rows beside the figures that a document's lines state, and whether they agree.

    ``pattern`` has a group for the zone and one for its whole number. A figure that is not stated does not agree.
    """
    parts = [F.regexp_extract("value", pattern, k) for k in (1, 2)]
    stated = lines.where(F.col("value").rlike(pattern)).select(parts[0].alias("zone_id"), parts[1].try_cast("long").alias("stated"))
    return computed.join(stated, "zone_id", "left").withColumn("agrees", F.coalesce(F.col("stated") == F.col("computed"), F.lit(False)))


def not_empty(df: DataFrame, what: str) -> DataFrame:
    """The same rows; an error if there are none."""
    if df.isEmpty():
        raise ValueError(f"no {what}")
    return df
