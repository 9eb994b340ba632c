"""Window operators over tracks: speed, smoothing, sessions, picks and strata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.angles import circular_median


def sliding_speed(obs: DataFrame, half: int = 4) -> DataFrame:
    """Speed by ordinary least squares of x and y on time over 2*half+1 rows; null at the ends and where any is missing."""
    w = Window.partitionBy("track_id").orderBy("frame_idx").rowsBetween(-half, half)
    full = (F.count(F.lit(1)).over(w) == 2 * half + 1) & (F.count("x").over(w) == 2 * half + 1)
    still = F.regr_sxx("x", "ts").over(w) < 1e-12
    speed = F.hypot(F.regr_slope("x", "ts").over(w), F.regr_slope("y", "ts").over(w))
    return obs.select("track_id", "frame_idx", F.when(full & ~still, speed).alias("speed_mps"))


def smoothed_yaw(obs: DataFrame, half: int = 2, least: int = 3) -> DataFrame:
    """Sliding circular median over a track's measured angles; nulls keep their places, tracks of fewer measurements stay."""
    order = Window.partitionBy("track_id").orderBy("frame_idx")
    near = F.collect_list("body_yaw").over(order.rowsBetween(-half, half))
    many = F.count("body_yaw").over(Window.partitionBy("track_id")) >= least
    measured = obs.where("body_yaw IS NOT NULL").select("track_id", "frame_idx", F.when(many, circular_median(near)).otherwise(F.col("body_yaw")).alias("smooth"))
    return obs.select("track_id", "frame_idx").join(measured, ["track_id", "frame_idx"], "left")


def gap_sessions(rows: DataFrame, gap: float, by: str = "track_id") -> DataFrame:
    """(key, session, t0, t1, n): rows of a key split where the step to the next exceeds ``gap``."""
    order = Window.partitionBy(by).orderBy("ts", "frame_idx")
    new = F.when(F.col("ts") - F.lag("ts").over(order) > gap, 1).otherwise(0)
    marked = rows.withColumn("new", new).withColumn("session", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return marked.groupBy(by, "session").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.count("*").alias("n"))


def even_picks(rows: DataFrame, k: int, by: str = "track_id", order: str = "frame_idx") -> DataFrame:
    """At most ``k`` rows of each key, evenly spaced from first to last, half-even rounding of places."""
    w = Window.partitionBy(by)
    placed = rows.withColumn("place", F.row_number().over(w.orderBy(order)) - 1).withColumn("n", F.count("*").over(w))
    steps = F.least(F.lit(k), F.col("n"))
    wanted = F.transform(F.sequence(F.lit(0), (steps - 1).cast("int")), lambda i: F.bround(i * (F.col("n") - 1) / F.greatest(steps - 1, F.lit(1)), 0).cast("long"))
    return placed.where(F.array_contains(wanted, F.col("place").cast("long"))).drop("place", "n")


def rank_strata(rows: DataFrame, strata: int, by: list[str], order: list[str], spans: float = 10_000.0) -> DataFrame:
    """Number of each row's rank stratum, bounds at round(i*m/strata), half even.

    The first of ``order`` is a number, cut into spans of 1/``spans``.
    """
    ranked = numbered(rows, F.floor(F.col(order[0]) * spans), order, by)
    stratum = sum((F.col("place") >= F.bround(F.lit(i) * F.col("m") / F.lit(strata), 0)).cast("int") for i in range(1, strata))
    return ranked.withColumn("stratum", stratum).drop("place", "m")


def _offsets(cut: DataFrame, by: list[str], weight: str | None = None) -> tuple[DataFrame, Column]:
    """One row a group and span: rows before it, in it and in all (before, inside, m); and the condition that joins it.

    With ``weight``, a row counts as often as that column says.
    """
    sizes = cut.groupBy(*by, "span").agg((F.sum(weight) if weight else F.count("*")).alias("inside"))
    group = Window.partitionBy(*by)
    before = F.coalesce(F.sum("inside").over(group.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    keys = [*by, "span"]
    named = sizes.select(*(F.col(c).alias(f"own_{c}") for c in keys), "inside", before.alias("before"), F.sum("inside").over(group).alias("m"))
    return named, reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"own_{c}")) for c in keys))


def numbered(rows: DataFrame, span: Column, order: list[Column | str], by: list[str] | None = None, first: int | None = None) -> DataFrame:
    """Rows with their ``place`` from 0 in their group's order, and the group's size ``m``.

    ``span`` must not fall along the order. Rows are sorted within a span only, once counts by span have told how many come
    before, so no task sorts a group; what meets in a task is a row a span. With ``first``, only spans that hold some of the
    first so many rows of a group are sorted and kept.
    """
    by = by or []
    cut = rows.withColumn("span", span)
    offsets, same = _offsets(cut, by)
    if first is not None:
        offsets = offsets.where(F.col("before") < first)
    own = Window.partitionBy(*by, "span").orderBy(*order)
    placed = cut.join(offsets, same).withColumn("place", F.col("before") + F.row_number().over(own) - 1)
    return placed.drop("span", "inside", "before", *(f"own_{c}" for c in [*by, "span"]))


def exact_quantiles(rows: DataFrame, value: str, step: float, at: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact quantiles of each group, one column for each of ``at``, between the two values next to the place; nulls do not count.

    Equal values are counted first, so that a value which half of all rows have is one row from there on. Distinct values are counted by
    spans of ``step``; only those in the spans that hold a wanted place are sorted. Without groups, no values give one row of nulls.
    """
    by = by or []
    valued = rows.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("value"))
    cut = valued.groupBy(*by, "value").agg(F.count("*").alias("n")).withColumn("span", F.floor(F.col("value") / step))
    offsets, same = _offsets(cut, by, "n")
    places = {name: F.lit(float(q)) * (F.col("m") - 1) for name, q in at.items()}
    held = lambda k: (F.col("before") <= k) & (k < F.col("before") + F.col("inside"))
    wanted = offsets.where(reduce(lambda a, b: a | b, (held(f(p)) for p in places.values() for f in (F.floor, F.ceil))))
    order = Window.partitionBy(*by, "span").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = cut.join(wanted, same).withColumn("start", F.col("before") + F.coalesce(F.sum("n").over(order), F.lit(0)))
    here = lambda k: F.max(F.when((F.col("start") <= k) & (k < F.col("start") + F.col("n")), F.col("value")))

    def between(place: Column) -> Column:
        low, high = here(F.floor(place)), here(F.ceil(place))
        share = F.max(place - F.floor(place))
        return F.when(low == high, low).otherwise((1 - share) * low + share * high)

    return ranked.groupBy(*by).agg(*(between(p).alias(name) for name, p in places.items()))


def exact_median(rows: DataFrame, value: str, step: float, by: list[str] | None = None, name: str = "median") -> DataFrame:
    """The exact median of each group, between the two middle values; nulls do not count."""
    return exact_quantiles(rows, value, step, {name: 0.5}, by)


def running(rows: DataFrame, span: Column, order: str, columns: list[str]) -> DataFrame:
    """Rows with ``columns`` summed up to each row in order; sums by span come first, so each span is a window of its own."""
    cut = rows.withColumn("span", span)
    earlier = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy("span").agg(*(F.sum(c).alias(c) for c in columns))
    before = sums.select(F.col("span").alias("own_span"), *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in columns))
    inside = Window.partitionBy("span").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = cut.join(before, F.col("span") == F.col("own_span"))
    return joined.select(*(c for c in rows.columns if c not in columns), *((F.col(f"{c}_before") + F.sum(c).over(inside)).alias(c) for c in columns))


def steps(rows: DataFrame, value: str, width: float) -> DataFrame:
    """``step`` from each value to the one before it, null for the first; values are ordered within spans of ``width``."""
    cut = rows.select(value, F.floor(F.col(value) / width).alias("span"))
    ends = cut.groupBy("span").agg(F.max(value).alias("last"))
    ends = ends.select(F.col("span").alias("own_span"), F.lag("last").over(Window.orderBy("span")).alias("previous"))
    before = F.lag(value).over(Window.partitionBy("span").orderBy(value))
    return cut.join(ends, F.col("span") == F.col("own_span")).select((F.col(value) - F.coalesce(before, F.col("previous"))).alias("step"))


def overlapped(rows: DataFrame, position: str, width: float, reach: float) -> DataFrame:
    """Rows with the ``block`` of ``width`` that their position is in; those within ``reach`` of its start also stand, as guests
    (``own`` false), in the block before, so that windows that look ahead can run block by block."""
    block = F.floor(F.col(position) / width)
    near = (F.col(position) - block * width <= reach) & (block > 0)
    listed = F.when(near, F.array(block, block - 1)).otherwise(F.array(block))
    return rows.withColumn("block", F.explode(listed)).withColumn("own", F.col("block") == F.floor(F.col(position) / width))
