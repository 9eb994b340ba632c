"""From track-frames and storefronts to attention episodes: one Spark plan.

Storefronts are a few literal rows, so the spatial join is a broadcast one; the costly sector test runs only for frames near
enough to reach a facade with a known angle. Windows and the aggregate that follow share the partitioning by track.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.angles import unit_x, unit_y
from ..functions.stats import wilson
from ..operators.sequences import exact_median


@dataclass(frozen=True)
class Rules:
    """Thresholds of episodes: metres, degrees, seconds and shares."""

    reach: float = 8.0
    half_sector: float = 21.2
    grazing: float = 70.0
    slow_share: float = 0.25
    stop_seconds: float = 1.5
    gaze_share: float = 0.2
    least_frames: int = 5


def positions(obs: DataFrame) -> DataFrame:
    """Track-frames with a position: refined where there is one, and the head's angle before the body's."""
    return obs.select(
        "track_id", "frame_idx", "ts", F.coalesce("x_ref", "x").alias("x"), F.coalesce("y_ref", "y").alias("y"),
        F.coalesce("head_yaw", "body_yaw").alias("yaw"), "speed",
    ).where("x IS NOT NULL AND y IS NOT NULL")


def stop_threshold(pos: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row: the speed below which a track stands, relative to the flow's median."""
    return exact_median(pos, "speed", 0.01).select((F.lit(rules.slow_share) * F.col("median")).alias("thr"))


def zone_frames(obs: DataFrame, zones: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Every track-frame with every zone: in the apron, near, slow, looking at the facade, and how flatly.

    With each come its place in the track, and the track's first frame and span of time (seq, frame0, t_start, t_end), so that rows without
    bearing on a zone need not be kept for episodes.

    Each step's results are columns of their own, so that the next refers to them instead of computing them again: the rays'
    directions once a track-frame, their distances once a zone, then the nearest of them and how steeply it meets the facade.
    """
    pos = positions(obs)
    threshold = stop_threshold(pos, rules)
    track = Window.partitionBy("track_id")
    pos = pos.withColumns({
        "seq": F.row_number().over(track.orderBy("frame_idx")), "frame0": F.min("frame_idx").over(track), "t_start": F.min("ts").over(track), "t_end": F.max("ts").over(track),
    })
    rays = [-rules.half_sector, 0.0, rules.half_sector]
    aimed = pos.withColumns({f"{axis}{k}": unit(F.col("yaw") + turn) for k, turn in enumerate(rays) for axis, unit in (("dx", unit_x), ("dy", unit_y))})
    joined = aimed.crossJoin(F.broadcast(threshold)).crossJoin(F.broadcast(zones))
    c = {n: F.col(n) for n in ("x", "y", "ax", "ay", "bx", "by", "yaw")}
    apron = [("apron_x0", "apron_y0"), ("apron_x1", "apron_y0"), ("apron_x1", "apron_y1"), ("apron_x0", "apron_y1")]
    ring = [(F.col(a), F.col(b)) for a, b in apron]
    near = G.segment_distance(c["x"], c["y"], c["ax"], c["ay"], c["bx"], c["by"]) <= rules.reach
    seen = joined.withColumn("near", near).withColumn("in_apron", G.point_in_polygon(c["x"], c["y"], ring))
    looking = F.col("near") & F.col("yaw").isNotNull()
    facade = [c[n] for n in ("ax", "ay", "bx", "by")]
    # Each ray meets the facade's line at t along itself and u along the facade.
    ex, ey, qx, qy = c["bx"] - c["ax"], c["by"] - c["ay"], c["ax"] - c["x"], c["ay"] - c["y"]
    dets = seen.withColumns({"looking": looking, **{f"det{k}": F.col(f"dx{k}") * ey - F.col(f"dy{k}") * ex for k in range(3)}})
    fine = [F.when(F.abs(F.col(f"det{k}")) >= G.NOWHERE, F.col(f"det{k}")) for k in range(3)]
    met = dets.withColumns({f"t{k}": (qx * ey - qy * ex) / fine[k] for k in range(3)} | {f"u{k}": (qx * F.col(f"dy{k}") - qy * F.col(f"dx{k}")) / fine[k] for k in range(3)})
    looking = F.col("looking")
    along = met.withColumns({f"d{k}": F.when(looking & F.col(f"t{k}").between(0, rules.reach) & F.col(f"u{k}").between(0, 1), F.col(f"t{k}")) for k in range(3)})
    missed = looking & F.coalesce("d0", "d1", "d2").isNull()
    ends = along.withColumns({f"d{k}": F.when(missed, G.end_distance(c["x"], c["y"], c["yaw"], rules.half_sector, px, py, rules.reach)) for k, (px, py) in ((3, facade[:2]), (4, facade[2:]))})
    near_by = ends.withColumns({f"r{k}": F.round(f"d{k}", 9) for k in range(5)}).withColumn("gaze_dist", F.least(*(f"r{k}" for k in range(5))))
    # How steeply the sight of the nearest meets the facade: the part of its direction across it. Of equal distances the earlier counts.
    width = F.hypot(ex, ey)
    across = [F.abs(F.col(f"det{k}")) for k in range(3)] + [F.abs((py - c["y"]) * ex - (px - c["x"]) * ey) / F.col(f"d{k}") for k, (px, py) in ((3, facade[:2]), (4, facade[2:]))]
    steep = F.coalesce(*(F.when(F.col(f"r{k}") == F.col("gaze_dist"), F.when(F.col(f"d{k}") * width >= G.NOWHERE, part / width).otherwise(-1.0)) for k, part in enumerate(across)))
    hits = near_by.withColumn("steep", steep)
    # Rounded, so that an angle on the limit does not depend on the last bit of an arc cosine; no length is no angle, and grazes.
    angle = F.when(F.col("steep") >= 0, F.degrees(F.acos(F.least(F.lit(1.0), "steep")))).otherwise(90.0)
    flat = F.round(angle, 9) > rules.grazing
    hit = F.col("gaze_dist").isNotNull()
    return hits.select(
        "track_id", "frame_idx", "zone_id", "ts", "x", "y", "yaw", "near", "in_apron",
        F.coalesce(F.col("speed") < F.col("thr"), F.lit(False)).alias("is_slow"), hit.alias("gaze_hit"), "gaze_dist", F.when(hit, flat).otherwise(False).alias("grazing"),
        "seq", "frame0", "t_start", "t_end",
    )


def relevant(frames: DataFrame) -> DataFrame:
    """The trace that is kept: frames in an apron, near it, or looking at it.

    Only a near frame can look at a facade, so that the condition needs no sector test and goes below it.
    """
    return frames.where("in_apron OR near")


def runs(frames: DataFrame, mask: str, keys: list[str]) -> DataFrame:
    """Unbroken runs of rows where ``mask`` holds, by ``keys``: first and last time and number of rows."""
    order = Window.partitionBy(*keys).orderBy("frame_idx")
    broken = F.sum(F.when(F.col(mask), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        frames.withColumn("run", broken).where(F.col(mask)).groupBy(*keys, "run")
        .agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.count("*").alias("n"))
    )


def episodes(frames: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """At most one episode a track and zone, from the relevant ones of ``zone_frames`` at least.

    Standing rows are one run while their places in the track are consecutive. Runs are summed first, then zones: both share the
    frames' partitioning by track.
    """
    keys = ["track_id", "zone_id"]
    marked = relevant(frames).withColumn("standing", F.col("in_apron") & F.col("is_slow"))
    place = F.row_number().over(Window.partitionBy(*keys, "standing").orderBy("seq"))
    seen = F.col("near") & F.col("yaw").isNotNull()
    flags, ends = ("grazing", "in_apron", "near"), ("frame0", "t_start", "t_end")
    by_run = marked.withColumn("run", F.when(F.col("standing"), F.col("seq") - place)).groupBy(*keys, "run").agg(
        F.count_if(seen).alias("orient_n"), F.count_if("gaze_hit").alias("hits"), *(F.bool_or(c).alias(c) for c in flags), *(F.min(c).alias(c) for c in ends),
        (F.max("ts") - F.min("ts")).alias("stood"),
    )
    stood = F.when(F.col("run").isNotNull() & (F.col("stood") >= rules.stop_seconds), F.col("stood"))
    sums = by_run.groupBy(*keys).agg(
        *(F.sum(c).alias(c) for c in ("orient_n", "hits")), *(F.bool_or(c).alias(c) for c in flags), *(F.min(c).alias(c) for c in ends), F.sum(stood).alias("stop_time")
    )
    scored = sums.withColumn("gaze", F.col("hits") / F.when(F.col("orient_n") > 0, F.col("orient_n")))
    gaze, stop = F.coalesce(F.col("gaze") >= rules.gaze_share, F.lit(False)), F.col("stop_time").isNotNull()
    kind = F.when(stop & gaze, "stop_and_gaze").when(stop, "stop").when(gaze, "gaze").when(F.col("in_apron") | F.col("near"), "pass_by")
    life = F.col("t_end") - F.col("t_start")
    share = F.when(F.col("in_apron") & (life > 0), F.least(F.lit(1.0), F.coalesce("stop_time", F.lit(0.0)) / life))
    thin = gaze & (F.col("orient_n") < rules.least_frames)
    named = scored.withColumn("event_type", kind).where("event_type IS NOT NULL")
    return named.select(
        F.concat_ws(":", "track_id", "zone_id", "event_type", "frame0").alias("event_id"), "track_id", "zone_id", "t_start", "t_end",
        share.alias("stop_score"), F.least(F.lit(1.0), F.col("gaze")).alias("gaze_score"), "event_type",
        (F.col("grazing") | (F.col("orient_n") == 0) | thin).alias("low_confidence"), thin.alias("thin"), "orient_n",
    )


def gaze_counts() -> Column:
    """Whether an episode's attention counts: a gaze, with confidence. The one definition that all metrics share."""
    return F.col("event_type").isin("gaze", "stop_and_gaze") & ~F.col("low_confidence")


def counted(events: DataFrame) -> DataFrame:
    """Episodes of attention that count."""
    return events.where(gaze_counts())


def stopped(events: DataFrame) -> DataFrame:
    """Episodes with a stop; confidence concerns gazes and is not asked for."""
    return events.where(F.col("event_type").isin("stop", "stop_and_gaze"))


def zone_rates(events: DataFrame) -> DataFrame:
    """Visitors, stop and orientation rates of each zone with their Wilson intervals, counted by track."""
    gaze = gaze_counts()
    stop = F.col("event_type").isin("stop", "stop_and_gaze")
    by_zone = events.groupBy("zone_id").agg(
        F.countDistinct("track_id").alias("visitors"), F.countDistinct(F.when(stop, F.col("track_id"))).alias("stoppers"),
        F.countDistinct(F.when(gaze, F.col("track_id"))).alias("lookers"),
    )
    out = ["zone_id", "visitors", "stoppers", "lookers"]
    for name, k in (("stop", "stoppers"), ("orientation", "lookers")):
        low, high = wilson(F.col(k), F.col("visitors"))
        rate = F.col(k) / F.when(F.col("visitors") > 0, F.col("visitors"))
        by_zone = by_zone.withColumns({f"{name}_rate": F.round(rate, 6), f"{name}_low": F.round(low, 6), f"{name}_high": F.round(high, 6)})
        out += [f"{name}_rate", f"{name}_low", f"{name}_high"]
    return by_zone.select(*out)
