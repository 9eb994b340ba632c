"""Window, ordering, sampling and set queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.stats import median
from ..operators import sampling as Sm
from ..operators import sequences as Q
from ..plans import attention as A
from ..sources import tables as T
from .attention import events_of, frames_of
from .registry import query


def track():
    return Window.partitionBy("track_id")


@query("win01_detection_rank", "SELECT frame_idx, x1, y1, conf, (row_number() OVER (PARTITION BY frame_idx ORDER BY conf DESC, x1, y1, x2, y2, cls) - 1)::INTEGER AS det_id FROM v_det")
def win01(s, d):
    order = Window.partitionBy("frame_idx").orderBy(F.desc("conf"), "x1", "y1", "x2", "y2", "cls")
    return T.detections(s, d).select("frame_idx", "x1", "y1", "conf", (F.row_number().over(order) - 1).alias("det_id"))


@query("win02_sliding_speed", """SELECT track_id, frame_idx, round(CASE WHEN c = 9 AND cx = 9 AND sxx >= 1e-12 THEN sqrt(bx * bx + b_y * b_y) END, 6) AS speed_mps FROM (SELECT track_id, frame_idx, count(*) OVER w AS c, count(x) OVER w AS cx,
    regr_sxx(x, ts) OVER w AS sxx, regr_slope(x, ts) OVER w AS bx, regr_slope(y, ts) OVER w AS b_y FROM v_obs WINDOW w AS (PARTITION BY track_id ORDER BY frame_idx ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING))""")
def win02(s, d):
    return Q.sliding_speed(T.observations(s, d)).select("track_id", "frame_idx", F.round("speed_mps", 6).alias("speed_mps"))


@query("flt09_speed_plausibility", "SELECT track_id, frame_idx, CASE WHEN speed <= 1.2 THEN speed END AS speed FROM v_obs")
def flt09(s, d):
    return T.observations(s, d).select("track_id", "frame_idx", F.when(F.col("speed") <= 1.2, F.col("speed")).alias("speed"))


@query("win03_clipped_gap", "SELECT track_id, frame_idx, round(coalesce(least(1::DOUBLE, greatest(0::DOUBLE, ts - lag(ts) OVER (PARTITION BY track_id ORDER BY frame_idx))), 0), 6) AS dt FROM v_obs")
def win03(s, d):
    step = F.col("ts") - F.lag("ts").over(track().orderBy("frame_idx"))
    clipped = F.when(step.isNull(), 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), step)))
    return T.observations(s, d).select("track_id", "frame_idx", F.round(clipped, 6).alias("dt"))


@query("win04_slow_runs", "SELECT track_id, zone_id, round(t0, 6) AS t0, round(t1, 6) AS t1, n FROM v_runs")
def win04(s, d):
    marked = frames_of(s, d).withColumn("standing", F.expr("in_apron AND is_slow"))
    return A.runs(marked, "standing", ["track_id", "zone_id"]).select("track_id", "zone_id", F.round("t0", 6).alias("t0"), F.round("t1", 6).alias("t1"), "n")


@query("win05_gap_sessions", """SELECT track_id, session::BIGINT AS session, round(min(ts), 6) AS t0, round(max(ts), 6) AS t1, count(*) AS n FROM (SELECT track_id, ts, sum(new) OVER (PARTITION BY track_id ORDER BY ts, frame_idx ROWS UNBOUNDED PRECEDING) AS session
    FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY track_id ORDER BY ts, frame_idx) > 1.0 THEN 1 ELSE 0 END AS new FROM v_obs)) GROUP BY track_id, session""")
def win05(s, d):
    return Q.gap_sessions(T.observations(s, d), 1.0).select("track_id", "session", F.round("t0", 6).alias("t0"), F.round("t1", 6).alias("t1"), "n")


@query("win06_stop_scores", "SELECT track_id, zone_id, round(stop_score, 6) AS stop_score FROM v_event WHERE stop_score IS NOT NULL")
def win06(s, d):
    return events_of(s, d).where("stop_score IS NOT NULL").select("track_id", "zone_id", F.round("stop_score", 6).alias("stop_score"))


@query("win07_smoothed_yaw", """SELECT track_id, frame_idx, smooth FROM v_obs LEFT JOIN (SELECT track_id, frame_idx, CASE WHEN many THEN list_min(list_transform(list_zip(range(len(vals)), vals),
    lambda p: struct_pack(c := round(list_sum(list_transform(vals, lambda o: abs(CASE WHEN (o - p[2] + 180) - 360 * floor((o - p[2] + 180) / 360::DOUBLE) = 0 THEN 180 ELSE (o - p[2] + 180) - 360 * floor((o - p[2] + 180) / 360::DOUBLE) - 180 END))), 9), k := p[1], v := p[2]))).v ELSE body_yaw END AS smooth
    FROM (SELECT track_id, frame_idx, body_yaw, list(body_yaw) OVER (PARTITION BY track_id ORDER BY frame_idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS vals, count(*) OVER (PARTITION BY track_id) >= 3 AS many FROM v_obs WHERE body_yaw IS NOT NULL)) USING (track_id, frame_idx)""")
def win07(s, d):
    return Q.smoothed_yaw(T.observations(s, d))


_PICKS = "list_contains(list_transform(range(least({k}, n)), lambda i: round_even(i * (n - 1) / greatest(least({k}, n) - 1, 1)::DOUBLE, 0)::BIGINT), place)"


@query("win08_even_picks", f"SELECT track_id, frame_idx FROM (SELECT track_id, frame_idx, row_number() OVER (PARTITION BY track_id ORDER BY frame_idx) - 1 AS place, count(*) OVER (PARTITION BY track_id) AS n FROM v_obs) WHERE {_PICKS.format(k=5)}")
def win08(s, d):
    return Q.even_picks(T.observations(s, d).select("track_id", "frame_idx"), 5)


@query("win09_middle_row", "SELECT track_id, frame_idx FROM (SELECT track_id, frame_idx, row_number() OVER (PARTITION BY track_id ORDER BY frame_idx) AS r, count(*) OVER (PARTITION BY track_id) AS n FROM v_obs) WHERE r = n // 2 + 1")
def win09(s, d):
    rows = T.observations(s, d).select("track_id", "frame_idx", F.row_number().over(track().orderBy("frame_idx")).alias("r"), F.count("*").over(track()).alias("n"))
    return rows.where(F.col("r") == F.floor(F.col("n") / 2) + 1).select("track_id", "frame_idx")


@query("win10_densest_frames", """SELECT frame_idx, total::BIGINT AS total FROM (SELECT frame_idx, sum(n_detections) OVER (ORDER BY frame_idx ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS total,
    count(*) OVER (ORDER BY frame_idx ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS c FROM v_frame WHERE processed) WHERE c = 50 ORDER BY total DESC, frame_idx LIMIT 1""")
def win10(s, d):
    """The window of 50 processed frames with most detections, the first of equals. Frames of one recording form one order."""
    placed = Q.numbered(T.frames(s, d).where("processed").select("frame_idx", "n_detections"), F.floor(F.col("frame_idx") / SPAN), ["frame_idx"])
    w = Window.partitionBy("block").orderBy("place").rowsBetween(0, 49)
    rows = Q.overlapped(placed, "place", SPAN, 48).select("frame_idx", "own", F.sum("n_detections").over(w).alias("total"), F.count("*").over(w).alias("c"))
    return rows.where("own AND c = 50").orderBy(F.desc("total"), "frame_idx").limit(1).select("frame_idx", "total")


@query("win11_densest_time", """SELECT round(ts, 6) AS ts, round(mean, 6) AS mean FROM (SELECT ts, avg(n_detections) OVER (ORDER BY ts RANGE BETWEEN CURRENT ROW AND 5 FOLLOWING) AS mean, max(ts) OVER () AS last FROM v_frame WHERE processed)
    WHERE ts + 5 <= last ORDER BY round(mean, 9) DESC, ts LIMIT 1""")
def win11(s, d):
    rows = T.frames(s, d).where("processed")
    mean = F.avg("n_detections").over(Window.partitionBy("block").orderBy("ts").rangeBetween(0, 5))
    last = F.broadcast(rows.agg(F.max("ts").alias("last")))
    fits = Q.overlapped(rows, "ts", 600.0, 5.0).select("ts", "own", mean.alias("mean")).where("own").crossJoin(last).where("ts + 5 <= last")
    return fits.orderBy(F.round("mean", 9).desc(), "ts").limit(1).select(F.round("ts", 6).alias("ts"), F.round("mean", 6).alias("mean"))


@query("win12_rank_strata", """SELECT track_id, frame_idx, ((r >= round_even(m / 3::DOUBLE, 0))::INTEGER + (r >= round_even(2 * m / 3::DOUBLE, 0))::INTEGER)::INTEGER AS stratum
    FROM (SELECT track_id, frame_idx, row_number() OVER (PARTITION BY foot_source ORDER BY yaw_conf, track_id, frame_idx) - 1 AS r, count(*) OVER (PARTITION BY foot_source) AS m FROM v_obs WHERE yaw_conf IS NOT NULL)""")
def win12(s, d):
    rows = T.observations(s, d).where("yaw_conf IS NOT NULL")
    return Q.rank_strata(rows, 3, ["foot_source"], ["yaw_conf", "track_id", "frame_idx"]).select("track_id", "frame_idx", "stratum")


@query("win13_best_per_track", "SELECT track_id, frame_idx FROM (SELECT track_id, frame_idx, row_number() OVER (PARTITION BY track_id ORDER BY yaw_conf DESC NULLS LAST, frame_idx) AS r FROM v_obs) WHERE r <= 3")
def win13(s, d):
    best = F.row_number().over(track().orderBy(F.col("yaw_conf").desc_nulls_last(), "frame_idx"))
    return T.observations(s, d).withColumn("r", best).where("r <= 3").select("track_id", "frame_idx")


@query("win14_three_strata", "SELECT CASE WHEN r < m // 3 THEN 0 WHEN r < 2 * m // 3 THEN 1 ELSE 2 END AS stratum, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY model_conf, frame_idx) - 1 AS r, count(*) OVER () AS m FROM v_label) GROUP BY 1")
def win14(s, d):
    rows = Q.numbered(T.labelled_angles(s, d), F.floor(F.col("model_conf") * 10_000), ["model_conf", "frame_idx"]).withColumnRenamed("place", "r")
    stratum = F.when(F.col("r") < F.floor(F.col("m") / 3), 0).when(F.col("r") < F.floor(2 * F.col("m") / 3), 1).otherwise(2)
    return rows.groupBy(stratum.alias("stratum")).agg(F.count("*").alias("n"))


@query("win15_dwell_so_far", "SELECT track_id, frame_idx, round(ts - min(ts) OVER (PARTITION BY track_id), 6) AS dwell FROM v_obs")
def win15(s, d):
    return T.observations(s, d).select("track_id", "frame_idx", F.round(F.col("ts") - F.min("ts").over(track()), 6).alias("dwell"))


@query("win16_time_steps", "SELECT track_id, round(quantile_cont(step, 0.75) - quantile_cont(step, 0.25), 6) AS iqr FROM (SELECT track_id, ts - lag(ts) OVER (PARTITION BY track_id ORDER BY ts) AS step FROM (SELECT DISTINCT track_id, ts FROM v_obs)) GROUP BY 1")
def win16(s, d):
    steps = T.observations(s, d).select("track_id", "ts").distinct().select("track_id", (F.col("ts") - F.lag("ts").over(track().orderBy("ts"))).alias("step"))
    return steps.groupBy("track_id").agg(F.round(F.percentile("step", F.lit(0.75)) - F.percentile("step", F.lit(0.25)), 6).alias("iqr"))


@query("win17_named_ranks", """SELECT track_id, frame_idx, rank() OVER w::INTEGER AS rnk, dense_rank() OVER w::INTEGER AS dense, lead(frame_idx) OVER (PARTITION BY track_id ORDER BY frame_idx) AS nxt, first_value(frame_idx) OVER (PARTITION BY track_id ORDER BY frame_idx) AS fst,
    ntile(4) OVER (PARTITION BY track_id ORDER BY frame_idx)::INTEGER AS quarter, round(cume_dist() OVER w, 9) AS dist FROM v_obs WINDOW w AS (PARTITION BY track_id ORDER BY n_kpts_valid)""".replace("rank() OVER w::INTEGER AS rnk, dense_rank() OVER w::INTEGER", "(rank() OVER w)::INTEGER AS rnk, (dense_rank() OVER w)::INTEGER").replace("ntile(4) OVER (PARTITION BY track_id ORDER BY frame_idx)::INTEGER", "(ntile(4) OVER (PARTITION BY track_id ORDER BY frame_idx))::INTEGER"))
def win17(s, d):
    w, f = track().orderBy("n_kpts_valid"), track().orderBy("frame_idx")
    return T.observations(s, d).select(
        "track_id", "frame_idx", F.rank().over(w).alias("rnk"), F.dense_rank().over(w).alias("dense"), F.lead("frame_idx").over(f).alias("nxt"),
        F.first_value("frame_idx").over(f).alias("fst"), F.ntile(4).over(f).alias("quarter"), F.round(F.cume_dist().over(w), 9).alias("dist"),
    )


#: Frames, or rows, that are ordered together.
SPAN = 10_000


@query("srt01_track_order", "SELECT track_id, frame_idx, row_number() OVER (PARTITION BY track_id ORDER BY frame_idx)::INTEGER AS place FROM v_obs".replace("row_number() OVER (PARTITION BY track_id ORDER BY frame_idx)::INTEGER", "(row_number() OVER (PARTITION BY track_id ORDER BY frame_idx))::INTEGER"))
def srt01(s, d):
    return T.observations(s, d).select("track_id", "frame_idx", F.row_number().over(track().orderBy("frame_idx")).alias("place"))


@query("srt02_top_cells", "SELECT cx, cy, n FROM (SELECT floor(x / 3)::BIGINT AS cx, floor(y / 3)::BIGINT AS cy, count(*) AS n FROM v_obs WHERE x IS NOT NULL GROUP BY ALL) ORDER BY n DESC, cx, cy LIMIT 10")
def srt02(s, d):
    cells = T.observations(s, d).where("x IS NOT NULL").groupBy(F.floor(F.col("x") / 3).alias("cx"), F.floor(F.col("y") / 3).alias("cy")).agg(F.count("*").alias("n"))
    return cells.orderBy(F.desc("n"), "cx", "cy").limit(10)


_CLAIMS = "SELECT foot_source AS claim, track_id, frame_idx, yaw_conf AS confidence FROM v_obs WHERE yaw_conf IS NOT NULL"


def claims(s, d):
    return T.observations(s, d).where("yaw_conf IS NOT NULL").select(F.col("foot_source").alias("claim"), "track_id", "frame_idx", F.col("yaw_conf").alias("confidence"))


@query("srt03_head_per_claim", f"SELECT claim, track_id, frame_idx FROM (SELECT *, row_number() OVER (PARTITION BY claim ORDER BY confidence, track_id, frame_idx) AS r FROM ({_CLAIMS})) WHERE r <= 12")
def srt03(s, d):
    w = Window.partitionBy("claim").orderBy("confidence", "track_id", "frame_idx")
    return claims(s, d).withColumn("r", F.row_number().over(w)).where("r <= 12").select("claim", "track_id", "frame_idx")


@query("srt04_riskiest_first", "SELECT frame_idx, round((y2 - y1) / (x2 - x1), 6) AS aspect FROM v_det ORDER BY aspect, frame_idx, x1, y1 LIMIT 20")
def srt04(s, d):
    aspect = F.round((F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1")), 6)
    return T.detections(s, d).withColumn("aspect", aspect).orderBy("aspect", "frame_idx", "x1", "y1").limit(20).select("frame_idx", "aspect")


@query("srt05_nearest_zone", "SELECT track_id, frame_idx, zone_id FROM (SELECT track_id, frame_idx, zone_id, row_number() OVER (PARTITION BY track_id, frame_idx ORDER BY round((x - least(greatest(x, ax), bx))^2 + (y - ay)^2, 9), zone_id) AS r FROM v_obs, v_zone WHERE x IS NOT NULL) WHERE r = 1")
def srt05(s, d):
    from ..functions.geometry import segment_distance

    dist = F.round(F.pow(segment_distance(*(F.col(c) for c in ("x", "y", "ax", "ay", "bx", "by"))), 2.0), 9)
    rows = T.observations(s, d).where("x IS NOT NULL").crossJoin(F.broadcast(T.zones(s))).withColumn("key", F.struct(dist.alias("dist"), "zone_id"))
    return rows.groupBy("track_id", "frame_idx").agg(F.min("key")["zone_id"].alias("zone_id"))


_DRAWN = Sm.drawn_sql("claim, track_id, frame_idx")


@query("srt06_reservoir", f"SELECT claim, track_id, frame_idx FROM (SELECT *, row_number() OVER (PARTITION BY claim ORDER BY {_DRAWN}, track_id, frame_idx) AS r FROM ({_CLAIMS})) WHERE r <= 2000")
def srt06(s, d):
    return Sm.reservoir(claims(s, d), "claim", ["track_id", "frame_idx"], 2000).select("claim", "track_id", "frame_idx")


@query("srt07_stratified_sample", f"""SELECT claim, track_id, frame_idx, stratum FROM (SELECT *, row_number() OVER (PARTITION BY claim ORDER BY (extra > 0)::INTEGER, extra, stratum) AS turn FROM (
    SELECT *, greatest(row_number() OVER (PARTITION BY claim, stratum ORDER BY {_DRAWN}, track_id, frame_idx) - 4, 0) AS extra FROM (
    SELECT *, ((r >= round_even(m / 3::DOUBLE, 0))::INTEGER + (r >= round_even(2 * m / 3::DOUBLE, 0))::INTEGER)::INTEGER AS stratum FROM (
    SELECT *, row_number() OVER (PARTITION BY claim ORDER BY confidence, track_id, frame_idx) - 1 AS r, count(*) OVER (PARTITION BY claim) AS m FROM ({_CLAIMS}))))) WHERE turn <= 12""")
def srt07(s, d):
    """Twelve rows a claim, four a stratum where there are enough."""
    return Sm.stratified(claims(s, d), "claim", ["track_id", "frame_idx"], "confidence", 12, 3).select("claim", "track_id", "frame_idx", "stratum")


@query("srt08_random_subset", f"SELECT track_id, frame_idx FROM v_obs ORDER BY {Sm.drawn_sql('frame_idx', 7)}, frame_idx LIMIT 500")
def srt08(s, d):
    return T.observations(s, d).orderBy(Sm.drawn(["frame_idx"], 7), "frame_idx").limit(500).select("track_id", "frame_idx")


@query("srt09_capped_frames", f"SELECT track_id, frame_idx FROM (SELECT track_id, frame_idx, place, n FROM (SELECT track_id, frame_idx, row_number() OVER (PARTITION BY track_id ORDER BY frame_idx) - 1 AS place, count(*) OVER (PARTITION BY track_id) AS n FROM v_obs)), (SELECT greatest(1, least(6, ceil(600 / count(DISTINCT track_id))))::BIGINT AS cap FROM v_obs) WHERE {_PICKS.format(k='cap')}")
def srt09(s, d):
    """As many evenly spaced frames of each track as share 600 among all, one at least and six at most."""
    obs = T.observations(s, d).select("track_id", "frame_idx")
    cap = obs.agg(F.greatest(F.lit(1), F.least(F.lit(6), F.ceil(600 / F.countDistinct("track_id")))).cast("long").alias("cap"))
    placed = obs.withColumns({"place": F.row_number().over(track().orderBy("frame_idx")) - 1, "n": F.count("*").over(track())}).crossJoin(F.broadcast(cap))
    steps = F.least("cap", "n")
    wanted = F.transform(F.sequence(F.lit(0), (steps - 1).cast("int")), lambda i: F.bround(i * (F.col("n") - 1) / F.greatest(steps - 1, F.lit(1)), 0).cast("long"))
    return placed.where(F.array_contains(wanted, F.col("place").cast("long"))).select("track_id", "frame_idx")


@query("srt10_every_kth", "SELECT track_id, frame_idx FROM (SELECT track_id, frame_idx, row_number() OVER (PARTITION BY track_id ORDER BY frame_idx) AS r FROM v_obs) WHERE (r - 1) % 7 = 0")
def srt10(s, d):
    return T.observations(s, d).withColumn("r", F.row_number().over(track().orderBy("frame_idx"))).where((F.col("r") - 1) % 7 == 0).select("track_id", "frame_idx")


@query("srt11_shuffled_order", f"SELECT frame_idx, row_number() OVER (ORDER BY {Sm.drawn_sql('frame_idx')}, frame_idx) - 1 AS place FROM v_label")
def srt11(s, d):
    """Labels in an order drawn by a hash: every one has a place of its own."""
    return Sm.shuffled(T.labelled_angles(s, d).select("frame_idx"), ["frame_idx"]).select("frame_idx", "place")


@query("srt12_middle_hit", "SELECT track_id, frame_idx FROM (SELECT track_id, frame_idx, row_number() OVER (ORDER BY frame_idx, track_id, zone_id) AS r, count(*) OVER () AS n FROM v_tz WHERE gaze_hit) WHERE r = n // 2 + 1")
def srt12(s, d):
    hits = frames_of(s, d).where("gaze_hit").select("track_id", "frame_idx", "zone_id")
    placed = Q.numbered(hits, F.floor(F.col("frame_idx") / SPAN), ["frame_idx", "track_id", "zone_id"])
    return placed.where(F.col("place") == F.floor(F.col("m") / 2)).select("track_id", "frame_idx")


@query("set01_union_all", "SELECT 'event' AS kind, track_id FROM v_event UNION ALL SELECT 'obs', track_id FROM v_obs")
def set01(s, d):
    return events_of(s, d).select(F.lit("event").alias("kind"), "track_id").unionByName(T.observations(s, d).select(F.lit("obs").alias("kind"), "track_id"))


@query("set03_difference", "SELECT track_id FROM v_event EXCEPT SELECT track_id FROM v_counted")
def set03(s, d):
    events = events_of(s, d)
    return events.select("track_id").subtract(A.counted(events).select("track_id"))


@query("set04_distinct", "SELECT DISTINCT foot_source, n_kpts_valid FROM v_obs")
def set04(s, d):
    return T.observations(s, d).select("foot_source", "n_kpts_valid").distinct()


@query("set05_stacked_bounds", "SELECT min(x) AS lo_x, max(x) AS hi_x, min(y) AS lo_y, max(y) AS hi_y FROM (SELECT x, y FROM v_obs UNION ALL SELECT ax, ay FROM v_zone UNION ALL SELECT bx, b_y FROM v_zone)")
def set05(s, d):
    zones = T.zones(s)
    points = T.observations(s, d).select("x", "y").union(zones.select("ax", "ay")).union(zones.select("bx", "by"))
    return points.agg(F.min("x").alias("lo_x"), F.max("x").alias("hi_x"), F.min("y").alias("lo_y"), F.max("y").alias("hi_y"))


@query("flt16_recent_tail", "SELECT track_id, frame_idx, count(*) OVER (PARTITION BY track_id ORDER BY frame_idx RANGE BETWEEN 44 PRECEDING AND CURRENT ROW) AS n FROM v_obs")
def flt16(s, d):
    """Rows of the track within the 45 frames up to each row."""
    return T.observations(s, d).select("track_id", "frame_idx", F.count("*").over(track().orderBy("frame_idx").rangeBetween(-44, 0)).alias("n"))


@query("agg43_tails", "SELECT track_id, list(frame_idx ORDER BY frame_idx) AS frames, count(*) AS n FROM v_obs WHERE x IS NOT NULL GROUP BY 1")
def agg43(s, d):
    return T.observations(s, d).where("x IS NOT NULL").groupBy("track_id").agg(F.array_sort(F.collect_list("frame_idx")).alias("frames"), F.count("*").alias("n"))


@query("agg50_rate_estimate", "SELECT round(1 / median(step), 6) AS fps FROM (SELECT ts - lag(ts) OVER (ORDER BY ts) AS step FROM v_frame)")
def agg50(s, d):
    return Q.exact_median(Q.steps(T.frames(s, d), "ts", 600.0), "step", 0.001).select(F.round(1 / F.col("median"), 6).alias("fps"))
