"""Episodes and the metrics of storefronts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import median, wilson_sql
from ..operators import sequences as Q
from ..plans import attention as A
from ..sources import tables as T
from ..sources.staging import staged
from .registry import DERIVED, query

R = A.Rules()


def _ray(offset: float) -> str:
    """SQL struct of a ray's hit: distance, order and point."""
    rank = {-1: 0, 0: 1, 1: 2}[(offset > 0) - (offset < 0)]
    dx, dy = f"cos(radians(yaw + {offset}::DOUBLE))", f"sin(radians(yaw + {offset}::DOUBLE))"
    det = f"({dx} * (b_y - ay) - {dy} * (bx - ax))"
    t = f"(((ax - x) * (b_y - ay) - (ay - y) * (bx - ax)) / {det})"
    u = f"(((ax - x) * {dy} - (ay - y) * {dx}) / {det})"
    return (
        f"CASE WHEN abs({det}) >= 1e-12 AND {t} >= 0 AND {t} <= {R.reach} AND {u} >= 0 AND {u} <= 1"
        f" THEN struct_pack(dist := round({t}, 9), r := {rank}, hx := x + {t} * {dx}, hy := y + {t} * {dy}) END"
    )


def _end(rank: int, px: str, py: str) -> str:
    d = f"sqrt(({px} - x) * ({px} - x) + ({py} - y) * ({py} - y))"
    a = f"(degrees(atan2({py} - y, {px} - x)) - yaw + 180)"
    turn = f"abs({a} - 360 * floor({a} / 360) - 180)"
    return f"CASE WHEN {d} <= {R.reach} AND {d} >= 1e-12 AND {turn} <= {R.half_sector} THEN struct_pack(dist := round({d}, 9), r := {rank}, hx := {px}, hy := {py}) END"


_T = "CASE WHEN (bx-ax)*(bx-ax)+(b_y-ay)*(b_y-ay) >= 1e-12 THEN least(1::DOUBLE, greatest(0::DOUBLE, ((x-ax)*(bx-ax)+(y-ay)*(b_y-ay)) / ((bx-ax)*(bx-ax)+(b_y-ay)*(b_y-ay)))) ELSE 0::DOUBLE END"
_SIZE = "(sqrt((bx-ax)*(bx-ax)+(b_y-ay)*(b_y-ay)) * sqrt((hit.hx-x)*(hit.hx-x)+(hit.hy-y)*(hit.hy-y)))"
DERIVED |= {
    "v_pos": """SELECT track_id, frame_idx, ts, coalesce(x_ref, x) AS x, coalesce(y_ref, y) AS y, coalesce(head_yaw, body_yaw) AS yaw, speed
        FROM v_obs WHERE coalesce(x_ref, x) IS NOT NULL AND coalesce(y_ref, y) IS NOT NULL""",
    "v_thr": f"SELECT {R.slow_share}::DOUBLE * median(speed) AS thr FROM v_pos",
    "v_near": f"""SELECT *, sqrt((x - (ax + tt*(bx-ax)))*(x - (ax + tt*(bx-ax))) + (y - (ay + tt*(b_y-ay)))*(y - (ay + tt*(b_y-ay)))) <= {R.reach} AS near FROM
        (SELECT *, {_T} AS tt FROM v_pos, v_thr, v_zone)""",
    "v_hit": f"""SELECT *, x >= apron_x0 AND x < apron_x1 AND y >= apron_y0 AND y < apron_y1 AS in_apron, CASE WHEN near AND yaw IS NOT NULL THEN coalesce(
        list_min(list_filter([{_ray(-R.half_sector)}, {_ray(0.0)}, {_ray(R.half_sector)}], lambda h: h IS NOT NULL)),
        list_min(list_filter([{_end(3, "ax", "ay")}, {_end(4, "bx", "b_y")}], lambda h: h IS NOT NULL))) END AS hit FROM v_near""",
    "v_tz": f"""SELECT track_id, frame_idx, zone_id, ts, x, y, yaw, near, in_apron, coalesce(speed < thr, false) AS is_slow, hit IS NOT NULL AS gaze_hit, hit.dist AS gaze_dist,
        hit IS NOT NULL AND round(coalesce(degrees(acos(least(1::DOUBLE, abs((hit.hx-x) * -(b_y-ay) + (hit.hy-y) * (bx-ax)) / CASE WHEN {_SIZE} >= 1e-12 THEN {_SIZE} END))), 90), 9) > {R.grazing} AS grazing FROM v_hit""",
    "v_runs": """SELECT track_id, zone_id, run, min(ts) AS t0, max(ts) AS t1, count(*) AS n FROM (SELECT *, in_apron AND is_slow AS standing,
        sum(CASE WHEN in_apron AND is_slow THEN 0 ELSE 1 END) OVER (PARTITION BY track_id, zone_id ORDER BY frame_idx ROWS UNBOUNDED PRECEDING) AS run FROM v_tz) WHERE standing GROUP BY ALL""",
    "v_ep": f"""SELECT *, coalesce(gaze >= {R.gaze_share}, false) AS has_gaze, stop_time IS NOT NULL AS has_stop FROM (SELECT *, hits / nullif(orient_n, 0) AS gaze FROM (
        SELECT track_id, zone_id, count(*) FILTER (near AND yaw IS NOT NULL) AS orient_n, count(*) FILTER (gaze_hit) AS hits, bool_or(grazing) AS grazing, bool_or(in_apron) AS in_apron,
        bool_or(near) AS near, min(frame_idx) AS frame0, min(ts) AS t_start, max(ts) AS t_end FROM v_tz GROUP BY ALL)
        LEFT JOIN (SELECT track_id, zone_id, sum(t1 - t0) AS stop_time FROM v_runs WHERE t1 - t0 >= {R.stop_seconds} GROUP BY ALL) USING (track_id, zone_id))""",
    "v_event": f"""SELECT concat_ws(':', track_id, zone_id, event_type, frame0) AS event_id, track_id, zone_id, t_start, t_end,
        CASE WHEN in_apron AND t_end > t_start THEN least(1::DOUBLE, coalesce(stop_time, 0) / (t_end - t_start)) END AS stop_score, least(1::DOUBLE, gaze) AS gaze_score, event_type,
        grazing OR orient_n = 0 OR thin AS low_confidence, thin, orient_n FROM (SELECT *, has_gaze AND orient_n < {R.least_frames} AS thin,
        CASE WHEN has_stop AND has_gaze THEN 'stop_and_gaze' WHEN has_stop THEN 'stop' WHEN has_gaze THEN 'gaze' WHEN in_apron OR near THEN 'pass_by' END AS event_type FROM v_ep) WHERE event_type IS NOT NULL""",
    "v_counted": "SELECT * FROM v_event WHERE event_type IN ('gaze', 'stop_and_gaze') AND NOT low_confidence",
    "v_stopped": "SELECT * FROM v_event WHERE event_type IN ('stop', 'stop_and_gaze')",
}


def frames_of(spark: SparkSession, sf: str) -> DataFrame:
    """All zone frames, for what reads them once."""
    return A.zone_frames(T.observations(spark, sf), T.zones(spark))


def trace_of(spark: SparkSession, sf: str) -> DataFrame:
    """The relevant zone frames, written, for what reads them several times; in partitions by track, as episodes need them."""
    return staged(A.relevant(frames_of(spark, sf))).repartition("track_id")


def events_of(spark: SparkSession, sf: str) -> DataFrame:
    return A.episodes(frames_of(spark, sf))


def _wilson(name: str, k: str, n: str = "visitors") -> str:
    low, high = wilson_sql(k, n)
    return f"round({k} / nullif({n}, 0), 6) AS {name}_rate, round({low}, 6) AS {name}_low, round({high}, 6) AS {name}_high"


RATES_SQL = f"""SELECT *, {_wilson("stop", "stoppers")}, {_wilson("orientation", "lookers")} FROM (
    SELECT zone_id, count(DISTINCT track_id) AS visitors, count(DISTINCT CASE WHEN event_type IN ('stop', 'stop_and_gaze') THEN track_id END) AS stoppers,
    count(DISTINCT CASE WHEN event_type IN ('gaze', 'stop_and_gaze') AND NOT low_confidence THEN track_id END) AS lookers FROM v_event GROUP BY 1)"""


@query("agg18_zone_rates", RATES_SQL)
def agg18(s, d):
    return A.zone_rates(events_of(s, d))


@query("s6_zone_frames", "SELECT track_id, frame_idx, zone_id, in_apron, is_slow, gaze_hit, round(gaze_dist, 6) AS gaze_dist, grazing FROM v_tz WHERE in_apron OR gaze_hit OR near")
def s6_zone_frames(s, d):
    return A.relevant(frames_of(s, d)).select("track_id", "frame_idx", "zone_id", "in_apron", "is_slow", "gaze_hit", F.round("gaze_dist", 6).alias("gaze_dist"), "grazing")


@query("s6_events", "SELECT event_id, track_id, zone_id, round(t_start, 6) AS t_start, round(t_end, 6) AS t_end, round(stop_score, 6) AS stop_score, round(gaze_score, 6) AS gaze_score, event_type, low_confidence FROM v_event")
def s6_events(s, d):
    rounded = [F.round(c, 6).alias(c) for c in ("t_start", "t_end", "stop_score", "gaze_score")]
    return events_of(s, d).select("event_id", "track_id", "zone_id", *rounded, "event_type", "low_confidence")


@query("jn04_track_frames_by_zone", "SELECT zone_id, count(*) AS n FROM v_pos, v_zone GROUP BY 1")
def jn04(s, d):
    return A.positions(T.observations(s, d)).crossJoin(F.broadcast(T.zones(s))).groupBy("zone_id").agg(F.count("*").alias("n"))


@query("jn05_sector_hits", "SELECT track_id, frame_idx, zone_id, round(gaze_dist, 6) AS dist FROM v_tz WHERE gaze_hit")
def jn05(s, d):
    return frames_of(s, d).where("gaze_hit").select("track_id", "frame_idx", "zone_id", F.round("gaze_dist", 6).alias("dist"))


@query("jn06_apron_frames", "SELECT track_id, frame_idx, zone_id FROM v_tz WHERE in_apron")
def jn06(s, d):
    return frames_of(s, d).where("in_apron").select("track_id", "frame_idx", "zone_id")


@query("flt10_counted_events", "SELECT event_id FROM v_counted")
def flt10(s, d):
    return A.counted(events_of(s, d)).select("event_id")


@query("flt11_stop_events", "SELECT event_id FROM v_stopped")
def flt11(s, d):
    return A.stopped(events_of(s, d)).select("event_id")


@query("flt12_valid_hits", "SELECT track_id, frame_idx, zone_id FROM v_tz WHERE gaze_hit AND NOT grazing")
def flt12(s, d):
    return frames_of(s, d).where("gaze_hit AND NOT grazing").select("track_id", "frame_idx", "zone_id")


@query("flt14_relevant_rows", "SELECT zone_id, count(*) AS n FROM v_tz WHERE in_apron OR gaze_hit OR near GROUP BY 1")
def flt14(s, d):
    return A.relevant(frames_of(s, d)).groupBy("zone_id").agg(F.count("*").alias("n"))


@query("prj07_event_keys", "SELECT event_id, track_id FROM v_event")
def prj07(s, d):
    return events_of(s, d).select("event_id", "track_id")


@query("prj08_event_types", "SELECT track_id, zone_id, event_type FROM v_event")
def prj08(s, d):
    return events_of(s, d).select("track_id", "zone_id", "event_type")


@query("prj10_clipped_scores", "SELECT event_id, round(least(1::DOUBLE, gaze_score), 6) AS gaze_score FROM v_event")
def prj10(s, d):
    return events_of(s, d).select("event_id", F.round(F.when(F.col("gaze_score").isNotNull(), F.least(F.lit(1.0), "gaze_score")), 6).alias("gaze_score"))


@query("prj13_page_events", "SELECT track_id AS id, zone_id AS zone, round(t_start, 2) AS t0, round(t_end, 2) AS t1, event_type AS kind FROM v_event")
def prj13(s, d):
    return events_of(s, d).select(F.col("track_id").alias("id"), F.col("zone_id").alias("zone"), F.round("t_start", 2).alias("t0"), F.round("t_end", 2).alias("t1"), F.col("event_type").alias("kind"))


@query("agg03_zone_visitors", "SELECT zone_id, count(DISTINCT track_id) AS visitors FROM v_event GROUP BY 1")
def agg03(s, d):
    return events_of(s, d).groupBy("zone_id").agg(F.countDistinct("track_id").alias("visitors"))


@query("agg04_zone_stoppers", "SELECT zone_id, count(DISTINCT CASE WHEN event_type IN ('stop', 'stop_and_gaze') THEN track_id END) AS stoppers FROM v_event GROUP BY 1")
def agg04(s, d):
    stop = F.col("event_type").isin("stop", "stop_and_gaze")
    return events_of(s, d).groupBy("zone_id").agg(F.countDistinct(F.when(stop, F.col("track_id"))).alias("stoppers"))


@query("agg05_zone_lookers", "SELECT zone_id, count(DISTINCT track_id) AS lookers FROM v_counted GROUP BY 1")
def agg05(s, d):
    return A.counted(events_of(s, d)).groupBy("zone_id").agg(F.countDistinct("track_id").alias("lookers"))


def zone_dwell(events: DataFrame) -> DataFrame:
    """(zone_id, dwell): the median length of a zone's episodes."""
    dwell = staged(events.select("zone_id", (F.col("t_end") - F.col("t_start")).alias("dwell")))
    return Q.exact_median(dwell, "dwell", 0.1, ["zone_id"], "dwell")


@query("agg06_zone_dwell_median", "SELECT zone_id, round(median(t_end - t_start), 6) AS dwell FROM v_event GROUP BY 1")
def agg06(s, d):
    return zone_dwell(events_of(s, d)).select("zone_id", F.round("dwell", 6).alias("dwell"))


DERIVED["v_period"] = "SELECT median(step) AS period FROM (SELECT ts - lag(ts) OVER (ORDER BY ts) AS step FROM (SELECT DISTINCT ts FROM v_tz WHERE in_apron OR gaze_hit OR near))"


def frame_period(frames: DataFrame) -> DataFrame:
    """One row: the median step between distinct frame times."""
    times = A.relevant(frames).select("ts").distinct()
    return Q.exact_median(Q.steps(times, "ts", 600.0), "step", 0.001, name="period")


@query("agg08_frame_period", "SELECT round(period, 9) AS period FROM v_period")
def agg08(s, d):
    return frame_period(frames_of(s, d)).select(F.round("period", 9).alias("period"))


def attention_seconds(frames: DataFrame, events: DataFrame) -> DataFrame:
    """(zone_id, seconds): the median, over the tracks whose attention counts, of the time that they look at the zone."""
    hits = frames.where("gaze_hit AND NOT grazing").join(A.counted(events).select("track_id", "zone_id"), ["track_id", "zone_id"], "left_semi")
    per_track = hits.groupBy("zone_id", "track_id").agg(F.count("*").alias("n")).crossJoin(F.broadcast(frame_period(frames)))
    return per_track.groupBy("zone_id").agg(median(F.col("n") * F.col("period")).alias("seconds"))


@query("agg07_zone_attention_seconds", """SELECT zone_id, round(median(n * period), 6) AS seconds FROM (SELECT zone_id, track_id, count(*) AS n FROM v_tz SEMI JOIN v_counted USING (zone_id, track_id)
    WHERE gaze_hit AND NOT grazing GROUP BY ALL), v_period GROUP BY 1""")
def agg07(s, d):
    frames = trace_of(s, d)
    return attention_seconds(frames, A.episodes(frames)).select("zone_id", F.round("seconds", 6).alias("seconds"))


@query("jn12_counted_pairs", "SELECT track_id, frame_idx, zone_id FROM v_tz SEMI JOIN v_counted USING (track_id, zone_id) WHERE gaze_hit")
def jn12(s, d):
    frames = trace_of(s, d)
    pairs = A.counted(A.episodes(frames)).select("track_id", "zone_id")
    return frames.where("gaze_hit").join(pairs, ["track_id", "zone_id"], "left_semi").select("track_id", "frame_idx", "zone_id")


@query("jn13_lookers_hits", "SELECT zone_id, count(*) AS n FROM v_tz WHERE gaze_hit AND track_id IN (SELECT track_id FROM v_counted) GROUP BY 1")
def jn13(s, d):
    frames = trace_of(s, d)
    lookers = A.counted(A.episodes(frames)).select("track_id").distinct()
    return frames.where("gaze_hit").join(lookers, "track_id", "left_semi").groupBy("zone_id").agg(F.count("*").alias("n"))


@query("jn19_frame_flags", """SELECT track_id, frame_idx, coalesce(hit, false) AS hit, coalesce(apron, false) AS apron FROM v_pos LEFT JOIN
    (SELECT track_id, frame_idx, bool_or(gaze_hit) AS hit, bool_or(in_apron) AS apron FROM v_tz GROUP BY ALL) USING (track_id, frame_idx)""")
def jn19(s, d):
    obs = T.observations(s, d)
    flags = frames_of(s, d).groupBy("track_id", "frame_idx").agg(F.bool_or("gaze_hit").alias("hit"), F.bool_or("in_apron").alias("apron"))
    joined = A.positions(obs).select("track_id", "frame_idx").join(flags, ["track_id", "frame_idx"], "left")
    return joined.select("track_id", "frame_idx", F.coalesce("hit", F.lit(False)).alias("hit"), F.coalesce("apron", F.lit(False)).alias("apron"))


@query("agg13_approached_tracks", "SELECT count(DISTINCT track_id) AS n FROM v_event")
def agg13(s, d):
    return events_of(s, d).agg(F.countDistinct("track_id").alias("n"))


@query("agg14_turned_tracks", "SELECT count(DISTINCT track_id) AS n FROM v_counted")
def agg14(s, d):
    return A.counted(events_of(s, d)).agg(F.countDistinct("track_id").alias("n"))


@query("agg17_wilson", f"SELECT k, n, round({wilson_sql('k', 'n')[0]}, 9) AS low, round({wilson_sql('k', 'n')[1]}, 9) AS high FROM (SELECT frame_idx % 50 AS k, 50 + frame_idx % 100 AS n FROM v_frame)")
def agg17(s, d):
    from ..functions.stats import wilson

    rows = T.frames(s, d).select((F.col("frame_idx") % 50).alias("k"), (50 + F.col("frame_idx") % 100).alias("n"))
    low, high = wilson(F.col("k"), F.col("n"))
    return rows.select("k", "n", F.round(low, 9).alias("low"), F.round(high, 9).alias("high"))


@query("agg19_stop_threshold", "SELECT round(thr, 9) AS thr FROM v_thr")
def agg19(s, d):
    return A.stop_threshold(A.positions(T.observations(s, d))).select(F.round("thr", 9).alias("thr"))


@query("agg21_event_counts", "SELECT event_type, count(*) AS n, count(*) FILTER (low_confidence) AS low_confidence, count(*) FILTER (thin) AS thin FROM v_event GROUP BY 1")
def agg21(s, d):
    return events_of(s, d).groupBy("event_type").agg(F.count("*").alias("n"), F.count_if("low_confidence").alias("low_confidence"), F.count_if("thin").alias("thin"))


@query("agg22_reconciliation", f"""SELECT bool_and(coalesce(stop_rate BETWEEN 0 AND 1, true)) AS stop_rates, bool_and(coalesce(orientation_rate BETWEEN 0 AND 1, true)) AS orientation_rates,
    bool_and(stoppers <= visitors AND lookers <= visitors) AS counts, count(*) > 0 AS some FROM ({RATES_SQL})""")
def agg22(s, d):
    rate = lambda c: F.bool_and(F.coalesce(F.col(c).between(0, 1), F.lit(True)))
    return A.zone_rates(events_of(s, d)).agg(
        rate("stop_rate").alias("stop_rates"), rate("orientation_rate").alias("orientation_rates"),
        F.bool_and((F.col("stoppers") <= F.col("visitors")) & (F.col("lookers") <= F.col("visitors"))).alias("counts"), (F.count("*") > 0).alias("some"),
    )


@query("agg23_funnel", """SELECT count(*) AS tracked, count(*) FILTER (visited) AS visited, count(*) FILTER (visited AND turned) AS turned, count(*) FILTER (visited AND turned AND stopped) AS stopped
    FROM (SELECT DISTINCT track_id, track_id IN (SELECT track_id FROM v_event) AS visited, track_id IN (SELECT track_id FROM v_counted) AS turned,
    track_id IN (SELECT track_id FROM v_stopped) AS stopped FROM v_obs)""")
def agg23(s, d):
    obs = T.observations(s, d)
    gaze = F.col("event_type").isin("gaze", "stop_and_gaze") & ~F.col("low_confidence")
    flags = events_of(s, d).groupBy("track_id").agg(F.lit(True).alias("visited"), F.bool_or(gaze).alias("turned"), F.bool_or(F.col("event_type").isin("stop", "stop_and_gaze")).alias("stopped"))
    joined = obs.select("track_id").distinct().join(flags, "track_id", "left")
    v, t, p = F.col("visited"), F.col("turned"), F.col("stopped")
    return joined.agg(F.count("*").alias("tracked"), F.count_if(v).alias("visited"), F.count_if(v & t).alias("turned"), F.count_if(v & t & p).alias("stopped"))


@query("agg24_entry_shares", """SELECT zone_id, visitors, round(visitors / sum(visitors) OVER (), 6) AS share, round(sum(visitors) OVER () / total, 6) AS per_person
    FROM (SELECT zone_id, count(DISTINCT track_id) AS visitors FROM v_event GROUP BY 1), (SELECT count(DISTINCT track_id) AS total FROM v_event)""")
def agg24(s, d):
    events = events_of(s, d)
    by_zone = events.groupBy("zone_id").agg(F.countDistinct("track_id").alias("visitors"))
    total = events.agg(F.countDistinct("track_id").alias("total"))
    every = F.sum("visitors").over(Window.partitionBy())
    return by_zone.crossJoin(F.broadcast(total)).select("zone_id", "visitors", F.round(F.col("visitors") / every, 6).alias("share"), F.round(every / F.col("total"), 6).alias("per_person"))


def bucket(value, edges: list[float]):
    """Number of the half-open bucket [edge, next edge) that a value falls in, from 0; the last is open."""
    out = F.when(value < edges[0], -1)
    for k, edge in enumerate(edges[1:]):
        out = out.when(value < edge, k)
    return out.otherwise(len(edges) - 1)


def bucket_sql(value: str, edges: list[float]) -> str:
    return f"CASE WHEN {value} < {edges[0]} THEN -1 " + " ".join(f"WHEN {value} < {e} THEN {k}" for k, e in enumerate(edges[1:])) + f" ELSE {len(edges) - 1} END"


DWELL, ATTENTION = [0.0, 5.0, 10.0, 20.0, 40.0, 80.0], [0.0, 1.0, 2.0, 4.0, 8.0]


@query("agg25_dwell_buckets", f"SELECT zone_id, {bucket_sql('(t_end - t_start)', DWELL)} AS bucket, count(*) AS n FROM v_event GROUP BY ALL")
def agg25(s, d):
    return events_of(s, d).groupBy("zone_id", bucket(F.col("t_end") - F.col("t_start"), DWELL).alias("bucket")).agg(F.count("*").alias("n"))


@query("agg25_attention_buckets", f"""SELECT {bucket_sql('(n * period)', ATTENTION)} AS bucket, count(*) AS n FROM (SELECT zone_id, track_id, count(*) AS n FROM v_tz SEMI JOIN v_counted USING (zone_id, track_id)
    WHERE gaze_hit AND NOT grazing GROUP BY ALL), v_period GROUP BY 1""")
def agg25b(s, d):
    frames = trace_of(s, d)
    hits = frames.where("gaze_hit AND NOT grazing").join(A.counted(A.episodes(frames)).select("track_id", "zone_id"), ["track_id", "zone_id"], "left_semi")
    per_track = hits.groupBy("zone_id", "track_id").agg(F.count("*").alias("n")).crossJoin(F.broadcast(frame_period(frames)))
    return per_track.groupBy(bucket(F.col("n") * F.col("period"), ATTENTION).alias("bucket")).agg(F.count("*").alias("n"))


@query("agg32_event_quality", """SELECT round(avg(low_confidence::INTEGER), 6) AS low_share, (SELECT count(*) FROM v_tz WHERE grazing) AS grazing_frames,
    (SELECT round(avg((foot_source <> 'ankle')::INTEGER), 6) FROM v_obs) AS indirect_share FROM v_event""")
def agg32(s, d):
    frames = trace_of(s, d)
    low = A.episodes(frames).agg(F.round(F.avg(F.col("low_confidence").cast("int")), 6).alias("low_share"))
    flat = frames.agg(F.count_if("grazing").alias("grazing_frames"))
    feet = T.observations(s, d).agg(F.round(F.avg((F.col("foot_source") != "ankle").cast("int")), 6).alias("indirect_share"))
    return low.crossJoin(flat).crossJoin(feet)


@query("agg45_leader", f"""SELECT zone_id, orientation_rate, orientation_low > max_other AS separated FROM (SELECT *, (SELECT max(orientation_high) FROM ({RATES_SQL}) o WHERE o.zone_id <> r.zone_id) AS max_other
    FROM ({RATES_SQL}) r) ORDER BY orientation_rate DESC, zone_id LIMIT 1""")
def agg45(s, d):
    rates = A.zone_rates(events_of(s, d))
    first = Window.orderBy(F.desc("orientation_rate"), "zone_id")
    ranked = rates.withColumn("place", F.row_number().over(first))
    other = F.max(F.when(F.col("place") > 1, F.col("orientation_high"))).over(Window.partitionBy())
    return ranked.withColumn("other", other).where("place = 1").select("zone_id", "orientation_rate", (F.col("orientation_low") > F.col("other")).alias("separated"))


@query("set02_turned_and_stopped", "SELECT track_id FROM v_counted INTERSECT SELECT track_id FROM v_stopped")
def set02(s, d):
    events = events_of(s, d)
    return A.counted(events).select("track_id").intersect(A.stopped(events).select("track_id"))


@query("agg42_cumulative_tracks", """SELECT frame_idx, sum(new_track) OVER w::BIGINT AS tracks, sum(hits) OVER w::BIGINT AS hits, sum(new_looker) OVER w::BIGINT AS lookers FROM (
    SELECT frame_idx, count(*) FILTER (first_frame) AS new_track, sum(hits) AS hits, count(*) FILTER (first_hit) AS new_looker FROM (
    SELECT track_id, frame_idx, hits, frame_idx = min(frame_idx) OVER (PARTITION BY track_id) AS first_frame, coalesce(frame_idx = min(CASE WHEN hits > 0 THEN frame_idx END) OVER (PARTITION BY track_id), false) AS first_hit
    FROM (SELECT track_id, frame_idx, count(*) FILTER (gaze_hit AND NOT grazing) AS hits FROM v_tz GROUP BY ALL)) GROUP BY 1) WINDOW w AS (ORDER BY frame_idx ROWS UNBOUNDED PRECEDING)""".replace("sum(new_track) OVER w::BIGINT", "(sum(new_track) OVER w)::BIGINT").replace("sum(hits) OVER w::BIGINT", "(sum(hits) OVER w)::BIGINT").replace("sum(new_looker) OVER w::BIGINT", "(sum(new_looker) OVER w)::BIGINT"))
def agg42(s, d):
    """Counts so far by frame."""
    own = Window.partitionBy("track_id")
    per = frames_of(s, d).groupBy("track_id", "frame_idx").agg(F.count_if(F.expr("gaze_hit AND NOT grazing")).alias("hits"))
    first = per.withColumns({
        "first_frame": F.col("frame_idx") == F.min("frame_idx").over(own),
        "first_hit": F.coalesce(F.col("frame_idx") == F.min(F.when(F.col("hits") > 0, F.col("frame_idx"))).over(own), F.lit(False)),
    })
    by_frame = first.groupBy("frame_idx").agg(F.count_if("first_frame").alias("tracks"), F.sum("hits").alias("hits"), F.count_if("first_hit").alias("lookers"))
    return Q.running(staged(by_frame), F.floor(F.col("frame_idx") / 10_000), "frame_idx", ["tracks", "hits", "lookers"])
