"""Aggregates over tracks, frames, colours and labels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.angles import yaw_difference
from ..functions.colour import colour_class, colour_class_sql
from ..functions.stats import median
from ..operators import metrics as Me
from ..operators import sequences as Q
from ..operators import sketches as Sk
from ..sources import tables as T
from .attention import bucket, bucket_sql
from .registry import DERIVED, query
from .scalars import sql_turn

DERIVED |= {
    "v_colour": f"SELECT *, {colour_class_sql()} AS colour FROM v_attr",
    "v_step": "SELECT *, CASE WHEN lag(ts) OVER w IS NULL THEN 0 ELSE least(1::DOUBLE, greatest(0::DOUBLE, ts - lag(ts) OVER w)) END AS dt, speed IS NOT NULL AND x IS NOT NULL AND x >= 1 AND x < 34 AND y >= 0.5 AND y < 11.5 AS valid FROM v_obs WINDOW w AS (PARTITION BY track_id ORDER BY frame_idx)",
    "v_valid": "SELECT * FROM (SELECT *, count(*) FILTER (valid) OVER (PARTITION BY track_id) AS n_valid FROM v_step) WHERE valid AND n_valid >= 2",
}


def rnd(c, n=6):
    return F.round(c, n)


def coloured(s, d):
    return T.attributes(s, d).withColumn("colour", colour_class(F.col("h"), F.col("s"), F.col("v")))


@query("agg01_boxes_per_frame", "SELECT frame_idx, count(*) AS n FROM v_det GROUP BY 1")
def agg01(s, d):
    return T.detections(s, d).groupBy("frame_idx").agg(F.count("*").alias("n"))


@query("agg02_unique_tracks", "SELECT count(DISTINCT track_id) AS n FROM v_obs")
def agg02(s, d):
    return T.observations(s, d).agg(F.countDistinct("track_id").alias("n"))


@query("agg09_presence_curve", "SELECT floor(ts / 10)::BIGINT AS bin, count(*) AS frames, round(avg(n_detections), 6) AS mean FROM v_frame WHERE processed GROUP BY 1")
def agg09(s, d):
    return Me.presence_curve(T.frames(s, d), 10.0).select("bin", "frames", rnd("mean").alias("mean"))


@query("agg10_stop_dwell_grid", "SELECT floor(x)::BIGINT AS cx, floor(y)::BIGINT AS cy, round(sum(dt), 6) AS seconds, count(DISTINCT track_id) AS tracks FROM v_valid WHERE speed < 0.4 GROUP BY ALL")
def agg10(s, d):
    return Me.stop_dwell_grid(T.observations(s, d), T.ROI, 0.4, 1.0).select("cx", "cy", rnd("seconds").alias("seconds"), "tracks")


@query("agg10_stop_dwell_totals", "SELECT round(sum(dt) FILTER (speed < 0.4), 6) AS stopped, round(sum(dt), 6) AS seen FROM v_valid")
def agg10b(s, d):
    rows = Me.valid_steps(T.observations(s, d), T.ROI)
    return rows.agg(rnd(F.sum(F.when(F.col("speed") < 0.4, F.col("dt")))).alias("stopped"), rnd(F.sum("dt")).alias("seen"))


@query("agg11_stoppers", """SELECT count(DISTINCT track_id) AS n FROM (SELECT track_id, max(ts) - min(ts) AS life FROM (SELECT track_id, ts, sum(new) OVER (PARTITION BY track_id ORDER BY frame_idx ROWS UNBOUNDED PRECEDING) AS run FROM (
    SELECT track_id, frame_idx, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY track_id ORDER BY frame_idx) > 1 THEN 1 ELSE 0 END AS new FROM v_step WHERE valid AND speed < 0.8)) GROUP BY track_id, run) WHERE life >= 1.5""")
def agg11(s, d):
    return Me.stoppers(T.observations(s, d), T.ROI, 0.8, 1.5).agg(F.countDistinct("track_id").alias("n"))


LIFE = [0.0, 5.0, 10.0, 20.0, 40.0]


@query("agg12_duration_histogram", f"SELECT {bucket_sql('life', LIFE)} AS bucket, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM (SELECT max(ts) - min(ts) AS life FROM v_obs GROUP BY track_id) GROUP BY 1")
def agg12(s, d):
    lives = Me.lifetimes(T.observations(s, d)).groupBy(bucket(F.col("life"), LIFE).alias("bucket")).agg(F.count("*").alias("n"))
    return lives.select("bucket", "n", rnd(F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


@query("agg12_duration_summary", "SELECT round(median(life), 6) AS mid, round(quantile_cont(life, 0.9), 6) AS p90, round(max(life), 6) AS longest FROM (SELECT max(ts) - min(ts) AS life FROM v_obs GROUP BY track_id)")
def agg12b(s, d):
    lives = Me.lifetimes(T.observations(s, d))
    ends = Q.exact_quantiles(lives, "life", 1.0, {"mid": 0.5, "p90": 0.9})
    return lives.agg(rnd(F.max("life")).alias("longest")).crossJoin(F.broadcast(ends)).select(rnd("mid").alias("mid"), rnd("p90").alias("p90"), "longest")


DERIVED["v_spot"] = "SELECT track_id, colour, mx, my FROM v_colour JOIN (SELECT track_id, median(x) AS mx, median(y) AS my FROM v_obs GROUP BY 1) USING (track_id) WHERE mx IS NOT NULL"


@query("agg15_colour_spatial_bias", f"""SELECT colour, n_tracks, round(in_share, 6) AS in_share, round(out_share, 6) AS out_share, round(in_share / nullif(out_share, 0), 6) AS ratio FROM (
    SELECT c.colour, c.n AS n_tracks, count(*) FILTER (p.colour = c.colour AND inside) / nullif(count(*) FILTER (inside), 0)::DOUBLE AS in_share, count(*) FILTER (p.colour = c.colour AND NOT inside) / nullif(count(*) FILTER (NOT inside), 0)::DOUBLE AS out_share
    FROM (SELECT colour, median(mx) AS x0, median(my) AS y0, count(*) AS n FROM v_spot GROUP BY 1 HAVING count(*) >= 3) c, LATERAL (SELECT *, abs(mx - x0) < 3 AND abs(my - y0) < 3 AS inside FROM v_spot) p GROUP BY ALL)""")
def agg15(s, d):
    from ..operators.matching import coloured_positions

    return Me.colour_bias(coloured_positions(T.attributes(s, d), T.observations(s, d))).select("colour", "n_tracks", *(rnd(c).alias(c) for c in ("in_share", "out_share", "ratio")))


@query("agg16_indirect_share", "SELECT round(avg((foot_source <> 'ankle')::INTEGER), 6) AS share FROM v_obs")
def agg16(s, d):
    """An unknown source is an error, not a share."""
    known = F.col("foot_source").isin("ankle", "box_bottom", "box_bottom_occluded")
    indirect = F.when(known, (F.col("foot_source") != "ankle").cast("int")).otherwise(F.raise_error(F.concat(F.lit("unknown foot source "), F.coalesce("foot_source", F.lit("null")))))
    return T.observations(s, d).agg(rnd(F.avg(indirect)).alias("share"))


@query("agg20_scope", "SELECT count(*) AS total, count(*) FILTER (processed) AS processed, round(avg(processed::INTEGER), 6) AS fraction, round(max(ts), 6) AS last FROM v_frame")
def agg20(s, d):
    return T.frames(s, d).agg(F.count("*").alias("total"), F.count_if("processed").alias("processed"), rnd(F.avg(F.col("processed").cast("int"))).alias("fraction"), rnd(F.max("ts")).alias("last"))


@query("agg26_colour_counts", "SELECT colour, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share, round(median(agree), 6) AS mid FROM v_colour GROUP BY 1")
def agg26(s, d):
    counts = coloured(s, d).groupBy("colour").agg(F.count("*").alias("n"), rnd(median("agree")).alias("mid"))
    return counts.select("colour", "n", rnd(F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"), "mid")


@query("agg27_chromatic", "SELECT count(*) FILTER (s >= 90) AS n FROM v_attr")
def agg27(s, d):
    return T.attributes(s, d).agg(F.count_if(F.col("s") >= 90).alias("n"))


@query("agg28_depth_bins", """SELECT bin, n, mid, bin = min(CASE WHEN n >= 10 AND mid < 1.69 THEN bin END) OVER () AS cutoff FROM (SELECT floor((depth - lo) / 3)::BIGINT AS bin, count(*) AS n, round(median(height), 6) AS mid
    FROM v_person, (SELECT floor(min(depth)) AS lo FROM v_person) GROUP BY 1)""")
def agg28(s, d):
    return Me.depth_bins(T.people(s, d), 3.0, 10, 1.69)


@query("agg29_coverage", "SELECT round(avg((body_yaw IS NOT NULL)::INTEGER), 6) AS body, round(avg((head_yaw IS NOT NULL)::INTEGER), 6) AS head, round(avg((x_ref IS NOT NULL)::INTEGER), 6) AS ankle, round(count(DISTINCT CASE WHEN coalesce(head_yaw, body_yaw) IS NOT NULL THEN track_id END) / count(DISTINCT track_id), 6) AS tracks FROM v_obs")
def agg29(s, d):
    share = lambda c: rnd(F.avg(F.col(c).isNotNull().cast("int")))
    any_yaw = F.when(F.coalesce("head_yaw", "body_yaw").isNotNull(), F.col("track_id"))
    return T.observations(s, d).agg(share("body_yaw").alias("body"), share("head_yaw").alias("head"), share("x_ref").alias("ankle"), rnd(F.countDistinct(any_yaw) / F.countDistinct("track_id")).alias("tracks"))


@query("agg30_track_lengths", "SELECT round(median(n), 6) AS mid, round(quantile_cont(n, 0.1), 6) AS p10, round(quantile_cont(n, 0.9), 6) AS p90 FROM (SELECT count(*) AS n FROM v_obs GROUP BY track_id)")
def agg30(s, d):
    sizes = T.observations(s, d).groupBy("track_id").agg(F.count("*").alias("n"))
    ends = Q.exact_quantiles(sizes, "n", 1.0, {"mid": 0.5, "p10": 0.1, "p90": 0.9})
    return ends.select(*(rnd(c).alias(c) for c in ends.columns))


@query("agg31_yaw_iqr", "SELECT round(median(iqr), 6) AS iqr FROM (SELECT quantile_cont(body_yaw, 0.75) - quantile_cont(body_yaw, 0.25) AS iqr FROM v_obs GROUP BY track_id)")
def agg31(s, d):
    iqr = F.percentile("body_yaw", F.lit(0.75)) - F.percentile("body_yaw", F.lit(0.25))
    return Q.exact_median(T.observations(s, d).groupBy("track_id").agg(iqr.alias("iqr")), "iqr", 0.1, name="iqr").select(rnd("iqr").alias("iqr"))


@query("agg33_height_spread", "SELECT count(*) AS n, round(median(height), 6) AS mid, round(quantile_cont(height, 0.75) - quantile_cont(height, 0.25), 6) AS iqr, round(quantile_cont(height, 0.1), 6) AS p10, round(quantile_cont(height, 0.9), 6) AS p90 FROM v_person")
def agg33(s, d):
    return Me.height_spread(T.people(s, d)).select("n", *(rnd(c).alias(c) for c in ("mid", "iqr", "p10", "p90")))


@query("agg34_slope_interval", "SELECT n, round(slope, 9) AS slope, round(slope - t * se, 9) AS low, round(slope + t * se, 9) AS high, slope - t * se <= 0 AND slope + t * se >= 0 AS covers_zero FROM (SELECT n, slope, CASE WHEN n - 2 >= 30 THEN 1.96::DOUBLE ELSE 2.31::DOUBLE END AS t, sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx) AS se FROM (SELECT regr_count(height, depth)::BIGINT AS n, regr_slope(height, depth) AS slope, regr_sxx(height, depth) AS sxx, regr_syy(height, depth) AS syy, regr_sxy(height, depth) AS sxy FROM v_person))")
def agg34(s, d):
    return Me.slope_interval(T.people(s, d), "height", "depth").select("n", *(F.round(c, 9).alias(c) for c in ("slope", "low", "high")), "covers_zero")


@query("agg35_filtered_slope", "SELECT CASE WHEN count(*) >= 30 THEN round(regr_slope(height, depth), 9) END AS slope FROM v_person WHERE height > 0.8 AND height < 2.6 AND depth > 0")
def agg35(s, d):
    kept = T.people(s, d).where("height > 0.8 AND height < 2.6 AND depth > 0")
    return kept.agg(F.when(F.count("*") >= 30, F.round(F.regr_slope("height", "depth"), 9)).alias("slope"))


@query("agg36_trimmed_scale", "SELECT round(1.68::DOUBLE / median(height), 9) AS scale, count(*) AS n FROM v_person, (SELECT quantile_cont(height, 0.1) AS lo, quantile_cont(height, 0.9) AS hi FROM v_person) WHERE height BETWEEN lo AND hi")
def agg36(s, d):
    return Me.trimmed_scale(T.people(s, d), 1.68, 0.1).select(F.round("scale", 9).alias("scale"), "n")


_ERR = f"SELECT abs({sql_turn('predicted', 'label')}) AS e FROM v_label WHERE predicted IS NOT NULL"


def errors(s, d):
    return T.labelled_angles(s, d).where("predicted IS NOT NULL").select("frame_idx", F.abs(yaw_difference(F.col("predicted"), F.col("label"))).alias("e"))


@query("agg37_angle_errors", f"SELECT round(avg(e), 6) AS mae, round(median(e), 6) AS mid, round(quantile_cont(e, 0.9), 6) AS p90, round(avg((e > 90)::INTEGER), 6) AS over90, round(avg((e > 135)::INTEGER), 6) AS over135 FROM ({_ERR})")
def agg37(s, d):
    e = F.col("e")
    ends = Q.exact_quantiles(errors(s, d), "e", 0.1, {"mid": 0.5, "p90": 0.9}).select(rnd("mid").alias("mid"), rnd("p90").alias("p90"))
    means = errors(s, d).agg(rnd(F.avg(e)).alias("mae"), rnd(F.avg((e > 90).cast("int"))).alias("over90"), rnd(F.avg((e > 135).cast("int"))).alias("over135"))
    return means.crossJoin(F.broadcast(ends))


@query("agg38_bootstrap_mean")
def agg38(s, d):
    """Percentile interval of the mean error from resamples drawn by hash; the resamples differ from other engines'."""
    return Me.bootstrap_mean(errors(s, d), "frame_idx", "e", 10_000)


@query("agg39_bootstrap_slope")
def agg39(s, d):
    return Me.bootstrap_slope(T.people(s, d), "person_id", "height", "depth", 400)


@query("agg40_height_histogram", "SELECT least(55, floor((height - 1.0::DOUBLE) / 0.025::DOUBLE + 1e-9))::BIGINT AS bin, count(*) AS n FROM v_person WHERE height BETWEEN 1.0 AND 2.4 GROUP BY 1")
def agg40(s, d):
    """56 bins from 1.0 to 2.4 m; the last holds its upper edge."""
    bin_ = F.least(F.lit(55).cast("long"), F.floor((F.col("height") - 1.0) / 0.025 + 1e-9))
    return T.people(s, d).where("height BETWEEN 1.0 AND 2.4").groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"))


@query("agg41_hue_floor", "SELECT bin, n, round(n / sum(n) OVER (), 6) AS share, mid, least(abs(mid - 90), 180 - abs(mid - 90)) AS gap FROM (SELECT floor(s / 16)::BIGINT AS bin, count(*) AS n, median(h) AS mid FROM v_attr GROUP BY 1)")
def agg41(s, d):
    from ..functions.angles import hue_distance

    bins = T.attributes(s, d).groupBy(F.floor(F.col("s") / 16).alias("bin")).agg(F.count("*").alias("n"), median("h").alias("mid"))
    return bins.select("bin", "n", rnd(F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"), "mid", hue_distance(F.col("mid"), F.lit(90.0)).alias("gap"))


@query("agg44_evidence_counts", "SELECT foot_source AS claim, count(*) AS n, count(DISTINCT track_id) AS people FROM v_obs GROUP BY 1")
def agg44(s, d):
    return T.observations(s, d).groupBy(F.col("foot_source").alias("claim")).agg(F.count("*").alias("n"), F.countDistinct("track_id").alias("people"))


@query("agg46_top_cells_share", "SELECT round(sum(n) FILTER (r <= 5) / sum(n), 6) AS share FROM (SELECT n, row_number() OVER (ORDER BY n DESC, cx, cy) AS r FROM (SELECT floor(x / 3)::BIGINT AS cx, floor(y / 3)::BIGINT AS cy, count(*) AS n FROM v_obs WHERE x IS NOT NULL GROUP BY ALL))")
def agg46(s, d):
    cells = T.observations(s, d).where("x IS NOT NULL").groupBy(F.floor(F.col("x") / 3).alias("cx"), F.floor(F.col("y") / 3).alias("cy")).agg(F.count("*").alias("n"))
    top = cells.orderBy(F.desc("n"), "cx", "cy").limit(5).agg(F.sum("n").alias("top"))
    return cells.agg(F.sum("n").alias("all")).crossJoin(top).select(rnd(F.col("top") / F.col("all")).alias("share"))


@query("agg47_presence_summary", "SELECT round(avg(mean), 6) AS mean, round(max(mean), 6) AS top FROM (SELECT avg(n_detections) AS mean FROM v_frame WHERE processed GROUP BY floor(ts / 10))")
def agg47(s, d):
    return Me.presence_curve(T.frames(s, d), 10.0).agg(rnd(F.avg("mean")).alias("mean"), rnd(F.max("mean")).alias("top"))


_VOTE = f"SELECT track_id % 150 AS track_id, {colour_class_sql()} AS colour, h, s, v, agree, bg_h, bg_s FROM v_attr"


@query("agg48_majority_vote", f"""SELECT track_id, colour, n, round(n / total * agree, 6) AS conf, h, CASE WHEN total < 3 THEN 'too_few' WHEN n / total * agree < 0.1 THEN 'uncertain' ELSE 'ok' END AS status FROM (
    SELECT *, sum(n) OVER (PARTITION BY track_id) AS total, row_number() OVER (PARTITION BY track_id ORDER BY n DESC, colour) AS r FROM (SELECT track_id, colour, count(*) AS n, avg(agree) AS agree, median(h) AS h FROM ({_VOTE}) GROUP BY ALL)) WHERE r = 1""")
def agg48(s, d):
    crops = coloured(s, d).withColumn("track_id", F.col("track_id") % 150)
    return Me.majority_vote(crops).select("track_id", "colour", "n", rnd("conf").alias("conf"), "h", "status")


@query("agg49_refined_share", "SELECT round(avg((x_ref IS NOT NULL)::INTEGER), 6) AS share FROM v_obs")
def agg49(s, d):
    return T.observations(s, d).agg(rnd(F.avg(F.col("x_ref").isNotNull().cast("int"))).alias("share"))


@query("agg51_span_ratio", "SELECT round(r, 6) AS ratio, r BETWEEN 0.05 AND 20 AS plausible FROM (SELECT ((SELECT max(greatest(ax, bx)) - min(least(ax, bx)) + max(greatest(ay, b_y)) - min(least(ay, b_y)) FROM v_zone) / (max(x) - min(x) + max(y) - min(y))) AS r FROM v_obs)")
def agg51(s, d):
    c = F.col
    span = lambda a, b: F.max(F.greatest(a, b)) - F.min(F.least(a, b))
    zones = T.zones(s).agg((span("ax", "bx") + span("ay", "by")).alias("z"))
    tracks = T.observations(s, d).agg((F.max("x") - F.min("x") + F.max("y") - F.min("y")).alias("t"))
    return zones.crossJoin(tracks).select(rnd(c("z") / c("t")).alias("ratio"), (c("z") / c("t")).between(0.05, 20).alias("plausible"))


@query("agg52_top_decile_speed", "SELECT round(quantile_cont(speed, 0.9), 6) AS p90 FROM v_obs")
def agg52(s, d):
    return Q.exact_quantiles(T.observations(s, d), "speed", 0.01, {"p90": 0.9}).select(rnd("p90").alias("p90"))


@query("agg53_track_speeds", "SELECT round(median(v), 6) AS mid, count(*) AS n FROM (SELECT sqrt(regr_slope(x, ts) ^ 2 + regr_slope(y, ts) ^ 2) AS v, max(ts) - min(ts) AS life, count(x) AS n FROM v_obs GROUP BY track_id) WHERE life >= 2 AND n >= 3")
def agg53(s, d):
    speed = F.hypot(F.regr_slope("x", "ts"), F.regr_slope("y", "ts"))
    tracks = T.observations(s, d).groupBy("track_id").agg(speed.alias("v"), (F.max("ts") - F.min("ts")).alias("life"), F.count("x").alias("k"))
    kept = tracks.where("life >= 2 AND k >= 3")
    return kept.agg(F.count("*").alias("n")).crossJoin(F.broadcast(Q.exact_median(kept, "v", 0.001, name="mid"))).select(rnd("mid").alias("mid"), "n")


@query("agg54_label_counts", "SELECT count(*) AS n, count(predicted) AS predicted, round(median(model_conf), 6) AS mid FROM v_label")
def agg54(s, d):
    labels = T.labelled_angles(s, d)
    counts = labels.agg(F.count("*").alias("n"), F.count("predicted").alias("predicted"))
    return counts.crossJoin(F.broadcast(Q.exact_median(labels, "model_conf", 0.001, name="mid"))).select("n", "predicted", rnd("mid").alias("mid"))


@query("agg55_cube", "SELECT foot_source, n_kpts_valid, count(*) AS n FROM v_obs GROUP BY CUBE (foot_source, n_kpts_valid)")
def agg55(s, d):
    return T.observations(s, d).cube("foot_source", "n_kpts_valid").agg(F.count("*").alias("n"))


@query("agg55_rollup", "SELECT foot_source, n_kpts_valid, grouping(foot_source)::INTEGER + grouping(n_kpts_valid)::INTEGER AS level, count(*) AS n FROM v_obs GROUP BY ROLLUP (foot_source, n_kpts_valid)")
def agg55_rollup(s, d):
    level = F.grouping("foot_source").cast("int") + F.grouping("n_kpts_valid").cast("int")
    return T.observations(s, d).rollup("foot_source", "n_kpts_valid").agg(level.alias("level"), F.count("*").alias("n"))


@query("agg55_grouping_sets", "SELECT foot_source, n_kpts_valid, count(*) AS n, round(avg(speed), 6) AS speed FROM v_obs GROUP BY GROUPING SETS ((foot_source, n_kpts_valid), (n_kpts_valid), ())")
def agg55_sets(s, d):
    c = F.col
    sets = [[c("foot_source"), c("n_kpts_valid")], [c("n_kpts_valid")], []]
    return T.observations(s, d).groupingSets(sets, "foot_source", "n_kpts_valid").agg(F.count("*").alias("n"), rnd(F.avg("speed")).alias("speed"))


@query("agg55_sketches", """SELECT foot_source, count(*) AS n, count(DISTINCT track_id) AS tracks, true AS tracks_near, true AS as_the_whole, quantile_disc(speed, 0.5) AS mid, true AS mid_near, true AS p90_near
    FROM v_obs GROUP BY 1""")
def agg55_sketches(s, d):
    """Sketches by source and time bin, merged over the bins: equal to those of the whole, and near the exact figures."""
    obs = T.observations(s, d).withColumn("bin", F.floor(F.col("ts") / 5.0))
    bins = Sk.sketched(obs, ["foot_source", "bin"], "track_id", "speed")
    over, whole = Sk.merged(bins, ["foot_source"]), Sk.sketched(obs, ["foot_source"], "track_id", "speed")
    same = over.select("foot_source", "n", "quantiles", Sk.distinct_estimate("distinct_items").alias("about"), *(Sk.quantile_estimate("quantiles", q).alias(c) for c, q in (("s50", 0.5), ("s90", 0.9))))
    other = whole.select("foot_source", F.col("n").alias("whole_n"), F.col("quantiles").alias("whole_quantiles"), Sk.distinct_estimate("distinct_items").alias("whole_about"))
    exact = obs.groupBy("foot_source").agg(F.countDistinct("track_id").alias("tracks"), *(F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY speed)").alias(c) for c, q in (("mid", 0.5), ("p90", 0.9))))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.col(b) * Sk.ERROR + 0.0101  # noqa: E731  a step of the values: places differ by one
    spread = 4 * 1.04 / 2 ** (Sk.REGISTERS / 2)
    joined = same.join(other, "foot_source").join(exact, "foot_source")
    equal = (F.col("n") == F.col("whole_n")) & (F.col("about") == F.col("whole_about")) & (F.map_entries("quantiles") == F.map_entries("whole_quantiles"))
    return joined.select("foot_source", "n", "tracks", (F.abs(F.col("about") - F.col("tracks")) <= F.col("tracks") * spread + 1).alias("tracks_near"), equal.alias("as_the_whole"), "mid", near("s50", "mid").alias("mid_near"), near("s90", "p90").alias("p90_near"))


@query("agg56_busiest_frame", "SELECT frame_idx, count(*) AS n FROM v_det GROUP BY 1 ORDER BY n DESC, frame_idx LIMIT 1")
def agg56(s, d):
    return T.detections(s, d).groupBy("frame_idx").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "frame_idx").limit(1)


@query("agg57_canvas_bounds", "SELECT min(x) - 2 AS lo_x, max(x) + 2 AS hi_x, min(y) - 2 AS lo_y, max(y) + 2 AS hi_y FROM (SELECT x, y FROM v_obs UNION ALL SELECT ax, ay FROM v_zone UNION ALL SELECT bx, b_y FROM v_zone)")
def agg57(s, d):
    zones = T.zones(s)
    points = T.observations(s, d).select("x", "y").union(zones.select("ax", "ay")).union(zones.select("bx", "by"))
    return points.agg((F.min("x") - 2).alias("lo_x"), (F.max("x") + 2).alias("hi_x"), (F.min("y") - 2).alias("lo_y"), (F.max("y") + 2).alias("hi_y"))
