"""Filters and joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.colour import colour_class_sql
from ..operators import gates as Ga
from ..operators import matching as M
from ..operators.grid import points_in_zones
from ..sources import tables as T
from ..sources.layout import bucketed, by_track_session
from .registry import DERIVED, query

#: Detections with a number within their frame; equal boxes of a frame count once.
DERIVED["v_box"] = """SELECT *, (row_number() OVER (PARTITION BY frame_idx ORDER BY x1, y1, x2, y2, conf, cls) - 1)::INTEGER AS det FROM (SELECT DISTINCT * FROM v_det)"""


def boxes(s, d):
    order = Window.partitionBy("frame_idx").orderBy("x1", "y1", "x2", "y2", "conf", "cls")
    return T.detections(s, d).distinct().withColumn("det", F.row_number().over(order) - 1)


@query("flt01_tall_boxes", "SELECT count(*) FILTER (y2 - y1 >= 70) AS kept, count(*) FILTER (y2 - y1 < 70) AS dropped FROM v_det")
def flt01(s, d):
    tall = F.col("y2") - F.col("y1") >= 70
    return T.detections(s, d).agg(F.count_if(tall).alias("kept"), F.count_if(~tall).alias("dropped"))


@query("flt02_frame_stride", "SELECT frame_idx, CASE WHEN frame_idx % 3 <> 0 THEN 'sampled_out' END AS skip FROM v_frame")
def flt02(s, d):
    return T.frames(s, d).select("frame_idx", F.when(F.pmod("frame_idx", F.lit(3)) != 0, "sampled_out").alias("skip"))


@query("flt03_processed", "SELECT frame_idx, n_detections FROM v_frame WHERE processed")
def flt03(s, d):
    """The denominator of all shares; an error if nothing was processed."""
    return Ga.not_empty(T.frames(s, d).where("processed"), "processed frames").select("frame_idx", "n_detections")


_EDGES = "x1 > 10 AND y1 > 10 AND x2 < 1790 AND y2 < 1070"


@query("flt04_geometry_grade", f"SELECT frame_idx, x1, y1 FROM v_det WHERE conf > 0.5 AND y2 - y1 > 90 AND {_EDGES}")
def flt04(s, d):
    return T.detections(s, d).where(f"conf > 0.5 AND y2 - y1 > 90 AND {_EDGES}").select("frame_idx", "x1", "y1")


DERIVED["v_pair"] = """SELECT a.frame_idx, a.det AS a, b.det AS b, CASE WHEN u > 0 THEN i / u ELSE 0 END AS iou FROM (SELECT *, (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - i AS u FROM (
    SELECT a, b, greatest(0::DOUBLE, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0::DOUBLE, least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS i FROM v_box a JOIN v_box b ON a.frame_idx = b.frame_idx AND a.det < b.det))"""


def pairs(s, d):
    return M.frame_pairs(boxes(s, d))


@query("jn07_frame_pairs", "SELECT frame_idx, a, b, round(iou, 9) AS iou FROM v_pair")
def jn07(s, d):
    return pairs(s, d).select("frame_idx", "a", "b", F.round("iou", 9).alias("iou"))


DERIVED["v_crowd"] = "SELECT v_box.*, coalesce(m, 0) AS max_iou FROM v_box LEFT JOIN (SELECT frame_idx, det, max(iou) AS m FROM (SELECT frame_idx, a AS det, iou FROM v_pair UNION ALL SELECT frame_idx, b, iou FROM v_pair) GROUP BY ALL) USING (frame_idx, det)"


@query("flt05_first_failing_reason", f"SELECT CASE WHEN conf <= 0.3 THEN 'low_conf' WHEN NOT ({_EDGES}) THEN 'touches_edge' WHEN max_iou >= 0.2 THEN 'crowded' WHEN y2 - y1 <= 90 THEN 'too_small' ELSE 'kept' END AS reason, count(*) AS n FROM v_crowd GROUP BY 1")
def flt05(s, d):
    reason = F.when(F.col("conf") <= 0.3, "low_conf").when(~F.expr(_EDGES), "touches_edge").when(F.col("max_iou") >= 0.2, "crowded").when(F.col("y2") - F.col("y1") <= 90, "too_small").otherwise("kept")
    return M.crowding(boxes(s, d)).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("flt06_uncrowded", "SELECT frame_idx, det FROM v_crowd WHERE max_iou < 0.2")
def flt06(s, d):
    return M.crowding(boxes(s, d)).where("max_iou < 0.2").select("frame_idx", "det")


@query("flt07_positioned", "SELECT track_id, frame_idx FROM v_obs WHERE x IS NOT NULL AND y IS NOT NULL")
def flt07(s, d):
    return T.observations(s, d).where("x IS NOT NULL AND y IS NOT NULL").select("track_id", "frame_idx")


@query("flt08_in_roi", "SELECT track_id, frame_idx FROM v_obs WHERE x >= 1 AND x < 34 AND y >= 0.5 AND y < 11.5")
def flt08(s, d):
    return T.observations(s, d).where(G.point_in_polygon(F.col("x"), F.col("y"), T.ROI)).select("track_id", "frame_idx")


@query("flt13_plausible_heights", "SELECT person_id FROM v_person WHERE height > 0.8 AND height < 2.6 AND depth > 0 AND isfinite(height)")
def flt13(s, d):
    return T.people(s, d).where("height > 0.8 AND height < 2.6 AND depth > 0 AND NOT isnan(height)").select("person_id")


@query("flt15_supported_bins", "SELECT bin, n FROM (SELECT floor(depth / 3)::BIGINT AS bin, count(*) AS n FROM v_person GROUP BY 1) WHERE n >= 10")
def flt15(s, d):
    return T.people(s, d).groupBy(F.floor(F.col("depth") / 3).alias("bin")).agg(F.count("*").alias("n")).where("n >= 10")


_FILES = "SELECT o_orderkey AS id, o_orderdate AS t, 'live_' || strftime(o_orderdate, '%Y%m%d') || '_0900JST.ts' AS file FROM orders"


def files(s, d):
    date = F.date_format("o_orderdate", "yyyyMMdd")
    return T.read(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("live_"), date, F.lit("_0900JST.ts")).alias("file"))


@query("src09_file_times", f"SELECT DISTINCT file, strptime(regexp_extract(file, 'live_(\\d{{8}}_\\d{{4}})JST', 1), '%Y%m%d_%H%M')::TIMESTAMP AS start FROM ({_FILES})")
def src09(s, d):
    start = F.to_timestamp_ntz(F.regexp_extract("file", r"live_(\d{8}_\d{4})JST", 1), F.lit("yyyyMMdd_HHmm"))
    return files(s, d).select("file").distinct().select("file", start.alias("start"))


@query("flt17_window_files", f"SELECT DISTINCT file FROM ({_FILES}) WHERE file BETWEEN 'live_19960101' AND 'live_19960401'")
def flt17(s, d):
    return files(s, d).where(F.col("file").between("live_19960101", "live_19960401")).select("file").distinct()


@query("jn01_tracks_orient", "SELECT o.track_id, o.frame_idx, n.yaw FROM v_obs o LEFT JOIN (SELECT track_id, frame_idx, head_yaw AS yaw FROM v_obs WHERE head_yaw IS NOT NULL) n USING (track_id, frame_idx)")
def jn01(s, d):
    obs = T.observations(s, d)
    orient = obs.where("head_yaw IS NOT NULL").select("track_id", "frame_idx", F.col("head_yaw").alias("yaw"))
    return obs.select("track_id", "frame_idx").join(orient, ["track_id", "frame_idx"], "left")


@query("jn01_copartitioned", "SELECT o.track_id, o.frame_idx, n.yaw FROM v_obs o LEFT JOIN (SELECT track_id, frame_idx, head_yaw AS yaw FROM v_obs WHERE head_yaw IS NOT NULL) n USING (track_id, frame_idx)")
def jn01_layout(s, d):
    """The same over tables in buckets by track, whose join shuffles nothing."""
    return tracks_with_angles(*tables_by_track(s, d))


def tables_by_track(s, d, buckets: int = 8):
    obs = T.observations(s, d)
    orient = obs.where("head_yaw IS NOT NULL").select("track_id", "frame_idx", F.col("head_yaw").alias("yaw"))
    reader = by_track_session(s)
    return tuple(bucketed(df, "track_id", ["frame_idx"], buckets, reader=reader) for df in (obs, orient))


def tracks_with_angles(obs, orient):
    return obs.select("track_id", "frame_idx").join(orient.hint("merge"), ["track_id", "frame_idx"], "left")


def many_zones(s, d):
    """A quadrilateral a part, some metres wide, anywhere on the street; those of every fifth part bend inwards."""
    k = F.col("p_partkey")
    x, y, w = (k * 131 % 3400) / 100.0, (k * 71 % 1150) / 100.0, (k % 7 + 2) / 10.0
    corner = lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))
    bend = F.when(k % 5 == 0, 0.375).otherwise(1.25)
    ring = F.array(corner(x, y), corner(x + w, y + 0.125), corner(x + w * bend, y + w * bend), corner(x + 0.0625, y + w))
    return T.read(s, d, "part").select(k.alias("zone_id"), ring.alias("ring"))


_RING = "[(x0, y0), (x0 + w, y0 + 0.125::DOUBLE), (x0 + w * bend, y0 + w * bend), (x0 + 0.0625::DOUBLE, y0 + w)]"


DERIVED |= {
    "v_many": f"""SELECT zone_id, list_transform({_RING}, lambda p: struct_pack(x := p[1], y := p[2])) AS ring FROM (SELECT p_partkey AS zone_id, (p_partkey * 131 % 3400) / 100::DOUBLE AS x0,
        (p_partkey * 71 % 1150) / 100::DOUBLE AS y0, (p_partkey % 7 + 2) / 10::DOUBLE AS w, CASE WHEN p_partkey % 5 = 0 THEN 0.375::DOUBLE ELSE 1.25::DOUBLE END AS bend FROM part)""",
    "v_many_side": "SELECT zone_id, ring[k].x AS ax, ring[k].y AS ay, ring[k % 4 + 1].x AS bx, ring[k % 4 + 1].y AS b_y FROM v_many, range(1, 5) r(k)",
}


@query("jn06_many_zones", """SELECT track_id, frame_idx, zone_id FROM (SELECT track_id, frame_idx, zone_id, count(*) AS n FROM v_obs JOIN v_many_side
    ON (ay > y) <> (b_y > y) AND x < (bx - ax) * (y - ay) / (b_y - ay) + ax GROUP BY ALL) WHERE n % 2 = 1""")
def jn06_many(s, d):
    """Positions inside any of thousands of zones, through a grid of cells."""
    points = T.observations(s, d).select("track_id", "frame_idx", "x", "y")
    return points_in_zones(points, many_zones(s, d), 0.5).select("track_id", "frame_idx", "zone_id")


@query("jn02_frame_times", "SELECT d.frame_idx, f.ts, count(*) AS n FROM v_det d JOIN v_frame f USING (frame_idx) GROUP BY ALL")
def jn02(s, d):
    times = T.frames(s, d).select("frame_idx", "ts")
    return T.detections(s, d).join(times, "frame_idx").groupBy("frame_idx", "ts").agg(F.count("*").alias("n"))


@query("jn03_frames_with_boxes", "SELECT f.frame_idx, count(b.det) AS n FROM v_frame f LEFT JOIN v_box b USING (frame_idx) WHERE f.processed GROUP BY 1")
def jn03(s, d):
    listed = T.frames(s, d).where("processed").select("frame_idx").join(boxes(s, d).select("frame_idx", "det"), "frame_idx", "left")
    return listed.groupBy("frame_idx").agg(F.count("det").alias("n"))


@query("jn08_separated_pairs", "SELECT a.frame_idx, a.det AS a, b.det AS b FROM v_box a JOIN v_box b ON a.frame_idx = b.frame_idx AND a.det < b.det WHERE abs(a.y2 - b.y2) >= 80")
def jn08(s, d):
    """All pairs; a cap for estimation is drawn by hash where they are used, so that it favours no frames."""
    return M.separated_pairs(boxes(s, d), 80.0).select("frame_idx", "a", "b")


_PROBE = "SELECT frame_idx, frame_idx % 1800 + 30 AS fx, frame_idx * 7 % 900 + 100 AS fy FROM v_frame"
DERIVED["v_nearest"] = f"SELECT frame_idx, det, dist, h FROM (SELECT p.frame_idx, b.det, round(sqrt(((b.x1 + b.x2) / 2 - fx) ^ 2 + (b.y2 - fy) ^ 2), 9) AS dist, b.y2 - b.y1 AS h, row_number() OVER (PARTITION BY p.frame_idx ORDER BY round(sqrt(((b.x1 + b.x2) / 2 - fx) ^ 2 + (b.y2 - fy) ^ 2), 9), b.det) AS r FROM ({_PROBE}) p JOIN v_box b USING (frame_idx)) WHERE r = 1"


def probes(s, d):
    f = F.col("frame_idx")
    return T.frames(s, d).select("frame_idx", (f % 1800 + 30).alias("fx"), (f * 7 % 900 + 100).alias("fy"))


@query("jn09_nearest_box", "SELECT frame_idx, CASE WHEN dist <= greatest(4, 4 * h) THEN det END AS det, round(dist, 6) AS dist FROM v_nearest")
def jn09(s, d):
    """The tolerance is tested on the nearest box only; a wide one here, as boxes and probes are random."""
    return M.nearest_box(probes(s, d), boxes(s, d), 4.0, 4.0).select("frame_idx", "det", F.round("dist", 6).alias("dist"))


@query("jn22_unmatched", "SELECT frame_idx FROM v_frame ANTI JOIN (SELECT * FROM v_nearest WHERE dist <= greatest(4, 4 * h)) USING (frame_idx)")
def jn22(s, d):
    matched = M.nearest_box(probes(s, d), boxes(s, d), 4.0, 4.0).where("det IS NOT NULL")
    return T.frames(s, d).select("frame_idx").join(matched, "frame_idx", "left_anti")


@query("jn10_band_match", "SELECT p.frame_idx, p.probe, min(b.det)::INTEGER AS det FROM (SELECT frame_idx, det AS probe, (x1 + x2) / 2 + 0.5 AS fx, y2 - 0.5 AS fy FROM v_box) p JOIN v_box b USING (frame_idx) WHERE abs((b.x1 + b.x2) / 2 - fx) < 1 AND abs(b.y2 - fy) < 1 GROUP BY ALL")
def jn10(s, d):
    own = boxes(s, d)
    p = own.select("frame_idx", F.col("det").alias("probe"), ((F.col("x1") + F.col("x2")) / 2 + 0.5).alias("fx"), (F.col("y2") - 0.5).alias("fy"))
    band = (F.abs((F.col("x1") + F.col("x2")) / 2 - F.col("fx")) < 1) & (F.abs(F.col("y2") - F.col("fy")) < 1)
    return p.join(own, "frame_idx").where(band).groupBy("frame_idx", "probe").agg(F.min("det").alias("det"))


@query("jn11_greedy_poses")
def jn11(s, d):
    """Order-dependent assignment within a frame: each track in turn takes its nearest pose if nobody has and it is near."""
    own = boxes(s, d)
    tracks = own.where("det % 2 = 0").select("frame_idx", F.col("det").alias("track"), ((F.col("x1") + F.col("x2")) / 2).alias("x"), F.col("y2").alias("y"))
    poses = own.where("det % 2 = 1").select("frame_idx", F.col("det").alias("pose"), ((F.col("x1") + F.col("x2")) / 2).alias("x"), F.col("y2").alias("y"))
    return M.greedy_poses(tracks, poses, 600.0)


@query("jn14_point_lookup", "SELECT a.track_id, a.frame_idx, b.speed FROM v_tz a JOIN v_obs b USING (track_id, frame_idx) WHERE a.gaze_hit")
def jn14(s, d):
    from .attention import frames_of

    hits = frames_of(s, d).where("gaze_hit").select("track_id", "frame_idx")
    return hits.join(T.observations(s, d).select("track_id", "frame_idx", "speed"), ["track_id", "frame_idx"])


@query("jn15_attributes_position", f"SELECT track_id, colour, round(mx, 6) AS mx, round(my, 6) AS my FROM (SELECT track_id, {colour_class_sql()} AS colour FROM v_attr) JOIN (SELECT track_id, median(x) AS mx, median(y) AS my FROM v_obs GROUP BY 1) USING (track_id) WHERE mx IS NOT NULL")
def jn15(s, d):
    return M.coloured_positions(T.attributes(s, d), T.observations(s, d)).select("track_id", "colour", F.round("mx", 6).alias("mx"), F.round("my", 6).alias("my"))


@query("jn16_attributes_middle", "SELECT track_id, frame_idx, h FROM v_attr JOIN (SELECT track_id, frame_idx, row_number() OVER (PARTITION BY track_id ORDER BY frame_idx) AS r, count(*) OVER (PARTITION BY track_id) AS n FROM v_obs) USING (track_id) WHERE r = n // 2 + 1")
def jn16(s, d):
    w = Window.partitionBy("track_id")
    mid = T.observations(s, d).select("track_id", "frame_idx", F.row_number().over(w.orderBy("frame_idx")).alias("r"), F.count("*").over(w).alias("n"))
    return mid.where(F.col("r") == F.floor(F.col("n") / 2) + 1).join(T.attributes(s, d), "track_id").select("track_id", "frame_idx", "h")


@query("jn17_labels_live", "SELECT count(*) AS n, count(*) FILTER (o.body_yaw IS NULL) AS missing FROM v_label l LEFT JOIN v_obs o USING (frame_idx)")
def jn17(s, d):
    live = T.observations(s, d).select("frame_idx", "body_yaw")
    return T.labelled_angles(s, d).join(live, "frame_idx", "left").agg(F.count("*").alias("n"), F.count_if(F.col("body_yaw").isNull()).alias("missing"))


@query("jn18_other_stages", "SELECT foot_source, count(*) AS n FROM v_obs WHERE foot_source <> 'ankle' GROUP BY 1")
def jn18(s, d):
    return T.observations(s, d).where("foot_source <> 'ankle'").groupBy("foot_source").agg(F.count("*").alias("n"))


@query("jn20_as_of", "SELECT a.track_id, a.frame_idx, b.frame_idx AS before FROM v_obs a ASOF JOIN (SELECT frame_idx, ts FROM v_frame WHERE processed) b ON a.ts >= b.ts")
def jn20(s, d):
    """The last processed frame at or before each observation."""
    right = T.frames(s, d).where("processed").select("ts", F.col("frame_idx").alias("before"))
    return M.as_of(T.observations(s, d).select("track_id", "frame_idx", "ts"), right, "before", 10.0).select("track_id", "frame_idx", "before")


@query("jn21_full_outer", "SELECT coalesce(a.track_id, b.track_id) AS track_id, a.h IS NOT NULL AS attributed, b.n AS frames FROM v_attr a FULL JOIN (SELECT track_id, count(*) AS n FROM v_obs GROUP BY 1) b ON a.track_id = b.track_id")
def jn21(s, d):
    counts = T.observations(s, d).groupBy("track_id").agg(F.count("*").alias("frames"))
    return T.attributes(s, d).select("track_id", "h").join(counts, "track_id", "full").select("track_id", F.col("h").isNotNull().alias("attributed"), "frames")
