"""The published metrics as a whole, and the gate of the calibration beneath them."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..operators import gates as Ga
from ..operators.calibration import calibration_gate
from ..plans import attention as A
from ..plans import report as Rp
from ..sources import contracts as Co
from ..sources import manifest as Mf
from ..sources import tables as T
from ..sources.staging import scratch, staged
from .attention import R, RATES_SQL, attention_seconds, trace_of, zone_dwell
from .registry import DERIVED, query

_X0, _Y0, _X1, _Y1 = T.ROI[0] + T.ROI[2]
_IN = f"x >= {_X0} AND x < {_X1} AND y >= {_Y0} AND y < {_Y1}"
DERIVED |= {
    "v_rates": RATES_SQL,
    "v_flow": f"""SELECT *, count(*) FILTER (valid) OVER (PARTITION BY track_id) AS n_valid FROM (SELECT *, speed IS NOT NULL AND x IS NOT NULL AND {_IN} AS valid,
        least(1::DOUBLE, greatest(0::DOUBLE, coalesce(ts - lag(ts) OVER (PARTITION BY track_id ORDER BY frame_idx), 0))) AS dt FROM v_obs, v_thr)""",
    "v_still": f"""SELECT track_id, max(ts) - min(ts) AS life FROM (SELECT track_id, ts, sum(new) OVER (PARTITION BY track_id ORDER BY ts, frame_idx ROWS UNBOUNDED PRECEDING) AS run FROM (
        SELECT track_id, frame_idx, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY track_id ORDER BY ts, frame_idx) > 1 THEN 1 ELSE 0 END AS new FROM v_flow WHERE x IS NOT NULL AND {_IN} AND speed < thr)) GROUP BY track_id, run""",
    "v_dwell": "SELECT zone_id, median(t_end - t_start) AS dwell FROM v_event GROUP BY 1",
    "v_looked": """SELECT zone_id, median(n * period) AS seconds FROM (SELECT zone_id, track_id, count(*) AS n FROM v_tz SEMI JOIN v_counted USING (zone_id, track_id)
        WHERE gaze_hit AND NOT grazing GROUP BY ALL), v_period GROUP BY 1""",
    "v_known": "SELECT zone_id, coalesce(visitors, 0) AS visitors, coalesce(lookers, 0) AS lookers FROM v_zone LEFT JOIN v_rates USING (zone_id)",
}
_STREET = """SELECT 'unique_tracks_total' AS metric, NULL::VARCHAR AS zone_id, count(DISTINCT track_id)::DOUBLE AS value, count(DISTINCT track_id)::BIGINT AS n FROM v_obs
    UNION ALL SELECT 'indirect_foot_share', NULL, avg((foot_source <> 'ankle')::INTEGER), count(*) FROM v_obs
    UNION ALL SELECT 'approached_tracks_total', NULL, count(DISTINCT track_id), (SELECT count(DISTINCT track_id) FROM v_obs) FROM v_event
    UNION ALL SELECT 'turned_tracks_total', NULL, count(DISTINCT track_id), (SELECT count(DISTINCT track_id) FROM v_obs) FROM v_counted
    UNION ALL SELECT 'stop_seconds_total', NULL, coalesce(sum(dt) FILTER (speed < thr), 0), (SELECT count(*) FROM v_obs) FROM v_flow WHERE valid AND n_valid >= 2"""


@query("s8_metrics", f"""SELECT metric, zone_id, round(value, 6) AS value, n, value IS NOT NULL AS measured FROM ({_STREET}
    UNION ALL SELECT 'stoppers_total', NULL, count(DISTINCT track_id), count(DISTINCT track_id) FROM v_still WHERE life >= {R.stop_seconds}
    UNION ALL SELECT 'visitors', zone_id, visitors, visitors FROM v_rates
    UNION ALL SELECT 'stop_rate', zone_id, stop_rate, stoppers FROM v_rates
    UNION ALL SELECT 'orientation_rate', zone_id, orientation_rate, lookers FROM v_rates
    UNION ALL SELECT 'gaze_seconds_median', zone_id, seconds, lookers FROM v_known LEFT JOIN v_looked USING (zone_id)
    UNION ALL SELECT 'dwell_median', zone_id, dwell, visitors FROM v_known LEFT JOIN v_dwell USING (zone_id))""")
def s8_metrics(s, d):
    """All published metrics: six of the street, and five of each zone. The trace and the episodes are computed once."""
    return _published(s, d)[0].select("metric", "zone_id", F.round("value", 6).alias("value"), "n", "measured")


#: Limits of this camera's gate, and its calibration's document.
LIMITS = {
    "height_median": (1.55, 1.75), "height_iqr": 0.35, "height_span": 0.6, "speed_median": (0.5, 1.8), "least_people": 100,
    "holdout_px": 3.0, "street_width": 11.0, "street_width_tolerance": 0.5,
}
DOCUMENT = {
    "homography": [list(T.HOMOGRAPHY[k : k + 3]) for k in (0, 3, 6)], "horizon": list(T.HOMOGRAPHY[6:]), "corner_residual": 2e-4, "holdout_residual_px": {"horizontal": 1.25, "vertical": 3.5},
    "facade_baselines": [((1.0, 12.0), (34.0, 12.0)), ((1.0, 0.5), (34.0, 0.5))], "street_width": 11.5,
}


DERIVED["v_calibration"] = """SELECT 'height_median' AS "check", round(median(height), 6) AS value, CASE WHEN median(height) BETWEEN 1.55 AND 1.75 THEN 'pass' ELSE 'fail' END AS standing FROM v_person
    UNION ALL SELECT 'height_spread', round(iqr, 6), CASE WHEN iqr <= 0.35 AND span <= 0.6 THEN 'pass' ELSE 'fail' END FROM (
        SELECT quantile_cont(height, 0.75) - quantile_cont(height, 0.25) AS iqr, quantile_cont(height, 0.9) - quantile_cont(height, 0.1) AS span FROM v_person)
    UNION ALL SELECT 'sample_size', count(height), CASE WHEN count(height) >= 100 THEN 'pass' ELSE 'fail' END FROM v_person
    UNION ALL SELECT 'speed_median', round(median(speed), 6), CASE WHEN median(speed) BETWEEN 0.5 AND 1.8 THEN 'pass' ELSE 'fail' END FROM v_obs
    UNION ALL SELECT 'depth_slope', round(slope, 6), CASE WHEN abs(slope) <= t * se THEN 'pass' ELSE 'fail' END FROM (
        SELECT slope, CASE WHEN n >= 32 THEN 1.96::DOUBLE ELSE 2.31::DOUBLE END AS t, sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx) AS se FROM (
        SELECT regr_count(height, depth) AS n, regr_slope(height, depth) AS slope, regr_sxx(height, depth) AS sxx, regr_syy(height, depth) AS syy, regr_sxy(height, depth) AS sxy FROM v_person))
    UNION ALL SELECT * FROM (VALUES ('vp_holdout', 3.5::DOUBLE, 'fail'), ('street_width', 11.5::DOUBLE, 'pass'), ('inputs', 0::DOUBLE, 'pass'), ('ground_plane', 0::DOUBLE, 'pass'))"""


@query("dq06_calibration_gate", DERIVED["v_calibration"])
def dq06_gate(s, d):
    """The nine checks; the last four are of a document whose held-out residual is too large."""
    people = T.people(s, d)
    now = {"people": Co.digest(people)}
    return calibration_gate(people, T.observations(s, d), DOCUMENT | {"inputs_sha256": now}, LIMITS, now).withColumn("value", F.round("value", 6))


@query("agg40_hue_histogram", "SELECT least(35, floor(h / 5))::BIGINT AS bin, count(*) AS n FROM v_attr WHERE h BETWEEN 0 AND 180 GROUP BY 1")
def agg40_hue(s, d):
    """36 bins from 0 to 180; the last holds its upper edge."""
    bin_ = F.least(F.lit(35).cast("long"), F.floor(F.col("h") / 5))
    return T.attributes(s, d).where("h BETWEEN 0 AND 180").groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"))


def _functions() -> dict:
    street = ("unique_tracks_total", "indirect_foot_share", "approached_tracks_total", "turned_tracks_total", "stop_seconds_total", "stoppers_total")
    rates = dict.fromkeys(("visitors", "stop_rate", "orientation_rate"), A.zone_rates)
    return dict.fromkeys(street, Rp.street_metrics) | rates | {"gaze_seconds_median": attention_seconds, "dwell_median": zone_dwell}


CAVEATS = {"unique_tracks_total": ["tracks are not people: they break and merge"], "visitors": ["tracks are not people: they break and merge"]}
_FUNCTIONS = ", ".join(f"('{m}', '{f.__name__}', {len(CAVEATS.get(m, []))})" for m, f in _functions().items())
_STAGE = "CASE WHEN m.metric IN ('unique_tracks_total', 'indirect_foot_share', 'stop_seconds_total', 'stoppers_total') THEN 's4_track' ELSE 's6_attn' END"


def _published(s, d):
    """Metric rows of the whole run, in full, and its episodes."""
    frames = trace_of(s, d)
    events = staged(A.episodes(frames))
    obs = T.observations(s, d)
    rates = staged(A.zone_rates(events))
    rows = Rp.street_metrics(obs, events, T.ROI, staged(A.stop_threshold(A.positions(obs))), R.stop_seconds)
    for part in (Rp.zone_metrics(rates), Rp.zone_seconds(T.zones(s), rates, zone_dwell(events), attention_seconds(frames, events))):
        rows = rows.unionByName(part)
    return rows, events


@query("s8_envelopes", f"""SELECT m.metric, m.zone_id, round(value, 6) AS value, round(low, 6) AS ci95_low, round(high, 6) AS ci95_high, CASE WHEN low IS NOT NULL THEN 'wilson_by_track' ELSE 'none' END AS ci_method,
    'stub_affine' AS calibration_status, {_STAGE} AS source_stage, function, caveats::INTEGER AS caveats,
    CASE WHEN value IS NULL THEN 'nothing to measure' END AS reason, (SELECT round(avg(low_confidence::INTEGER), 6) FROM v_event) AS low_confidence,
    (SELECT round(avg((coalesce(head_yaw, body_yaw) IS NOT NULL)::INTEGER), 6) FROM v_obs) AS with_angle, (SELECT round(avg((x IS NOT NULL)::INTEGER), 6) FROM v_obs) AS with_position
    FROM (SELECT metric, zone_id, value, NULL::DOUBLE AS low, NULL::DOUBLE AS high FROM ({_STREET}
    UNION ALL SELECT 'stoppers_total', NULL, count(DISTINCT track_id), count(DISTINCT track_id) FROM v_still WHERE life >= {R.stop_seconds})
    UNION ALL SELECT 'visitors', zone_id, visitors, NULL, NULL FROM v_rates
    UNION ALL SELECT 'stop_rate', zone_id, stop_rate, stop_low, stop_high FROM v_rates
    UNION ALL SELECT 'orientation_rate', zone_id, orientation_rate, orientation_low, orientation_high FROM v_rates
    UNION ALL SELECT 'gaze_seconds_median', zone_id, seconds, NULL, NULL FROM v_known LEFT JOIN v_looked USING (zone_id)
    UNION ALL SELECT 'dwell_median', zone_id, dwell, NULL, NULL FROM v_known LEFT JOIN v_dwell USING (zone_id)) m
    JOIN (VALUES {_FUNCTIONS}) f(metric, function, caveats) ON f.metric = m.metric""")
def s8_envelopes(s, d):
    """Every published metric with all that says how it came about."""
    rows, events = _published(s, d)
    obs = T.observations(s, d)
    quality = events.agg(F.avg(F.col("low_confidence").cast("int")).alias("low_confidence"))
    known = lambda c: F.avg(c.isNotNull().cast("int"))
    coverage = obs.agg(known(F.coalesce("head_yaw", "body_yaw")).alias("with_angle"), known(F.col("x")).alias("with_position"))
    full = Rp.provenance(rows, _functions(), "stub_affine", quality, coverage, CAVEATS)
    return full.select(
        "metric", "zone_id", *(F.round(c, 6).alias(c) for c in ("value", "ci95_low", "ci95_high")), "ci_method", "calibration_status", "source_stage", F.col("compute_ref.function").alias("function"),
        F.size("caveats").alias("caveats"), "reason", F.round(F.col("quality")["low_confidence"], 6).alias("low_confidence"),
        *(F.round(F.col("coverage")[c], 6).alias(c) for c in ("with_angle", "with_position")),
    )


@query("snk_run_manifest", """SELECT 's3_detect' AS stage, 'ok' AS status, (SELECT count(*) FROM v_frame) AS rows, 1::BIGINT AS aborted UNION ALL SELECT 's4_track', 'ok', (SELECT count(*) FROM v_obs), 1
    UNION ALL SELECT 's7_attrs', 'failed', (SELECT count(*) FROM v_attr), 1""")
def run_manifest(s, d):
    """A run's manifest, written by three stages over their tables and read again: one was killed and started anew, one failed."""
    path = scratch(s, f"run-{uuid.uuid4().hex}/manifest.json")
    for stage, table, error in (("s3_detect", T.frames, None), ("s4_track", T.observations, None), ("s7_attrs", T.attributes, "no colours")):
        for killed in (True, False) if stage == "s4_track" else (False,):
            run = Mf.StageRun(s, path, stage, {"stage": stage}, lambda: "2024-01-01T00:00:00Z")
            run.start()
            if not killed:
                run.note("rows", table(s, d).count())
                run.finish("failed" if error else "ok", error)
    aborted = len(Mf.read_manifest(s, path)["aborted_runs"])
    return Mf.stage_table(s, path).select("stage", "status", F.col("notes")["rows"].cast("long").alias("rows"), F.lit(aborted).cast("long").alias("aborted"))



@query("dq12_stage_gates", f"""SELECT stage, count(*) AS checks, count(*) FILTER (standing = 'fail') AS failed, count(*) FILTER (standing = 'unmeasured') AS unmeasured, bool_and(standing = 'pass') AS passed,
    bool_and(standing <> 'fail') AS passed_allowing FROM (
    SELECT 's0_ingest' AS stage, CASE WHEN (SELECT count(*) FILTER ((n_detections IS NULL) <> (NOT processed)) FROM v_frame) = 0 THEN 'pass' ELSE 'fail' END AS standing
    UNION ALL SELECT 's0_ingest', CASE WHEN (SELECT count(*) FILTER ((skip_reason IS NOT NULL) <> (NOT processed)) FROM v_frame) = 0 THEN 'pass' ELSE 'fail' END
    UNION ALL SELECT 's1_calib', standing FROM v_calibration
    UNION ALL SELECT 's2_zones', CASE WHEN share >= 0.3 THEN 'pass' ELSE 'fail' END FROM (SELECT count(DISTINCT CASE WHEN in_apron OR near THEN struct_pack(t := track_id, f := frame_idx) END) / count(DISTINCT struct_pack(t := track_id, f := frame_idx)) AS share FROM v_tz)
    UNION ALL SELECT 's3_detect', 'unmeasured'
    UNION ALL SELECT 's4_track', 'unmeasured'
    UNION ALL SELECT 's4_track', CASE WHEN (SELECT count(*) FROM (SELECT track_id, frame_idx FROM v_obs GROUP BY ALL HAVING count(*) > 1)) = 0 THEN 'pass' ELSE 'fail' END
    UNION ALL SELECT 's5_orient', CASE WHEN (SELECT count(*) FROM v_obs WHERE body_yaw IS NOT NULL AND NOT (body_yaw >= 0 AND body_yaw < 360)) = 0 THEN 'pass' ELSE 'fail' END
    UNION ALL SELECT 's5_orient', CASE WHEN (SELECT count(*) FROM v_obs WHERE NOT n_kpts_valid BETWEEN 0 AND 17) = 0 THEN 'pass' ELSE 'fail' END
    UNION ALL SELECT 's5_orient', CASE WHEN (SELECT count(*) FROM v_obs WHERE yaw_conf IS NOT NULL AND body_yaw IS NULL AND head_yaw IS NULL) = 0 THEN 'pass' ELSE 'fail' END
    UNION ALL SELECT 's6_attn', CASE WHEN (SELECT count(*) FROM v_event WHERE gaze_score NOT BETWEEN 0 AND 1 OR t_end < t_start) = 0 THEN 'pass' ELSE 'fail' END
    UNION ALL SELECT 's7_attrs', CASE WHEN (SELECT count(*) FROM v_attr WHERE NOT (h >= 0 AND h < 180 AND s BETWEEN 0 AND 255 AND v BETWEEN 0 AND 255 AND agree BETWEEN 0 AND 1)) = 0 THEN 'pass' ELSE 'fail' END
    UNION ALL SELECT 's8_aggregate', CASE WHEN (SELECT count(*) FROM v_rates WHERE stop_rate IS NULL OR orientation_rate IS NULL) = 0 THEN 'pass' ELSE 'fail' END
    UNION ALL SELECT 's9_report', CASE WHEN (SELECT count(*) FROM (SELECT zone_id FROM v_rates) SEMI JOIN v_zone USING (zone_id)) = (SELECT count(*) FROM v_rates) THEN 'pass' ELSE 'fail' END
    ) GROUP BY stage""")
def dq12_stages(s, d):
    """The gates of all ten stages in one table; whether each opens, and whether it would if unmeasured checks were let pass.

    Detection and tracking accuracy need frames labelled by hand, which these tables lack, and are unmeasured.
    """
    c = F.col
    obs, frames = T.observations(s, d), trace_of(s, d)
    events = staged(A.episodes(frames))
    rates = staged(A.zone_rates(events))
    none = lambda df: df.agg(F.count("*").alias("n")).select(F.when(c("n") == 0, "pass").otherwise("fail").alias("standing"))
    broken = lambda df: df.select(F.when(c("violations") == 0, "pass").otherwise("fail").alias("standing"))
    unmeasured = s.range(1).select(F.lit("unmeasured").alias("standing"))
    index = Ga.gate(T.frames(s, d), {"counts": c("n_detections").isNull() == ~c("processed"), "reasons": c("skip_reason").isNotNull() == ~c("processed")})
    angles = Ga.gate(obs, {
        "yaw_range": c("body_yaw").isNull() | (c("body_yaw") >= 0) & (c("body_yaw") < 360), "keypoints": c("n_kpts_valid").between(0, 17),
        "confidence": c("yaw_conf").isNull() | c("body_yaw").isNotNull() | c("head_yaw").isNotNull(),
    })
    zoned = frames.agg(F.countDistinct("track_id", "frame_idx").alias("held")).crossJoin(A.positions(obs).agg(F.countDistinct("track_id", "frame_idx").alias("n")))
    report = Ga.drift(rates.select(F.format_string("| %s | visitors | %d |", "zone_id", "visitors").alias("value")), rates.select("zone_id", c("visitors").alias("computed")), r"\| (\w+) \| visitors \| (\d+) \|")
    parts = {
        "s0_ingest": [broken(index)],
        "s1_calib": [dq06_gate(s, d).select("standing")],
        "s2_zones": [zoned.select(Ga.standing(c("held") / c("n"), 0.3, 1.0).alias("standing"))],
        "s3_detect": [unmeasured],
        "s4_track": [unmeasured, none(obs.groupBy("track_id", "frame_idx").count().where("count > 1"))],
        "s5_orient": [broken(angles)],
        "s6_attn": [none(events.where("gaze_score NOT BETWEEN 0 AND 1 OR t_end < t_start"))],
        "s7_attrs": [broken(Ga.gate(T.attributes(s, d), {"ranges": (c("h") >= 0) & (c("h") < 180) & c("s").between(0, 255) & c("v").between(0, 255) & c("agree").between(0, 1)}))],
        "s8_aggregate": [none(rates.where("stop_rate IS NULL OR orientation_rate IS NULL"))],
        "s9_report": [none(report.where("NOT agrees"))],
    }
    rows = reduce(lambda a, b: a.unionByName(b), (df.select(F.lit(stage).alias("stage"), "standing") for stage, dfs in parts.items() for df in dfs))
    return rows.groupBy("stage").agg(
        F.count("*").alias("checks"), F.count_if(c("standing") == "fail").alias("failed"), F.count_if(c("standing") == "unmeasured").alias("unmeasured"),
        F.bool_and(c("standing") == "pass").alias("passed"), F.bool_and(c("standing") != "fail").alias("passed_allowing"),
    )
