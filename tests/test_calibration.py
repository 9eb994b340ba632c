"""The calibration gate's document checks, and metrics of tables without rows."""

import math

import pytest

from kerbside.operators.calibration import calibration_gate, document_checks, separation
from kerbside.plans import attention as A
from kerbside.plans import report as Rp
from kerbside.sources import tables as T

LIMITS = {
    "height_median": (1.5, 1.8), "height_iqr": 0.2, "height_span": 0.4, "speed_median": (0.8, 1.6), "least_people": 20,
    "holdout_px": 3.0, "street_width": 10.0, "street_width_tolerance": 0.2,
}
GOOD = {
    "homography": [[1.0, 0, 0], [0, 1.0, 0], [0, 0, 1.0]], "horizon": [0.0, 0.0, 1.0], "corner_residual": 0.0, "holdout_residual_px": {"horizontal": 1.0, "vertical": 2.0},
    "facade_baselines": [((0.0, 0.0), (10.0, 0.0)), ((0.0, 10.0), (10.0, 10.0))], "street_width": 10.0, "inputs_sha256": {"people": "a"},
}


def standings(document, inputs={"people": "a"}):
    return {check: state for check, _, state in document_checks(document, LIMITS, inputs)}


def test_separation_of_parallel_and_inclined_lines():
    assert separation(((0, 0), (4, 0)), ((1, 3), (9, 3))) == pytest.approx((3, 0, 0))
    mean, spread, angle = separation(((0, 0), (10, 0)), ((0, 2), (10, 12)))
    away = [2 / math.sqrt(2), 12 / math.sqrt(2), 2, 12]  # of the first line's points, then of the second's
    assert (mean, spread, angle) == pytest.approx((sum(away) / 4, 12 - 2 / math.sqrt(2), 45))


def test_document_checks_pass_fail_and_are_unmeasured():
    assert set(standings(GOOD).values()) == {"pass"}
    assert set(standings({}).values()) == {"unmeasured"}
    wrong = {
        "vp_holdout": {"holdout_residual_px": {"horizontal": 1.0, "vertical": 3.1}}, "inputs": {"inputs_sha256": {"people": "b"}},
        "street_width": {"street_width": 10.1}, "ground_plane": {"homography": [[1.0, 0, 0], [2.0, 0, 0], [0, 0, 1.0]]},
    }
    for check, change in wrong.items():
        found = standings(GOOD | change)
        assert found.pop(check) == "fail" and set(found.values()) == {"pass"}
    assert standings(GOOD | {"facade_baselines": [((0.0, 0.0), (10.0, 0.0)), ((0.0, 12.0), (10.0, 12.0))], "street_width": 12.0})["street_width"] == "fail"
    for change in ({"horizon": None}, {"corner_residual": None}, {"corner_residual": math.nan}, {"homography": [[math.inf, 0, 0], [0, 1, 0], [0, 0, 1]]}):
        assert standings(GOOD | change)["ground_plane"] == "fail"
    assert standings(GOOD, {})["inputs"] == "fail"


def test_a_stored_slope_must_be_the_recomputed_one(spark):
    people = spark.createDataFrame([(1.6 + k % 5 / 50, 4.0 + k) for k in range(40)], "height double, depth double")
    speeds = spark.createDataFrame([(1.0,), (1.2,), (None,)], "speed double")
    gate = lambda document: {r["check"]: r["standing"] for r in calibration_gate(people, speeds, document, LIMITS, {"people": "a"}).collect()}
    fine = gate(GOOD)
    assert len(fine) == 9 and set(fine.values()) == {"pass"}
    assert gate(GOOD | {"height_depth_slope": 0.3})["depth_slope"] == "fail"


def test_speeds_without_values_are_unmeasured(spark):
    people = spark.createDataFrame([(1.6 + k % 5 / 50, 4.0 + k) for k in range(40)], "height double, depth double")
    rows = calibration_gate(people, spark.createDataFrame([], "speed double"), {}, LIMITS, {}).collect()
    assert len(rows) == 9 and {r["check"] for r in rows if r["standing"] == "unmeasured"} == {"speed_median", "vp_holdout", "street_width", "inputs", "ground_plane"}


def test_zones_that_nobody_reached_are_unmeasured(spark):
    zones = T.zones(spark)
    rates = spark.createDataFrame([("M1", 3, 1)], "zone_id string, visitors long, lookers long")
    dwell = spark.createDataFrame([("M1", 4.5)], "zone_id string, dwell double")
    gaze = spark.createDataFrame([], "zone_id string, seconds double")
    rows = {(r["metric"], r["zone_id"]): r for r in Rp.zone_seconds(zones, rates, dwell, gaze).collect()}
    assert len(rows) == 8 and rows["dwell_median", "M1"]["value"] == 4.5 and rows["dwell_median", "M1"]["n"] == 3
    assert {k for k, r in rows.items() if r["measured"]} == {("dwell_median", "M1")}
    assert rows["dwell_median", "M2"]["n"] == 0 and rows["dwell_median", "M2"]["reason"]


def test_street_metrics_of_two_tracks(spark):
    """One stands for two seconds inside the street, the other walks."""
    obs = spark.createDataFrame(
        [(1, k, k / 2, 5.0, 5.0, None, None, None, None, 0.1, "ankle") for k in range(5)] + [(2, k, k / 2, 5.0 + k, 5.0, None, None, None, None, 1.0, "box_bottom") for k in range(5)],
        "track_id int, frame_idx int, ts double, x double, y double, x_ref double, y_ref double, head_yaw double, body_yaw double, speed double, foot_source string",
    )
    events = spark.createDataFrame([(1, "stop", False), (2, "gaze", False), (2, "gaze", True)], "track_id int, event_type string, low_confidence boolean")
    rows = {r["metric"]: r["value"] for r in Rp.street_metrics(obs, events, T.ROI, A.stop_threshold(A.positions(obs)), 1.5).collect()}
    assert rows == {"unique_tracks_total": 2, "indirect_foot_share": 0.5, "approached_tracks_total": 2, "turned_tracks_total": 1, "stop_seconds_total": 2.0, "stoppers_total": 1}
