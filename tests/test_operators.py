"""Operators on small tables made for a rule each."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.operators import estimators, gates, images, metrics, sampling, sequences, tracking
from kerbside.plans import attention
from kerbside.sources import contracts, readers
from kerbside.streaming import presence


def walkers(frame, empty=()):
    a, b = [200 + 8 * frame, 500, 280 + 8 * frame, 660, 0.9], [1400 - 8 * frame, 520, 1480 - 8 * frame, 680, 0.85]
    return np.zeros((0, 5)) if frame in empty else np.array([a, b], float)


@pytest.mark.parametrize("empty", [(), (20,)])
def test_two_walkers_keep_their_tracks(empty):
    found = tracking.track_boxes([(f, walkers(f, empty)) for f in range(40)])
    sizes = {t: sum(1 for _, _, u in found if u == t) for _, _, t in found}
    assert sorted(sizes.values()) == [40 - len(empty)] * 2
    assert not [f for f, _, _ in found if f in empty]


@pytest.mark.parametrize("empty", [(), (20, 21)])
def test_tracks_go_on_across_segments(spark, empty):
    """Two walkers over five segments come out as the sequential run has them: one track each."""
    sizes = [walkers(f % 60, empty) for f in range(100)]
    boxes = [(f, *map(float, row)) for f, rows in enumerate(sizes) for row in rows]
    detections = spark.createDataFrame(boxes, "frame_idx long, x1 double, y1 double, x2 double, y2 double, conf double")
    frames = spark.range(100).withColumnRenamed("id", "frame_idx")
    found = tracking.track_across(detections, frames, 20, 10).collect()
    mine = {}
    for r in found:
        mine.setdefault((r["segment_id"], r["track_id"]), set()).add((r["frame_idx"], r["x1"]))
    theirs = {}
    for f, i, t in tracking.track_boxes([(f, rows) for f, rows in enumerate(sizes)]):
        theirs.setdefault(t, set()).add((f, sizes[f][i][0]))
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))
    assert {k[0] for k in mine} <= {0, 3}


def test_tracking_without_boxes(spark):
    none = spark.createDataFrame([], "frame_idx long, x1 double, y1 double, x2 double, y2 double, conf double")
    assert tracking.track_across(none, spark.range(50).withColumnRenamed("id", "frame_idx"), 20, 10).collect() == []


def test_covered_boxes_hold_persons_and_heads(spark):
    schema = "frame_idx long, x1 double, y1 double, x2 double, y2 double, points array<struct<x:double,y:double,conf:double>>"
    a = spark.createDataFrame([(1, 0.0, 0.0, 40.0, 90.0, [(10.0, 10.0, 0.2), (30.0, 14.0, 0.9), (500.0, 500.0, 0.1)]), (2, 0.0, 0.0, 9.0, 9.0, [(5.0, 5.0, 0.1)])], schema)
    b = spark.createDataFrame([(1, 0.0, 0.0, 40.0, 90.0, None), (3, 1.0, 1.0, 9.0, 9.0, [(5.0, 6.0, 0.5)])], schema)
    found = sorted(map(tuple, images.covered_boxes([a, b]).collect()))
    heads = [(1, "head", -8.0, -8.0, 48.0, 32.0), (3, "head", 5 - 10.8, 6 - 10.8, 5 + 10.8, 6 + 10.8)]
    assert [r for r in found if r[1] == "head"] == heads
    assert [r[0] for r in found if r[1] == "person"] == [1, 1, 2, 3]


def test_road_masks_against_pixels(spark):
    ring, w, h = [(2, 1), (27, 3), (24, 18), (5, 16)], 30, 20
    boxes = {1: [(4.9, 5.2, 8.7, 9.9), (25.0, 15.0, 99.0, 99.0)], 2: [(-9.0, -9.0, -5.0, -5.0)]}
    rows = spark.createDataFrame([(f, *b) for f, held in boxes.items() for b in held], "frame_idx long, x1 double, y1 double, x2 double, y2 double")
    found = {r["frame_idx"]: r for r in images.road_masks(spark.range(1, 4).withColumnRenamed("id", "frame_idx"), rows, ring, w, h, 1).collect()}
    sides = list(zip(ring, ring[1:] + ring[:1]))
    for f in (1, 2, 3):
        free = lambda x, y: not any(int(b[0]) - 1 <= x <= int(b[2]) + 1 and int(b[1]) - 1 <= y <= int(b[3]) + 1 for b in boxes.get(f, ()))  # noqa: B023, E731
        road = lambda x, y: all((bx - ax) * (y - ay) - (by - ay) * (x - ax) >= 0 for (ax, ay), (bx, by) in sides)
        want = np.array([[road(x, y) and free(x, y) for x in range(w)] for y in range(h)])
        assert found[f]["pixels"] == want.sum() and found[f]["mask"] == np.packbits(want).tobytes()


def test_assignment_is_least():
    rng = np.random.default_rng(3)
    for _ in range(20):
        cost = rng.random((3, 4))
        best = min(sum(cost[i, p[i]] for i in range(3)) for p in __import__("itertools").permutations(range(4), 3))
        assert sum(cost[a, b] for a, b in tracking.assign(cost)) == pytest.approx(best)


def obs(spark, rows):
    return spark.createDataFrame(rows, "track_id int, frame_idx long, ts double, x double, y double")


@pytest.mark.parametrize("stride", [1, 3])
def test_speed_of_constant_motion(spark, stride):
    rows = [(1, i, i / 30, 1.3 * i / 30, 0.0) for i in range(0, 60, stride)]
    found = [r["speed_mps"] for r in sequences.sliding_speed(obs(spark, rows)).orderBy("frame_idx").collect()]
    assert sum(v is None for v in found) == 8
    assert [v for v in found if v is not None] == pytest.approx([1.3] * (len(rows) - 8), abs=1e-6)


def test_speed_needs_all_positions(spark):
    rows = [(1, i, i / 30, None if i == 10 else 1.3 * i / 30, 0.0) for i in range(20)]
    found = {r["frame_idx"]: r["speed_mps"] for r in sequences.sliding_speed(obs(spark, rows)).collect()}
    assert all(found[i] is None for i in range(6, 15))


def test_sessions_split_above_the_gap(spark):
    rows = spark.createDataFrame([(1, 0, 0.0), (1, 1, 1.0), (1, 2, 2.001)], "track_id int, frame_idx long, ts double")
    assert sorted(r["n"] for r in sequences.gap_sessions(rows, 1.0).collect()) == [1, 2]


def test_stops_of_the_least_length_count(spark):
    rows = [(t, i, i * step, 5.0, 5.0, 0.1) for t, step in ((1, 0.7), (2, 0.75)) for i in range(3)]
    df = spark.createDataFrame(rows, "track_id int, frame_idx long, ts double, x double, y double, speed double")
    found = metrics.stoppers(df, [(0, 0), (10, 0), (10, 10), (0, 10)], 0.4, 1.5).collect()
    assert [r["track_id"] for r in found] == [2]


def test_stop_grid_ignores_single_rows_and_holds_gaps(spark):
    rows = [(1, 0, 0.0, 5.0, 5.0, 0.1), (2, 0, 0.0, 5.0, 5.0, 0.1), (2, 1, 60.0, 5.0, 5.0, 0.1)]
    df = spark.createDataFrame(rows, "track_id int, frame_idx long, ts double, x double, y double, speed double")
    (cell,) = metrics.stop_dwell_grid(df, [(0, 0), (10, 0), (10, 10), (0, 10)], 0.4, 1.0).collect()
    assert (cell["cx"], cell["cy"], cell["seconds"], cell["tracks"]) == (5, 5, 1.0, 1)


def test_vote_ties_go_by_name(spark):
    rows = [(1, c, 0.9, 100.0) for c in ("blue", "black", "blue", "black")]
    (won,) = metrics.majority_vote(spark.createDataFrame(rows, "track_id int, colour string, agree double, h double")).collect()
    assert won["colour"] == "black" and won["status"] == "ok"


def test_stratified_quota_and_shortfall(spark):
    rows = [("a", i, (i + 1) / 100) for i in range(90)] + [("b", i, (i + 1) / 10) for i in range(5)]
    df = spark.createDataFrame(rows, "claim string, k long, score double")
    picked = sampling.stratified(df, "claim", ["k"], "score", 12, 3)
    counts = {(r["claim"], r["stratum"]): r["count"] for r in picked.groupBy("claim", "stratum").count().collect()}
    assert [counts["a", s] for s in range(3)] == [4, 4, 4] and sum(n for (c, _), n in counts.items() if c == "b") == 5
    again = sampling.stratified(df.repartition(7), "claim", ["k"], "score", 12, 3)
    assert sorted(map(tuple, picked.collect())) == sorted(map(tuple, again.collect()))


def test_episodes(spark):
    rules = attention.Rules()
    rows = [(1, i, 0.5 * i, 5.0, 8.0, None, None, 90.0, None, 1.0) for i in range(6)] + [(2, i, 0.5 * i, 5.0, 8.0, None, None, 270.0, None, 1.0) for i in range(6)]
    df = spark.createDataFrame(rows, "track_id int, frame_idx long, ts double, x double, y double, x_ref double, y_ref double, body_yaw double, head_yaw double, speed double")
    zones = spark.createDataFrame([("Z", 2.0, 12.0, 8.0, 12.0, 2.0, 10.0, 8.0, 12.0)], "zone_id string, ax double, ay double, bx double, by double, apron_x0 double, apron_y0 double, apron_x1 double, apron_y1 double")
    found = {r["track_id"]: r for r in attention.episodes(attention.zone_frames(df, zones, rules), rules).collect()}
    assert found[1]["event_type"] == "gaze" and found[1]["gaze_score"] == 1.0 and not found[1]["low_confidence"]
    assert found[2]["event_type"] == "pass_by" and found[2]["gaze_score"] == 0.0


def test_contract_refuses_drift_and_nulls(spark):
    columns = [contracts.Column("a", "int64"), contracts.Column("b", "string", True)]
    fine = spark.createDataFrame([(1, None)], "a long, b string")
    assert contracts.conform(fine, columns).collect()[0]["a"] == 1
    for bad in (fine.drop("b"), fine.withColumn("c", F.lit(1))):
        with pytest.raises(contracts.ContractError):
            contracts.conform(bad, columns)
    with pytest.raises(Exception, match="null in a"):
        contracts.conform(spark.createDataFrame([(None, "x")], "a long, b string"), columns).collect()


def test_skeletons_are_refused(spark, tmp_path):
    path = f"{tmp_path}/events"
    contracts.write_skeleton(spark, contracts.EVENTS, path, "s6")
    with pytest.raises(contracts.ContractError):
        contracts.read_contract(spark, contracts.EVENTS, path)


def test_manifest_marks_killed_runs():
    m = contracts.Manifest()
    m.start("s1", "cfg", "t0")
    m.start("s1", "cfg", "t1")
    m.finish("s1", "t2", "failed")
    assert m.sections["s1"]["status"] == "failed" and m.sections["s1"]["past"][0]["status"] == "aborted"


def test_zones_reject_skeletons(spark):
    docs = spark.createDataFrame([(json.dumps({"status": "skeleton", "features": []}),)], "value string")
    with pytest.raises(Exception, match="skeleton"):
        readers.zones_from_geojson(spark, docs).collect()


def test_blur_changes_only_the_top():
    image = np.random.default_rng(0).integers(0, 255, (60, 20, 3), dtype=np.uint8)
    out = images.blurred_top(image)
    assert (out[18:] == image[18:]).all() and (out[:18] != image[:18]).any()


def test_gate_standing(spark):
    assert gates.passed(["pass"]) and not gates.passed(["unmeasured"]) and gates.passed(["unmeasured"], True)


def test_horizon_is_found_among_outliers(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 1900, 400)
    y = 200 + 0.05 * x + rng.normal(0, 3, 400)
    y[:150] = rng.uniform(0, 1000, 150)
    points = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y, strict=True)], "px double, py double")
    row = estimators.ransac_line(points).first()
    assert row["accepted"] and -row["a"] / row["b"] == pytest.approx(0.05, abs=0.01)


def test_horizon_returns_its_residual(spark):
    points = spark.createDataFrame([(float(x), 100.0 + (2.0 if x % 2 else -2.0)) for x in range(0, 1000, 5)] + [(float(k), 900.0) for k in range(20)], "px double, py double")
    row = estimators.ransac_line(points).first()
    assert row["accepted"] and row["residual"] == pytest.approx(2.0, abs=0.1)


def test_registered_iteration_counts(monkeypatch):
    import inspect

    from kerbside.queries import QUERIES, aggregates

    times = {}
    for name in ("bootstrap_mean", "bootstrap_slope"):
        monkeypatch.setattr(aggregates.Me, name, lambda *args, name=name: times.setdefault(name, args[-1]))
    monkeypatch.setattr(aggregates, "errors", lambda s, d: None)
    monkeypatch.setattr(aggregates.T, "people", lambda s, d: None)
    QUERIES["agg38_bootstrap_mean"](None, "")
    QUERIES["agg39_bootstrap_slope"](None, "")
    assert times == {"bootstrap_mean": 10_000, "bootstrap_slope": 400}
    assert inspect.signature(estimators.ransac_line).parameters["tries"].default == 400


def test_burst_tracks_cover_all_frames(spark, monkeypatch):
    from kerbside.queries import QUERIES, processes

    frames = spark.range(90).select(F.col("id").alias("frame_idx"))
    boxes = [(k, *map(float, row)) for k in range(90) for row in walkers(k % 30)]
    monkeypatch.setattr(processes.T, "detections", lambda s, d: spark.createDataFrame(boxes, "frame_idx long, x1 double, y1 double, x2 double, y2 double, conf double"))
    monkeypatch.setattr(processes.T, "frames", lambda s, d: frames)
    found = QUERIES["trk02_burst_tracks"](spark, "").groupBy("segment_id").agg(F.countDistinct("track_id").alias("n")).collect()
    assert {r["segment_id"]: r["n"] for r in found} == {0: 2, 1: 2, 2: 2}


def test_focal_length_rejects_swapped_points():
    assert estimators.focal_length((0.0, 1.0, -240.0), (960.0, 4540.0), (960.0, 540.0)) == pytest.approx((300 * 4000) ** 0.5)
    with pytest.raises(ValueError, match="same side"):
        estimators.focal_length((0.0, 1.0, -840.0), (960.0, 4540.0), (960.0, 540.0))


def test_streaming_presence(spark, tmp_path):
    spark.createDataFrame([(f"2024-01-01 00:00:{s:02d}", s) for s in range(20)], "t string, n_detections int").select(F.to_timestamp("t").alias("at"), "n_detections").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("at timestamp, n_detections int").parquet(f"{tmp_path}/in")
    q = presence.presence(stream).writeStream.format("memory").queryName("presence_test").outputMode("complete").option("checkpointLocation", f"{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["n"] for r in spark.table("presence_test").collect()) == [10, 10]


def test_as_of_carries_over_empty_spans(spark):
    from kerbside.operators.matching import as_of

    left = spark.createDataFrame([(t,) for t in (0.5, 1.0, 25.0, 99.0)], "ts double")
    right = spark.createDataFrame([(1.0, 1), (24.0, 2)], "ts double, v int")
    assert sorted(tuple(r) for r in as_of(left, right, "v", 10.0).collect()) == [(1.0, 1), (25.0, 2), (99.0, 2)]
