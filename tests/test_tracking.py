"""Tracking: sparse assignment, and segments in parallel against one sequential run."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbside.operators import tracking
from kerbside.sources import tables

DETECTIONS = "frame_idx long, x1 double, y1 double, x2 double, y2 double, conf double"


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 12), st.integers(1, 12), st.floats(20, 400))
def test_sparse_assignment_has_the_pairs_of_the_full_one(seed, n, m, spread):
    rng = np.random.default_rng(seed)

    def boxes(k):
        low = rng.random((k, 2)) * spread
        return np.hstack((low, low + 20 + 40 * rng.random((k, 2))))

    iou = tracking.overlaps(boxes(n), boxes(m))
    assert tracking.sparse_assign(iou) == sorted((a, b) for a, b in tracking.assign(1 - iou) if iou[a, b] > 0)


def scene(frames, seed, hidden=()):
    """People on their ways, seen with gaps, at times weakly, and not at all in ``hidden`` frames."""
    rng = np.random.default_rng(seed)
    people = [(int(rng.integers(-30, frames)), int(rng.integers(30, 250)), rng.random(2) * 900, rng.normal(0, 3, 2), 40 + rng.random(2) * 60) for _ in range(frames // 7)]
    listed = []
    for f in range(frames):
        rows = []
        for first, stays, place, move, size in people:
            if first <= f < first + stays and f not in hidden and rng.random() > 0.15:
                at = place + move * (f - first) + rng.normal(0, 1, 2)
                rows.append((*at.tolist(), *(at + size).tolist(), float(rng.choice([0.9, 0.7, 0.55, 0.3]))))
        listed.append(np.array(sorted(rows, key=lambda r: (-r[4], r)), float).reshape(-1, 5))
    return listed


def compare(detections, frames, listed, segment, warm):
    found = {}
    for r in tracking.track_across(detections, frames, segment, warm).collect():
        found.setdefault((r["segment_id"], r["track_id"]), set()).add((r["frame_idx"], r["x1"], r["y1"], r["conf"]))
    one = {}
    for f, i, t in tracking.track_boxes(listed):
        one.setdefault(t, set()).add((f, *dict(listed)[f][i][[0, 1, 4]].tolist()))
    # Tracks are numbered by their starts in either form, so they agree one by one.
    assert [found[k] for k in sorted(found)] == [one[k] for k in sorted(one)]
    return found


@pytest.mark.parametrize("warm", [0, 10, 45])
@pytest.mark.parametrize("hidden", [(), range(45, 63), [*range(95, 130), *range(150, 156)]])
def test_segments_equal_one_run(spark, warm, hidden):
    """Whatever the first guess, people hidden over the end of a segment keep their tracks, and those unseen for too long lose them."""
    listed = list(enumerate(scene(220, 7, set(hidden))))
    detections = spark.createDataFrame([(f, *map(float, r)) for f, rows in listed for r in rows], DETECTIONS)
    found = compare(detections, spark.range(220).withColumnRenamed("id", "frame_idx"), listed, 50, warm)
    spans = [{f // 50 for f, *_ in boxes} for boxes in found.values()]
    assert any(len(s) >= 3 for s in spans)


def test_segments_without_frames_hand_tracks_on(spark):
    """Frames that are not listed do not count, so a track goes on over segments of which none is."""
    at = [*range(40), *range(290, 330)]
    walk = [(f, np.array([[10 + 2 * k, 5, 70 + 2 * k, 105, 0.9]], float)) for k, f in enumerate(at)]
    detections = spark.createDataFrame([(f, *map(float, r)) for f, rows in walk for r in rows], DETECTIONS)
    found = compare(detections, detections.select("frame_idx").distinct(), walk, 20, 0)
    # Unseen frames count by their numbers, yet the box is matched before the track's age is looked at.
    assert len(found) == 1


def test_benchmark_recording_equals_one_run(spark, tmp_path):
    import os

    sf_dir = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(sf_dir):
        pytest.skip("no benchmark tables here")
    detections = tables.detections(spark, sf_dir)
    frames = tables.frames(spark, sf_dir).select("frame_idx")
    rows = frames.join(detections.select("frame_idx", *tracking.BOX), "frame_idx", "left").toPandas()
    listed = tracking.frames_in_order(rows)
    compare(detections, frames, listed, 1000, 60)
    assert detections.where(F.col("conf") >= 0.6).count() > 1000


@pytest.mark.parametrize("segment", [30, 110])
def test_lanes_are_trackers_side_by_side(segment):
    """Boxes, names and states to the last bit, from no state and from given ones, for scenes of different length and rows in any order."""
    rng = np.random.default_rng(segment)
    scenes = [scene(n, k, range(40, 75) if k % 2 else ()) for k, n in enumerate([220, 90, 1, 150])]
    want, states, rows = [], [], []
    for k, listed in enumerate(scenes):
        warm = tracking.Tracker(tracking.TrackRules())
        for f, boxes in enumerate(listed[:segment]):
            warm.step(f, boxes)
        states.append(warm.packed() if k != 1 else b"")
        one = tracking.Tracker(tracking.TrackRules(), states[-1])
        for f, boxes in enumerate(listed, segment):
            want += [(k, f, *boxes[i].tolist(), name) for i, name in one.step(f, boxes)]
            rows += [(k, f, *b) for b in boxes.tolist()] or [(k, f, *[np.nan] * 5)]
        scenes[k] = (one.packed(), one.ident.tolist())
    rows = np.array(rows)[rng.permutation(len(rows))]
    found, names, left, _ = tracking.run_lanes(rows[:, 0].astype(int), rows[:, 1].astype(int), rows[:, 2:].T, states)
    assert sorted((*map(int, rows[i, :2]), *rows[i, 2:].tolist(), int(n)) for i, n in zip(found, names, strict=True)) == sorted(want)
    assert left == scenes


def test_segments_of_many_batches_stay_whole():
    import pyarrow as pa

    ids = np.repeat([3, 4, 9, 10, 11], [5, 1, 30, 2, 7])
    batches = pa.Table.from_pydict({"segment_id": ids, "k": np.arange(45)}).to_batches(max_chunksize=4)
    tables = list(tracking._whole_segments(iter(batches), 10))
    assert [x for t in tables for x in t.column("k").to_pylist()] == list(range(45)) and len(tables) > 2
    assert sum(len(set(t.column("segment_id").to_pylist())) for t in tables) == 5
