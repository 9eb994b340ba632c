"""Keyed streaming state against the batch forms, across restarts, with late rows; sessions of stops over a stream."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.operators import sampling, tracking
from kerbside.streaming import keyed, presence

START = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
BOXES = "segment_id long, at timestamp, frame_idx long, x1 double, y1 double, x2 double, y2 double, conf double"


def street(frames, seed=4):
    """Rows of two recordings: people who come, go and are hidden for a while; frames without boxes have a row of nulls."""
    rng = np.random.default_rng(seed)
    rows = []
    for segment in (0, 1):
        people = [(rng.integers(0, frames), rng.integers(10, 60), rng.random(2) * 700, rng.normal(0, 3, 2)) for _ in range(frames // 6)]
        for f in range(frames):
            at, n = START + dt.timedelta(milliseconds=33 * f), len(rows)
            for first, stays, place, move in people:
                if first <= f < first + stays and rng.random() > 0.2:
                    x, y = (place + move * (f - first)).tolist()
                    rows.append((segment, at, f, x, y, x + 60, y + 120, float(rng.choice([0.9, 0.7, 0.4]))))
            if len(rows) == n:
                rows.append((segment, at, f, None, None, None, None, None))
    return rows


def closing(rows, later=600):
    """A row of another key far ahead, which carries the watermark past all others."""
    return [(9, max(r[1] for r in rows) + dt.timedelta(seconds=later), 10**6, None, None, None, None, None)]


def chunks(spark, rows, bounds):
    return [spark.createDataFrame(rows[a:b], BOXES) for a, b in zip([0, *bounds], [*bounds, len(rows)], strict=True)]


def in_order(rows):
    return sorted(tuple(r)[:3] + tuple(map(float, tuple(r)[3:])) for r in rows)


def test_tracks_equal_the_batch_across_restarts(spark, tmp_path):
    rows = sorted(street(90), key=lambda r: (r[2], r[0]))
    # Neighbouring rows change places, also over the ends of chunks.
    rng = np.random.default_rng(1)
    rows = [rows[i] for i in np.argsort(np.arange(len(rows)) + rng.integers(0, 12, len(rows)), kind="stable")]
    found = keyed.replayed(chunks(spark, rows + closing(rows), [150, 400, len(rows)]), keyed.keyed_tracks, str(tmp_path)).collect()
    df = spark.createDataFrame([(r[0] * 1000 + r[2], *r[3:]) for r in rows], "frame_idx long, x1 double, y1 double, x2 double, y2 double, conf double")
    frames = df.select("frame_idx").distinct()
    batch = tracking.track(df.where("x1 IS NOT NULL"), frames, 1000).withColumn("frame_idx", F.col("frame_idx") % 1000).collect()
    assert len(found) > 300 and in_order(found) == in_order(batch)


def test_late_frames_are_dropped_and_quiet_keys_start_afresh(spark, tmp_path):
    def walk(first, n):
        return [(0, START + dt.timedelta(milliseconds=33 * f), f, 10.0 + 2 * f, 5.0, 60.0 + 2 * f, 105.0, 0.9) for f in range(first, first + n)]

    early, again = walk(0, 20), walk(4000, 10)
    late = [(0, early[3][1], 3, 300.0, 5.0, 350.0, 105.0, 0.9)]
    parts = [spark.createDataFrame(c, BOXES) for c in (early, closing(early, 30), late, again, closing(again))]
    found = keyed.replayed(parts, lambda s: keyed.keyed_tracks(s, quiet_ms=20_000), str(tmp_path)).collect()
    assert sorted((r["track_id"], r["frame_idx"]) for r in found) == [(1, f) for f in range(20)] + [(1, f) for f in range(4000, 4010)]
    assert all(r["x1"] < 9000 and r["x1"] != 300.0 for r in found)


@pytest.mark.parametrize("size", [3, 50])
def test_samples_equal_the_batch_across_restarts(spark, tmp_path, size):
    rng = np.random.default_rng(2)
    rows = [(str(rng.choice(["a", "b"])), START + dt.timedelta(minutes=int(m)), int(k)) for k, m in enumerate(np.sort(rng.integers(0, 3 * 1440, 300)))]
    schema = "group string, at timestamp, k long"
    end = [("z", START + dt.timedelta(days=30), 0)]
    parts = [spark.createDataFrame(c, schema) for c in (rows[:70], rows[60:200], rows[200:], end)]
    found = keyed.replayed(parts, lambda s: keyed.keyed_samples(s, size, ["k"]), str(tmp_path)).collect()
    days = spark.createDataFrame(rows, schema).withColumn("starts", F.date_trunc("day", "at"))
    want = set()
    for day in [r["starts"] for r in days.select("starts").distinct().collect()]:
        own = days.where(F.col("starts") == day)
        want |= {(r["group"], day, r["k"]) for r in sampling.reservoir(own, "group", ["k"], size).collect()}
    assert len(found) == len(want) and {(r["group"], r["starts"], json.loads(r["item"])["k"]) for r in found} == want


def test_stops_are_sessions_of_slow_rows(spark, tmp_path):
    def row(track, ms, speed):
        return (track, START + dt.timedelta(milliseconds=ms), speed)

    rows = [row(1, 0, 0.1), row(1, 400, 0.2), row(1, 800, 0.9), row(1, 1200, 0.1), row(1, 3000, 0.1), row(2, 100, 0.1), row(2, 5000, 2.0)]
    parts = [spark.createDataFrame(c, "track_id int, at timestamp, speed double") for c in (rows[:3], rows[3:], [row(1, 200, 0.1), row(9, 10**6, 0.1)], [row(1, 600, 0.0), row(9, 2 * 10**6, 0.1)])]
    found = keyed.replayed(parts, lambda s: presence.stops(s, 0.5), str(tmp_path)).collect()
    at = lambda ms: (START + dt.timedelta(milliseconds=ms)).replace(tzinfo=None)
    # 0.4 s and 1.2 s lie within a gap; the row of the last part is behind the watermark.
    assert sorted(map(tuple, found)) == [(1, at(0), at(1200)), (1, at(3000), at(3000)), (2, at(100), at(100)), (9, at(10**6), at(10**6))]


def test_streams_without_a_row(spark, tmp_path):
    empty = spark.createDataFrame([], BOXES)
    assert keyed.replayed([empty], keyed.keyed_tracks, str(tmp_path / "a")).collect() == []
    assert keyed.replayed([spark.createDataFrame([], "group string, at timestamp, k long")], lambda s: keyed.keyed_samples(s, 3, ["k"]), str(tmp_path / "b")).collect() == []


def test_recordings_of_one_share_are_tracked_side_by_side(spark, tmp_path, monkeypatch):
    """Dealt to one key, recordings keep their own tracks and numbers over restarts, and no frame is a state or a step of its own."""
    rows = sorted(street(60), key=lambda r: (r[2], r[0]))
    rows += [(5, *r[1:]) for r in rows if r[0] == 0 and r[2] < 25]
    rows.sort(key=lambda r: (r[2], r[0]))
    parts = chunks(spark, rows + closing(rows), [200, len(rows)])
    found = keyed.replayed(parts, lambda s: keyed.keyed_tracks(s, shares=1), str(tmp_path)).collect()
    df = spark.createDataFrame([(r[0] * 1000 + r[2], *r[3:]) for r in rows], "frame_idx long, x1 double, y1 double, x2 double, y2 double, conf double")
    batch = tracking.track(df.where("x1 IS NOT NULL"), df.select("frame_idx").distinct(), 1000).withColumn("frame_idx", F.col("frame_idx") % 1000).collect()
    assert len({r["segment_id"] for r in found}) == 3 and in_order(found) == in_order(batch)
