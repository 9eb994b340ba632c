"""Sketches that merge, tables in buckets, and the grid of zones: equal to the whole, without a shuffle, and without all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.operators import grid, sequences, sketches
from kerbside.queries import joins
from kerbside.sources import layout


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def measured(spark):
    rng = np.random.default_rng(3)
    rows = [(str(rng.choice(["a", "b"])), int(t), int(rng.integers(0, 4000)), float(v)) for t, v in zip(rng.integers(0, 50, 6000), np.concatenate((rng.lognormal(0, 3, 3000), -rng.lognormal(0, 1, 1500), np.zeros(1500))), strict=True)]
    rows += [("a", 3, None, None), ("c", 1, None, None), (None, 1, 7, 2.5), ("d", 1, 5, 1e-320), ("d", 2, 5, 1e300)]
    return rows, spark.createDataFrame(rows, "g string, t int, item int, v double").repartition(5)


def test_merged_sketches_are_those_of_the_whole(measured):
    rows, df = measured
    bins = sketches.sketched(df.withColumn("bin", F.floor(F.col("t") / 7)), ["g", "bin"], "item", "v")
    ends = lambda s: {r["g"]: (r["n"], r["about"], r["quantiles"], r["q"]) for r in s.select("g", "n", "quantiles", sketches.distinct_estimate("distinct_items").alias("about"), F.array(*(sketches.quantile_estimate("quantiles", q) for q in (0, 0.1, 0.5, 0.99, 1))).alias("q")).collect()}
    found = ends(sketches.merged(bins, ["g"]))
    assert found == ends(sketches.sketched(df, ["g"], "item", "v"))
    for g, (n, about, _, estimates) in found.items():
        own = sorted(v for h, _, _, v in rows if h == g and v is not None)
        items = {i for h, _, i, _ in rows if h == g and i is not None}
        assert n == sum(h == g for h, *_ in rows) and abs(about - len(items)) <= 4 * 1.04 / 64 * len(items) + 1
        for q, estimate in zip((0, 0.1, 0.5, 0.99, 1), estimates, strict=True):
            if not own:
                assert estimate is None
                continue
            exact = own[math.floor(q * (len(own) - 1))]
            assert estimate == pytest.approx(exact, rel=sketches.ERROR * 1.0001, abs=2e-300)
    total = sketches.merged(bins, []).first()
    assert total["n"] == len(rows) and sum(total["quantiles"].values()) == sum(v is not None for *_, v in rows)


def test_tables_by_track_join_without_a_shuffle(spark):
    draw = random.Random(2)
    rows = [(draw.randrange(20), f, f / 30, float(f), float(draw.randrange(9))) for f in range(600)]
    obs = spark.createDataFrame(rows, "track_id int, frame_idx long, ts double, x double, y double")
    orient = obs.where("frame_idx % 3 = 0").select("track_id", "frame_idx", F.col("y").alias("yaw"))
    reader = layout.by_track_session(spark)
    a, b = (layout.bucketed(df, "track_id", ["frame_idx"], 4, reader=reader) for df in (obs, orient))
    joined = joins.tracks_with_angles(a, b)
    speeds = sequences.sliding_speed(a)
    for df in (joined, speeds, a.groupBy("track_id").count()):
        df.collect()
        assert "Exchange" not in plan(df)
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, joins.tracks_with_angles(obs, orient).collect()), key=str)
    assert sorted(map(tuple, speeds.collect()), key=str) == sorted(map(tuple, sequences.sliding_speed(obs).collect()), key=str)


def inside(x, y, ring):
    hits = 0
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            hits += 1
    return hits % 2 == 1


@pytest.mark.parametrize("cell", [0.25, 1.0, 50.0])
def test_grid_equals_brute_force(spark, cell):
    rng = np.random.default_rng(7)
    rings = {}
    for k in range(60):
        middle, n = rng.random(2) * 20 - 5, int(rng.integers(3, 9))
        turns = np.sort(rng.random(n)) * 2 * np.pi
        rings[k] = [tuple(map(float, middle + rng.uniform(0.2, 3) * np.array([np.cos(t), np.sin(t)]))) for t in turns]
    rings[90] = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    rings[91] = [(-2.0, -2.0), (-2.0, 9.0), (9.0, 9.0), (9.0, 8.5), (-1.5, 8.5), (-1.5, -2.0)]
    spots = [tuple(map(float, p)) for p in rng.random((400, 2)) * 24 - 7] + [(float(x), float(y)) for x in range(-2, 10) for y in range(-2, 10)]
    zones = spark.createDataFrame([(k, r) for k, r in rings.items()], "zone_id long, ring array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)] + [(9999, None, 1.0)], "spot long, x double, y double")
    df = grid.points_in_zones(points, zones, cell)
    found = {(r["spot"], r["zone_id"]) for r in df.collect()}
    assert found == {(i, k) for i, p in enumerate(spots) for k, ring in rings.items() if inside(*p, ring)} and len(found) == df.count()
    assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)
    if cell == 0.25:
        whole = grid.zone_cells(zones, cell).where("sides IS NULL").count()
        assert whole > 300
