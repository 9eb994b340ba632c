"""Scalar functions on hand-derived cases."""

import math

import pytest
from pyspark.sql import functions as F

from kerbside.functions import angles, colour, geometry, polygons, stats


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("a", "b", "want"), [(359, 1, -2), (1, 359, 2), (0, 180, 180), (10, 350, 20)])
def test_yaw_difference(spark, a, b, want):
    assert one(spark, angles.yaw_difference(F.lit(float(a)), F.lit(float(b)))) == want


@pytest.mark.parametrize(("values", "want"), [([359, 1, 3], 1), ([0, 180], 0), ([], None)])
def test_circular_median(spark, values, want):
    assert one(spark, angles.circular_median(F.lit([float(v) for v in values]) if values else F.array().cast("array<double>"))) == want


@pytest.mark.parametrize(("x", "y", "inside"), [(5, 5, True), (15, 5, False), (0, 5, True), (10, 5, False), (5, 0, True), (5, 10, False)])
def test_point_in_polygon_is_half_open(spark, x, y, inside):
    square = [(0, 0), (10, 0), (10, 10), (0, 10)]
    assert one(spark, geometry.point_in_polygon(F.lit(float(x)), F.lit(float(y)), square)) is inside
    ring = F.array(*(F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in square))
    assert one(spark, geometry.point_in_ring(F.lit(float(x)), F.lit(float(y)), ring)) is inside


def lits(*values):
    return [F.lit(float(v)) for v in values]


def test_ray_segment(spark):
    assert one(spark, geometry.ray_segment(*lits(0, 0, 0, 5, -1, 5, 1), 8.0)) == pytest.approx(5)
    assert one(spark, geometry.ray_segment(*lits(0, 0, 0, 5, -1, 5, 1), 4.0)) is None
    assert one(spark, geometry.ray_segment(*lits(0, 0, 0, 1, 1, 5, 1), 8.0)) is None


def test_rays_through_the_ends_of_a_level_segment_are_hits(spark, tmp_path):
    """Rows of larger tables whose ray meets a facade in its end, which a place as a share of the facade lost to rounding."""
    from kerbside.queries import QUERIES

    hits = [(6890, 498875, "M4", 6.010408), (7750, 564175, "M1", 4.596194), (10665, 764100, "M3", 4.242641), (11310, 745575, "M4", 7.424621)]
    rows = [(e, u, "click") for u, e, _, _ in hits]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").withColumn("ts", F.lit("2024-01-01").cast("timestamp")).write.parquet(f"{tmp_path}/events.parquet")
    found = {tuple(r) for r in QUERIES["fn11_ray_hits"](spark, str(tmp_path)).select("track_id", "frame_idx", "zone_id", "dist").collect()}
    assert found >= set(hits)
    assert one(spark, geometry.ray_level(*lits(0, 0, 90, -1, 1, 5), 8.0)) == pytest.approx(5)
    assert one(spark, geometry.ray_level(*lits(0, 0, 90, -1, 1, 5), 4.0)) is None
    assert one(spark, geometry.ray_level(*lits(0, 0, 0, -1, 1, 5), 8.0)) is None


def test_sector_falls_back_to_an_end(spark):
    hit = one(spark, geometry.sector_hit(F.lit(0.0), F.lit(0.0), F.lit(0.0), 21.2, *lits(5, 0.5, 5, 1.0), 8.0))
    assert hit["rank"] == 3 and hit["dist"] == pytest.approx(math.hypot(5, 0.5)) and (hit["hx"], hit["hy"]) == (5.0, 0.5)


def test_sector_prefers_the_nearest_ray(spark):
    hit = one(spark, geometry.sector_hit(F.lit(0.0), F.lit(0.0), F.lit(0.0), 21.2, *lits(5, -3, 5, 3), 8.0))
    assert hit["rank"] == 1 and hit["dist"] == pytest.approx(5)


def test_grazing_and_distance(spark):
    assert one(spark, geometry.grazing_angle(*lits(5, 0, 0, 0, 5, -1, 5, 1))) == pytest.approx(0, abs=1e-6)
    assert one(spark, geometry.segment_distance(*lits(0, 3, 1, 0, 5, 0))) == pytest.approx(math.hypot(1, 3))


def test_pair_yaw(spark):
    identity = (1, 0, 0, 0, 1, 0, 0, 0, 1)
    assert one(spark, geometry.pair_yaw(identity, *lits(0, 0, 0, -1))) == pytest.approx(0)
    assert one(spark, geometry.pair_yaw(identity, *lits(0, 0, 0, 0))) is None


@pytest.mark.parametrize(("k", "n", "low", "high"), [(339, 2588, 0.1185, 0.1445), (0, 2551, 0.0, 0.0015)])
def test_wilson(spark, k, n, low, high):
    a, b = stats.wilson(F.lit(k), F.lit(n))
    assert one(spark, a) == pytest.approx(low, abs=5e-5) and one(spark, b) == pytest.approx(high, abs=5e-5)


def test_wilson_of_nothing(spark):
    assert one(spark, stats.wilson(F.lit(0), F.lit(0))[0]) is None


@pytest.mark.parametrize(("hsv", "want"), [((5, 200, 200), "red"), ((175, 200, 200), "red"), ((100, 200, 200), "blue"), ((0, 0, 55), "black"), ((0, 45, 185), "white"), ((0, 45, 184), "grey"), ((10, 200, 200), "orange")])
def test_colour_class(spark, hsv, want):
    assert one(spark, colour.colour_class(*lits(*hsv))) == want


def test_bgr_to_hsv(spark):
    h, s, v = colour.bgr_to_hsv(F.lit(0), F.lit(255), F.lit(0))
    assert (one(spark, h), one(spark, s), one(spark, v)) == (60, 255, 255)


def test_polygons():
    a, b = [(0, 0), (2, 0), (2, 2), (0, 2)], [(1, 0), (3, 0), (3, 2), (1, 2)]
    assert polygons.overlap_share(a, b) == pytest.approx(0.5)
    assert polygons.overlap_share(a, [(2, 0), (4, 0), (4, 2), (2, 2)]) == 0
    assert len(polygons.hull([*a, (1, 1)])) == 4
