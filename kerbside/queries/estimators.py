"""Estimators, with SQL where they are aggregates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..functions.geometry import homography
from ..operators import estimators as E
from ..operators import matching as M
from ..operators import segments as Sg
from ..operators.groundplane import traced_plane
from ..operators.sequences import exact_median
from ..sources import tables as T
from ..sources.staging import staged
from .joins import boxes
from .registry import query


def horizon_points(s, d):
    return E.crossing_points(M.separated_pairs(boxes(s, d), 80.0))


_CROSS = """SELECT frame_idx, round(ax + t * (bx - ax), 6) AS px, round(a_foot + t * (b_foot - a_foot), 6) AS py FROM (SELECT *, (a_head - a_foot) * (bx - ax) / CASE WHEN abs((bx - ax) * (b_head - a_head) - (b_foot - a_foot) * (bx - ax)) > 1e-9 THEN (bx - ax) * (b_head - a_head) - (b_foot - a_foot) * (bx - ax) END * -1 AS t FROM (
    SELECT a.frame_idx, (a.x1 + a.x2) / 2 AS ax, a.y2 AS a_foot, a.y1 AS a_head, (b.x1 + b.x2) / 2 AS bx, b.y2 AS b_foot, b.y1 AS b_head FROM v_box a JOIN v_box b ON a.frame_idx = b.frame_idx AND a.det < b.det WHERE abs(a.y2 - b.y2) >= 80)) WHERE t IS NOT NULL AND abs(ax + t * (bx - ax)) < 1e5 AND abs(a_foot + t * (b_foot - a_foot)) < 1e5"""


@query("est01_horizon_points", _CROSS)
def est01p(s, d):
    return horizon_points(s, d).select("frame_idx", F.round("px", 6).alias("px"), F.round("py", 6).alias("py"))


@query("est01_horizon")
def est01(s, d):
    """RANSAC from hypotheses drawn by a seeded generator, which no SQL engine shares."""
    return E.ransac_line(horizon_points(s, d))


def vertical_lines(s, d):
    """Lines through foot and head that lean with the distance from the image's middle."""
    x = (F.col("x1") + F.col("x2")) / 2
    lean, tall = (x - 960) * 0.1, F.col("y2") - F.col("y1")
    size = F.hypot(lean, tall)
    a, b = tall / size, -lean / size
    return T.detections(s, d).select(a.alias("a"), b.alias("b"), (-(a * x + b * F.col("y2"))).alias("c"))


def standing_people(s, d):
    """Feet and heads of poses in a camera tilted down: heads lean away from (960, 6000), a fifth of them anywhere."""
    x, y, tall = (F.col("x1") + F.col("x2")) / 2, F.col("y2"), (F.col("y2") - F.col("y1")) * 1.5
    noise = F.round(F.col("conf") * 1000) % 7 - 3
    lean = F.when(F.round(F.col("conf") * 1000) % 5 == 0, noise * 12).otherwise((x - 960) * tall / (6000 - y) + noise * 0.25)
    return T.detections(s, d).select(x.alias("fx"), y.alias("fy"), (x + lean).alias("hx"), (y - tall).alias("hy"))


@query("est02_vertical_point")
def est02(s, d):
    """The vanishing point of poses, with its inliers; reweighted least squares has no SQL."""
    found = E.vertical_vanishing_point(standing_people(s, d))
    return s.createDataFrame([tuple(found.values())], "x double, y double, n long, inliers long, share double, residual double")


@query("est02_weighted_sums", "SELECT round(sum(a * a), 3) AS aa, round(sum(a * b), 3) AS ab, round(sum(b * b), 3) AS bb FROM (SELECT tall / sqrt(tall * tall + lean * lean) AS a, -lean / sqrt(tall * tall + lean * lean) AS b FROM (SELECT ((x1 + x2) / 2 - 960) * 0.1::DOUBLE AS lean, y2 - y1 AS tall FROM v_det))")
def est02s(s, d):
    return vertical_lines(s, d).agg(*(F.round(F.sum(F.col(p) * F.col(q)), 3).alias(p + q) for p, q in ("aa", "ab", "bb")))


@query("est03_focal_length", "SELECT sqrt(300::DOUBLE * 4000) AS focal")
def est03(s, d):
    return s.createDataFrame([(E.focal_length((0.0, 1.0, -240.0), (960.0, 4540.0), (960.0, 540.0)),)], "focal double")


@query("est04_common_point", "SELECT 100::DOUBLE AS x, 50::DOUBLE AS y")
def est04(s, d):
    lines = np.array([[1.0, 0.0, -100.0], [0.0, 1.0, -50.0], [1.0, 1.0, -150.0]])
    return s.createDataFrame([E.common_point(lines)], "x double, y double")


@query("est05_holdout_residual", "SELECT round(median(abs((x2 - x1) * (100 - y1) - (y2 - y1) * (900 - x1)) / sqrt((x2 - x1)^2 + (y2 - y1)^2)), 6) AS residual FROM v_det WHERE frame_idx % 10 >= 7")
def est05(s, d):
    """Median distance of the held-out segments' lines from a vanishing point; three tenths of the frames are held out."""
    c = F.col
    dx, dy = c("x2") - c("x1"), c("y2") - c("y1")
    res = F.abs(dx * (F.lit(100.0) - c("y1")) - dy * (F.lit(900.0) - c("x1"))) / F.sqrt(dx * dx + dy * dy)
    held = T.detections(s, d).where("frame_idx % 10 >= 7").select(res.alias("res"))
    return exact_median(held, "res", 1.0, name="residual").select(F.round("residual", 6).alias("residual"))


@query("est05_vanishing_point")
def est05_point(s, d):
    """The point where most boxes' diagonals meet, with its held-out residual; hypotheses are drawn by hash, so it has no SQL."""
    c = F.col
    size = F.sqrt((c("y2") - c("y1")) ** 2 + (c("x2") - c("x1")) ** 2)
    a, b = (c("y1") - c("y2")) / size, (c("x2") - c("x1")) / size
    lines = T.detections(s, d).select("frame_idx", a.alias("a"), b.alias("b"), (-(a * c("x1") + b * c("y1"))).alias("c"))
    found = E.vanishing_point(lines, "frame_idx")
    return s.createDataFrame([tuple(found.values())], "x double, y double, inliers long, residual double, deviation double, accepted boolean")


@query("est06_candidates_on_line", "SELECT frame_idx, round(x1 + (300 - y1) * (x2 - x1) / (y2 - y1), 6) AS x FROM v_det WHERE y2 <> y1")
def est06(s, d):
    """Where each segment's line meets the horizon at row 300."""
    c = F.col
    return T.detections(s, d).where("y2 <> y1").select("frame_idx", F.round(c("x1") + (F.lit(300.0) - c("y1")) * (c("x2") - c("x1")) / (c("y2") - c("y1")), 6).alias("x"))


#: Images that leave a task together: some ten MB.
AT_ONCE = 64


def _drawn(batches, at_once: int = AT_ONCE):
    """Images of 240 x 160 for batches of keys, a few at a time, as each is some hundred KB and a key a few bytes."""
    y, x = np.mgrid[0:160, 0:240].astype(float)
    y, x = y[:, :1], x[:1]
    for batch in batches:
        for start in range(0, batch.num_rows, at_once):
            keys, made = batch.column("p_partkey").slice(start, at_once), []
            for key in keys.to_pylist():
                ring = [(20 + key % 40, 20 + key % 17), (190 + key % 31, 14 + key % 23), (200 - key % 37, 130 + key % 19), (30 + key % 29, 140 - key % 13)]
                share = np.ones((160, 240))
                for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
                    share *= np.clip(0.5 + ((bx - ax) * (y - ay) - (by - ay) * (x - ax)) / np.hypot(bx - ax, by - ay), 0, 1)
                noise = np.random.Generator(np.random.PCG64(key)).normal(0, 3, share.shape)
                image = np.clip(50 + key % 60 + 110 * share + noise, 0, 255).round().astype(np.uint8)
                made.append(np.repeat(image[:, :, None], 3, axis=2).tobytes())
            n = len(made)
            yield pa.RecordBatch.from_pydict({"image_id": keys.cast(pa.int64()), "width": pa.array([240] * n, pa.int32()), "height": pa.array([160] * n, pa.int32()), "content": pa.array(made, pa.binary())})


def _scenes(s, d):
    """An image of 240 x 160 for each part: a bright quadrilateral on a dark ground, its sides and its noise drawn from the part's key."""
    # Keys are few bytes and images many, so they are spread before they are drawn.
    keys = T.read(s, d, "part").select("p_partkey").repartition(s.sparkContext.defaultParallelism, "p_partkey")
    return keys.mapInArrow(_drawn, "image_id long, width int, height int, content binary")


@query("est12_line_segments")
def est12(s, d):
    """Segments of 40 pixels and more in images, with the row of the horizon at which their lines point; image work has no SQL."""
    c = F.col
    found = Sg.detect_segments(_scenes(s, d), 40.0)
    crossing = F.when(F.abs(c("y2") - c("y1")) > 1e-6, c("x1") + (F.lit(-60.0) - c("y1")) * (c("x2") - c("x1")) / (c("y2") - c("y1")))
    return found.select("image_id", *(F.round(v, 3).alias(v) for v in ("x1", "y1", "x2", "y2", "width", "alarms")), F.round(crossing, 3).alias("at_horizon"))


@query("est12_vanishing_point")
def est12_point(s, d):
    """The point where most of the found segments' lines meet, by votes of all of them."""
    c = F.col
    size = F.hypot(c("x2") - c("x1"), c("y2") - c("y1"))
    a, b = (c("y1") - c("y2")) / size, (c("x2") - c("x1")) / size
    lines = Sg.detect_segments(_scenes(s, d), 40.0).select("image_id", a.alias("a"), b.alias("b"), (-(a * c("x1") + b * c("y1"))).alias("c"))
    found = E.vanishing_point(staged(lines), "image_id", tolerance=5.0)
    return s.createDataFrame([tuple(found.values())], "x double, y double, inliers long, residual double, deviation double, accepted boolean")


@query("est07_camera_axes", "SELECT true AS orthogonal, true AS right_handed")
def est07(s, d):
    camera = E.camera_from_points(1100.0, (900.0, 240.0), (960.0, 4540.0), (960.0, 540.0))
    r = camera.rotation
    return s.createDataFrame([(bool(np.allclose(r.T @ r, np.eye(3))), bool(np.linalg.det(r) > 0))], "orthogonal boolean, right_handed boolean")


@query("est08_rectangle_homography", "SELECT 0::BIGINT AS corner, 0::DOUBLE AS u, 0::DOUBLE AS v UNION ALL SELECT 1, 4, 0 UNION ALL SELECT 2, 4, 2 UNION ALL SELECT 3, 0, 2")
def est08(s, d):
    corners = [(100.0, 900.0), (1700.0, 880.0), (1200.0, 400.0), (500.0, 410.0)]
    h = E.ground_homography(corners, 4.0, 2.0)
    rows = []
    for k, p in enumerate(corners):
        g = h @ np.array([*p, 1.0])
        rows.append((k, round(float(g[0] / g[2]), 6) + 0.0, round(float(g[1] / g[2]), 6) + 0.0))
    return s.createDataFrame(rows, "corner long, u double, v double")


@query("est09_scale", "SELECT round(6.06::DOUBLE / 3.03::DOUBLE, 9) AS from_width, round(1.68::DOUBLE / median(height), 9) AS from_heights FROM v_person")
def est09(s, d):
    scale = E.scale_from_width(np.eye(3), (0.0, 0.0), (0.0, 3.03), 6.06)
    middle = exact_median(T.people(s, d), "height", 0.001, name="mid")
    return middle.select(F.round(F.lit(scale), 9).alias("from_width"), F.round(F.lit(1.68) / F.col("mid"), 9).alias("from_heights"))


@query("est10_verdicts", "SELECT * FROM (VALUES ('all', 'calibrated'), ('no street', 'scale_from_height'), ('no scale', 'angles_ok_scale_unverified'), ('no horizon', 'stub_affine')) v(case_, verdict)")
def est10(s, d):
    fine = {k: True for k in ("horizon", "vertical", "focal", "height", "street")}
    cases = {"all": {}, "no street": {"street": None}, "no scale": {"street": None, "height": None}, "no horizon": {"horizon": None}}
    return s.createDataFrame([(k, E.verdict({**fine, **v})) for k, v in cases.items()], "case_ string, verdict string")


@query("est11_stub_plane", "SELECT frame_idx, round((x1 + x2) / 2 / 1920 * 35, 6) AS x, round(12 - y2 / 1080 * 12, 6) AS y FROM v_det")
def est11(s, d):
    """The affine stand-in for a camera that could not be calibrated: the image stretched over the street."""
    return T.detections(s, d).select("frame_idx", F.round((F.col("x1") + F.col("x2")) / 2 / 1920 * 35, 6).alias("x"), F.round(12 - F.col("y2") / 1080 * 12, 6).alias("y"))


#: A rectangle of the paving as it was traced in the image, and the plane that it gives.
TRACED = {"rect_px": [[300.0, 420.0], [1500.0, 400.0], [1800.0, 980.0], [60.0, 1010.0]], "aspect": 2.5}
_PLANE = [v for row in traced_plane(TRACED, 2.5)["H"] for v in row]
_W = f"({_PLANE[6]!r}::DOUBLE * fx + {_PLANE[7]!r}::DOUBLE * fy + {_PLANE[8]!r}::DOUBLE)"


@query("est11_manual_plane", f"""SELECT frame_idx, round(({_PLANE[0]!r}::DOUBLE * fx + {_PLANE[1]!r}::DOUBLE * fy + {_PLANE[2]!r}::DOUBLE) / {_W}, 6) AS x,
    round(({_PLANE[3]!r}::DOUBLE * fx + {_PLANE[4]!r}::DOUBLE * fy + {_PLANE[5]!r}::DOUBLE) / {_W}, 6) AS y, {_W} * {_PLANE[6] * 930 + _PLANE[7] * 700 + _PLANE[8]!r}::DOUBLE > 0 AS on_the_ground
    FROM (SELECT frame_idx, (x1 + x2) / 2 AS fx, y2 AS fy FROM v_det)""")
def est11_plane(s, d):
    """Feet on the traced plane, in units of its left side, and whether they lie below its horizon."""
    fx, fy = (F.col("x1") + F.col("x2")) / 2, F.col("y2")
    x, y = homography(_PLANE, fx, fy)
    inside = _PLANE[6] * 930 + _PLANE[7] * 700 + _PLANE[8]
    below = (fx * _PLANE[6] + fy * _PLANE[7] + _PLANE[8]) * inside > 0
    return T.detections(s, d).select("frame_idx", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"), below.alias("on_the_ground"))
