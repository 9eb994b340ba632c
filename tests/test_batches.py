"""Work in batches: what a task holds at once does not grow with the rows of a batch, and batches change no result."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerbside.functions import colour
from kerbside.operators import grid, images, png
from kerbside.queries import estimators


def test_drawn_images_leave_a_few_at_a_time():
    """A batch of 500 keys is 4 KB, and 58 MB as images."""
    keys = pa.RecordBatch.from_pydict({"p_partkey": list(range(500))})
    made = list(estimators._drawn(iter([keys])))
    assert [i for b in made for i in b.column("image_id").to_pylist()] == list(range(500))
    assert max(b.nbytes for b in made) < 10_000_000
    assert all(len(c.as_buffer()) == 240 * 160 * 3 for c in made[-1].column("content"))


def test_torso_colours_against_columns_without_a_row_a_pixel(spark):
    rng = np.random.default_rng(5)
    made = [rng.integers(0, 256, (h, w, 3)) // step * step for h, w, step in [(48, 24, 1), (48, 24, 64), (31, 17, 40), (48, 24, 255), (12, 9, 3), (6, 4, 1)]]
    rows = [(k, m.shape[1], m.shape[0], m.astype(np.uint8).tobytes()) for k, m in enumerate(made)]
    df = images.torso_colours(spark.createDataFrame([*rows, (9, 24, 48, None)], "crop_id long, width int, height int, content binary"))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    found = {r["crop_id"]: r for r in df.collect()}
    assert sorted(found) == [0, 1, 2, 3, 4]
    for k in found:
        h, w = made[k].shape[:2]
        rows_, cols, edge = slice(int(h * 0.22), int(h * 0.55)), slice(int(w * 0.18), int(w * 0.82)), max(1, int(w * 0.12))
        pixels = [("torso", *map(int, p)) for p in made[k][rows_, cols].reshape(-1, 3)]
        pixels += [("side", *map(int, p)) for part in (made[k][rows_, :edge], made[k][rows_, w - edge :]) for p in part.reshape(-1, 3)]
        hsv = colour.bgr_to_hsv(*(F.col(c) for c in "bgr"))
        seen = spark.createDataFrame(pixels, "part string, b int, g int, r int").select("part", *(v.alias(c) for v, c in zip(hsv, "hsv", strict=True)))
        mid = lambda c, part: F.percentile(F.when(F.col("part") == part, F.col(c)), F.lit(0.5)).alias(c if part == "torso" else f"bg_{c}")
        want = seen.agg(*(mid(c, "torso") for c in "hsv"), mid("h", "side"), mid("s", "side")).withColumn("colour", colour.colour_class(*map(F.col, "hsv"))).first()
        assert all(found[k][c] == want[c] for c in ("h", "s", "v", "bg_h", "bg_s", "colour"))
        same = seen.where("part = 'torso'").agg(F.avg((colour.colour_class(*map(F.col, "hsv")) == want["colour"]).cast("int"))).first()[0]
        assert found[k]["agree"] == pytest.approx(same, abs=1e-12)


def blurred_one_by_one(image, share=0.3, block=16, sigma=4.0):
    """The upper part by its definition: means of blocks, then a convolution along each axis."""
    out = image.copy()
    top = max(1, int(round(image.shape[0] * share)))
    part = out[:top].astype(float)
    for y in range(0, top, block):
        for x in range(0, part.shape[1], block):
            part[y : y + block, x : x + block] = part[y : y + block, x : x + block].mean(axis=(0, 1))
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    for axis in (0, 1):
        wide = np.pad(part, [(reach, reach) if a == axis else (0, 0) for a in range(3)], mode="edge")
        part = np.apply_along_axis(lambda v: np.convolve(v, kernel / kernel.sum(), mode="valid"), axis, wide)
    out[:top] = np.round(part.round(6))
    return out


@pytest.mark.parametrize(("h", "w"), [(48, 24), (1, 1), (120, 70), (33, 16), (7, 90)])
def test_crops_of_one_size_are_blurred_together(spark, monkeypatch, h, w):
    """As by the definition, with no convolution a line: 900,000 crops of 24 x 48 have 40 million of them."""
    made = np.random.default_rng(h * w).integers(0, 256, (5, h, w, 3)).astype(np.uint8)
    want = [blurred_one_by_one(m) for m in made]
    monkeypatch.setattr(np, "apply_along_axis", None)
    assert all((images.blurred_tops(made)[k] == want[k]).all() and (images.blurred_top(made[k]) == want[k]).all() for k in range(5))


def test_crops_of_several_sizes_keep_their_places(spark):
    rng = np.random.default_rng(3)
    made = [rng.integers(0, 256, size).astype(np.uint8) for size in [(48, 24, 3), (20, 11, 3), (48, 24, 3), (20, 24, 3)]] + [np.full((48, 24, 3), 7, np.uint8)]
    rows = [(k, m.shape[1], m.shape[0], m.tobytes()) for k, m in enumerate(made)] + [(9, 24, 48, None)]
    found = {r["crop_id"]: r for r in images.blur_crops(spark.createDataFrame(rows, "crop_id long, width int, height int, content binary").coalesce(1)).collect()}
    assert len(found) == 6 and found[9]["content"] is None and not found[4]["changed"] and found[0]["changed"]
    assert all(bytes(found[k]["content"]) == images.blurred_top(m).tobytes() for k, m in enumerate(made))


@pytest.mark.parametrize(("h", "w"), [(48, 24), (1, 1), (17, 64)])
def test_images_of_one_size_are_encoded_together(h, w):
    """As one by one, from one pass over the pixels of all of them."""
    rng = np.random.default_rng(h + w)
    made = np.minimum(255, np.add.outer(np.arange(h) * 3, np.arange(w) * 2)[:, :, None] // 2 + rng.integers(0, 40, (6, h, w, 3))).astype(np.uint8)
    assert png.encoded_all(made) == [png.encoded(m) for m in made] and len(set(png.encoded_all(made))) == 6


def test_road_pixels_are_those_of_the_masks(spark, monkeypatch):
    """With boxes that overlap, touch, lie outside or are turned round, with none and with many; no mask is drawn for frames of few boxes."""
    rng = np.random.default_rng(8)
    rows = []
    for f, n in enumerate([0, 1, 2, 3, 5, 9, 17, images.MANY_BOXES + 5, 4, 4, 4]):
        for _ in range(n):
            x, y, w, h = rng.uniform(-30, 60), rng.uniform(-30, 50), rng.uniform(-8, 30), rng.uniform(-8, 30)
            rows.append((f, *map(float, (x, y, x + w, y + h))))
    boxes = spark.createDataFrame(rows, "frame_idx long, x1 double, y1 double, x2 double, y2 double")
    frames = spark.range(12).withColumnRenamed("id", "frame_idx")
    shape = ([(2, 1), (47, 3), (44, 38), (5, 36)], 50, 40, 2)
    want = {r["frame_idx"]: r["pixels"] for r in images.road_masks(frames, boxes, *shape).select("frame_idx", "pixels").collect()}
    found = {r["frame_idx"]: r["pixels"] for r in images.road_pixels(frames, boxes, *shape).collect()}
    assert found == want and len(set(found.values())) > 6
    from kerbside.queries import QUERIES, processes

    monkeypatch.setattr(processes.Im, "road_masks", None)
    monkeypatch.setattr(processes.T, "frames", lambda s, d: frames)
    monkeypatch.setattr(processes.T, "detections", lambda s, d: boxes)
    assert QUERIES["udf05_road_masks"](spark, "").count() == 12


def test_many_zones_are_not_gathered_by_the_driver(spark):
    """Neither side of the grid's join is broadcast, and points of one position, doubled ones and zones of one number all count."""
    square = lambda a, b, w: [(a, b), (a + w, b), (a + w, b + w), (a, b + w)]
    zones = [(1, square(0.0, 0.0, 2.0)), (2, square(1.0, 1.0, 2.0)), (2, square(1.25, 1.25, 0.25)), (3, square(-1.0, -1.0, 0.5))]
    rings = spark.createDataFrame(zones, "zone_id long, ring array<struct<x: double, y: double>>")
    spots = [(0.5, 0.5), (1.3, 1.3), (1.3, 1.3), (2.5, 2.5), (9.0, 9.0), (-0.75, -0.75), (0.0, 0.25), (-0.0, 0.25), (None, 1.0)]
    rows = [(k % 7, x, y) for k, (x, y) in enumerate(spots)] + [(5, -0.75, -0.75)]
    df = grid.points_in_zones(spark.createDataFrame(rows, "k int, x double, y double"), rings, 0.5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 2
    inside = lambda x, y, ring: ring[0][0] <= x < ring[2][0] and ring[0][1] <= y < ring[2][1]
    want = [(*r, z) for r in rows if r[1] is not None for z, ring in zones if inside(*r[1:], ring)]
    assert df.columns == ["k", "x", "y", "zone_id"] and sorted(map(tuple, df.collect())) == sorted(want) and len(want) > 10
