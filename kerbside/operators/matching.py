"""Joins of detections, probes and poses within frames. Frame equality bounds them all."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.colour import colour_class
from ..functions.geometry import box_iou
from ..functions.stats import median

_BOX = ("x1", "y1", "x2", "y2")


def frame_pairs(boxes: DataFrame) -> DataFrame:
    """(frame_idx, a, b, iou) of all pairs a < b of boxes in a frame."""
    left = boxes.select("frame_idx", F.col("det").alias("a"), *(F.col(c).alias(f"a_{c}") for c in _BOX))
    right = boxes.select("frame_idx", F.col("det").alias("b"), *(F.col(c).alias(f"b_{c}") for c in _BOX))
    iou = box_iou(*(F.col(f"{p}_{c}") for p in "ab" for c in _BOX))
    return left.join(right, "frame_idx").where("a < b").select("frame_idx", "a", "b", iou.alias("iou"))


def crowding(boxes: DataFrame) -> DataFrame:
    """Boxes with the largest overlap that each has with another of its frame."""
    pairs = frame_pairs(boxes)
    both = pairs.select("frame_idx", F.explode(F.array("a", "b")).alias("det"), "iou")
    return boxes.join(both.groupBy("frame_idx", "det").agg(F.max("iou").alias("m")), ["frame_idx", "det"], "left").withColumn("max_iou", F.coalesce("m", F.lit(0.0))).drop("m")


def separated_pairs(boxes: DataFrame, apart: float) -> DataFrame:
    """Pairs a < b of a frame whose feet lie ``apart`` rows or more from each other, with feet and heads."""
    x = (F.col("x1") + F.col("x2")) / 2
    side = lambda p: boxes.select("frame_idx", F.col("det").alias(p), x.alias(f"{p}x"), F.col("y2").alias(f"{p}_foot"), F.col("y1").alias(f"{p}_head"))
    return side("a").join(side("b"), "frame_idx").where((F.col("a") < F.col("b")) & (F.abs(F.col("a_foot") - F.col("b_foot")) >= apart))


def nearest_box(probes: DataFrame, boxes: DataFrame, least: float, share: float) -> DataFrame:
    """Each probe's nearest box by its foot, ties to the lower number; ``det`` is null beyond max(least, share x height)."""
    dist = F.round(F.hypot((F.col("x1") + F.col("x2")) / 2 - F.col("fx"), F.col("y2") - F.col("fy")), 9)
    key = F.struct(dist.alias("dist"), "det", (F.col("y2") - F.col("y1")).alias("h"))
    best = probes.join(boxes, "frame_idx").groupBy("frame_idx").agg(F.min(key).alias("best"))
    fits = F.col("best.dist") <= F.greatest(F.lit(least), F.col("best.h") * share)
    return best.select("frame_idx", F.when(fits, F.col("best.det")).alias("det"), F.col("best.dist").alias("dist"))


def greedy_poses(tracks: DataFrame, poses: DataFrame, reach: float) -> DataFrame:
    """(frame_idx, track, pose): tracks in order take their nearest unused pose, if it is within ``reach``.

    Sequential within a frame, so it runs in pandas; a frame holds a street's people.
    """

    def in_frame(frame: int, left: pd.DataFrame, right: pd.DataFrame) -> list[tuple[int, int, int]]:
        free = np.ones(len(right), bool)
        px, py, pose = (right[c].to_numpy() for c in ("x", "y", "pose"))
        rows = []
        for track, x, y in zip(left["track"], left["x"], left["y"], strict=True):
            if not free.any():
                break
            dist = np.where(free, np.hypot(px - x, py - y), np.inf)
            k = int(dist.argmin())
            if dist[k] <= reach:
                free[k] = False
                rows.append((frame, track, int(pose[k])))
        return rows

    def assign(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        poses_of = dict(list(right.sort_values("pose").groupby("frame_idx")))
        rows: list[tuple[int, int, int]] = []
        for frame, own in left.sort_values("track").groupby("frame_idx"):
            if frame in poses_of:
                rows += in_frame(int(frame), own, poses_of[frame])
        return pd.DataFrame(rows, columns=["frame_idx", "track", "pose"]).astype({"frame_idx": "int64", "track": "int32", "pose": "int32"})

    # Some hundred frames a group: a call each would cost more than the work.
    span = F.floor(F.col("frame_idx") / 512).alias("span")
    left, right = tracks.select("*", span), poses.select("*", span)
    return left.groupBy("span").cogroup(right.groupBy("span")).applyInPandas(assign, "frame_idx long, track int, pose int")


def coloured_positions(attributes: DataFrame, obs: DataFrame) -> DataFrame:
    """Tracks with a colour class and the median of their positions."""
    colours = attributes.select("track_id", colour_class(F.col("h"), F.col("s"), F.col("v")).alias("colour"))
    middle = obs.groupBy("track_id").agg(median("x").alias("mx"), median("y").alias("my")).where("mx IS NOT NULL")
    return colours.join(middle, "track_id")


def as_of(left: DataFrame, right: DataFrame, value: str, span: float) -> DataFrame:
    """Each left row with ``value`` of the last right row (ts, value) at or before its ``ts``; rows without one are left out.

    Time is cut into spans that are ordered apart. A span starts from the last right row of those before it, carried over by a
    window with one row a span, so that no task orders the whole table.
    """
    cut = lambda df: df.withColumn("span", F.floor(F.col("ts") / span))
    last = cut(right).groupBy("span").agg(F.max_by(value, "ts").alias("last"))
    spans = cut(left).select("span").union(last.select("span")).distinct().join(last, "span", "left")
    earlier = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("span", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    names = left.columns
    mine = cut(left).select("ts", "span", F.struct(*names).alias("row"), F.lit(None).cast(right.schema[value].dataType).alias("seen"), F.lit(1).alias("side"))
    other = cut(right).select("ts", "span", F.lit(None).cast(mine.schema["row"].dataType).alias("row"), F.col(value).alias("seen"), F.lit(0).alias("side"))
    so_far = Window.partitionBy("span").orderBy("ts", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = mine.unionByName(other).withColumn("found", F.last("seen", ignorenulls=True).over(so_far)).where("side = 1").join(carried, "span")
    return found.select("row.*", F.coalesce("found", "carried").alias(value)).where(F.col(value).isNotNull())
