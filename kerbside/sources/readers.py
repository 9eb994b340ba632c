"""Readers of documents: GeoJSON zones, JSON-lines labels, configuration; generators of frame numbers; interfaces of models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ZONE = "struct<zone_id:string,zone_type:string,storefront_id:string,name:string,status:string>"
_DOCUMENT = f"status string, homography_sha256 string, features array<struct<geometry:struct<type:string,coordinates:string>,properties:{ZONE}>>"


def require(config: dict, *keys: str):
    """A nested setting that must be there."""
    for k, key in enumerate(keys):
        if not isinstance(config, dict) or key not in config:
            raise KeyError(f"no setting {'.'.join(keys[: k + 1])}")
        config = config[key]
    return config


def zones_from_geojson(spark: SparkSession, documents: DataFrame, homography_sha256: str | None = None) -> DataFrame:
    """(zone_id, zone_type, storefront_id, coords) from GeoJSON texts in column ``value``; a polygon's closing vertex is dropped.

    Skeletons, documents without facades and those made with another homography fail the job that meets them.
    """
    doc = documents.select(F.from_json("value", _DOCUMENT).alias("d")).select("d.*")
    facades = F.size(F.filter("features", lambda f: f["properties"]["zone_type"] == "facade"))
    stale = F.lit(False) if homography_sha256 is None else ~F.col("homography_sha256").eqNullSafe(F.lit(homography_sha256))
    wrong = F.when(F.col("status") == "skeleton", "skeleton").when(F.coalesce(facades, F.lit(0)) == 0, "no facades").when(stale, "stale homography")
    checked = doc.withColumn("features", F.when(wrong.isNull(), F.col("features")).otherwise(F.raise_error(F.concat(F.lit("zones: "), wrong))))
    rows = checked.select(F.explode("features").alias("f")).select("f.properties.*", F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("text"))
    line = F.from_json("text", "array<array<double>>")
    ring = F.element_at(F.from_json("text", "array<array<array<double>>>"), 1)
    points = F.when(F.col("kind") == "LineString", line).otherwise(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))))
    return rows.select("zone_id", "zone_type", "storefront_id", F.transform(points, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("coords"))


def labels_from_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(header, rows) of JSON-lines labels: the header is the line that names a mode."""
    schema = "mode string, track_id long, frame_idx long, bbox_px array<double>, predicted_yaw_deg double, model_conf double, label double, flag string"
    parsed = lines.select(F.from_json("value", schema).alias("r")).select("r.*")
    return parsed.where("mode IS NOT NULL").select("mode"), parsed.where("mode IS NULL AND track_id IS NOT NULL").drop("mode")


def burst_frames(spark: SparkSession, frames: int, bursts: int, length: int) -> DataFrame:
    """(frame_idx, burst_id): evenly spaced runs of frames from first to last, half-even starts, equal starts once."""
    if not 0 < length <= frames or bursts < 1:
        raise ValueError("bursts must fit the recording")
    step = (frames - length) / (bursts - 1) if bursts > 1 else 0.0
    starts = spark.range(bursts).select(F.bround(F.col("id") * step, 0).cast("long").alias("start"))
    firsts = starts.groupBy("start").agg(F.lit(1)).select("start")
    numbered = firsts.withColumn("burst_id", F.floor(F.col("start") / max(step, 1.0) + 0.5).cast("int"))
    return numbered.select(F.explode(F.sequence("start", F.col("start") + length - 1)).alias("frame_idx"), "burst_id").dropDuplicates(["frame_idx"])


def people_samples(detections: DataFrame, step: int) -> DataFrame:
    """(frame_idx, n): numbers of boxes in every ``step``-th frame."""
    return detections.where(F.pmod("frame_idx", F.lit(step)) == 0).groupBy("frame_idx").agg(F.count("*").alias("n"))


Detector = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def detect(images: DataFrame, model: Detector) -> DataFrame:
    """Run a detector over (frame_idx, content) rows; the model is loaded once a task, inside the callable.

    The engine brings no model. Whatever yields x1, y1, x2, y2, conf and cls a box fits.
    """
    return images.mapInPandas(model, "frame_idx long, x1 double, y1 double, x2 double, y2 double, conf double, cls int")


def estimate_poses(images: DataFrame, model: Detector) -> DataFrame:
    """The same for poses: 17 keypoints a person."""
    return images.mapInPandas(model, "frame_idx long, person int, keypoints array<struct<x:double,y:double,conf:double>>")
