"""The engine's input tables derived from the benchmark tables, and the same definitions as SQL.

A deployment reads its own observations, detections and frames with the schemas of ``contracts``; these views give every query
something of that shape from TPC-H-like tables, by integer arithmetic that all engines agree on. Ten hours count as a second.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Storefronts: (zone, facade from, facade to, x and y, apron corners). The facades line the far side of a 35 x 12 m street.
FACADES = [("M1", 2.0, 12.0, 8.0, 12.0), ("M2", 10.0, 12.0, 16.0, 12.0), ("M3", 18.0, 12.0, 25.0, 12.0), ("M4", 27.0, 12.0, 33.0, 12.0)]
APRON_DEPTH = 2.0
#: The observed part of the street, and a plane homography from pixels to metres, row by row.
ROI = [(1.0, 0.5), (34.0, 0.5), (34.0, 11.5), (1.0, 11.5)]
HOMOGRAPHY = (0.02, 0.001, -1.0, 0.0005, 0.03, -2.0, 0.00001, 0.0008, 1.0)

_BASE = 1_704_067_200_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track-frames: one row per track and frame, positions in metres, angles in degrees."""
    e, u = F.col("event_id"), F.col("user_id")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    seen = e % 29 != 0
    x, y = (e * 37 % 3500) / 100.0, (e * 53 % 1200) / 100.0
    return read(spark, sf_dir, "events").select(
        u.cast("int").alias("track_id"), e.alias("frame_idx"), ((micros - _BASE) / 36e9).alias("ts"),
        F.when(seen, x).alias("x"), F.when(seen, y).alias("y"),
        F.when(seen & (e % 4 == 1), x + 0.25).alias("x_ref"), F.when(seen & (e % 4 == 1), y - 0.125).alias("y_ref"),
        F.when(F.col("event_type") != "error", ((e * 73 + u * 17) % 360).cast("double")).alias("body_yaw"),
        F.when(e % 3 == 0, (e * 31 % 360).cast("double")).alias("head_yaw"),
        F.when((F.col("event_type") != "error") | (e % 3 == 0), (e * 7 % 100) / 100.0).alias("yaw_conf"),
        (e % 18).cast("int").alias("n_kpts_valid"),
        F.when(seen, (e * 11 % 160) / 100.0).alias("speed"),
        F.when(F.col("event_type") == "click", "ankle").when(F.col("event_type") == "purchase", "box_bottom").otherwise("box_bottom_occluded").alias("foot_source"),
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of a frame in pixels, with their confidence."""
    p, s, n, q = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"), F.col("l_quantity").cast("int")
    x1, y1 = (p * 7 % 1800).cast("double"), (s * 13 % 700 + n * 29 % 100).cast("double")
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frame_idx"), x1.alias("x1"), y1.alias("y1"), (x1 + 20 + q).alias("x2"), (y1 + 40 + q * 3).alias("y2"),
        ((p * 13 + s * 7 + n) % 1000 / 1000.0).alias("conf"), (q % 2).cast("int").alias("cls"),
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All frames of the recording; those not processed have no detections but a reason."""
    done = F.col("o_orderstatus") != "P"
    counts = detections(spark, sf_dir).groupBy("frame_idx").agg(F.count("*").alias("n"))
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("frame_idx"), done.alias("processed"))
    return orders.join(counts, "frame_idx", "left").select(
        "frame_idx", (F.col("frame_idx") / 30.0).alias("ts"), "processed",
        F.when(F.col("processed"), F.coalesce("n", F.lit(0)).cast("int")).alias("n_detections"),
        F.when(~F.col("processed"), F.when(F.col("frame_idx") % 5 == 0, "decode_error").otherwise("sampled_out")).alias("skip_reason"),
    )


def zones(spark: SparkSession) -> DataFrame:
    """One row a storefront: its facade's ends and, in front of it, its apron's corners. A handful of literal rows."""
    rows = [(z, ax, ay, bx, by, ax, ay - APRON_DEPTH, bx, by) for z, ax, ay, bx, by in FACADES]
    return spark.createDataFrame(rows, "zone_id string, ax double, ay double, bx double, by double, apron_x0 double, apron_y0 double, apron_x1 double, apron_y1 double")


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colour of each track: HSV with hue in [0, 180), its background's, and pixel agreement."""
    k = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        k.cast("int").alias("track_id"), (k * 37 % 180).cast("double").alias("h"), (k * 53 % 256).cast("double").alias("s"),
        (k * 71 % 256).cast("double").alias("v"), (k * 41 % 180).cast("double").alias("bg_h"), (k * 59 % 256).cast("double").alias("bg_s"),
        (k * 3 % 100 / 100.0).alias("agree"),
    )


def labelled_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-labelled and predicted angles of single observations; some predictions are missing."""
    d = F.col("doc_id")
    return read(spark, sf_dir, "labels").select(
        d.alias("frame_idx"), (d * 37 % 360).cast("double").alias("label"),
        F.when(d % 11 != 0, (d * 37 % 360 + d * 13 % 61 - 30).cast("double")).alias("predicted"), (d * 7 % 100 / 100.0).alias("model_conf"),
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured heights of people, and their distance from the camera, in metres."""
    k = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        k.alias("person_id"), (F.lit(1.4) + k * 17 % 600 / 1000.0).alias("height"), (F.lit(4.0) + k * 29 % 3000 / 100.0).alias("depth")
    )


def _rows(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}::DOUBLE" for v in r) + ")" for r in rows)


VIEWS: dict[str, str] = {
    "v_obs": f"""SELECT user_id::INTEGER AS track_id, event_id AS frame_idx, (epoch_us(ts) - {_BASE}) / 36e9::DOUBLE AS ts,
        CASE WHEN event_id % 29 <> 0 THEN (event_id * 37 % 3500) / 100::DOUBLE END AS x, CASE WHEN event_id % 29 <> 0 THEN (event_id * 53 % 1200) / 100::DOUBLE END AS y,
        CASE WHEN event_id % 29 <> 0 AND event_id % 4 = 1 THEN (event_id * 37 % 3500) / 100::DOUBLE + 0.25::DOUBLE END AS x_ref,
        CASE WHEN event_id % 29 <> 0 AND event_id % 4 = 1 THEN (event_id * 53 % 1200) / 100::DOUBLE - 0.125::DOUBLE END AS y_ref,
        CASE WHEN event_type <> 'error' THEN ((event_id * 73 + user_id * 17) % 360)::DOUBLE END AS body_yaw,
        CASE WHEN event_id % 3 = 0 THEN (event_id * 31 % 360)::DOUBLE END AS head_yaw,
        CASE WHEN event_type <> 'error' OR event_id % 3 = 0 THEN (event_id * 7 % 100) / 100::DOUBLE END AS yaw_conf,
        (event_id % 18)::INTEGER AS n_kpts_valid, CASE WHEN event_id % 29 <> 0 THEN (event_id * 11 % 160) / 100::DOUBLE END AS speed,
        CASE event_type WHEN 'click' THEN 'ankle' WHEN 'purchase' THEN 'box_bottom' ELSE 'box_bottom_occluded' END AS foot_source FROM events""",
    "v_det": """SELECT frame_idx, x1, y1, x1 + 20 + q AS x2, y1 + 40 + q * 3 AS y2, conf, (q % 2)::INTEGER AS cls FROM (
        SELECT l_orderkey AS frame_idx, (l_partkey * 7 % 1800)::DOUBLE AS x1, (l_suppkey * 13 % 700 + l_linenumber * 29 % 100)::DOUBLE AS y1,
        l_quantity::INTEGER AS q, ((l_partkey * 13 + l_suppkey * 7 + l_linenumber) % 1000) / 1000::DOUBLE AS conf FROM lineitem)""",
    "v_frame": """SELECT frame_idx, frame_idx / 30::DOUBLE AS ts, processed, CASE WHEN processed THEN coalesce(n, 0)::INTEGER END AS n_detections,
        CASE WHEN NOT processed THEN CASE WHEN frame_idx % 5 = 0 THEN 'decode_error' ELSE 'sampled_out' END END AS skip_reason
        FROM (SELECT o_orderkey AS frame_idx, o_orderstatus <> 'P' AS processed FROM orders) LEFT JOIN (SELECT frame_idx, count(*) AS n FROM v_det GROUP BY 1) USING (frame_idx)""",
    "v_zone": f"""SELECT zone_id, ax, ay, bx, b_y, ax AS apron_x0, ay - {APRON_DEPTH}::DOUBLE AS apron_y0, bx AS apron_x1, b_y AS apron_y1
        FROM (VALUES {_rows(FACADES)}) z(zone_id, ax, ay, bx, b_y)""",
    "v_attr": """SELECT c_custkey::INTEGER AS track_id, (c_custkey * 37 % 180)::DOUBLE AS h, (c_custkey * 53 % 256)::DOUBLE AS s, (c_custkey * 71 % 256)::DOUBLE AS v,
        (c_custkey * 41 % 180)::DOUBLE AS bg_h, (c_custkey * 59 % 256)::DOUBLE AS bg_s, (c_custkey * 3 % 100) / 100::DOUBLE AS agree FROM customer""",
    "v_label": """SELECT doc_id AS frame_idx, (doc_id * 37 % 360)::DOUBLE AS label, CASE WHEN doc_id % 11 <> 0 THEN (doc_id * 37 % 360 + doc_id * 13 % 61 - 30)::DOUBLE END AS predicted,
        (doc_id * 7 % 100) / 100::DOUBLE AS model_conf FROM labels""",
    "v_person": """SELECT p_partkey AS person_id, 1.4::DOUBLE + (p_partkey * 17 % 600) / 1000::DOUBLE AS height, 4::DOUBLE + (p_partkey * 29 % 3000) / 100::DOUBLE AS depth FROM part""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """A query preceded by the views that it names, directly or through others."""
    known = {**VIEWS, **(extra or {})}
    needed: list[str] = []

    def add(text: str) -> None:
        for name in known:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                add(known[name])
                needed.append(name)

    add(body)
    return ("WITH " + ", ".join(f"{n} AS ({known[n]})" for n in needed) + " " if needed else "") + body
