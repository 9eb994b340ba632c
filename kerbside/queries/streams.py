"""Keyed state over streams: the benchmark tables replayed as files in three runs, each from the checkpoint of the one before."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sampling import drawn_sql
from ..sources import tables as T
from ..sources.staging import scratch, staged
from ..streaming import keyed, presence
from .registry import query

RUNS = 3


def in_runs(rows: DataFrame, closing: DataFrame) -> list[DataFrame]:
    """Rows cut at equal steps of event time ``at``, and a last chunk that carries the watermark past all of them."""
    lo, hi = rows.agg(F.min("at"), F.max("at")).first()
    if lo is None:
        return [rows]
    step = (hi - lo) / RUNS
    cuts = [lo + step * k for k in range(1, RUNS)]
    bounds = zip([None, *cuts], [*cuts, None], strict=True)
    parts = [reduce(lambda df, c: df.where(c), [c for c in (F.col("at") >= a if a else None, F.col("at") < b if b else None) if c is not None], rows) for a, b in bounds]
    return [*parts, closing]


def _far(s, schema, **values) -> DataFrame:
    """One row in the year 2100, beyond all others, null but for ``values``."""
    at = F.timestamp_seconds(F.lit(4_102_444_800))
    return s.range(1).select(*(at.alias(f.name) if f.name == "at" else F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema))


def _place(s, name: str) -> str:
    return scratch(s, f"{name}-{uuid.uuid4().hex}")


@query("stm01_keyed_tracks")
def stm01(s, d):
    """Tracks of recordings of 1,000 frames, kept as state; equal to the batch form over the same recordings, which has no SQL."""
    boxes = T.frames(s, d).select("frame_idx").join(T.detections(s, d), "frame_idx", "left")
    at = F.timestamp_millis(F.floor(F.col("frame_idx") * 1000 / 30))
    rows = boxes.select(F.floor(F.col("frame_idx") / 1000).alias("segment_id"), at.alias("at"), "frame_idx", "x1", "y1", "x2", "y2", "conf")
    rows = staged(rows)  # runs read it apart
    return keyed.replayed(in_runs(rows, _far(s, rows.schema, segment_id=-1, frame_idx=-1)), keyed.keyed_tracks, _place(s, "stm01"))


_EVENTS = "SELECT event_type, event_id, ts, (epoch_us(ts) // 86400000000)::BIGINT AS day FROM events"


@query("stm02_keyed_samples", f"""SELECT event_type AS "group", day, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type, day ORDER BY {drawn_sql('event_type, event_id')}, event_id::VARCHAR) AS r
    FROM ({_EVENTS})) WHERE r <= 20""")
def stm02(s, d):
    """Twenty events of each type and day, those of least draws, as the state holds them when the day has passed."""
    rows = T.read(s, d, "events").select(F.col("event_type").alias("group"), F.col("ts").cast("timestamp").alias("at"), "event_id")
    found = keyed.replayed(in_runs(rows, _far(s, rows.schema, group="")), lambda x: keyed.keyed_samples(x, 20, ["event_id"]), _place(s, "stm02"))
    day = F.floor(F.unix_micros("starts") / 86_400_000_000).cast("long")
    return found.select("group", day.alias("day"), F.get_json_object("item", "$.event_id").cast("long").alias("event_id"))


@query("stm03_stop_sessions", """SELECT track_id, min(us) AS t0, max(us) AS t1 FROM (SELECT *, sum(new) OVER (PARTITION BY track_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS session FROM (
    SELECT *, (us - coalesce(lag(us) OVER (PARTITION BY track_id ORDER BY us), -1e18::BIGINT) > 172800000000)::INTEGER AS new FROM (
    SELECT user_id::INTEGER AS track_id, epoch_us(ts)::BIGINT AS us FROM events WHERE event_id % 29 <> 0 AND (event_id * 11 % 160) / 100::DOUBLE < 0.8::DOUBLE))) GROUP BY track_id, session""")
def stm03(s, d):
    """Sessions of slow rows with steps of up to two days, closed by the watermark."""
    speed = F.when(F.col("event_id") % 29 != 0, (F.col("event_id") * 11 % 160) / 100.0)
    rows = T.read(s, d, "events").select(F.col("user_id").cast("int").alias("track_id"), F.col("ts").cast("timestamp").alias("at"), speed.alias("speed"))
    found = keyed.replayed(in_runs(rows, _far(s, rows.schema, track_id=-1, speed=0.0)), lambda x: presence.stops(x, 0.8, "2 days", "1 hour"), _place(s, "stm03"))
    return found.where("track_id >= 0").select("track_id", F.unix_micros("t0").alias("t0"), F.unix_micros("t1").alias("t1"))


@query("stm04_presence_windows", """SELECT (epoch_us(ts) // 86400000000 * 86400000000)::BIGINT AS start_us, count(*) AS n, avg((event_id % 18)::INTEGER) AS mean FROM events GROUP BY ALL""")
def stm04(s, d):
    """Rows and their mean count by tumbling days over the stream."""
    rows = T.read(s, d, "events").select(F.col("ts").cast("timestamp").alias("at"), (F.col("event_id") % 18).cast("int").alias("n_detections"))
    found = keyed.replayed(in_runs(rows, _far(s, rows.schema)), lambda x: presence.presence(x, "1 day", "1 hour"), _place(s, "stm04"))
    return found.select(F.unix_micros("window_start").alias("start_us"), "n", "mean").where("start_us < 4102444800000000")
