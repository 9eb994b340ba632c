"""Streaming forms of the bounded-state queries: presence by tumbling windows and stops by sessions, both with watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def presence(stream: DataFrame, window: str = "10 seconds", late: str = "30 seconds") -> DataFrame:
    """(window_start, n, mean): frames and mean number of people by window of (at timestamp, n_detections) rows."""
    timed = stream.withWatermark("at", late).groupBy(F.window("at", window).alias("w"))
    return timed.agg(F.count("*").alias("n"), F.avg("n_detections").alias("mean")).select(F.col("w.start").alias("window_start"), "n", "mean")


def stops(stream: DataFrame, slow: float, gap: str = "1 second", late: str = "30 seconds") -> DataFrame:
    """(track_id, t0, t1): sessions of slow rows of (track_id, at, speed); ends are the last row's, not the session's."""
    standing = stream.where(F.col("speed") < slow).withWatermark("at", late)
    sessions = standing.groupBy("track_id", F.session_window("at", gap).alias("w")).agg(F.min("at").alias("t0"), F.max("at").alias("t1"))
    return sessions.select("track_id", "t0", "t1")
