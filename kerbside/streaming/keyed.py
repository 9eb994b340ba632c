"""Keyed state with timers: tracks of each recording and bounded samples of each group, kept over a stream of rows.

Both work in event time. Rows at or before the watermark are late: Spark drops them before they reach the state, so what has been emitted
never changes. A timer settles a key when the watermark passes it even if the key has no more rows, and clears a key that stays quiet,
so that state is bounded by the keys alive and not by the stream. State is in the checkpoint: a query that stops
and starts again goes on where it was. The state store must be RocksDB's (``STORE``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from ..operators.sampling import SEED, drawn
from ..operators.tracking import BOX, TrackRules, run_lanes
from ..sources.contracts import exists

#: Setting and value of the store that keyed state with timers needs.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _rearm(handle: StatefulProcessorHandle, at: int | None) -> None:
    """Leave a key with one timer, or none."""
    for old in list(handle.listTimers()):
        handle.deleteTimer(old)
    if at is not None:
        handle.registerTimer(at)


class _Tracks(StatefulProcessor):
    """Rows wait until the watermark passes their frame, then the recordings of a key take their frames in order, side by side.

    A key is a share of the recordings. ``waiting`` holds packed rows as they came, ``tracks`` a value a recording.
    """

    ROW = np.dtype([("segment", "<i8"), ("frame", "<i8"), ("ms", "<i8"), ("box", "<f8", 5)])

    def __init__(self, rules: TrackRules, quiet_ms: int):
        self.rules, self.quiet_ms = rules, quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tracks = handle.getMapState("tracks", "segment_id long", "packed binary, names array<long>, started long, last_frame long, last_ms long")
        self.waiting = handle.getListState("waiting", "rows binary")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        """Rows are put by as they come; the timer of the first of them settles them, in this batch or a later one."""
        due = list(self.handle.listTimers())
        for pdf in rows:
            packed = np.empty(len(pdf), self.ROW)
            packed["segment"], packed["frame"], packed["box"] = pdf["segment_id"], pdf["frame_idx"], pdf[BOX].to_numpy("<f8")
            packed["ms"] = pdf["at"].to_numpy("datetime64[ms]").astype("<i8")
            self.waiting.appendValue((packed.tobytes(),))
            due.append(int(packed["ms"].min()))
        _rearm(self.handle, min(due))
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._settle(timerValues.getCurrentWatermarkInMs())

    def _settle(self, now: int) -> pd.DataFrame:
        """Track all waiting frames up to ``now``, forget recordings that are quiet, and set the timer for what comes next."""
        known = {segment: tuple(value) for (segment,), value in self.tracks.iterator()}
        rows = np.concatenate([np.empty(0, self.ROW), *(np.frombuffer(bytes(held), self.ROW) for (held,) in self.waiting.get())])
        segments, lane = np.unique(rows["segment"], return_inverse=True)
        done = np.array([known[k][3] if k in known else np.iinfo(np.int64).min for k in segments.tolist()], np.int64)
        fresh = rows["frame"] > done[lane]  # others came between two watermarks: their frame has been tracked
        rows = rows[fresh]
        if len(rows):  # a frame is ready as a whole
            rows = rows[np.lexsort((rows["frame"], rows["segment"]))]
            begins = np.concatenate(([True], (np.diff(rows["segment"]) != 0) | (np.diff(rows["frame"]) != 0)))
            rows["ms"] = np.maximum.reduceat(rows["ms"], np.flatnonzero(begins))[np.cumsum(begins) - 1]
        ready = rows["ms"] <= now
        left = rows[~ready]
        rows = rows[ready]
        segments, lane = np.unique(rows["segment"], return_inverse=True)
        before = [known.get(k, (b"", [], 0, None, None)) for k in segments.tolist()]
        found, names, gave, started = run_lanes(lane, rows["frame"], np.ascontiguousarray(rows["box"].T), [bytes(v[0]) for v in before], self.rules)
        # Names count on over the runs of a recording: those given are places in its list, others new.
        given = [np.array(list(v[1]), np.int64) for v in before]
        first = np.cumsum([0, *map(len, given)])[:-1]
        base = np.array([v[2] for v in before], np.int64)
        own, listed = lane[found], np.concatenate((*given, [0]))
        names = np.where(names < 0, listed[np.where(names < 0, first[own] - 1 - names, -1)], names + base[own]) if len(names) else names
        last_frame, last_ms = np.full(len(segments), np.iinfo(np.int64).min), np.full(len(segments), np.iinfo(np.int64).min)
        np.maximum.at(last_frame, lane, rows["frame"])
        np.maximum.at(last_ms, lane, np.where(rows["frame"] == last_frame[lane], rows["ms"], np.iinfo(np.int64).min))
        for k, segment in enumerate(segments.tolist()):
            packed, idents = gave[k]
            known[segment] = (packed, [int(given[k][-1 - i]) if i < 0 else int(i + base[k]) for i in idents], int(base[k] + started[k]), int(last_frame[k]), int(last_ms[k]))
            self.tracks.updateValue((segment,), known[segment])
        if len(rows) or not fresh.all():
            self.waiting.clear()
            if len(left):
                self.waiting.appendValue((left.tobytes(),))
        busy = set(left["segment"].tolist())
        for segment in [k for k, v in known.items() if k not in busy and v[4] + self.quiet_ms <= now]:
            self.tracks.removeKey((segment,))
            del known[segment]
        times = [*([int(left["ms"].min())] if len(left) else []), *(v[4] + self.quiet_ms for k, v in known.items() if k not in busy)]
        _rearm(self.handle, min(times) if times else None)
        boxes = rows["box"][found]
        return pd.DataFrame({"segment_id": rows["segment"][found], "track_id": names.astype("int32"), "frame_idx": rows["frame"][found]} | {c: boxes[:, k] for k, c in enumerate(BOX)})

    def close(self) -> None:
        pass


def keyed_tracks(stream: DataFrame, *, late: str = "2 seconds", quiet_ms: int = 60_000, rules: TrackRules = TrackRules(), shares: int = 64) -> DataFrame:
    """(segment_id, track_id, frame_idx, x1, y1, x2, y2, conf) of a stream of (segment_id, at, frame_idx, x1, y1, x2, y2, conf) rows.

    A row whose box is null stands for a frame without boxes. Frames of a segment are tracked in order once the watermark, ``late`` behind
    the newest row, has passed them; rows behind the watermark are dropped. Segments are dealt to ``shares`` keys, so that a step tracks a frame of
    each of a key's; a checkpoint keeps their number. A segment without frames for ``quiet_ms`` of event time loses
    its tracks; if it comes back it starts afresh, with numbers from 1. Without late rows and such pauses the rows are those
    of ``tracking.track`` over the same keys.
    """
    dealt = stream.withColumn("share", F.pmod(F.xxhash64("segment_id"), F.lit(shares)))
    rows = dealt.withWatermark("at", late).groupBy("share")
    out = "segment_id long, track_id int, frame_idx long, x1 double, y1 double, x2 double, y2 double, conf double"
    return rows.transformWithStateInPandas(_Tracks(rules, quiet_ms), outputStructType=out, outputMode="Append", timeMode="EventTime")


class _Sample(StatefulProcessor):
    """The rows of least draws so far; emitted and forgotten when the watermark passes the group's end."""

    def __init__(self, size: int, columns: list[str]):
        self.size, self.columns = size, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "draws array<string>, items array<string>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        kept = set(zip(*self.held.get(), strict=True)) if self.held.exists() else set()
        for pdf in rows:
            kept = set(sorted(kept.union(zip(pdf["draw"], pdf["item"], strict=True)))[: self.size])
            _rearm(self.handle, int(pdf["ends"].iloc[0].timestamp() * 1000))
        self.held.update(tuple(list(c) for c in zip(*sorted(kept), strict=True)))
        yield from ()

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.held.exists():
            yield pd.DataFrame([(*key, draw, item) for draw, item in zip(*self.held.get(), strict=True)], columns=self.columns)
            self.held.clear()

    def close(self) -> None:
        pass


def keyed_samples(stream: DataFrame, size: int, keys: list[str], *, window: str = "1 day", late: str = "1 hour", seed: int = SEED) -> DataFrame:
    """(group, starts, draw, item): of each group and window of a stream of (group, at, ...) rows the ``size`` rows of least draws.

    Draws hash the group and ``keys``, as in ``sampling.reservoir``, so that any order of arrival picks the same rows; ``item`` is
    the keys as JSON, and a row that is repeated counts once. A sample leaves when the watermark passes its window's end, and its state with it.
    """
    timed = stream.withWatermark("at", late).select("at", "group", F.window("at", window).alias("w"), drawn(["group", *keys], seed).alias("draw"), F.to_json(F.struct(*keys)).alias("item"))
    rows = timed.select("at", "group", F.col("w.start").alias("starts"), F.col("w.end").alias("ends"), "draw", "item").groupBy("group", "starts")
    group = stream.schema["group"].dataType.simpleString()
    columns = ["group", "starts", "draw", "item"]
    out = f"group {group}, starts timestamp, draw string, item string"
    return rows.transformWithStateInPandas(_Sample(size, columns), outputStructType=out, outputMode="Append", timeMode="EventTime")


def replayed(chunks: list[DataFrame], plan, path: str) -> DataFrame:
    """Rows of ``plan`` over ``chunks`` as a stream of files, one after another, each by a run of its own from the checkpoint of the one before.

    ``plan`` turns the stream into the result. Files, checkpoint and result lie below ``path``, which all executors share.
    """
    spark = chunks[0].sparkSession
    source, sink = f"{path}/source", f"{path}/sink"
    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)
    try:
        for chunk in chunks:
            chunk.write.mode("append").parquet(source)
            # All files of a chunk at once: files have no order of time within it.
            result = plan(spark.readStream.schema(chunk.schema).option("maxFilesPerTrigger", 2**31 - 1).parquet(source))
            run = result.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").option("path", sink).trigger(availableNow=True).start()
            run.awaitTermination()
    finally:
        spark.conf.unset(STORE[0]) if before is None else spark.conf.set(STORE[0], before)
    # A stream that never had a row has written nothing.
    return spark.read.schema(result.schema).parquet(sink) if exists(spark, sink) else spark.createDataFrame([], result.schema)
