"""Multi-object tracking of boxes: two rounds of association by overlap, after ByteTrack (Zhang et al., 2022).

Confident boxes are matched to predicted tracks first, then weak boxes to tracks still unmatched; only confident leftovers start
tracks. A recording is sequential, yet its segments run in parallel: each starts from a guess of the tracks that it takes over, and those
whose guess was not what the segment before handed on run again, until none is left. The result is that of one run over all frames.
Within a task, segments are lanes that take their frames side by side, so that a step of arrays serves a frame of each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged


@dataclass(frozen=True)
class TrackRules:
    high: float = 0.5
    low: float = 0.1
    new: float = 0.6
    keep: int = 30
    #: Least overlap of a match: one less the distance limit of 0.8, and of the second round.
    overlap: float = 0.2
    weak_overlap: float = 0.5


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """IoU of all pairs of boxes x1, y1, x2, y2."""
    low, high = np.maximum(a[:, None, :2], b[None, :, :2]), np.minimum(a[:, None, 2:], b[None, :, 2:])
    both = np.prod(np.clip(high - low, 0, None), axis=2)
    area = lambda x: np.prod(x[:, 2:] - x[:, :2], axis=1)
    return both / np.maximum(area(a)[:, None] + area(b)[None, :] - both, 1e-9)


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Least-cost assignment of a rectangular matrix, by successive shortest augmenting paths with potentials."""
    flipped = cost.shape[0] > cost.shape[1]
    c = cost.T if flipped else cost
    n, m = c.shape
    u, v, owner = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for row in range(1, n + 1):
        owner[0], at = row, 0
        least, came, seen = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            seen[at] = True
            reduced = c[owner[at] - 1] - u[owner[at]] - v[1:]
            better = ~seen[1:] & (reduced < least[1:])
            least[1:][better], came[1:][better] = reduced[better], at
            nxt = 1 + int(np.where(seen[1:], np.inf, least[1:]).argmin())
            step = least[nxt]
            u[owner[seen]] += step
            v[seen] -= step
            least[~seen] -= step
            at = nxt
            if not owner[at]:
                break
        while at:
            owner[at], at = owner[came[at]], came[at]
    pairs = [(int(owner[j]) - 1, j - 1) for j in range(1, m + 1) if owner[j]]
    return [(b, a) for a, b in pairs] if flipped else pairs


def sparse_assign(gain: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of the assignment of largest gain that have any, by connected components of the positive entries.

    Entries of 0 join nothing, so components are solved apart; most have one pair.
    """
    rows, cols = np.nonzero(gain > 0)
    if len(rows) < 2:
        return list(zip(rows.tolist(), cols.tolist(), strict=True))
    named: dict[int, int] = {}

    def top(k: int) -> int:
        while (up := named.setdefault(k, k)) != k:
            named[k] = k = named[up]
        return k

    # Columns are named below zero.
    for a, b in zip(rows.tolist(), (-1 - cols).tolist(), strict=True):
        named[top(a)] = top(b)
    parts: dict[int, tuple[list[int], list[int]]] = {}
    for k in sorted(named):
        parts.setdefault(top(k), ([], []))[k < 0].append(k if k >= 0 else -1 - k)
    pairs = []
    for a, b in parts.values():
        if len(a) == len(b) == 1:
            pairs.append((a[0], b[0]))
        else:
            b.sort()
            pairs += [(a[i], b[j]) for i, j in assign(-gain[np.ix_(a, b)]) if gain[a[i], b[j]] > 0]
    return sorted(pairs)


#: Decimals kept of a track's state, so that runs which saw the same boxes for a while hold the same numbers.
DECIMALS = 6


class Tracker:
    """The tracks alive, as arrays with a row a track, and one step a frame.

    A box's centre, width and height move with constant speed and share one filter covariance, as they share their noise. Rows are
    kept in an order of what they hold, so that their history before does not matter. ``ident`` names a track: the number of its
    start in this run from 1, or -1 - k for row k of the state that it was given.
    """

    def __init__(self, rules: TrackRules, packed: bytes = b""):
        held = np.frombuffer(packed, "<f8").reshape(-1, 12)
        self.rules, self.started = rules, 0
        self.mean, self.var, self.seen = held[:, :8].copy(), held[:, 8:11].copy(), held[:, 11].astype(np.int64)
        self.ident = -1 - np.arange(len(held), dtype=np.int64)

    def packed(self) -> bytes:
        """The state without names, for a run that goes on from here."""
        return np.column_stack((self.mean, self.var, self.seen)).astype("<f8").tobytes()

    def _keep(self, rows: np.ndarray) -> None:
        self.mean, self.var, self.seen, self.ident = self.mean[rows], self.var[rows], self.seen[rows], self.ident[rows]

    def _predict(self) -> np.ndarray:
        """Move all tracks on by a frame; their boxes."""
        place, speed = (self.mean[:, 3] / 20) ** 2, (self.mean[:, 3] / 160) ** 2
        self.mean[:, :4] += self.mean[:, 4:]
        pp, pv, vv = self.var.T
        self.var = np.column_stack((pp + 2 * pv + vv + place, pv + vv, vv + speed))
        centre, half = self.mean[:, :2], self.mean[:, 2:4] / 2
        return np.hstack((centre - half, centre + half))

    def _update(self, rows: np.ndarray, seen: np.ndarray, frame: int) -> None:
        pp, pv, vv = self.var[rows].T
        gain = pp / (pp + (self.mean[rows, 3] / 20) ** 2)
        lift = pv / (pp + (self.mean[rows, 3] / 20) ** 2)
        off = seen - self.mean[rows, :4]
        self.mean[rows] += np.hstack((gain[:, None] * off, lift[:, None] * off))
        self.var[rows] = np.column_stack((pp - gain * pp, pv - gain * pv, vv - lift * pv))
        self.seen[rows] = frame

    def step(self, frame: int, boxes: np.ndarray) -> list[tuple[int, int]]:
        """(row of ``boxes``, name of its track) of the boxes x1, y1, x2, y2, conf that belong to a track."""
        rules, conf = self.rules, boxes[:, 4]
        size = boxes[:, 2:4] - boxes[:, :2]
        centred = np.hstack((boxes[:, :2] + size / 2, size))
        places = self._predict()
        strong, weak = np.flatnonzero(conf >= rules.high), np.flatnonzero((conf >= rules.low) & (conf < rules.high))
        free, out = np.arange(len(places)), []
        for k, (picked, limit) in enumerate(((strong, rules.overlap), (weak, rules.weak_overlap))):
            if not len(picked) or not len(free):
                continue
            iou = overlaps(places[free], boxes[picked, :4])
            pairs = [(a, b) for a, b in sparse_assign(iou) if iou[a, b] >= limit]
            if not pairs:
                continue
            mine, theirs = (list(x) for x in zip(*pairs, strict=True))
            self._update(free[mine], centred[picked[theirs]], frame)
            out += zip(picked[theirs].tolist(), self.ident[free[mine]].tolist(), strict=True)
            free = np.delete(free, mine)
            if k == 0:
                strong = np.delete(strong, theirs)
        new = strong[conf[strong] >= rules.new]
        if len(new):
            names = self.started + 1 + np.arange(len(new))
            self.started += len(new)
            place, speed = 4 * (centred[new, 3] / 20) ** 2, 4 * (centred[new, 3] / 160) ** 2
            self.mean = np.vstack((self.mean, np.hstack((centred[new], np.zeros((len(new), 4))))))
            self.var = np.vstack((self.var, np.column_stack((place, np.zeros(len(new)), speed))))
            self.seen, self.ident = np.append(self.seen, np.full(len(new), frame)), np.append(self.ident, names)
            out += zip(new.tolist(), names.tolist(), strict=True)
        self.mean, self.var = self.mean.round(DECIMALS), self.var.round(DECIMALS)
        alive = np.flatnonzero(frame - self.seen <= rules.keep)
        order = np.lexsort((*self.mean[alive].T[::-1], self.seen[alive]))
        self._keep(alive[order])
        return out


def track_boxes(frames: list[tuple[int, np.ndarray]], rules: TrackRules = TrackRules()) -> list[tuple[int, int, int]]:
    """(frame, row of its boxes, track) of boxes x1, y1, x2, y2, conf in frames in order, those without boxes included."""
    tracker = Tracker(rules)
    return [(frame, i, t) for frame, rows in frames for i, t in tracker.step(frame, rows)]


class Lanes:
    """Trackers side by side, each with its own frames; a step takes a frame of every lane. Tracks, boxes and names are those of ``Tracker``.

    A column a track: the eight of its mean, then the three of its variance. Columns stand by lanes, and in an order of what they hold
    only where it counts: where several tracks and boxes overlap, and in what a lane hands on.
    """

    def __init__(self, rules: TrackRules, states: list[bytes]):
        held = [np.frombuffer(p, "<f8").reshape(-1, 12) for p in states]
        sizes = np.array([len(h) for h in held], np.int64)
        rows = np.concatenate(held) if held else np.empty((0, 12))
        self.rules, self.started = rules, np.zeros(len(states), np.int64)
        self.lane = np.repeat(np.arange(len(states), dtype=np.int32), sizes)
        self.state, self.seen = rows[:, :11].T.copy(), rows[:, 11].astype(np.int64)
        self.ident = -1 - (np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes))

    def _keep(self, columns: np.ndarray) -> None:
        self.lane, self.state, self.seen, self.ident = self.lane[columns], self.state[:, columns], self.seen[columns], self.ident[columns]

    def leave(self, lanes: np.ndarray) -> Iterator[tuple[int, bytes, list[int]]]:
        """(lane, its state packed, its names in that order) of ``lanes``, whose tracks are then gone from here."""
        own = np.flatnonzero(np.isin(self.lane, lanes))
        own = own[np.lexsort((*self.state[:, own][::-1], self.seen[own], self.lane[own]))]
        packed = np.column_stack((*self.state[:, own], self.seen[own])).astype("<f8")
        ends = np.searchsorted(self.lane[own], lanes, side="right")
        for lane, first, last in zip(lanes.tolist(), np.searchsorted(self.lane[own], lanes).tolist(), ends.tolist(), strict=True):
            yield lane, packed[first:last].tobytes(), self.ident[own[first:last]].tolist()
        self._keep(np.flatnonzero(~np.isin(self.lane, lanes)))

    def _chosen(self, track: np.ndarray, box: np.ndarray, gain: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Pairs of the assignment of largest gain. A pair apart from all others is in it, and of one track or box with several others the best pair."""
        tracks, boxes = np.bincount(track), np.bincount(box)
        many_boxes, many_tracks = tracks[track] > 1, boxes[box] > 1
        alone = np.flatnonzero(~many_boxes & ~many_tracks)
        rest = np.flatnonzero(many_boxes | many_tracks)
        if not len(rest):
            return alone
        chosen, hard = [alone], np.ones(len(rest), bool)
        for hub, leaf_shared, hub_shared in ((box, many_boxes, many_tracks), (track, many_tracks, many_boxes)):
            tied = np.bincount(hub[rest], weights=leaf_shared[rest]) > 0
            star = np.flatnonzero(hub_shared[rest] & ~tied[hub[rest]])
            if not len(star):
                continue
            own = rest[star]
            order = np.lexsort((-gain[own], hub[own]))
            own = own[order]
            first = np.concatenate(([True], hub[own][1:] != hub[own][:-1]))
            # Best pairs of equal gain are left to the order of what tracks hold.
            equal = np.zeros(len(own), bool)
            equal[:-1] = first[:-1] & (gain[own][:-1] == gain[own][1:])
            fine = ~equal[np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))]
            chosen.append(own[first & fine])
            hard[star[order[fine]]] = False
        chosen.append(np.array(self._solved(rest[hard], track, box, gain, before), np.int64))
        return np.concatenate(chosen)

    def _solved(self, pairs: np.ndarray, track: np.ndarray, box: np.ndarray, gain: np.ndarray, before: np.ndarray) -> list[int]:
        named: dict[int, int] = {}

        def top(k: int) -> int:
            while (up := named.setdefault(k, k)) != k:
                named[k] = k = named[up]
            return k

        listed = list(zip(pairs.tolist(), track[pairs].tolist(), box[pairs].tolist(), strict=True))
        for _, a, b in listed:
            named[top(a)] = top(-1 - b)
        parts: dict[int, dict[tuple[int, int], int]] = {}
        for pair, a, b in listed:
            parts.setdefault(top(a), {})[a, b] = pair
        found = []
        for part in parts.values():
            own = sorted({a for a, _ in part}, key=lambda a: (self.seen[a], *before[:, a].tolist()))
            theirs = sorted({b for _, b in part})
            matrix = np.zeros((len(own), len(theirs)))
            for (a, b), pair in part.items():
                matrix[own.index(a), theirs.index(b)] = gain[pair]
            found += [part[own[i], theirs[j]] for i, j in assign(-matrix) if matrix[i, j] > 0]
        return found

    def step(self, frame: np.ndarray, lane: np.ndarray, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``boxes``, names of their tracks) of the boxes x1, y1, x2, y2, conf, a column each and by lanes, that belong to a track. ``frame`` is a number a lane."""
        rules, s, own = self.rules, self.state, self.lane
        before = s[:8].copy()
        place, speed = (s[3] / 20) ** 2, (s[3] / 160) ** 2
        s[:4] += s[4:8]
        pp, pv, vv = s[8:]
        s[8], s[9], s[10] = pp + 2 * pv + vv + place, pv + vv, vv + speed
        half = s[2:4] / 2
        low, high = s[:2] - half, s[:2] + half
        area = np.prod(high - low, axis=0)
        conf, size = boxes[4], boxes[2:4] - boxes[:2]
        centred, its_area = np.vstack((boxes[:2] + size / 2, size)), np.prod(size, axis=0)
        strong = conf >= rules.high
        free, taken = np.ones(len(own), bool), np.zeros(len(conf), bool)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for mask, limit in ((strong, rules.overlap), ((conf >= rules.low) & ~strong, rules.weak_overlap)):
            picked, rows = np.flatnonzero(mask), np.flatnonzero(free)
            counts = np.bincount(own[rows], minlength=len(self.started))
            first, each = np.cumsum(counts) - counts, counts[lane[picked]]
            track = rows[np.arange(each.sum()) + np.repeat(first[lane[picked]] - (np.cumsum(each) - each), each)]
            box = np.repeat(picked, each)
            both = np.ones(len(track))
            for axis in (0, 1):  # pairs apart on one axis are not looked at on the other
                side = np.minimum(high[axis, track], boxes[2 + axis, box]) - np.maximum(low[axis, track], boxes[axis, box])
                near = np.flatnonzero(side > 0)
                track, box, both = track[near], box[near], both[near] * side[near]
            iou = both / np.maximum(area[track] + its_area[box] - both, 1e-9)
            pairs = self._chosen(track, box, iou, before) if len(track) else np.empty(0, np.int64)
            pairs = pairs[iou[pairs] >= limit]
            if not len(pairs):
                continue
            mine, theirs = track[pairs], box[pairs]
            pp, pv, vv = s[8:, mine]
            noise = (s[3, mine] / 20) ** 2
            gain, lift = pp / (pp + noise), pv / (pp + noise)
            off = centred[:, theirs] - s[:4, mine]
            s[:4, mine] += gain * off
            s[4:8, mine] += lift * off
            s[8, mine], s[9, mine], s[10, mine] = pp - gain * pp, pv - gain * pv, vv - lift * pv
            self.seen[mine] = frame[own[mine]]
            free[mine], taken[theirs] = False, True
            out.append((theirs, self.ident[mine]))
        new = np.flatnonzero(strong & ~taken & (conf >= rules.new))
        if len(new):
            counts = np.bincount(lane[new], minlength=len(self.started))
            names = self.started[lane[new]] + 1 + np.arange(len(new)) - (np.cumsum(counts) - counts)[lane[new]]
            self.started += counts
            nothing = np.zeros(len(new))
            place, speed = 4 * (centred[3, new] / 20) ** 2, 4 * (centred[3, new] / 160) ** 2
            self.state = np.hstack((s, np.vstack((centred[:, new], *[nothing] * 4, place, nothing, speed))))
            self.lane, self.seen, self.ident = np.append(own, lane[new]), np.append(self.seen, frame[lane[new]]), np.append(self.ident, names)
            out.append((new, names))
        self.state = self.state.round(DECIMALS)
        alive = np.flatnonzero(frame[self.lane] - self.seen <= rules.keep)
        self._keep(alive[np.argsort(self.lane[alive], kind="stable")])
        return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.empty(0, np.int64), np.empty(0, np.int64))


def run_lanes(lane: np.ndarray, frame: np.ndarray, boxes: np.ndarray, states: list[bytes], rules: TrackRules = TrackRules()) -> tuple[np.ndarray, np.ndarray, list[tuple[bytes, list[int]]], np.ndarray]:
    """(rows with a track, its names, what each lane hands on, how many tracks it started) of rows with their lane, frame and box, a box a column; a row without a box stands for its frame."""
    order = np.lexsort((*boxes[3::-1], -boxes[4], frame, lane))
    lane, frame, boxes = lane[order].astype(np.int32), frame[order], boxes[:, order]
    begins = np.ones(len(lane), bool)
    begins[1:] = (lane[1:] != lane[:-1]) | (frame[1:] != frame[:-1])
    starts = np.flatnonzero(begins)
    lengths = np.bincount(lane[starts], minlength=len(states))
    turn = np.arange(len(starts)) - (np.cumsum(lengths) - lengths)[lane[starts]]
    row_turn = turn[np.cumsum(begins) - 1] if len(lane) else turn
    # Frames and boxes by turns, in a turn by lanes.
    listed = np.argsort(turn, kind="stable")
    held = np.flatnonzero(~np.isnan(boxes[0]))
    held = held[np.argsort(row_turn[held], kind="stable")]
    turns = np.arange(lengths.max(initial=0) + 1)
    frames_at, boxes_at = np.searchsorted(turn[listed], turns).tolist(), np.searchsorted(row_turn[held], turns).tolist()
    tracker, now = Lanes(rules, states), np.zeros(len(states), np.int64)
    rows, names, left = [], [], {}
    for t in turns.tolist():
        ended = np.flatnonzero(lengths == t)
        if len(ended):
            left |= {k: (packed, given) for k, packed, given in tracker.leave(ended)}
        if t == len(turns) - 1:
            break
        some, own = starts[listed[frames_at[t] : frames_at[t + 1]]], held[boxes_at[t] : boxes_at[t + 1]]
        now[lane[some]] = frame[some]
        found, named = tracker.step(now, lane[own], boxes[:, own])
        rows.append(order[own[found]])
        names.append(named)
    none = np.empty(0, np.int64)
    return np.concatenate((none, *rows)), np.concatenate((none, *names)), [left[k] for k in range(len(states))], tracker.started


BOX = ["x1", "y1", "x2", "y2", "conf"]
_ROWS = "segment_id long, track_id int, frame_idx long, x1 double, y1 double, x2 double, y2 double, conf double"
#: What a run of a segment gives: its boxes with their tracks (`frame_idx` set), and one row with the state that it hands on.
_RUN = f"{_ROWS}, took string, gave string, packed binary, names array<long>"
#: Rows of segments that a task takes at once.
AT_ONCE = 400_000


def frames_in_order(pdf: pd.DataFrame) -> list[tuple[int, np.ndarray]]:
    """Frames with their boxes from (frame_idx, x1, y1, x2, y2, conf) rows, boxes by confidence; a row without a box stands for its frame."""
    pdf = pdf.sort_values(["frame_idx", "conf", "x1", "y1", "x2", "y2"], ascending=[True, False, True, True, True, True])
    at, boxes = pdf["frame_idx"].to_numpy(), pdf[BOX].to_numpy(float)
    starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else []
    return [(int(at[k]), own[~np.isnan(own[:, 0])]) for k, own in zip(starts, np.split(boxes, starts[1:]), strict=True)] if len(at) else []


def _by_segment(detections: DataFrame, frames: DataFrame, segment: int) -> DataFrame:
    rows = frames.select("frame_idx").join(detections.select("frame_idx", *BOX), "frame_idx", "left")
    return rows.withColumn("segment_id", F.floor(F.col("frame_idx") / segment))


def _whole_segments(batches: Iterator[pa.RecordBatch], at_once: int = AT_ONCE) -> Iterator[pa.Table]:
    """Rows in order of segments, in tables of whole segments of some ``at_once`` rows together, or of one that has more."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) < at_once:
            continue
        table = pa.Table.from_batches(waiting)
        segments = table.column("segment_id").to_numpy()
        cut = int(np.searchsorted(segments, segments[-1]))
        if cut:
            yield table.slice(0, cut)
            waiting = table.slice(cut).combine_chunks().to_batches()
    if waiting:
        yield pa.Table.from_batches(waiting)


def _lanes_of(table: pa.Table, rules: TrackRules):
    """(segments, their states or none, the rows that are frames, and what ``run_lanes`` finds of them) of a table of whole segments; a row without a frame holds a state."""
    every = table.column("segment_id").to_numpy()
    at = np.flatnonzero(table.column("frame_idx").is_valid().to_numpy())
    segments, lane = np.unique(every[at], return_inverse=True)
    given: dict[int, bytes] = {}
    if "packed" in table.column_names:
        states = table.filter(table.column("packed").is_valid()).select(["segment_id", "packed"])
        given = dict(zip(*(c.to_pylist() for c in states.columns), strict=True))
    states = [given.get(k, b"") for k in segments.tolist()]
    own = table.take(pa.array(at))
    frame = own.column("frame_idx").to_numpy()
    boxes = np.vstack([own.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in BOX]) if len(at) else np.empty((5, 0))
    return segments, states, lane, frame, boxes, *run_lanes(lane, frame, boxes, states, rules)


def _found(segments, lane, frame, boxes, rows, names) -> list[pa.Array]:
    return [pa.array(segments[lane[rows]], pa.int64()), pa.array(names, pa.int32()), pa.array(frame[rows], pa.int64()), *(pa.array(c[rows]) for c in boxes)]


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _together(rows: DataFrame) -> DataFrame:
    return rows.repartition("segment_id").sortWithinPartitions("segment_id")


def track(detections: DataFrame, frames: DataFrame, segment: int, rules: TrackRules = TrackRules()) -> DataFrame:
    """(segment_id, track_id, frame_idx, x1, y1, x2, y2, conf): tracks within segments of ``segment`` frames.

    Tracks are numbered within a segment and start afresh in each. A task holds some ``AT_ONCE`` rows, or those of one segment.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_segments(batches):
            segments, _, lane, frame, boxes, rows, names, *_ = _lanes_of(table, rules)
            yield pa.RecordBatch.from_arrays(_found(segments, lane, frame, boxes, rows, names), names=_names(_ROWS))

    return _together(_by_segment(detections, frames, segment)).mapInArrow(run, _ROWS)


def _before(segments: DataFrame, span: int = 4096) -> DataFrame:
    """(segment_id, before): the last segment with frames before each one. Segments are ordered within spans, and spans by one row each."""
    placed = segments.withColumn("span", F.floor(F.col("segment_id") / span))
    ends = placed.groupBy("span").agg(F.max("segment_id").alias("last")).withColumn("carried", F.lag("last").over(Window.orderBy("span"))).drop("last")
    own = F.lag("segment_id").over(Window.partitionBy("span").orderBy("segment_id"))
    return placed.withColumn("own", own).join(ends, "span").select("segment_id", F.coalesce("own", "carried").alias("before"))


def track_across(detections: DataFrame, frames: DataFrame, segment: int, warm: int = 60, rules: TrackRules = TrackRules()) -> DataFrame:
    """The tracks of one run over all frames; ``segment_id`` is the segment in which a track starts, ``track_id`` its number there.

    Segments run in parallel from guessed states. A segment whose state was not, to the last bit, what the segment before hands on runs
    again from that, until all agree: tracks that are the same for a while make the states agree, so later rounds have few segments, and
    at worst one more is settled each round. The first guess comes from the ``warm`` frames before a segment; it decides how
    many run again and nothing else. A segment's frames, and the tracks alive at its ends, bound what a task holds.
    """
    rows = staged(_by_segment(detections, frames, segment))
    late = rows.where(F.pmod("frame_idx", F.lit(segment)) >= segment - warm)

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_segments(batches):
            segments, *_, left, _ = _lanes_of(table, rules)
            yield pa.RecordBatch.from_arrays([pa.array(segments + 1), pa.array([packed for packed, _ in left], pa.binary())], names=["segment_id", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda packed: hashlib.sha256(packed).hexdigest()
        for table in _whole_segments(batches):
            segments, given, lane, frame, boxes, found, names, left, _ = _lanes_of(table, rules)
            n, ends = len(found), len(segments)
            none = [pa.nulls(n, kind) for kind in (pa.string(), pa.string(), pa.binary(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*_found(segments, lane, frame, boxes, found, names), *none], names=_names(_RUN))
            empty = [pa.nulls(ends, kind) for kind in (pa.int32(), pa.int64(), *[pa.float64()] * 5)]
            gave = [pa.array([sha(p) for p in given]), pa.array([sha(p) for p, _ in left]), pa.array([p for p, _ in left], pa.binary()), pa.array([k for _, k in left], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(segments, pa.int64()), *empty, *gave], names=_names(_RUN))

    def runs(some: DataFrame, states: DataFrame, turn: int) -> DataFrame:
        given = states.where("packed IS NOT NULL").select("segment_id", "packed")
        made = _together(some.unionByName(given, allowMissingColumns=True)).mapInArrow(run, _RUN)
        return staged(made.withColumn("turn", F.lit(turn)))

    states = _together(late).mapInArrow(guess, "segment_id long, packed binary")
    done = [runs(rows, states, 0)]
    before = staged(_before(rows.select("segment_id").distinct()))
    while True:
        every = done[0]
        for more in done[1:]:
            every = every.unionByName(more)
        ends = every.where("took IS NOT NULL").groupBy("segment_id").agg(F.max_by(F.struct("took", "gave", "packed", "names", "turn"), "turn").alias("end")).select("segment_id", "end.*")
        handed = ends.select(F.col("segment_id").alias("before"), F.col("gave").alias("given"), "packed")
        nothing = F.lit(hashlib.sha256(b"").hexdigest())
        checked = ends.select("segment_id", "took").join(before, "segment_id").join(handed, "before", "left")
        todo = staged(checked.where(F.col("took") != F.coalesce("given", nothing)).select("segment_id", "packed"))
        if todo.isEmpty():
            break
        done.append(runs(rows.join(todo.select("segment_id"), "segment_id", "left_semi"), todo, len(done)))
    ends = staged(ends)
    found = every.where("frame_idx IS NOT NULL").join(ends.select("segment_id", "turn"), ["segment_id", "turn"], "left_semi")
    # A taken-over track is row -1 - track_id of what the segment before gave, and has the name that it gave it.
    gave = ends.select(F.col("segment_id").alias("before"), F.posexplode("names").alias("k", "name"))
    links = gave.join(before, "before").select("segment_id", (-1 - F.col("k")).cast("int").alias("track_id"), F.col("before").alias("to_segment"), F.col("name").cast("int").alias("to_track"))
    named = found.join(_starts(links), ["segment_id", "track_id"], "left")
    return named.select(
        F.coalesce("to_segment", "segment_id").alias("segment_id"), F.coalesce("to_track", "track_id").alias("track_id"), "frame_idx", *BOX
    )


def _starts(links: DataFrame) -> DataFrame:
    """Each linked track's first one. Pointers double their reach each round, so rounds grow with the logarithm of a track's segments."""
    links = staged(links)
    while True:
        onward = links.select(F.col("segment_id").alias("to_segment"), F.col("track_id").alias("to_track"), F.col("to_segment").alias("far_segment"), F.col("to_track").alias("far_track"))
        moved = links.join(onward, ["to_segment", "to_track"], "left")
        if moved.where("far_segment IS NOT NULL").isEmpty():
            return links
        links = staged(moved.select("segment_id", "track_id", F.coalesce("far_segment", "to_segment").alias("to_segment"), F.coalesce("far_track", "to_track").alias("to_track")))
