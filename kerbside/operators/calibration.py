"""The gate of a calibration: nine checks, of measured people and of the calibration's document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import degrees, hypot, isfinite

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .gates import agrees, standing
from .metrics import HEIGHT_STEP, slope_interval
from .sequences import exact_median, exact_quantiles

Line = tuple[tuple[float, float], tuple[float, float]]


def separation(a: Line, b: Line) -> tuple[float, float, float]:
    """Of two lines by two points each: the mean of the four distances from a point to the other line, their spread, and the angle in degrees."""

    def away(p: tuple[float, float], line: Line) -> float:
        (x0, y0), (x1, y1) = line
        return abs((x1 - x0) * (p[1] - y0) - (y1 - y0) * (p[0] - x0)) / hypot(x1 - x0, y1 - y0)

    gaps = [away(p, b) for p in a] + [away(p, a) for p in b]
    (u, v) = (np.subtract(line[1], line[0]) for line in (a, b))
    turn = degrees(float(np.arccos(min(1.0, abs(u @ v) / (np.linalg.norm(u) * np.linalg.norm(v))))))
    return sum(gaps) / 4, max(gaps) - min(gaps), turn


def _verdict(fine: bool | None) -> str:
    return "unmeasured" if fine is None else "pass" if fine else "fail"


def document_checks(document: Mapping, limits: Mapping, inputs: Mapping[str, str]) -> list[tuple[str, float | None, str]]:
    """(check, value, standing) of the four checks that need the document alone. A part that it lacks is unmeasured."""
    residuals = document.get("holdout_residual_px")
    worst = max(residuals.values()) if residuals else None

    lines, stored = document.get("facade_baselines"), document.get("street_width")
    width = separation(*lines)[0] if lines else None
    wide = None if width is None else (stored is None or abs(stored - width) <= 1e-3) and abs(width - limits["street_width"]) <= limits["street_width_tolerance"]

    recorded = document.get("inputs_sha256") or {}
    changed = [k for k, sha in recorded.items() if inputs.get(k) != sha]

    def plane(matrix: Sequence, horizon: Sequence | None, corners: float | None) -> int:
        """The number of faults of a homography: values, rank, corners and horizon."""
        h = np.asarray(matrix, dtype=float)
        whole = h.shape == (3, 3) and bool(np.isfinite(h).all())
        return sum((not whole, whole and abs(float(np.linalg.det(h))) < 1e-12, corners is None or not isfinite(corners) or corners > 1e-3, horizon is None or len(horizon) != 3))

    faults = plane(document["homography"], document.get("horizon"), document.get("corner_residual")) if document.get("homography") else None
    return [
        ("vp_holdout", worst, _verdict(None if worst is None else worst <= limits["holdout_px"])),
        ("street_width", width, _verdict(wide)),
        ("inputs", float(len(changed)) if recorded else None, _verdict(not changed if recorded else None)),
        ("ground_plane", None if faults is None else float(faults), _verdict(None if faults is None else faults == 0)),
    ]


def calibration_gate(people: DataFrame, speeds: DataFrame, document: Mapping, limits: Mapping, inputs: Mapping[str, str]) -> DataFrame:
    """(check, value, standing): nine rows. Heights, speeds and their drift are recomputed from the samples, not read from the document.

    ``people`` has heights and depths, ``speeds`` speeds; ``inputs`` are the digests of the inputs as they are now.
    A document's slope must be the recomputed one. The median height sets the scale, so that its check finds gross faults only.
    """
    ends = exact_quantiles(people, "height", HEIGHT_STEP, {"mid": 0.5, "p75": 0.75, "p25": 0.25, "p90": 0.9, "p10": 0.1})
    spread = ends.select("mid", (F.col("p75") - F.col("p25")).alias("iqr"), (F.col("p90") - F.col("p10")).alias("span"))
    heights = people.agg(F.count("height").alias("n")).crossJoin(F.broadcast(spread))
    row = lambda name, value, state: F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), state.alias("standing"))
    mid, iqr, n = F.col("mid"), F.col("iqr"), F.col("n")
    tight = F.when(iqr.isNull(), "unmeasured").when((iqr <= limits["height_iqr"]) & (F.col("span") <= limits["height_span"]), "pass").otherwise("fail")
    of_heights = heights.select(F.inline(F.array(
        row("height_median", mid, standing(mid, *limits["height_median"])), row("height_spread", iqr, tight), row("sample_size", n, standing(n, limits["least_people"], 1 << 60)),
    )))
    pace = F.col("pace")
    of_speeds = exact_median(speeds, "speed", 0.01, name="pace").agg(F.max("pace").alias("pace")).select(F.inline(F.array(row("speed_median", pace, standing(pace, *limits["speed_median"])))))
    slope, stored = F.col("slope"), document.get("height_depth_slope")
    level = F.col("covers_zero") & (F.lit(True) if stored is None else agrees(F.lit(float(stored)), slope))
    of_slope = slope_interval(people, "height", "depth").select(F.inline(F.array(row("depth_slope", slope, F.when(level, "pass").otherwise("fail")))))
    rest = people.sparkSession.createDataFrame(document_checks(document, limits, inputs), "check string, value double, standing string")
    return of_heights.unionByName(of_speeds).unionByName(of_slope).unionByName(rest)
