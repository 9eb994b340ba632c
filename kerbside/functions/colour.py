"""Colour classes and white balance."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .angles import hue_distance

# Thresholds of the achromatic classes, and the classes' half-open hue ranges on [0, 180).
BLACK_V, GREY_S, WHITE_V = 55.0, 45.0, 185.0
HUES = [("red", 0, 10), ("orange", 10, 22), ("yellow", 22, 33), ("green", 33, 85), ("blue", 85, 130), ("purple", 130, 160), ("pink", 160, 170), ("red", 170, 180)]
MATCH_HUE, MATCH_SATURATION = 6.0, 0.25


def colour_class(h: Column, s: Column, v: Column) -> Column:
    """The class of a colour: dark and pale ones first, as their hue is noise."""
    out = F.when(v <= BLACK_V, "black").when((s <= GREY_S) & (v >= WHITE_V), "white").when(s <= GREY_S, "grey")
    for name, low, high in HUES:
        out = out.when((h >= low) & (h < high), name)
    return out.otherwise("other")


def colour_class_sql(h: str = "h", s: str = "s", v: str = "v") -> str:
    hues = " ".join(f"WHEN {h} >= {a} AND {h} < {b} THEN '{n}'" for n, a, b in HUES)
    return f"CASE WHEN {v} <= {BLACK_V} THEN 'black' WHEN {s} <= {GREY_S} AND {v} >= {WHITE_V} THEN 'white' WHEN {s} <= {GREY_S} THEN 'grey' {hues} ELSE 'other' END"


def saturation_ratio(s: Column, background: Column) -> Column:
    return (s + 1.0) / (background + 1.0)


def matches_background(h: Column, s: Column, bg_h: Column, bg_s: Column) -> Column:
    """Whether a colour is that of the light rather than of the garment."""
    return (hue_distance(h, bg_h) < MATCH_HUE) & (F.abs(saturation_ratio(s, bg_s) - 1.0) < MATCH_SATURATION)


def bgr_to_hsv(b: Column, g: Column, r: Column) -> tuple[Column, Column, Column]:
    """8-bit HSV with hue in [0, 180), rounded half up."""
    top, low = F.greatest(b, g, r), F.least(b, g, r)
    span = (top - low).cast("double")
    turn = F.when(span == 0, 0.0).when(top == r, 60.0 * (g - b) / span).when(top == g, 120.0 + 60.0 * (b - r) / span).otherwise(240.0 + 60.0 * (r - g) / span)
    hue = F.pmod(F.floor(F.pmod(turn, F.lit(360.0)) / 2.0 + 0.5), F.lit(180)).cast("int")
    return hue, F.when(top == 0, 0).otherwise(F.floor(span * 255.0 / top + 0.5)).cast("int"), top.cast("int")


# The same on arrays, for pixels that are not worth a row each.
CLASSES = ["black", "white", "grey", *dict.fromkeys(n for n, _, _ in HUES), "other"]


def class_codes(h: np.ndarray, s: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Places in ``CLASSES`` of the classes of colours."""
    code = CLASSES.index
    tests = [v <= BLACK_V, (s <= GREY_S) & (v >= WHITE_V), s <= GREY_S, *((h >= low) & (h < high) for _, low, high in HUES)]
    return np.select(tests, [*map(code, ("black", "white", "grey")), *(code(n) for n, _, _ in HUES)], code("other"))


def hsv_of(bgr: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit HSV of an array whose last axis is blue, green and red."""
    b, g, r = (bgr[..., k].astype(float) for k in range(3))
    top, low = np.maximum(np.maximum(b, g), r), np.minimum(np.minimum(b, g), r)
    span = top - low
    some = np.where(span == 0, 1.0, span)
    turn = np.where(top == r, 60.0 * (g - b) / some, np.where(top == g, 120.0 + 60.0 * (b - r) / some, 240.0 + 60.0 * (r - g) / some))
    hue = np.floor(np.where(span == 0, 0.0, turn) % 360.0 / 2.0 + 0.5) % 180
    return hue.astype(np.int16), np.where(top == 0, 0, np.floor(span * 255.0 / np.where(top == 0, 1.0, top) + 0.5)).astype(np.int16), top.astype(np.int16)
