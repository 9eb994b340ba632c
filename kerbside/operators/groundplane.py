"""A ground plane from a traced rectangle of the paving, where vanishing points cannot be had: angles and membership of zones, but no metres."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np

from .estimators import ground_homography

#: Sign of the turn from the image's right to its up, seen on a plane that is not mirrored.
UPRIGHT = 1
#: Least determinant of a plane that is one.
LEAST_DETERMINANT = 1e-12


def through(h: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Points through a homography."""
    out = np.column_stack((points, np.ones(len(points)))) @ h.T
    return out[:, :2] / out[:, 2:]


def orientation(h: np.ndarray, at: np.ndarray) -> int:
    """Whether a plane keeps (1) or mirrors (-1) turns at a pixel: the image's right and up, one pixel each, as they lie on it."""
    origin, right, up = through(h, np.array([at, at + [1.0, 0.0], at + [0.0, -1.0]]))
    (a, b), (c, d) = right - origin, up - origin
    return int(np.sign(a * d - b * c))


def traced_plane(document: Mapping, aspect: float) -> dict:
    """The calibration that a traced rectangle gives, from its corners ``rect_px`` (top left, top right, bottom right, bottom left).

    The plane's x runs along the top, its y along the left side, whose length is 1; ``aspect`` is the top's. A mirrored plane would turn every angle
    round, so its y is turned. Lengths are in units of the left side and no scale is claimed: heights, speeds and widths are absent, not
    zero. An aspect other than the one that was traced by, corners in another order, a bent or crossed outline and corners on one line are errors.
    """
    stated = document.get("aspect", aspect)
    if abs(float(stated) - aspect) > 1e-9:
        raise ValueError(f"traced by an aspect of {stated}, not of {aspect}")
    corners = np.asarray(document["rect_px"], float)
    if corners.shape != (4, 2) or not np.isfinite(corners).all():
        raise ValueError("a rectangle has four corners")
    if not np.isfinite(aspect) or aspect <= 0:
        raise ValueError(f"an aspect of {aspect}")
    if corners[2:, 1].mean() <= corners[:2, 1].mean():
        raise ValueError("the last two corners lie above the first two")
    sides = np.roll(corners, -1, axis=0) - corners
    turns = np.sign([a[0] * b[1] - a[1] * b[0] for a, b in zip(sides, np.roll(sides, -1, axis=0), strict=True)])
    if not (np.all(turns > 0) or np.all(turns < 0)):
        raise ValueError("the outline is bent or crosses itself")
    h = ground_homography([tuple(p) for p in corners], aspect, 1.0)
    if abs(np.linalg.det(h)) < LEAST_DETERMINANT:
        raise ValueError("the corners lie almost on one line")
    target = np.array([[0.0, 0.0], [aspect, 0.0], [aspect, 1.0], [0.0, 1.0]])
    mirrored = orientation(h, corners.mean(axis=0)) != UPRIGHT
    if mirrored:
        h, target = np.diag([1.0, -1.0, 1.0]) @ h, target * [1.0, -1.0]
    line = h[2] / np.hypot(h[2, 0], h[2, 1])
    return {
        "method": "manual_ground_plane", "direction": "px_to_unit", "scale_known": False, "scale_m_per_unit": None, "H": h.tolist(), "horizon_line": line.tolist(),
        "ground_rect_px": corners.tolist(), "aspect": aspect, "plane_y_flipped": mirrored, "corner_residual_units": float(np.abs(through(h, corners) - target).max()),
    }
