"""A traced rectangle gives a plane in units of its left side, upright, or is refused."""

import numpy as np
import pytest

from kerbside.operators import groundplane as g

CAMERA = np.array([[900.0, 20.0, 700.0], [15.0, 300.0, 420.0], [0.01, 0.12, 1.0]])  # units to pixels


def traced(aspect, camera=CAMERA):
    return g.through(camera, np.array([[0.0, 0.0], [aspect, 0.0], [aspect, 1.0], [0.0, 1.0]]))


@pytest.mark.parametrize("aspect", [0.5, 1.0, 3.5])
def test_plane_of_a_camera_is_recovered(aspect):
    plane = g.traced_plane({"rect_px": traced(aspect).tolist(), "aspect": aspect}, aspect)
    spots = np.random.default_rng(1).random((50, 2)) * [aspect, 1.0]
    back = g.through(np.array(plane["H"]), g.through(CAMERA, spots))
    assert np.allclose(back * [1, -1] if plane["plane_y_flipped"] else back, spots, atol=1e-6)
    assert plane["corner_residual_units"] < 1e-6 and plane["scale_known"] is False and plane["scale_m_per_unit"] is None
    # A plane's points at infinity lie on the horizon.
    far = [CAMERA @ np.array([np.cos(t), np.sin(t), 0.0]) for t in (0.1, 1.2, 2.5)]
    assert all(abs(np.dot(plane["horizon_line"], p / p[2])) < 1e-3 for p in far)


def test_turns_are_kept_whatever_side_was_traced_first():
    corners = traced(2.0)
    for order in ([0, 1, 2, 3], [1, 0, 3, 2]):
        plane = g.traced_plane({"rect_px": corners[order].tolist()}, 2.0)
        assert g.orientation(np.array(plane["H"]), corners.mean(axis=0)) == g.UPRIGHT
    assert {g.traced_plane({"rect_px": corners[o].tolist()}, 2.0)["plane_y_flipped"] for o in ([0, 1, 2, 3], [1, 0, 3, 2])} == {True, False}


@pytest.mark.parametrize(
    ("document", "aspect", "why"),
    [
        ({"rect_px": [[0, 0], [9, 0], [9, 9], [0, 9]], "aspect": 2.0}, 1.0, "traced by"),
        ({"rect_px": [[0, 0], [9, 0], [9, 9]]}, 1.0, "four corners"),
        ({"rect_px": [[0, 0], [9, 0], [9, 9], [0, 9]]}, 0.0, "an aspect"),
        ({"rect_px": [[9, 9], [0, 9], [0, 0], [9, 0]]}, 1.0, "above"),
        ({"rect_px": [[0, 0], [9, 0], [0, 9], [9, 9]]}, 1.0, "bent or crosses"),
        ({"rect_px": [[0, 0], [9, 0], [3, 2], [0, 9]]}, 1.0, "bent or crosses"),
    ],
)
def test_other_outlines_are_refused(document, aspect, why):
    with pytest.raises(ValueError, match=why):
        g.traced_plane(document, aspect)
