"""Turning a page weighs only the places where its values differ."""

import numpy as np
import pytest

from gridloom.kernels import geometry as geo
from gridloom.plans import drawn


@pytest.mark.parametrize("border", ["replicate", "zero"])
def test_every_place_weighs_the_same_as_before(border):
    rng = np.random.default_rng(2)
    for shape in ((31, 41), (3, 2), (40, 30, 3), (1, 1)):
        image = np.repeat(np.repeat(rng.integers(0, 256, shape), 4, 0), 4, 1).astype(np.uint8)
        h, w = image.shape[:2]
        t = np.radians(7.3)
        dx, dy = np.meshgrid(np.arange(w) - w // 2, np.arange(h) - h // 2)
        sx, sy = np.cos(t) * dx - np.sin(t) * dy + w // 2, np.sin(t) * dx + np.cos(t) * dy + h // 2
        y0, x0 = np.floor(sy).astype(int), np.floor(sx).astype(int)
        widen = lambda v: v[..., None] if image.ndim == 3 else v
        wy, wx = (geo._cubic(widen(v)) for v in (sy - y0, sx - x0))

        def at(y, x):
            v = image[np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)].astype(float)
            if border == "zero":
                v[(y < 0) | (y >= h) | (x < 0) | (x >= w)] = 0
            return v

        want = sum(wy[i] * sum(wx[j] * at(y0 + i - 1, x0 + j - 1) for j in range(4)) for i in range(4))
        assert (geo.rotate(image, 7.3, "cubic", border) == np.clip(np.rint(want), 0, 255)).all()


def test_even_places_are_not_weighed(monkeypatch):
    sizes, cubic = [], geo._cubic
    monkeypatch.setattr(geo, "_cubic", lambda t: (sizes.append(t.size), cubic(t))[1])
    geo.rotate(drawn.ruled(3), 1.5)
    assert 0 < max(sizes) < drawn.WIDTH * drawn.HEIGHT / 3


def test_ink_is_found_once_for_all_angles(monkeypatch):
    calls, nonzero = [], np.nonzero
    page = drawn.ruled(3)
    monkeypatch.setattr(np, "nonzero", lambda a: (calls.append(1), nonzero(a))[1])
    geo.skew_angle(page)
    assert len(calls) == 2
