"""Kernels against brute force and drawn pages."""

import numpy as np
import pytest
from pagemaker import make_page

from gridloom.kernels import components as comp
from gridloom.kernels import composites, geometry as geo, pixels as px

RNG = np.random.default_rng(5)


@pytest.mark.parametrize("k", [3, 4, 5, 8, 9])
@pytest.mark.parametrize("vertical", [False, True])
def test_line_opening_keeps_long_runs(k, vertical):
    mask = (RNG.random((12, 40)) < 0.8).astype(np.uint8) * 255
    m = mask.T if vertical else mask
    want = np.zeros_like(m)
    for y in range(m.shape[0]):
        for x in range(m.shape[1]):
            if m[y, x]:
                a = b = x
                while a and m[y, a - 1]:
                    a -= 1
                while b + 1 < m.shape[1] and m[y, b + 1]:
                    b += 1
                need = 1 if a == 0 and b == m.shape[1] - 1 else k - k // 2 if a == 0 else k // 2 + 1 if b == m.shape[1] - 1 else k
                want[y, x] = 255 if b - a + 1 >= need else 0
    assert (px.open_line(mask, k, vertical) == (want.T if vertical else want)).all()


def test_erosion_and_dilation_by_definition():
    image = RNG.integers(0, 256, (9, 11)).astype(np.uint8)
    for kernel in (px.element("rect", 3, 2), px.element("cross", 3), px.element("ellipse", 5)):
        ay, ax = kernel.shape[0] // 2, kernel.shape[1] // 2
        offsets = [(i - ay, j - ax) for i, j in zip(*np.nonzero(kernel))]
        at = lambda y, x, out: image[y, x] if 0 <= y < 9 and 0 <= x < 11 else out
        low = [[min(at(y + i, x + j, 255) for i, j in offsets) for x in range(11)] for y in range(9)]
        high = [[max(at(y - i, x - j, 0) for i, j in offsets) for x in range(11)] for y in range(9)]
        assert (px.erode(image, kernel) == low).all() and (px.dilate(image, kernel) == high).all()


def test_opening_and_closing_are_idempotent():
    image = RNG.integers(0, 256, (20, 20)).astype(np.uint8)
    k = px.element("rect", 3)
    assert (px.opening(px.opening(image, k), k) == px.opening(image, k)).all()
    assert (px.closing(px.closing(image, k), k) == px.closing(image, k)).all()


def test_otsu_by_search():
    image = np.concatenate([RNG.normal(60, 10, 500), RNG.normal(180, 15, 700)]).clip(0, 255).astype(np.uint8).reshape(30, 40)

    def between(t):
        low, high = image[image <= t].astype(float), image[image > t].astype(float)
        return len(low) * len(high) * (low.mean() - high.mean()) ** 2 if len(low) and len(high) else -1

    assert px.otsu_level(image) == max(range(256), key=lambda t: (round(between(t), 3), -t))


def test_gray_and_checks():
    assert px.gray(np.full((2, 2, 3), 200, np.uint8)).tolist() == [[200, 200]] * 2
    for bad, error in ((None, ValueError), ([1], TypeError), (np.zeros((0, 3)), ValueError)):
        with pytest.raises(error):
            px.check(bad)
    for f in (lambda: px.binarize(np.zeros((4, 4), np.uint8), "no"), lambda: px.element("star", 3), lambda: px.gaussian_kernel(4), lambda: geo.rotate(np.zeros((4, 4), np.uint8), 1, "no")):
        with pytest.raises(ValueError):
            f()


def test_components_by_flood():
    mask = RNG.random((25, 30)) < 0.4
    labels, stats = comp.label_image(mask)
    assert ((labels > 0) == mask).all() and stats[:, 4].sum() == mask.sum()
    for y, x in zip(*np.nonzero(mask)):
        near = labels[max(y - 1, 0) : y + 2, max(x - 1, 0) : x + 2]
        assert set(near[near > 0]) == {labels[y, x]}


def test_holes_are_filled():
    ring = np.zeros((7, 7), bool)
    ring[1:6, 1:6] = True
    ring[3, 3] = False
    assert comp.fill_holes(ring).sum() == 25
    with pytest.raises(RuntimeError):
        comp.largest_filled(np.zeros((3, 3), np.uint8))


def test_largest_rectangle_by_search():
    for _ in range(10):
        mask = RNG.random((7, 8)) < 0.7
        best = max((y2 - y1 + 1) * (x2 - x1 + 1) for y1 in range(7) for y2 in range(y1, 7) for x1 in range(8) for x2 in range(x1, 8) if mask[y1 : y2 + 1, x1 : x2 + 1].all())
        x1, y1, x2, y2 = geo.largest_rectangle(mask)
        assert (y2 - y1 + 1) * (x2 - x1 + 1) == best and mask[y1 : y2 + 1, x1 : x2 + 1].all()
    with pytest.raises(RuntimeError):
        geo.largest_rectangle(np.zeros((3, 3)))


def test_rotation_there_and_back():
    page = px.gaussian_blur(make_page([50, 150, 250], [50, 120, 200]), 9)
    for method in ("linear", "cubic"):
        back = geo.rotate(geo.rotate(page, 3, method), -3, method)
        assert np.abs(back.astype(int) - page)[20:-20, 20:-20].mean() < 6
    assert (geo.rotate(page, 0) == page).all()


@pytest.mark.parametrize("method", ["histogram_variance", "radon"])
@pytest.mark.parametrize("angle", [-2.0, 1.5])
def test_skew_is_found(method, angle):
    turned = geo.rotate(make_page([60, 200, 340, 480], [60, 130, 200, 270, 340]), angle)
    assert geo.skew_angle(turned, method) == pytest.approx(-angle, abs=0.3)


def test_small_angles_change_nothing():
    page = make_page([60, 200], [60, 130])
    out, angle = geo.deskew(page)
    assert out is page and angle == 0.0


def test_early_stop_of_the_coarse_scan():
    falling = lambda a: -a
    tried = []
    geo.search_angle(lambda a: tried.append(a) or falling(a), 5, 0.5, 1, 0.2, lambda a: 0.0, stop_early=True)
    assert len(tried) == 5


def test_marks_go_and_ink_stays():
    page = make_page([60, 200], [60, 130])
    page[20:24, 20:24] = 215
    out = composites.remove_marks(page)
    assert out[22, 22] == 255 and out[60, 100] == 0


def test_margin_is_cut():
    scan = np.full((200, 300), 20, np.uint8)
    scan[30:170, 40:260] = 240
    out = composites.remove_margin(scan)
    assert out.min() == 240 and out.shape[0] >= 130 and out.shape[1] >= 210


def test_canny_marks_edges():
    image = np.zeros((30, 30), np.uint8)
    image[:, 15:] = 255
    edges = px.canny(image)
    assert edges[10:20, 13:17].any(1).all() and not edges[:, :10].any()


def test_largest_rectangle_like_all_rectangles():
    r = np.random.default_rng(8)
    for _ in range(60):
        mask = r.random((r.integers(1, 9), r.integers(1, 9))) < r.choice([0.4, 0.7, 0.95])
        h, w = mask.shape
        found = [((y2 - y1 + 1) * (x2 - x1 + 1), -y2, -x2, y2 - y1 + 1, (x1, y1, x2, y2)) for y1 in range(h) for y2 in range(y1, h) for x1 in range(w) for x2 in range(x1, w) if mask[y1 : y2 + 1, x1 : x2 + 1].all()]
        if found:
            assert geo.largest_rectangle(mask) == max(found)[-1]
        else:
            with pytest.raises(RuntimeError):
                geo.largest_rectangle(mask)
