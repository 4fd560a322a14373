"""Operations on one page image that are made of several kernels."""

from __future__ import annotations

import functools

import numpy as np

from . import geometry as geo
from . import pixels as px
from . import trees
from .components import image_runs, label_image, label_runs, largest_filled

#: Pixels of the largest page whose turns are remembered.
KEPT_PLACES = 1 << 16


def protect_mask(image: np.ndarray, dilate_iter: int = 2, kernel_size: int = 3, lines_mask: np.ndarray | None = None) -> np.ndarray:
    """Ink and table lines, widened."""
    mask = px.otsu(px.gray(image), True)
    if lines_mask is not None:
        mask = mask | lines_mask
    return px.dilate(mask, px.element("rect", kernel_size), dilate_iter)


def remove_marks(image: np.ndarray, dilate_iter: int = 2, kernel_size: int = 3, lines_mask: np.ndarray | None = None) -> np.ndarray:
    """Grey inside the protected mask, white elsewhere; always one channel."""
    return np.where(protect_mask(image, dilate_iter, kernel_size, lines_mask) > 0, px.gray(image), 255).astype(np.uint8)


def paper_mask(image: np.ndarray, blur: int = 5, close: int = 25, close_iter: int = 2, erode_after: int = 0) -> np.ndarray:
    """The page against its background, as the largest region with its holes closed."""
    g = px.gray(image)
    if blur:
        g = px.gaussian_blur(g, blur + (blur % 2 == 0))
    mask = px.otsu(g)
    if mask.mean() < 127:
        mask = 255 - mask
    mask = px.closing(mask, px.element("rect", close), close_iter)
    if erode_after:
        mask = px.erode(mask, px.element("rect", erode_after))
    return largest_filled(mask)


def gradient_mask(image: np.ndarray, frame: int = 50, strong: float = 50.0, share: float = 0.3, inset: int = 5) -> np.ndarray:
    """The page inside the borders where, within the outer frame, more than `share` of a row or column is steep."""
    gx, gy = px.sobel(px.gray(image))
    steep = np.hypot(gx, gy) > strong
    h, w = steep.shape
    rows, cols = np.flatnonzero(steep.mean(1) > share), np.flatnonzero(steep.mean(0) > share)
    first = lambda at, most: at[at < min(frame, most)]
    last = lambda at, most: at[at >= max(most - frame, 0)]
    top, left = (int(x[0]) + inset if len(x) else 0 for x in (first(rows, h), first(cols, w)))
    bottom, right = (int(x[-1]) - inset if len(x) else m - 1 for x, m in ((last(rows, h), h), (last(cols, w), w)))
    out = np.zeros((h, w), np.uint8)
    out[top : bottom + 1, left : right + 1] = 255
    return out


def remove_margin(image: np.ndarray, method: str = "paper", **options) -> np.ndarray:
    """The largest rectangle inside the page; what has none raises RuntimeError."""
    masks = {"paper": paper_mask, "gradient": gradient_mask}
    if method not in masks:
        raise ValueError(f"unknown method {method!r}")
    x1, y1, x2, y2 = geo.largest_rectangle(masks[method](image, **options))
    return image[y1 : y2 + 1, x1 : x2 + 1]


def remove_margin_keep_borders(image: np.ndarray, blur: int = 5, close: int = 15, safety: int = 10) -> np.ndarray:
    """The bounding box of the page together with its ink, and a margin of safety."""
    g = px.gaussian_blur(px.gray(image), blur)
    mask = px.otsu(g)
    if mask.mean() < 127:
        mask = 255 - mask
    mask = largest_filled(px.closing(mask, px.element("ellipse", close)) | px.otsu(g, True))
    ys, xs = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
    h, w = g.shape
    return image[max(ys[0] - safety, 0) : min(ys[-1] + safety + 1, h), max(xs[0] - safety, 0) : min(xs[-1] + safety + 1, w)]


def line_mask(image: np.ndarray, threshold: int, h_size: int, v_size: int, skew: float = 0.0, skew_step: float = 0.2, prepare: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Masks of horizontal and vertical lines: ink that an opening with a long line keeps, at any small turn.

    prepare: options of px.binarize() for a binary page to search instead, and of px.strengthen() under "strokes".
    """
    g = px.gray(image)
    if prepare:
        options = dict(prepare)
        strokes = options.pop("strokes", None)
        g = px.binarize(g, **options)
        if strokes:
            g = px.strengthen(g, **strokes)
    ink = px.fixed(255 - g, threshold)
    if skew <= 0:
        return px.open_line(ink, h_size, False), px.open_line(ink, v_size, True)
    out = [np.zeros(g.shape, np.uint8), np.zeros(g.shape, np.uint8)]
    for a in geo.angles(-skew, skew, skew_step):
        turned = geo.rotate(ink, a, "nearest", "zero")
        for k, (size, vertical) in enumerate(((h_size, False), (v_size, True))):
            out[k] |= geo.rotate(px.open_line(turned, size, vertical), -a, "nearest", "zero")
    return tuple(px.closing(x, px.element("rect", 3)) for x in out)


@functools.lru_cache(maxsize=64)
def _places(h: int, w: int, c: float, s: float) -> np.ndarray:
    """Where each place of a page turned by (c, s) comes from, the nearest pixel, as a place in the page's rows with h * w for what lies outside.

    In the fixed-point numbers of operators.turning.
    """
    cx, cy = float(w // 2), float(h // 2)
    x, y = np.arange(w, dtype=np.float64), np.arange(h, dtype=np.float64)[:, None]
    at = lambda d: np.rint(d * 1024.0).astype(np.int64)
    sx = (at(c * x) + at(-s * y + (cx - c * cx + s * cy)) + 512) >> 10
    sy = (at(s * x) + at(c * y + (cy - s * cx - c * cy)) + 512) >> 10
    return np.where((sx >= 0) & (sx < w) & (sy >= 0) & (sy < h), sy * w + sx, h * w)


def lines_at_turns(mask: np.ndarray, h_size: int, v_size: int, turns) -> tuple[np.ndarray, np.ndarray]:
    """Where horizontal and vertical lines of so many pixels are at any of the turns (cosine and sine, there and back), united and closed."""
    h, w = mask.shape
    places = _places if h * w <= KEPT_PLACES else _places.__wrapped__
    turned = lambda m, turn: np.append(m > 0, False).take(places(h, w, *turn))
    kept = [np.zeros((h, w), bool), np.zeros((h, w), bool)]
    for there, back in turns:
        own = turned(mask, there)
        for out, k, vertical in zip(kept, (h_size, v_size), (False, True)):
            out |= turned(px.open_line(own, k, vertical), back)
    return tuple(px.closing(m.view(np.uint8) * np.uint8(255), px.element("rect", 3)) > 0 for m in kept)


def line_components(mask: np.ndarray, vertical: bool, min_ratio: float, min_aspect: float) -> list[tuple[int, int, int, int, float]]:
    """seq, position, start, end, aspect of the components that are long and thin enough.

    A thick one's position is that of its densest row or column (the mean of equals), a thin one's its middle.
    """
    labels, stats = label_image(mask)
    out = []
    for k, (x, y, w, h, _) in enumerate(stats.tolist()):
        long, thick, whole = (h, w, mask.shape[0]) if vertical else (w, h, mask.shape[1])
        aspect = long / max(thick, 1)
        if long < min_ratio * whole or aspect < min_aspect:
            continue
        first = x if vertical else y
        if thick > 3:
            n = (labels[y : y + h, x : x + w] == k + 1).sum(0 if vertical else 1)
            at = first + int(np.flatnonzero(n == n.max()).mean())
        else:
            at = (first + first + thick) // 2
        out.append((k, at, y if vertical else x, (y + h) if vertical else (x + w), aspect))
    return out


def dark_band(g: np.ndarray, dark: int = 110, least: int = 200) -> tuple[int, int] | None:
    """Top and bottom of the band of tags in the upper page."""
    h = g.shape[0]
    i = np.arange(h)
    rows = np.flatnonzero(((g < dark).sum(1) > least) & (i > h * 0.02) & (i < h * 0.4))
    return (max(int(rows[0]) - 10, 0), min(int(rows[-1]) + 10, h - 1)) if len(rows) else None


def tag_regions(g: np.ndarray, dark: int = 110, kernel: int = 5, iterations: int = 2) -> list[tuple[int, int, int, int, int, float]]:
    """x, y, w, h, area and share of dark pixels of dark regions."""
    mask = px.closing(px.fixed(g, dark, True), px.element("rect", kernel), iterations)
    return [(x, y, w, h, a, float((g[y : y + h, x : x + w] < dark).mean())) for x, y, w, h, a in label_image(mask)[1].tolist()]


def stable_regions(g: np.ndarray, delta: int = 5, area: tuple[int, int] = (1500, 60000), change: float = 0.25) -> list[tuple[int, int, int, int]]:
    """Boxes of maximally stable dark regions: nodes of the component tree that hardly grow, and no more than those just inside and around them."""
    tree = trees.component_tree(g)
    own = trees.growth(tree, delta)
    up, down = trees.neighbours(tree, own)
    keep = (tree.area >= area[0]) & (tree.area <= area[1]) & (own <= change) & (own <= up) & (own <= down)
    boxes = {(x1, y1, x2 - x1 + 1, y2 - y1 + 1): None for x1, y1, x2, y2 in tree.box[keep].tolist()}
    return list(boxes)


def glyph_count(roi: np.ndarray, level: int = 185, kernel: int = 3, least: int = 60) -> int:
    """Bright blobs of more than `least` pixels."""
    bright = px.opening(px.fixed(roi, level), px.element("rect", kernel))
    return int((label_runs(*image_runs(bright))[1][:, 4] > least).sum())


def capsule_mask(roi: np.ndarray, pad: int = 8, close: int = 9, open_: int = 3, grow: int = 3) -> np.ndarray:
    """The dark capsule in the middle of a region, widened; in the padded region's frame cut back to the region."""
    p = np.pad(roi, pad, constant_values=255)
    soft = px.gaussian_blur(p, 5)
    mask = px.otsu(soft, True) | px.fixed(soft, 190, True) | px.adaptive(soft, 31, 5, True)
    mask[:pad], mask[-pad:], mask[:, :pad], mask[:, -pad:] = 0, 0, 0, 0
    mask = px.opening(px.closing(mask, px.element("ellipse", close)), px.element("ellipse", open_))
    labels, stats = label_image(mask)
    if not len(stats):
        return np.zeros(roi.shape, np.uint8)
    cy, cx = p.shape[0] / 2, p.shape[1] / 2
    d = (stats[:, 0] + stats[:, 2] / 2 - cx) ** 2 + (stats[:, 1] + stats[:, 3] / 2 - cy) ** 2
    own = np.where(labels == d.argmin() + 1, 255, 0).astype(np.uint8)
    return px.dilate(own[pad : pad + roi.shape[0], pad : pad + roi.shape[1]], px.element("ellipse", grow))


def white_boxes(image: np.ndarray, boxes, margin: int = 2) -> np.ndarray:
    out = image.copy()
    for x, y, w, h in boxes:
        out[max(y - margin, 0) : y + h + margin, max(x - margin, 0) : x + w + margin] = 255
    return out


def white_capsules(image: np.ndarray, boxes, **options) -> np.ndarray:
    """options: of capsule_mask()."""
    out = image.copy()
    for x, y, w, h in boxes:
        own = slice(y, y + h), slice(x, x + w)
        out[own][capsule_mask(px.gray(image[own]), **options) > 0] = 255
    return out
