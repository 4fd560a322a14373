"""Geometric kernels on one image: rotation, projections, angle search, rectangles."""

from __future__ import annotations

import warnings

import numpy as np

from . import pixels as px


def _cubic(t: np.ndarray) -> list[np.ndarray]:
    """Weights of four neighbours at offset t, Keys' kernel with a = -0.75."""
    a = -0.75
    w = lambda d: np.where(d <= 1, (a + 2) * d**3 - (a + 3) * d**2 + 1, a * d**3 - 5 * a * d**2 + 8 * a * d - 4 * a)
    return [w(1 + t), w(t), w(1 - t), w(2 - t)]


def rotate(image: np.ndarray, angle: float, method: str = "cubic", border: str = "replicate") -> np.ndarray:
    """The image turned counter-clockwise by `angle` degrees around (w // 2, h // 2), in its own size.

    method: nearest, linear or cubic; border: replicate, or zero.
    """
    if method not in ("nearest", "linear", "cubic"):
        raise ValueError(f"unknown interpolation {method!r}")
    h, w = image.shape[:2]
    cx, cy, t = w // 2, h // 2, np.radians(angle)
    dx, dy = np.arange(w, dtype=np.float64) - cx, (np.arange(h, dtype=np.float64) - cy)[:, None]
    sx, sy = np.cos(t) * dx - np.sin(t) * dy + cx, np.sin(t) * dx + np.cos(t) * dy + cy

    def at(y: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = image[np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)].astype(np.float64)
        if border == "zero":
            out[(y < 0) | (y >= h) | (x < 0) | (x >= w)] = 0
        return out

    if method == "nearest":
        return at(np.rint(sy).astype(int), np.rint(sx).astype(int)).astype(image.dtype)
    # what all four by four places around an origin share is also what they weigh to: only the others are weighed
    reach = 3
    padded = np.pad(image, [(reach, reach)] * 2 + [(0, 0)] * (image.ndim - 2), **({"mode": "edge"} if border == "replicate" else {"constant_values": 0}))
    even = _even(padded)
    y0, x0 = np.floor(sy).astype(np.int32), np.floor(sx).astype(np.int32)
    ky, kx = np.clip(y0 + reach - 1, 0, even.shape[0] - 1), np.clip(x0 + reach - 1, 0, even.shape[1] - 1)
    place = ky * np.int32(padded.shape[1]) + kx
    out = padded.reshape(-1, *image.shape[2:]).take(place, 0)
    rest = np.flatnonzero(~even.take(ky * np.int32(even.shape[1]) + kx))
    y0, x0 = y0.ravel()[rest].astype(int), x0.ravel()[rest].astype(int)
    fy, fx = sy.ravel()[rest] - y0, sx.ravel()[rest] - x0
    if image.ndim == 3:
        fy, fx = fy[..., None], fx[..., None]
    if method == "linear":
        mixed = (at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx) * (1 - fy) + (at(y0 + 1, x0) * (1 - fx) + at(y0 + 1, x0 + 1) * fx) * fy
    else:
        wx, wy = _cubic(fx), _cubic(fy)
        mixed = sum(wy[i] * sum(wx[j] * at(y0 + i - 1, x0 + j - 1) for j in range(4)) for i in range(4))
    out.reshape(-1, *image.shape[2:])[rest] = np.clip(np.rint(mixed), 0, 255).astype(image.dtype)
    return out


def _even(padded: np.ndarray) -> np.ndarray:
    """Whether the four by four places from each on, to the right and down, have one value."""
    same = lambda a, b: (a == b).all(-1) if a.ndim == 3 else a == b
    x = same(padded[:, 1:], padded[:, :-1])
    x = x[:, :-2] & x[:, 1:-1] & x[:, 2:]
    y = same(padded[1:], padded[:-1])[:, : x.shape[1]]
    return x[:-3] & x[1:-2] & x[2:-1] & x[3:] & y[:-2] & y[1:-1] & y[2:]


def shear_rows(binary: np.ndarray, angle: float) -> np.ndarray:
    """Row sums of the image turned by a small angle, without an image: columns shift against each other."""
    return sheared(binary)(angle)


def sheared(binary: np.ndarray):
    """A function that gives shear_rows() of one image: its ink is found once for all angles."""
    h, w = binary.shape
    rows, cols = np.nonzero(binary)

    def sums(angle: float) -> np.ndarray:
        shift = np.rint(-np.tan(np.radians(angle)) * (np.arange(w) - w // 2)).astype(int)
        at = rows + shift[cols]
        return np.bincount(at[(at >= 0) & (at < h)], minlength=h).astype(np.int64) * 255

    return sums


def sharpness(rows: np.ndarray) -> float:
    return float((np.diff(rows.astype(np.int64)) ** 2).sum())


def angles(low: float, high: float, step: float) -> np.ndarray:
    return low + step * np.arange(max(0, int(np.ceil((high + step - low) / step - 1e-9))))


def search_angle(score, coarse_range: float, coarse_step: float, fine_range: float, fine_step: float, score_fine=None, stop_early: bool = False) -> tuple[float, float]:
    """The angle of the greatest score and that score: a coarse pass, then a fine one around its best, first maximum first.

    stop_early ends the coarse pass once its last five scores have not risen.
    """
    tried = []
    for a in angles(-coarse_range, coarse_range, coarse_step):
        tried.append((score(a), a))
        last = [s for s, _ in tried[-5:]]
        if stop_early and len(tried) >= 5 and all(x >= y for x, y in zip(last, last[1:])):
            break
    best = max(tried, key=lambda x: x[0])[1]
    fine = angles(max(-coarse_range, best - fine_range), min(coarse_range, best + fine_range), fine_step)
    top = max(((score_fine or score)(a), -i, a) for i, a in enumerate(fine))
    return float(top[2]), float(top[0])


def skew_by_projection(image: np.ndarray, coarse_range=5.0, coarse_step=0.5, fine_range=1.0, fine_step=0.2, stop_early=False) -> float:
    """The turn that makes rows of text sharpest."""
    ink = px.otsu(px.gray(image), True)
    small = px.otsu(px.area_quarter(px.gray(image)), True)

    def of(x):
        rows = sheared(x)
        return lambda a: sharpness(rows(a))

    return search_angle(of(small), coarse_range, coarse_step, fine_range, fine_step, of(ink), stop_early)[0]


def skew_by_radon(image: np.ndarray, coarse_range=5.0, coarse_step=0.5, fine_range=1.0, fine_step=0.2, binarized=False) -> float:
    """The turn with the greatest variance of the sums along rows of edges (or of ink, if binarized)."""
    g = px.gray(image)
    coarse_step = 0.5 if coarse_step == 1.0 else coarse_step  # 1.0 stands for "not set"
    of = lambda x: px.otsu(x, True) if binarized else px.canny(x).astype(np.uint8) * 255
    full, small = of(g), of(px.area_quarter(g))

    def score(x):
        rows = sheared(x)
        return lambda a: float(np.var(rows(a)))

    return search_angle(score(small), coarse_range, coarse_step, fine_range, fine_step, score(full))[0]


METHODS = {"histogram_variance": skew_by_projection, "radon": skew_by_radon}


def known_method(method: str) -> str:
    """The method itself, or, with a warning, the one that stands in for it."""
    if method in METHODS:
        return method
    warnings.warn(f"no way to find a skew is named {method!r}; histogram_variance is used", stacklevel=3)
    return "histogram_variance"


def skew_angle(image: np.ndarray, method: str = "histogram_variance", **options) -> float:
    """By a method's name; an unknown or unavailable one falls back to histogram_variance."""
    f = METHODS[known_method(method)]
    return f(image, **{k: v for k, v in options.items() if k in f.__code__.co_varnames})


def deskew(image: np.ndarray, method: str = "histogram_variance", min_angle: float = 0.2, **options) -> tuple[np.ndarray, float]:
    """The image turned upright and the angle; under min_angle the image as it is and 0."""
    a = skew_angle(image, method, **options)
    return (image, 0.0) if abs(a) < min_angle else (rotate(image, a), a)


def largest_rectangle(mask: np.ndarray) -> tuple[int, int, int, int]:
    """x1, y1, x2, y2 (inclusive) of the largest all-set rectangle; none raises RuntimeError.

    Of equals the one that ends in the first row, then that with the first right side, then the highest. For each row and column: how far
    the set pixels reach up, and how wide that height stays set on both sides.
    """
    h, w = mask.shape
    at = np.arange(w)
    height, left, right = np.zeros(w, np.int64), np.zeros(w, np.int64), np.full(w, w)
    best, most = None, 0
    for y in range(h):
        on = mask[y] > 0
        if not on.any():
            height[:], left[:], right[:] = 0, 0, w
            continue
        start = np.maximum.accumulate(np.where(on, 0, at + 1))
        end = np.minimum.accumulate(np.where(on, w, at)[::-1])[::-1]
        height = np.where(on, height + 1, 0)
        left, right = np.where(on, np.maximum(left, start), 0), np.where(on, np.minimum(right, end), w)
        area = height * (right - left)
        top = int(area.max())
        if top > most:
            ties = np.flatnonzero(area == top)
            k = ties[np.lexsort((-height[ties], right[ties]))[0]]
            most, best = top, (int(left[k]), y - int(height[k]) + 1, int(right[k]) - 1, y)
    if best is None:
        raise RuntimeError("no rectangle in the mask")
    return best


def draw_lines(shape: tuple[int, int], lines, thickness: int = 3) -> np.ndarray:
    """Axis-parallel lines (x1, y1, x2, y2) as a mask."""
    out = np.zeros(shape[:2], np.uint8)
    r0, r1 = thickness // 2, (thickness - 1) // 2 + 1
    for x1, y1, x2, y2 in lines:
        x1, x2, y1, y2 = min(x1, x2), max(x1, x2), min(y1, y2), max(y1, y2)
        out[max(y1 - r0, 0) : y2 + r1, max(x1 - r0, 0) : x2 + r1] = 255
    return out
