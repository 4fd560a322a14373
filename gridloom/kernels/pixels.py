"""Per-pixel and neighbourhood kernels on one image: (H, W) grey or (H, W, 3) BGR arrays of uint8."""

from __future__ import annotations

import functools

import numpy as np

SHAPES = ("rect", "ellipse", "cross")


def check(image) -> np.ndarray:
    """The image itself; raises for what is no image."""
    if image is None:
        raise ValueError("image is None")
    if not isinstance(image, np.ndarray):
        raise TypeError("image is no array")
    if image.size == 0:
        raise ValueError("image is empty")
    return image


def gray(image: np.ndarray) -> np.ndarray:
    """Luma 0.114 B + 0.587 G + 0.299 R in 14-bit fixed point; a grey image as it is."""
    if image.ndim == 2:
        return image
    b, g, r = (image[..., k].astype(np.int32) for k in range(3))
    return ((b * 1868 + g * 9617 + r * 4899 + 8192) >> 14).astype(np.uint8)


def bgr(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 3 else np.repeat(image[..., None], 3, 2)


def fixed(image: np.ndarray, t: float, inverted: bool = False) -> np.ndarray:
    return np.where((image > t) != inverted, 255, 0).astype(np.uint8)


def otsu_level(image: np.ndarray) -> int:
    """The smallest level with the greatest between-class variance."""
    n = np.bincount(image.ravel(), minlength=256).astype(np.int64)
    n0, s0 = np.cumsum(n), np.cumsum(n * np.arange(256))
    n1 = n0[-1] - n0
    with np.errstate(divide="ignore", invalid="ignore"):
        sigma = np.where((n0 > 0) & (n1 > 0), (s0 * n0[-1] - s0[-1] * n0).astype(float) ** 2 / (n0.astype(float) * n1), -1.0)
    return int(sigma.argmax())


def otsu(image: np.ndarray, inverted: bool = False) -> np.ndarray:
    return fixed(image, otsu_level(image), inverted)


def gaussian_kernel(size: int, sigma: float = 0) -> np.ndarray:
    if size % 2 == 0 or size < 1:
        raise ValueError("the size of a Gaussian must be odd")
    sigma = sigma or 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    k = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma**2))
    return k / k.sum()


def _beyond(n: int, r: int, mode: str) -> np.ndarray:
    """Which of n places stand for those from r before the first to r after the last."""
    at = np.arange(-r, n + r)
    if mode == "edge" or n == 1:
        return np.clip(at, 0, n - 1)
    if mode != "reflect":
        raise ValueError(f"unknown mode {mode!r}")
    at %= 2 * n - 2
    return np.where(at < n, at, 2 * n - 2 - at)


def separable(image: np.ndarray, along_y: np.ndarray, along_x: np.ndarray, mode: str = "reflect") -> np.ndarray:
    """Correlation with an outer product of two odd kernels, as floats."""
    out = image.astype(np.float64)
    for axis, k in ((0, along_y), (1, along_x)):
        n = out.shape[axis]
        p = np.take(out, _beyond(n, len(k) // 2, mode), axis)
        part = (lambda i: p[i : i + n]) if axis == 0 else (lambda i: p[:, i : i + n])  # noqa: B023, E731
        out = k[0] * part(0)
        for i, w in enumerate(k[1:], 1):
            out += w * part(i)
    return out


def gaussian_blur(image: np.ndarray, size: int) -> np.ndarray:
    k = gaussian_kernel(size)
    return np.clip(np.rint(separable(image, k, k)), 0, 255).astype(np.uint8)


def adaptive(image: np.ndarray, block: int = 31, c: float = 5, inverted: bool = False) -> np.ndarray:
    """v > local Gaussian mean - c; an even block size is raised by one."""
    k = gaussian_kernel(block + (block % 2 == 0))
    mean = np.rint(separable(image, k, k, "edge"))
    return np.where((image > mean - c) != inverted, 255, 0).astype(np.uint8)


def element(shape: str, width: int, height: int | None = None) -> np.ndarray:
    """A structuring element, by name in any case."""
    return _element(shape.lower(), width, height or width).copy()


@functools.lru_cache(maxsize=64)
def _element(shape: str, width: int, height: int) -> np.ndarray:
    if shape not in SHAPES:
        raise ValueError(f"unknown kernel shape {shape!r}")
    if shape == "rect":
        return np.ones((height, width), bool)
    out = np.zeros((height, width), bool)
    if shape == "cross":
        out[height // 2], out[:, width // 2] = True, True
        return out
    ry, rx = height // 2, width // 2
    for i in range(height):
        dy = i - ry
        if abs(dy) <= ry:
            dx = int(round(rx * np.sqrt((ry * ry - dy * dy) / (ry * ry)))) if ry else 0
            out[i, max(rx - dx, 0) : min(rx + dx + 1, width)] = True
    return out


@functools.lru_cache(maxsize=64)
def _spans(kernel: bytes, width: int) -> list[tuple[tuple[int, int], list[int]]]:
    """First and last column of a kernel's stretches, by width, and the rows that each is in."""
    from .components import image_runs

    found: dict[tuple[int, int], list[int]] = {}
    for i, a, b in zip(*(x.tolist() for x in image_runs(np.frombuffer(kernel, bool).reshape(-1, width)))):
        found.setdefault((a, b), []).append(i)
    return sorted(found.items(), key=lambda s: (s[0][1] - s[0][0], s[0]))


def _extremum(image: np.ndarray, kernel: np.ndarray, f, outside: int, iterations: int, flip: bool) -> np.ndarray:
    h, w = kernel.shape
    ay, ax = h // 2, w // 2
    if flip:
        kernel, ay, ax = kernel[::-1, ::-1], h - 1 - ay, w - 1 - ax
    out = image
    for _ in range(iterations):
        p = np.full((out.shape[0] + h - 1, out.shape[1] + w - 1), outside, out.dtype)
        p[ay : ay + out.shape[0], ax : ax + out.shape[1]] = out
        new = None
        if kernel.all():  # a rectangle is a row and a column one after the other
            rows = p[:, : out.shape[1]].copy()
            for j in range(1, w):
                f(rows, p[:, j : j + out.shape[1]], out=rows)
            new = rows[: out.shape[0]].copy()
            for i in range(1, h):
                f(new, rows[i : i + out.shape[0]], out=new)
        else:
            for (first, last), at in _spans(kernel.tobytes(), w):  # a row of the kernel is a stretch of columns; wider ones grow from those within them
                if new is None or not first <= low <= high <= last:
                    low = high = first
                    rows = p[:, first : first + out.shape[1]].copy()
                for j in (*range(first, low), *range(high + 1, last + 1)):
                    f(rows, p[:, j : j + out.shape[1]], out=rows)
                low, high = first, last
                for i in at:
                    part = rows[i : i + out.shape[0]]
                    new = part.copy() if new is None else f(new, part, out=new)
        out = new
    return out


def erode(image: np.ndarray, kernel: np.ndarray, iterations: int = 1) -> np.ndarray:
    """Least value under the kernel; what lies outside the image counts as white."""
    return _extremum(image, kernel, np.minimum, 255, iterations, False)


def dilate(image: np.ndarray, kernel: np.ndarray, iterations: int = 1) -> np.ndarray:
    """Greatest value under the reflected kernel; what lies outside the image counts as black."""
    return _extremum(image, kernel, np.maximum, 0, iterations, True)


def opening(image: np.ndarray, kernel: np.ndarray, iterations: int = 1) -> np.ndarray:
    return dilate(erode(image, kernel, iterations), kernel, iterations)


def closing(image: np.ndarray, kernel: np.ndarray, iterations: int = 1) -> np.ndarray:
    return erode(dilate(image, kernel, iterations), kernel, iterations)


def open_line(mask: np.ndarray, k: int, vertical: bool) -> np.ndarray:
    """Opening with a line of k pixels: keeps runs that are long enough, shorter ones only at the border."""
    m = mask.T if vertical else mask
    from .components import image_runs

    row, a, b = image_runs(m)
    start, end = a == 0, b == m.shape[1] - 1
    need = np.where(start & end, 1, np.where(start, k - k // 2, np.where(end, k // 2 + 1, k)))
    keep = b - a + 1 >= need
    edges = np.zeros((m.shape[0], m.shape[1] + 1), np.int8)
    edges[row[keep], a[keep]] = 1
    edges[row[keep], b[keep] + 1] = -1
    out = np.cumsum(edges, 1, dtype=np.int8)[:, :-1].view(np.uint8) * np.uint8(255)
    return out.T if vertical else out


def strengthen(image: np.ndarray, size: int = 2, iterations: int = 1, shape: str = "ellipse") -> np.ndarray:
    """Thickens dark strokes; three channels stay three."""
    out = 255 - dilate(255 - gray(image), element(shape, size), iterations)
    return bgr(out) if image.ndim == 3 else out


def binarize(image: np.ndarray, method: str = "otsu", level: float = 127, block: int = 31, c: float = 5, invert: bool = False, denoise: bool = False, strokes: bool = False) -> np.ndarray:
    """[strokes] -> threshold -> [opening of white by 2 x 2]."""
    g = gray(strengthen(image) if strokes else image)
    if method == "otsu":
        out = otsu(g, invert)
    elif method == "adaptive":
        out = adaptive(g, block, c, invert)
    elif method == "fixed":
        out = fixed(g, level, invert)
    else:
        raise ValueError(f"unknown method {method!r}")
    return opening(out, element("rect", 2)) if denoise else out


def sobel(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d, s = np.array([-1.0, 0, 1]), np.array([1.0, 2, 1])
    return separable(image, s, d), separable(image, d, s)


def canny(image: np.ndarray, sigma: float = 1.0, low: float = 0.1, high: float = 0.2) -> np.ndarray:
    """Edges: Gaussian gradient, thinning along it, hysteresis (thresholds as shares of 255)."""
    from .components import label_image

    size = 2 * int(4 * sigma + 0.5) + 1
    k = gaussian_kernel(size, sigma)
    gx, gy = sobel(separable(image, k, k, "edge") / 255)
    gx, gy = gx / 4, gy / 4
    m = np.hypot(gx, gy)
    p = np.pad(m, 1)
    near = lambda dy, dx: p[1 + dy : 1 + dy + m.shape[0], 1 + dx : 1 + dx + m.shape[1]]
    octant = (np.rint(np.degrees(np.arctan2(gy, gx)) / 45) % 4).astype(int)
    keep = np.zeros(m.shape, bool)
    for o, (dy, dx) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1))):
        keep |= (octant == o) & (m >= near(dy, dx)) & (m >= near(-dy, -dx))
    weak, strong = keep & (m >= low), keep & (m >= high)
    labels, stats = label_image(weak)
    good = np.zeros(len(stats) + 1, bool)
    good[np.unique(labels[strong])] = True
    good[0] = False
    return good[labels]


def area_quarter(image: np.ndarray) -> np.ndarray:
    """The image at a quarter of its width and height, by means of blocks."""
    h, w = image.shape[0] // 4, image.shape[1] // 4
    if not h or not w:
        return image
    blocks = image[: h * 4, : w * 4].reshape(h, 4, w, 4, *image.shape[2:]).astype(np.float64)
    return np.rint(blocks.mean((1, 3))).astype(np.uint8)


def hue_saturation(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hue in 0..179 and saturation in 0..255 of a BGR image, as whole numbers."""
    b, g, r = (image[..., k].astype(np.int32) for k in range(3))
    v, low = np.maximum(np.maximum(b, g), r), np.minimum(np.minimum(b, g), r)
    d = v - low
    n = np.arange(1, 256)
    by_v, by_d = (np.append(0, np.rint(of * 4096 / n)).astype(np.int32) for of in (255, 30))
    turn = np.where(v == r, g - b, np.where(v == g, b - r + 2 * d, r - g + 4 * d))
    h = (turn * by_d[d] + 2048) >> 12
    return np.where(h < 0, h + 180, h), (d * by_v[v] + 2048) >> 12


def blend(a: np.ndarray, b: np.ndarray, share: float) -> np.ndarray:
    return np.clip(np.rint(a * share + b * (1.0 - share)), 0, 255).astype(np.uint8)
