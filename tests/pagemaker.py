"""Drawn pages with a known table: lines at xs and ys, without those between merged cells."""

import numpy as np


def make_page(xs, ys, merges=(), thickness=3, margin=40, noise=0, seed=0):
    """A grey page with a ruled table; merges: (row, col, rowspan, colspan) inside which no line is drawn."""
    h, w = max(ys) + margin, max(xs) + margin
    page = np.full((h, w), 255, np.uint8)
    t = thickness // 2

    def merged(r0, c0, r1, c1):
        return any(r <= r0 and c <= c0 and r1 < r + rs and c1 < c + cs for r, c, rs, cs in merges)

    for c, x in enumerate(xs):
        for r in range(len(ys) - 1):
            if not (0 < c < len(xs) - 1 and merged(r, c - 1, r, c)):
                page[ys[r] - t : ys[r + 1] + t + 1, x - t : x + t + 1] = 0
    for r, y in enumerate(ys):
        for c in range(len(xs) - 1):
            if not (0 < r < len(ys) - 1 and merged(r - 1, c, r, c)):
                page[y - t : y + t + 1, xs[c] - t : xs[c + 1] + t + 1] = 0
    if noise:
        rng = np.random.default_rng(seed)
        page[rng.integers(0, h, noise), rng.integers(0, w, noise)] = 0
    return page
