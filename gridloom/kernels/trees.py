"""The component tree of one page: how its dark regions grow and join as the grey level rises.

A node is a 4-connected region of pixels up to a level, at the level where it comes to be; it lives until its parent's level, where it has
grown or joined others. Levels are met in order and each one's meetings are joined at once, so the work goes by levels, not by pixels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .components import least_labels


@dataclass
class Tree:
    """Arrays over nodes, by rising level. first: the region's first pixel by rows; parent: a node's number, -1 for the whole page."""

    level: np.ndarray
    first: np.ndarray
    parent: np.ndarray
    area: np.ndarray
    box: np.ndarray  # x1, y1, x2, y2, inclusive

    def __len__(self) -> int:
        return len(self.level)


def component_tree(v: np.ndarray) -> Tree:
    h, w = v.shape
    own = v.ravel()  # bytes are sorted by radix
    # neighbours of one value in a row are one piece from the start, named by its first pixel; pieces meet where one of them begins
    begins = np.ones((h, w), bool)
    begins[:, 1:] = v[:, 1:] != v[:, :-1]
    start = np.flatnonzero(begins)
    n = len(start)
    piece = (np.cumsum(begins.ravel()) - 1).reshape(h, w)
    met_below = begins[:-1] | begins[1:]
    beside = np.flatnonzero(start[1:] % max(w, 1))
    a = np.concatenate([beside, piece[:-1][met_below]])
    b = np.concatenate([beside + 1, piece[1:][met_below]])
    own = own[start]
    when = np.maximum(own[a], own[b])
    order = np.argsort(when, kind="stable")
    a, b, when = a[order], b[order], when[order].astype(np.int64)
    pixels = np.argsort(own, kind="stable")
    levels, starts = np.unique(own[pixels].astype(np.int64), return_index=True)
    ends = np.append(starts[1:], n)
    low, high = np.searchsorted(when, levels, "left"), np.searchsorted(when, levels, "right")

    area = np.diff(np.append(start, h * w))
    root, node = np.arange(n), np.full(n, -1)
    y, x = np.divmod(start, max(w, 1))
    box = np.stack([x, y, x + area - 1, y], -1)
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("level", "first", "area", "box")}
    links, count = [], 0
    seen, number = np.zeros(n, bool), np.zeros(n, np.int64)

    def top(p: np.ndarray) -> np.ndarray:
        r = root[p]
        while (root[r] != r).any():
            r = root[r]
        root[p] = r
        return r

    for t, s, e, i, j in zip(levels.tolist(), starts, ends, low, high):
        p, q = top(a[i:j]), top(b[i:j])
        seen[p] = seen[q] = seen[pixels[s:e]] = True
        met = np.flatnonzero(seen)
        seen[met], number[met] = False, np.arange(len(met))
        label = least_labels(len(met), number[p], number[q])
        heads = np.flatnonzero(np.bincount(label, minlength=len(met)))
        number[heads] = np.arange(len(heads))
        of = number[label]
        root[met] = met[label]
        total = np.bincount(of, area[met]).astype(np.int64)
        edges = box[met[heads]].copy()
        for k, f in ((0, np.minimum), (1, np.minimum), (2, np.maximum), (3, np.maximum)):
            f.at(edges[:, k], of, box[met, k])
        old = node[met]
        links.append((old[old >= 0], count + of[old >= 0]))
        first = met[heads]
        area[first], box[first], node[first] = total, edges, count + np.arange(len(heads))
        out["level"].append(np.full(len(heads), t))
        out["first"].append(start[first])
        out["area"].append(total)
        out["box"].append(edges)
        count += len(heads)
    parent = np.full(count, -1)
    for child, own in links:
        parent[child] = own
    join = lambda k, empty: np.concatenate(out[k]) if out[k] else empty
    none = np.zeros(0, np.int64)
    return Tree(join("level", none), join("first", none), parent, join("area", none), join("box", np.zeros((0, 4), np.int64)))


def growth(tree: Tree, delta: int) -> np.ndarray:
    """For each node the least share, over the levels t of its life, by which it grows from t - delta to t + delta.

    The region at t - delta is the largest one inside it, or nothing; beyond the last level stands the whole page.
    """
    n, level, parent, area = len(tree), tree.level, tree.parent, tree.area
    ends = np.where(parent >= 0, level[parent], level + 1)
    best = np.full(n, np.inf)
    for o in range(2 * delta + 1):  # a node that lives longer does not grow at all at its level + delta
        alive = np.flatnonzero(level + o < ends)
        if not len(alive):
            break
        above, limit = alive.copy(), level[alive] + o + delta
        while True:
            up = parent[above]
            go = (up >= 0) & (level[np.maximum(up, 0)] <= limit)
            if not go.any():
                break
            above = np.where(go, up, above)
        inner = np.zeros(n, np.int64)
        # a node stands for the levels from its own to before its parent's; which of its ancestors look there
        d, up = np.arange(n), np.arange(n)
        while len(d):
            seen = level[up] + o - delta
            hit = (seen >= level[d]) & (seen < ends[d])
            np.maximum.at(inner, up[hit], area[d[hit]])
            on = (parent[up] >= 0) & (seen < ends[d])
            d, up = d[on], parent[up[on]]
        best[alive] = np.minimum(best[alive], (area[above] - inner[alive]) / area[alive])
    return best


def neighbours(tree: Tree, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node the value of its parent and the least one of its children; infinity where there is none."""
    has = tree.parent >= 0
    up = np.where(has, values[np.maximum(tree.parent, 0)], np.inf)
    down = np.full(len(tree), np.inf)
    np.minimum.at(down, tree.parent[has], values[has])
    return up, down
