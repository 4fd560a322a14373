"""The ink of one text as a page: its lines are rows, its characters but blanks are set pixels."""

from __future__ import annotations

import numpy as np


def ink_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """y and x of the text's ink, by rows."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.flatnonzero(code == 10)
    y = np.zeros(len(code), np.int32)
    y[ends[ends + 1 < len(code)] + 1] = 1
    y = np.cumsum(y, dtype=np.int32)
    x = np.arange(len(code), dtype=np.int32) - np.append(0, ends + 1).astype(np.int32)[y]
    on = (code != 32) & (code != 10)
    return y[on], x[on]


def page_ink(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """y and x of the ink of a page's texts; a page has one, unless ids repeat."""
    if len(texts) == 1:
        return ink_of(texts[0])
    y, x = (np.concatenate(c) for c in zip(*map(ink_of, texts)))
    order = np.lexsort((x, y))
    return y[order], x[order]


def runs_of(texts: list[str], along: str) -> tuple[np.ndarray, ...]:
    """line, a, b (inclusive), size of the maximal runs of a page's ink along rows ('x') or columns ('y'), and its extent that way.

    As islands are told by their place less their rank, pixels that texts share part runs as they do there.
    """
    y, x = page_ink(texts)
    line, at = (y, x) if along == "x" else (x, y)
    if along == "y":
        order = np.argsort(line, kind="stable")  # rows rise within a column as they are
        line, at = line[order], at[order]
    if not len(line):
        return line, at, at, at
    size = int(at.max()) + 1
    if len(texts) > 1:
        first = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
        g = at - (np.arange(len(line)) - np.repeat(first, np.diff(np.append(first, len(line)))))
        order = np.lexsort((at, g, line))
        line, at, g = line[order], at[order], g[order]
        starts = np.flatnonzero(np.append(True, (line[1:] != line[:-1]) | (g[1:] != g[:-1])))
    else:
        starts = np.flatnonzero(np.append(True, (line[1:] != line[:-1]) | (at[1:] != at[:-1] + 1)))
    return line[starts], at[starts], at[np.append(starts[1:], len(line)) - 1], np.full(len(starts), size)


def counts_of(texts: list[str], axis: str) -> tuple[np.ndarray, ...]:
    """i, n, size: how much of a page's ink each column ('x') or row ('y') with any has, and the page's extent across them."""
    at = page_ink(texts)["yx".index(axis)]
    n = np.bincount(at) if len(at) else np.zeros(0, np.int64)
    i = np.flatnonzero(n)
    return i, n[i], np.full(len(i), len(n))


def densest_of(texts: list[str], axis: str) -> tuple[np.ndarray, ...]:
    """center: the mean (rounded down) of the columns or rows with the most ink."""
    i, n, _ = counts_of(texts, axis)
    top = i[n == n.max(initial=0)]
    return (np.array([top.sum() // len(top)] if len(top) else [], np.int64),)
