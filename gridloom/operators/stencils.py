"""Pixels with their neighbours, by windows along rows and columns: convolutions, gradients, edges and the borders of pages.

pixels: page_id, y, x, v without gaps. A window holds one row or one column of a page, so the largest group is a page's side. All arithmetic
is on whole numbers, so no order of rows can show in a result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: tan(22.5 degrees) as a share of 2**15.
TAN = round(math.tan(math.radians(22.5)) * 2**15)


def convolved(pixels: DataFrame, weights: list[int], axis: str, border: str = "edge", value: str = "v", out: str = "v") -> DataFrame:
    """pixels with `out`: the sum of weights times the values around a pixel along an axis, the middle weight its own.

    border: edge (the last pixel goes on) or mirror (the page is reflected at its last pixel; a page must be as wide as the kernel's half).
    """
    if border not in ("edge", "mirror"):
        raise ValueError(f"unknown border {border!r}")
    half = len(weights) // 2
    line = Window.partitionBy("page_id", "y" if axis == "x" else "x")
    w, all_ = line.orderBy(axis), line.orderBy(axis).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = F.count("*").over(line)
    total: Column = F.lit(0)
    for i, k in enumerate(weights):
        step = i - half
        if not k:
            continue
        if not step:
            at = F.col(value)
        else:
            at = F.lag(value, -step).over(w) if step < 0 else F.lead(value, step).over(w)
            if border == "edge":
                beyond = F.first(value).over(all_) if step < 0 else F.last(value).over(all_)
            else:
                # beyond the edge at p + step: the pixel at -(p + step), or at 2 (n - 1) - (p + step)
                beyond = _mirrored(value, axis, step, half, w, n)
            at = F.coalesce(at, beyond)
        total = total + F.lit(k) * at
    return pixels.withColumn(out, total.cast("long"))


def _mirrored(value: str, axis: str, step: int, half: int, w, n: Column) -> Column:
    """The reflected pixel for a place `step` away that lies beyond the page."""
    p, out = F.col(axis), F.lit(None).cast("long")
    for d in range(half):
        # p = d before the start, or d from the end: the reflection is |step| - 2 d away in the other direction
        away = abs(step) - 2 * d
        if abs(step) <= d:
            continue
        hit = (p == d) if step < 0 else (n - 1 - p == d)
        other = away if step < 0 else -away
        seen = F.col(value) if other == 0 else F.lead(value, other).over(w) if other > 0 else F.lag(value, -other).over(w)
        out = F.when(hit, seen).otherwise(out)
    return out


def around(pixels: DataFrame, value: str) -> DataFrame:
    """pixels with n: the nine values of the 3 x 3 square, row by row, null beyond the page."""
    row = Window.partitionBy("page_id", "y").orderBy("x")
    col = Window.partitionBy("page_id", "x").orderBy("y")
    three = pixels.withColumn("_r", F.array(F.lag(value).over(row), F.col(value), F.lead(value).over(row)))
    none = F.array(*[F.lit(None).cast("long")] * 3)
    return three.withColumn("n", F.concat(F.coalesce(F.lag("_r").over(col), none), "_r", F.coalesce(F.lead("_r").over(col), none))).drop("_r")


def gaussian(size: int, sigma: float, scale: int = 256) -> list[int]:
    """Whole weights of a Gaussian kernel that sum to scale; the middle one takes the rounding."""
    half = size // 2
    raw = [math.exp(-((i - half) ** 2) / (2 * sigma**2)) for i in range(size)]
    out = [round(scale * r / sum(raw)) for r in raw]
    out[half] += scale - sum(out)
    return out


def gradients(pixels: DataFrame, border: str = "mirror") -> DataFrame:
    """page_id, y, x, v, gx, gy: Sobel's differences to the right and downwards."""
    smooth, step = [1, 2, 1], [-1, 0, 1]
    across = convolved(convolved(pixels, step, "x", border, "v", "_d"), smooth, "x", border, "v", "_s")
    down = convolved(convolved(across, smooth, "y", border, "_d", "gx"), step, "y", border, "_s", "gy")
    return down.drop("_d", "_s")


def border_bounds(pixels: DataFrame, frame: int = 50, strong: float = 50.0, share: float = 0.3, inset: int = 5) -> DataFrame:
    """page_id, left, top, right, bottom (inclusive): the page inside its borders.

    Within the outer frame, a border is the outermost row or column of which more than `share` is steep; the page begins `inset` pixels
    further in. A side without one keeps its edge.
    """
    steep = ((F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")).cast("double") > strong * strong).cast("long")
    marked = gradients(pixels).select("page_id", "y", "x", steep.alias("steep"))
    size = marked.groupBy("page_id").agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))

    def side(axis: str, length: str, other: str) -> DataFrame:
        lines = marked.groupBy("page_id", F.col(axis).alias("i")).agg(F.sum("steep").alias("n")).join(size, "page_id").where(F.col("n") > share * F.col(other))
        near, far = F.col("i") < frame, F.col("i") >= F.col(length) - frame
        return lines.groupBy("page_id").agg(F.min(F.when(near, F.col("i"))).alias(f"{axis}0"), F.max(F.when(far, F.col("i"))).alias(f"{axis}1"))

    both = size.join(side("y", "height", "width"), "page_id", "left").join(side("x", "width", "height"), "page_id", "left")
    first = lambda c: F.coalesce(F.col(c) + inset, F.lit(0)).cast("long")
    last = lambda c, n: F.coalesce(F.col(c) - inset, F.col(n) - 1).cast("long")
    return both.select("page_id", first("x0").alias("left"), first("y0").alias("top"), last("x1", "width").alias("right"), last("y1", "height").alias("bottom"))


def smoothed_gradients(pixels: DataFrame, sigma: float = 1.0, reach: float = 4.0) -> DataFrame:
    """page_id, y, x, gx, gy of the page under a Gaussian, scaled by 2**16 for its two passes."""
    k = gaussian(2 * int(reach * sigma + 0.5) + 1, sigma)
    return gradients(convolved(convolved(pixels, k, "y"), k, "x"), "edge")


def thinned(slopes: DataFrame) -> DataFrame:
    """page_id, y, x, m: pixels whose squared gradient m is no less than that of their two neighbours along it.

    The direction is one of four: within 22.5 degrees of a row, of a column, or between. Beyond the page the gradient counts as 0.
    """
    gx, gy = F.col("gx"), F.col("gy")
    ax, ay = F.abs(gx), F.abs(gy)
    flat, steep = ay * 2**15 < ax * TAN, ax * 2**15 < ay * TAN
    m = slopes.select("page_id", "y", "x", (gx * gx + gy * gy).alias("m"), F.when(flat, 0).when(steep, 1).when((gx < 0) == (gy < 0), 2).otherwise(3).alias("o"))
    near = around(m.where("true"), "m")
    n = lambda i: F.coalesce(F.get("n", F.lit(i)), F.lit(0))
    pair = {0: (3, 5), 1: (1, 7), 2: (0, 8), 3: (2, 6)}
    top = F.lit(False)
    for o, (a, b) in pair.items():
        top = top | ((F.col("o") == o) & (F.col("m") >= n(a)) & (F.col("m") >= n(b)))
    return near.where(top & (F.col("m") > 0)).select("page_id", "y", "x", "m")


def linked(edges: DataFrame) -> DataFrame:
    """page_id, y, x of weak pixels that a chain of weak ones (8 neighbours) joins to a strong one. edges: page_id, y, x, strong.

    Chains are components of runs, found page by page; a component stays if any of its runs holds a strong pixel.
    """
    w = Window.partitionBy("page_id", "y").orderBy("x")
    islands = edges.select("page_id", F.col("y").alias("line"), "x", "strong", (F.col("x") - F.row_number().over(w)).alias("g"))
    runs = islands.groupBy("page_id", "line", "g").agg(F.min("x").alias("a"), F.max("x").alias("b"), F.max(F.col("strong").cast("int")).alias("strong")).drop("g")
    kept = runs.groupBy("page_id").applyInArrow(_kept_runs, "page_id long, line long, a long, b long")
    return kept.select("page_id", F.col("line").alias("y"), F.explode(F.sequence("a", "b")).alias("x"))


def _kept_runs(group):
    import numpy as np
    import pyarrow as pa

    from gridloom.kernels.components import label_runs

    line, a, b, strong = (group.column(c).to_numpy() for c in ("line", "a", "b", "strong"))
    label, stats = label_runs(line, a, b)
    good = np.zeros(len(stats), bool)
    good[label[strong > 0]] = True
    return group.filter(pa.array(good[label])).select(["page_id", "line", "a", "b"]).cast(pa.schema([(c, pa.int64()) for c in ("page_id", "line", "a", "b")]))


def canny(pixels: DataFrame, sigma: float = 1.0, low: float = 0.1, high: float = 0.2) -> DataFrame:
    """page_id, y, x of edges: thinned gradients above `high`, and those above `low` that are joined to them. Thresholds are shares of full contrast."""
    unit = (4 * 255 * 2**16) ** 2  # Sobel's sum of weights, white, both passes of the Gaussian
    weak = thinned(smoothed_gradients(pixels, sigma)).where(F.col("m") >= F.lit(int(low * low * unit)))
    return linked(weak.select("page_id", "y", "x", (F.col("m") >= F.lit(int(high * high * unit))).alias("strong")))
