"""Turned rasters and the angles at which their projections are sharpest, as joins and grouped sums over pixels.

pixels: page_id, y, x, v without gaps, from (0, 0); ink: page_id, y, x of set pixels alone. sizes: page_id, height, width. Places in
the page that a turned pixel comes from are fixed-point numbers (1/1024 pixel, rounded to 1/32 where values are
interpolated), so weights and sums are exact and don't depend on the order of rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.kernels.composites import lines_at_turns

from .pages import _bounded as bounded

SCALE, STEPS = 1024, 32


def sizes_of(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("page_id").agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))


def angle_list(low: float, high: float, step: float) -> list[float]:
    """From low in steps, up to the first that reaches high."""
    n = max(0, math.ceil((high + step - low) / step - 1e-9))
    return [low + step * i for i in range(n)]


def turn(angle: float) -> tuple[float, float]:
    t = math.radians(angle)
    return math.cos(t), math.sin(t)


def _origin(c: Column, s: Column, x: Column, y: Column, half: int, centre: str = "pixel") -> tuple[Column, Column]:
    """Where a pixel of the turned page comes from, in 1/1024 pixels: turned counter-clockwise around its middle pixel, or its true middle."""
    of = lambda n: F.floor(F.col(n) / 2).cast("double") if centre == "pixel" else (F.col(n) - 1) / F.lit(2.0)
    cx, cy = of("width"), of("height")
    at = lambda d: F.rint(d * float(SCALE)).cast("long")
    sx = at(c * x) + at(-s * y + (cx - c * cx + s * cy)) + half
    sy = at(s * x) + at(c * y + (cy - s * cx - c * cy)) + half
    return sx, sy


def cubic_weights() -> list[list[float]]:
    """Weights of four neighbours for each fraction of 1/32, Keys' kernel with a = -0.75; all are multiples of 2**-17."""
    a = -0.75

    def w(d: float) -> float:
        return (a + 2) * d**3 - (a + 3) * d**2 + 1 if d <= 1 else a * d**3 - 5 * a * d**2 + 8 * a * d - 4 * a

    return [[w(1 + t), w(t), w(1 - t), w(2 - t)] for t in (k / STEPS for k in range(STEPS))]


def _quads(pixels: DataFrame, border: str) -> DataFrame:
    """page_id, ty, x0, q: for each place of a row the values at x0 - 1 to x0 + 2, those beyond the page by the border's rule.

    Places from -2 to the row's length are there; what is further out has only the border in reach, as these have.
    """
    w = Window.partitionBy("page_id", "y").orderBy("x")
    v, beyond = F.col("v"), F.col("v") if border == "replicate" else F.lit(0).cast("long")
    after = F.lead("v", 1).over(w)
    rows = pixels.select(
        "page_id", "y", "x", "v", F.coalesce(F.lag("v", 1).over(w), beyond).alias("m"), F.coalesce(after, beyond).alias("p"),
        F.coalesce(F.lead("v", 2).over(w), after if border == "replicate" else F.lit(None), beyond).alias("p2"), after.isNull().alias("last"),
    )
    quad = lambda x0, *q: F.struct(x0.cast("long").alias("x0"), F.array(*q).alias("q"))
    out = beyond
    inside, edge = F.array(quad(F.col("x"), F.col("m"), v, F.col("p"), F.col("p2"))), F.array()
    left = F.when(F.col("x") == 0, F.array(quad(F.lit(-2), out, out, out, v), quad(F.lit(-1), out, out, v, F.col("p"))))
    right = F.when(F.col("last"), F.array(quad(F.col("x") + 1, v, out, out, out)))
    kind = "array<struct<x0:bigint,q:array<bigint>>>"
    every = F.concat(inside.cast(kind), F.coalesce(left.cast(kind), edge.cast(kind)), F.coalesce(right.cast(kind), edge.cast(kind)))
    return rows.select("page_id", F.col("y").alias("ty"), F.explode(every).alias("e")).select("page_id", "ty", "e.x0", "e.q")


def rotated(pixels: DataFrame, angle: float, method: str = "cubic", border: str = "replicate", centre: str = "pixel", truncate: bool = False) -> DataFrame:
    """pixels turned counter-clockwise by `angle` degrees around the middle, in their own size.

    method: nearest, linear (2 x 2 weights) or cubic (4 x 4); border: replicate, or zero; centre: pixel (width // 2, height // 2), or middle, half
    a pixel before it where a side is even; truncate: cuts values to whole numbers instead of rounding them. A place joins with the rows of pixels that it
    needs, four at most, each of which brings its four columns along.
    """
    if method not in ("nearest", "linear", "cubic"):
        raise ValueError(f"unknown interpolation {method!r}")
    if border not in ("replicate", "zero"):
        raise ValueError(f"unknown border {border!r}")
    if centre not in ("pixel", "middle"):
        raise ValueError(f"unknown centre {centre!r}")
    c, s = map(F.lit, turn(angle))
    sx, sy = _origin(c, s, F.col("x"), F.col("y"), SCALE // 2 if method == "nearest" else SCALE // STEPS // 2, centre)
    places = pixels.join(sizes_of(pixels), "page_id").select("page_id", "y", "x", "height", "width", sx.alias("sx"), sy.alias("sy"))
    top, left = F.col("height") - 1, F.col("width") - 1
    if method == "nearest":
        near = places.select("page_id", "y", "x", "height", "width", F.shiftright("sy", 10).alias("ty"), F.shiftright("sx", 10).alias("tx"))
        if border == "replicate":
            near = near.withColumns({"ty": F.least(F.greatest("ty", F.lit(0)), top), "tx": F.least(F.greatest("tx", F.lit(0)), left)})
        found = near.join(pixels.select("page_id", F.col("y").alias("ty"), F.col("x").alias("tx"), "v"), ["page_id", "ty", "tx"], "left")
        return found.select("page_id", "y", "x", F.coalesce("v", F.lit(0)).alias("v"))
    fine = [F.shiftright(c, 5) for c in ("sx", "sy")]
    split = places.select("page_id", "y", "x", "height", "width", *(e for n, f in zip("xy", fine) for e in (F.shiftright(f, 5).alias(f"{n}0"), f.bitwiseAND(31).cast("int").alias(f"f{n}"))))
    if method == "cubic":
        table = F.array(*(F.array(*map(F.lit, w)) for w in cubic_weights()))
        weights, taps = (lambda f: F.element_at(table, F.col(f) + 1)), range(4)
    else:
        weights, taps = (lambda f: F.array(F.lit(0.0), 1 - F.col(f) / STEPS, F.col(f) / STEPS, F.lit(0.0))), (1, 2)
    weighed = split.withColumns({"wx": weights("fx"), "wy": weights("fy")})
    rows = weighed.select("page_id", "y", "x", "height", F.least(F.greatest("x0", F.lit(-2)), F.col("width")).alias("x0"), "wx", F.explode(F.array(*(F.struct((F.col("y0") + k - 1).alias("ty"), F.get("wy", F.lit(k)).alias("w")) for k in taps))).alias("t"))
    ty = F.col("t.ty") if border == "zero" else F.least(F.greatest(F.col("t.ty"), F.lit(0)), F.col("height") - 1)
    met = rows.select("page_id", "y", "x", "x0", "wx", F.col("t.w").alias("w"), ty.alias("ty")).join(_quads(pixels, border), ["page_id", "ty", "x0"], "left")
    part = sum((F.get("wx", F.lit(i)) * F.coalesce(F.get("q", F.lit(i)), F.lit(0)) for i in range(4)), F.lit(0.0))
    total = met.groupBy("page_id", "y", "x").agg(F.sum(F.col("w") * part).alias("total"))
    return total.select("page_id", "y", "x", F.least(F.greatest(F.floor("total").cast("double") if truncate else F.rint("total"), F.lit(0.0)), F.lit(255.0)).cast("long").alias("v"))


def turned_ink(ink: DataFrame, angles: list[float]) -> DataFrame:
    """page_id, k, y, x, height, width: ink (page_id, y, x, height, width) turned by each angle (number k), nearest pixel, nothing from outside.

    A set pixel tries the nine places around where it goes to and keeps those that come from it, so nothing is joined or shuffled.
    """
    turns = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(turn(a)[0]).alias("c"), F.lit(turn(a)[1]).alias("s")) for k, a in enumerate(angles)))
    return scattered(ink.withColumn("_t", F.explode(turns)).select(*ink.columns, "_t.*")).drop("c", "s")


def scattered(ink: DataFrame) -> DataFrame:
    """ink with its turn's cosine c and sine s: each pixel at the places that come from it."""
    c, s, x, y = (F.col(n) for n in "csxy")
    cx, cy = F.floor(F.col("width") / 2).cast("double"), F.floor(F.col("height") / 2).cast("double")
    near = [F.rint(v).cast("long") for v in (c * (x - cx) + s * (y - cy) + cx, -s * (x - cx) + c * (y - cy) + cy)]
    tries = F.array(*(F.struct((near[0] + dx).alias("x2"), (near[1] + dy).alias("y2")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)))
    others = [n for n in ink.columns if n not in ("x", "y")]
    tried = ink.select(*others, "x", "y", F.explode(tries).alias("_p")).select(*others, "x", "y", "_p.*")
    sx, sy = _origin(c, s, F.col("x2"), F.col("y2"), SCALE // 2)
    inside = (F.col("x2") >= 0) & (F.col("y2") >= 0) & (F.col("x2") < F.col("width")) & (F.col("y2") < F.col("height"))
    own = tried.where(inside & (F.shiftright(sx, 10) == x) & (F.shiftright(sy, 10) == y))
    return own.select(*others, F.col("x2").alias("x"), F.col("y2").alias("y"))


# --- angles ------------------------------------------------------------------------------------


def quarter(pixels: DataFrame) -> DataFrame:
    """Sums of whole 4 x 4 blocks, 0 where nothing is set; a part of a block at the edge is left out."""
    s = sizes_of(pixels)
    blocks = pixels.join(s, "page_id").withColumns({"y": F.floor(F.col("y") / 4), "x": F.floor(F.col("x") / 4)})
    inside = blocks.where((F.col("y") < F.floor(F.col("height") / 4)) & (F.col("x") < F.floor(F.col("width") / 4)))
    return inside.groupBy("page_id", "y", "x").agg(F.sum("v").alias("v"))


def _turns(angles: list[float]) -> Column:
    return F.array(*(F.struct(F.lit(k).alias("k"), F.lit(a).alias("angle"), F.lit(turn(a)[0]).alias("c"), F.lit(turn(a)[1]).alias("s")) for k, a in enumerate(angles)))


def angle_sums(pixels: DataFrame, sizes: DataFrame, axis: str) -> DataFrame:
    """page_id, k, angle, bin, total, bins: sums of v along the rows (axis 'y') or columns ('x') of the page turned by each of its angles.

    pixels: page_id, y, x, v, turns (array of k, angle, c, s); those of v = 0 may be missing. A pixel adds to one bin an angle, summed in
    its task first. Rows are those of a turned page of its own size; columns those of a frame that holds the whole page however it
    is turned (the Radon transform), turned the other way round.
    """
    if axis not in ("x", "y"):
        raise ValueError(f"unknown axis {axis!r}")
    at = pixels.where("v != 0").join(sizes, "page_id").withColumn("t", F.explode("turns")).select("page_id", "y", "x", "v", "height", "width", "t.*")
    cx, cy = F.floor(F.col("width") / 2).cast("double"), F.floor(F.col("height") / 2).cast("double")
    dx, dy = F.col("x") - cx, F.col("y") - cy
    if axis == "y":
        place, bins = -F.col("s") * dx + F.col("c") * dy + cy, F.col("height")
    else:
        bins = F.ceil(F.sqrt(F.lit(2.0)) * F.greatest("height", "width"))
        place = F.col("c") * dx - F.col("s") * dy + F.floor(bins / 2)
    binned = at.select("page_id", "k", "angle", F.floor(place + 0.5).alias("bin"), "v", bins.cast("long").alias("bins"))
    return binned.where("bin >= 0 and bin < bins").groupBy("page_id", "k", "angle", "bin", "bins").agg(F.sum("v").alias("total"))


def angle_scores(sums: DataFrame, kind: str) -> DataFrame:
    """page_id, k, angle, score: 'sharpness', the squared differences of neighbouring bins, or 'variance' over all bins, empty ones included."""
    if kind == "variance":
        n, s, q = (F.col(c).cast("decimal(19,0)") for c in ("bins", "s", "q"))
        moments = sums.groupBy("page_id", "k", "angle", "bins").agg(F.sum("total").alias("s"), F.sum(F.col("total") * F.col("total")).alias("q"))
        return moments.select("page_id", "k", "angle", ((n * q - s * s).cast("double") / (n * n).cast("double")).alias("score"))
    if kind != "sharpness":
        raise ValueError(f"unknown score {kind!r}")
    w = Window.partitionBy("page_id", "k").orderBy("bin")
    t, before, after = F.col("total"), F.lag("bin").over(w), F.lead("bin").over(w)
    # an empty neighbour is a step to 0, but for the frame's own ends
    joined = F.when(before == F.col("bin") - 1, (t - F.lag("total").over(w)) * (t - F.lag("total").over(w))).when(F.col("bin") > 0, t * t).otherwise(0)
    step = F.when((F.col("bin") < F.col("bins") - 1) & (after.isNull() | (after > F.col("bin") + 1)), t * t).otherwise(0)
    return sums.select("page_id", "k", "angle", (joined + step).alias("d")).groupBy("page_id", "k", "angle").agg(F.sum("d").cast("double").alias("score"))


def before_stop(scores: DataFrame, run: int = 5) -> DataFrame:
    """scores up to the first angle that ends a run of `run` scores none of which is above the one before it."""
    w = Window.partitionBy("page_id").orderBy("k")
    falls = F.col("score") <= F.lag("score").over(w)
    flat = scores.withColumn("_f", falls.cast("int"))
    ends = F.sum("_f").over(w.rowsBetween(-(run - 2), 0)) == run - 1
    marked = flat.withColumn("_e", F.coalesce(ends, F.lit(False)).cast("int"))
    stops = F.coalesce(F.sum("_e").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return marked.withColumn("_n", stops).where("_n = 0").drop("_f", "_e", "_n")


def best_angle(scores: DataFrame) -> DataFrame:
    """page_id, k, angle, score of each page's greatest score, the first of equals."""
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("score"), "k"))
    return scores.withColumn("_n", nth).where("_n = 1").drop("_n")


def fine_angles(coarse: list[float], reach: float, width: float, step: float) -> list[list[float]]:
    """For each coarse angle the angles around it, within the reach of the search."""
    return [angle_list(max(-reach, a - width), min(reach, a + width), step) for a in coarse]


def search_scores(fine: DataFrame, axis: str, kind: str, reach=5.0, coarse_step=0.5, width=1.0, fine_step=0.2, coarse: DataFrame | None = None, stop_early: bool = False) -> DataFrame:
    """page_id, pass (0 coarse, 1 fine), k, angle, score of all angles tried.

    fine: page_id, y, x, v of every pixel; coarse: the smaller pages of the first pass, by default fine's quarter. The fine angles of a page follow from its
    best coarse one through a literal list of lists. Pages without ink give no rows.
    """
    first = angle_list(-reach, reach, coarse_step)
    small = quarter(fine) if coarse is None else coarse
    wide = angle_scores(angle_sums(small.withColumn("turns", _turns(first)), sizes_of(small), axis), kind)
    wide = before_stop(wide) if stop_early else wide
    lists = F.array(*map(_turns, fine_angles(first, reach, width, fine_step)))
    own = best_angle(wide).select("page_id", F.element_at(lists, F.col("k") + 1).alias("turns"))
    close = angle_scores(angle_sums(fine.join(own, "page_id"), sizes_of(fine), axis), kind)
    return wide.withColumn("pass", F.lit(0)).unionByName(close.withColumn("pass", F.lit(1))).select("page_id", "pass", "k", "angle", "score")


def found_angle(scores: DataFrame) -> DataFrame:
    """page_id, angle, best, mean, deviation, confidence: the best fine angle, and how far the best score stands out of all."""
    fine = best_angle(scores.where("pass = 1")).select("page_id", "angle")
    n, mean = F.count("*"), F.avg("score")
    spread = F.sqrt(F.greatest(F.sum(F.col("score") * F.col("score")) / n - mean * mean, F.lit(0.0)))
    spread_of = scores.groupBy("page_id").agg(F.max("score").alias("best"), mean.alias("mean"), spread.alias("deviation"))
    sure = F.least(F.lit(1.0), F.col("best") / (F.col("mean") + F.col("deviation") + 1e-6))
    return fine.join(spread_of, "page_id").withColumn("confidence", sure)


# --- lines at any small turn ---------------------------------------------------------------------

_SQUARE = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]


def _beside(ink: DataFrame) -> DataFrame:
    """Each set pixel at the places of its 3 x 3 square that lie on the page."""
    tries = F.array(*(F.struct((F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x")) for dy, dx in _SQUARE))
    others = [c for c in ink.columns if c not in ("x", "y")]
    moved = ink.select(*others, F.explode(tries).alias("_p")).select(*others, "_p.y", "_p.x")
    return moved.where("y >= 0 and x >= 0 and y < height and x < width")


def closed_ink(ink: DataFrame) -> DataFrame:
    """ink (also height, width) after a closing with a 3 x 3 square, whose parts beyond the page don't count."""
    grown = _beside(ink).distinct()
    keys = [c for c in ink.columns if c not in ("x", "y")]
    met = _beside(grown).groupBy(*keys, "y", "x").agg(F.count("*").alias("_n"))
    across = lambda c, n: 3 - (F.col(c) == 0).cast("int") - (F.col(c) == F.col(n) - 1).cast("int")
    return met.where(F.col("_n") == across("y", "height") * across("x", "width")).drop("_n")


def packed_ink(ink: DataFrame) -> DataFrame:
    """page_id, height, width, ink: pages of ink (page_id, y, x, height, width) as one row each, the ink as an array of y and the xs in it."""
    own = F.struct(F.col("y").cast("int").alias("y"), F.array(F.col("x").cast("int")).alias("xs"))
    return ink.groupBy("page_id").agg(F.first("height").alias("height"), F.first("width").alias("width"), F.collect_list(own).alias("ink"))


#: Rows that one batch of lines has, about.
LINE_ROWS = 200_000


def skewed_lines(ink: DataFrame, h_size: int, v_size: int, tolerance: float, step: float) -> DataFrame:
    """page_id, orient, y, x of ink that is part of a line of h_size or v_size pixels at any turn within the tolerance.

    ink: page_id, y, x, height, width, or packed_ink(). For each angle the page is turned, its runs along rows and columns are opened and turned back; what any
    angle keeps is united, and closed. A page stays one row until its lines are known, so no row for a turned pixel is dealt or sorted.
    """
    turns = [(turn(a), turn(-a)) for a in angle_list(-tolerance, tolerance, step)]
    pages = bounded(ink if "ink" in ink.columns else packed_ink(ink))
    kind = dict(pages.dtypes)["page_id"]

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for page, height, width, own in zip(*(batch.column(c) for c in ("page_id", "height", "width", "ink"))):
                mask = np.zeros((height.as_py(), width.as_py()), bool)
                xs = own.values.field("xs")
                mask[np.repeat(own.values.field("y").to_numpy(), xs.value_lengths().to_numpy()), xs.flatten().to_numpy()] = True
                for orient, found in zip("hv", lines_at_turns(mask, h_size, v_size, turns)):
                    y, x = np.nonzero(found)
                    held.append(pa.RecordBatch.from_arrays([pa.repeat(page, len(y)), pa.repeat(orient, len(y)), pa.array(y, pa.int64()), pa.array(x, pa.int64())], names=["page_id", "orient", "y", "x"]))
                    n += len(y)
                if n >= LINE_ROWS:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return pages.select("page_id", "height", "width", "ink").mapInArrow(run, f"page_id {kind}, orient string, y long, x long")
