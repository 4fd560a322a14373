"""Pixels as rows: page_id, y, x, v. The relational forms of kernels, for small rasters and as checks of the Arrow ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def threshold(pixels: DataFrame, t: int | Column, inverted: bool = False, above: int = 255) -> DataFrame:
    """v > t becomes `above`, the rest 0; inverted the other way round."""
    hit = F.col("v") > (F.lit(t) if isinstance(t, int) else t)
    return pixels.withColumn("v", F.when(~hit if inverted else hit, above).otherwise(0).cast("long"))


def invert(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("v", 255 - F.col("v"))


def combine(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Bitwise and, or, xor of two rasters of the same pages."""
    ops = {"and": "bitwiseAND", "or": "bitwiseOR", "xor": "bitwiseXOR"}
    if how not in ops:
        raise ValueError(f"unknown operation {how!r}")
    both = a.join(b.withColumnRenamed("v", "v2"), ["page_id", "y", "x"])
    return both.select("page_id", "y", "x", getattr(F.col("v"), ops[how])(F.col("v2")).alias("v"))


def mask_select(pixels: DataFrame, mask: DataFrame, fill: int = 255) -> DataFrame:
    """v where the mask is set, else `fill`."""
    both = pixels.join(mask.withColumnRenamed("v", "m"), ["page_id", "y", "x"])
    return both.select("page_id", "y", "x", F.when(F.col("m") > 0, F.col("v")).otherwise(fill).cast("long").alias("v"))


def histogram(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("page_id", "v").agg(F.count("*").alias("n"))


def _wide(column: str) -> Column:
    """Sums of up to 2**62 multiply without overflow."""
    return F.col(column).cast("decimal(19,0)")


def otsu(pixels: DataFrame) -> DataFrame:
    """page_id, t: the smallest grey level with the greatest variance between classes, from histograms."""
    w = Window.partitionBy("page_id").orderBy("v")
    all_ = Window.partitionBy("page_id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    h = histogram(pixels).select("page_id", "v", F.sum("n").over(upto).alias("n0"), F.sum(F.col("n") * F.col("v")).over(upto).alias("s0"), F.sum("n").over(all_).alias("n1"), F.sum(F.col("n") * F.col("v")).over(all_).alias("s1"))
    between = F.when(F.col("n0") < F.col("n1"), F.pow((_wide("s0") * _wide("n1") - _wide("s1") * _wide("n0")).cast("double"), 2) / (F.col("n0").cast("double") * (F.col("n1") - F.col("n0"))))
    best = h.withColumn("sigma", F.coalesce(between, F.lit(0.0)))
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("sigma"), "v"))
    return best.withColumn("nth", nth).where("nth = 1").select("page_id", F.col("v").alias("t"))


def projection(pixels: DataFrame, axis: str) -> DataFrame:
    """page_id, i, total: sums of v along each row (axis 'y') or column ('x')."""
    if axis not in ("x", "y"):
        raise ValueError(f"unknown axis {axis!r}")
    return pixels.groupBy("page_id", F.col(axis).alias("i")).agg(F.sum("v").alias("total"))


def sharpness(projected: DataFrame) -> DataFrame:
    """page_id, score: the summed squares of differences of neighbouring sums."""
    d = F.col("total") - F.lag("total").over(Window.partitionBy("page_id").orderBy("i"))
    return projected.select("page_id", d.alias("d")).groupBy("page_id").agg(F.coalesce(F.sum(F.col("d") * F.col("d")), F.lit(0)).cast("long").alias("score"))


def variance(projected: DataFrame) -> DataFrame:
    """Population variance, from whole-number sums, so that the order of rows can't show in it."""
    sums = projected.groupBy("page_id").agg(F.count("*").alias("n"), F.sum("total").alias("s"), F.sum(_wide("total") * _wide("total")).cast("decimal(19,0)").alias("q"))
    return sums.select("page_id", ((_wide("n") * F.col("q") - _wide("s") * _wide("s")).cast("double") / (_wide("n") * _wide("n")).cast("double")).alias("variance"))


def runs(ink: DataFrame, along: str = "x") -> DataFrame:
    """page_id, line, a, b (inclusive): maximal runs of ink along rows ('x') or columns ('y')."""
    line = "y" if along == "x" else "x"
    w = Window.partitionBy("page_id", line).orderBy(along)
    islands = ink.select("page_id", F.col(line).alias("line"), F.col(along).alias("p"), (F.col(along) - F.row_number().over(w)).alias("g"))
    return islands.groupBy("page_id", "line", "g").agg(F.min("p").alias("a"), F.max("p").alias("b")).drop("g")


def least_run(start: Column, end: Column, k: int) -> Column:
    """The length that an opening with k pixels asks of a run, given whether it touches the page's start or end."""
    return F.when(start & end, F.lit(1)).when(start, F.lit(k - k // 2)).when(end, F.lit(k // 2 + 1)).otherwise(F.lit(k))


def opened(runs_: DataFrame, k: int, extent: DataFrame | None = None) -> DataFrame:
    """Runs that an opening with a line of k pixels keeps. extent: page_id, size along the runs; without it the runs' own size counts, or a page ends with its last ink.

    What lies outside the page never erodes, so a run at the border may be shorter: by the kernel's part beyond the border.
    """
    n = F.col("b") - F.col("a") + 1
    start, end = F.col("a") == 0, F.col("b") == F.col("size") - 1
    need = least_run(start, end, k)
    if extent is not None:
        sized = runs_.join(extent, "page_id")
    else:
        sized = runs_ if "size" in runs_.columns else runs_.withColumn("size", F.max("b").over(Window.partitionBy("page_id")) + 1)
    return sized.where(n >= need).select("page_id", "line", "a", "b")


def components(ink: DataFrame) -> DataFrame:
    """page_id, x, y, w, h, area of 8-connected components, found run by run within a page."""
    return runs(ink).groupBy("page_id").applyInArrow(_component_stats, "page_id long, x long, y long, w long, h long, area long")


def _component_stats(group):
    import pyarrow as pa

    from gridloom.kernels.components import label_runs

    page = group.column("page_id")[0].as_py()
    line, a, b = (group.column(c).to_numpy() for c in ("line", "a", "b"))
    stats = label_runs(line, a, b)[1]
    names = ("x", "y", "w", "h", "area")
    return pa.table({"page_id": pa.array([page] * len(stats), pa.int64())} | {n: pa.array(stats[:, i], pa.int64()) for i, n in enumerate(names)})


def gutter_segments(columns: DataFrame, widths: DataFrame, search_ratio: float = 0.5, peak: float = 0.3) -> DataFrame:
    """page_id, a, b, width: runs of columns near the middle whose sum is at least `peak` of the greatest there.

    columns: page_id, i, total with every column of the page; widths: page_id, width.
    """
    margin = F.floor((1 - F.lit(search_ratio)) / 2 * F.col("width"))
    window = columns.join(widths, "page_id").where((F.col("i") >= margin) & (F.col("i") < F.col("width") - margin))
    most = F.max("total").over(Window.partitionBy("page_id"))
    peaks = window.withColumn("most", most).where(F.col("total") >= F.lit(peak) * F.col("most"))
    g = F.col("i") - F.row_number().over(Window.partitionBy("page_id").orderBy("i"))
    return peaks.withColumn("g", g).groupBy("page_id", "width", "g").agg(F.min("i").alias("a"), F.max("i").alias("b")).drop("g")


def split_position(segments: DataFrame, widths: DataFrame) -> DataFrame:
    """page_id, split_x, n_segments: between the two segments nearest the middle, in one segment's middle, or halfway."""
    mid = F.floor((F.col("a") + F.col("b")) / 2)
    centre = F.floor(F.col("width") / 2)
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy(F.abs(mid - centre), "a"))
    two = segments.withColumn("nth", nth).groupBy("page_id").agg(
        F.count("*").alias("n"), F.sum(F.col("b") - F.col("a") + 1).alias("peaks"),
        F.sort_array(F.collect_list(F.when(F.col("nth") <= 2, F.struct("a", "b")))).alias("s"),
    )
    both = widths.join(two, "page_id", "left")
    first, second = F.get("s", F.lit(0)), F.get("s", F.lit(1))
    split = F.when(F.coalesce("peaks", F.lit(0)) < 2, centre).when(F.col("n") == 1, F.floor((first["a"] + first["b"]) / 2)).otherwise(F.floor((first["b"] + second["a"]) / 2))
    return both.select("page_id", split.alias("split_x"), F.coalesce("n", F.lit(0)).cast("long").alias("n_segments"))


def densest(ink: DataFrame, axis: str = "x") -> DataFrame:
    """page_id, center: the mean (rounded down) of the columns or rows with the most ink."""
    per = ink.groupBy("page_id", F.col(axis).alias("i")).agg(F.count("*").alias("n"))
    most = F.max("n").over(Window.partitionBy("page_id"))
    return per.withColumn("most", most).where("n = most").groupBy("page_id").agg(F.floor(F.avg("i")).alias("center"))
