"""From lines to a grid of cells. Axes: page_id, orient ('v': x, 'h': y), idx, center."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lines import cluster_positions


def axes(lines: DataFrame, eps: int = 10) -> DataFrame:
    """Positions of grid lines; idx counts from 0 along the axis."""
    return cluster_positions(lines, eps).select("page_id", "orient", "idx", F.col("center").alias("c"))


def intervals(axis: DataFrame, orient: str) -> DataFrame:
    """page_id, idx, a, b: neighbouring positions of one axis."""
    w = Window.partitionBy("page_id", "orient").orderBy("idx")
    return axis.where(F.col("orient") == orient).withColumn("b", F.lead("c").over(w)).where("b is not null").select("page_id", "idx", F.col("c").alias("a"), "b")


def sides(axis: DataFrame) -> DataFrame:
    """page_id, xs, ys: arrays of idx, c, b of the neighbouring positions of both axes."""
    w = Window.partitionBy("page_id", "orient").orderBy("idx")
    pairs = axis.withColumn("b", F.lead("c").over(w)).where("b is not null")
    side = lambda o: F.collect_list(F.when(F.col("orient") == o, F.struct("idx", "c", "b")))
    return pairs.groupBy("page_id").agg(side("v").alias("xs"), side("h").alias("ys"))


def cells(axis: DataFrame) -> DataFrame:
    """page_id, row, col, x1, y1, x2, y2: every pair of neighbouring xs with every pair of neighbouring ys.

    Both axes of a page come from one aggregate, so what they are computed from runs once.
    """
    both = sides(axis)
    met = both.select("page_id", "ys", F.explode("xs").alias("x")).select("page_id", "x", F.explode("ys").alias("y"))
    return met.select("page_id", F.col("y.idx").alias("row"), F.col("x.idx").alias("col"), F.col("x.c").alias("x1"), F.col("y.c").alias("y1"), F.col("x.b").alias("x2"), F.col("y.b").alias("y2"))


def structure(axis: DataFrame) -> DataFrame:
    """page_id, xs, ys, num_rows, num_cols of every page with a line; fewer than two positions make no rows or columns."""
    side = lambda o: F.sort_array(F.collect_list(F.when(F.col("orient") == o, F.col("c"))))
    out = axis.groupBy("page_id").agg(side("v").alias("xs"), side("h").alias("ys"))
    count = lambda c: F.greatest(F.size(c) - 1, F.lit(0)).cast("long")
    return out.select("page_id", "xs", "ys", count("ys").alias("num_rows"), count("xs").alias("num_cols"))


def place(boxes: DataFrame, axis: DataFrame) -> DataFrame:
    """page_id, box_id, row, col of boxes (x1, y1, x2, y2) that lie within one row and one column: the first of each."""
    y = intervals(axis, "h").select("page_id", F.col("idx").alias("row"), F.col("a").alias("ya"), F.col("b").alias("yb"))
    x = intervals(axis, "v").select("page_id", F.col("idx").alias("col"), F.col("a").alias("xa"), F.col("b").alias("xb"))
    in_y = boxes.join(y, "page_id").where("ya <= y1 and y1 < yb and ya < y2 and y2 <= yb").groupBy("page_id", "box_id").agg(F.min("row").alias("row"))
    in_x = boxes.join(x, "page_id").where("xa <= x1 and x1 < xb and xa < x2 and x2 <= xb").groupBy("page_id", "box_id").agg(F.min("col").alias("col"))
    return in_y.join(in_x, ["page_id", "box_id"])


def crop_bounds(cells_: DataFrame, axis: DataFrame, width: int, height: int, padding: int = 20) -> DataFrame:
    """page_id, x1, y1, x2, y2: the cells' bounding box, or that of the axes, padded and clamped to the page."""
    box = cells_.groupBy("page_id").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
    of = lambda f, o: f(F.when(F.col("orient") == o, F.col("c")))
    rest = axis.groupBy("page_id").agg(of(F.min, "v").alias("a1"), of(F.min, "h").alias("b1"), of(F.max, "v").alias("a2"), of(F.max, "h").alias("b2"))
    both = rest.join(box, "page_id", "left")
    low = lambda a, b: F.greatest(F.coalesce(a, b, F.lit(0)) - padding, F.lit(0))
    high = lambda a, b, most: F.least(F.coalesce(a, b, F.lit(most)) + padding, F.lit(most))
    return both.select("page_id", low("x1", "a1").alias("x1"), low("y1", "b1").alias("y1"), high("x2", "a2", width).alias("x2"), high("y2", "b2", height).alias("y2"))


def structure_lines(axis: DataFrame) -> DataFrame:
    """page_id, orient, pos, s, e: the grid's lines from end to end, for overlays; an axis without the other one has no lines."""
    of = lambda f, o: f(F.when(F.col("orient") == o, F.col("c")))
    ends = axis.groupBy("page_id").agg(*(of(f, o).alias(f"{o}{k}") for o in "hv" for k, f in ((0, F.min), (1, F.max))))
    across = lambda k: F.when(F.col("orient") == "h", F.col(f"v{k}")).otherwise(F.col(f"h{k}"))
    return axis.join(ends, "page_id").select("page_id", "orient", F.col("c").alias("pos"), across(0).alias("s"), across(1).alias("e")).where("s is not null")


def cell_outlines(cells_: DataFrame) -> DataFrame:
    """page_id, orient, pos, s, e: the sides of cells (x1, y1, x2, y2), for overlays; a side that two cells share once."""
    side = lambda o, pos, s, e: F.struct(F.lit(o).alias("orient"), F.col(pos).alias("pos"), F.col(s).alias("s"), F.col(e).alias("e"))
    sides = F.array(side("h", "y1", "x1", "x2"), side("h", "y2", "x1", "x2"), side("v", "x1", "y1", "y2"), side("v", "x2", "y1", "y2"))
    return cells_.select("page_id", F.explode(sides).alias("l")).select("page_id", "l.*").distinct()
