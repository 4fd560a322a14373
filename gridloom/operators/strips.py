"""Column strips between vertical boundaries. Lines: page_id, x, y1, y2."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def strip_positions(lines: DataFrame, longest_only: bool = False, min_length_ratio: float = 0.9) -> DataFrame:
    """page_id, x: distinct positions, with longest_only of lines near the page's longest."""
    if longest_only:
        most = F.max(F.abs(F.col("y2") - F.col("y1"))).over(Window.partitionBy("page_id"))
        lines = lines.withColumn("_most", most).where(F.abs(F.col("y2") - F.col("y1")) >= F.col("_most") * F.lit(min_length_ratio))
    return lines.select("page_id", "x").distinct()


def rescaled(positions: DataFrame, widths: DataFrame | Column, tolerance: float = 0.05) -> DataFrame:
    """page_id, x, width: positions scaled to the width where the greatest exceeds it by more than the tolerance.

    Halves round to even. widths: page_id, width, or a column.
    """
    most = F.max("x").over(Window.partitionBy("page_id"))
    sized = positions.withColumn("width", widths) if isinstance(widths, Column) else positions.join(widths, "page_id")
    both = sized.withColumn("_most", most)
    too_far = (F.col("_most") > F.col("width")) & ((F.col("_most") - F.col("width")) / F.col("_most") > tolerance)
    return both.select("page_id", F.when(too_far, F.bround(F.col("x") * (F.col("width") / F.col("_most")), 0).cast("long")).otherwise(F.col("x")).alias("x"), "width")


def strip_bounds(positions: DataFrame, padding_left: int = 20, padding_right: int = 20, min_width: int = 1) -> DataFrame:
    """page_id, column_index (from 1; thin strips leave gaps), left, right, original_left, original_right.

    positions: page_id, x, width.
    """
    w = Window.partitionBy("page_id").orderBy("x")
    pairs = positions.select("page_id", "x", "width", F.lead("x").over(w).alias("next"), F.row_number().over(w).cast("long").alias("column_index")).where("next is not null")
    left, right = F.greatest(F.col("x") - padding_left, F.lit(0)), F.least(F.col("next") + padding_right, F.col("width"))
    out = pairs.select("page_id", "column_index", left.alias("left"), right.alias("right"), F.col("x").alias("original_left"), F.col("next").alias("original_right"))
    return out.where(F.col("right") - F.col("left") >= min_width)
