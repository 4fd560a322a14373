"""Colours of pixels and boxes as expressions. pixels: page_id, y, x, b, g, r."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hue_saturation(b: Column, g: Column, r: Column) -> tuple[Column, Column]:
    """Hue in 0..179 and saturation in 0..255, whole numbers: quotients come from tables of 1/4096 and are rounded to the nearest."""
    v, low = F.greatest(b, g, r), F.least(b, g, r)
    d = v - low
    rounded = lambda n, share: F.shiftright((n * share + 2048).cast("long"), 12)
    table = lambda of, by: F.when(by > 0, F.rint(F.lit(float(of * 4096)) / by)).otherwise(0.0).cast("long")
    turn = F.when(v == r, g - b).when(v == g, b - r + 2 * d).otherwise(r - g + 4 * d)
    hue = rounded(turn, table(30, d))
    return F.when(hue < 0, hue + 180).otherwise(hue), rounded(d, table(255, v))


def grey(b: Column, g: Column, r: Column) -> Column:
    """Luminance in whole numbers, with weights of 1/16384."""
    return F.shiftright((b * 1868 + g * 9617 + r * 4899 + 8192).cast("long"), 14)


def box_colours(pixels: DataFrame, boxes: DataFrame, dark: int = 160) -> DataFrame:
    """page_id, box_id, dark (share of pixels below that grey), sat, hue: means over each of boxes(page_id, box_id, x, y, w, h).

    A box meets the page's rows that it covers, by key; boxes without a pixel give no row.
    """
    hue, sat = hue_saturation(F.col("b"), F.col("g"), F.col("r"))
    seen = pixels.select("page_id", "y", F.col("x").alias("px"), hue.alias("hue"), sat.alias("sat"), (grey(F.col("b"), F.col("g"), F.col("r")) < dark).cast("int").alias("dark"))
    rows = boxes.where("w > 0 and h > 0").select("page_id", "box_id", "x", "w", F.explode(F.sequence("y", F.col("y") + F.col("h") - 1)).alias("y"))
    met = rows.join(seen, ["page_id", "y"]).where((F.col("px") >= F.col("x")) & (F.col("px") < F.col("x") + F.col("w")))
    return met.groupBy("page_id", "box_id").agg(*((F.sum(c) / F.count("*")).alias(c) for c in ("dark", "sat", "hue")))
