"""Tag boxes: band, candidates, scores, suppression of overlaps, consistency of rows. Boxes: page_id, box_id, x, y, w, h."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lines import bound


def tag_band(rows: DataFrame, heights: DataFrame, min_dark: int = 200, low: float = 0.02, high: float = 0.4, margin: int = 10) -> DataFrame:
    """page_id, top, bottom: around the rows of the upper page with more than min_dark dark pixels. rows: page_id, i, total."""
    inside = (F.col("i") > F.col("height") * low) & (F.col("i") < F.col("height") * high) & (F.col("total") > min_dark)
    found = rows.join(heights, "page_id").where(inside).groupBy("page_id", "height").agg(F.min("i").alias("a"), F.max("i").alias("b"))
    return found.select("page_id", F.greatest(F.col("a") - margin, F.lit(0)).alias("top"), F.least(F.col("b") + margin, F.col("height") - 1).alias("bottom"))


def classic_filter(boxes: DataFrame, min_area=2000, max_area=60000, min_aspect=0.3, max_aspect=1.8, min_dark=0.7) -> DataFrame:
    """Boxes (also area, dark) strictly within the bounds of aspect and area, and dark enough."""
    box = F.struct("w", "h", "area", "dark")
    return boxes.where(is_classic(box, min_area, max_area, min_aspect, max_aspect, min_dark))


def is_classic(box: Column, min_area=2000, max_area=60000, min_aspect=0.3, max_aspect=1.8, min_dark=0.7) -> Column:
    """classic_filter()'s condition on a struct w, h, area, dark."""
    aspect = box["w"] / box["h"]
    return (aspect > min_aspect) & (aspect < max_aspect) & (box["area"] > min_area) & (box["area"] < max_area) & (box["dark"] >= min_dark)


def candidate_reason(width, height, size: tuple, aspect: tuple[float, float], min_dark: float, reject_red: bool = True, tall: tuple | None = None, box: Column | None = None) -> Column:
    """Why a box (also dark, sat, hue) is no candidate: bounds, shape, light, red; null for candidates.

    size: least and greatest width, and height unless `tall` has its own; these and the page's sides may be columns. box: a struct that holds
    the box instead of the row's columns.
    """
    of = F.col if box is None else lambda n: box[n]
    a = of("w") / F.greatest(of("h"), F.lit(1))
    out = (of("x") < 0) | (of("y") < 0) | (of("x") + of("w") > width) | (of("y") + of("h") > height)
    fits = of("w").between(*size) & of("h").between(*(tall or size)) & a.between(*aspect)
    red = (of("sat") > 70) & ((of("hue") < 15) | (of("hue") > 165)) & (of("dark") < 0.70)
    reason = F.when(out, "bounds").when(~fits, "shape").when(of("dark") < min_dark, "light")
    return reason.when(red, "red") if reject_red else reason


def tag_score(dark: Column, glyphs: Column, w: Column, h: Column) -> Column:
    """0.60 darkness + 0.25 nearness of the glyphs (6 at most) to three + 0.15 shape."""
    a = w / F.greatest(h, F.lit(1))
    shape = F.when(a.between(0.28, 1.60), 1.0).otherwise(0.5)
    return 0.60 * dark + 0.25 / (1 + F.abs(F.least(glyphs, F.lit(6)) - 3)) + 0.15 * shape


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two structs x, y, w, h; 0 for an empty union."""
    side = lambda p, s: F.greatest(F.lit(0), F.least(a[p] + a[s], b[p] + b[s]) - F.greatest(a[p], b[p]))
    both = side("x", "w") * side("y", "h")
    union = a["w"] * a["h"] + b["w"] * b["h"] - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def nms(boxes: DataFrame, threshold: float = 0.30, also: tuple[str, ...] = ()) -> DataFrame:
    """Greedy suppression per page: by falling area (then box_id), a box stays if no kept box overlaps it by more.

    also: further columns that the boxes bring along.
    """
    columns = ("box_id", "x", "y", "w", "h", *also)
    lists = boxes.groupBy("page_id").agg(F.collect_list(F.struct(*columns)).alias("b"))
    kinds = dict(boxes.dtypes)
    return lists.select("page_id", F.inline(apart(F.col("b"), threshold, {c: kinds[c] for c in also}))).drop("o")


def apart(boxes: Column, threshold: float = 0.30, also: dict[str, str] | None = None) -> Column:
    """nms() of one page's array of boxes; also: further fields that they bring along, and their types. Field o orders them."""
    also = also or {}
    ordered = F.sort_array(F.transform(boxes, lambda b: F.struct((-b["w"] * b["h"]).alias("o"), *(b[c].alias(c) for c in ("box_id", "x", "y", "w", "h", *also)))))

    def step(kept: Column, box: Column) -> Column:
        return F.when(F.forall(kept, lambda k: iou(box, k) <= threshold), F.concat(kept, F.array(box))).otherwise(kept)

    more = "".join(f",{c}:{kind}" for c, kind in also.items())
    empty = F.array().cast(f"array<struct<o:bigint,box_id:bigint,x:bigint,y:bigint,w:bigint,h:bigint{more}>>")
    return F.aggregate(ordered, empty, step)


def _median(values: Column) -> Column:
    """F.median() of an array; null for an empty one."""
    return bound(F.sort_array(values), lambda v: (F.get(v, F.floor((F.size(v) - 1) / 2).cast("int")) + F.get(v, F.floor(F.size(v) / 2).cast("int"))) / 2)


def _middle_y(box: Column) -> Column:
    return box["y"] + box["h"] / 2


def near_median(boxes: Column, least_tau: float = 28.0) -> Column:
    """row_filter_median() of one page's array of boxes."""
    def near(b: Column) -> Column:
        page = F.struct(_median(F.transform(b, _middle_y)).alias("y0"), _median(F.transform(b, lambda x: x["h"])).alias("hm"))
        return bound(page, lambda p: F.filter(b, lambda x: F.abs(_middle_y(x) - p["y0"]) <= F.greatest(0.25 * p["hm"], F.lit(least_tau))))

    return bound(boxes, lambda b: F.when(F.size(b) < 2, b).otherwise(near(b)))


def near_theil_sen(boxes: Column, least_tau: float = 28.0) -> Column:
    """row_filter_theil_sen() of one page's array of boxes."""
    x = lambda b: b["x"] + b["w"] / 2

    def near(b: Column) -> Column:
        after = lambda p: F.filter(b, lambda q: (p["box_id"] < q["box_id"]) & (F.abs(x(q) - x(p)) >= 1e-6))
        slopes = F.flatten(F.transform(b, lambda p: F.transform(after(p), lambda q: (_middle_y(q) - _middle_y(p)) / (x(q) - x(p)))))
        with_rest = lambda s: F.struct(s.alias("slope"), _median(F.transform(b, lambda p: _middle_y(p) - s * x(p))).alias("rest"), _median(F.transform(b, lambda p: p["h"])).alias("hm"))
        fit = bound(F.coalesce(_median(slopes), F.lit(0.0)), with_rest)
        return bound(fit, lambda f: F.filter(b, lambda p: F.abs(_middle_y(p) - (f["slope"] * x(p) + f["rest"])) <= F.greatest(0.25 * f["hm"], F.lit(least_tau))))

    return bound(boxes, lambda b: F.when(F.size(b) < 2, b).otherwise(near(b)))


def row_filter_median(boxes: DataFrame, least_tau: float = 28.0) -> DataFrame:
    """Boxes whose middle is near their page's median; a page with one box keeps it."""
    w = Window.partitionBy("page_id")
    page = {"_y0": F.median(F.col("y") + F.col("h") / 2).over(w), "_hm": F.median("h").over(w), "_n": F.count("*").over(w)}
    near = F.abs(F.col("y") + F.col("h") / 2 - F.col("_y0")) <= F.greatest(0.25 * F.col("_hm"), F.lit(least_tau))
    return boxes.withColumns(page).where((F.col("_n") < 2) | near).select(boxes.columns)


def theil_sen(points: DataFrame) -> DataFrame:
    """page_id, slope, intercept of a robust line through points (page_id, point_id, px, py).

    Medians of the slopes of all pairs at different px and of the rests; a page's points bound its pairs.
    """
    p, q = points.alias("p"), points.alias("q")
    pairs = p.join(q, (F.col("p.page_id") == F.col("q.page_id")) & (F.col("p.point_id") < F.col("q.point_id")) & (F.abs(F.col("q.px") - F.col("p.px")) >= 1e-6))
    slopes = pairs.groupBy(F.col("p.page_id").alias("page_id")).agg(F.median((F.col("q.py") - F.col("p.py")) / (F.col("q.px") - F.col("p.px"))).alias("slope"))
    with_slope = points.join(slopes, "page_id", "left").withColumn("slope", F.coalesce("slope", F.lit(0.0)))
    return with_slope.groupBy("page_id").agg(F.first("slope").alias("slope"), F.median(F.col("py") - F.col("slope") * F.col("px")).alias("intercept"))


def row_filter_theil_sen(boxes: DataFrame, least_tau: float = 28.0) -> DataFrame:
    """Boxes whose middle is near a robust line through their page's middles."""
    middle = boxes.select("page_id", F.col("box_id").alias("point_id"), (F.col("x") + F.col("w") / 2).alias("px"), (F.col("y") + F.col("h") / 2).alias("py"))
    page = boxes.groupBy("page_id").agg(F.median("h").alias("hm"), F.count("*").alias("n"))
    both = boxes.join(theil_sen(middle), "page_id").join(page, "page_id")
    fit = F.col("slope") * (F.col("x") + F.col("w") / 2) + F.col("intercept")
    near = F.abs(F.col("y") + F.col("h") / 2 - fit) <= F.greatest(0.25 * F.col("hm"), F.lit(least_tau))
    return both.where((F.col("n") < 2) | near).select(boxes.columns)


def nearest_to_centre(parts: DataFrame, width: Column, height: Column) -> DataFrame:
    """Of each page's components (also label, cx, cy) the one nearest the middle, the first of equals."""
    d = F.pow(F.col("cx") - width / 2, 2) + F.pow(F.col("cy") - height / 2, 2)
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy(d, "label"))
    return parts.withColumn("nth", nth).where("nth = 1").drop("nth")
