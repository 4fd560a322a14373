"""Drawn pages: one for each supplier, of a fixed size, whose ruled table, tags, gutter and margin follow from its key by arithmetic.

What the kernels find on them is therefore known, and SQL states it without looking at a pixel. GRID gives a page's lines
(page_id, n columns, m rows, steps); a page of key k has columns at 40 + i * dx and rows at 100 + j * dy, ruled three
pixels thick, but for the first inner column line, which leaves out the first row (so two cells are one).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from gridloom.operators.pages import IMAGE, batched_images, image_row

from .derived import table

WIDTH, HEIGHT, LEFT, TOP = 400, 300, 40, 100
#: Pages that one task draws.
PAGES = 64
GRID = f"""grid AS (SELECT CAST(s_suppkey AS VARCHAR) AS page_id, CAST(s_suppkey AS BIGINT) AS k, 3 + s_suppkey % 3 AS n, 2 + s_suppkey % 2 AS m, 52 + s_suppkey % 9 AS dx, 50 + s_suppkey % 7 AS dy FROM supplier),
 col_ AS (SELECT page_id, k, n, m, dx, dy, i, {LEFT} + i * dx AS x FROM grid, LATERAL (SELECT unnest(range(0, n + 1)) AS i)),
 row_ AS (SELECT page_id, k, n, m, dx, dy, j, {TOP} + j * dy AS y FROM grid, LATERAL (SELECT unnest(range(0, m + 1)) AS j))"""


#: Bars of text and their first row.
BARS, BAR_TOP = 4, 180
#: The pixels of the ruled table.
DARK = """ink_ AS (SELECT page_id, x - 1 AS x1, x + 1 AS x2, {TOP} + CASE WHEN i = 1 THEN dy ELSE 0 END - 1 AS y1, {TOP} + m * dy + 1 AS y2 FROM col_ UNION ALL SELECT page_id, {LEFT} - 1, {LEFT} + n * dx + 1, y - 1, y + 1 FROM row_),
 dk AS (SELECT DISTINCT page_id, y, x FROM ink_, LATERAL (SELECT unnest(range(y1, y2 + 1)) AS y), LATERAL (SELECT unnest(range(x1, x2 + 1)) AS x))""".format(TOP=TOP, LEFT=LEFT)


def layout(k: int) -> tuple[list[int], list[int]]:
    n, m, dx, dy = 3 + k % 3, 2 + k % 2, 52 + k % 9, 50 + k % 7
    return [LEFT + i * dx for i in range(n + 1)], [TOP + j * dy for j in range(m + 1)]


def ruled(k: int) -> np.ndarray:
    """A grey page with the table alone."""
    xs, ys = layout(k)
    page = np.full((HEIGHT, WIDTH), 255, np.uint8)
    for i, x in enumerate(xs):
        page[(ys[1] if i == 1 else ys[0]) - 1 : ys[-1] + 2, x - 1 : x + 2] = 0
    for y in ys:
        page[y - 1 : y + 2, xs[0] - 1 : xs[-1] + 2] = 0
    return page


def tagged(k: int) -> np.ndarray:
    """A page with six dark tags of 42 by 52 pixels in a row."""
    page = np.full((HEIGHT, WIDTH), 255, np.uint8)
    for t in range(6):
        page[24:76, 12 + 62 * t + k % 10 : 54 + 62 * t + k % 10] = 30
    return page


def tagged_text(k: int) -> np.ndarray:
    """The page with tags and, further down, bars of text, which are none of the tags' business."""
    page = tagged(k)
    for r in range(BARS):
        page[BAR_TOP + 20 * r : BAR_TOP + 6 + 20 * r, 30 + k % 7 + 11 * r : 300 + k % 13] = 40
    return page


#: The capsules' first row and the red frame's size and thickness.
CAPSULES, CAPSULE_TOP, FRAME, THICK = 5, 40, (58, 70), 8


def capsules(k: int) -> np.ndarray:
    """A colour page with five dark tags of 42 by 52 pixels, each with three bright glyphs, and a red frame, which is a stamp and none of them."""
    page = np.full((HEIGHT, WIDTH, 3), 255, np.uint8)
    for t in range(CAPSULES):
        x, y = 12 + 62 * t + k % 10, CAPSULE_TOP + k % 3
        page[y : y + 52, x : x + 42] = 30
        for g in range(3):
            page[y + 4 + 16 * g : y + 14 + 16 * g, x + 16 : x + 26] = 220
    x = 325 + k % 10
    page[CAPSULE_TOP : CAPSULE_TOP + FRAME[1], x : x + FRAME[0]] = (40, 40, 210)
    page[CAPSULE_TOP + THICK : CAPSULE_TOP + FRAME[1] - THICK, x + THICK : x + FRAME[0] - THICK] = 255
    return page


def marked(k: int) -> np.ndarray:
    """The table with pale marks well away from its lines."""
    page = ruled(k)
    for t in range(8):
        y, x = 20 + t * 7, 20 + (k * 13 + t * 41) % 350
        page[y : y + 4, x : x + 6] = 200
    return page


#: Rows and columns of the dark block below the pale table.
BLOCK = (275, 295, 50, 350)


def pale(k: int) -> np.ndarray:
    """A table too pale to count as ink, pale marks away from it, and a dark block of text."""
    page = np.where(marked(k) == 255, 255, 200).astype(np.uint8)
    page[BLOCK[0] : BLOCK[1], BLOCK[2] : BLOCK[3]] = 0
    return page


def shaded(k: int) -> np.ndarray:
    """The page under uneven light, so that every grey level occurs: what pixel kernels are held against."""
    y, x = np.mgrid[0:HEIGHT, 0:WIDTH]
    light = 180 + (x * 3 + y * 5 + k) % 60
    return np.where(ruled(k) == 0, 20 + (x * 7 + y * 11 + k) % 40, light).astype(np.uint8)


#: The same as SQL, over the pixels of a page's upper left part.
PART = (60, 90)
SHADED = f"""{GRID}, ink_ AS (SELECT page_id, x - 1 AS x1, x + 1 AS x2, {TOP} + CASE WHEN i = 1 THEN dy ELSE 0 END - 1 AS y1, {TOP} + m * dy + 1 AS y2 FROM col_ UNION ALL SELECT page_id, {LEFT} - 1, {LEFT} + n * dx + 1, y - 1, y + 1 FROM row_),
 at_ AS (SELECT page_id, k, x, y FROM grid, LATERAL (SELECT unnest(range({LEFT - 10}, {LEFT - 10 + PART[1]})) AS x), LATERAL (SELECT unnest(range({TOP - 10}, {TOP - 10 + PART[0]})) AS y)),
 dark_ AS (SELECT DISTINCT a.page_id, x, y FROM at_ a JOIN ink_ i ON i.page_id = a.page_id AND x BETWEEN x1 AND x2 AND y BETWEEN y1 AND y2),
 shade AS (SELECT a.page_id, a.x - {LEFT - 10} AS x, a.y - {TOP - 10} AS y, CASE WHEN d.x IS NOT NULL THEN 20 + (a.x * 7 + a.y * 11 + k) % 40 ELSE 180 + (a.x * 3 + a.y * 5 + k) % 60 END AS v
 FROM at_ a LEFT JOIN dark_ d ON d.page_id = a.page_id AND d.x = a.x AND d.y = a.y)"""


def shaded_part(k: int) -> np.ndarray:
    return np.ascontiguousarray(shaded(k)[TOP - 10 : TOP - 10 + PART[0], LEFT - 10 : LEFT - 10 + PART[1]])


def sometimes(k: int) -> np.ndarray | None:
    """The ruled page, or for each seventh key none, as where a file can't be read."""
    return None if k % 7 == 3 else ruled(k)


def spread(k: int) -> np.ndarray:
    """Two pages side by side with a dark line between them, 8 to 24 pixels from the middle."""
    page = np.full((HEIGHT, WIDTH), 255, np.uint8)
    page[10 : HEIGHT - 10, 8 + WIDTH // 2 + k % 17 : 12 + WIDTH // 2 + k % 17] = 0
    return page


def margined(k: int) -> np.ndarray:
    """A white page on a dark scanner bed."""
    page = np.full((HEIGHT, WIDTH), 25, np.uint8)
    page[28 + k % 5 : HEIGHT - 30 - k % 7, 34 + k % 11 : WIDTH - 29 - k % 3] = 240
    return page


def turned(k: int) -> np.ndarray:
    """Rows of text, drawn as bars, turned by k mod 5 - 2 degrees."""
    from gridloom.kernels.geometry import rotate

    page = np.full((HEIGHT, WIDTH), 255, np.uint8)
    for y in range(60, 240, 12):
        page[y : y + 4, 50 : 350 - (y * 7 + k) % 90] = 0
    return rotate(page, float(k % 5 - 2))


def pages_of(spark: SparkSession, sf_dir: str, draw) -> DataFrame:
    """draw(key) for each supplier, as page images."""

    def run(batches):
        return batched_images(image_row(str(k), draw(k)) for batch in batches for k in batch.column(0).to_pylist())

    keys = table(spark, sf_dir, "supplier").select("s_suppkey")
    count = keys.count()
    tasks = max(min(count, spark.sparkContext.defaultParallelism), -(-count // PAGES), 1)
    return keys.repartition(tasks, "s_suppkey").mapInArrow(run, IMAGE)
