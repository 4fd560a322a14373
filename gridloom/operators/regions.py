"""Regions of pages through their component trees. pixels: page_id, y, x, v (whole numbers), without gaps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.kernels import trees

_NODES = "level long, first long, parent long, area long, x long, y long, w long, h long, growth double, parent_growth double, child_growth double"


def _dense(group: pa.Table) -> np.ndarray:
    y, x, v = (group.column(c).to_numpy() for c in "yxv")
    out = np.zeros((int(y.max()) + 1, int(x.max()) + 1), np.int64)
    out[y, x] = v
    return out


def _columns(tree: trees.Tree, delta: int) -> dict[str, np.ndarray]:
    x1, y1, x2, y2 = tree.box.T
    own = trees.growth(tree, delta)
    up, down = trees.neighbours(tree, own)
    values = (tree.level, tree.first, tree.parent, tree.area, x1, y1, x2 - x1 + 1, y2 - y1 + 1, own, up, down)
    return dict(zip((c.split()[0] for c in _NODES.split(", ")), values))


def component_tree(pixels: DataFrame, delta: int = 5) -> DataFrame:
    """page_id, node and its columns (_NODES) for each dark region at the level where it comes to be.

    first is the number of the region's first pixel by rows, parent a node of the page or -1; growth is the least share by which the region grows
    from delta levels below to delta above during its life. A page is one group, as its regions can span it.
    """
    kind = dict(pixels.dtypes)["page_id"]

    def run(group: pa.Table) -> pa.Table:
        columns = _columns(trees.component_tree(_dense(group)), delta)
        n = len(columns["level"])
        page = pa.array([group.column("page_id")[0].as_py()] * n, group.schema.field("page_id").type)
        return pa.table({"page_id": page, "node": pa.array(np.arange(n))} | {k: pa.array(v) for k, v in columns.items()})

    return pixels.select("page_id", "y", "x", "v").groupBy("page_id").applyInArrow(run, f"page_id {kind}, node long, {_NODES}")


def stable(tree: DataFrame, area: tuple[int, int] = (1500, 60000), change: float = 0.25) -> DataFrame:
    """Regions of the tree within the bounds of area that hardly grow, and no more than the regions just inside and around them."""
    grows = F.col("growth")
    return tree.where(F.col("area").between(*area) & (grows <= change) & (grows <= F.col("parent_growth")) & (grows <= F.col("child_growth")))


def stable_regions(pixels: DataFrame, delta: int = 5, area: tuple[int, int] = (1500, 60000), change: float = 0.25) -> DataFrame:
    """page_id, level, area, x, y, w, h, growth of maximally stable dark regions."""
    return stable(component_tree(pixels, delta), area, change).select("page_id", "level", "area", "x", "y", "w", "h", "growth")
