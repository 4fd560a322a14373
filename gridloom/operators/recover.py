"""Merged cells: boundaries that no line covers join the cells on either side."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.kernels.components import least_labels

from .grid import sides
from .lines import anchor_sets


def inner_boundaries(cells: DataFrame, with_cells: bool = False) -> DataFrame:
    """page_id, orient, row, col, row2, col2, coord, a, b: what lies between each cell and its right or lower neighbour.

    Both windows lie within a page, so the cells are dealt once. with_cells adds each cell as a row of orient 'c', its
    sides as coord, row2 (x1, y1) and a, b (x2, y2).
    """
    right = Window.partitionBy("page_id", "row").orderBy("col")
    below = Window.partitionBy("page_id", "col").orderBy("row")
    cells = cells.select("*", F.lead("col").over(right).alias("col_2"), F.lead("row").over(below).alias("row_2"))
    side = lambda o, ok, row2, col2, c, a, b: F.when(ok, F.struct(F.lit(o).alias("orient"), row2.alias("row2"), col2.alias("col2"), F.col(c).alias("coord"), F.col(a).alias("a"), F.col(b).alias("b")))
    v = side("v", F.col("col_2") == F.col("col") + 1, F.col("row"), F.col("col_2"), "x2", "y1", "y2")
    h = side("h", F.col("row_2") == F.col("row") + 1, F.col("row_2"), F.col("col"), "y2", "x1", "x2")
    own = F.struct(F.lit("c").alias("orient"), F.col("y1").alias("row2"), F.col("col").alias("col2"), F.col("x1").alias("coord"), F.col("x2").alias("a"), F.col("y2").alias("b"))
    found = cells.select("page_id", "row", "col", F.explode(F.array_compact(F.array(v, h, own) if with_cells else F.array(v, h))).alias("n"))
    return found.select("page_id", "n.orient", "row", "col", "n.row2", "n.col2", "n.coord", "n.a", "n.b")


def coverage(boundaries: DataFrame, lines: DataFrame, tol: int = 15) -> DataFrame:
    """boundaries with coverage: the share of a..b under the spans of the first anchor within tol of coord.

    Spans that overlap count each; an empty interval is covered; without an anchor the coverage is null. A page's anchors
    come as one array, so each boundary meets one row.
    """
    near = F.get(F.filter("anchors", lambda x: F.abs(x["anchor"] - F.col("coord")) <= tol), F.lit(0))
    overlap = lambda x: F.greatest(F.lit(0).cast("long"), F.least(F.col("b"), x["e"]) - F.greatest(F.col("a"), x["s"]))
    covered = F.aggregate(F.col("spans"), F.lit(0).cast("long"), lambda total, x: total + overlap(x))
    share = F.when(F.col("spans").isNotNull(), F.when(F.col("a") >= F.col("b"), F.lit(1.0)).otherwise(covered / (F.col("b") - F.col("a"))))
    # both orientations of a page in one row: the boundaries, which are dealt by page, stay where they are
    of = lambda o: F.first(F.when(F.col("orient") == o, F.col("anchors")), ignorenulls=True).alias(f"_{o}")
    sets = anchor_sets(lines, tol).groupBy("page_id").agg(of("h"), of("v"))
    own = F.when(F.col("orient") == "h", F.col("_h")).when(F.col("orient") == "v", F.col("_v"))
    met = boundaries.join(sets, "page_id", "left").withColumn("anchors", own).withColumn("spans", near["spans"])
    columns = [c for c in boundaries.columns if c not in ("page_id", "orient")]
    return met.select("page_id", "orient", *columns, share.alias("coverage"))


def merge_edges(covered: DataFrame, ratio: float = 0.8) -> DataFrame:
    """page_id, row, col, row2, col2 of cells that no boundary parts."""
    return covered.where(F.coalesce(F.col("coverage"), F.lit(-1.0)) < ratio).select("page_id", "row", "col", "row2", "col2")


_MERGED = "row long, col long, rowspan long, colspan long, x1 long, y1 long, x2 long, y2 long"


def _joined(page, cells: np.ndarray, edges: np.ndarray, kind: pa.DataType) -> pa.Table:
    """One page's cells (row, col, x1, y1, x2, y2) joined along its edges (row, col, row2, col2)."""
    names = [x.split()[0] for x in _MERGED.split(", ")]
    if not len(cells):
        return pa.table({"page_id": pa.array([], kind)} | {n: pa.array([], pa.int64()) for n in names})
    width = int(max(cells[:, 1].max(), edges[:, [1, 3]].max(initial=0))) + 1
    key = cells[:, 0] * width + cells[:, 1]
    order = np.argsort(key, kind="stable")
    at = lambda r, c: order[np.searchsorted(key[order], r * width + c)]
    label = least_labels(len(cells), at(edges[:, 0], edges[:, 1]), at(edges[:, 2], edges[:, 3]))
    order = np.argsort(label, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(label[order]) > 0))
    low, high = np.minimum.reduceat(cells[order], starts), np.maximum.reduceat(cells[order], starts)
    columns = (low[:, 0], low[:, 1], high[:, 0] - low[:, 0] + 1, high[:, 1] - low[:, 1] + 1, low[:, 2], low[:, 3], high[:, 4], high[:, 5])
    return pa.table({"page_id": pa.array([page] * len(low), kind)} | {n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def _matrix(t: pa.Table, columns: tuple[str, ...]) -> np.ndarray:
    return np.stack([t.column(c).to_numpy() for c in columns], 1).astype(np.int64) if t.num_rows else np.zeros((0, len(columns)), np.int64)


def _union(left: pa.Table, right: pa.Table) -> pa.Table:
    page = left.column("page_id")[0].as_py() if left.num_rows else None
    return _joined(page, _matrix(left, ("row", "col", "x1", "y1", "x2", "y2")), _matrix(right, ("row", "col", "row2", "col2")), left.schema.field("page_id").type)


def _union_rows(group: pa.Table) -> pa.Table:
    is_cell = pa.compute.equal(group.column("orient"), "c")
    cells, edges = group.filter(is_cell), group.filter(pa.compute.invert(is_cell))
    sides = _matrix(cells, ("row", "col", "coord", "row2", "a", "b"))
    return _joined(group.column("page_id")[0].as_py(), sides, _matrix(edges, ("row", "col", "row2", "col2")), group.schema.field("page_id").type)


def merged_table(cells: DataFrame, lines: DataFrame, tol: int = 15, ratio: float = 0.8) -> DataFrame:
    """The groups of cells that no line parts, as merged_cells() gives them; cells and boundaries pass the plan together, once."""
    covered = coverage(inner_boundaries(cells, True), lines, tol)
    rows = covered.where((F.col("orient") == "c") | (F.coalesce(F.col("coverage"), F.lit(-1.0)) < ratio))
    return rows.groupBy("page_id").applyInArrow(_union_rows, f"page_id {dict(cells.dtypes)['page_id']}, {_MERGED}")


def _met(across: str, along: str, anchors: str, tol: int, of) -> Column:
    """of(x, i, y, j, share) of each boundary of a page's sides (grid.sides()), position by position.

    The boundary lies at the end of x, the i-th of the sides across, along y, the j-th of the others; share is its coverage. Lines are looked up once a position.
    """
    overlap = lambda x, a, b: F.greatest(F.lit(0).cast("long"), F.least(b, x["e"]) - F.greatest(a, x["s"]))

    def at(m: Column) -> Column:
        def share(y: Column) -> Column:
            covered = F.aggregate(m["spans"], F.lit(0).cast("long"), lambda total, x: total + overlap(x, y["c"], y["b"]))
            return F.when(m["spans"].isNotNull(), F.when(y["c"] >= y["b"], F.lit(1.0)).otherwise(covered / (y["b"] - y["c"])))

        return F.transform(F.col(along), lambda y, j: of(m["x"], m["i"], y, j, share(y)))

    near = lambda x: F.get(F.filter(F.col(anchors), lambda k: F.abs(k["anchor"] - x["b"]) <= tol), F.lit(0))["spans"]
    met = F.transform(F.slice(F.col(across), F.lit(1), F.greatest(F.size(across) - 1, F.lit(0))), lambda x, i: F.struct(x.alias("x"), near(x).alias("spans"), i.alias("i")))
    return F.flatten(F.transform(met, at))


def _pages(axis: DataFrame, lines: DataFrame, tol: int) -> DataFrame:
    """page_id, xs, ys (grid.sides(), in order), _h, _v (anchors): a row for each page with a cell."""
    of = lambda o: F.first(F.when(F.col("orient") == o, F.col("anchors")), ignorenulls=True).alias(f"_{o}")
    sets = anchor_sets(lines, tol).groupBy("page_id").agg(of("h"), of("v"))
    return sides(axis).where("size(xs) > 0 and size(ys) > 0").select("page_id", F.array_sort("xs").alias("xs"), F.array_sort("ys").alias("ys")).join(sets, "page_id", "left")


def grid_coverage(axis: DataFrame, lines: DataFrame, tol: int = 15) -> DataFrame:
    """coverage() of the inner boundaries of a grid's cells (grid.cells()): a page is one row until its boundaries are known, so no row for a cell or a boundary is dealt or sorted."""
    def row(orient: str, x: Column, y: Column, to_row: Column, to_col: Column, side: Column, other: Column, share: Column) -> Column:
        return F.struct(
            F.lit(orient).alias("orient"), y["idx"].alias("row"), x["idx"].alias("col"), to_row.alias("row2"), to_col.alias("col2"),
            side["b"].alias("coord"), other["c"].alias("a"), other["b"].alias("b"), share.alias("coverage"),
        )

    v = _met("xs", "ys", "_v", tol, lambda x, i, y, j, share: row("v", x, y, y["idx"], x["idx"] + 1, x, y, share))
    h = _met("ys", "xs", "_h", tol, lambda y, i, x, j, share: row("h", x, y, y["idx"] + 1, x["idx"], y, x, share))
    return _pages(axis, lines, tol).select("page_id", F.explode(F.concat(v, h)).alias("n")).select("page_id", "n.*")


def _open(across: str, along: str, anchors: str, tol: int, ratio: float) -> Column:
    """Of a page's sides (grid.sides()) the boundaries that no line covers enough, as numbers: place across * size along + place along."""
    places = _met(across, along, anchors, tol, lambda x, i, y, j, share: F.when(F.coalesce(share, F.lit(-1.0)) < ratio, i * F.size(along) + j))
    return F.array_compact(places)


def merged_grid(axis: DataFrame, lines: DataFrame, tol: int = 15, ratio: float = 0.8) -> DataFrame:
    """merged_table() of the cells of a grid (grid.cells()): a page is one row until its cells are joined, so no row for a cell or a boundary is dealt or sorted."""
    pages = _pages(axis, lines, tol).select("page_id", "xs", "ys", _open("xs", "ys", "_v", tol, ratio).alias("v"), _open("ys", "xs", "_h", tol, ratio).alias("h"))
    kind = dict(axis.dtypes)["page_id"]

    def run(batches):
        for batch in batches:
            made = []
            columns = [batch.column(c) for c in ("page_id", "xs", "ys", "v", "h")]
            for page, xs, ys, v, h in zip(*columns):
                x, y = (np.stack([s.values.field(f).to_numpy() for f in ("idx", "c", "b")], 1) for s in (xs, ys))
                r, c = np.divmod(np.arange(len(y) * len(x)), len(x))
                cells = np.stack([y[r, 0], x[c, 0], x[c, 1], y[r, 1], x[c, 2], y[r, 2]], 1)
                vc, vr = np.divmod(v.values.to_numpy().astype(np.int64), len(y))
                hr, hc = np.divmod(h.values.to_numpy().astype(np.int64), len(x))
                at = lambda r, c: np.stack([y[r, 0], x[c, 0]], 1)
                edges = np.concatenate([np.hstack([at(vr, vc), at(vr, vc + 1)]), np.hstack([at(hr, hc), at(hr + 1, hc)])])
                made.append(_joined(page.as_py(), cells, edges, columns[0].type))
            if made:
                yield from pa.concat_tables(made).combine_chunks().to_batches()

    return pages.mapInArrow(run, f"page_id {kind}, {_MERGED}")


def merged_cells(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """The groups of cells that edges connect, with their spans and bounding boxes (of L-shapes, too)."""
    narrow = cells.select(*[F.col(c).alias(c) for c in ("page_id", "row", "col", "x1", "y1", "x2", "y2")])  # edges may stem from the same cells
    edges = edges.select(*[F.col(c).alias(c) for c in edges.columns])
    return narrow.groupBy("page_id").cogroup(edges.groupBy("page_id")).applyInArrow(_union, f"page_id {dict(cells.dtypes)['page_id']}, {_MERGED}")


def _edges_of(merged: DataFrame) -> DataFrame:
    return merged.select("page_id", "row", "y1", "y2", F.explode(F.array("x1", "x2")).alias("x"))


def all_boundaries(merged: DataFrame) -> DataFrame:
    """page_id, x, y1, y2 of every left or right side of a cell."""
    return _edges_of(merged).groupBy("page_id", "x").agg(F.min("y1").alias("y1"), F.max("y2").alias("y2"))


def major_boundaries(merged: DataFrame, min_row_coverage: float = 1.0) -> DataFrame:
    """Of all boundaries those that cells of at least so large a share of the rows have; rows count by where cells begin."""
    rows = merged.groupBy("page_id").agg(F.max(F.col("row") + F.col("rowspan")).alias("num_rows"))
    per = _edges_of(merged).groupBy("page_id", "x").agg(F.min("y1").alias("y1"), F.max("y2").alias("y2"), F.count_distinct("row").alias("n"))
    return per.join(rows, "page_id").where(F.col("n") >= F.floor(F.col("num_rows") * F.lit(min_row_coverage))).select("page_id", "x", "y1", "y2")
