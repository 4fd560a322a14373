"""Coverage of a grid's boundaries from its axes: as from its cells, without a row for each of them before the end."""

import pytest

from gridloom.operators import grid, recover
from gridloom.plans import queries as q

SF = "/root/testdata/sf0.001"


def same(got, want):
    assert got.dtypes == want.dtypes
    rows = lambda x: sorted(map(repr, map(tuple, x.collect())))
    assert rows(got) == rows(want) != []


def test_same_as_from_cells(spark):
    same(q._covered(spark, SF), recover.coverage(recover.inner_boundaries(q._cells_(spark, SF)), q.seg(spark, SF), 15))


def test_same_on_odd_pages(spark):
    pages = {1: ([0, 100, 100, 250], [0, 40, 90]), 2: ([0, 10], [5, 9]), 3: ([0, 10, 20], []), 4: ([7], [1, 2, 3]), 5: ([0, 50, 60], [0, 30])}
    axis = spark.createDataFrame([(p, o, i, c) for p, xy in pages.items() for o, cs in zip("vh", xy) for i, c in enumerate(cs)], "page_id long, orient string, idx long, c long")
    lines = spark.createDataFrame([(1, "v", 0, 96, 70, 10), (1, "v", 1, 104, 0, 95), (1, "h", 2, 41, 0, 100), (1, "h", 3, 60, 0, 9), (4, "h", 4, 2, 0, 9), (9, "v", 5, 1, 0, 9)], "page_id long, orient string, seq long, pos long, s long, e long")
    same(recover.grid_coverage(axis, lines), recover.coverage(recover.inner_boundaries(grid.cells(axis)), lines))


@pytest.mark.parametrize("name", ["border_coverage", "merge_edges"])
def test_no_row_for_a_boundary_is_joined(spark, name):
    plan = q.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan.split("Join", 1)[0]
