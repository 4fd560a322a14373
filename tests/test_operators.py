"""Hand-worked cases, and plans against plain Python on random input."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.operators import grid, lines, raster, recover, strips, tags

LINE = "page_id long, orient string, seq long, pos long, s long, e long"


def frame(spark, rows, orient="h", page=1):
    return spark.createDataFrame([(page, orient, i, p, s, e) for i, (p, s, e) in enumerate(rows)], LINE)


def test_cluster_positions(spark):
    out = lines.cluster_positions(frame(spark, [(p, 0, 5) for p in (0, 10, 20, 31)]), 10).orderBy("idx").collect()
    assert [(r.center, r.n) for r in out] == [(10, 3), (31, 1)]


def test_cluster_of_null_positions_and_ties(spark):
    out = lines.cluster_positions(frame(spark, [(p, 0, 5) for p in (None, 30, 3, 31, 30, None)]), 10).orderBy("idx").collect()
    assert [(r.center, r.n) for r in out] == [(3, 1), (30, 3), (None, 1), (None, 1)]


def test_cluster_of_nothing(spark):
    assert lines.cluster_positions(frame(spark, []), 10).count() == 0


def test_merge_uses_the_running_mean(spark):
    out = lines.merge_close(frame(spark, [(p, 0, 5) for p in (0, 10, 20)]), 10).orderBy("idx").collect()
    assert [(r.pos, r.n) for r in out] == [(5, 2), (20, 1)]
    assert lines.merge_close(frame(spark, [(3, 0, 5), (3, 1, 2)]), 0).count() == 2


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 200), st.integers(0, 50), st.integers(51, 90)), max_size=30))
def test_merge_close_like_a_loop(spark, rows):
    want, group = [], []
    for line in sorted(rows):
        if group and abs(line[0] - sum(x[0] for x in group) / len(group)) <= 12:
            group.append(line)
        else:
            if group:
                want.append(group)
            group = [line]
    want += [group] if group else []
    want = [(sum(x[0] for x in g) // len(g), min(x[1] for x in g), max(x[2] for x in g)) for g in want]
    got = lines.merge_close(frame(spark, rows), 12).orderBy("idx").collect()
    assert [(r.pos, r.s, r.e) for r in got] == want


def test_align_clusters_move_with_their_members(spark):
    rows = [(1, "v", i, p, 0, 10, w) for i, (p, w) in enumerate([(0, 1), (3, 3), (6, 1), (20, 1)])]
    df = spark.createDataFrame(rows, LINE + ", score long")
    # 0 and 3 join (mean 2.25); 6 is 3.75 away
    assert [r.pos for r in lines.align_clusters(df, 3).orderBy("idx").collect()] == [2, 6, 20]


def test_anchors_never_move(spark):
    out = lines.anchor_lines(frame(spark, [(100, 0, 5), (110, 7, 2), (120, 0, 5)]), 15).collect()
    assert sorted((r.anchor, r.s, r.e) for r in out) == [(100, 0, 5), (100, 2, 7), (120, 0, 5)]


def axis(spark, xs, ys):
    rows = [(1, "v", i, x) for i, x in enumerate(xs)] + [(1, "h", i, y) for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "page_id long, orient string, idx long, c long")


def test_cells(spark):
    out = grid.cells(axis(spark, [0, 10, 30], [0, 5, 9])).orderBy("col", "row").collect()
    assert [(r.x1, r.y1, r.x2, r.y2) for r in out] == [(0, 0, 10, 5), (0, 5, 10, 9), (10, 0, 30, 5), (10, 5, 30, 9)]
    one = axis(spark, [4], [0, 5, 9])
    assert grid.cells(one).count() == 0
    s = grid.structure(one).first()
    assert (s.num_rows, s.num_cols) == (2, 0)


def boundary(spark, a, b):
    return spark.createDataFrame([(1, "h", 0, 0, 1, 0, 50, a, b)], "page_id long, orient string, row long, col long, row2 long, col2 long, coord long, a long, b long")


@pytest.mark.parametrize("a,b,want", [(0, 100, 1.2), (7, 7, 1.0)])
def test_coverage_counts_overlaps_twice(spark, a, b, want):
    out = recover.coverage(boundary(spark, a, b), frame(spark, [(50, 0, 60), (52, 40, 100)])).first()
    assert out.coverage == pytest.approx(want)


def test_no_line_is_no_coverage(spark):
    assert recover.coverage(boundary(spark, 0, 100), frame(spark, [(90, 0, 60)])).first().coverage is None


def test_recovery_of_a_merged_row(spark):
    a = axis(spark, [0, 100, 200], [0, 100, 200])
    found = frame(spark, [(100, 0, 100)], "v").union(frame(spark, [(100, 0, 200)], "h"))
    covered = recover.coverage(recover.inner_boundaries(grid.cells(a)), found)
    out = recover.merged_cells(grid.cells(a), recover.merge_edges(covered, 0.8)).orderBy("row", "col").collect()
    assert [(r.row, r.col, r.rowspan, r.colspan) for r in out] == [(0, 0, 1, 1), (0, 1, 1, 1), (1, 0, 1, 2)]
    assert (out[2].x1, out[2].y1, out[2].x2, out[2].y2) == (0, 100, 200, 200)


def test_all_boundaries(spark):
    rows = [(1, 0, 0, 1, 1, 0, 0, 10, 5), (1, 1, 0, 1, 1, 0, 5, 10, 9), (1, 0, 1, 2, 1, 10, 0, 30, 9)]
    m = spark.createDataFrame(rows, "page_id long, row long, col long, rowspan long, colspan long, x1 long, y1 long, x2 long, y2 long")
    assert [(r.x, r.y1, r.y2) for r in recover.all_boundaries(m).orderBy("x").collect()] == [(0, 0, 9), (10, 0, 9), (30, 0, 9)]
    assert [r.x for r in recover.major_boundaries(m).orderBy("x").collect()] == [0, 10]


def test_strips(spark):
    p = spark.createDataFrame([(1, x, 100) for x in (0, 50, 100)], "page_id long, x long, width long")
    assert [(r.left, r.right) for r in strips.strip_bounds(p, 5, 5).orderBy("column_index").collect()] == [(0, 55), (45, 100)]
    assert [r.column_index for r in strips.strip_bounds(spark.createDataFrame([(1, x, 500) for x in (0, 3, 100)], "page_id long, x long, width long"), 0, 0, 10).collect()] == [2]


@pytest.mark.parametrize("xs,width,want", [([0, 110, 220], 200, [0, 100, 200]), ([0, 104], 100, [0, 104])])
def test_rescale(spark, xs, width, want):
    p = spark.createDataFrame([(1, x) for x in xs], "page_id long, x long")
    w = spark.createDataFrame([(1, width)], "page_id long, width long")
    assert sorted(r.x for r in strips.rescaled(p, w).collect()) == want


def test_nms(spark):
    b = spark.createDataFrame([(1, i, *x) for i, x in enumerate([(0, 0, 10, 10), (1, 1, 10, 10), (50, 50, 4, 4)])], "page_id long, box_id long, x long, y long, w long, h long")
    assert sorted(r.box_id for r in tags.nms(b).collect()) == [0, 2]


def test_theil_sen(spark):
    p = spark.createDataFrame([(1, i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (1, 1), (2, 2), (3, 100)])], "page_id long, point_id long, px double, py double")
    r = tags.theil_sen(p).first()
    assert (r.slope, r.intercept) == (pytest.approx(17.166666666666668), pytest.approx(-8.083333333333334))
    r = tags.theil_sen(p.limit(1)).first()
    assert (r.slope, r.intercept) == (0.0, 0.0)


def test_glyphs_are_clamped(spark):
    from pyspark.sql import functions as F

    score = spark.range(1).select(tags.tag_score(F.lit(0.0), F.lit(9), F.lit(10), F.lit(10)).alias("s")).first().s
    assert score == pytest.approx(0.25 * 0.25 + 0.15)


def test_split_position(spark):
    g = spark.createDataFrame([(1, a, b, 100) for a, b in ((10, 12), (40, 44), (70, 72))], "page_id long, a long, b long, width long")
    w = spark.createDataFrame([(1, 100), (2, 80)], "page_id long, width long")
    assert {r.page_id: r.split_x for r in raster.split_position(g, w).collect()} == {1: 57, 2: 40}


def test_unknown_names_fail_early(spark):
    with pytest.raises(ValueError):
        raster.projection(None, "z")
    with pytest.raises(ValueError):
        raster.combine(None, None, "nand")


def test_components_partition_the_ink(spark):
    random.seed(3)
    ink = {(random.randrange(20), random.randrange(20)) for _ in range(120)}
    out = raster.components(spark.createDataFrame([(1, y, x) for y, x in ink], "page_id long, y long, x long")).collect()
    seen, sizes = set(), []
    for p in ink:
        if p in seen:
            continue
        todo, n = [p], 0
        seen.add(p)
        while todo:
            y, x = todo.pop()
            n += 1
            for q in ((y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)):
                if q in ink and q not in seen:
                    seen.add(q)
                    todo.append(q)
        sizes.append(n)
    assert sorted(r.area for r in out) == sorted(sizes)
