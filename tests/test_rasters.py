"""Turned rasters, edges and regions against plain code on small pages."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.kernels import geometry as geo
from gridloom.kernels import pixels as px
from gridloom.kernels import trees
from gridloom.operators import raster
from gridloom.operators import regions as rg
from gridloom.operators import stencils as st
from gridloom.operators import turning as tn


def pixels(spark, pages):
    rows = [(p, int(y), int(x), int(v)) for p, a in pages.items() for (y, x), v in np.ndenumerate(a)]
    return spark.createDataFrame(rows, "page_id long, y long, x long, v long")


def dense(df, pages):
    out = {p: np.zeros(a.shape, np.int64) for p, a in pages.items()}
    for r in df.collect():
        out[r.page_id][r.y, r.x] = r["v"] if "v" in r else 1
    return out


@pytest.fixture(scope="module")
def pages():
    r = np.random.default_rng(4)
    return {1: r.integers(0, 256, (17, 23)), 2: r.integers(0, 256, (12, 9)), 3: np.full((1, 5), 7), 4: r.integers(0, 256, (3, 1))}


@pytest.mark.parametrize("method, border", [("cubic", "replicate"), ("linear", "zero"), ("cubic", "zero"), ("linear", "replicate"), ("nearest", "replicate"), ("nearest", "zero")])
def test_rotated_as_the_kernel(spark, pages, method, border):
    found = dense(tn.rotated(pixels(spark, pages), 7.3, method, border), pages)
    for p, a in pages.items():
        other = geo.rotate(a.astype(np.uint8), 7.3, method, border).astype(int)
        # places are rounded (to 1/32 of a pixel for weights), so values differ by a share of the contrast between neighbours, and a nearest pixel now and then
        assert (np.abs(found[p] - other) <= (0 if method == "nearest" else 24)).mean() > 0.97


def test_rotated_by_nothing_and_unknown_ways(spark, pages):
    assert all((dense(tn.rotated(pixels(spark, pages), 0.0, m), pages)[p] == a).all() for m in ("nearest", "linear", "cubic") for p, a in pages.items())
    for wrong in ({"method": "magic"}, {"border": "wrap"}):
        with pytest.raises(ValueError):
            tn.rotated(pixels(spark, pages), 1.0, **wrong)


def test_turned_ink_is_the_nearest_rotation(spark, pages):
    p = pixels(spark, pages)
    ink = p.where("v > 127").join(tn.sizes_of(p), "page_id").select("page_id", "y", "x", "height", "width")
    turned = tn.turned_ink(ink, [-6.0, 11.0])
    for k, a in enumerate((-6.0, 11.0)):
        one = tn.rotated(p.withColumn("v", (F.col("v") > 127).cast("long")), a, "nearest", "zero").where("v > 0")
        assert sorted((r.page_id, r.y, r.x) for r in one.collect()) == sorted((r.page_id, r.y, r.x) for r in turned.where(F.col("k") == k).collect())


def test_closed_ink(spark):
    r = np.random.default_rng(2)
    pages = {1: r.random((15, 14)) < 0.3, 2: r.random((2, 3)) < 0.5}
    p = pixels(spark, pages)
    ink = p.where("v > 0").join(tn.sizes_of(p), "page_id").select("page_id", "y", "x", "height", "width")
    found = dense(tn.closed_ink(ink), pages)
    for k, a in pages.items():
        assert (found[k] > 0).tolist() == (px.closing(a.astype(np.uint8) * 255, px.element("rect", 3)) > 0).tolist()


def test_skewed_lines_find_a_turned_line(spark):
    page = np.zeros((60, 80), np.int64)
    page[20:22, 5:75] = 1
    page[5:55, 40] = 1
    turned = geo.rotate((page * 255).astype(np.uint8), 2.0, "nearest", "zero") > 0
    p = pixels(spark, {1: turned})
    ink = p.where("v > 0").join(tn.sizes_of(p), "page_id").select("page_id", "y", "x", "height", "width")
    straight = tn.skewed_lines(ink, 60, 40, 0.0, 1.0).where("orient = 'h'").count()
    found = tn.skewed_lines(ink, 60, 40, 3.0, 1.0)
    rows = {o: {(r.y, r.x) for r in found.where(F.col("orient") == o).collect()} for o in "hv"}
    assert straight == 0 and len(rows["h"]) >= 100 and len(rows["v"]) >= 35
    assert {(y, x) for y, x in rows["h"]} - {(y + a, x + b) for y, x in np.argwhere(turned) for a in (-1, 0, 1) for b in (-1, 0, 1)} == set()


def test_scores_are_those_of_the_sums(spark, pages):
    p = pixels(spark, pages)
    turned = p.withColumn("turns", tn._turns([-3.0, 0.0, 4.0]))
    for axis, kind in (("y", "sharpness"), ("x", "variance"), ("y", "variance")):
        sums = tn.angle_sums(turned, tn.sizes_of(p), axis)
        full = {}
        for r in sums.collect():
            full.setdefault((r.page_id, r.k), np.zeros(r.bins, np.int64))[r.bin] = r.total
        for r in tn.angle_scores(sums, kind).collect():
            t = full[r.page_id, r.k]
            assert r.score == pytest.approx(geo.sharpness(t) if kind == "sharpness" else t.var())
        if axis == "y":
            assert (full[1, 1] == pages[1].sum(1)).all()
    with pytest.raises(ValueError):
        tn.angle_scores(sums, "best")
    with pytest.raises(ValueError):
        tn.angle_sums(turned, tn.sizes_of(p), "z")


def test_search_finds_the_turn(spark):
    page = np.full((160, 200), 0, np.uint8)
    for y in range(20, 140, 12):
        page[y : y + 4, 20 : 180 - (y * 7) % 40] = 255
    p = pixels(spark, {k: geo.rotate(page, float(k), "nearest", "zero") // 255 for k in (-2, 1)})
    scores = tn.search_scores(p, "y", "sharpness").cache()
    found = {r.page_id: r for r in tn.found_angle(scores).collect()}
    assert abs(found[-2].angle - 2) <= 0.3 and abs(found[1].angle + 1) <= 0.3
    for k, r in found.items():
        own = np.array([x.score for x in scores.where(F.col("page_id") == k).collect()])
        assert r.best == own.max() and r.confidence == pytest.approx(min(1, own.max() / (own.mean() + own.std() + 1e-6)))


def test_stop_of_the_coarse_pass(spark):
    rows = [(1, k, float(v)) for k, v in enumerate([5, 4, 4, 3, 2, 9, 1])] + [(2, k, float(v)) for k, v in enumerate([1, 2, 2, 1, 1, 1, 9])] + [(3, k, float(v)) for k, v in enumerate([3, 2, 1])]
    scores = spark.createDataFrame(rows, "page_id long, k int, score double")
    kept = {}
    for r in tn.before_stop(scores).collect():
        kept.setdefault(r.page_id, []).append(r.k)
    assert {p: max(ks) for p, ks in kept.items()} == {1: 4, 2: 5, 3: 2}
    top = {r.page_id: r.k for r in tn.best_angle(scores.withColumn("angle", F.lit(0.0))).collect()}
    assert top == {1: 5, 2: 6, 3: 0}


def test_convolutions(spark, pages):
    p = pixels(spark, {k: v for k, v in pages.items() if min(v.shape) > 3})
    k = [1, -2, 5, 3, 4]
    for axis in "yx":
        for border, mode in (("edge", "edge"), ("mirror", "reflect")):
            found = dense(st.convolved(p, k, axis, border), pages)
            for n in (1, 2):
                pad = [(2, 2), (0, 0)] if axis == "y" else [(0, 0), (2, 2)]
                a = np.pad(pages[n], pad, mode=mode)
                h, w = pages[n].shape
                want = sum(c * (a[i : i + h] if axis == "y" else a[:, i : i + w]) for i, c in enumerate(k))
                assert (found[n] == want).all()


def test_gradients_as_the_kernel(spark, pages):
    p = {k: v for k, v in pages.items() if min(v.shape) > 3}
    rows = st.gradients(pixels(spark, p))
    for name, i in (("gx", 0), ("gy", 1)):
        found = dense(rows.drop("v").withColumnRenamed(name, "v"), p)
        assert all((found[k] == px.sobel(v.astype(np.uint8))[i]).all() for k, v in p.items())


def test_canny(spark):
    page = np.full((40, 50), 200, np.int64)
    page[10:30, 12:38] = 40
    page[:, 45] = 190
    flat = np.full((20, 20), 9, np.int64)
    edges = {(r.page_id, r.y, r.x) for r in st.canny(pixels(spark, {1: page, 2: flat})).collect()}
    other = np.argwhere(px.canny(page.astype(np.uint8)))
    assert {p for p, _, _ in edges} == {1}
    mine = {(y, x) for _, y, x in edges}
    # of two pixels with the same gradient on either side of a step both stay, where rounding of floats picks one
    other = set(map(tuple, other.tolist()))
    assert len(other - mine) <= 0.05 * len(mine) and all(any((y + a, x + b) in other for a in (-1, 0, 1) for b in (-1, 0, 1)) for y, x in mine)
    assert all(9 <= y <= 30 and 11 <= x <= 38 for y, x in mine)


def test_weak_edges_hang_on_strong_ones(spark):
    rows = [(1, 0, 0, True), (1, 1, 1, False), (1, 2, 2, False), (1, 2, 3, False), (1, 5, 5, False), (1, 5, 6, False), (2, 1, 1, False)]
    kept = {(r.page_id, r.y, r.x) for r in st.linked(spark.createDataFrame(rows, "page_id long, y long, x long, strong boolean")).collect()}
    assert kept == {(1, 0, 0), (1, 1, 1), (1, 2, 2), (1, 2, 3)}


def test_border_bounds(spark):
    page = np.full((120, 140), 250, np.int64)
    page[:8], page[:, :11], page[112:] = 20, 20, 20
    plain = np.full((120, 140), 250, np.int64)
    found = {r.page_id: tuple(r)[1:] for r in st.border_bounds(pixels(spark, {1: page, 2: plain})).collect()}
    assert found[2] == (0, 0, 139, 119)
    assert found[1] == (10 + 5, 7 + 5, 139, 112 - 5)


def brute_tree(a):
    """(level, first) -> (area, box) of every region that has a pixel of its level, by flooding."""
    out, h, w = {}, *a.shape
    for t in np.unique(a).tolist():
        seen = np.zeros(a.shape, bool)
        for y, x in np.argwhere(a <= t).tolist():
            if seen[y, x]:
                continue
            stack, region = [(y, x)], []
            seen[y, x] = True
            while stack:
                i, j = stack.pop()
                region.append((i, j))
                for p, q in ((i - 1, j), (i + 1, j), (i, j - 1), (i, j + 1)):
                    if 0 <= p < h and 0 <= q < w and not seen[p, q] and a[p, q] <= t:
                        seen[p, q] = True
                        stack.append((p, q))
            ys, xs = zip(*region)
            if max(a[r] for r in region) == t:
                out[t, y * w + x] = len(region), (min(xs), min(ys), max(xs), max(ys))
    return out


@pytest.mark.parametrize("shape, levels, seed", [((9, 11), 5, 1), ((20, 16), 30, 2), ((1, 1), 3, 3), ((1, 12), 4, 4), ((13, 13), 1, 5)])
def test_component_tree(shape, levels, seed):
    a = np.random.default_rng(seed).integers(0, levels, shape)
    tree = trees.component_tree(a)
    mine = {(int(t), int(f)): (int(n), tuple(b.tolist())) for t, f, n, b in zip(tree.level, tree.first, tree.area, tree.box)}
    assert mine == brute_tree(a)
    assert (tree.parent == -1).sum() == 1 and tree.area[tree.parent == -1].tolist() == [a.size]
    has = tree.parent >= 0
    assert (tree.level[tree.parent[has]] > tree.level[has]).all() and (tree.area[tree.parent[has]] > tree.area[has]).all()


def test_stable_regions_are_the_drawn_ones(spark):
    r = np.random.default_rng(1)
    page = r.integers(215, 256, (90, 120))
    page[10:40, 8:50] = r.integers(20, 25, (30, 42))
    page[50:80, 60:100] = r.integers(100, 104, (30, 40))
    p = pixels(spark, {1: page, 2: np.full((5, 5), 3)})
    found = {(int(x.x), int(x.y), int(x.w), int(x.h)) for x in rg.stable_regions(p, 5, (500, 5000)).collect()}
    # around the second one the noise of the page goes on in a few steps that hardly grow either
    drawn = {(8, 10, 42, 30), (60, 50, 40, 30)}
    assert drawn <= found and all(x <= 60 and y <= 50 and x + w >= 100 and y + h >= 80 for x, y, w, h in found - drawn)
    from gridloom.kernels.composites import stable_regions

    assert set(stable_regions(page.astype(np.uint8), 5, (500, 5000))) == found


def test_variance_of_a_large_white_page(spark):
    """7000 rows of 5000 white pixels: squares of sums beyond 64 bits."""
    columns = spark.range(5000).select(F.lit(1).cast("long").alias("page_id"), F.col("id").alias("i"), (F.lit(255 * 7000) - F.col("id") % 2).alias("total"))
    assert raster.variance(columns).first()["variance"] == pytest.approx(0.25)
