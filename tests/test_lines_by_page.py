"""Lines at any turn: a page stays one row until its lines are known."""

import numpy as np

from gridloom.operators import turning as tn
from gridloom.plans import derived as d
from gridloom.plans import queries as q

SF = "/root/testdata/sf0.001"


def test_no_row_for_a_turned_pixel(spark):
    plan = q.QUERIES["skewed_lines"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan and "Join" not in plan


def test_packed_ink_is_that_of_the_pixels(spark):
    p = d.pixels(spark, SF)
    ink = p.where("v > 127").join(tn.sizes_of(p), "page_id")
    lines = lambda x: sorted(map(tuple, tn.skewed_lines(x, 6, 5, 2.0, 1.0).collect()))
    assert lines(ink) == lines(d.packed_ink(spark, SF, 127)) != []


def test_same_as_row_by_row(spark):
    """Against the places that each turned pixel comes from, joined as rows, and a closing of rows."""
    r = np.random.default_rng(3)
    sizes = {1: (23, 31), 2: (40, 17), 3: (1, 9)}
    ink = spark.createDataFrame([(k, int(y), int(x), h, w) for k, (h, w) in sizes.items() for y, x in np.argwhere(r.random((h, w)) < 0.7)], "page_id long, y long, x long, height long, width long")
    found = {o: set() for o in "hv"}
    for a in tn.angle_list(-3.0, 3.0, 1.5):
        pages = {}
        for p in tn.turned_ink(ink, [a]).collect():
            pages.setdefault(p.page_id, np.zeros(sizes[p.page_id], bool))[p.y, p.x] = True
        for o, size in (("h", 5), ("v", 4)):
            kept = []
            for page, m in pages.items():
                lines = m if o == "h" else m.T
                for i, line in enumerate(lines):
                    ends = np.flatnonzero(np.diff(np.concatenate([[0], line, [0]])))
                    for s, e in zip(ends[::2], ends[1::2]):
                        at_start, at_end = s == 0, e == len(line)
                        need = 1 if at_start and at_end else size - size // 2 if at_start else size // 2 + 1 if at_end else size
                        kept += [(page, *((i, int(j)) if o == "h" else (int(j), i)), *sizes[page]) for j in range(s, e) if e - s >= need]
            if kept:
                back = tn.turned_ink(spark.createDataFrame(kept, ink.schema), [-a])
                found[o] |= {(p.page_id, p.y, p.x, p.height, p.width) for p in back.collect()}
    want = sorted((p.page_id, o, p.y, p.x) for o in "hv" for p in tn.closed_ink(spark.createDataFrame(sorted(found[o]), ink.schema)).collect())
    assert sorted(map(tuple, tn.skewed_lines(ink, 5, 4, 3.0, 1.5).collect())) == want != []
