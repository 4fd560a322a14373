"""Tags: a page's regions are found once, and trees of wide pages stay cheap to label."""

import numpy as np
from pyspark.sql import functions as F

from gridloom.config import Tags
from gridloom.kernels.components import least_labels
from gridloom.operators.pages import IMAGE
from gridloom.operators import tags
from gridloom.operators.tags import nms
from gridloom.plans import stages


def test_regions_are_found_once(spark):
    plan = stages.find_tags(spark.createDataFrame([], IMAGE), Tags())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_pages_meet_their_tags_without_a_join(spark):
    for c in (Tags(), Tags(rows="theilsen"), Tags(method="classic")):
        plan = stages.remove_tags(spark.createDataFrame([], IMAGE), c)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan and plan.count("MapInArrow") == 2


def test_rows_of_arrays_as_of_tables(spark):
    rng = np.random.default_rng(8)
    rows = [(f"p{p}", k, *rng.integers(0, 400, 1).tolist(), *(rng.integers(0, 40, 1) + 300 * (rng.random(1) < 0.2)).tolist(), *rng.integers(1, 60, 2).tolist()) for p in range(30) for k in range(p % 9)]
    boxes = spark.createDataFrame(rows, "page_id string, box_id long, x long, y long, w long, h long")
    lists = boxes.groupBy("page_id").agg(F.collect_list(F.struct("box_id", "x", "y", "w", "h")).alias("b"))
    for table, array in ((tags.row_filter_median, tags.near_median), (tags.row_filter_theil_sen, tags.near_theil_sen)):
        found = sorted(tuple(r) for r in lists.select("page_id", F.inline(array(F.col("b")))).collect())
        assert found == sorted(tuple(r) for r in table(boxes).select(boxes.columns).collect()) and 0 < len(found) < len(rows)


def test_kept_boxes_bring_their_columns(spark):
    boxes = spark.createDataFrame([("a", 1, 0, 0, 10, 10, 0.5), ("a", 2, 1, 1, 9, 9, 0.6), ("a", 3, 40, 0, 5, 5, 0.7)], "page_id string, box_id long, x long, y long, w long, h long, dark double")
    assert sorted((r.box_id, r.dark) for r in nms(boxes, 0.3, ("dark",)).collect()) == [(1, 0.5), (3, 0.7)]


def test_labels_are_the_least_node():
    rng = np.random.default_rng(5)
    for n in (1, 2, 30, 300):
        a, b = rng.integers(0, n, (2, n // 2))
        want = list(range(n))
        for _ in range(n):
            for p, q in zip(a, b):
                want[p] = want[q] = min(want[p], want[q])
        assert least_labels(n, a, b).tolist() == want
