"""Pages' images move in few batches, and what is found on a page is joined to it without its image."""

import random

from pyspark.sql import functions as F

from gridloom.operators import lines, pages
from gridloom.plans import drawn, stages


def test_merged_cells_pass_as_pages(spark):
    plan = stages.stage2(spark.createDataFrame([], pages.IMAGE))["merged"]._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" not in plan


def test_drawn_pages_come_in_batches():
    rows = [pages.image_row(str(k), drawn.ruled(k)) for k in range(10)]
    made = list(pages.batched_images(iter(rows)))
    assert len(made) == 1 and made[0].num_rows == 10 and made[0].column("data")[3].as_py() == rows[3][4]


def test_pages_are_cut_without_a_join(spark):
    plan = stages.stage1(spark.createDataFrame([], pages.IMAGE), keep=False)["tables"]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_centers_as_of_tables(spark):
    rng = random.Random(4)
    rows = [(p, "v", k, rng.randrange(200), 0, 5) for p in range(40) for k in range(p % 12)]
    segments = spark.createDataFrame(rows, "page_id long, orient string, seq long, pos long, s long, e long")
    found = segments.groupBy("page_id").agg(F.collect_list("pos").alias("at")).select("page_id", F.posexplode(lines.centers(F.col("at"), 7))).collect()
    assert sorted(tuple(r) for r in found) == sorted((r.page_id, r.idx, r.center) for r in lines.cluster_positions(segments, 7).collect())


def test_lines_of_a_page_as_of_tables(spark):
    rng = random.Random(5)
    rows = [(p, rng.choice("hv"), k, rng.randrange(150), a, a + rng.randrange(90), rng.randrange(1, 9)) for p in range(30) for k in range(p % 14) for a in [rng.randrange(100)]]
    segments = spark.createDataFrame(rows, "page_id long, orient string, seq long, pos long, s long, e long, score long")
    lists = segments.groupBy("page_id").agg(F.collect_list(F.struct(*segments.columns[1:])).alias("found"))
    for close in (0, 20):
        merged = lines.filter_relative(lines.align_clusters(segments, 5), 0.4)
        want = lines.merge_close(lines.filter_long(merged, 100, 100, 0.8, 0.7), close)
        of = [lines.of_page(F.col("found"), o, 5, 0.4, F.lit(m), close) for o, m in (("h", 80), ("v", 70))]
        found = lists.select("page_id", F.inline(F.concat(*of)))
        assert found.columns == want.columns and sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) != []
