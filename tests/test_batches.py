"""Pages reach the workers in batches of bounded bytes, and lines open without a loop over runs."""

import numpy as np
import pyarrow as pa

from gridloom.kernels import pixels as px
from gridloom.operators import pages


def test_batches_of_pages_are_bounded(spark):
    rows = spark.range(0, 300, 1, 1).selectExpr("cast(id as string) as page_id", "300 as height", "400 as width", "1 as n_channels", "cast(repeat('a', 120000) as binary) as data", "cast(null as string) as error")
    pages.map_images(rows, lambda i: i)
    size = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches)
    assert max(r.n for r in rows.mapInArrow(size, "n long").collect()) < 2 * pages.BATCH_BYTES


def test_opening_keeps_whole_runs():
    mask = np.array([[255, 255, 0, 255, 255, 255, 0, 255], [0, 255, 255, 0, 0, 0, 255, 255]], np.uint8)
    assert px.open_line(mask, 3, False).tolist() == [[255, 255, 0, 255, 255, 255, 0, 0], [0, 0, 0, 0, 0, 0, 255, 255]]
