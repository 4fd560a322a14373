import numpy as np
import pytest

from gridloom.llm import pivots


def brute(rows, k=5):
    use = [(i, np.floor(np.array(v, float) * 256)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    use = list({(i, tuple(v)): (i, v) for i, v in use}.values())
    dim = max((len(v) for _, v in use), default=0)
    use = [(i, np.pad(v, (0, dim - len(v)))) for i, v in use]
    out = {}
    for q, v in use:
        if q % 50 == 0:
            best = sorted((-int(v @ w), i) for i, w in use if i != q)[:k]
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def got(spark, rows):
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")
    out = {}
    for r in pivots.top_k(df).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_exact_with_ties_nulls_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8).round(1)]) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(400, 520)]  # one very common vector
    rows += [(600, None), (601, [None] * 8), (602, [float("nan")] * 8), (603, [float("inf")] * 8), (None, rows[1][1]), (5, rows[5][1])]
    assert got(spark, rows) == brute(rows)


def test_few_candidates_and_none(spark):
    rows = [(0, [0.5, 0.25]), (50, [0.5, -0.25]), (7, [1.0, 1.0])]
    assert got(spark, rows) == brute(rows)
    assert got(spark, [(50, [1.0])]) == {}
    assert got(spark, []) == {}


def test_bounds_prune(spark):
    """Well separated groups: the second round leaves most blocks out."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 8)) * 3
    rows = [(i, [float(x) for x in centres[i % 20] + rng.normal(size=8) * 0.01]) for i in range(1000)]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("n,block", [(10, 4), (1000, 64)])
def test_blocks_hold_every_row_once(spark, n, block):
    df = spark.createDataFrame([(i, [float(i % 7), float(i)]) for i in range(n)], "vec_id long, embedding array<double>")
    index = pivots.PivotIndex(pivots.quantised(df), 5, 4, block)
    ids = np.concatenate([pivots._unpacked_ids(bytes(r.ids))[1] for r in index.blocks.collect()])
    assert sorted(ids.tolist()) == list(range(n))
