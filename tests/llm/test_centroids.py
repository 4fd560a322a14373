import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from gridloom.llm import centroids


def brute(rows, clusters, rounds, seed, dim):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    at = [v for _, v in order[:clusters]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in at]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(at)):
            own = [v for (_, v), (k, _) in zip(kept, found) if k == c]
            if own:
                at[c] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    per = [sum(d for k, d in found if k == c) for c in range(len(at))]
    return [(i, k, d, per[k], sum(per), hashlib.sha256(",".join(map(str, at[k])).encode()).hexdigest()) for (i, _), (k, d) in zip(kept, found)]


def run(spark, rows, clusters, rounds, dim, parts=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("clash")).repartition(parts)
    found = centroids.clustered(centroids.quantised(df, dim), clusters, rounds, 2)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(repr, map(tuple, found.collect())))


def test_same_as_brute_force(spark):
    r = random.Random(5)
    rows = [(i, [r.uniform(-1, 1) + (i % 5) for _ in range(6)]) for i in range(200)]
    rows += [(7, rows[7][1])] * 60 + [(i, [0.5] * 6) for i in range(300, 320)]  # a repeated row, ties
    rows += [(None, [0.25] * 6), (None, [-0.25] * 6), (400, None), (401, []), (402, [1.0] * 5), (403, [1.0] * 7), (404, [float("nan")] + [0.0] * 5), (405, [None] + [0.0] * 5), (406, [float("-inf")] + [0.0] * 5)]
    expected = sorted(map(repr, brute(rows, 9, 4, 2, 6)))
    assert run(spark, rows, 9, 4, 6) == expected
    assert run(spark, rows, 9, 4, 6, parts=11) == expected


def test_fewer_vectors_than_clusters_and_equal_ones(spark):
    rows = [(1, [0.1, 0.2]), (2, [0.1, 0.2]), (3, [0.9, -0.4])]
    assert run(spark, rows, 5, 2, 2) == sorted(map(repr, brute(rows, 5, 2, 2, 2)))


def test_no_vectors(spark):
    assert run(spark, [(1, None)], 5, 2, 2) == [] and run(spark, [], 5, 2, 2) == []


def test_huge_components_are_held(spark):
    found = [eval(x) for x in run(spark, [(1, [1e300] * 64), (2, [-1e300] * 64)], 1, 1, 64)]
    assert [x[2] for x in found] == [64 * 2**52] * 2 and {x[4] for x in found} == {2**59}
    many = [eval(x) for x in run(spark, [(i, [1e300 * (-1) ** i] * 64) for i in range(40)], 1, 1, 64)]
    assert {x[4] for x in many} == {None}  # beyond 64 bits


def test_nearest_takes_the_first_of_equals():
    first, square = centroids.nearest(np.array([[0, 0], [3, 4]]), np.array([[1, 0], [-1, 0], [3, 4]]))
    assert first.tolist() == [0, 2] and square.tolist() == [1, 0]
