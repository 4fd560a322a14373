"""Plain Lloyd clustering of integer vectors with exact arithmetic, so that reruns and partitions cannot change a result.

Each round sends the centroids to the tasks. A task computes the squared differences of its vectors to one centroid after the other,
keeps the first least one, and returns a row for each cluster that it met: its number of vectors and their sums. A groupBy merges
these rows, at most clusters x partitions of them whatever the data, and the driver gets one row for each cluster.

Vectors are quantised once into a saved table of small integers, which a column store packs tighter than the floats, and each round reads it.

Defined cases: a null vector, one of another length, or one with a null or non-finite component takes no part; a component beyond
2**26 in size counts as that, so that a distance always fits 64 bits, and an inertia that does not is null; fewer vectors than clusters leave fewer
clusters, and no vector gives no rows; repeated rows and repeated ids are vectors each; a null id is hashed as an empty one, and equal hashes
go by components; a cluster that loses all its vectors keeps its centroid; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table

#: Components are held within this, so that 64 squared differences of them stay below 2**63.
LARGEST = 2**26


def quantised(embeddings: DataFrame, dim: int = 64, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v array<int>: floor(scale * component), of the vectors with dim finite components."""
    x = F.col(vector).cast("array<double>")
    cells = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))
    whole = cells.where((F.size("x") == dim) & F.forall("x", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))))
    held = F.transform("x", lambda c: F.greatest(F.least(F.floor(F.greatest(F.least(c, F.lit(float(LARGEST))), F.lit(-float(LARGEST))) * scale), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    return whole.select("vec_id", held.alias("v"))


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of `seed:vec_id`, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(digest.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r.v for r in rows], np.int64)


def nearest(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of the nearest centroid, the smallest of equals, and the squared distance."""
    squares = np.empty((len(centroids), len(v)), np.int64)
    for i, c in enumerate(centroids):
        d = v - c
        squares[i] = np.einsum("ij,ij->i", d, d)
    first = squares.argmin(0)
    return first, squares[first, np.arange(len(v))]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.concatenate(column.to_numpy()).astype(np.int64).reshape(len(column), -1)


def _sums(centroids: np.ndarray):
    """A task's rows for the clusters of its vectors: cluster, n, total."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            if len(batch):
                v = _matrix(batch["v"])
                cluster = nearest(v, centroids)[0]
                n += np.bincount(cluster, minlength=len(n))
                for c in np.unique(cluster):
                    total[c] += v[cluster == c].sum(0)
        met = np.flatnonzero(n)
        if len(met):
            yield pd.DataFrame({"cluster": met, "n": n[met], "total": list(total[met])})

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                cluster, distance = nearest(_matrix(batch["v"]), centroids)
                yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "cluster": cluster, "distance": distance})

    return run


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: floors of the exact means of their vectors."""
    dim = centroids.shape[1]
    parts = vectors.select("v").mapInPandas(_sums(centroids), "cluster int, n long, total array<bigint>")
    exact = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dim)]
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect():
        out[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dim)]
    return out


def lloyd(vectors: DataFrame, clusters: int, rounds: int, seed: int) -> tuple[DataFrame, np.ndarray]:
    """vectors: vec_id, v, read once for each round. Returns vec_id, cluster, distance of the last assignment, and the centroids."""
    centroids = first_centroids(vectors, clusters, seed)
    if not len(centroids):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    return vectors.mapInPandas(_assigned(centroids), "vec_id long, cluster int, distance long"), centroids


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clustered(vectors: DataFrame, clusters: int = 40, rounds: int = 5, seed: int = 2) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for each of the vectors."""
    found, centroids = lloyd(vectors, clusters, rounds, seed)
    found = saved(found, "clusters")
    exact = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r.s) for r in exact)
    # one row for each centroid
    known = [(r.cluster, *(x if x < 2**63 else None for x in (int(r.s), total)), digest(centroids[r.cluster])) for r in exact]
    per = vectors.sparkSession.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_lloyd_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 clusters of the 64-component vectors after 5 rounds."""
    return clustered(saved(quantised(table(spark, sf_dir, "embeddings")), "vectors"))
