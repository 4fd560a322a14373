"""Exact top-k inner-product search with a pivot-distance index.

Inner products become distances by one more coordinate: with R the largest norm, x gains
sqrt(R^2 - |x|^2) and a query gains 0, so |q - x|^2 = |q|^2 + R^2 - 2 q.x falls as q.x rises.
Pivots come from a bounded sample (PIVOTS rows, the smallest by hash). Each vector is keyed by its
nearest pivot and the distance to it; vectors sorted by that key are cut into blocks, each an
annulus around its pivot, with the least and greatest distance of its vectors to every pivot.
A query's blocks are sorted by their triangle-inequality bound: its own annulus first, then those around it. Rounds
expand along that order, FIRST_BLOCKS at first and GROWTH times as far each time; the k-th distance so far is the query's
radius, and it stops at the first block whose bound exceeds it, as all further ones do too. Scores are integers and exact, so results
are exact.

Queries are keyed and sorted as vectors are, so that those of one piece need much the same blocks; a task meets one piece of
queries and one block of vectors at a time. A round computes the bounds of all pieces against all blocks' summaries, a thousandth of
the work of scoring them. Equal vectors are indexed once with their k + 1 smallest ids, which any query's result can
at most use of them, so one vector that many rows share costs no more than another.

Defined cases: a null vector, or one with a null or non-finite component, takes no part (neither as query nor as candidate),
nor does a null id; an empty vector scores 0 against all; of vectors of different lengths the shorter counts as padded
with zeros; a repeated row is a candidate once per id, and an id that has several vectors is a
candidate with each but the query's own id never is; ties go to the smaller id; a query with fewer than k candidates
returns them all; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table

PIVOTS = 32
BLOCK = 1024
QUERY_BLOCK = 512
FIRST_BLOCKS, GROWTH = 4, 16
SUMMARIES = 1024
#: Rounding of a distance at most, as a share of the largest norm (its square has about 64 roundings of 1e-16).
_SLACK = 1e-6

_BLOCKS = "block long, ids binary, vectors binary, near binary, far binary, n int"
_NEEDS = "piece long, block long, rows binary"


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """id, v array<double> of floor(scale * x), without the rows that take no part."""
    x = F.col("embedding").cast("array<double>")
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("id"), x.alias("x"))
        .where("id is not null and x is not null and forall(x, c -> c is not null and not isnan(c) and abs(c) < double('Infinity'))")
        .select("id", F.transform("x", lambda c: F.floor(c * scale).cast("double")).alias("v"))
    )


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to dim."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim))
    at = np.repeat(np.arange(len(lengths)), lengths)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """To each pivot, in the space with the additional coordinate (the last of a pivot)."""
    square = (x * x).sum(1)[:, None] + (extra**2)[:, None] + norms[None, :] - 2 * (x @ pivots[:, :-1].T + np.outer(extra, pivots[:, -1]))
    return np.sqrt(np.maximum(square, 0))


def _keyed(pivots: np.ndarray, reach: float, dim: int):
    norms = (pivots**2).sum(1)

    def run(batches):
        for b in batches:
            x = _matrix(b.column("v"), dim)
            d = _distances(x, np.sqrt(np.maximum(reach - (x * x).sum(1), 0)), pivots, norms)
            p = d.argmin(1) if len(d) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [b.column("ids"), b.column("v"), pa.array(p, pa.int32()), pa.array(d[np.arange(len(d)), p], pa.float64())],
                names=["ids", "v", "pivot", "distance"],
            )

    return run


def _cut(pivots: np.ndarray, reach: float, dim: int, block: int):
    """Sorted vectors as blocks that lie around one pivot each."""
    norms = (pivots**2).sum(1)

    def run(batches):
        from pyspark import TaskContext

        number, part = 0, TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def blocks(t: pa.Table, last: bool):
            nonlocal number
            pivot = t.column("pivot").to_numpy()
            at = 0
            while at < len(pivot):
                end = min(at + block, int(np.searchsorted(pivot[at:], pivot[at], "right")) + at)
                if end == len(pivot) and end - at < block and not last:
                    break
                own = t.slice(at, end - at)
                x = _matrix(own.column("v"), dim)
                d = _distances(x, np.sqrt(np.maximum(reach - (x * x).sum(1), 0)), pivots, norms)
                ids = own.column("ids").combine_chunks()
                lengths = np.diff(ids.offsets.to_numpy()).astype("<i4")
                packed = np.int32(len(lengths)).tobytes() + lengths.tobytes() + ids.flatten().to_numpy().astype("<i8").tobytes()
                yield part + number, packed, x.astype("<f8").tobytes(), d.min(0).tobytes(), d.max(0).tobytes(), end - at
                number += 1
                at = end
            held[:] = t.slice(at).to_batches()

        names = ["block", "ids", "vectors", "near", "far", "n"]
        types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
        def batch(rows):
            columns = list(zip(*rows)) or [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= block:
                yield batch(list(blocks(pa.Table.from_batches(held), False)))
        if sum(x.num_rows for x in held):
            yield batch(list(blocks(pa.Table.from_batches(held), True)))

    return run


def _unpacked_ids(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, "<i4", 1)[0])
    return np.frombuffer(data, "<i4", n, 4), np.frombuffer(data, "<i8", offset=4 + 4 * n)


def _query_blocks(pivots: np.ndarray, reach: float, dim: int, size: int):
    norms = (pivots**2).sum(1)

    def run(batches):
        from pyspark import TaskContext

        number, part = 0, TaskContext.get().partitionId() << 32
        for b in batches:
            for at in range(0, b.num_rows, size):
                own = b.slice(at, size)
                x = _matrix(own.column("v"), dim)
                d = _distances(x, np.zeros(len(x)), pivots, norms)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part + number], pa.int64()), pa.array([own.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()), pa.array([x.astype("<f8").tobytes()], pa.binary()), pa.array([d.tobytes()], pa.binary())],
                    names=["piece", "query_ids", "query_vectors", "query_distances"],
                )
                number += 1

    return run


def _wanted(pivots: int, slack: float, low: int, high: int):
    """Of (piece of queries, block summaries) pairs those to search: each query's blocks from place low to high by their
    bounds, as far as these lie within its radius (if it has one yet)."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                d = np.frombuffer(row["query_distances"]).reshape(-1, pivots)
                near = np.frombuffer(b"".join(row["nears"])).reshape(-1, pivots)
                far = np.frombuffer(b"".join(row["fars"])).reshape(-1, pivots)
                blocks = np.array(row["blocks"], "i8")
                if low >= len(blocks):
                    continue
                bound = np.zeros((len(d), len(blocks)))
                for p in range(pivots):
                    np.maximum(bound, near[None, :, p] - d[:, p, None], out=bound)
                    np.maximum(bound, d[:, p, None] - far[None, :, p], out=bound)
                hit = np.zeros(bound.shape, bool)
                np.put_along_axis(hit, np.argsort(bound, 1, kind="stable")[:, low:high], True, 1)
                if row["radius"] is not None:
                    hit &= bound <= np.frombuffer(row["radius"])[:, None] + slack
                columns = np.flatnonzero(hit.any(0))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(columns), row["piece"]), pa.int64()),
                        pa.array(blocks[columns], pa.int64()),
                        pa.array([np.flatnonzero(hit[:, c]).astype("<i4").tobytes() for c in columns], pa.binary()),
                    ],
                    names=["piece", "block", "rows"],
                )

    return run


def _search(k: int, dim: int):
    """Scores of one block of queries against one block of vectors: the best k ids of each query."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                use = np.frombuffer(row["rows"], "<i4")
                qid = np.frombuffer(row["query_ids"], "<i8")[use]
                q = np.frombuffer(row["query_vectors"]).reshape(-1, dim)[use]
                x = np.frombuffer(row["vectors"]).reshape(-1, dim)
                counts, ids = _unpacked_ids(row["ids"])
                starts = np.cumsum(counts) - counts
                scores = q @ x.T
                most = min(k + 1, scores.shape[1])
                least = np.partition(scores, scores.shape[1] - most, 1)[:, -most] if most else np.zeros(len(q))
                r, c = np.nonzero(scores >= least[:, None])
                n = counts[c]
                at = np.repeat(starts[c], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                r, s, i = np.repeat(r, n), np.repeat(scores[r, c], n), ids[at]
                keep = i != qid[r]
                r, s, i = r[keep], s[keep], i[keep]
                order = np.lexsort((i, -s, r))
                r, s, i = r[order], s[order], i[order]
                rank = np.arange(len(r)) - np.searchsorted(r, r)
                top = rank < k
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(int(top.sum()), row["piece"]), pa.int64()), pa.array(use[r[top]], pa.int32()),
                        pa.array(qid[r[top]], pa.int64()), pa.array(i[top], pa.int64()), pa.array(s[top].astype("i8"), pa.int64()),
                    ],
                    names=["piece", "row", "query_id", "vec_id", "score"],
                )

    return run


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each query row; hits have at most k rows for each query and block."""
    w = Window.partitionBy("piece", "row").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


class PivotIndex:
    """Blocks of vectors by nearest pivot and distance, written to the shared folder."""

    def __init__(self, vectors: DataFrame, k: int, pivots: int = PIVOTS, block: int = BLOCK):
        """vectors: id, v as quantised() gives them; k: the most neighbours a search may ask for."""
        spark = vectors.sparkSession
        bounds = vectors.select(
            F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)).alias("reach"), F.max(F.size("v")).alias("dim")
        ).first()
        self.k, self.reach, self.dim = k, bounds.reach or 0.0, max(1, bounds.dim or 1)
        sample = vectors.orderBy(F.xxhash64("id"), "id").limit(pivots).select("v").toPandas()
        p = np.zeros((max(1, len(sample)), self.dim + 1))
        for row, v in zip(p, sample.v):
            row[: len(v)] = v
            row[-1] = np.sqrt(max(self.reach - (row[:-1] ** 2).sum(), 0))
        self.pivots = p
        w = Window.partitionBy("v").orderBy("id")
        once = vectors.distinct().withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k + 1)
        once = once.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select("ids", "v")
        keyed = once.mapInArrow(_keyed(p, self.reach, self.dim), "ids array<long>, v array<double>, pivot int, distance double")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        ordered = keyed.repartitionByRange(parts, "pivot", "distance").sortWithinPartitions("pivot", "distance")
        self.blocks = saved(ordered.mapInArrow(_cut(p, self.reach, self.dim, block), _BLOCKS), "pivot-blocks")

    def _summaries(self) -> tuple[DataFrame, int]:
        """Block bounds, many to a row, and how many rows there are at most."""
        s = F.sort_array(F.collect_list(F.struct("block", "near", "far")))
        chunks = max(1, -(-self.blocks.count() // SUMMARIES))
        chunk = F.pmod(F.xxhash64("block"), F.lit(chunks))
        g = self.blocks.groupBy(chunk.cast("int").alias("chunk")).agg(s.alias("s"))
        return saved(g.select("chunk", F.col("s.block").alias("blocks"), F.col("s.near").alias("nears"), F.col("s.far").alias("fars")), "pivot-bounds"), chunks

    def search(self, queries: DataFrame) -> DataFrame:
        """queries(id, v) as query_id, rank, vec_id, score."""
        args = (self.pivots, self.reach, self.dim)
        parts = max(1, min(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-queries.count() // QUERY_BLOCK)))
        keyed = queries.select(F.array("id").alias("ids"), "v").mapInArrow(_keyed(*args), "ids array<long>, v array<double>, pivot int, distance double")
        ordered = keyed.repartitionByRange(parts, "pivot", "distance").sortWithinPartitions("pivot", "distance").select(F.get("ids", F.lit(0)).alias("id"), "v")
        pieces = ordered.mapInArrow(_query_blocks(*args, QUERY_BLOCK), "piece long, query_ids binary, query_vectors binary, query_distances binary")
        pieces = saved(pieces, "pivot-queries")
        bounds, chunks = self._summaries()
        every = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")  # one for SUMMARIES * BLOCK vectors
        np_, slack = len(self.pivots), _SLACK * float(np.sqrt(self.reach))
        radii = pieces.select("piece", "query_distances", F.lit(None).cast("binary").alias("radius"))
        hits, low, high = None, 0, FIRST_BLOCKS
        while True:
            meets = radii.select("piece", "query_distances", "radius", every).join(bounds, "chunk")
            need = saved(meets.mapInArrow(_wanted(np_, slack, low, high), _NEEDS), "pivot-needs")
            if need.isEmpty():
                break
            new = self._scored(need, pieces)
            hits = saved(_best(new if hits is None else hits.unionByName(new), self.k).drop("rank"), "pivot-hits")
            # a query's radius: the distance at its k-th score, or all where it has fewer
            kth = hits.groupBy("piece", "row").agg(F.min("score").alias("least"), F.count("*").alias("n"))
            kth = kth.groupBy("piece").agg(F.collect_list(F.struct("row", F.when(F.col("n") >= self.k, F.col("least")).alias("least"))).alias("kth"))
            radii = pieces.join(kth, "piece", "left").mapInArrow(_radii(self.reach, self.dim), "piece long, query_distances binary, radius binary")
            low, high = high, high * GROWTH
        if hits is None:
            return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        return _best(hits, self.k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

    def _scored(self, need: DataFrame, pieces: DataFrame) -> DataFrame:
        pairs = need.join(pieces.drop("query_distances"), "piece").join(self.blocks.select("block", "ids", "vectors"), "block")
        return pairs.mapInArrow(_search(self.k, self.dim), "piece long, row int, query_id long, vec_id long, score long")


def _radii(reach: float, dim: int):
    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            radii = []
            for row in rows:
                q = np.frombuffer(row["query_vectors"]).reshape(-1, dim)
                square = np.full(len(q), np.inf)
                for x in row["kth"] or ():
                    if x["least"] is not None:
                        square[x["row"]] = (q[x["row"]] ** 2).sum() + reach - 2 * x["least"]
                radii.append(np.sqrt(np.maximum(square, 0)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("piece"), batch.column("query_distances"), pa.array(radii, pa.binary())], names=["piece", "query_distances", "radius"]
            )

    return run


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """For the rows whose id is divisible by `every`, the k best of all other rows."""
    vectors = saved(quantised(embeddings), "pivot-vectors")
    return PivotIndex(vectors, k).search(vectors.where(F.col("id") % every == 0))


def op2_pivot_distance_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))
