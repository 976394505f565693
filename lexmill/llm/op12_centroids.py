"""Exact centroid clustering of vectors: integers throughout, with float32 products only to leave centroids out.

Vectors are turned into integers, floor(64 * x). A pass assigns each to its nearest centroid by exact squared distance,
lowest number first where two are equally near; a round then moves each centroid to the floor of its vectors' mean.

1. Screening. One float32 matrix product of a block of vectors with all centroids gives approximate dot products. Each is
   within ``gamma * |x| * |c|`` of the true one, whatever order the sum was taken in and whether or not products were
   fused: gamma = n u / (1 - n u) for u = 2**-24 and n two more than the components, as entering float32 may round both
   factors. Norms are exact integers. So each distance lies in an interval, and a centroid whose interval begins above the
   least upper end can't be the nearest.
2. What is left is recomputed with 64-bit integers where several intervals overlap; the first of equal ones wins.

Each pass reads the table once and shuffles nothing but, for each task, sums and counts of the centroids; they are added up
on Spark, so the driver gets one row for each centroid and component. The centroids, of fixed number and width, go out with
the tasks. Nothing depends on which task saw which row, so a lost executor's tasks may run again. A vector that is very
common costs what any other does.

Defined results: vectors of another length, null ones and those with a null or non-finite component take no part. Rows
that repeat a vec_id count each. Starting centroids are the rows with the smallest sha256 of ``1:<vec_id>``; of rows of
one id, those with the least components; rows without an id are never one, but are assigned. With fewer rows than
centroids there are as many centroids as rows; an empty table gives no rows. Integers beyond 2**27 could put distances
beyond 64 bits, which is what the result has, and are refused with an error. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stage, table

CENTROIDS, ROUNDS, WIDTH, SCALE = 16, 3, 64, 64
#: Vectors that are multiplied at once.
BLOCK = 4096
MOST = 1 << 27


def quantised(column: pa.Array, width: int = WIDTH, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their integers) of an array of lists of numbers."""
    values, lens = column.flatten(), pc.fill_null(column.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lens)
    right = np.flatnonzero(lens == width)
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    at = (ends - lens)[right, None] + np.arange(width)
    x = flat[at] if len(right) else np.zeros((0, width))
    fine = np.isfinite(x).all(axis=1)
    x, right = x[fine], right[fine]
    q = np.floor(x * scale)
    if q.size and not (np.abs(q) <= MOST).all():
        raise ValueError(f"a component beyond {MOST // scale}: distances would not fit 64 bits")
    return right, q.astype(np.int64)


def nearest(q: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, exact squared distance) of the nearest centroid of each row."""
    if not len(q):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = (q.shape[1] + 2) * 2.0**-24
    gamma = n / (1 - n)
    dot = (q.astype(np.float32) @ centroids.astype(np.float32).T).astype(np.float64)
    xx, cc = ((a * a).sum(axis=1).astype(np.float64) for a in (q, centroids))
    about = xx[:, None] + cc[None, :] - 2 * dot
    # The last term covers the roundings of the line above and of the norms, in float64.
    off = 2.001 * gamma * np.sqrt(xx[:, None] * cc[None, :]) + 2.0**-48 * (xx[:, None] + cc[None, :])
    near = about - off <= (about + off).min(axis=1, keepdims=True)
    first = near.argmax(axis=1)
    least = ((q - centroids[first]) ** 2).sum(axis=1)
    close = np.flatnonzero(near.sum(axis=1) > 1)
    for c in range(len(centroids)):  # upwards, so that of equal distances the lowest number stays
        rows = close[near[close, c] & (first[close] < c)]
        if len(rows):
            d = ((q[rows] - centroids[c]) ** 2).sum(axis=1)
            better = d < least[rows]
            least[rows[better]], first[rows[better]] = d[better], c
    return first, least


def _blocks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            b = batch.slice(i, BLOCK)
            rows, q = quantised(b.column(at))
            yield b, rows, q


def seeds(vectors: DataFrame, k: int = CENTROIDS, key: str = "vec_id", column: str = "embedding") -> np.ndarray:
    """The starting centroids. Each task names its first k, so the driver sees a few rows of each at most through Spark's
    own top-k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[tuple[str, list[int]]] = []
        for b, rows, q in _blocks(batches, 1):
            ids = b.column(0)
            new = []
            for i, row in enumerate(rows.tolist()):
                if (v := ids[row].as_py()) is not None:
                    h = hashlib.sha256(f"1:{v}".encode()).hexdigest()
                    if len(least) < k or h <= least[-1][0]:
                        new.append((h, q[i].tolist()))
            least = heapq.nsmallest(k, least + new)
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in least], pa.string()), pa.array([q for _, q in least], pa.list_(pa.int64()))], names=["h", "q"])

    got = vectors.select(key, column).mapInArrow(run, "h string, q array<bigint>").orderBy("h", "q").limit(k).collect()
    return np.array([r.q for r in got], np.int64).reshape(len(got), WIDTH)


def _moved(vectors: DataFrame, centroids: np.ndarray, column: str) -> np.ndarray:
    """Centroids after one round: exact floors of means; one without vectors stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = centroids.shape
        sums = np.zeros((k, width + 1), np.int64)  # the last column counts
        room = 1 << 34  # rows of which sums stay within 64 bits
        for _, _, q in _blocks(batches, 0):
            first, _ = nearest(q, centroids)
            if len(q):
                order = np.argsort(first, kind="stable")
                begin = np.flatnonzero(np.diff(first[order], prepend=-1))
                sums[first[order[begin]], :width] += np.add.reduceat(q[order], begin, axis=0)
                sums[:, width] += np.bincount(first, minlength=k)
            room -= len(q)
            if room < BLOCK:
                yield _sums(sums)
                sums[:], room = 0, 1 << 34
        yield _sums(sums)

    got = vectors.select(column).mapInArrow(run, "c int, at int, s bigint").groupBy("c", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    total = {(r.c, r.at): int(r.s) for r in got}
    out = centroids.copy()
    for c in range(len(out)):
        if n := total.get((c, WIDTH), 0):
            out[c] = [total[c, i] // n for i in range(WIDTH)]
    return out


def _sums(sums: np.ndarray) -> pa.RecordBatch:
    c, at = np.indices(sums.shape, dtype=np.int32)
    return pa.RecordBatch.from_arrays([pa.array(c.ravel()), pa.array(at.ravel()), pa.array(sums.ravel())], names=["c", "at", "s"])


def fit(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, key: str = "vec_id", column: str = "embedding") -> np.ndarray:
    centroids = seeds(vectors, k, key, column)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(vectors, centroids, column)
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(key, cluster, distance) of each vector that takes part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, rows, q in _blocks(batches, 1):
            first, d = nearest(q, centroids)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(first.astype(np.int32)), pa.array(d)], names=[key, "cluster", "distance"])

    if not len(centroids):  # nobody takes part
        return vectors.select(key).where("false").select(key, F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
    return vectors.select(key, column).mapInArrow(run, f"{key} {vectors.schema[key].dataType.simpleString()}, cluster int, distance bigint")


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, key: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector, and the centroids."""
    centroids = fit(vectors, k, rounds, key, column)
    got = Stage(assign(vectors, centroids, key, column), "centroids-assigned").df
    sums = {r.cluster: int(r.s) for r in got.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    named = [(c, s, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sums.items()]
    if any(n[2] >= 1 << 63 for n in named):
        raise ValueError("the inertia does not fit 64 bits")
    pick = lambda i, kind: F.element_at(F.create_map(*[x for n in named for x in (F.lit(n[0]), F.lit(n[i]).cast(kind))]), F.col("cluster")) if named else F.lit(None).cast(kind)
    return got.select("*", pick(1, "bigint").alias("cluster_inertia"), pick(2, "bigint").alias("inertia"), pick(3, "string").alias("centroid_sha256")), centroids


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))[0]
