"""Approximate nearest neighbours by multi-index hashing.

A rotation learned on a bounded sample (ITQ: principal axes, then the rotation that brings the data nearest to the
corners of a cube; several starts give more bits) turns vectors into binary codes. A code is split into substrings and
each substring is indexed. By the pigeonhole principle a code within Hamming radius R of the query's differs by at most
R / m in one of its m substrings, so probing each index within that radius finds every such code; those are reranked by
the cosine of the original vectors in double precision. R comes from the sample: nearly all true neighbours of sampled
vectors, which lie farther apart than in the whole table, are within it. A query that finds too few in a shard widens the
radius step by step until it has enough, or the whole shard; so every query gets its full number of rows.

Rows are staged once and indexed in shards of bounded size; queries come in broadcast blocks of bounded size. Of rows with one and the
same vector the ``k + 1`` smallest ids take part, which can't change a result, and one such vector is searched once, so a
vector that a third of the rows share costs no more than any other.

Null ids, and vectors that are null, zero, of another length than most, or hold null or non-finite components, take no
part. Repeated rows count once. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Stage, bound_batches, table

K = 5
EVERY = 50
SAMPLE = 4096
STARTS = 2
SHARD_ROWS = 1 << 15
#: Bytes of query vectors in a broadcast block, and bits by which a radius that holds too few grows.
BLOCK_BYTES = 32 << 20
WIDER = 8
#: Share of the sample's true neighbours that the radius must hold.
WITHIN = 0.98

_DISTANCE = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])


class Codes:
    """Learned rotations and the search radius."""

    def __init__(self, sample: np.ndarray, starts: int = STARTS, k: int = K, seed: int = 7):
        x = unit(sample)
        d = x.shape[1]
        _, _, axes = np.linalg.svd(x, full_matrices=True) if len(x) < d else (None, None, np.linalg.eigh(x.T @ x)[1].T[::-1])
        rng = np.random.default_rng(seed)
        self.rotations = []
        for _ in range(starts):
            v = x @ axes.T
            r = np.linalg.qr(rng.standard_normal((d, d)))[0]
            for _ in range(20):
                u, _, w = np.linalg.svd(np.sign(v @ r).T @ v)
                r = (u @ w).T
            self.rotations.append(axes.T @ r)
        self.bits = d * starts
        n = min(len(x), 512)
        cos = x[:n] @ x.T
        cos[np.arange(n), np.arange(n)] = -2
        near = np.argsort(-cos, axis=1)[:, : min(k, len(x) - 1)]
        c = self.of(x)
        dist = np.bitwise_count(c[:n, None, :] ^ c[near]).sum(axis=2, dtype=np.int64)
        self.radius = int(math.ceil(np.quantile(dist, WITHIN))) if dist.size else self.bits

    def of(self, unit_vectors: np.ndarray) -> np.ndarray:
        bits = np.concatenate([unit_vectors @ r > 0 for r in self.rotations], axis=1)
        return np.packbits(bits, axis=1)


def unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Index:
    """The substring indexes of one shard: rows of each byte value, in order."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(codes[:, s], kind="stable") for s in range(codes.shape[1])]
        self.start = [np.searchsorted(codes[o, s], np.arange(257)) for s, o in enumerate(self.order)]

    def enough(self, code: np.ndarray, radius: int, k: int) -> np.ndarray:
        """All rows within the radius; or, if those are fewer than k, within the next wider one that has k, if any has."""
        rows = self.within(code, radius)
        while len(rows) < min(k, len(self.codes)):
            radius += WIDER
            rows = self.within(code, radius)
        return rows

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is within the radius."""
        hit = np.zeros(len(self.codes), bool)
        part = radius // self.codes.shape[1]
        for s, value in enumerate(code):
            v = np.flatnonzero(_DISTANCE[value] <= part)
            a, n = self.start[s][v], self.start[s][v + 1] - self.start[s][v]
            at = np.arange(int(n.sum())) + np.repeat(a - np.cumsum(n) + n, n)
            hit[self.order[s][at]] = True
        rows = np.flatnonzero(hit)
        near = np.bitwise_count(self.codes[rows] ^ code).sum(axis=1, dtype=np.int64) <= radius
        return rows[near]


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of one vector with rows, in double precision; equal rows give equal cosines."""
    return np.clip((unit(x) * unit(q[None, :])).sum(axis=1), -1.0, 1.0)


def _valid(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    ok = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    return rows.where(F.forall("v", ok) & F.exists("v", lambda c: c != 0))


def search(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of each query, its own row left out."""
    spark = vectors.sparkSession
    bound_batches(spark, 4096)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    rows, asked = _valid(vectors, key, vector), _valid(queries, key, vector)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    d = lengths[0].d
    rows, asked = rows.where(F.size("v") == d), asked.where(F.size("v") == d).distinct()
    sample = rows.withColumn("h", F.xxhash64("v")).orderBy("h", "id").limit(SAMPLE).select("v").toArrow()
    x = np.array(sample.column(0).to_pylist(), np.float64)
    x = x[np.sort(np.unique(x, axis=0, return_index=True)[1])]  # in an order by hash, so that the first rows are any rows
    codes = Codes(x, k=k)

    first = Window.partitionBy("v").orderBy("id")
    kept = rows.withColumn("place", F.dense_rank().over(first)).where(F.col("place") <= k + 1).select("id", "v").dropDuplicates(["v", "id"])
    staged = Stage(kept, "vectors")
    kept = staged.df
    keyed = asked.withColumn("q", F.xxhash64("v"))
    distinct = keyed.groupBy("q").agg(F.first("v").alias("v"))
    blocks = max(1, math.ceil(distinct.count() * 8 * d / BLOCK_BYTES))
    model = spark.sparkContext.broadcast(codes)
    found = None
    for b in range(blocks):
        # About BLOCK_BYTES of vectors at once.
        part = distinct.where(F.pmod("q", F.lit(blocks)) == b).toArrow()
        block = spark.sparkContext.broadcast((np.array(part.column("q").to_pylist(), np.int64), np.array(part.column("v").to_pylist(), np.float64).reshape(-1, d)))
        got = kept.mapInArrow(_probe(model, block, k + 1), "q bigint, id bigint, score double")
        found = got if found is None else found.unionByName(got)
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    top = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    top = top.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("near"))
    mine = F.slice(F.filter("near", lambda n: n["id"] != F.col("query_id")), 1, k)
    out = keyed.select(F.col("id").alias("query_id"), "q").join(top, "q").select("query_id", F.posexplode(mine).alias("at", "n"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.id").alias("vec_id"), F.col("n.score").alias("score"))


def _probe(model, block, k: int):
    def shard(ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        codes, (q, qv) = model.value, block.value
        index, qc = Index(codes.of(unit(v))), codes.of(unit(qv)) if len(qv) else []
        out_q, out_i, out_s = [], [], []
        for i in range(len(q)):
            rows = index.enough(qc[i], codes.radius, k)
            s = cosine(qv[i], v[rows])
            best = np.lexsort((ids[rows], -s))[:k]
            out_q.append(np.full(len(best), q[i]))
            out_i.append(ids[rows][best])
            out_s.append(s[best])
        cat = lambda a, t: pa.array(np.concatenate(a) if a else [], t)
        return pa.RecordBatch.from_arrays([cat(out_q, pa.int64()), cat(out_i, pa.int64()), cat(out_s, pa.float64())], names=["q", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vs, n = [], [], 0
        for b in batches:
            if not b.num_rows:
                continue
            ids.append(b.column(0).to_numpy(zero_copy_only=False))
            vs.append(b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1))
            n += b.num_rows
            if n >= SHARD_ROWS:
                yield shard(np.concatenate(ids), np.concatenate(vs))
                ids, vs, n = [], [], 0
        if n:
            yield shard(np.concatenate(ids), np.concatenate(vs))

    return run


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where(F.col("vec_id") % EVERY == 0))
