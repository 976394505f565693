"""Centroid clustering against exact integers in plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest
from helpers import DATA

from lexmill.llm import op12_centroids


def expected(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)
    cs = [q for _, q in named[:k]]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        of = [near(q)[1] for _, q in kept]
        cs = [[sum(x) // len(m) for x in zip(*m, strict=True)] if (m := [q for (_, q), o in zip(kept, of, strict=True) if o == j]) else c for j, c in enumerate(cs)]
    got = [(i, *near(q)[::-1]) for i, q in kept]
    total = lambda j: sum(d for _, c, d in got if c == j)
    return sorted(((-1 if i is None else i), c, d, total(c), sum(d for *_, d in got), hashlib.sha256(",".join(map(str, cs[c])).encode()).hexdigest()) for i, c, d in got)


def made(spark, tmp_path, rows):
    spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<double>, cluster int, distance string").repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    return sorted((-1 if r.vec_id is None else r.vec_id, *list(r)[1:]) for r in op12_centroids.query(spark, str(tmp_path)).collect())


@pytest.mark.parametrize("scale", [0.01, 1.0, 30.0, 3e5])
def test_clusters_equal_exact_integers(spark, tmp_path, scale):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, scale) for _ in range(64)]) for i in range(300)]
    rows += [(500 + i, rows[7][1]) for i in range(60)] + [(9, rows[3][1]), (None, rows[4][1]), (600, [0.0] * 64), (601, [-0.0] * 64)]
    rows += [(700, None), (701, []), (702, [1.0] * 63), (703, [1.0] * 65), (704, [None] + [1.0] * 63), (705, [float("nan")] * 64), (706, [float("inf")] + [0.0] * 63)]
    assert made(spark, tmp_path, rows) == expected(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, tmp_path, n):
    rows = [(i, [float(i * j % 7) for j in range(64)]) for i in range(n)] + [(99, None)]
    assert made(spark, tmp_path, rows) == expected(rows)


def test_ties_go_to_the_lowest_number():
    centroids = np.array([[5] * 64, [1] * 64, [-1] * 64, [1] * 64], np.int64)
    first, d = op12_centroids.nearest(np.array([[0] * 64, [1] * 64, [3] * 64], np.int64), centroids)
    assert first.tolist() == [1, 1, 0] and d.tolist() == [64, 0, 256]


def test_screening_never_loses_the_nearest():
    """Large, nearly equal distances, where float32 alone is often wrong."""
    rng = np.random.default_rng(1)
    base = rng.integers(-(1 << 26), 1 << 26, 64)
    centroids = base + rng.integers(-40, 40, (16, 64))
    q = base + rng.integers(-50, 50, (2000, 64)) + (1 << 20)
    exact = np.array([[int(((x.astype(object) - c.astype(object)) ** 2).sum()) for c in centroids] for x in q[:300]], object)
    first, d = op12_centroids.nearest(q, centroids)
    assert first[:300].tolist() == [min(range(16), key=lambda j: (e[j], j)) for e in exact] and d[:300].tolist() == [min(e) for e in exact]
    x, c = q.astype(np.float32), centroids.astype(np.float32)
    assert (((c * c).sum(axis=1) - 2 * (x @ c.T)).argmin(axis=1) != first).any()


def test_too_wide_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="would not fit 64 bits"):
        made(spark, tmp_path, [(1, [1e9] * 64)])


def test_clusters_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in op12_centroids.query(spark, DATA).collect())
    assert got == expected(rows)
