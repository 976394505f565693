"""Nearest neighbours, toxicity, quality and the pipeline."""

import zlib

import numpy as np
import pytest
from helpers import DATA

import corpus_pipeline
from lexmill.llm import op1_ann, op5_toxicity, op10_quality, sampling
from lexmill.llm.calibrate import TIE, isotonic_fit, isotonic_predict
from lexmill.llm.queries import QUERIES


def brute(rows, queries, k=5):
    ids, v = np.array([i for i, _ in rows]), np.array([x for _, x in rows], float)
    out = {}
    for q, x in queries:
        s = op1_ann.cosine(np.array(x, float), v)
        near = [(i, c) for i, c in sorted(zip(ids.tolist(), s.tolist(), strict=True), key=lambda p: (-p[1], p[0])) if i != q][:k]
        out[q] = near
    return out


def test_recall_and_scores(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 50 == 0])
    got = {}
    for r in QUERIES["op1_ann"](spark, DATA).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want) and all(len(x) == 5 for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    exact = {(q, i): c for q, near in brute(rows, [r for r in rows if r[0] % 50 == 0], 1000).items() for i, c in near}
    assert all(abs(exact[q, i] - c) < 1e-12 for q, near in got.items() for i, c in near)


def test_vectors_that_take_no_part(spark):
    good = [(i, [1.0, float(i % 3), 0.5]) for i in range(30)]
    bad = [(100, None), (150, [0.0, 0.0, 0.0]), (200, [1.0, None, 2.0]), (250, [float("nan"), 1.0, 1.0]), (300, [float("inf"), 0.0, 0.0]), (350, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    schema = "vec_id bigint, embedding array<float>, score string, v int"
    df = spark.createDataFrame([(i, v, "s", 0) for i, v in [*good, *bad, good[0]]], schema)
    got = op1_ann.search(df, df.where("vec_id % 50 = 0")).orderBy("rank").collect()
    # Many ties: equal vectors go by id, the query's own row is left out.
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, i + 1, v) for i, v in enumerate([3, 6, 9, 12, 15])]
    assert all(abs(r.score - 1) < 1e-12 for r in got)
    two = spark.createDataFrame([(0, [1.0, 0.0], "", 0), (1, [1.0, 1.0], "", 0)], schema)
    assert [(r.vec_id, r.rank) for r in op1_ann.search(two, two.limit(1)).collect()] == [(1, 1)]
    assert op1_ann.search(df.limit(0), df.limit(0)).collect() == []


def test_pigeonhole_probing_is_complete():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 256, (500, 6)).astype(np.uint8)
    codes[:100] = codes[100] ^ (rng.random((100, 6)) < 0.3)
    index = op1_ann.Index(codes)
    for q in codes[90:110]:
        for radius in (0, 5, 11, 48):
            want = np.flatnonzero(np.bitwise_count(codes ^ q).sum(axis=1) <= radius)
            assert (index.within(q, radius) == want).all()


def test_outlying_queries_get_all_their_rows(spark):
    rng = np.random.default_rng(3)
    near = rng.normal(size=(400, 8)) * 0.05 + np.eye(8)[0]
    rows = [(i + 1, v.tolist()) for i, v in enumerate(near)] + [(500, (-np.eye(8)[0]).tolist()), (550, np.eye(8)[5].tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = op1_ann.search(df, df.where("vec_id >= 500")).collect()
    assert sorted((r.query_id, r["rank"]) for r in got) == [(q, k) for q in (500, 550) for k in range(1, 6)]
    want = brute(rows, rows[-2:])
    hits = sum(len({r.vec_id for r in got if r.query_id == q} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 9


def test_isotonic():
    x, y = isotonic_fit(np.array([3.0, 1, 2, 2]), np.array([1.0, 0, 1, 0]), np.ones(4))
    at = np.array([-1e6, 0, 1, 1.5, 2, 2.5, 3, 9.0, 1e6])
    got = isotonic_predict(x, y, at, 0.5)
    assert np.abs(got - [0, 0, 0, 0.25, 0.5, 0.75, 1, 1, 1]).max() <= TIE and (np.diff(got) > 0).all() and 0 <= got.min() and got.max() <= 1
    assert ((got >= 0.5) == (at >= 2)).all()
    assert (isotonic_predict(np.array([1.0]), np.array([0.3]), np.array([-5, 1, 5.0]), 0.3) >= 0.3).all()


def test_texts_are_learned_from_whole_or_not(spark, monkeypatch):
    monkeypatch.setattr(sampling, "MOST_CHARS", 100)
    rows = [("a" * 60, 1, 3, "x"), ("b" * 50, 0, 4, "y"), ("c" * 30, 1, 5, "z"), ("", 0, 6, "v"), ("d" * 11, 0, 7, "w"), ("e" * 10, 0, 8, "w")]
    df = spark.createDataFrame(rows[::-1], "text string, label int, h bigint, key string")
    assert sampling.fitted(df, lambda got: got) == [("a" * 60, 1), ("c" * 30, 1), ("", 0), ("e" * 10, 0)]


def labelled(toxic):
    """Synthetic labelled texts: two words give toxic ones away, and noise gives bad ones."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        w = rng.choice(["bana", "tolu", "miro", "sesta", "kelu", "dorvi"], 40).tolist()
        y = int(i % 3 == 0)
        if toxic and y:
            w[5:5] = ["du", "lowerbur"]
        if not toxic and not y:
            w = [x.upper() + "!!%%" for x in w]
        rows.append((i, " ".join(w), y))
    return rows


@pytest.mark.parametrize("kind", ["toxic", "quality"])
def test_models_learn_and_hold_out(spark, make_docs, kind):
    op, threshold = (op5_toxicity, 0.5) if kind == "toxic" else (op10_quality, 0.3)
    rows = labelled(kind == "toxic")
    docs = make_docs([(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (902, "word " * 20000), (None, "bana tolu"), (0, rows[0][1])])
    labels = spark.createDataFrame([(i, y, "z") for i, _, y in rows] + [(1, None, "z"), (None, 1, "z"), (2, rows[2][2], "z")], f"doc_id bigint, {kind} int, text string")
    got = op.score(docs, op.fit(docs, labels)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) + 5 and by[900].score == by[901].score
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert len({r.score for r in got if r.doc_id == 0}) == 1
    held = [(by[i].predicted, y) for i, _, y in rows if by[i].held_out]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    # Held-out labels change nothing.
    wrong = labels.withColumn(kind, __import__("pyspark.sql.functions", fromlist=["F"]).expr(f"case when pmod(crc32(cast(doc_id as string)), 5) = 0 then 1 - {kind} else {kind} end"))
    again = {r.doc_id: r.score for r in op.score(docs, op.fit(docs, wrong)).collect()}
    assert all(again[i] == by[i].score for i, _, _ in rows)


@pytest.mark.parametrize("op", [op5_toxicity, op10_quality])
def test_models_without_labels(spark, make_docs, op):
    none = spark.createDataFrame([], "doc_id bigint, toxic int, quality int")
    docs = make_docs([(1, "a"), (2, None)])
    assert op.score(docs, op.fit(docs, none)).count() == 2
    assert op.score(docs.limit(0), op.fit(docs.limit(0), none)).count() == 0


def test_clean_keeps_columns(spark, make_docs):
    rows = labelled(True)
    docs = make_docs([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    kept = op5_toxicity.clean(docs, op5_toxicity.fit(docs, labels))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, y in rows if not y}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "decontamination", "bpe"]
    at, kept = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, DATA)
        assert at.columns == docs.columns
        at = spark.createDataFrame(at.toArrow().to_pandas(), docs.schema)
        kept.append(at.count())
    assert docs.count() >= kept[0] and kept[0] == kept[1] and kept[1] >= kept[2] > 0
    want = corpus_pipeline.STAGES[-1][1](spark, at, DATA)
    key = lambda df: sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in df.collect())
    assert key(corpus_pipeline.run(spark, DATA)) == key(want)
    assert corpus_pipeline.run(spark, DATA).count() == kept[-1]
