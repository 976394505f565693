"""Sketches, and near-dedup by them, against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
from helpers import DATA
from test_copies import changed, classes, prose

from lexmill.llm import op13_minhash


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} - {()}


def expected(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    near = lambda x, y: x and y and 100 * len(x & y) >= 85 * len(x | y)
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if any(near(x, y) for x in sets[a] for y in sets[b])]
    return sets, classes(sets, links)


def near_docs():
    """Copies; clusters of near copies on both sides of the threshold; parts of one text of all lengths; chains; texts
    that share long passages; short ones."""
    rng = random.Random(12)
    base, second, other = prose(rng, 150), prose(rng, 260), prose(rng, 90)
    texts = [" ".join(base)] * 6
    texts += [" ".join(changed(rng, base, rng.choice([1, 2, 3, 4, 5, 6, 7]))) for _ in range(70)]
    family = changed(rng, base, 8)
    texts += [" ".join(changed(rng, family, rng.choice([0, 1, 3]))) for _ in range(15)]
    texts += [" ".join(second[: 260 - rng.choice([0, 1, 20, 30, 40, 45, 50, 60, 61, 62])]) for _ in range(30)]
    texts += [" ".join(second[:190] + prose(rng, rng.choice([5, 20, 40]))) for _ in range(15)]
    chain = other
    for _ in range(14):
        texts.append(" ".join(chain))
        chain = changed(rng, chain, 1)
    texts += [" ".join(prose(rng, 12) + base[:70] + prose(rng, 25)) for _ in range(20)]
    texts += ["", None, "one", "one", "One", "a b", "a b c", "A B  C\nD", "a b c d e f g h i", "a b c d e f g h j", "k a b c d e f g h i", " ".join(base) * 4, " ".join(prose(rng, 3000))]
    return texts


@pytest.mark.parametrize("served", [256, 4])
def test_groups_equal_brute_force(make_docs, monkeypatch, served):
    monkeypatch.setattr(op13_minhash, "SERVED", served)
    texts = near_docs()
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(5000, texts[0]), (5000, texts[-1]), (5001, texts[30])]
    sets, want = expected(rows)
    df = make_docs([*rows, (None, texts[0])])
    got = op13_minhash.join(df).collect()
    assert len(got) == len(rows) + 1
    assert {r.doc_id: (r.component_id, r.kept) for r in got if r.doc_id is not None} == {i: (want[i], want[i] == i) for i in sets}
    assert sorted((r.doc_id, r.n_shingles) for r in got if r.doc_id is not None) == sorted((i, len(s)) for i, of in sets.items() for s in of)
    assert [(r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None] == [(len(shingles(texts[0])), None, True)]
    kept = op13_minhash.dedup(df)
    assert kept.columns == df.columns and kept.where("doc_id is null").count() == 1
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == set(want.values())


def test_groups_of_nothing(make_docs):
    assert op13_minhash.join(make_docs([])).count() == 0
    assert op13_minhash.dedup(make_docs([(1, None), (2, "")])).count() == 2


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b c d", 1, 2, 3, 4), (2, "a b c d", 1, 2, 3, 4)], "doc_id bigint, text string, gone int, k int, c int, sig int")
    assert [tuple(r) for r in op13_minhash.dedup(df).collect()] == [(1, "a b c d", 1, 2, 3, 4)]


def test_sketches_are_full_and_tell_similarity():
    rng = np.random.default_rng(3)
    sets, true = [], []
    for n in (1, 2, 7, 40, 1000, 5000):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for share in (0.0, 0.5, 0.85, 1.0):
            k = round(n * share)
            b = np.concatenate((a[:k], rng.integers(0, 1 << 63, n - k, dtype=np.uint64)))
            sets += [np.unique(a), np.unique(b)]
            true.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    got = op13_minhash.sketches(sets)
    assert got.shape == (len(sets), op13_minhash.T) and (got != np.uint64(2**64 - 1)).all()
    agree = (got[0::2] == got[1::2]).mean(axis=1)
    assert np.abs(agree - true).max() < 4.5 * 0.5 / op13_minhash.T**0.5
    alone = np.concatenate([op13_minhash.sketches([s]) for s in sets])  # whatever is sketched beside it
    assert (alone == got).all()


def test_pairs_at_the_threshold_meet():
    """Recall of a single link: of pairs just at the threshold, how many share a band."""
    rng = np.random.default_rng(8)
    pairs = []
    for n in (20, 74, 500):
        for _ in range(300):
            shared = math_ceil(85 * 2 * n, 185)
            a = rng.integers(0, 1 << 63, 2 * n - shared, dtype=np.uint64)
            pairs += [a[:n], np.concatenate((a[:shared], a[n:]))]
    keys = op13_minhash.bands(op13_minhash.sketches(pairs))
    assert ((keys[0::2] == keys[1::2]).any(axis=1)).all()


def math_ceil(a, b):
    return -(-a // b)


def test_groups_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    sets, want = expected(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op13_minhash.query(spark, DATA).collect()}
    assert got == {i: (len(s[0]), want[i]) for i, s in sets.items()}
