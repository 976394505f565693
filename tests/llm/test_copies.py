"""Line dedup, the Jaccard join, decontamination, components: all against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
from helpers import DATA
from pyspark.sql import functions as F

from lexmill.llm import op3_lines, op6_jaccard, op9_decontaminate
from lexmill.llm.graph import components

WORDS = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "l")]


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def classes(nodes, links):
    parent = {n: n for n in nodes}
    for a, b in links:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {n: find(parent, n) for n in nodes}


@pytest.mark.parametrize("links", [[], [(1, 2), (3, 2), (4, 5), (5, 5), (None, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)]])
def test_components(spark, links):
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == classes({x for p in real for x in p}, real)


def prose(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def changed(rng, words, k):
    words = list(words)
    for i in rng.sample(range(len(words)), k):
        words[i] = rng.choice(WORDS) + "x"
    return words


def jaccard_docs():
    """Copies, a cluster of near copies of one text some of which are too far, chains, short texts, nulls."""
    rng = random.Random(5)
    base, other = prose(rng, 160), prose(rng, 90)
    texts = [" ".join(base)] * 6
    texts += [" ".join(changed(rng, base, rng.choice([1, 2, 3, 3, 4]))) for _ in range(60)]
    chain = other
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = changed(rng, chain, 1)
    texts += [" ".join(prose(rng, 8) + base[:40] + prose(rng, 60)) for _ in range(10)]
    texts += ["", None, "one", "one", "One", "a b c d", "a b c d e", "A B  C\nD E", " ".join(base) * 4, " ".join(prose(rng, 3000))]
    return texts


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


@pytest.mark.parametrize("bucket", [500_000, 20])
def test_jaccard_equals_brute_force(spark, make_docs, monkeypatch, bucket):
    monkeypatch.setattr(op6_jaccard, "BUCKET", bucket)  # lists of over 20 are dealt to several buckets
    texts = jaccard_docs()
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = classes(sets, links)
    got = op6_jaccard.join(make_docs([*rows, (None, texts[0])])).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {i: (len(s), want[i]) for i, s in sets.items()}
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id is None] == [(len(shingles(texts[0])), None)]
    kept = op6_jaccard.dedup(make_docs([*rows, (None, texts[0])]))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(want.values()))
    assert kept.columns == make_docs([]).columns and kept.where("doc_id is null").count() == 1


def test_jaccard_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 1, 2, 3, 4, 5), (2, "a b c d e f", 1, 2, 3, 4, 5)], "doc_id bigint, text string, __gone int, gone int, k int, c int, sig int")
    assert [tuple(r) for r in op6_jaccard.dedup(df).collect()] == [(1, "a b c d e f", 1, 2, 3, 4, 5)]


def test_jaccard_of_nothing(make_docs):
    assert op6_jaccard.join(make_docs([])).count() == 0
    assert op6_jaccard.dedup(make_docs([])).count() == 0


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def test_lines_equal_brute_force(spark, make_docs):
    rng = random.Random(3)
    long = prose(rng, 300)
    base = [prose(rng, 40) for _ in range(4)]
    lines = [" ".join(changed(rng, rng.choice(base), rng.choice([0, 1, 1, 2]))) for _ in range(80)] + [" ".join(long), " ".join(changed(rng, long, 2)), "***", "", "  ", "Same, LINE!", "same line", "ß ÄÖ"]
    rng.shuffle(lines)
    docs = [(i, "\n".join(lines[i * 9 : i * 9 + 9])) for i in range(10)] + [(50, None), (51, ""), (52, "\n\n")]
    df = make_docs([*docs, docs[0], (None, "same line\nnew one")])
    norm = lambda t: re.sub("[\x00-\x2f\x3a-\x60\x7b-\xbf]+", " ", t.lower()).strip()
    texts = {norm(t) for _, d in [*docs, (None, "same line\nnew one")] for t in (d or "").split("\n")} - {""}
    sims = {}
    for t in texts:
        got = op3_lines.Lines([op3_lines.folded(t)])
        assert got.normal(0) == op3_lines.normal(t) == t and int(got.size[0]) == len(t)
        bits = [sum(int(x) >> i & 1 for x in got.h) * 2 > len(got.h) for i in range(64)]
        sims[t] = int(got.sim[0])
        assert sims[t] == sum(1 << i for i, b in enumerate(bits) if b), t
    near = [(a, b) for a, b in itertools.combinations(sorted(texts), 2) if (sims[a] ^ sims[b]).bit_count() <= 3 and distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)]
    assert near
    group = classes(texts, near)
    seen, want = set(), {}
    for i, d in sorted([*docs, (-1, "same line\nnew one")]):  # a null id comes first
        keep = []
        for t in (d or "").split("\n"):
            n = norm(t)
            if not n or group[n] not in seen:
                keep.append(t)
            seen.add(group[n] if n else None)
        want[i] = d if d is None or len(keep) == len(d.split("\n")) else "\n".join(keep)
    got = op3_lines.dedup(df)
    assert got.columns == df.columns
    rows = [(-1 if r.doc_id is None else r.doc_id, r.text) for r in got.collect()]
    assert len(rows) == df.count() and dict(rows) == want


def test_wide_lines_equal_edit_similarity(make_docs):
    """Lines that are near by edit distance are one group, whatever their SimHashes say."""
    rng, lines = random.Random(8), ["abcde", "abcdx", "hunderteins", "hundertzwei", "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往", "天地玄黄宇宙洪荒日月盈昃辰宿列張寒来暑往"]
    for n in (2, 3, 4, 5, 6, 8, 10, 14, 20, 30, 50, 80):
        for _ in range(4):
            words = prose(rng, n)
            typo = list(words)
            typo[rng.randrange(n)] += "q"
            lines += [" ".join(words), " ".join(typo), " ".join(prose(rng, n))]
    near = [(a, b) for a, b in itertools.combinations(sorted(set(lines)), 2) if abs(len(a) - len(b)) <= len(max(a, b, key=len)) * 0.2 and distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)]
    group, seen, want = classes(set(lines), near), set(), []
    for t in lines:
        if group[t] not in seen:
            want.append(t)
        seen.add(group[t])
    got = {r.doc_id: r.text for r in op3_lines.dedup(make_docs(list(enumerate(lines))), wide=True).collect()}
    assert len(near) >= 48 and [got[i] for i in sorted(got) if got[i]] == want


@pytest.mark.parametrize("direct", [40, 2000])
def test_hot_pieces(make_docs, monkeypatch, direct):
    """Lines that all share pieces, some near and some not; with few direct comparisons keys are dealt again."""
    monkeypatch.setattr(op3_lines, "DIRECT", direct)
    monkeypatch.setattr(op3_lines, "DEEPER", 20 * direct)
    monkeypatch.setattr(op3_lines, "HOT", 10 if direct == 40 else 5000)
    rng = random.Random(4)
    same = "extraordinarily knowledgeable"
    bases = [prose(rng, 10) for _ in range(12)]
    lines = [" ".join([*b[:5], same, *changed(rng, b[5:], 1 if i % 2 else 0)]) for i, b in enumerate(bases * 3)]
    near = [(a, b) for a, b in itertools.combinations(sorted(set(lines)), 2) if distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)]
    group, seen, want = classes(set(lines), near), set(), []
    for t in lines:
        if group[t] not in seen:
            want.append(t)
        seen.add(group[t])
    got = {r.doc_id: r.text for r in op3_lines.dedup(make_docs(list(enumerate(lines))), wide=True).collect()}
    assert near and [got[i] for i in sorted(got) if got[i]] == want


def test_edit_distance():
    rng = random.Random(6)
    for _ in range(600):
        a = "".join(rng.choice("abc ") for _ in range(rng.randrange(30)))
        b = "".join(x if rng.random() < 0.8 else rng.choice(["", "d", x + "a"]) for x in a)
        d = distance(a, b)
        for most in (0, 2, 5, 40):
            got = op3_lines.distance(a, b, most)
            assert got == d if d <= most else got > most
        assert op3_lines.anchored_bound(a.split(" "), b.split(" ")) >= d
        assert op3_lines.similar(a, b) == (d <= op3_lines.allowed(max(len(a), len(b))))


def test_very_long_lines(make_docs):
    rng = random.Random(7)
    long = [w[:2] for w in prose(rng, 66_000)]  # more words than a 16-bit counter holds
    docs = [(1, " ".join(long)), (2, " ".join(changed(rng, long, 40)))]
    got = {r.doc_id: r.text for r in op3_lines.dedup(make_docs(docs), wide=True).collect()}
    assert got == {1: docs[0][1], 2: ""}
    x = op3_lines.Lines([docs[0][1].encode()])
    ones = [int(((x.h >> np.uint64(k)) & np.uint64(1)).sum()) for k in range(64)]
    assert int(x.sim[0]) == sum(1 << k for k, n in enumerate(ones) if 2 * n > len(x.h))


def test_lines_of_nothing(make_docs):
    assert op3_lines.dedup(make_docs([])).count() == 0
    assert op3_lines.dedup(make_docs([(1, None), (2, "a")])).count() == 2


def test_blocks_cover_the_radius():
    for lines in (1, 1 << 30, 1 << 40):
        m = op3_lines.block_count(lines)
        assert m >= op3_lines.RADIUS + 2
        for places in itertools.combinations(range(m), op3_lines.RADIUS):
            assert any(not set(c) & set(places) for c in itertools.combinations(range(m), m - op3_lines.RADIUS))


def windows_hit(doc, items, n=10):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = word(doc), set(), set()
    for i, t in items:
        x = word(t)
        k = min(n, len(x))
        for p in range(len(x) - k + 1 if x else 0):
            for q in range(len(w) - k + 1):
                if w[q : q + k] == x[p : p + k]:
                    hit.update(range(q, q + k))
                    found.add(str(i))
    return len(w), len(hit), found


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_decontamination_equals_brute_force(spark, make_docs, block_bytes, monkeypatch):
    monkeypatch.setattr(op9_decontaminate, "SHARD_BYTES", 3000)
    rng = random.Random(1)
    items = [(i, " ".join(prose(rng, n))) for i, n in enumerate([30, 30, 12, 10, 4, 1])] + [(10, "ÉTÉ-été 12"), (11, ""), (12, None), (None, "lost"), (3, "x y")]
    items.append((20, items[0][1][5:]))
    docs = []
    for i in range(40):
        w = prose(rng, rng.choice([5, 60, 200]))
        if i % 3:
            t = rng.choice([t for _, t in items if t]).split()
            a = rng.randrange(len(t))
            p = rng.randrange(len(w))
            w[p:p] = t[a : a + rng.choice([3, 10, 40])]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w).title()))
    docs += [(90, None), (91, ""), (92, "été--ÉTÉ 12; Été été 12"), (92, "x. Y")]
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id bigint, text string, spans string")
    real = [(i, t) for i, t in items if i is not None]
    got = op9_decontaminate.find(make_docs(docs), bench, block_bytes=block_bytes).select("row.doc_id", "text", "n_words", F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["e"] - s["s"]).alias("n_hit"), "items")
    for r in got.collect():
        assert (r.n_words, r.n_hit, set(r["items"])) == windows_hit(r.text, real), r.doc_id
    kept = op9_decontaminate.decontaminate(make_docs(docs), bench)
    assert kept.columns == make_docs(docs).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, t in docs if not windows_hit(t, real)[1])


def test_decontamination_without_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    r = op9_decontaminate.scan(make_docs([(1, "a b")]), none).first()
    assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (2, 0, 0, False)
    assert r.items_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert op9_decontaminate.scan(make_docs([]), none).count() == 0


def test_documents(spark):
    docs, bench = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    got = {r.doc_id: r for r in op9_decontaminate.scan(docs, bench).collect()}
    for r in docs.where("length(text) < 1200").limit(40).collect():
        n, hit, found = windows_hit(r.text, items)
        assert (got[r.doc_id].n_words, got[r.doc_id].n_hit, got[r.doc_id].n_items) == (n, hit, len(found))
