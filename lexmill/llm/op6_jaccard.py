"""N-gram Jaccard join of documents with set-relation skipping.

A document's set holds its distinct five-word shingles, as 64-bit hashes. Documents with equal sets are one class, so
copies never meet. Different sets link when 100 * intersection >= 80 * union.

1. One pass makes the classes' signatures and a count sketch of shingles (of fixed width; one small array a task).
2. Shingles are ordered by that count and hash, rare first. Sets that link share a shingle among their first
   ``n - ceil(0.8 n) + 1``, so only those are indexed: postings of shingle, class, set size and position, packed by bucket
   of shingles. Index lists of one class are dropped at once, which are most.
3. Skipping by answers. The class of a list that meets most others is its hub, and the other classes of the list are
   first compared with the hub alone. What a hub's answer holds is one group; lists whose classes are all in one group
   need no more work.
4. Answers from a similar set's. A hub that holds most of a class, and of most others, is its home. Two classes of one home can share no
   more than the lesser of their overlaps with it and what both have beyond it; so their pairs are not sought in the
   home's own lists but in lists of what each has beyond the home, which are short, and are counted exactly there.
5. Skipping by position. From the lists that still hold several groups, other pairs of different groups come with the
   number of prefix shingles they share. Past both prefixes at most the larger rest can be shared, so pairs whose count
   cannot reach the threshold are skipped; the others are compared, if they were not before.
6. Comparison is exact on whole texts. Groups are connected components.

Every linked pair is compared, or inside one group by other links, or skipped by a bound that no linked pair misses; so
the components are those of all links. A group of thousands of near copies costs about its size, not its square.

Defined results: null and empty texts have an empty set and are groups of their own; a null id has no group and links
nothing; rows of one id count as one document with the links of all of them; extra columns are ignored by ``join`` and
kept by ``dedup``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Stage, bound_batches, table
from .graph import components
from .textnum import SPACED, Words, batches_by_bytes, mix

SHINGLE = 5
PART_BYTES = 2 << 20
#: Bits of a sketch cell's number, and cells in a row of the staged sketch.
SKETCH_BITS = 22
CHUNK = 1 << 16
#: Postings in a bucket, about; lists with more are dealt to several buckets.
BUCKET = 500_000
#: Per cent of a set that its hub must hold to be its home.
HOME = 50
#: A class is compared with a hub if they share one in so many of its prefix's shingles.
STAR = 16
#: Homes of a class at most; more would only skip more.
HOMES = 4
#: Documents whose ids may be broadcast to fetch texts; more are joined by shuffle.
BROADCAST_ROWS = 400_000

_C = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = Words(texts, SPACED)
    h = w.hashes()
    n = max(0, len(h) - SHINGLE + 1)
    rolled = np.zeros(n, np.uint64)
    for k, c in enumerate(_C):
        rolled += h[k : k + n] * c
    rolled = mix(rolled)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a : b - SHINGLE + 1]))
        elif b > a:
            few = (h[a:b] * np.array(_C[: b - a], np.uint64)).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(few + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(s: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    return int((mix(mix(s).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s))))[0].astype(np.int64))


def prefix(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1


def _texts(b: pa.RecordBatch, at: int) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace") for t in b.column(at).to_pylist()]


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents, and at the end the task's sketch."""
    names = ["doc", "n", "sig", "chunk", "counts"]
    cells = np.zeros(1 << SKETCH_BITS, np.uint32)
    for b in batches:
        ids, n, sig = b.column(0), [], []
        for part in batches_by_bytes([(t,) for t in _texts(b, 1)], PART_BYTES):
            for s in shingle_sets([p[0] for p in part]):
                n.append(len(s))
                sig.append(signature(s))
                np.add.at(cells, s >> np.uint64(64 - SKETCH_BITS), np.uint32(1))
        yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names=names)
    for c in range(0, len(cells), CHUNK):
        if cells[c : c + CHUNK].any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([c // CHUNK], pa.int32()), pa.array([cells[c : c + CHUNK].tobytes()], pa.binary())], names=names)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums sketch rows as they stream by; holds one row for each chunk."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for c, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            x = np.frombuffer(raw, np.uint32)
            if c not in total:
                total[c] = np.zeros(CHUNK, np.uint64)
            total[c] += x
    rows = [(c, np.minimum(x, np.uint64(2**32 - 1)).astype(np.uint32).tobytes()) for c, x in total.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["chunk", "counts"])


def _postings(levels, buckets: int, most: int):
    """Packed postings of the prefixes, for classes the task has not met before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = levels.value, set()
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            tok, sig, n, count = (np.concatenate([h[i] for h in held]) for i in range(4))
            # A list too long for a bucket is dealt by class as well; such buckets are numbered past the others.
            parts = np.maximum(1, np.ceil(count / most)).astype(np.uint64)
            bucket = (mix(tok) % np.uint64(buckets)).astype(np.int64)
            long = parts > 1
            if long.any():
                share = mix(sig[long].astype(np.uint64)) % parts[long]
                bucket[long] = buckets + (mix(tok[long] + share * np.uint64(7919)) % np.uint64(1 << 30)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, tok, sig, n = bucket[order], tok[order], sig[order], n[order]
            cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
            spans = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]], pa.int64()), *(pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()) for x in (tok, sig, n))], names=["bucket", "tok", "sig", "size"])
            held, size = [], 0

        for b in batches:
            for part in batches_by_bytes([(t,) for t in _texts(b, 1)], PART_BYTES):
                for s in shingle_sets([p[0] for p in part]):
                    n = len(s)
                    if n < 4:  # smaller sets link only with equal ones
                        continue
                    g = signature(s)
                    if g in seen:
                        continue
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(g)
                    lv = level[s >> np.uint64(64 - SKETCH_BITS)]
                    first = np.lexsort((s, lv))[: prefix(n)]
                    k = len(first)
                    held.append((s[first], np.full(k, g, np.int64), np.full(k, n, np.int32), np.exp2(lv[first] / 8.0)))
                    size += k
                if size > 600_000:
                    yield from flush()
        if held:
            yield from flush()

    return run


def _lists(buckets: int):
    """Index lists of several classes, from packed postings sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            tok, sig, n = (np.concatenate([np.frombuffer(h[i], t) for h in held]) for i, t in enumerate((np.uint64, np.int64, np.int32)))
            order = np.lexsort((sig, tok))
            tok, sig, n = tok[order], sig[order], n[order]
            new = np.concatenate(([True], (tok[1:] != tok[:-1]) | (sig[1:] != sig[:-1])))
            tok, sig, n = tok[new], sig[new], n[new]
            if now < buckets:
                same = tok[1:] == tok[:-1]
                several = np.concatenate((same, [False])) | np.concatenate(([False], same))
                tok, sig, n = tok[several], sig[several], n[several]
            first = np.flatnonzero(np.concatenate(([True], tok[1:] != tok[:-1]))) if len(tok) else np.zeros(0, np.int64)
            count = np.diff(np.concatenate((first, [len(tok)])))
            df = np.repeat(count, count)
            for i in range(0, len(tok), 100_000):
                j = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(tok[j].astype(np.int64)), pa.array(sig[j]), pa.array(n[j]), pa.array(df[j])], names=["tok", "sig", "size", "df"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[0] != now and held:
                    yield from out()
                    held = []
                now = row[0]
                held.append(row[1:])
        if held:
            yield from out()

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the pairs (a, b, text_a, text_b): the overlap, whether they link, and what b has beyond a if that is not much."""
    kept: dict[int, np.ndarray] = {}  # hubs repeat from row to row
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        new = {}
        for ids, at in ((a, 2), (b, 3)):
            for g, t in zip(ids, batch.column(at), strict=True):
                if g not in kept and g not in new:
                    new[g] = (t.as_py() or "").encode("utf-8", "replace")
        sets = dict(kept)
        for part in batches_by_bytes(list(new.items()), PART_BYTES):
            sets.update(zip((p[0] for p in part), shingle_sets([p[1] for p in part]), strict=True))
        overlap, link, beyond = [], [], []
        for x, y in zip(a, b, strict=True):
            s, t = sets[x], sets[y]
            at = np.searchsorted(s, t)
            held = s[np.minimum(at, len(s) - 1)] == t
            both = int(held.sum())
            overlap.append(both)
            link.append(100 * both >= 80 * (len(s) + len(t) - both))
            beyond.append(t[~held].astype(np.int64).tolist() if 100 * both >= HOME * len(t) else None)
        kept = {x: sets[x] for x in a[-8:]}
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(overlap, pa.int64()), pa.array(link, pa.bool_()), pa.array(beyond, pa.list_(pa.int64()))], names=["a", "b", "o", "link", "beyond"])


def _linked(pairs: Stage, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs of classes, compared on their representatives' texts."""
    ids = pairs.df.select(F.col("a").alias("sig")).unionByName(pairs.df.select(F.col("b").alias("sig"))).distinct()
    need = Stage(ids.join(classes, "sig").select("sig", "first"), "jaccard-need")
    few = need.df.count() <= BROADCAST_ROWS
    rows = docs.join(F.broadcast(need.df) if few else need.df, docs["doc"] == need.df["first"]).select("sig", "text")

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:  # rows that share an id with the representative have another set
            want, texts = b.column(0).to_pylist(), _texts(b, 1)
            ok = [signature(s) == g for part in batches_by_bytes(list(zip(want, texts, strict=True)), PART_BYTES) for (g, _), s in zip(part, shingle_sets([p[1] for p in part]), strict=True)]
            yield b.filter(pa.array(ok, pa.bool_()))

    texts = Stage(rows.mapInArrow(same, "sig bigint, text string").dropDuplicates(["sig"]), "jaccard-texts")
    side = lambda x: texts.df.select(F.col("sig").alias(x), F.col("text").alias(f"text_{x}"))
    both = pairs.df.select("a", "b").join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
    out = Stage(both.mapInArrow(_compare, "a bigint, b bigint, o bigint, link boolean, beyond array<bigint>"), "jaccard-compared")
    need.drop()
    texts.drop()
    return out.df


def _ordered(pairs: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b) with the lesser class first."""
    turn = F.col("a") > F.col("b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(turn, F.col("n_b")).otherwise(F.col("n_a")).alias("n_a"), F.when(turn, F.col("n_a")).otherwise(F.col("n_b")).alias("n_b"))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc, n, sig) of each row; and (sig, component: least id of the group) of each class with an id."""
    spark = docs.sparkSession
    bound_batches(spark)
    src = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text"))
    seen = Stage(src.mapInArrow(_survey, "doc bigint, n bigint, sig bigint, chunk int, counts binary"), "jaccard-survey")
    rows = seen.df.where("chunk is null").select("doc", "n", "sig")
    sums = seen.df.where("chunk is not null").select("chunk", "counts").mapInArrow(_summed, "chunk int, counts binary")
    cells = np.zeros(1 << SKETCH_BITS, np.uint32)
    # One array of fixed width, in rows of CHUNK cells.
    for r in sums.repartition("chunk").mapInArrow(_summed, "chunk int, counts binary").toLocalIterator():
        cells[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = np.frombuffer(r.counts, np.uint32)
    levels = spark.sparkContext.broadcast(np.minimum(255, np.rint(8 * np.log2(cells + 1.0))).astype(np.uint8))
    total = rows.agg(F.sum("n")).first()[0] or 0
    classes = Stage(rows.where("doc is not null and n > 0").groupBy("sig").agg(F.min("doc").alias("first"), F.first("n").alias("n"), F.count("*").alias("copies")), "jaccard-classes").df

    buckets = max(64, math.ceil(0.2 * total / BUCKET))
    packed = src.where("doc is not null and text is not null").mapInArrow(_postings(levels, buckets, BUCKET), "bucket bigint, tok binary, sig binary, size binary")
    index = Stage(packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_lists(buckets), "tok bigint, sig bigint, size int, df bigint"), "jaccard-index")
    lists = index.df

    # Hubs: the class of a list that meets most others in all its lists. Where texts were copied with changes that is
    # the one nearest to all of them.
    score = lists.groupBy("sig").agg(F.sum("df").alias("score"))
    hubs = lists.join(score, "sig").groupBy("tok").agg(F.max(F.struct("score", "sig")).alias("most")).select("tok", F.col("most.sig").alias("hub"))
    hubs = Stage(hubs, "jaccard-hubs").df
    size = lambda x: classes.select(F.col("sig").alias(x), F.col("n").alias(f"n_{x}"))
    fits = "5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)"
    pre = lambda n: f"({n} - (4 * {n} + 4) div 5 + 1)"
    near = lists.join(hubs, "tok").where("sig <> hub").groupBy(F.col("hub").alias("a"), F.col("sig").alias("b")).agg(F.count("*").alias("c"), F.first("size").cast("bigint").alias("n_b"))
    # Unpromising ones are left to the last step, which is exact.
    near = near.join(size("a"), "a").where(fits).where(f"{STAR} * c >= {pre('least(n_a, n_b)')}")
    first = Stage(near.select("a", "b"), "jaccard-pairs")
    compared = _linked(first, classes, src)
    links = compared.where("link").select("a", "b")
    of = Stage(components(links, "jaccard-components").select(F.col("id").alias("sig"), "component"), "jaccard-groups").df

    # The homes of a class: of the hubs that hold most of it, the few that are so to most classes; a hub is one to itself.
    found = compared.where("beyond is not null").select(F.col("b").alias("sig"), F.col("a").alias("home"), "o")
    popular = found.groupBy("home").agg(F.count("*").alias("to"))
    found = found.unionByName(popular.join(classes.select(F.col("sig").alias("home"), F.col("n").alias("o")), "home").select(F.col("home").alias("sig"), "home", "o"))
    place = F.row_number().over(Window.partitionBy("sig").orderBy(F.desc("to"), "home"))
    housed = Stage(found.join(popular, "home").withColumn("place", place).where(F.col("place") <= HOMES).select("sig", "home", "o", "place"), "jaccard-homes").df
    homes = housed.groupBy("sig").agg(F.array_sort(F.collect_list(F.struct("place", "home", "o"))).alias("homes"))

    # Lists that still hold several groups.
    placed = lists.select("tok", "sig", "size").join(of, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    mixed = placed.groupBy("tok").agg(F.min("component").alias("least"), F.max("component").alias("last")).where("least <> last").select("tok")
    main = mixed.join(hubs, "tok").join(of.withColumnRenamed("sig", "hub"), "hub", "left").select("tok", F.coalesce("component", "hub").alias("main"))
    members = Stage(placed.join(main, "tok").join(homes, "sig", "left").select("tok", "sig", F.col("size").cast("bigint").alias("n"), "component", "main", F.col("homes")[0]["home"].alias("home"), F.col("homes")[0]["o"].alias("o"), "homes"), "jaccard-mixed")
    named = lambda df, x: df.select(*[F.col(c).alias(f"{c}_{x}") if c in ("n", "component", "home", "o", "homes") else F.col(c).alias(x) if c == "sig" else F.col(c) for c in df.columns])
    a = named(members.df.where("component <> main").drop("main"), "a")
    b = named(members.df, "b")
    once = "component_a <> component_b and (component_b = main or a < b)"
    # Two classes of one home that link share more than their overlaps with it, or something beyond it.
    short = "{0}.home = {1}.home and 9 * least({0}.o, {1}.o) < 4 * (n_a + n_b)"
    beyond = "coalesce(home_a = home_b and 9 * least(o_a, o_b) < 4 * (n_a + n_b), false) or coalesce(exists(homes_a, u -> exists(homes_b, v -> " + short.format("u", "v") + ")), false)"
    apart = a.join(b, "tok").where(once).where(fits).where(f"not ({beyond})")
    counted = _ordered(apart).groupBy("a", "b").agg(F.count("*").alias("c"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"))
    # Past the prefixes at most the larger rest is shared; 9 * intersection >= 4 * (n_a + n_b) is the threshold.
    rest = f"greatest(n_a - {pre('n_a')}, n_b - {pre('n_b')})"
    counted = counted.where(f"9 * (c + {rest}) >= 4 * (n_a + n_b)").select("a", "b")

    # Classes of one home by what they have beyond it, if the home still has several groups.
    housed = housed.join(of, "sig", "left").withColumn("component", F.coalesce("component", "sig")).join(classes.select("sig", "n"), "sig").drop("place")
    split = housed.groupBy("home").agg(F.min("component").alias("least"), F.max("component").alias("last")).where("least <> last").select("home")
    split = split.join(of.withColumnRenamed("sig", "home"), "home", "left").select("home", F.coalesce("component", "home").alias("main"))
    extra = compared.where("size(beyond) > 0").select(F.col("b").alias("sig"), F.col("a").alias("home"), F.explode("beyond").alias("tok"))
    extra = Stage(extra.join(housed, ["sig", "home"]).join(split, "home").select("home", "tok", "sig", "n", "component", "main", "o"), "jaccard-beyond")
    a = named(extra.df.where("component <> main").drop("main"), "a").withColumnRenamed("home_a", "home")
    b = named(extra.df, "b").withColumnRenamed("home_b", "home")
    shared = a.join(b, ["home", "tok"]).where(once).where(fits)
    shared = shared.groupBy("a", "b").agg(F.count("*").alias("c"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"), F.first("o_a").alias("o_a"), F.first("o_b").alias("o_b"))
    shared = shared.where("9 * (c + least(o_a, o_b)) >= 4 * (n_a + n_b)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    tried = compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second = Stage(counted.unionByName(shared).distinct().join(tried, ["a", "b"], "left_anti"), "jaccard-pairs")
    more = _linked(second, classes, src).where("link").select("a", "b")
    of = Stage(components(links.unionByName(more), "jaccard-components").select(F.col("id").alias("sig"), "component"), "jaccard-groups").df
    least = of.join(classes, "sig").groupBy("component").agg(F.min("first").alias("least"))
    named = of.join(least, "component").select("sig", "least")
    named = classes.join(named, "sig", "left").select("sig", F.coalesce("least", "first").alias("component"), "copies", F.col("least").isNotNull().alias("linked"))
    for s in (index, members, extra, first, second):
        s.drop()
    return rows, named


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) of each row."""
    rows, named = groups(docs, key, text)
    # Only classes that name another document matter, so the join's one side is small where few texts repeat.
    named = named.where("copies > 1 or linked").select("sig", "component")
    own = F.when(F.col("n") > 0, F.coalesce("component", "doc")).otherwise(F.col("doc"))
    return rows.join(named, "sig", "left").select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("doc").isNotNull(), own).alias("component_id"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, the one of least id; documents without an id stay."""
    gone = join(docs, key, text).groupBy(F.col(key).alias("k")).agg(F.min("component_id").alias("c")).where("k <> c")
    mark = "gone"
    while mark in {c.lower() for c in docs.columns}:
        mark += "_"
    gone = gone.select(F.col("k").alias(mark))
    return docs.join(gone, docs[key].cast("bigint") == gone[mark], "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
