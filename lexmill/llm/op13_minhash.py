"""MinHash near-dedup of documents by fast similarity sketches, banding and exact verification.

A document's set holds its distinct three-word shingles, as 64-bit hashes. Documents with equal sets are one class, so
copies never meet. Different sets link when 100 * intersection >= 85 * union, confirmed on the full sets.

1. Sketch. T coordinates are filled in rounds. In round i < T each shingle is thrown into one hashed bin with the value
   i plus a hashed fraction, and a bin keeps its least value; in round T + j all shingles go to bin j. So after at most 2T
   rounds every coordinate is full, even for one shingle, while a set of many shingles needs one or two rounds: the cost is
   about n + T log T, not n * T. Coordinates of two sets agree with the probability of their similarity, and how many agree
   is as concentrated as for independent coordinates. Rounds end for a set when its bins are full.
2. Banding. ``BANDS`` bands of ``ROWS`` coordinates. A pair of similarity s meets in no band with probability
   (1 - s**ROWS) ** BANDS: 9e-7 at 0.85, less than 1e-11 at 0.9; that is the method's recall of a single link.
3. Hubs. In a band key of several classes one, that meets the most others over all keys, is the hub; the others are
   compared with it on full sets. Components of these links settle nearly all keys: those whose classes are then in one
   component need no more.
4. What is left, exactly. Two classes of a key share its hub h, and with it their known overlaps o with h. For a link
   they must share I = 17/37 (|x| + |y|) shingles; inside the hub they share at most the lesser o. Where that is less than I
   they must share shingles that h lacks, so they are sought in index lists of those (hub, shingle), of which only each
   set's rarest |extra| - q + 1 are kept, as q = .85 |x| - o of them must be shared. The few pairs where the hub alone may
   suffice (one is a little smaller, and nearly inside the hub) are compared directly. Pairs of one component are left out
   before lists are joined.
5. Comparison is exact; groups are connected components over all links.

So a group of thousands of near copies costs about its size, and no pair that meets in a band is dropped, whatever the
size of its key. Sets of the classes that meet others are staged once, packed; a hub's set is dealt out in parts to its
many partners, so no task gets them all.

Defined results: null and empty texts have an empty set and are groups of their own; a text of fewer than three words is
one shingle of all of them; texts of one id are one document with the links of all of them (but an empty one stays alone); a null id has no group, links nothing and is kept; extra columns are ignored by ``join`` and kept
by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Stage, bound_batches, table
from .graph import components
from .textnum import SPACED, Words, batches_by_bytes, mix

SHINGLE, LINK = 3, 85
ROWS, BANDS = 7, 36
T = ROWS * BANDS
PART_BYTES = 1 << 19
#: Sets that are sketched at once.
SKETCHED = 512
#: Sets of at most so many shingles link with equal ones alone: less than 6 of 7 is too little.
ALONE = 5
#: Partners of a hub that one copy of its set serves.
SERVED = 256
#: Steps of size, as a logarithm, that partners are joined by.
SIZE_STEP = 0.02
#: Documents whose ids may be broadcast to fetch texts; more are joined by shuffle.
BROADCAST_ROWS = 400_000
#: Texts of which a task knows that it has sketched them.
KNOWN = 200_000

_C = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_ROUND, _ROW = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


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


def sketches(sets: list[np.ndarray], t: int = T) -> np.ndarray:
    """One row of t values for each set, all of which hold something. The upper ten bits of a value are its round."""
    if 2 * t > 1 << 10:
        raise ValueError("rounds don't fit ten bits")
    empty = np.uint64(2**64 - 1)
    out = np.full(len(sets) * t, empty, np.uint64)
    items = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for i in range(2 * t):
        if not len(items):
            break
        h = mix(items + np.uint64((i + 1) * int(_ROUND) % (1 << 64)))
        value = (np.uint64(i) << np.uint64(54)) | (h >> np.uint64(10))
        # The fraction has its own bits; the bin comes from another mixing of the same throw.
        place = row * t + ((mix(h ^ _ROW) % np.uint64(t)).astype(np.int64) if i < t else i - t)
        np.minimum.at(out, place, value)
        if i < 2 or i % 8 == 0 or i >= t:
            open_ = (out.reshape(len(sets), t) == empty).any(axis=1)[row]
            items, row = items[open_], row[open_]
    return out.reshape(len(sets), t)


def bands(sketch: np.ndarray) -> np.ndarray:
    """The key of each band of each sketch."""
    powers = np.array([pow(int(_ROW), k + 1, 1 << 64) for k in range(ROWS)], np.uint64)
    x = (mix(sketch).reshape(-1, BANDS, ROWS) * powers).sum(axis=2, dtype=np.uint64)
    return mix(x + np.arange(1, BANDS + 1, dtype=np.uint64) * _ROUND)


def _texts(b: pa.RecordBatch, at: int) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace") for t in b.column(at).to_pylist()]


def _lists(rows: list[np.ndarray | None]) -> pa.ListArray:
    held = [r for r in rows if r is not None]
    ends = np.cumsum([0, *(0 if r is None else len(r) for r in rows)]).astype(np.int32)
    values = pa.array(np.concatenate(held) if held else np.zeros(0, np.int64))
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array([r is None for r in rows]))


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, n, sig, keys) of each row; keys only where the task sees a class for the first time."""
    known: set[int] = set()
    for b in batches:
        n, sig, keys = [], [], []
        for part in batches_by_bytes([(t,) for t in _texts(b, 1)], PART_BYTES):
            sets = shingle_sets([p[0] for p in part])
            signed = [signature(s) for s in sets]
            new = []
            for i, (g, s) in enumerate(zip(signed, sets, strict=True)):
                if len(s) > ALONE and g not in known:
                    new.append(i)
                    if len(known) >= KNOWN:
                        known.clear()
                    known.add(g)
            mine = {}
            for j in range(0, len(new), SKETCHED):
                some = new[j : j + SKETCHED]
                mine |= zip(some, bands(sketches([sets[i] for i in some])).astype(np.int64), strict=True)
            n += [len(s) for s in sets]
            sig += signed
            keys += [mine.get(i) for i in range(len(sets))]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.int64()), _lists(keys)], names=["doc", "n", "sig", "keys"])


def _packed(docs: DataFrame, need: DataFrame, few: bool) -> DataFrame:
    """(sig, s: the packed set) of each needed class (sig, first), from its first document."""
    rows = docs.join(F.broadcast(need) if few else need, docs["doc"] == need["first"]).select("sig", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:  # rows that share an id with the first have another set
            got = []
            for part in batches_by_bytes(list(zip(b.column(0).to_pylist(), _texts(b, 1), strict=True)), PART_BYTES):
                got += [(g, s.tobytes()) for (g, _), s in zip(part, shingle_sets([p[1] for p in part]), strict=True) if signature(s) == g]
            yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in got], pa.int64()), pa.array([s for _, s in got], pa.binary())], names=["sig", "s"])

    return rows.mapInArrow(run, "sig bigint, s binary").dropDuplicates(["sig"])


def _compare(beyond: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the pairs (a, b, set of a, set of b): the overlap, whether they link, and what b has that a lacks."""
        last: tuple = (None, None)
        for batch in batches:
            overlap, link, rest = [], [], []
            for x, s, t in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if x != last[0]:
                    last = (x, np.frombuffer(s.as_py(), np.uint64))
                s, t = last[1], np.frombuffer(t.as_py(), np.uint64)
                held = s[np.minimum(np.searchsorted(s, t), len(s) - 1)] == t
                both = int(held.sum())
                overlap.append(both)
                link.append(100 * both >= LINK * (len(s) + len(t) - both))
                rest.append(t[~held].tobytes() if beyond else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(overlap, pa.int64()), pa.array(link, pa.bool_()), pa.array(rest, pa.binary())], names=["a", "b", "o", "link", "rest"])

    return run


def _compared(pairs: DataFrame, sets: DataFrame, label: str, beyond: bool = False) -> Stage:
    """pairs (a, b) with their sets: a's, of which there may be many partners, is dealt out in parts."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / SERVED).cast("int").alias("parts"))
    dealt = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")).drop("parts")
    hubs = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    hubs = hubs.join(sets.select(F.col("sig").alias("a"), F.col("s").alias("s_a")), "a")
    both = dealt.join(sets.select(F.col("sig").alias("b"), F.col("s").alias("s_b")), "b").join(hubs, ["a", "part"])
    return Stage(both.select("a", "b", "s_a", "s_b").mapInArrow(_compare(beyond), "a bigint, b bigint, o bigint, link boolean, rest binary"), label)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hub, sig, tok) of packed rest sets, in bounded batches."""
    for b in batches:
        for h, g, raw in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            t = np.frombuffer(raw, np.int64)
            for i in range(0, len(t), 1 << 16):
                part = t[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), h)), pa.array(np.full(len(part), g)), pa.array(part)], names=["hub", "sig", "tok"])


def _fits(a: str = "n_a", b: str = "n_b") -> str:
    return f"100 * least({a}, {b}) >= {LINK} * greatest({a}, {b})"


#: 100 I >= 85 (n_a + n_b - I): what two sets must share.
SHARE = 100 + LINK


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc, n, sig) of each row; and (sig, component, copies, linked) of each class with an id."""
    bound_batches(docs.sparkSession)
    src = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text"))
    survey = Stage(src.mapInArrow(_survey, "doc bigint, n bigint, sig bigint, keys array<bigint>"), "minhash-survey")
    rows = survey.df.select("doc", "n", "sig")
    classes = Stage(rows.where("doc is not null and n > 0").groupBy("sig").agg(F.min("doc").alias("first"), F.first("n").alias("n"), F.count("*").alias("copies")), "minhash-classes").df

    # A task keys a class once, but several tasks may; and rows without an id key nothing.
    keyed = survey.df.where("keys is not null").select("sig", F.explode("keys").alias("band"))
    several = keyed.groupBy("band").agg(F.min("sig").alias("least"), F.max("sig").alias("last")).where("least <> last").select("band")
    meets = keyed.join(several, "band").distinct().join(classes.select("sig", "n"), "sig")
    met = Stage(meets, "minhash-met")
    size = met.df.groupBy("band").agg(F.count("*").alias("size"))
    score = met.df.join(size, "band").groupBy("sig").agg(F.sum("size").alias("score"))
    hubs = met.df.join(score, "sig").groupBy("band").agg(F.max(F.struct("score", "sig")).alias("h")).select("band", F.col("h.sig").alias("a"))
    nears = met.df.join(hubs, "band").where("a <> sig").select("a", F.col("sig").alias("b"), F.col("n").alias("n_b")).distinct()
    near = Stage(nears, "minhash-pairs")
    need = Stage(met.df.select("sig").distinct().join(classes, "sig").select("sig", "first"), "minhash-need")
    few = need.df.count() <= BROADCAST_ROWS
    sets = Stage(_packed(src, need.df, few), "minhash-sets")
    compared = _compared(near.df.select("a", "b"), sets.df, "minhash-compared", beyond=True)
    links = compared.df.where("link").select("a", "b")
    of = Stage(components(links, "minhash-components").select(F.col("id").alias("sig"), "component"), "minhash-groups")

    # Hubs whose classes are in several components; the hub itself is one of its classes, with all of itself shared.
    n_of = lambda x: classes.select(F.col("sig").alias(x), F.col("n").alias(f"n_{x}"))
    held = compared.df.select(F.col("a").alias("hub"), F.col("b").alias("sig"), "o", "link")
    own = held.select("hub").distinct().join(classes.select(F.col("sig").alias("hub"), F.col("n").alias("o")), "hub").select("hub", F.col("hub").alias("sig"), "o", F.lit(True).alias("link"))
    member = held.unionByName(own).join(of.df, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    mixed = member.groupBy("hub").agg(F.min("component").alias("least"), F.max("component").alias("last")).where("least <> last").select("hub")
    members = Stage(member.join(mixed, "hub").join(classes.select("sig", "n"), "sig").select("hub", "sig", "o", "link", "component", "n"), "minhash-members")
    side = lambda df, x: df.select("hub", *(F.col(c).alias(x if c == "sig" else f"{c}_{x}") for c in df.columns if c not in ("hub", "tok", "part")), *(c for c in df.columns if c in ("tok", "part")))

    # Pairs that may link by what they share inside the hub alone. One of a pair is not linked with the hub, or both
    # were in one component.
    may = f"{SHARE} * least(o_a, o_b) >= {LINK} * (n_a + n_b)"
    # Of classes of one overlap and size, any that is not linked with the hub needs a partner that shares enough: its own
    # overlap must reach what it and the least partner, .85 of its size, would have to share.
    loose = members.df.where("not link").where(f"{SHARE} * o >= {LINK} * (n + n * {LINK} / 100)")
    # So partners have sizes from .85 of its own to what its overlap allows: they are joined by steps of size.
    step = lambda size, slack: F.floor(F.log(size) / SIZE_STEP + slack).cast("int")
    apart = loose.withColumn("part", F.explode(F.sequence(step(F.col("n") * LINK / 100, -1e-9), step(F.col("o") * SHARE / LINK - F.col("n"), 1e-9))))
    others = members.df.withColumn("part", step(F.col("n"), 0.0))
    inside = side(apart, "a").join(side(others, "b"), ["hub", "part"]).where("component_a <> component_b and (link_b or a < b)").where(_fits()).where(may).select("a", "b")

    # Pairs that must share something the hub lacks.
    rest = compared.df.join(mixed.withColumnRenamed("hub", "a"), "a").where("length(rest) > 0").select(F.col("a").alias("hub"), F.col("b").alias("sig"), "rest")
    extra = Stage(rest.mapInArrow(_unpack, "hub bigint, sig bigint, tok bigint"), "minhash-extra")
    count = extra.df.groupBy("hub", "tok").agg(F.count("*").alias("df")).where("df > 1")
    shared = extra.df.join(count, ["hub", "tok"])
    placed = shared.withColumn("place", F.row_number().over(Window.partitionBy("hub", "sig").orderBy("df", "tok"))).withColumn("among", F.count("*").over(Window.partitionBy("hub", "sig")))
    # extra shingles: n - o, of which n - o - among are in this set alone and so the rarest.
    first = f"(n - o - among) + place <= (n - o) - greatest(ceil(n * {LINK} / 100) - o, 1) + 1"
    listed = placed.join(members.df, ["hub", "sig"]).where(first).select("hub", "tok", "sig", "o", "link", "component", "n")
    lists = Stage(listed, "minhash-lists")
    still = lists.df.groupBy("hub", "tok").agg(F.min("component").alias("least"), F.max("component").alias("last")).where("least <> last").select("hub", "tok")
    left = lists.df.join(still, ["hub", "tok"])
    beyond = side(left.where("not link"), "a").join(side(left, "b"), ["hub", "tok"]).where("component_a <> component_b and (link_b or a < b)").where(_fits()).where(f"not ({may})").select("a", "b")

    pairs = inside.unionByName(beyond).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    tried = compared.df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second = Stage(pairs.join(tried, ["a", "b"], "left_anti"), "minhash-pairs")
    again = _compared(second.df, sets.df, "minhash-compared")
    twice = rows.where("doc is not null and n > 0").groupBy("doc").agg(F.min("sig").alias("a"), F.max("sig").alias("last")).where("a <> last").select("doc", "a")
    same = rows.where("n > 0").join(twice, "doc").select("a", F.col("sig").alias("b"))
    found = Stage(components(links.unionByName(again.df.where("link").select("a", "b")).unionByName(same), "minhash-components").select(F.col("id").alias("sig"), "component"), "minhash-groups").df
    least = found.join(classes, "sig").groupBy("component").agg(F.min("first").alias("least"))
    named = found.join(least, "component").select("sig", "least")
    named = classes.join(named, "sig", "left").select("sig", F.coalesce("least", "first").alias("component"), "copies", F.col("least").isNotNull().alias("linked"))
    for s in (met, near, need, sets, compared, of, members, extra, lists, second, again):
        s.drop()
    return rows, named


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of each row."""
    rows, named = groups(docs, key, text)
    # Only classes that name another document matter, so the join's one side is small where few texts repeat.
    named = named.where("copies > 1 or linked").select("sig", "component")
    own = F.when(F.col("n") > 0, F.coalesce("component", "doc")).otherwise(F.col("doc"))
    got = rows.join(named, "sig", "left").select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("doc").isNotNull(), own).alias("component_id"))
    return got.withColumn("kept", F.col("component_id").eqNullSafe(F.col(key)))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, the one of least id; documents without an id stay."""
    gone = join(docs, key, text).groupBy(F.col(key).alias("k")).agg(F.min("component_id").alias("c")).where("k <> c").select("k")
    gone = gone.toDF(_free("gone", docs.columns))
    return docs.join(gone, docs[key].cast("bigint") == gone[gone.columns[0]], "left_anti")


def _free(name: str, taken: list[str]) -> str:
    """A column name that is not taken, whatever its case."""
    have = {t.lower() for t in taken}
    while name.lower() in have:
        name += "_"
    return name


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
