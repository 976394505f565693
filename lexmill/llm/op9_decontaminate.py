"""Benchmark decontamination with training suffix arrays.

The documents of a partition are cut into shards of bounded size. Over the words of a shard a suffix array is built
(prefix doubling, so suffixes are ordered by their first ``DEPTH`` words). Every benchmark suffix is binary-searched in
it: the range of training suffixes that start with the same window gives the locations of all verbatim matches, and runs
of matches on one diagonal give the longest. Words are compared by a 64-bit hash and each match once more by a second,
independent one.

The benchmark is searched in blocks of bounded size: each block is one broadcast and one pass that updates the findings
carried beside the text, so nothing grows with the benchmark and no shuffle is needed. Documents never meet each other,
so hot keys and copies cost no more than other rows.

Defined results: a null text has no words and no hits; repeated rows give repeated results; an item of fewer words than
the window is one window; an item without words, or a null item id, matches nothing; extra columns are kept by
``decontaminate`` and left out by ``scan``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, pick, table
from .textnum import ALNUM, Words, batches_by_bytes

WINDOW = 10
#: Suffixes are ordered by so many words at least; a power of two that is no less than the window.
DEPTH = 16
#: Bytes of text in a shard, and of benchmark text in a block.
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20


class Block:
    """The windows of some benchmark items, each once, with the items that hold it."""

    def __init__(self, ids: list[str], texts: list[bytes], window: int):
        w = Words(texts, ALNUM)
        h1, h2 = w.hashes(), w.hashes(salt=1)
        rows, items = [], []
        for i in range(len(ids)):
            a, b = int(w.first[i]), int(w.first[i + 1])
            n = min(window, b - a)
            for p in range(a, b - n + 1 if n else a):
                rows.append((p, n))
                items.append(i)
        self.ids = ids
        self.n = len(rows)
        self.h1, self.h2 = np.zeros((self.n, window), np.uint64), np.zeros((self.n, window), np.uint64)
        self.size = np.array([n for _, n in rows], np.int64)
        for k in range(window):
            has = np.flatnonzero(self.size > k)
            at = np.array([rows[j][0] + k for j in has], np.int64)
            self.h1[has, k], self.h2[has, k] = h1[at], h2[at]
        # Equal windows are searched once.
        if self.n:
            key = np.concatenate([self.h1, self.h2, self.size[:, None].astype(np.uint64)], axis=1)
            _, first, back = np.unique(key, axis=0, return_index=True, return_inverse=True)
            back = back.reshape(-1)
            self.h1, self.h2, self.size = self.h1[first], self.h2[first], self.size[first]
            order = np.argsort(back, kind="stable")
            self.holder = np.asarray(items)[order]
            self.holders = np.concatenate(([0], np.cumsum(np.bincount(back, minlength=len(first)))))
            self.n = len(first)


def suffix_array(words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions ordered by their first ``depth`` words; and the distinct word hashes, whose index is a word's rank."""
    n = len(words)
    distinct, rank = np.unique(words, return_inverse=True)
    rank = rank.astype(np.int64).reshape(-1) + 1
    if n == 0:
        return np.zeros(0, np.int64), distinct
    k = 1
    sa = np.argsort(rank, kind="stable")
    while True:
        r = rank[sa]
        new = np.concatenate(([True], r[1:] != r[:-1]))
        if k >= depth or new.all():
            return sa, distinct
        # Only positions whose first k words are not unique are sorted again.
        group = np.cumsum(new) - 1
        tied = ~(new & np.concatenate((new[1:], [True])))
        pos = sa[tied]
        follow = np.where(pos + k < n, rank[np.minimum(pos + k, n - 1)], 0)
        order = np.lexsort((follow, group[tied]))
        sa[tied] = pos[order]
        g, f = group[tied][order], follow[order]
        fresh = np.concatenate(([True], (g[1:] != g[:-1]) | (f[1:] != f[:-1])))
        heads = new.copy()
        heads[tied] = fresh
        heads[~tied] = True
        ranks = np.maximum.accumulate(np.where(heads, np.arange(n) + 1, 0))
        rank = np.empty(n, np.int64)
        rank[sa] = ranks
        k *= 2


def search(words: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) of each occurrence of the block's windows among the words."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(words) or not block.n:
        return none
    sa, distinct = suffix_array(words, DEPTH)
    code = np.searchsorted(distinct, words).astype(np.int64) + 1
    at = np.searchsorted(distinct, block.h1)
    at = np.minimum(at, len(distinct) - 1)
    size = block.size
    used = np.arange(block.h1.shape[1])[None, :] < size[:, None]
    known = ((distinct[at] == block.h1) | ~used).all(axis=1)
    which = np.flatnonzero(known)
    if not len(which):
        return none
    want, size, used = at[which].astype(np.int64) + 1, size[which], used[which]
    n, m = len(words), len(which)

    def bound(after: bool) -> np.ndarray:
        """First place in the suffix array whose suffix is not below (or, after: is above) the window."""
        lo, hi = np.zeros(m, np.int64), np.full(m, n, np.int64)
        while (lo < hi).any():
            mid = (lo + hi) // 2
            pos = sa[np.minimum(mid, n - 1)]
            less, settled = np.zeros(m, bool), np.zeros(m, bool)
            for k in range(want.shape[1]):
                here = np.where(pos + k < n, code[np.minimum(pos + k, n - 1)], 0)
                open_ = ~settled & used[:, k]
                less |= open_ & (here < want[:, k])
                settled |= open_ & (here != want[:, k])
                if settled.all():
                    break
            if after:
                less |= ~settled
            move = lo < hi
            lo = np.where(move & less, mid + 1, lo)
            hi = np.where(move & ~less, mid, hi)
        return lo

    lo = bound(False)
    hi = bound(True)
    count = hi - lo
    got = np.repeat(np.arange(m), count)
    place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    return which[got], sa[place]


def _scan_shard(texts: list[bytes], block: Block, acc: list[tuple]) -> list[tuple]:
    """Per text: (words, intervals hit, items, longest match in words, its first word)."""
    w = Words(texts, ALNUM)
    per = np.diff(w.first)
    # A gap between texts is a word of its own that no window holds.
    gaps = w.first[1:] + np.arange(len(texts))
    words = np.zeros(len(w.start) + len(texts), np.uint64)
    real = np.ones(len(words), bool)
    real[gaps] = False
    words[real] = w.hashes()
    win, pos = search(words, block)
    doc_of = np.searchsorted(gaps, pos, side="right")
    if len(win):  # the second hash, word by word
        size = block.size[win]
        ok = np.ones(len(win), bool)
        inner = pos - doc_of
        for k in range(block.h2.shape[1]):
            has = np.flatnonzero(size > k)
            if len(has):
                ok[has] &= w.hashes(inner[has] + k, salt=1) == block.h2[win[has], k]
        win, pos, doc_of = win[ok], pos[ok], doc_of[ok]
    order = np.lexsort((pos, doc_of))
    win, pos, doc_of = win[order], pos[order], doc_of[order]
    cut = np.searchsorted(doc_of, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        a, b = int(cut[i]), int(cut[i + 1])
        spans, items, best, where = (list(acc[i][0]), set(acc[i][1]), acc[i][2], acc[i][3]) if acc[i] else ([], set(), 0, -1)
        if b > a:
            base = int(w.first[i]) + i
            seen = win[a:b]
            for x in np.unique(seen).tolist():
                items.update(block.ids[j] for j in block.holder[block.holders[x] : block.holders[x + 1]].tolist())
            p, size = pos[a:b] - base, block.size[seen]
            start, reach = int(p[0]), int(p[0] + size[0])
            for s, e in zip(p.tolist(), (p + size).tolist(), strict=True):
                if s > reach:
                    spans.append((start, reach))
                    start, reach = s, e
                reach = max(reach, e)
            spans.append((start, reach))
            spans = _merged(spans)
            for s, e in spans:
                if e - s > best:
                    best, where = e - s, s
        out.append((int(per[i]), spans, items, best, where))
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


_FOUND = "n_words bigint, spans array<struct<s: bigint, e: bigint>>, items array<string>, longest bigint, longest_at bigint"
_SPANS = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[tuple[list[str], list[bytes]]]:
    """The items in blocks of bounded size, read one partition at a time."""
    ids, texts, size = [], [], 0
    rows = benchmark.select(F.col(item).cast("string"), F.col(text).cast("string")).where(F.col(item).isNotNull() & F.col(text).isNotNull())
    for i, t in rows.toLocalIterator():
        raw = t.encode()
        if ids and size + len(raw) > block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(raw)
        size += len(raw)
    if ids:
        yield ids, texts


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs (with all its columns packed in ``row``) beside what the whole benchmark hits in each document."""
    spark = docs.sparkSession
    bound_batches(spark)
    at = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).cast("string").alias("text"))
    kind = at.schema["row"].dataType.simpleString()
    at = at.withColumns({"n_words": F.lit(0).cast("bigint"), "spans": F.lit(None).cast("array<struct<s: bigint, e: bigint>>"), "items": F.lit(None).cast("array<string>"), "longest": F.lit(0).cast("bigint"), "longest_at": F.lit(-1).cast("bigint")})
    schema = f"row {kind}, text string, {_FOUND}"
    blocks = 0
    for ids, texts in _blocks(benchmark, item, item_text, block_bytes):
        at = at.mapInArrow(_pass(spark.sparkContext.broadcast((ids, texts)), window), schema)
        blocks += 1
    if not blocks:
        at = at.mapInArrow(_pass(spark.sparkContext.broadcast(([], [])), window), schema)
    return at


def _pass(block, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = Block(*block.value, window)
        for b in batches:
            carried = [x if x[0] is not None else None for x in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), b.column(5).to_pylist(), b.column(6).to_pylist(), strict=True)]
            carried = [([(s["s"], s["e"]) for s in x[0]], x[1], x[2], x[3]) if x else None for x in carried]
            rows = [(c, (t.as_py() or "").encode("utf-8", "replace")) for c, t in zip(carried, b.column(1), strict=True)]
            found = [f for part in batches_by_bytes(rows, SHARD_BYTES) for f in _scan_shard([r[1] for r in part], tests, [r[0] for r in part])]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([[{"s": s, "e": e} for s, e in f[1]] for f in found], _SPANS),
                    pa.array([sorted(f[2]) for f in found], pa.list_(pa.string())),
                    pa.array([f[3] for f in found], pa.int64()),
                    pa.array([f[4] for f in found], pa.int64()),
                ],
                names=["row", "text", "n_words", "spans", "items", "longest", "longest_at"],
            )

    return run


def scan(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: words, words hit, the items found, and the longest stretch that is hit."""
    got = find(pick(docs, key, text), benchmark, text)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["e"] - s["s"])
    return got.select(
        F.col(f"row.`{key}`").alias(key),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "longest",
        "longest_at",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents no benchmark window occurs in, with their columns as they were."""
    return find(docs, benchmark, text).where(F.size("spans") == 0).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("longest", "longest_at")
