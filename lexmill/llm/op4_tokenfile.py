"""Token-id output: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

1. Texts are encoded once; the ids are staged in the shared folder.
2. Ids are counted over all documents (at most one count for each vocabulary entry reaches the driver) and ranked, the
   commonest first, so that common ids take one byte.
3. Each document is coded: two bits of a control byte tell how many bytes (1 to 4) an id's rank takes; four ids share a
   control byte; control bytes and data bytes are kept apart.
4. Documents are dealt to ranges of doc_id, sorted there, and written as blocks of bounded size, so that the parts of the
   file lie in ascending order. A block is a row of a Parquet file, so any file system that Spark reaches will do:
   ``bucket``, ``seq``, ``start`` (tokens before it in its bucket), ``doc_ids``, ``counts``, ``control``, ``data``. Beside
   the blocks lies ``index``: the id of each rank, and the tokens before each bucket. The folder is all that reading needs.
5. Reading decodes whole blocks with numpy: control bytes index a table of lengths, offsets are their running sum.

Null and empty texts hold the end id alone. Null ids come first. Rows of one id lie together; an id or null that has more
rows than a range holds is dealt to several ranges by a checksum of what is coded, and in a range they keep an order by
their coded bytes. An empty table gives a file without blocks. Extra columns are left out.
"""

from __future__ import annotations

import math
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stage, bound_batches, pick, shared_dir, table
from .op2_bpe import byte_chars

END_ID = 2
#: Tokens in a block and (about) in a range of doc_id; ranges at most.
BLOCK_TOKENS = 1 << 19
BUCKET_TOKENS = 1 << 23
MOST_BUCKETS = 4096
#: Pieces whose ids a worker keeps in each of two generations.
KEPT = 500_000
#: Plain texts, and how the library cuts them: every character of U+00F8 to U+024F is a letter.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-ɏ]*")
CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+| ?[0-9²³¹¼-¾]+| ?[^\sA-Za-zªµºÀ-ÖØ-öø-ɏ0-9²³¹¼-¾]+|\s+(?!\S)|\s+")

#: Bytes of each of the four numbers that a control byte describes.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)


class CachedEncoder:
    """The library's encoder; pieces of plain texts are cut here, and a bounded table keeps their ids.

    The table has two generations: when the younger is full, the older goes. Ids come in the given type of array.
    """

    def __init__(self, path: str, kind: str = "I"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.kind = Tokenizer.from_file(path), kind
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # Only pieces that are not in the table reach the model, so a table of its own would cost and find nothing.
        self.model = Tokenizer.from_file(path).model
        if hasattr(self.model, "_resize_cache"):
            self.model._resize_cache(0)
        self._chars = byte_chars()
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        easy = piece.isascii() and piece.isprintable()
        shown = piece.replace(" ", self._chars[32]) if easy else "".join(map(self._chars.__getitem__, piece.encode()))
        return array(self.kind, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed."""
        if len(self._known) > KEPT:
            self._older, self._known = self._known, {}
        known, older, find = self._known, self._older, self._known.get
        out: list[bytes] = []
        for t in texts:
            plain = t.replace("\n", "").isprintable() if t.isascii() else PLAIN.fullmatch(t)
            if not plain or any(s in t for s in self.special):
                out.append(array(self.kind, self.library.encode(t, add_special_tokens=False).ids).tobytes())
                continue
            pieces = CUT.findall(t)
            got = list(map(find, pieces))
            at = -1
            while True:
                try:
                    at = got.index(None, at + 1)
                except ValueError:
                    break
                p = pieces[at]
                ids = find(p)
                if ids is None:
                    ids = older.get(p)
                    known[p] = ids = self._piece(p) if ids is None else ids
                got[at] = ids
            out.append(b"".join(got))
        return out


_LOADED: dict[tuple[str, str], CachedEncoder] = {}


def worker_encoder(path: str, kind: str) -> CachedEncoder:
    if (path, kind) not in _LOADED:
        _LOADED[path, kind] = CachedEncoder(path, kind)
    return _LOADED[path, kind]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def vbyte_encode(numbers: np.ndarray, groups: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control bytes and data bytes of runs of unsigned 32-bit numbers. groups: of four numbers, in each run."""
    if not len(groups):
        return [], []
    code = (numbers > 0xFF).astype(np.uint8)
    wide = 2 if not len(numbers) or numbers.max() <= 0xFFFF else 4
    if wide == 4:
        code += numbers > 0xFFFF
        code += numbers > 0xFFFFFF
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    raw = numbers.astype(f"<u{wide}").view(np.uint8).reshape(-1, wide)
    data = raw[np.arange(wide) <= code[:, None]].tobytes()
    ends = np.cumsum(groups)
    before = np.concatenate(([0], np.cumsum(LENGTHS[control].sum(axis=1, dtype=np.int64))))
    at, cut, control = [0, *ends.tolist()], [0, *before[ends].tolist()], control.tobytes()
    return [control[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], [data[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def vbyte_decode(control: bytes, data: bytes) -> np.ndarray:
    """All numbers, those that fill up last groups included: lengths by table, places by their running sum."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()
    if not len(size):
        return np.zeros(0, np.uint32)
    end = np.cumsum(size, dtype=np.int64)
    d = np.frombuffer(data, np.uint8)
    out = d[end - size].astype(np.uint32)
    for k in range(1, int(size.max())):
        longer = np.flatnonzero(size > k)
        out[longer] |= d[end[longer] - size[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def tokenize(docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, counts): ids in two bytes each where the vocabulary allows it, the end id included.

    The last row of each task has no ids, but how often the task has met each id.
    """
    src = pick(docs, key, text)
    kind = _kind(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(path, "H" if kind == "<u2" else "I")
        end, total = np.array([end_id], kind).tobytes(), np.zeros(end_id + 1, np.int64)
        for b in batches:
            packed = [x + end for x in enc.encode([t or "" for t in b.column(1).to_pylist()])]
            n = np.bincount(np.frombuffer(b"".join(packed), kind), minlength=len(total))
            n[: len(total)] += total
            total = n
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary()), pa.nulls(len(packed), pa.binary())], names=[key, "ids", "counts"])
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.astype("<i8").tobytes()], pa.binary())], names=[key, "ids", "counts"])

    return src.mapInArrow(run, f"`{key}` bigint, ids binary, counts binary")


def _kind(path: str) -> str:
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    most = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    return "<u2" if most < 1 << 16 else "<u4"


class TokenFile:
    """A written token file, known by its folder alone."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        row = spark.read.schema(_INDEX).parquet(f"{path}/index").first()
        self.ids_by_rank = np.frombuffer(row.ids_by_rank, "<u4")
        self.base = dict(zip(row.buckets, row.starts, strict=True))

    def read(self, key: str = "doc_id") -> DataFrame:
        """(key, start, n_tokens, ids_crc32) of each document, from the files."""

        def row(doc: pa.Array, before: np.ndarray, counts: np.ndarray, ids: list[np.ndarray]) -> list[pa.Array]:
            return [doc, pa.array(before, pa.int64()), pa.array(counts, pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())]

        return self._decoded(row, [key, "start", "n_tokens", "ids_crc32"], f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")

    def ids(self, key: str = "doc_id") -> DataFrame:
        """(key, start, ids: packed little-endian unsigned 32-bit integers) of each document, from the files."""

        def row(doc: pa.Array, before: np.ndarray, counts: np.ndarray, ids: list[np.ndarray]) -> list[pa.Array]:
            return [doc, pa.array(before, pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())]

        return self._decoded(row, [key, "start", "ids"], f"`{key}` bigint, start bigint, ids binary")

    def _decoded(self, row, names: list[str], schema: str) -> DataFrame:
        by_rank, base = self.ids_by_rank, self.base

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for block in b.to_pylist():
                    counts = np.frombuffer(block["counts"], "<i8")
                    ids = by_rank[vbyte_decode(block["control"], block["data"])]
                    first = np.cumsum(-(-counts // 4) * 4) - (-(-counts // 4) * 4)  # documents begin at whole groups
                    before = base[block["bucket"]] + block["start"] + np.cumsum(counts) - counts
                    cut = [ids[f : f + n] for f, n in zip(first.tolist(), counts.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(row(pa.array(block["doc_ids"], pa.int64()), before, counts, cut), names=names)

        return self.spark.read.schema(_BLOCKS).parquet(f"{self.path}/blocks").mapInArrow(run, schema)


_INDEX = "ids_by_rank binary, buckets array<int>, starts array<bigint>"
_BLOCKS = "bucket int, seq bigint, start bigint, doc_ids array<bigint>, counts binary, control binary, data binary"


def write(docs: DataFrame, path: str | None = None, end_id: int = END_ID, key: str = "doc_id", text: str = "text", to: str | None = None) -> TokenFile:
    """Writes the token file to a folder ``to`` (else a new one in the shared folder)."""
    spark = docs.sparkSession
    bound_batches(spark)
    path = path or default_path()
    kind = _kind(path)
    staged = Stage(tokenize(docs.select(F.col(key).cast("bigint").alias(key), F.col(text).cast("string").alias(text)), path, end_id, key, text), "tokens", "lz4")
    rows = staged.df.where("ids is not null").select(key, "ids")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0).to_pylist():
                n = np.frombuffer(x, "<i8")
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(n[seen], pa.int64())], names=["id", "n"])

    # At most one row for each entry of the vocabulary.
    counts = staged.df.where("counts is not null").select("counts").mapInArrow(unpack, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    ranked = sorted(counts, key=lambda r: (-r.n, r.id))
    ids_by_rank = np.array([r.id for r in ranked], np.int64)
    rank_of = np.zeros(int(ids_by_rank.max(initial=0)) + 1, np.uint32)
    rank_of[ids_by_rank] = np.arange(len(ids_by_rank), dtype=np.uint32)
    common = np.array(ids_by_rank[:1], kind).tobytes()
    fill, tokens = common * 3, sum(r.n for r in counts)
    buckets = min(MOST_BUCKETS, max(1, math.ceil(tokens / BUCKET_TOKENS)))
    # Equal cuts mean an id of many rows: they share the ranges between them. Nulls have ranges of their own, in front.
    cuts = np.array(rows.approxQuantile(key, [i / buckets for i in range(1, buckets)], 0.2 / buckets) if buckets > 1 else [], np.float64).astype(np.int64)
    n = rows.agg(F.count("*").alias("all"), F.count_if(F.col(key).isNull()).alias("null")).first()
    nulls = max(1, math.ceil(buckets * n["null"] / max(1, n["all"])))

    def bucket_of(k: int | None, crc: int) -> int:
        if k is None:
            return crc % nulls
        left, right = (int(np.searchsorted(cuts, k, side=x)) for x in ("left", "right"))
        return nulls + (right if right - left < 2 else left + 1 + crc % (right - left))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, packed = b.column(0).to_pylist(), b.column(1).to_pylist()
            n = np.array([len(x) for x in packed], np.int64) // np.dtype(kind).itemsize
            # The commonest id has rank 0, which fills up last groups.
            filled = b"".join([part for x, k in zip(packed, n.tolist(), strict=True) for part in (x, fill[: -k % 4 * len(common)])])
            control, data = vbyte_encode(rank_of[np.frombuffer(filled, kind)], -(-n // 4))
            bucket = [bucket_of(k, zlib.crc32(d, zlib.crc32(c))) for k, c, d in zip(keys, control, data, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), b.column(0), pa.array(n, pa.int64()), pa.array(control, pa.binary()), pa.array(data, pa.binary())], names=["bucket", key, "n", "control", "data"])

    coded = rows.mapInArrow(code, f"bucket int, `{key}` bigint, n bigint, control binary, data binary")
    dealt = coded.repartitionById(nulls + len(cuts) + 1, F.col("bucket")).sortWithinPartitions("bucket", F.col(key).asc_nulls_first(), "control", "data")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, seq, start, held, size = None, 0, 0, [], 0

        def block() -> pa.RecordBatch:
            nonlocal seq, start, held, size
            ids, n = [h[0] for h in held], np.array([h[1] for h in held], "<i8")
            out = pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([seq], pa.int64()), pa.array([start], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([n.tobytes()], pa.binary()), pa.array([b"".join(h[2] for h in held)], pa.binary()), pa.array([b"".join(h[3] for h in held)], pa.binary())],
                names=["bucket", "seq", "start", "doc_ids", "counts", "control", "data"],
            )
            seq, start, held, size = seq + 1, start + int(n.sum()), [], 0
            return out

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and (row[0] != bucket or size + row[2] > BLOCK_TOKENS):
                    yield block()
                if row[0] != bucket:
                    bucket, seq, start = row[0], 0, 0
                held.append(row[1:])
                size += row[2]
        if held:
            yield block()

    to = to or f"{shared_dir(spark)}/token-file-{uuid.uuid4().hex[:12]}"
    dealt.mapInArrow(pack, _BLOCKS).write.option("compression", "lz4").parquet(f"{to}/blocks")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{to}/blocks")
    last = blocks.groupBy("bucket").agg(F.max_by(F.struct("start", "counts"), "seq").alias("last")).collect()  # a row a bucket
    starts, before = {}, 0
    for r in sorted(last, key=lambda r: r.bucket):
        starts[r.bucket] = before
        before += r["last"]["start"] + int(np.frombuffer(r["last"]["counts"], "<i8").sum())
    spark.createDataFrame([(ids_by_rank.astype("<u4").tobytes(), list(starts), list(starts.values()))], _INDEX).coalesce(1).write.parquet(f"{to}/index")
    staged.drop()
    return TokenFile(spark, to)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write(table(spark, sf_dir, "documents")).read()
