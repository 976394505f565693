"""BPE encoding and decoding with a pair occurrence index.

Texts are cut into pieces, and the pieces a worker has not met yet are encoded together: every pair of neighbouring
symbols is mapped to all its positions in all of them, the ranks that occur are applied in ascending order from a heap,
and each merge updates the lists of the pairs it makes. A bounded table keeps the ids of pieces met before.

Normalising and cutting follow the tokenizer file. Texts of plain Latin characters are cut by a regular expression;
any other text by the tokenizers library's own normaliser and pre-tokenizer, so that results agree on all of Unicode.

Null and empty texts give no tokens. Texts hold the strings of special tokens as those tokens, as the library does.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import bound_batches, pick, table

#: Pieces whose ids a worker keeps in each of two generations; when the younger is full, the older goes.
KEPT = 100_000
#: Characters with which the regular expression and the library agree.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-ɏ]*")
#: How the library cuts lower-cased plain texts: every character of U+00F8 to U+024F is a letter.
CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-zªµºÀ-ÖØ-öø-ɏ]+|[0-9²³¹¼-¾]|[^\sA-Za-zªµºÀ-ÖØ-öø-ɏ0-9²³¹¼-¾]+")


def byte_chars() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable bytes stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars, extra = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in chars:
            chars[b] = chr(256 + extra)
            extra += 1
    return [chars[b] for b in range(256)]


class PairIndexBpe:
    """Encoder and decoder of one vocabulary file (word ends as suffixes, byte-level pieces)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.rank: dict[int, int] = {}
        self.pair: list[tuple[int, int, int]] = []
        born: dict[int, int] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ", 1)
            x, y = self.vocab[a], self.vocab[b]
            new = self.vocab[a + b]
            # Ascending ranks over all pieces at once give what merging piece by piece gives, as no merge makes a pair of lower rank.
            if max(born.get(x, -1), born.get(y, -1)) >= r:
                raise ValueError(f"merge {r} uses a symbol that is made later")
            born.setdefault(new, r)
            self.rank.setdefault(x << 20 | y, r)
            self.pair.append((x, y, new))
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._chars = byte_chars()
        self._bytes = {c: b for b, c in enumerate(self._chars)}
        self._fixed = {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}
        self._known: dict[str, bytes] = dict(self._fixed)
        self._older: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        out: list[str] = []
        for part in self._special.split(text) if self._special and "<|" in text else (text,):
            if part in self.special:
                out.append(part)
            elif PLAIN.fullmatch(part):
                out += CUT.findall(part.lower())
            else:
                got = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
                out += [bytes(map(self._bytes.__getitem__, p)).decode() for p, _ in got]
        return out

    def _symbols(self, piece: str) -> list[int]:
        chars = [self._chars[b] for b in piece.encode()]
        chars[-1] += self.suffix
        return [self.vocab[c] for c in chars if c in self.vocab]

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece, all pieces together by the pair occurrence index."""
        if not pieces:
            return []
        sym: list[int] = []
        nxt: list[int] = []
        prv: list[int] = []
        begin: list[int] = []
        where: dict[int, list[int]] = {}
        rank, pair = self.rank, self.pair
        for piece in pieces:
            s = self._symbols(piece)
            at = len(sym)
            begin.append(at)
            sym += s
            prv += range(at - 1, at + len(s) - 1)
            nxt += range(at + 1, at + len(s) + 1)
            if s:
                prv[at] = nxt[-1] = -1
            for i in range(len(s) - 1):
                r = rank.get(s[i] << 20 | s[i + 1])
                if r is not None:
                    where.setdefault(r, []).append(at + i)
        active = list(where)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            a, b, c = pair[r]
            places = where.pop(r)
            if a == b:
                places.sort()  # overlapping pairs merge from the left
            for p in places:
                q = nxt[p]
                if sym[p] != a or q < 0 or sym[q] != b:
                    continue
                sym[p], sym[q] = c, -1
                n = nxt[p] = nxt[q]
                if n >= 0:
                    prv[n] = p
                    k = rank.get(c << 20 | sym[n])
                    if k is not None:
                        if k in where:
                            where[k].append(p)
                        else:
                            where[k] = [p]
                            heapq.heappush(active, k)
                m = prv[p]
                if m >= 0:
                    k = rank.get(sym[m] << 20 | c)
                    if k is not None:
                        if k in where:
                            where[k].append(m)
                        else:
                            where[k] = [m]
                            heapq.heappush(active, k)
        out = []
        ends = [*begin[1:], len(sym)]
        for at, end in zip(begin, ends, strict=True):
            ids, p = [], at if at < end else -1
            while p >= 0:
                ids.append(sym[p])
                p = nxt[p]
            out.append(ids)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self._known) > KEPT:
            self._older, self._known = self._known, dict(self._fixed)
        known, older = self._known, self._older
        cut = [self.pieces(t) for t in texts]
        new: set[str] = set()
        for c in cut:
            new.update(c)
        new.difference_update(known)
        known.update({p: older[p] for p in new if p in older})
        fresh = [p for p in new if p not in known]
        for piece, ids in zip(fresh, self.encode_pieces(fresh), strict=True):
            known[piece] = np.array(ids, "<u4").tobytes()
        return [b"".join(map(known.__getitem__, c)) for c in cut]


class Decoder:
    """The tokens of a vocabulary file by id, and no more: decoding workers stay small."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec.get("added_tokens", [])}}
        self.token = [""] * (max(of.values(), default=-1) + 1)
        for t, i in of.items():
            self.token[i] = t

    def decode(self, ids: bytes) -> str:
        """The text the library's decoder gives, special tokens included."""
        got = np.frombuffer(ids, "<u4").tolist()
        return " ".join(map(self.token.__getitem__, got)) if got else ""


_LOADED: dict[str, PairIndexBpe] = {}


def worker_bpe(path: str) -> PairIndexBpe:
    if path not in _LOADED:
        _LOADED[path] = PairIndexBpe(path)
    return _LOADED[path]


_DECODERS: dict[str, Decoder] = {}


def worker_decoder(path: str) -> Decoder:
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(path)
    return _DECODERS[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): ids as packed little-endian unsigned 32-bit integers."""
    bound_batches(docs.sparkSession)
    path = path or default_path()
    src = pick(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_bpe(path)
        for b in batches:
            ids = bpe.encode([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], names=[key, "ids"])

    return src.mapInArrow(run, f"`{key}` {dict(src.dtypes)[key]}, ids binary")


def digest(encoded: DataFrame, path: str | None = None, key: str = "doc_id") -> DataFrame:
    """Decodes packed ids; (key, n_tokens, ids_sha256, decoded_sha256, decoded_chars)."""
    path = path or default_path()
    src = pick(encoded, key, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = worker_decoder(path)
        for b in batches:
            ids = [x or b"" for x in b.column(1).to_pylist()]
            texts = [decoder.decode(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256", "decoded_chars"],
            )

    return src.mapInArrow(run, f"`{key}` {dict(src.dtypes)[key]}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, decoded_chars bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(encode(table(spark, sf_dir, "documents")))
