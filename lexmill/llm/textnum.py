"""Words and word hashes of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

_P1 = np.uint64(0x9E3779B97F4A7C15 | 1)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F | 1)


def classes(separators: list[tuple[int, int]]) -> np.ndarray:
    """Byte table: 0 for separators, else the byte with A-Z lower-cased."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    for a, b in separators:
        t[a : b + 1] = 0
    return t


#: Words are what lies between white space.
SPACED = classes([(0x20, 0x20), (0x09, 0x0D)])
#: Words are ASCII letters and digits and everything beyond ASCII.
ALNUM = classes([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
#: A byte that no UTF-8 text holds parts two texts; white space tables may keep NUL as a word byte.
_GAP = b"\xff"


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Powers that a worker keeps, and bytes of words that are hashed at once.
MOST_KEPT = 1 << 20
CHUNK_BYTES = 1 << 18


def powers(n: int, p: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2**64."""
    got = _TABLES.get(int(p))
    if got is None or len(got[0]) < n:
        got = []
        for x in (int(p), pow(int(p), -1, 1 << 64)):
            out = np.full(max(n, 1 << 16), x, np.uint64)
            out[0] = 1
            got.append(np.multiply.accumulate(out))
        got = tuple(got)
        if n <= MOST_KEPT:
            _TABLES[int(p)] = got
    return got[0][:n], got[1][:n]


def run_sums(values: np.ndarray, begin: np.ndarray, end: np.ndarray, p: np.uint64) -> np.ndarray:
    """Of each run of values the sum of its values, each times the power of p that its place in the run has."""
    up, down = powers(len(values) + 1, p)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return (total[end] - total[begin]) * down[begin]


class Spans:
    """Words as places in bytes."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.data, self.start, self.size = data, start, size

    def hashes(self, which: np.ndarray | None = None, salt: int = 0) -> np.ndarray:
        """64-bit hashes of all words, or of some; bytes are summed by bounded runs of words."""
        p, add = (_P2 if salt else _P1), np.uint64(1 + 77 * salt)
        if which is not None:
            start, size = self.start[which], self.size[which]
            if not len(start):
                return np.zeros(0, np.uint64)
            first = np.concatenate(([0], np.cumsum(size)[:-1]))
            inside = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
            value = (self.data[inside + np.repeat(start, size)].astype(np.uint64) + add) * powers(int(size.max()), p)[0][inside]
            return mix(np.add.reduceat(value, first) + size.astype(np.uint64))
        out = np.zeros(len(self.start), np.uint64)
        ends = self.start + self.size
        i = 0
        while i < len(out):
            base = int(self.start[i])
            j = max(i + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, side="right")))
            sums = run_sums(self.data[base : int(ends[j - 1])].astype(np.uint64) + add, self.start[i:j] - base, ends[i:j] - base, p)
            out[i:j] = mix(sums + self.size[i:j].astype(np.uint64))
            i = j
        return out


class Words(Spans):
    """data: lower-cased bytes; start, size: of each word in data; first[i] to first[i + 1]: the words of text i."""

    def __init__(self, texts: list[bytes], kinds: np.ndarray):
        raw = np.frombuffer(_GAP.join(texts) + _GAP if texts else b"", np.uint8)
        lens = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        ends = np.cumsum(lens)
        data = kinds[raw]
        word = (data != 0) | (raw == 0) if kinds is SPACED else data != 0  # NUL is no white space
        if len(ends):
            word[ends - 1] = False
        edge = np.flatnonzero(np.diff(np.concatenate(([0], word.view(np.int8), [0]))))
        super().__init__(data, edge[0::2], edge[1::2] - edge[0::2])
        self.first = np.concatenate(([0], np.searchsorted(self.start, ends)))


def batches_by_bytes(rows, most: int):
    """Lists of rows (…, bytes last) with up to ``most`` bytes together; one longer row is a list of its own."""
    held, size = [], 0
    for r in rows:
        n = len(r[-1])
        if held and size + n > most:
            yield held
            held, size = [], 0
        held.append(r)
        size += n
    if held:
        yield held
