"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: densities of a fixed lexicon and of words and word beginnings learned from labelled rows,
second-person words near such words, and rates of capitals, exclamation marks, punctuation and obfuscated words. Label,
language, source and id are no inputs.

A bounded sample of labelled rows is gathered in one task, which fits the model; the driver gets the model alone. Lexicon features of a sampled row come from a lexicon learned
on the other folds, so trees see them as they are on new text; the calibration is fitted on predictions of trees that
did not see the row. Scoring is row by row with a model of fixed size.

Null texts are scored as empty ones. Rows are independent, so repeated rows get equal scores. Where no labelled row of
one class exists, the score is the share of toxic rows (0 without any).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .calibrate import isotonic_fit, isotonic_predict
from .common import bound_batches, held_out, table
from .sampling import fitted, labelled_sample

#: Labelled rows of each class that the model is fitted on.
MOST_ROWS = 2000
FOLDS = 4
#: Learned lexicon entries of each kind, the least toxic texts that hold one, and the least log odds.
LEXICON = 2000
SUPPORT = 2
LEAST_ODDS = 1.5
PREFIXES = (4, 5)
NEAR = 5
THRESHOLD = 0.5

#: Insults.
INSULTS = frozenset("clown disgusting dumb fool garbage idiot idiots imbecile jerk liar loser losers moron morons pathetic pig scum shame stupid trash ugly vermin worthless".split())
#: Second-person words of four languages.
YOU = frozenset("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine deinen ihr euch tú ti usted ustedes vosotros".split())

_WORD = re.compile(r"[^\W\d_]+")
_ODD = re.compile(r"[^\W\d_][*@$#!0-9+]+[^\W\d_]|(?:\b[^\W\d_][ .\-_]){3,}")
_PUNCT = re.compile(r"[^\w\s]")
_CAPS = re.compile(r"[A-ZÀ-ÖØ-Þ]")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _units(words: set[str], kind: int) -> set[str]:
    return words if not kind else {w[:kind] for w in words if len(w) > kind}


class Lexicon:
    """Log odds of words (kind 0) and of word beginnings by length, learned from texts' distinct words."""

    def __init__(self, toxic: list[set[str]], clean: list[set[str]]):
        self.odds: dict[int, dict[str, float]] = {}
        a, b = len(toxic) + 1.0, len(clean) + 1.0
        for kind in (0, *PREFIXES):
            hi, lo = Counter(), Counter()
            for s in toxic:
                hi.update(_units(s, kind))
            for s in clean:
                lo.update(_units(s, kind))
            got = {u: math.log((n + 0.5) / a) - math.log((lo[u] + 0.5) / b) for u, n in hi.items() if n >= SUPPORT}
            got = {u: o for u, o in got.items() if o >= LEAST_ODDS}
            self.odds[kind] = dict(sorted(got.items(), key=lambda x: (-x[1] * math.log1p(hi[x[0]]), x[0]))[:LEXICON])


def features(text: str, words: list[str], lexicon: Lexicon) -> list[float]:
    n, chars = max(1, len(words)), max(1, len(text))
    out = [sum(w in INSULTS for w in words) / n]
    hit_at: list[int] = []
    for kind in (0, *PREFIXES):
        odds = lexicon.odds[kind]
        got = [(i, odds[u]) for i, u in enumerate(words if not kind else [w[:kind] if len(w) > kind else "" for w in words]) if u in odds]
        score = sorted((o for _, o in got), reverse=True)
        out += [len(got) / n, math.log1p(len(got)), score[0] if score else 0.0, sum(score[:5]), sum(score) / n]
        if not kind:
            hit_at = [i for i, _ in got]
    near = sum(1 for i in hit_at if any(w in YOU for w in words[max(0, i - NEAR) : i + NEAR + 1]))
    out += [near / n, sum(w in YOU for w in words) / n]
    out += [len(_CAPS.findall(text)) / chars, text.count("!") / chars, len(_PUNCT.findall(text)) / chars, len(_ODD.findall(text)) / n, math.log1p(len(words))]
    return out


class Trees:
    """Gradient boosting with histogram splits for the logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 3.0):
        self.rate = rate
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        b = self._binned(x)
        p = float(np.clip((w * y).sum() / w.sum(), 1e-3, 1 - 1e-3))
        self.base = math.log(p / (1 - p))
        f = np.full(len(y), self.base)
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for _ in range(rounds):
            q = 1 / (1 + np.exp(-f))
            tree = self._grow(b, w * (y - q), w * q * (1 - q), w, depth, bins, least)
            self.trees.append(tree)
            f += rate * self._leaf(tree, b)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    @staticmethod
    def _grow(b, g, h, w, depth, bins, least):
        nodes = 2 ** (depth + 1) - 1
        feature, cut, value = np.full(nodes, -1), np.zeros(nodes, np.int64), np.zeros(nodes)
        at = np.zeros(len(g), np.int64)
        for node in range(nodes):
            mine = np.flatnonzero(at == node)
            if not len(mine):
                continue
            gs, hs = g[mine].sum(), h[mine].sum()
            value[node] = gs / (hs + 1.0)
            if node >= 2**depth - 1:
                continue
            best = 1e-6
            for j in range(b.shape[1]):
                c = b[mine, j]
                gl, hl, wl = (np.cumsum(np.bincount(c, v[mine], minlength=bins))[:-1] for v in (g, h, w))
                gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                gain[(wl < least) | (w[mine].sum() - wl < least)] = 0
                k = int(gain.argmax())
                if gain[k] > best:
                    best, feature[node], cut[node] = gain[k], j, k
            if feature[node] >= 0:
                at[mine] = 2 * node + 1 + (b[mine, feature[node]] > cut[node])
        return feature, cut, value

    @staticmethod
    def _leaf(tree, b: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        at = np.zeros(len(b), np.int64)
        rows = np.arange(len(b))
        while True:
            f = feature[at]
            go = f >= 0
            if not go.any():
                return value[at]
            at = np.where(go, 2 * at + 1 + (b[rows, np.maximum(f, 0)] > cut[at]), at)

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = self._binned(x)
        return self.base + self.rate * sum((self._leaf(t, b) for t in self.trees), np.zeros(len(x)))


class Model:
    def __init__(self, rows: list[tuple[str, int]], share: dict[int, float]):
        y = np.array([l for _, l in rows], np.int64)
        self.prior, self.trees = share.get(1, 0.0), None
        if min((y == 0).sum(), (y == 1).sum()) < 2:
            return
        words = [words_of(t) for t, _ in rows]
        sets = [set(w) for w in words]
        fold = np.zeros(len(y), np.int64)
        for c in (0, 1):
            fold[y == c] = np.arange((y == c).sum()) % FOLDS

        def learn(mask: np.ndarray) -> Lexicon:
            return Lexicon([sets[i] for i in np.flatnonzero(mask & (y == 1))], [sets[i] for i in np.flatnonzero(mask & (y == 0))])

        x = np.zeros((len(y), 0))
        for k in range(FOLDS):
            lex = learn(fold != k)
            for i in np.flatnonzero(fold == k):
                v = features(rows[i][0], words[i], lex)
                if not x.shape[1]:
                    x = np.zeros((len(y), len(v)))
                x[i] = v
        w = np.where(y == 1, share[1] / (y == 1).sum(), share[0] / (y == 0).sum()) * len(y)
        even = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * len(y)
        raw = np.zeros(len(y))
        for k in range(FOLDS):
            raw[fold == k] = Trees(x[fold != k], y[fold != k], even[fold != k]).raw(x[fold == k])
        self.lexicon, self.trees = learn(np.ones(len(y), bool)), Trees(x, y, even)
        self.kx, self.ky = isotonic_fit(raw, y.astype(float), w)

    def score(self, texts: list[str]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.prior)
        if not texts:
            return np.zeros(0)
        x = np.array([features(t, words_of(t), self.lexicon) for t in texts])
        return isotonic_predict(self.kx, self.ky, self.trees.raw(x), THRESHOLD)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", most_rows: int = MOST_ROWS) -> Model:
    rows, share = labelled_sample(docs, labels, key, text, label, most_rows)
    return fitted(rows, lambda sample: Model(sample, share))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, held_out, score, predicted) of each document."""
    return _scored(docs.select(F.struct(F.col(key), held_out(key).alias("held_out")).alias("row"), F.col(text).cast("string").alias("text")), model, threshold).select(f"row.`{key}`", "row.held_out", "score", "predicted")


def clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not predicted toxic, with their columns as they were."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).cast("string").alias("text"))
    return _scored(packed, model, threshold).where(F.col("predicted") == 0).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _scored(packed: DataFrame, model: Model, threshold: float) -> DataFrame:
    spark = packed.sparkSession
    bound_batches(spark)
    held = spark.sparkContext.broadcast(model)  # trees and a lexicon of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            s = m.score([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], names=["row", "score", "predicted"])

    return packed.mapInArrow(run, f"row {packed.schema['row'].dataType.simpleString()}, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
