"""Quality classifier by compression: zstandard dictionaries of good and of bad text.

A bounded sample of labelled rows, gathered in one task, is split in two: one half trains a dictionary for each label, the other calibrates.
A text is cut into chunks, so that a dictionary counts throughout a long text, and each chunk is compressed with both.
The difference of the compressed sizes by byte of text, over the whole text, is the evidence: text that says little new
has little of it either way. Isotonic regression on the calibration half turns it into a score. Every chunk of every
text is used.

Null texts are scored as empty ones; the empty text has no evidence, and its score is that of evidence 0. Rows are
scored one by one, so repeated rows get equal scores. Where no labelled row of one class exists, the score is the share
of good rows (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .calibrate import isotonic_fit, isotonic_predict
from .common import bound_batches, held_out, table
from .sampling import fitted, labelled_sample

#: Labelled rows of each class that the model is fitted on.
MOST_ROWS = 2000
#: Bytes of a dictionary, and of a chunk.
DICT_BYTES = 64 << 10
CHUNK = 1024
LEVEL = 3
THRESHOLD = 0.3


def chunks(raw: bytes) -> list[bytes]:
    return [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)]


def build_dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; too few samples for the trainer give their plain bytes."""
    parts = [c for t in texts for c in chunks(t)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICT_BYTES:]


class Compressors:
    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = (zstandard.ZstdCompressor(level=LEVEL, dict_data=self._dict(d), write_content_size=False, write_checksum=False, write_dict_id=False) for d in (good, bad))

    @staticmethod
    def _dict(raw: bytes) -> zstandard.ZstdCompressionDict:
        d = zstandard.ZstdCompressionDict(raw)
        d.precompute_compress(level=LEVEL)
        return d

    def evidence(self, raw: bytes) -> float:
        """Above 0 where the good dictionary fits better."""
        g = b = 0
        for c in chunks(raw):
            g += len(self.good.compress(c))
            b += len(self.bad.compress(c))
        return (b - g) / len(raw) if raw else 0.0


class Model:
    """Dictionaries and the calibration of their evidence."""

    def __init__(self, rows: list[tuple[str, int]], share: dict[int, float] | None = None):
        """rows: (text, label), in an order that says nothing; share: of each class among all labelled rows."""
        by = {y: [t.encode("utf-8", "replace") for t, l in rows if l == y] for y in (0, 1)}
        self.good = self.bad = None
        self.x = self.y = np.zeros(0)
        n = len(by[0]) + len(by[1])
        self.prior = (share or {}).get(1, len(by[1]) / n if n else 0.5)
        if min(len(by[0]), len(by[1])) < 2:
            return
        self.good, self.bad = build_dictionary(by[1][0::2]), build_dictionary(by[0][0::2])
        c = Compressors(self.good, self.bad)
        held = [(c.evidence(t), y) for y in (0, 1) for t in by[y][1::2]]
        share = share or {y: len(by[y]) / n for y in (0, 1)}
        weight = {y: share[y] / max(1, len(by[y][1::2])) for y in (0, 1)}
        self.x, self.y = isotonic_fit(np.array([e for e, _ in held]), np.array([y for _, y in held], float), np.array([weight[y] for _, y in held]))

    def scorer(self):
        if self.good is None:
            return lambda texts: [self.prior] * len(texts)
        c = Compressors(self.good, self.bad)
        return lambda texts: isotonic_predict(self.x, self.y, np.array([c.evidence(t.encode("utf-8", "replace")) for t in texts]), THRESHOLD).tolist()


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", most_rows: int = MOST_ROWS) -> Model:
    rows, share = labelled_sample(docs, labels, key, text, label, most_rows)
    return fitted(rows, lambda sample: Model(sample, share))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, held_out, score, predicted) of each document."""
    spark = docs.sparkSession
    bound_batches(spark)
    src = docs.select(F.col(key), held_out(key).alias("held_out"), F.col(text).cast("string").alias("text"))
    held = spark.sparkContext.broadcast(model)  # two dictionaries and the steps of the calibration

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = held.value.scorer()
        for b in batches:
            s = of([t or "" for t in b.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())], names=[key, "held_out", "score", "predicted"])

    return src.mapInArrow(run, f"`{key}` {dict(src.dtypes)[key]}, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
