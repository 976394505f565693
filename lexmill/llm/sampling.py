"""A bounded, repeatable sample of labelled texts, and models fitted on it in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, held_out

#: Characters of sampled text that the fitting task holds. Texts are learned from whole or not at all: where a sample holds
#: more, fewer rows of it are used.
MOST_CHARS = 64 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most_rows: int) -> tuple[DataFrame, dict[int, float]]:
    """(text, label, h, key) of ``most_rows`` rows of each class at most, and the share of each class.

    Labels come only from rows that are not held out. Of several labels of one key the largest counts; null labels and
    keys don't. The choice depends on the keys alone, so it is the same in every run; rows that share a key all come.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"), held_out(key).alias("out")).where(F.col("key").isNotNull() & F.col("label").isin(0, 1) & ~F.col("out"))
    known = known.groupBy("key").agg(F.max("label").alias("label"))
    n = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(n.values())
    # Of each class about a fifth more keys than needed pass, those of least hash, so few rows meet in a task.
    cut = F.when(F.lit(False), F.lit(0).cast("bigint"))
    for y, c in n.items():
        cut = cut.when(F.col("label") == y, F.lit(int((1 << 64) * min(1.0, (1.2 * most_rows + 200) / c)) - (1 << 63) - 1))
    hashed = known.withColumn("h", F.xxhash64("key")).where(F.col("h") <= (cut if n else F.lit(0)))
    ranked = hashed.withColumn("place", F.row_number().over(Window.partitionBy("label").orderBy("h", "key"))).where(F.col("place") <= most_rows)
    # 2 * most_rows keys at most: a bounded side.
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).join(F.broadcast(ranked.select("key", "label", "h")), "key")
    return rows.select("text", "label", "h", F.col("key").cast("string").alias("key")), {y: c / total for y, c in n.items()} if total else {}


def fitted(sample: DataFrame, build: Callable[[list[tuple[str, int]]], object]):
    """The model that ``build`` makes of the sample's (text, label), in an order by hash; made by one task.

    Rows come in that order, which says nothing of labels, and those that don't fit what is left of MOST_CHARS are passed by.

    The sample is bounded, and the model comes back pickled, so the driver never holds the texts.
    """
    bound_batches(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, room = [], MOST_CHARS
        for b in batches:
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if len(text) <= room:
                    rows.append((text, label))
                    room -= len(text)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(build(rows))], pa.binary())], names=["model"])

    got = sample.repartition(1).sortWithinPartitions("h", "key", "text").select("text", "label").mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0].model) if got else build([])
