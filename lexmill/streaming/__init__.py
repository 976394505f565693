"""Translation sets as a stream of files: late repeats dropped, gate by micro-batch; windows over progress events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gate import GateConfig, gate


def read_unit_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def distinct_revisions(stream: DataFrame, ts: str = "ts", late: str = "1 hour", key: tuple[str, ...] = ("plugin", "unit_id", "version")) -> DataFrame:
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(key))


def gate_stream(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, config: GateConfig = GateConfig()):
    """Gates each micro-batch of units with contracts and hands the verdicts to a sink."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, i: sink(gate(df, config), i)).start()


def progress_windows(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of events by window and type; the same on a table and on a stream."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    rows = events.withWatermark("ts", gap) if events.isStreaming else events
    return rows.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")
