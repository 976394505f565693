"""Shared plumbing: table access, the shared scratch folder and batch bounds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handed to Python at once. Texts can be long, so batches stay small.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what one Arrow batch may hold, in rows and in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one only where that is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="lexmill-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Stage:
    """A table written to the shared folder: it cuts lineage and survives lost executors."""

    def __init__(self, df: DataFrame, label: str, codec: str = "zstd"):
        spark = df.sparkSession
        self.path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        # Once the table is written nothing reads the shuffles behind it.
        before = spark.conf.get(_CLEANUP, None)
        spark.conf.set(_CLEANUP, "true")
        try:
            df.write.option("compression", codec).parquet(self.path)
        finally:
            spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
        self.df = spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the files, once nothing reads them any more."""
        spark = self.df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)



def held_out(key: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra ones can't clash with an operator's own."""
    return df.select(*[F.col(n) for n in names])
