"""The folder that driver and executors share, and small files in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the checkpoint folder set in code; a temporary one in local mode only."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="lexmill-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def fresh(spark: SparkSession, label: str) -> str:
    """A folder of the shared one that nothing has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file under a name that no one else has taken; False, and nothing written, where it is taken.

    Which of two writers comes first the file system decides. An empty file is what a writer left that ended in between:
    it is written anew.
    """
    fs, p = _at(spark, path)
    fs.mkdirs(p.getParent())
    try:
        out = fs.create(p, False)
    except Exception:  # noqa: BLE001  the file system's own error, by py4j
        if not fs.exists(p):
            raise
        if read(spark, path):
            return False
        out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None where there is none."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    source = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _at(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
