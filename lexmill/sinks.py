"""Writers: reports, snapshots, JSON, and XML with only <Dest> texts replaced."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.xmltext import skeleton, splice, spliced  # noqa: F401  splice is for callers
from .sources.formats import BATCH_BYTES, MANIFESTS, open_, register

def splice_files(files: DataFrame, changes: DataFrame) -> DataFrame:
    """files (file, xml), changes (file, xml_index, dest) -> (file, xml, changed, unmatched, intact).

    One document is one row. changed counts what was replaced; unmatched are the numbers that no unit with a Dest has; of
    several changes of a unit the greatest text counts.
    """
    register(files.sparkSession)  # bounds the batches
    changes = changes.groupBy("file", "xml_index").agg(F.max("dest").alias("dest"))
    per = changes.groupBy("file").agg(F.collect_list(F.struct(F.col("xml_index").alias("i"), F.col("dest").alias("d"))).alias("new"))
    both = files.join(per, "file", "left")

    def run(batches):
        for b in batches:
            rows, size = [], 0
            for f, xml, new in zip(b["file"], b["xml"], b["new"], strict=True):
                changed = {} if new is None else {int(x["i"]): x["d"] for x in new}
                after, done = spliced(xml, changed)
                rows.append((f, after, len(done), sorted(set(changed) - done), skeleton(after) == skeleton(xml)))
                size += len(after)
                if size > BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=["file", "xml", "changed", "unmatched", "intact"])
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=["file", "xml", "changed", "unmatched", "intact"])

    return both.select("file", "xml", "new").mapInPandas(run, "file string, xml string, changed bigint, unmatched array<bigint>, intact boolean")


def write_documents(rows: DataFrame, folder: str, job: str | None = None) -> DataFrame:
    """Writes documents (file, path: a name below the folder, content) from executors, and reads them back:
    (file, path, written, sha256, verified).

    The rows are made once. A job of the same name that ran before, or in part, is carried on (see ``lexmill_documents``).
    """
    spark = rows.sparkSession
    register(spark)
    job = job or uuid.uuid4().hex
    rows.select("file", "path", "content").write.format("lexmill_documents").option("job", job).mode("append").save(folder)
    manifest = spark.read.schema("file string, path string, sha256 string, bytes bigint").json(f"{folder}/{MANIFESTS}/{job}.json")
    back = open_(spark, "documents", folder).select("path", F.col("sha256").alias("found"))
    got = manifest.join(back, "path", "left")
    return got.select("file", "path", F.concat(F.lit(folder.rstrip("/") + "/"), "path").alias("written"), "sha256", F.coalesce(F.col("found") == F.col("sha256"), F.lit(False)).alias("verified"))


def write_xml(spliced_files: DataFrame, folder: str, root: str | None = None, job: str | None = None) -> DataFrame:
    """Writes each document (file, xml, intact) to a new file of a folder and reads it back: see ``write_documents``.

    Documents that are not intact are not written. Files keep their path below ``root``, so base names may repeat; without
    a root they keep their base names, and two of one name are an error.
    """
    name = F.regexp_replace("file", r"^.*[/\\\\]", "")
    if root is not None:
        below = root.rstrip("/") + "/" if root else ""
        name = F.when(F.startswith("file", F.lit(below)), F.substring("file", len(below) + 1, 1 << 20)).otherwise(name)
    return write_documents(spliced_files.where("intact").select("file", name.alias("path"), F.col("xml").alias("content")), folder, job)


def write_report(df: DataFrame, path: str, form: str = "parquet") -> None:
    """A report is written once."""
    df.write.mode("errorifexists").format(form).save(path)


def append_snapshot(df: DataFrame, path: str) -> None:
    """Progress is only added to."""
    df.write.mode("append").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(path)
