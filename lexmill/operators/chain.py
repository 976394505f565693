"""The write chain: consume, write, verify, snapshot, each stage once, however often the job is cut off and run again.

A chain has a name. Each stage leaves a state file that is created only where there is none, at its end; a run goes on
behind the last state it finds. What a stage had half done is done again without harm: the consumed table is replaced, and
documents that are there with the same content count as written. A version is claimed by creating the file of the next
number: of two chains that began at one version, one gets it and the other is refused.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import staging
from ..functions.xmltext import skeleton
from ..sinks import splice_files, write_xml
from ..sources.formats import MANIFESTS, open_

STAGES = ("consumed", "written", "verified", "snapshot")


class Conflict(RuntimeError):
    """Another chain has taken the version."""


def canonical(*columns: str) -> Column:
    """A row as one text from which its values can be told: each with its length, nulls apart."""
    return F.concat(*[F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns])


def set_digest(rows: DataFrame, *columns: str) -> DataFrame:
    """(n, digest) of a table as a set of rows with their repeats, in whatever order and partitions they come.

    The eight words of each row's SHA-256 are summed, with map-side combination, and the sums and the count are hashed.
    """
    h = F.sha2(canonical(*columns).cast("binary"), 256)
    words = rows.select(*[F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("decimal(20,0)").alias(f"w{i}") for i in range(8)])
    sums = words.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(f"w{i}"), F.lit(0)).cast("string").alias(f"w{i}") for i in range(8)])
    return sums.select("n", F.sha2(F.concat_ws(":", F.col("n").cast("string"), *[f"w{i}" for i in range(8)]).cast("binary"), 256).alias("digest"))


def versions(spark: SparkSession, home: str) -> list[int]:
    return sorted(int(n[: -len(".json")]) for n in staging.names(spark, f"{home}/versions") if n.endswith(".json"))


def history(spark: SparkSession, home: str) -> DataFrame:
    """(version, chain, n, digest, documents) of all snapshots."""
    rows = [json.loads(staging.read(spark, f"{home}/versions/{v}.json")) for v in versions(spark, home)]
    return spark.createDataFrame([(r["version"], r["chain"], r["n"], r["digest"], r["documents"]) for r in rows], "version bigint, chain string, n bigint, digest string, documents bigint")


class WriteChain:
    """Changes (file, xml_index, dest) of documents (file, xml), written below ``home`` under a chain's name."""

    def __init__(self, spark: SparkSession, home: str, name: str):
        self.spark, self.home, self.name = spark, home.rstrip("/"), name
        self.at = f"{self.home}/chains/{name}"

    def state(self, stage: str) -> dict | None:
        text = staging.read(self.spark, f"{self.at}/states/{stage}.json")
        return json.loads(text) if text else None

    def run(self, files: DataFrame, changes: DataFrame, root: str | None = None) -> dict:
        """The snapshot: {version, chain, n, digest, documents}."""
        for stage in STAGES:
            if self.state(stage) is None:
                done = getattr(self, f"_{stage}")(files, changes, root)
                staging.create(self.spark, f"{self.at}/states/{stage}.json", json.dumps(done))
        return self.state("snapshot")

    @property
    def documents(self) -> str:
        return f"{self.at}/documents"

    def consumed(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.at}/consumed")

    def _consumed(self, files, changes, root) -> dict:
        """Changes are written down once; of several of a unit the greatest text counts."""
        one = changes.groupBy("file", "xml_index").agg(F.max("dest").alias("dest"))
        one.write.mode("overwrite").parquet(f"{self.at}/consumed")
        got = set_digest(self.consumed(), "file", "xml_index", "dest").first()
        return {"n": got.n, "digest": got.digest, "base": max(versions(self.spark, self.home), default=0)}

    def _written(self, files, changes, root) -> dict:
        touched = files.join(self.consumed().select("file").distinct(), "file", "left_semi")
        out = write_xml(splice_files(touched, self.consumed()), self.documents, root, job=self.name)
        got = out.agg(F.count("*").alias("n"), F.count_if(~F.col("verified")).alias("bad")).first()
        if got.bad:
            raise RuntimeError(f"{got.bad} documents are not what was written")
        return {"documents": got.n}

    def manifest(self) -> DataFrame:
        return self.spark.read.schema("file string, path string, sha256 string, bytes bigint").json(f"{self.documents}/{MANIFESTS}/{self.name}.json")

    def _verified(self, files, changes, root) -> dict:
        """What is in the documents: every change and no other, by a digest of units read back, and all else as before."""
        named = self.manifest().select("file", F.col("path").alias("p"))
        units = open_(self.spark, "xml", self.documents).select(F.col("file").alias("p"), "xml_index", "dest").join(named, "p")
        back = set_digest(units.join(self.consumed().select("file", "xml_index"), ["file", "xml_index"], "left_semi"), "file", "xml_index", "dest").first()
        want = self.state("consumed")
        if (back.n, back.digest) != (want["n"], want["digest"]):
            raise RuntimeError(f"{want['n']} changes were consumed, and {back.n} units read back, or others than those")
        after = open_(self.spark, "documents", self.documents).select(F.col("path").alias("p"), F.col("content").alias("xml")).join(named, "p").select("file", "xml")
        before = files.join(named.select("file"), "file", "left_semi").select("file", "xml")
        lost = _skeletons(before).join(_skeletons(after), ["file", "bones"], "left_anti").limit(1).count()
        if lost:
            raise RuntimeError("more than Dest texts has changed")
        return {"n": back.n}

    def _snapshot(self, files, changes, root) -> dict:
        was = self.state("consumed")
        version = was["base"] + 1
        row = {"version": version, "chain": self.name, "n": was["n"], "digest": was["digest"], "documents": self.state("written")["documents"]}
        path = f"{self.home}/versions/{version}.json"
        if not staging.create(self.spark, path, json.dumps(row)):
            held = json.loads(staging.read(self.spark, path))
            if held["chain"] != self.name:
                raise Conflict(f"version {version} is {held['chain']}'s; {self.name} began at {was['base']}")
        return row


def _skeletons(files: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pd.DataFrame({"file": b["file"], "bones": [skeleton(x) for x in b["xml"]]})

    return files.mapInPandas(run, "file string, bones string").select("file", F.sha2("bones", 256).alias("bones"))
