"""Readers: cases, translation sets, XML units, term rules, index files, listings and plain tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from ..functions.text import normal_path, without_bom
from ..functions.xmltext import units
from ..schema import CASE_FILE, CONTRACT, GATE_REPORT, TRANSLATION_SET, WORKER_REQUEST, WORKER_RESPONSE


def read_json(spark: SparkSession, path: str, schema: str, recursive: bool = True) -> DataFrame:
    """Whole-file JSON documents with a declared schema; a broken file is a row with ``corrupt`` set."""
    reader = spark.read.schema(f"{schema}, corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt")
    return reader.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.json").json(path).withColumn("file", F.col("_metadata.file_path"))


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """One row for each regression case of all files below a folder."""
    return read_json(spark, path, CASE_FILE).where(F.col("corrupt").isNull()).select("file", F.posexplode("cases").alias("pos", "c")).select("file", "pos", "c.*")


def read_raw_json(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(file, text, parsed: variant or null) of each file, for checks of keys that a schema would hide."""
    raw = spark.read.option("wholetext", True).option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.json").text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), without_bom("value").alias("text")).withColumn("parsed", F.try_parse_json("text"))


def read_translation_set(spark: SparkSession, path: str) -> DataFrame:
    """All translations of all files, with file and place, so that later files can win."""
    sets = read_json(spark, path, TRANSLATION_SET).where(F.col("corrupt").isNull())
    return sets.select("file", F.posexplode("translations").alias("pos", "t")).select("file", "pos", "t.*")


def read_gate_report(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, GATE_REPORT)


def read_worker_request(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, WORKER_REQUEST).select("file", F.inline("items"))


def read_worker_response(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, WORKER_RESPONSE)


def read_contracts(spark: SparkSession, path: str) -> DataFrame:
    """(file, contract) of each contract file; a broken one has ``corrupt`` set and a null contract."""
    kind = _parse_datatype_string(CONTRACT)
    got = read_json(spark, path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kind.fields))
    return got.select("file", F.when(F.col("corrupt").isNull(), F.struct(*kind.fieldNames()).cast(CONTRACT)).alias("contract"), "corrupt")


def read_keep_lists(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of keep lists: a JSON array of texts, or an object that holds one as ``keep_list`` or ``keep``."""
    got = read_raw_json(spark, path).where("parsed is not null")
    array = lambda at: F.try_variant_get("parsed", at, "array<string>")
    return got.select("file", F.explode(F.coalesce(array("$"), array("$.keep_list"), array("$.keep"))).alias("text")).where("text is not null").distinct()


def read_units_xml(spark: SparkSession, path: str, plugin: str | None = None) -> DataFrame:
    """<String> elements with <Source> and <Dest>; files of any name at any depth."""
    rows = spark.read.format("xml").option("rowTag", "String").option("recursiveFileLookup", True).schema("REC string, EDID string, Source string, Dest string").load(path)
    rows = rows.withColumn("file", F.input_file_name())
    return rows.select(F.lit(plugin).alias("plugin") if plugin else F.substring_index("file", "/", -1).alias("plugin"), F.col("REC").alias("rec"), F.col("EDID").alias("edid"), F.col("Source").alias("source"), F.col("Dest").alias("dest"), "file")


def read_xml_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, xml) of whole documents, character by character as they are: what a writer splices."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.decode("content", "utf-8").alias("xml")).withColumnRenamed("path", "file")


def xml_units(files: DataFrame, plugin: str | None = None) -> DataFrame:
    """Units of whole documents (file, xml), with the number of each <String> in its file: it can be gated by ``unit_id``
    and spliced back by (file, xml_index). Elements may have attributes; texts come with references decoded and CDATA as it
    is; a unit without a REC or EDID has nulls. ``lexmill_xml`` reads the same from files."""
    name = F.lit(plugin) if plugin else F.substring_index("file", "/", -1)

    def run(batches):
        for b in batches:
            for file, xml, of in zip(b["file"], b["xml"], b["plugin"], strict=True):
                rows = [(file, i, f"{file}#{i}", of, *(v.get(k) for k in ("REC", "EDID", "Source", "Dest"))) for i, v, _ in units(xml)]
                yield pd.DataFrame(rows, columns=["file", "xml_index", "unit_id", "plugin", "rec", "edid", "source", "dest"])

    return files.select("file", "xml", name.alias("plugin")).where("xml is not null").mapInPandas(run, "file string, xml_index bigint, unit_id string, plugin string, rec string, edid string, source string, dest string")


def parse_term_rules(blocks: DataFrame, column: str = "value") -> DataFrame:
    """(search, replace) of StartRule blocks, one text each; blocks without a search text are left out."""
    field = lambda name: F.regexp_extract(column, rf"(?m)^\s*{name}\s*=(.*)$", 1)
    return blocks.select(F.trim(field("Search")).alias("search"), F.trim(field("Replace")).alias("replace")).where("search <> ''")


def read_term_rules(spark: SparkSession, path: str) -> DataFrame:
    return parse_term_rules(spark.read.option("lineSep", "StartRule").text(path))


def read_index_file(spark: SparkSession, path: str) -> DataFrame:
    """Numbers, one a line; anything else is left out."""
    return spark.read.text(path).select(F.trim("value").try_cast("bigint").alias("xml_index")).where("xml_index is not null").distinct()


def listing_from_text(listing: DataFrame, column: str = "listing") -> DataFrame:
    """Paths of a NUL-separated listing."""
    return listing.select(F.explode(F.split(column, "\\x00")).alias("path")).where("path <> ''").select(normal_path("path").alias("path"))


def read_listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Paths below a folder by a walk; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select(normal_path("path").alias("path"), "length")


def parse_pipe_table(lines: DataFrame, columns: list[str], column: str = "value", header: list[str] | None = None) -> DataFrame:
    """Rows of a pipe table with as many cells as columns; rule lines are left out, and so is a header that has the names
    of the columns. (A table's header has no other mark once lines come in no order.)"""
    cells = F.transform(F.split(F.regexp_replace(F.trim(column), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    rows = lines.where(F.trim(column).startswith("|")).select(cells.alias("c")).where((F.size("c") == len(columns)) & ~F.forall("c", lambda x: F.rlike(x, F.lit("^:?-+:?$"))))
    rows = rows.where(~(F.transform("c", lambda x: F.lower(x)) == F.array(*[F.lit(n.lower()) for n in (header or columns)])))
    return rows.select(*[F.col("c")[i].alias(n) for i, n in enumerate(columns)])


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a few files, dealt out to all cores: a file of one row group is one task, however many cores there are. Tables
    of as many files as cores are left as they are, without a shuffle."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if 0 < len(rows.inputFiles()) < cores else rows


def derived_units(documents: DataFrame) -> DataFrame:
    """Translation units made from documents: the text as source, and a dest with a seeded defect for each id."""
    t, k = F.coalesce("text", F.lit("")), F.pmod("doc_id", F.lit(12))
    put = lambda s: F.replace(t, F.lit("that"), F.lit(s))
    dest = (
        F.when(k == 0, t)
        .when(k == 1, put("岚石月"))
        .when(k == 2, put("岚石"))
        .when(k == 3, F.concat(put("岚石月"), F.lit(" 岚石")))
        .when(k == 4, put("岚石...月"))
        .when(k == 5, put(""))
        .when(k == 6, F.concat(F.substring(t, 1, 20), F.lit("……")))
        .when(k == 7, F.concat(put("岚石月"), F.lit("龍門開")))
        .when(k == 8, put("岚石月份"))
        .when(k == 9, put("岩泽民"))
        .when(k == 10, F.concat(put("岚石月"), F.lit("中心得到")))
        .otherwise(F.concat(put("岚石月"), F.lit("心得")))
    )
    rec = F.when(F.pmod("doc_id", F.lit(4)) == 0, "BOOK:DESC").when(F.pmod("doc_id", F.lit(4)) == 1, "INFO:NAM1").when(F.pmod("doc_id", F.lit(4)) == 2, "QUST:CNAM").otherwise("MESG:DESC")
    return documents.select(F.col("doc_id").alias("unit_id"), F.col("source").alias("plugin"), rec.alias("rec"), t.alias("source"), dest.alias("dest"))
