"""Validation of case files: missing keys, domains, layer checks, duplicates; counts and exit status."""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REQUIRED = ("case_id", "test_layer", "category", "plugin", "origin")
LAYERS = ("gate", "translator")


def missing_keys(objects: DataFrame, column: str, keys: tuple[str, ...] = REQUIRED, carry: tuple[str, ...] = ("file",)) -> DataFrame:
    """One row for each key that a JSON object lacks; a key whose value is null is there."""
    have = F.coalesce(F.json_object_keys(column), F.array().cast("array<string>"))
    lacking = F.array_except(F.array(*[F.lit(k) for k in keys]), have)
    return objects.select(*carry, F.explode(lacking).alias("key")).withColumn("error", F.concat(F.lit("missing key "), "key"))


def out_of_domain(rows: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Rows whose value is null or not allowed."""
    return rows.where(F.col(column).isNull() | ~F.col(column).isin(*allowed))


def layer_errors(case: Column) -> Column:
    """Errors of a typed case by its layer, as an array."""
    lacks = lambda c, what: F.when(c.isNull(), what)
    gate = F.array(lacks(case["input"]["source"], "input.source"), lacks(case["input"]["translation"], "input.translation"), lacks(case["input"]["contract"], "input.contract"), lacks(case["expect"]["verdict"], "expect.verdict"))
    model = F.array(lacks(case["input"]["semantic_unit"], "input.semantic_unit"), lacks(case["assertion"], "assertion"))
    return F.array_compact(F.when(case["test_layer"] == "gate", gate).when(case["test_layer"] == "translator", model).otherwise(F.array(F.lit("test_layer"))))


def duplicates(rows: DataFrame, within: list[str], key: str, order: str) -> DataFrame:
    """Every repeat of a key within a file but the first."""
    w = Window.partitionBy(*within, key).orderBy(order)
    return rows.withColumn("n", F.row_number().over(w)).where("n > 1")


def not_arrays(files: DataFrame, field: str = "cases") -> DataFrame:
    """(file, error) of parsed files (file, parsed: variant) whose field is there and is no array."""
    kind = F.schema_of_variant(F.try_variant_get("parsed", f"$.{field}", "variant"))
    bad = F.col("parsed").isNotNull() & kind.isNotNull() & ~F.startswith(kind, F.lit("ARRAY"))
    return files.where(bad).select("file", F.concat(F.lit(field), F.lit(" is no array")).alias("error"))


def per_file(cases: DataFrame, file: str = "file") -> DataFrame:
    """(file, n) cases of each file."""
    return cases.groupBy(file).agg(F.count("*").alias("n"))


def check_cases(cases: DataFrame) -> DataFrame:
    """(file, case_id, error) of typed cases."""
    c = cases.select("file", "case_id", F.struct(*[F.col(x) for x in cases.columns if x != "file"]).alias("case"))
    place = "pos" if "pos" in cases.columns else None
    layers = c.select("file", "case_id", F.explode(layer_errors(F.col("case"))).alias("what")).select("file", "case_id", F.concat(F.lit("missing "), "what").alias("error"))
    numbered = cases.select("file", "case_id", (F.col(place) if place else F.monotonically_increasing_id()).alias("at"))
    twice = duplicates(numbered, ["file"], "case_id", "at").select("file", "case_id", F.lit("duplicate case_id").alias("error"))
    return layers.unionByName(twice)


#: Hosts that a schema must not name as its own.
MADE_UP_HOSTS = ("agentskills.io",)


def schema_errors(files: DataFrame, made_up: tuple[str, ...] = MADE_UP_HOSTS) -> DataFrame:
    """(file, error) of schema files: unreadable ones, an $id that is an outer address, a $schema of a made-up host.

    An $id is a local name, so one that begins with http is wrong; what is missing is no error.
    """
    field = lambda n: F.coalesce(F.get_json_object("text", f"$['{n}']"), F.lit(""))
    named = F.lit(False)
    for host in made_up:
        named = named | F.contains(field("$schema"), F.lit(host))
    bad = F.array_compact(F.array(
        F.when(F.col("parsed").isNull(), "not JSON"),
        F.when(F.col("parsed").isNotNull() & F.startswith(field("$id"), F.lit("http")), "$id"),
        F.when(F.col("parsed").isNotNull() & named, "$schema"),
    ))
    return files.select("file", F.explode(bad).alias("error"))


def counts(rows: DataFrame, *columns: str) -> DataFrame:
    """Counts by each column and the grand total: (column, value, n)."""
    sets = rows.groupingSets([[F.col(c)] for c in columns] + [[]], *[F.col(c) for c in columns]).agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    k = len(columns)
    which = F.when(F.lit(False), "")
    value = F.when(F.lit(False), "")
    for i, c in enumerate(columns):
        mask = (1 << k) - 1 - (1 << (k - 1 - i))
        which, value = which.when(F.col("g") == mask, c), value.when(F.col("g") == mask, F.col(c).cast("string"))
    return sets.select(F.coalesce(which.otherwise(F.lit(None)), F.lit("total")).alias("column"), value.alias("value"), "n")


def exit_status(errors: DataFrame) -> DataFrame:
    """One row: 1 if there is any error, else 0."""
    return errors.agg((F.count("*") > 0).cast("int").alias("status"), F.count("*").alias("errors"))


def syntax_errors(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, line, message) of Python sources that don't compile, and of those that can't be read as UTF-8 (line 0).

    Sources are texts or raw bytes; a mark of byte order at the beginning is none of the source. Nothing is run; only
    compiling needs Python.
    """
    raw = dict(files.dtypes)[text] == "binary"

    def fault(path: str, source) -> tuple | None:
        try:
            source = bytes(source or b"").decode("utf-8-sig") if raw else (source or "").removeprefix("\ufeff")
        except UnicodeDecodeError as e:
            return path, 0, f"cannot read: {e}"
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                compile(source, path or "", "exec", dont_inherit=True)
        except (SyntaxError, ValueError) as e:
            return path, getattr(e, "lineno", None) or 0, getattr(e, "msg", None) or str(e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bad = [x for p, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if (x := fault(p, t))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in bad], pa.string()), pa.array([x[1] for x in bad], pa.int32()), pa.array([x[2] for x in bad], pa.string())], names=["path", "line", "message"])

    return files.select(F.col(path).cast("string").alias("path"), F.col(text).alias("text")).mapInArrow(run, "path string, line int, message string")
