"""The queue of what people have to decide. Items are opened by what is found, and closed by decisions alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ITEM = ["kind", "key", "severity", "detail"]


def items(kind: str, rows: DataFrame, key: Column | str, severity: Column | str, detail: Column | str) -> DataFrame:
    """(kind, key, severity, detail) of rows that ask for a decision."""
    named = lambda c: F.col(c) if isinstance(c, str) else c
    return rows.select(F.lit(kind).alias("kind"), named(key).cast("string").alias("key"), named(severity).alias("severity"), F.coalesce(named(detail).cast("string"), F.lit("")).alias("detail"))


def golden_items(cases: DataFrame) -> DataFrame:
    """Translator cases (case_id, assertion, input) that ask for a look at the wording."""
    wanted = cases.where(F.coalesce(F.col("assertion.golden_review"), F.lit(False)))
    return items("golden", wanted, "case_id", F.lit("medium"), F.col("input.source"))


def warning_items(violations: DataFrame, unit: str = "unit_id") -> DataFrame:
    """Warnings of the gate, one item for a unit, code and term."""
    key = F.concat_ws("|", F.col(unit).cast("string"), "code", F.coalesce("term_id", F.lit("")))
    one = violations.where("severity = 'WARNING'").groupBy(key.alias("key")).agg(F.array_join(F.array_sort(F.collect_set("form")), ",").alias("detail"))
    return items("warning", one, "key", F.lit("low"), "detail")


def decision_items(decisions: DataFrame, key: str = "term_id") -> DataFrame:
    """Decisions of terms (key, status, error) that stand at REVIEW, or whose change was refused."""
    asked = decisions.where("status = 'REVIEW' or error is not null")
    return items("decision", asked, key, F.when(F.col("status") == "REVIEW", "high").otherwise("medium"), F.coalesce("error", "status"))


def fold(queue: DataFrame | None, found: list[DataFrame], decided: DataFrame, turn: int) -> DataFrame:
    """The queue after a turn: (kind, key, severity, detail, opened, closed_by), one row an item.

    queue: what it was (None at first); found: items of this turn; decided: (kind, key, detail, by) - who has decided on an
    item as it stands. What isn't found any more stays open: nothing closes itself. A decision closes an item only if it
    names the detail that it has; an item that comes back with another detail is open again. Of several equal items the most
    severe counts, then the greatest detail; of several decisions the least name.
    """
    rank = F.when(F.col("severity") == "high", 2).when(F.col("severity") == "medium", 1).otherwise(0)
    new = reduce(DataFrame.unionByName, [f.select(*ITEM) for f in found])
    new = new.groupBy("kind", "key").agg(F.max(F.struct(rank.alias("r"), "detail", "severity")).alias("n")).select("kind", "key", F.col("n.severity").alias("new_severity"), F.col("n.detail").alias("new_detail"))
    if queue is None:
        queue = new.select("kind", "key", F.col("new_severity").alias("severity"), F.col("new_detail").alias("detail"), F.lit(turn).cast("bigint").alias("opened"), F.lit(None).cast("string").alias("closed_by")).where("false")
    both = queue.join(new, ["kind", "key"], "full_outer")
    fresh = F.col("new_detail").isNotNull() & ~F.col("new_detail").eqNullSafe(F.col("detail"))
    now = both.select("kind", "key", F.when(fresh, F.col("new_severity")).otherwise(F.coalesce("severity", "new_severity")).alias("severity"), F.when(fresh, F.col("new_detail")).otherwise(F.col("detail")).alias("detail"), F.when(fresh, F.lit(turn)).otherwise(F.col("opened")).cast("bigint").alias("opened"), F.when(~fresh, F.col("closed_by")).alias("closed_by"))
    names = decided.where("by is not null").groupBy("kind", "key", F.coalesce("detail", F.lit("")).alias("detail")).agg(F.min("by").alias("by"))
    got = now.join(names, ["kind", "key", "detail"], "left")
    return got.select(*ITEM, "opened", F.coalesce("closed_by", "by").alias("closed_by"))


def open_issues(queue: DataFrame, *severities: str) -> DataFrame:
    """One row (name, ok) for ``workflow.release_ready``: whether no item of these severities is open."""
    bad = queue.where(F.col("closed_by").isNull() & F.col("severity").isin(*(severities or ("high", "medium"))))
    return bad.agg((F.count("*") == 0).alias("ok")).select(F.lit("review").alias("name"), "ok")
