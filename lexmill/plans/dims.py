"""Small literal tables that queries share: terms, bans and exemptions over derived units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: term_id, enforcement, source, target, forbidden, accepted, blocked suffixes
TERMS = [
    ("t.month", "REQUIRED", "that", "岚石月", ["岚石"], ["岚石月"], ["份"]),
    ("t.follow", "REQUIRED", "with", "跟随", ["尾随"], ["跟随", "随同"], []),
    ("t.elf", "FORBIDDEN_ONLY", "this", "林谷人", ["岩泽民"], ["林谷人"], []),
]
#: ban_id, english, forbidden, target, reason, unconditional
BANS = [
    ("b.month", "that", ["岚石"], "岚石月", "month names end in the month sign", False),
    ("b.memory", "anachronism", ["心得"], "", "computer words", True),
    ("b.people", "from", ["岩择民"], "岩泽民", "name of a people", False),
    ("b.wood", "wooden gate", ["岩泽民"], "林谷人", "other name of a people", True),
]
#: english, forbidden, left, right, source_contains
EXEMPTIONS = [("anachronism", "心得", ["中"], ["到"], [])]


def terms(spark: SparkSession) -> DataFrame:
    rows = [(i, "CONFIRMED", e, t, f, ("forms" if b else "contains_phrase", a, b), "OFFICIAL", s, None, None) for i, e, s, t, f, a, b in TERMS]
    return spark.createDataFrame(rows, "term_id string, decision_status string, enforcement string, target string, forbidden array<string>, match struct<kind:string,accepted:array<string>,blocked_suffixes:array<string>>, origin string, source string, evidence string, note string")


def bans(spark: SparkSession) -> DataFrame:
    rows = [(i, e, f, t, r, None, u) for i, e, f, t, r, u in BANS]
    return spark.createDataFrame(rows, "ban_id string, english string, forbidden array<string>, target string, reason string, category string, unconditional boolean")


def exemptions(spark: SparkSession) -> DataFrame:
    rows = [(e, f, "crosses words", (left, right, src)) for e, f, left, right, src in EXEMPTIONS]
    return spark.createDataFrame(rows, "english string, forbidden string, reason string, scope struct<dest_left:array<string>,dest_right:array<string>,source_contains:array<string>>")
