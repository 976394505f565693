"""Compiling, versions, over-reach, names, kinds of matches and the review queue, each against a plain reading."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexmill.functions import anchors
from lexmill.operators import contract, gate, nouns, review, workflow
from lexmill.schema import CONTRACT

WORDS = "stone stones oak the of elf elves lady ladies box boxes river's gate".split()


def units(spark, n=60, seed=3):
    rng = random.Random(seed)
    rows = [(i, f"p{i % 4}", " ".join(rng.choice(WORDS) for _ in range(rng.randrange(12))), "甲石" * (i % 3), i % 4 == 3) for i in range(n)]
    return spark.createDataFrame([*rows, (n, "p0", None, "x", None)], "unit_id bigint, plugin string, source string, dest string, frozen boolean")


FORMS = ["stone", "the stone", "stone of oak", "elf", "lady", "box", "river", "gate of the", "c++ (x)", "oak.", "of"]


def table(spark, rows, versioned=False):
    """(id, version, deleted, english) rows as terms or bans."""
    terms = spark.createDataFrame([(f"t{i}", v, d, "CONFIRMED", "FORBIDDEN_ONLY" if i % 5 == 4 else "REQUIRED", f"甲{i}-{x}", ["乙"], e) for i, v, d, e, x in rows], "term_id string, version int, deleted boolean, decision_status string, enforcement string, target string, forbidden array<string>, source string")
    terms = terms.select("*", *[F.lit(None).cast("string").alias(c) for c in ("origin", "evidence", "note")], F.lit(None).cast("struct<kind:string,accepted:array<string>,blocked_suffixes:array<string>>").alias("match"))
    bans = spark.createDataFrame([(f"b{i}", v, d, e, ["石"], f"乙{x}", "why", None, None) for i, v, d, e, x in rows], "ban_id string, version int, deleted boolean, english string, forbidden array<string>, target string, reason string, category string, unconditional boolean")
    return (terms, bans) if versioned else (terms.drop("version", "deleted"), bans.drop("version", "deleted"))


def plain(df, *columns):
    return sorted(df.select("unit_id", *columns, F.to_json("contract").alias("c")).collect(), key=lambda r: r.unit_id)


def test_few_forms_and_many_give_one_contract(spark, monkeypatch):
    u = units(spark)
    terms, bans = table(spark, [(i, 1, False, e, 0) for i, e in enumerate(FORMS)])
    forms = terms.select("term_id", "source")
    few = sorted(map(tuple, anchors.anchored_pairs(u, forms, form="term_id", english="source").collect()))
    assert few == sorted(map(tuple, anchors.joined_pairs(u, forms, form="term_id", english="source").collect())) and len(few) > 100
    held = {r.unit_id: r.source or "" for r in u.collect()}
    every = sorted((i, f"t{n}") for i, s in held.items() for n, e in enumerate(FORMS) if any(re.search(rf"(^|[^A-Za-z0-9_]){re.escape(v)}('s)?([^A-Za-z0-9_]|$)", s) for v in anchors._variants(e)))
    assert few == every
    one = plain(contract.compile_contract(u, terms, bans))
    monkeypatch.setattr(anchors, "FEW", 0)
    monkeypatch.setattr(contract, "FEW", 0)
    many = plain(contract.compile_contract(u, terms, bans))
    assert [r.unit_id for r in one] == [r.unit_id for r in many]
    import json

    for a, b in zip(one, many, strict=True):
        a, b = json.loads(a.c), json.loads(b.c)
        assert a | {"anchored": sorted(a["anchored"])} == b | {"anchored": sorted(b["anchored"])}


def test_anchored_forms_decide_as_the_text_does(spark):
    u = units(spark)
    terms, bans = table(spark, [(i, 1, False, e, 0) for i, e in enumerate(FORMS)])
    got = contract.compile_contract(u, terms, bans)
    alone = got.withColumn("contract", F.col("contract").withField("anchored", F.lit(None).cast("array<string>")))
    rows = lambda df: sorted(map(str, gate.violations(df).collect()))
    assert rows(got) == rows(alone) and len(rows(got)) > 50


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_recompiling_what_changed_equals_compiling_all(spark, seed):
    rng, u = random.Random(seed), units(spark, seed=seed)
    rows = [(i, 1, False, e, 0) for i, e in enumerate(FORMS)]
    for i, e in enumerate(FORMS):
        edit = rng.choice(["no", "no", "no", "text", "form", "gone"])
        rows += [] if edit == "no" else [(i, 2, edit == "gone", rng.choice(FORMS) if edit == "form" else e, 1)]
    rows += [(50, 2, False, rng.choice(FORMS), 0), (51, 3, False, "stone", 0)]
    terms, bans = table(spark, rows, versioned=True)
    at = lambda v: (contract.as_of(terms, v, "term_id"), contract.as_of(bans, v, "ban_id"))
    first = contract.compile_contract(u, *at(1)).where("unit_id % 7 <> 0").select("unit_id", F.lit(1).cast("bigint").alias("version"), "contract")
    got = plain(contract.recompile(u, first, terms, bans, 1, 2), "version")
    live = contract.compile_contract(u.where("not coalesce(frozen, false)"), *at(2)).withColumn("version", F.lit(2).cast("bigint"))
    cold = first.join(u.where("frozen").select("unit_id"), "unit_id", "left_semi")
    assert got == sorted(plain(live, "version") + plain(cold, "version"), key=lambda r: r.unit_id)


def test_versions_of_a_table(spark):
    df = spark.createDataFrame([("a", 1, False, 1), ("a", 3, None, 3), ("b", 1, None, 1), ("b", 2, True, 1), ("c", 4, False, 1)], "k string, version int, deleted boolean, x int")
    got = lambda v: sorted(tuple(r) for r in contract.as_of(df, v, "k").collect())
    assert got(0) == [] and got(1) == [("a", 1), ("b", 1)] and got(2) == [("a", 1)] and got(4) == [("a", 3), ("c", 1)]


def test_over_reach_is_the_longest_term_around(spark):
    u = spark.createDataFrame([(1, "old stone gate"), (2, "old stone gate, stone"), (3, "stone"), (4, "the old stone gates of oak; stone gate's"), (5, "stones"), (6, None), (7, "a old stone gate_ stone")], "unit_id bigint, source string")
    terms = spark.createDataFrame([("s", "REQUIRED", "stone"), ("g", "REQUIRED", "stone gate"), ("o", "REQUIRED", "old stone gate"), ("x", "FORBIDDEN_ONLY", "the old stone gates of oak")], "term_id string, enforcement string, source string")
    got = sorted(tuple(r) for r in contract.over_reach(u, terms).select("unit_id", "term_id", "longer_id", "severity").collect())
    assert got == [(1, "g", "o", "WARNING"), (1, "s", "o", "WARNING"), (2, "g", "o", "WARNING"), (4, "s", "g", "WARNING")]


def test_kinds_of_matches(spark):
    term = lambda kind: {"target": "石", "enforcement": "REQUIRED", "match": {"kind": kind, "accepted": ["石"], "blocked_suffixes": ["头"]}}
    rows = [(k, "A stone.", d, {"bindings": [{"term_id": "x", "required": True}], "terms": {"x": term(k)}}) for k in ("contains_phrase", "forms", "begins", "odd", None) for d in ("石头。", "木石。", "木。")]
    import json

    df = spark.createDataFrame([(k, s, d, json.dumps(c, ensure_ascii=False)) for k, s, d, c in rows], "kind string, source string, dest string, c string").withColumn("contract", F.from_json("c", CONTRACT))
    gate.register_match("begins", lambda dest, accepted: F.exists(accepted, lambda a: F.startswith(dest, a)))
    try:
        got = {(r.kind, r.dest): r.codes for r in gate.gate(df).collect()}
    finally:
        del gate.MATCH_KINDS["begins"]
    assert got["contains_phrase", "石头。"] == [] and got["forms", "石头。"] == ["TERM003"] and got[None, "石头。"] == []
    assert got["contains_phrase", "木。"] == got["forms", "木。"] == got["begins", "木。"] == got["begins", "木石。"] == ["TERM001"] and got["begins", "石头。"] == []
    assert got["odd", "木。"] == got["odd", "石头。"] == ["CONTRACT001"]


def test_candidate_names(spark):
    texts = {"They met Lord Aren's men.": ["Lord Aren"], "Aren came. Now and then Aren left": ["Aren"], "Aren came. Aren left.": [], "The Lady of the Lake": ["Lady of the Lake"], "": [], "“Gold!” said Mira-Lu.": ["Mira-Lu"]}
    df = spark.createDataFrame([(t,) for t in texts], "source string")
    assert {r.source: r.n for r in df.select("source", nouns.candidates("source").alias("n")).collect()} == texts
    assert spark.range(1).select(nouns.candidates(F.lit(None).cast("string"))).first()[0] == []


def test_names_are_consistent(spark):
    rows = [(1, "Lord Aren", "艾"), (2, "I saw Lord Aren.", "艾来了"), (3, "I saw Lord Aren.", "他来了"), (4, "Lady Bel", "贝"), (5, "Lady Bel", "贝"), (6, "Lady Bel", "蓓"), (7, "with Lady Bel", "蓓"), (8, "by King Cor", "科"), (9, "Old Dun", "敦"), (10, "an Old Dun", "敦儿")]
    got = {r.name: (r.uses, r.renderings, r.rendering, r.missing, r.verdict) for r in nouns.name_consistency(spark.createDataFrame(rows, "unit_id bigint, source string, dest string")).collect()}
    assert got == {"Lord Aren": (3, 1, "艾", 1, "MISSING"), "Lady Bel": (4, 2, "贝", 2, "INCONSISTENT"), "King Cor": (1, 0, None, 0, "UNKNOWN"), "Old Dun": (2, 1, "敦", 0, "OK")}


def test_families_carry_their_sign(spark):
    rows = [(1, "in Highmoon", "高月月"), (2, "in Highmoon", "高月"), (3, "in Highmoon", "高月月和高月"), (4, "on Firstday", "首日"), (5, "on Firstday", "日"), (6, "Highmoon", "Highmoon"), (7, "low moon", "高月")]
    families = spark.createDataFrame([("month", "Highmoon", "高月月", "月"), ("day", "Firstday", "首日", None)], "family string, english string, target string, sign string")
    got = sorted(tuple(r) for r in nouns.family_audit(spark.createDataFrame(rows, "unit_id bigint, source string, dest string"), families).select("unit_id", "family", "unsigned", "lacks").collect())
    assert got == [(2, "month", 1, True), (3, "month", 1, False), (5, "day", 0, True)]


def test_nothing_closes_itself(spark):
    items = lambda *rows: spark.createDataFrame(list(rows), "kind string, key string, severity string, detail string")
    says = lambda *rows: spark.createDataFrame(list(rows), "kind string, key string, detail string, by string")
    state = lambda q: {(r.kind, r.key): (r.severity, r.detail, r.opened, r.closed_by) for r in q.collect()}
    one = review.fold(None, [items(("w", "1", "low", "a"), ("w", "2", "high", "a"), ("w", "2", "low", "z")), items(("d", "1", "medium", ""))], says(("w", "1", "a", "ann"), ("w", "9", "a", "ann"), ("d", "1", "other", "ann"), ("w", "2", "a", None)), 1)
    assert state(one) == {("w", "1"): ("low", "a", 1, "ann"), ("w", "2"): ("high", "a", 1, None), ("d", "1"): ("medium", "", 1, None)}
    two = review.fold(one, [items(("w", "3", "low", "n"))], says(("d", "1", "", "zoe"), ("d", "1", None, "bob")), 2)
    assert state(two) == {**state(one), ("d", "1"): ("medium", "", 1, "bob"), ("w", "3"): ("low", "n", 2, None)}
    three = review.fold(two, [items(("w", "1", "low", "b"), ("d", "1", "medium", ""))], says(), 3)
    assert state(three) == {**state(two), ("w", "1"): ("low", "b", 3, None)}
    ready = lambda q, *s: workflow.release_ready(review.open_issues(q, *s)).first()
    assert tuple(ready(three)) == (False, "review") and tuple(ready(three, "medium")) == (True, "")


def test_items_of_what_is_found(spark):
    cases = spark.createDataFrame([("a", (True,), ("s",)), ("b", (False,), ("s",)), ("c", None, ("s",))], "case_id string, assertion struct<golden_review:boolean>, input struct<source:string>")
    assert [tuple(r) for r in review.golden_items(cases).collect()] == [("golden", "a", "medium", "s")]
    found = spark.createDataFrame([(1, "TRUNC001", "WARNING", None, "x"), (1, "TRUNC001", "WARNING", None, "y"), (2, "TERM001", "FAIL", "t", None)], "unit_id int, code string, severity string, term_id string, form string")
    assert [tuple(r) for r in review.warning_items(found).collect()] == [("warning", "1|TRUNC001|", "low", "x,y")]
    decided = spark.createDataFrame([("t1", "REVIEW", None), ("t2", "KEEP", "KEEP to X"), ("t3", "KEEP", None)], "term_id string, status string, error string")
    assert sorted(tuple(r) for r in review.decision_items(decided).collect()) == [("decision", "t1", "high", "REVIEW"), ("decision", "t2", "medium", "KEEP to X")]


def test_few_patterns_and_many_give_the_same_hits(spark, monkeypatch):
    rng = random.Random(5)
    texts = spark.createDataFrame([(i, "".join(rng.choice("甲乙丙ab ") for _ in range(rng.randrange(20)))) for i in range(80)] + [(80, None), (81, "")], "k int, t string")
    patterns = spark.createDataFrame([(p,) for p in ("甲", "甲乙", "ab ", "a", "丙丙", "乙a甲", "", None, "甲", "q")], "p string")
    few = sorted(map(tuple, workflow.pattern_hits(texts, patterns, "k", "t", "p").collect()))
    monkeypatch.setattr(workflow, "FEW_PATTERNS", 0)
    assert few == sorted(map(tuple, workflow.pattern_hits(texts, patterns, "k", "t", "p").collect())) and len(few) > 60


def test_exemptions_of_any_number(spark, monkeypatch):
    u = units(spark)
    terms, bans = table(spark, [(i, 1, False, e, 0) for i, e in enumerate(FORMS)])
    rows = [(e, "石", "r", (["甲"] if i % 2 else [], [], [])) for i, e in enumerate(FORMS)] + [("nowhere", "石", "r", ([], [], []))]
    exemptions = spark.createDataFrame(rows, "english string, forbidden string, reason string, scope struct<dest_left:array<string>,dest_right:array<string>,source_contains:array<string>>")
    got = lambda: sorted(map(str, gate.violations(contract.compile_contract(u, terms, bans, exemptions), gate.GateConfig(rules=("global_ban",))).collect()))
    few = got()
    monkeypatch.setattr(contract, "MOST_UNCONDITIONAL", 3)
    assert few == got() and any("WARNING" in v for v in few)


def test_unconditional_bans_of_any_number(spark, monkeypatch):
    u = units(spark)
    terms, bans = table(spark, [(i, 1, False, e, 0) for i, e in enumerate(FORMS)])
    more = [(f"u{i}", f"none {i}", [f, "石甲"], t, "r", None, True) for i, (f, t) in enumerate([("石", ""), ("甲", "甲石"), ("石甲石", ""), ("丁", ""), ("x", "")])]
    bans = bans.unionByName(spark.createDataFrame(more, bans.schema))
    got = lambda: sorted(map(str, gate.violations(contract.compile_contract(u, terms, bans), gate.GateConfig(rules=("global_ban",))).collect()))
    monkeypatch.setattr(contract, "FEW", 0)
    monkeypatch.setattr(anchors, "FEW", 0)
    literal = got()
    monkeypatch.setattr(contract, "MOST_UNCONDITIONAL", 2)
    assert literal == got() and sum("none" in v for v in literal) > 40
