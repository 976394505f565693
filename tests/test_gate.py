"""One failing unit and one guard for each mechanism; all texts are made up here."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from lexmill.operators import gate as g
from lexmill.operators.contract import normalise_contract
from lexmill.schema import CONTRACT


def term(target, forbidden=(), accepted=None, suffixes=(), enforcement="REQUIRED", source="Stone"):
    return {"target": target, "forbidden": list(forbidden), "enforcement": enforcement, "source": source, "match": {"kind": "forms", "accepted": list(accepted or [target]), "blocked_suffixes": list(suffixes)}}


def bound(t, required=True):
    return {"bindings": [{"term_id": "x", "required": required}], "terms": {"x": t}}


def ban(english, forbidden, target, unconditional=None):
    return {"english": english, "forbidden": forbidden, "target": target, "reason": "why", "unconditional": unconditional}


STONE = term("石心", ["石头", "石"])
MOON = {"global_bans": [ban("Moonrise", ["月升"], "月升节")]}
MEMORY = {"global_bans": [ban("anachronism", ["心得"], "", True)], "global_ban_exemptions": [{"english": "anachronism", "forbidden": "心得", "reason": "r", "scope": {"dest_left": ["中"], "dest_right": ["到"]}}]}
CROSS = {"global_bans": [ban("Redfolk", ["山民"], "红民", True), ban("Hillfolk", ["红民"], "山民", True)]}
CASES = {
    "missing": ("A Stone.", "一块木头。", bound(STONE), "FAIL", ["TERM001"]),
    "optional": ("A Stone.", "一块木头。", bound(STONE, False), "PASS", []),
    "forbidden": ("A Stone.", "一块石头。", bound(STONE), "FAIL", ["TERM001", "TERM002"]),
    "covered": ("A Stone.", "一颗石心。", bound(STONE), "PASS", []),
    "covered and bare": ("A Stone.", "石心和石。", bound(STONE), "FAIL", ["TERM002"]),
    "suffix": ("A Stone.", "石心城。", bound(term("石心", suffixes=["城"])), "FAIL", ["TERM003"]),
    "no suffix": ("A Stone.", "石心。", bound(term("石心", suffixes=["城"])), "PASS", []),
    "forbidden only": ("Old stones.", "老石头。", {"terms": {"x": term("岩", ["石头"], enforcement="FORBIDDEN_ONLY", source="stone")}}, "FAIL", ["TERM002"]),
    "forbidden only, no anchor": ("Old wood.", "老石头。", {"terms": {"x": term("岩", ["石头"], enforcement="FORBIDDEN_ONLY", source="stone")}}, "PASS", []),
    "unknown term": ("A", "甲", {"bindings": [{"term_id": "y", "required": True}]}, "FAIL", ["CONTRACT001"]),
    "ban": ("At Moonrise.", "在月升。", MOON, "FAIL", ["TERM004"]),
    "ban covered": ("At Moonrise.", "在月升节。", MOON, "PASS", []),
    "ban without anchor": ("At dawn.", "在月升。", MOON, "PASS", []),
    "ban untranslated": ("Moonrise 月升", "Moonrise 月升", MOON, "PASS", []),
    "ban split": ("Moonrise...", "月升……节", MOON, "PASS", []),
    "ban split, rest missing": ("Moonrise...", "月升……后", MOON, "FAIL", ["TERM004"]),
    "exempt": ("Within it.", "城中心得到裂痕。", MEMORY, "WARNING", []),
    "exempt does not open": ("Its memory.", "它的心得。", MEMORY, "FAIL", ["TERM004"]),
    "exempt, one bare": ("Both.", "城中心得到，心得。", MEMORY, "FAIL", ["TERM004"]),
    "cross": ("Hillfolk live here.", "山民住在这里。", CROSS, "PASS", []),
    "cross, wrong pair": ("Redfolk live here.", "山民住在这里。", CROSS, "FAIL", ["TERM004"]),
    "cross, no anchor": ("They live here.", "山民住在这里。", CROSS, "FAIL", ["TERM004"]),
    "keep": ("AuthorX", "作者", {"keep_list": ["AuthorX"]}, "FAIL", ["KEEP001"]),
    "kept": ("AuthorX", "AuthorX", {"keep_list": ["AuthorX"]}, "PASS", []),
    "global keep": ("AuthorX", "作者", {"keep": ["AuthorX"]}, "FAIL", ["KEEP002"]),
    "placeholder": ("Pay <N>.", "付钱。", {"protected_tokens": ["<N>"]}, "FAIL", ["PLACEHOLDER001"]),
    "placeholder there": ("Pay <N>.", "付<N>。", {"protected_tokens": ["<N>"]}, "PASS", []),
    "charset": ("Dragon.", "龍。", {}, "FAIL", ["CHAR001"]),
    "charset clean": ("Tower.", "瞭望塔，什么。", {}, "PASS", []),
    "interjection": ("Ah!", "哦！", {"interjection_map": {"Ah!": ["哎！"]}}, "FAIL", ["TERM002"]),
    "interjection allowed": ("Ah!", "哎！", {"interjection_map": {"Ah!": ["哎！"]}}, "PASS", []),
    "truncated": ("A long story about all the many things that were seen.", "故事……", {}, "WARNING", []),
    "ellipsis of the source": ("A long story about all the many things that were...", "故事……", {}, "PASS", []),
    "truncated behind tags": ("<b>[p] A long story about all the many things seen.", "<b>[p] 故事……", {}, "WARNING", []),
    "xml": ("<b>x</b>", "<b>甲</b", {}, "FAIL", ["XML001"]),
    "xml, left open in both": ("<font size='20'>A long tale of stone", "<font size='20'>石心的长故事", {}, "PASS", []),
    "xml, closed in dest": ("<font size='20'>A long tale of stone", "<font size='20'>石心的长故事</font>", {}, "PASS", []),
    "xml, closed in dest and cut": ("<font size='20'>A long tale of stone and wood", "<font size='20'>石……</font>", {}, "WARNING", []),
    "xml, closed twice": ("<i>A tale", "<i>故事</i></i>", {}, "FAIL", ["XML001"]),
    "xml, closed what is not open": ("<i>A tale", "<i>故事</b>", {}, "FAIL", ["XML001"]),
    "xml, closing lost": ("<i>A</i> tale", "<i>故事", {}, "FAIL", ["XML001"]),
    "xml, other attribute": ("<font size='20'>A", "<font size='24'>甲", {}, "FAIL", ["XML001"]),
    "xml, opened": ("A tale", "<i>故事</i>", {}, "FAIL", ["XML001"]),
    "xml, crossed": ("<b><i>A</i></b>", "<b><i>甲</b></i>", {}, "FAIL", ["XML001"]),
    "xml, closed crosswise": ("<b><i>A", "<b><i>甲</b></i>", {}, "FAIL", ["XML001"]),
    "xml, inner left open": ("<b><p>A</b>", "<b><p>甲</p></b>", {}, "PASS", []),
    "xml, empty": ("A<br/>b", "甲<br />乙", {}, "FAIL", ["XML001"]),
    "xml, space": ("<a  x='1'>A</a>", "<a x='1'>甲</A>", {}, "PASS", []),
    "semantic errors pass": ("Do not go.", "去吧。", {}, "PASS", []),
    "null dest": ("A", None, bound(STONE), "PASS", []),
}


@pytest.fixture(scope="module")
def units(spark):
    rows = [(n, s, d, json.dumps(c, ensure_ascii=False)) for n, (s, d, c, _, _) in CASES.items()]
    df = spark.createDataFrame(rows, "unit_id string, source string, dest string, j string")
    return df.select("unit_id", "source", "dest", F.from_json("j", CONTRACT).alias("contract"))


def test_verdicts(units):
    got = {r.unit_id: (r.verdict, r.codes) for r in g.gate(units).collect()}
    assert got == {n: (v, c) for n, (_, _, _, v, c) in CASES.items()}


def test_fold_agrees_with_table(units):
    table = {r.unit_id: (r.verdict, r.codes) for r in g.verdicts(units, g.violations(units)).collect()}
    assert table == {r.unit_id: (r.verdict, r.codes) for r in g.gate(units).collect()}


def test_warnings_stay_visible_with_reason(units):
    rows = g.violations(units).where("unit_id = 'exempt'").collect()
    assert [(r.code, r.severity, r.form, r.pos, r.reason) for r in rows] == [("TERM004", "WARNING", "心得", 3, "why")]


def test_fold_ignores_order(spark):
    kinds = [("C", s) for s in ("FAIL", "WARNING", "PASS")]
    for p in itertools.permutations(kinds):
        df = spark.createDataFrame([([{"code": c, "severity": s} for c, s in p],)], "v array<struct<code:string,severity:string>>")
        assert df.select(g.fold(F.col("v"))).first()[0] == "FAIL"


def test_exemptions_never_add(spark, units):
    without = units.withColumn("contract", F.col("contract").withField("global_ban_exemptions", F.lit(None).cast("array<struct<english:string,forbidden:string,reason:string,scope:struct<dest_left:array<string>,dest_right:array<string>,source_contains:array<string>>>>")))
    fails = lambda u: {(r.unit_id, r.form, r.pos) for r in g.violations(u).where("severity = 'FAIL' and code = 'TERM004'").collect()}
    assert fails(units) <= fails(without)


def test_own_rule(units):
    g.register_rule("length", lambda s, d, c, config: g.when(F.length(d) > 8, g.violation("LEN001", "WARNING")))
    try:
        got = g.violations(units, g.GateConfig(rules=("length",)))
        assert {r.code for r in got.collect()} == {"LEN001"}
    finally:
        del g.RULES["length"]


def test_report_and_tables(units):
    r = g.report(g.gate(units)).first()
    want = [v for _, _, _, v, _ in CASES.values()]
    assert (r.verdict, r.fail_count, r.warning_count, r.unit_count) == ("FAIL", want.count("FAIL"), want.count("WARNING"), len(want))
    tables = normalise_contract(units.withColumnRenamed("unit_id", "case_id"), contract="contract")
    assert {k: v.count() > 0 for k, v in tables.items()} == dict.fromkeys(tables, True)
