"""One query for each operator. ``QUERIES`` holds functions of (spark, folder); ``SQL`` the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.spans import occurrences, stripped
from ..functions.anchors import anchored_pairs
from ..functions.text import last_line, version, xml_index
from ..operators import contract, gate, validate, workflow
from ..schema import CONTRACT
from ..sources import derived_units, spread
from . import dims

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return keep


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _units(spark: SparkSession, d: str) -> DataFrame:
    return derived_units(spread(_t(spark, d, "documents")))


def _contracts(spark: SparkSession, d: str) -> DataFrame:
    return contract.compile_contract(_units(spark, d), dims.terms(spark), dims.bans(spark), dims.exemptions(spark))


def _violations(spark: SparkSession, d: str, *rules: str) -> DataFrame:
    return gate.violations(_contracts(spark, d), gate.GateConfig(rules=rules))


UNITS = """units AS (SELECT doc_id AS unit_id, source AS plugin,
  CASE doc_id % 4 WHEN 0 THEN 'BOOK:DESC' WHEN 1 THEN 'INFO:NAM1' WHEN 2 THEN 'QUST:CNAM' ELSE 'MESG:DESC' END AS rec,
  coalesce(text, '') AS source,
  CASE doc_id % 12 WHEN 0 THEN coalesce(text, '')
    WHEN 1 THEN replace(coalesce(text, ''), 'that', '岚石月') WHEN 2 THEN replace(coalesce(text, ''), 'that', '岚石')
    WHEN 3 THEN replace(coalesce(text, ''), 'that', '岚石月') || ' 岚石' WHEN 4 THEN replace(coalesce(text, ''), 'that', '岚石...月')
    WHEN 5 THEN replace(coalesce(text, ''), 'that', '') WHEN 6 THEN substring(coalesce(text, ''), 1, 20) || '……'
    WHEN 7 THEN replace(coalesce(text, ''), 'that', '岚石月') || '龍門開' WHEN 8 THEN replace(coalesce(text, ''), 'that', '岚石月份')
    WHEN 9 THEN replace(coalesce(text, ''), 'that', '岩泽民') WHEN 10 THEN replace(coalesce(text, ''), 'that', '岚石月') || '中心得到'
    ELSE replace(coalesce(text, ''), 'that', '岚石月') || '心得' END AS dest FROM documents)"""
_B, _E = "(^|[^A-Za-z0-9_])", "('s)?([^A-Za-z0-9_]|$)"
ANCHORS = "anchors AS (SELECT * FROM (VALUES ('that', '" + _B + "(that|thats)" + _E.replace("'", "''") + "'), ('with', '" + _B + "(with|withs)" + _E.replace("'", "''") + "'), ('this', '" + _B + "(this|thiss|thises)" + _E.replace("'", "''") + "'), ('from', '" + _B + "(from|froms)" + _E.replace("'", "''") + "')) a(english, pattern)), anchored AS (SELECT unit_id, english FROM units JOIN anchors ON regexp_matches(source, pattern))"


def _at(form: str, where: str = "") -> str:
    """SQL of (unit_id, pos) of each occurrence of a form in dest."""
    n = len(form)
    return f"(SELECT unit_id, dest, unnest(list_transform(range(1, len(parts)), lambda i: (list_sum(list_transform(parts[1:i], lambda p: length(p))) + (i - 1) * {n} + 1)::INT)) AS pos FROM (SELECT unit_id, dest, string_split(dest, '{form}') AS parts FROM units WHERE contains(dest, '{form}') {where}))"


def _has(english: str) -> str:
    return f"unit_id IN (SELECT unit_id FROM anchored WHERE english = '{english}')"


WITH = f"WITH {UNITS}, {ANCHORS}"
# An occurrence of 岚石 is inside 岚石月 where 月 follows.
BARE = f"SELECT unit_id, '岚石' AS form, pos FROM {_at('岚石')} WHERE substr(dest, pos, 3) <> '岚石月'"


@_query("scan_units", f"WITH {UNITS} SELECT rec, count(*)::BIGINT AS n_units, sum(length(source))::BIGINT AS source_chars, sum(length(dest))::BIGINT AS dest_chars FROM units GROUP BY rec")
def scan_units(spark, d):
    return _units(spark, d).groupBy("rec").agg(F.count("*").alias("n_units"), F.sum(F.length("source")).alias("source_chars"), F.sum(F.length("dest")).alias("dest_chars"))


@_query("validate_required_keys", "SELECT event_id, 'case_id' AS key, 'missing key case_id' AS error FROM events UNION ALL SELECT event_id, 'k', 'missing key k' FROM events WHERE NOT list_contains(json_keys(props), 'k')")
def validate_required_keys(spark, d):
    return validate.missing_keys(_t(spark, d, "events"), "props", ("k", "case_id"), ("event_id",))


@_query("validate_domain", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('O', 'F')")
def validate_domain(spark, d):
    return validate.out_of_domain(_t(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ("O", "F"))


@_query("validate_duplicates", "SELECT user_id, event_type, event_id, n FROM (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id)::INT AS n FROM events) WHERE n > 1")
def validate_duplicates(spark, d):
    return validate.duplicates(_t(spark, d, "events").select("user_id", "event_type", "event_id"), ["user_id"], "event_type", "event_id")


@_query("stats_by_category", "SELECT lang, source, count(*)::BIGINT AS n FROM documents GROUP BY ALL")
def stats_by_category(spark, d):
    return _t(spark, d, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))


@_query("stats_grouping_sets", "SELECT CASE WHEN grouping(lang) = 0 THEN 'lang' WHEN grouping(source) = 0 THEN 'source' ELSE 'total' END AS \"column\", coalesce(lang, source) AS value, count(*)::BIGINT AS n FROM documents GROUP BY GROUPING SETS ((lang), (source), ())")
def stats_grouping_sets(spark, d):
    return validate.counts(_t(spark, d, "documents"), "lang", "source")


@_query("exit_status", "SELECT (count(*) > 0)::INT AS status, count(*)::BIGINT AS errors FROM orders WHERE o_orderstatus NOT IN ('O', 'F')")
def exit_status(spark, d):
    return validate.exit_status(validate.out_of_domain(_t(spark, d, "orders"), "o_orderstatus", ("O", "F")))


MISSING = f"SELECT unit_id, 't.month' AS term_id, '岚石月' AS expected FROM units WHERE {_has('that')} AND NOT contains(dest, '岚石月') UNION ALL SELECT unit_id, 't.follow', '跟随' FROM units WHERE {_has('with')} AND NOT contains(dest, '跟随') AND NOT contains(dest, '随同')"


@_query("term001_missing", f"{WITH} {MISSING}")
def term001_missing(spark, d):
    return _violations(spark, d, "required_term").select("unit_id", "term_id", "expected")


@_query("term002_forbidden", f"{WITH} SELECT * FROM ({BARE}) WHERE {_has('that')}")
def term002_forbidden(spark, d):
    return _violations(spark, d, "forbidden_form").select("unit_id", "form", "pos")


@_query("term002_covered_exempt", f"{WITH} SELECT unit_id, len(string_split(dest, '岚石'))::BIGINT - 1 AS occurrences FROM units WHERE {_has('that')} AND contains(dest, '岚石') AND unit_id NOT IN (SELECT unit_id FROM ({BARE}))")
def term002_covered_exempt(spark, d):
    """Units with a forbidden form whose every occurrence lies inside the target."""
    u = _contracts(spark, d).where("size(contract.bindings) > 0").where(F.exists("contract.bindings", lambda b: b["term_id"] == "t.month"))
    u = u.withColumn("n", F.size(occurrences("dest", F.lit("岚石")))).where("n > 0")
    return gate.gate(u, gate.GateConfig(rules=("forbidden_form",))).where("verdict = 'PASS'").select("unit_id", F.col("n").cast("bigint").alias("occurrences"))


FORBIDDEN_ONLY = f"SELECT unit_id, '岩泽民' AS form, pos FROM {_at('岩泽民')} WHERE {_has('this')}"


@_query("term002_forbidden_only", f"{WITH} {FORBIDDEN_ONLY}")
def term002_forbidden_only(spark, d):
    return _violations(spark, d, "forbidden_only").select("unit_id", "form", "pos")


SUFFIX = f"SELECT unit_id, '岚石月' AS form, pos FROM {_at('岚石月')} WHERE substr(dest, pos + 3, 1) = '份' AND {_has('that')}"


@_query("term003_blocked_suffix", f"{WITH} {SUFFIX}")
def term003_blocked_suffix(spark, d):
    return _violations(spark, d, "blocked_suffix").select("unit_id", "form", "pos")


MONTH_BAN = f"SELECT unit_id, form, pos FROM ({BARE}) b JOIN (SELECT unit_id AS u, dest, source FROM units) x ON b.unit_id = x.u WHERE dest <> source AND {_has('that')} AND NOT regexp_matches(substr(dest, pos + 2, 200), '^([.][.]+|…+)月')"


@_query("term004_global_ban", f"{WITH} {MONTH_BAN}")
def term004_global_ban(spark, d):
    return _violations(spark, d, "global_ban").where("term_id = 'that'").select("unit_id", "form", "pos")


MEMORY = f"SELECT unit_id, '心得' AS form, pos, dest FROM {_at('心得', 'AND dest <> source')}"
SCOPED = f"SELECT unit_id, CASE WHEN bool_and(pos > 1 AND substr(dest, pos - 1, 1) = '中' AND substr(dest, pos + 2, 1) = '到') THEN 'WARNING' ELSE 'FAIL' END AS severity, count(*)::BIGINT AS n FROM ({MEMORY}) GROUP BY unit_id"


@_query("term004_unconditional", f"{WITH} SELECT unit_id, form, pos FROM ({MEMORY})")
def term004_unconditional(spark, d):
    return _violations(spark, d, "global_ban").where("term_id = 'anachronism'").select("unit_id", "form", "pos")


CROSS = f"SELECT unit_id, '岩泽民' AS form, pos FROM {_at('岩泽民', 'AND dest <> source')} WHERE NOT {_has('from')}"


@_query("term004_cross_exempt", f"{WITH} {CROSS}")
def term004_cross_exempt(spark, d):
    return _violations(spark, d, "global_ban").where("term_id = 'wooden gate'").select("unit_id", "form", "pos")


@_query("term004_scoped_exempt", f"{WITH} {SCOPED}")
def term004_scoped_exempt(spark, d):
    return _violations(spark, d, "global_ban").where("term_id = 'anachronism'").groupBy("unit_id", "severity").agg(F.count("*").alias("n"))


KEPT = ["NATION_1", "NATION_4", "NATION_7", "NATION_12"]
NAMES = "names AS (SELECT n_nationkey::BIGINT AS unit_id, n_name AS source, CASE n_nationkey % 3 WHEN 0 THEN n_name ELSE '国' || n_nationkey END AS dest FROM nation)"


def _names(spark, d):
    n = F.col("n_nationkey")
    return _t(spark, d, "nation").select(n.cast("bigint").alias("unit_id"), F.col("n_name").alias("source"), F.when(n % 3 == 0, F.col("n_name")).otherwise(F.concat(F.lit("国"), n)).alias("dest"))


@_query("keep001", f"WITH {NAMES} SELECT unit_id, 'KEEP001' AS code, source AS expected FROM names WHERE source IN ({', '.join(repr(k) for k in KEPT)}) AND dest <> source")
def keep001(spark, d):
    u = contract.compile_contract(_names(spark, d), dims.terms(spark), keep=KEPT)
    return gate.violations(u, gate.GateConfig(rules=("keep",))).select("unit_id", "code", "expected")


MARKUP = "markup AS (SELECT page_id AS unit_id, coalesce(html, '') AS source, CASE page_id % 3 WHEN 0 THEN coalesce(html, '') WHEN 1 THEN replace(coalesce(html, ''), '<b>', '') ELSE replace(coalesce(html, ''), '<article>', '<section>') || '%s' END AS dest FROM pages)"


def _markup(spark, d):
    h, k = F.coalesce("html", F.lit("")), F.pmod("page_id", F.lit(3))
    dest = F.when(k == 0, h).when(k == 1, F.replace(h, F.lit("<b>"), F.lit(""))).otherwise(F.concat(F.replace(h, F.lit("<article>"), F.lit("<section>")), F.lit("%s")))
    return _t(spark, d, "pages").select(F.col("page_id").alias("unit_id"), h.alias("source"), dest.alias("dest"))


@_query("placeholder001", f"WITH {MARKUP} SELECT unit_id, tag AS form FROM (SELECT unit_id, dest, unnest(list_distinct(regexp_extract_all(source, '<(?:b|article)>'))) AS tag FROM markup) WHERE NOT contains(dest, tag)")
def placeholder001(spark, d):
    u = contract.compile_contract(_markup(spark, d), dims.terms(spark), protected={"tag": "<(?:b|article)>"})
    return gate.violations(u, gate.GateConfig(rules=("placeholder",))).select("unit_id", "form")


@_query(
    "placeholder_tag_audit",
    f"""WITH {MARKUP}, s AS (SELECT unit_id, tag, count(*) AS n FROM (SELECT unit_id, unnest(regexp_extract_all(source, '<[^>]+>')) AS tag FROM markup) GROUP BY ALL),
  d AS (SELECT unit_id, tag, count(*) AS n FROM (SELECT unit_id, unnest(regexp_extract_all(dest, '<[^>]+>')) AS tag FROM markup) GROUP BY ALL),
  lost AS (SELECT s.unit_id, string_agg(s.tag, ' ' ORDER BY s.tag) AS lost FROM s LEFT JOIN d ON s.unit_id = d.unit_id AND s.tag = d.tag WHERE coalesce(d.n, 0) < s.n GROUP BY s.unit_id)
  SELECT m.unit_id, coalesce(lost, '') AS lost, (len(regexp_extract_all(source, '%[sd]')) - len(regexp_extract_all(dest, '%[sd]')))::BIGINT AS format_gap FROM markup m LEFT JOIN lost USING (unit_id) WHERE lost IS NOT NULL OR len(regexp_extract_all(source, '%[sd]')) <> len(regexp_extract_all(dest, '%[sd]'))""",
)
def placeholder_tag_audit(spark, d):
    return workflow.token_audit(_markup(spark, d)).select("unit_id", F.array_join(F.array_sort("lost"), " ").alias("lost"), "format_gap")


@_query("char001", f"WITH {UNITS} SELECT unit_id, 'CHAR001' AS code, '龍門開' AS form FROM units WHERE contains(dest, '龍門開')")
def char001(spark, d):
    return _violations(spark, d, "charset").select("unit_id", "code", "form")


@_query("interjection", "SELECT r_regionkey::BIGINT AS unit_id, r_name AS source, '哎！|哎呀！' AS expected FROM region WHERE r_name IN ('ASIA', 'AFRICA', 'EUROPE') AND r_regionkey % 2 = 0")
def interjection(spark, d):
    k = F.col("r_regionkey")
    u = _t(spark, d, "region").select(k.cast("bigint").alias("unit_id"), F.col("r_name").alias("source"), F.when(k % 2 == 0, "哟！").otherwise("哎呀！").alias("dest"))
    u = contract.compile_contract(u, dims.terms(spark), interjections={n: ["哎！", "哎呀！"] for n in ("ASIA", "AFRICA", "EUROPE")})
    return gate.violations(u, gate.GateConfig(rules=("interjection",))).select("unit_id", F.col("term_id").alias("source"), "expected")


_STRIP = r"trim(regexp_replace({}, '<[^>]+>|\[[^\]]+\]', '', 'g'))"
_S, _D = _STRIP.format("source"), _STRIP.format("dest")
TRUNC = f"SELECT unit_id FROM units WHERE regexp_matches({_D}, '(…|[.][.]+)$') AND NOT regexp_matches({_S}, '(…|[.][.]+)$') AND length({_D}) < length({_S}) * 0.35"


@_query("trunc001", f"WITH {UNITS} SELECT unit_id, 'TRUNC001' AS code, 'WARNING' AS severity FROM ({TRUNC})")
def trunc001(spark, d):
    return _violations(spark, d, "truncation").select("unit_id", "code", "severity")


CODES = f"""codes AS (
  SELECT DISTINCT unit_id, 'TERM001' AS code, 2 AS s FROM ({MISSING}) UNION SELECT unit_id, 'TERM002', 2 FROM ({BARE}) WHERE {_has('that')}
  UNION SELECT unit_id, 'TERM002', 2 FROM ({FORBIDDEN_ONLY}) UNION SELECT unit_id, 'TERM003', 2 FROM ({SUFFIX}) UNION SELECT unit_id, 'TERM004', 2 FROM ({MONTH_BAN})
  UNION SELECT unit_id, 'TERM004', 2 FROM ({CROSS}) UNION SELECT unit_id, 'TERM004', CASE severity WHEN 'FAIL' THEN 2 ELSE 1 END FROM ({SCOPED})
  UNION SELECT unit_id, 'CHAR001', 2 FROM units WHERE contains(dest, '龍門開') UNION SELECT unit_id, 'TRUNC001', 1 FROM ({TRUNC})),
folded AS (SELECT u.unit_id, CASE max(s) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARNING' ELSE 'PASS' END AS verdict, coalesce(string_agg(DISTINCT code, ',' ORDER BY code) FILTER (s = 2), '') AS codes FROM units u LEFT JOIN codes USING (unit_id) GROUP BY u.unit_id)"""
_RULES = ("required_term", "forbidden_form", "forbidden_only", "blocked_suffix", "global_ban", "charset", "truncation")


def _gated(spark, d):
    return gate.gate(_contracts(spark, d), gate.GateConfig(rules=_RULES))


@_query("verdict_fold", f"{WITH}, {CODES} SELECT * FROM folded")
def verdict_fold(spark, d):
    return _gated(spark, d).select("unit_id", "verdict", F.array_join("codes", ",").alias("codes"))


@_query("verdict_table", f"{WITH}, {CODES} SELECT * FROM folded")
def verdict_table(spark, d):
    """The same verdicts from a table of violations."""
    u = _contracts(spark, d)
    return gate.verdicts(u, gate.violations(u, gate.GateConfig(rules=_RULES))).select("unit_id", "verdict", F.array_join("codes", ",").alias("codes"))


@_query("gate_report_summary", f"{WITH}, {CODES} SELECT CASE max(CASE verdict WHEN 'FAIL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARNING' ELSE 'PASS' END AS verdict, count(*) FILTER (verdict = 'FAIL')::BIGINT AS fail_count, count(*) FILTER (verdict = 'WARNING')::BIGINT AS warning_count, count(*)::BIGINT AS unit_count FROM folded")
def gate_report_summary(spark, d):
    return gate.report(_gated(spark, d))


@_query("translator_assertions", "SELECT conv_id, turn, (contains(text, 'th') AND contains(text, 'e') AND NOT contains(text, 'que')) AS passed FROM conversations")
def translator_assertions(spark, d):
    lists = (F.array(F.lit("th"), F.lit("e")), F.array(F.lit("que")))
    return _t(spark, d, "conversations").select("conv_id", "turn", gate.assertions(F.col("text"), *lists).alias("passed"))


@_query("auto_bind", f"{WITH} SELECT unit_id, CASE english WHEN 'that' THEN 't.month' ELSE 't.follow' END AS term_id, english AS source_span FROM anchored WHERE english IN ('that', 'with')")
def auto_bind(spark, d):
    return contract.auto_bind(_units(spark, d), dims.terms(spark)).select("unit_id", "term_id", "source_span")


@_query("anchored_pairs", f"{WITH} SELECT english, count(*)::BIGINT AS n_units FROM anchored GROUP BY english")
def anchor_counts(spark, d):
    forms = spark.createDataFrame([("that",), ("with",), ("this",), ("from",)], "english string")
    return anchored_pairs(_units(spark, d), forms, form="english").groupBy("english").agg(F.count("*").alias("n_units"))


WARNINGS = "warnings AS (SELECT event_id, regexp_extract(label, 'xml-index:([0-9]+)', 1)::BIGINT AS xml_index FROM (SELECT event_id, 'xml-index:' || event_id AS label FROM events))"


@_query("warning_triage", f"WITH {UNITS}, {WARNINGS} SELECT xml_index, CASE WHEN source IS NULL THEN 'NOT FOUND' WHEN NOT contains(source, 'that') THEN 'IGNORE' WHEN contains(dest, '岚石月') THEN 'FALSE POSITIVE' ELSE 'REVIEW' END AS triage FROM warnings LEFT JOIN units ON xml_index = unit_id")
def warning_triage(spark, d):
    w = _t(spark, d, "events").select(xml_index(F.concat(F.lit("xml-index:"), "event_id")).alias("xml_index"), F.lit("t.month").alias("term_id"), F.lit("岚石月").alias("expected"))
    return contract.triage(w, _units(spark, d), dims.terms(spark)).select("xml_index", "triage")


PATTERNS = ["岚石月", "岚石", "月", "心得", "龍門", "龙", "浅滩"]
_VALUES = ", ".join(f"('{p}')" for p in PATTERNS)


@_query("term_hit_counts_zero_filled", f"WITH {UNITS} SELECT term, count(unit_id)::BIGINT AS n FROM (VALUES {_VALUES}) t(term) LEFT JOIN units ON contains(dest, term) GROUP BY term")
def term_hit_counts(spark, d):
    return workflow.term_hits(spark.createDataFrame([(p,) for p in PATTERNS], "term string"), _units(spark, d), "unit_id", "dest")


@_query("pattern_hits", f"WITH {UNITS} SELECT unit_id, pattern FROM (VALUES {_VALUES}) t(pattern) JOIN units ON contains(dest, pattern)")
def pattern_hits(spark, d):
    return workflow.pattern_hits(_units(spark, d), spark.createDataFrame([(p,) for p in PATTERNS], "pattern string"), "unit_id", "dest", "pattern")


@_query("title_expectation_match", f"WITH {NAMES} SELECT unit_id, CASE WHEN unit_id % 5 = 4 THEN 'UNKNOWN' WHEN dest = expected THEN CASE WHEN expected = source THEN 'KEEP' ELSE 'MATCH' END ELSE 'MISMATCH' END AS result FROM (SELECT *, CASE WHEN unit_id % 2 = 0 THEN source ELSE '国' || unit_id END AS expected FROM names)")
def title_expectation_match(spark, d):
    n = _names(spark, d)
    expected = n.where("unit_id % 5 <> 4").select("source", F.when(F.col("unit_id") % 2 == 0, F.col("source")).otherwise(F.concat(F.lit("国"), "unit_id")).alias("expected"))
    return workflow.expectations(n, expected).select("unit_id", "result")


@_query("top3_per_rec", f"WITH {UNITS} SELECT rec, unit_id, place FROM (SELECT rec, unit_id, row_number() OVER (PARTITION BY rec ORDER BY length(source) DESC, unit_id)::INT AS place FROM units) WHERE place <= 3")
def top3_per_rec(spark, d):
    u = _units(spark, d).select("rec", "unit_id", F.length("source").alias("n"))
    return workflow.top_per_group(u, "rec", [F.desc("n"), "unit_id"], 3).select("rec", "unit_id", "place")


@_query("last_wins_dedup", "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def last_wins_dedup(spark, d):
    return workflow.last_wins(_t(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value"), "user_id", "ts", "event_id").select("user_id", "event_id", "event_type", "value")


@_query("header_block_parse", "SELECT c_custkey, id, body FROM (SELECT c_custkey, 'id_' || c_custkey AS id, c_name || chr(10) || ' more ' || c_mktsegment AS body FROM customer UNION ALL SELECT c_custkey, c_nationkey::VARCHAR, c_mktsegment FROM customer)")
def header_block_parse(spark, d):
    c = _t(spark, d, "customer")
    text = F.concat(F.lit("preface\n"), F.lit("id_"), "c_custkey", F.lit(": old\n["), F.lit("id_"), "c_custkey", F.lit("]: "), "c_name", F.lit("\n more "), "c_mktsegment", F.lit(" \n["), "c_nationkey", F.lit("]: "), "c_mktsegment")
    return workflow.header_blocks(c.select("c_custkey", text.alias("text")), "c_custkey", "text")


@_query("first_match_suffix_join", "SELECT n_nationkey::BIGINT AS number, min(c_name) AS name FROM nation JOIN customer ON ends_with(c_name, n_nationkey::VARCHAR) GROUP BY 1")
def first_match_suffix_join(spark, d):
    numbers = _t(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("number"))
    return workflow.first_suffix_match(_t(spark, d, "customer").select(F.col("c_name").alias("name")), numbers, "name", "number")


@_query("min_version", "SELECT a AS major, b AS minor, c AS patch, p_name AS name FROM (SELECT p_size AS a, (p_partkey % 10)::INT AS b, (p_partkey % 7)::INT AS c, p_name FROM part) WHERE (a, b, c) < (3, 10, 0) ORDER BY a, b, c, p_name LIMIT 1")
def min_version(spark, d):
    p = _t(spark, d, "part").select(version(F.concat(F.lit("Python "), "p_size", F.lit("."), F.col("p_partkey") % 10, F.lit("."), F.col("p_partkey") % 7)).alias("version"), F.col("p_name").alias("name"))
    return workflow.min_by_version(p, "version", "name", (3, 10, 0)).select("version.major", "version.minor", "version.patch", "name")


@_query(
    "artefact_union_filter",
    r"WITH a AS (SELECT 'src/' || CASE s_suppkey % 5 WHEN 0 THEN 'nul' WHEN 1 THEN '$x' || s_suppkey WHEN 2 THEN 'CON.log' ELSE s_name END AS path FROM supplier), b AS (SELECT 'src/' || CASE c_custkey % 4 WHEN 0 THEN 'nul' WHEN 1 THEN 'null.txt' ELSE 'com' || (c_custkey % 12) || '.x.y' END AS path FROM customer) SELECT path FROM (SELECT path FROM a UNION SELECT path FROM b) WHERE starts_with(split_part(path, '/', 2), '$') OR lower(split_part(split_part(path, '/', 2), '.', 1)) IN ('nul','con','aux','prn','com1','com2','com3','com4','com5','com6','com7','com8','com9')",
)
def artefact_union_filter(spark, d):
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    a = _t(spark, d, "supplier").select(F.concat(F.lit("src\\"), F.when(s % 5 == 0, "nul").when(s % 5 == 1, F.concat(F.lit("$x"), s)).when(s % 5 == 2, "CON.log").otherwise(F.col("s_name"))).alias("path"))
    b = _t(spark, d, "customer").select(F.concat(F.lit("src/"), F.when(c % 4 == 0, "nul").when(c % 4 == 1, "null.txt").otherwise(F.concat(F.lit("com"), c % 12, F.lit(".x.y")))).alias("path"))
    return workflow.redirect_artefacts(a, b)


@_query("plan_gaps", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def plan_gaps(spark, d):
    done = _t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return workflow.gaps(_t(spark, d, "customer").select("c_custkey"), done, "c_custkey")


@_query("plan_orphans", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def plan_orphans(spark, d):
    return workflow.gaps(_t(spark, d, "documents").select("doc_id"), _t(spark, d, "labels"), "doc_id")


@_query("coverage_rollup", f"WITH {UNITS} SELECT plugin, rec, count(*)::BIGINT AS total, count(quality)::BIGINT AS done, count(quality)::DOUBLE / count(*) AS ratio FROM units LEFT JOIN labels ON unit_id = doc_id GROUP BY ROLLUP (plugin, rec)")
def coverage_rollup(spark, d):
    l = _t(spark, d, "labels").select(F.col("doc_id").alias("unit_id"), F.lit("TRANSLATED").alias("status"))
    return workflow.coverage(_units(spark, d).join(l, "unit_id", "left"), "plugin", "rec")


@_query("release_gate", "SELECT (g = 0 AND o = 0 AND f = 0) AS ready, concat_ws(',', CASE WHEN f > 0 THEN 'failed' END, CASE WHEN g > 0 THEN 'gaps' END, CASE WHEN o > 0 THEN 'orphans' END) AS open FROM (SELECT (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS g, (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS o, (SELECT count(*) FROM labels WHERE quality = 0) AS f)")
def release_gate(spark, d):
    docs, labels = _t(spark, d, "documents").select("doc_id"), _t(spark, d, "labels")
    ok = lambda name, bad: bad.agg((F.count("*") == 0).alias("ok")).select(F.lit(name).alias("name"), "ok")
    checks = ok("gaps", workflow.gaps(docs, labels, "doc_id")).unionByName(ok("orphans", workflow.gaps(labels.select("doc_id"), docs, "doc_id"))).unionByName(ok("failed", labels.where("quality = 0")))
    return workflow.release_ready(checks)


@_query("record_type_routing", f"WITH {UNITS} SELECT CASE split_part(rec, ':', 1) WHEN 'INFO' THEN 'dialogue' WHEN 'QUST' THEN 'quest' WHEN 'BOOK' THEN 'book' WHEN 'MESG' THEN 'message' ELSE 'item' END AS kind, count(*)::BIGINT AS n FROM units GROUP BY 1")
def record_type_routing(spark, d):
    return _units(spark, d).groupBy(workflow.record_kind("rec").alias("kind")).agg(F.count("*").alias("n"))


@_query("protected_token_extract", r"WITH t AS (SELECT page_id, 'tag' AS kind, unnest(regexp_extract_all(html, '<[^>]+>')) AS token FROM pages UNION ALL SELECT page_id, 'bracket', unnest(regexp_extract_all(html, '\[[^\]]+\]')) FROM pages UNION ALL SELECT page_id, 'format', unnest(regexp_extract_all(html, '%[0-9]*[sd]')) FROM pages UNION ALL SELECT page_id, 'alias', unnest(regexp_extract_all(html, '&[A-Za-z#0-9]+;')) FROM pages) SELECT page_id, kind, token, count(*)::BIGINT AS n FROM t GROUP BY ALL")
def protected_token_extract(spark, d):
    return workflow.extracted_tokens(_t(spark, d, "pages"), "page_id", "html")


@_query("markup_strip", r"SELECT page_id, length(regexp_replace(html, '<[^>]+>|\[[^\]]+\]', '', 'g'))::BIGINT AS n_chars FROM pages")
def markup_strip(spark, d):
    return _t(spark, d, "pages").select("page_id", F.length(stripped("html")).cast("bigint").alias("n_chars"))


@_query("evidence_ranked_lookup", "WITH e AS (SELECT p_type AS english, p_brand AS dest, CASE p_size % 3 WHEN 0 THEN 'core' WHEN 1 THEN 'extension' ELSE 'technical' END AS tier, count(*)::BIGINT AS uses FROM part WHERE p_type <> p_brand GROUP BY ALL) SELECT english, dest, tier, uses, row_number() OVER (PARTITION BY english ORDER BY CASE tier WHEN 'core' THEN 0 WHEN 'extension' THEN 1 ELSE 2 END, uses DESC, dest)::INT AS place FROM e")
def evidence_ranked_lookup(spark, d):
    s = F.col("p_size") % 3
    e = _t(spark, d, "part").select(F.col("p_type").alias("source"), F.col("p_brand").alias("dest"), F.when(s == 0, "core").when(s == 1, "extension").otherwise("technical").alias("tier"))
    return workflow.ranked_evidence(e.select(F.col("source").alias("english")).distinct(), e)


_RULE_ROWS = [("岚石", "岚石月"), ("心得", "记忆"), ("月", "月份"), ("浅滩", "滩涂")]


@_query("term_rule_scan", f"WITH {UNITS}, rules AS (SELECT * FROM (VALUES {', '.join(f'({s!r}, {r!r})' for s, r in _RULE_ROWS)}) r(search, replace)) SELECT unit_id, search, replace, CASE WHEN search = '心得' THEN '忆' END AS official, CASE WHEN search = '心得' THEN '忆' ELSE replace END AS suggestion FROM rules JOIN units ON contains(dest, search)")
def term_rule_scan(spark, d):
    rules = spark.createDataFrame(_RULE_ROWS, "search string, replace string")
    return workflow.scan_rules(_units(spark, d), rules, spark.createDataFrame([("心得", "忆")], "search string, official string"))


@_query("precedence_override", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'mod' WHEN c_custkey % 3 = 0 THEN 'glossary' WHEN c_custkey % 5 = 0 THEN 'global' END AS value, CASE WHEN c_custkey % 2 = 0 THEN 1 WHEN c_custkey % 3 = 0 THEN 2 WHEN c_custkey % 5 = 0 THEN 3 END AS layer FROM customer")
def precedence_override(spark, d):
    c = _t(spark, d, "customer").select("c_custkey")
    return contract.resolve(c, "c_custkey", *[c.where(f"c_custkey % {m} = 0").withColumn("value", F.lit(v)) for m, v in ((2, "mod"), (3, "glossary"), (5, "global"))])


@_query("semantic_unit_build", "SELECT conv_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn, coalesce(text, '')) AS unit_text, count(*)::BIGINT AS n_parts FROM conversations GROUP BY conv_id")
def semantic_unit_build(spark, d):
    return workflow.semantic_units(_t(spark, d, "conversations"), "conv_id", "turn", "text")


@_query("batch_plan", f"WITH {UNITS} SELECT unit_id, rec, source, (row_number() OVER (PARTITION BY rec ORDER BY unit_id) - 1) // 40 AS batch, 'B-' || rec || '-' || lpad(((row_number() OVER (PARTITION BY rec ORDER BY unit_id) - 1) // 40)::VARCHAR, 3, '0') AS batch_name FROM units WHERE rec NOT LIKE 'INFO%'")
def batch_plan(spark, d):
    u = _units(spark, d).where("rec not like 'INFO%'").select("unit_id", "rec", "source")
    return workflow.batch_plan(u, "rec", "unit_id", 40, "B-")


@_query("incremental_skip", "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events GROUP BY user_id HAVING bool_and(value > 0 AND event_type <> 'error'))")
def incremental_skip(spark, d):
    e = _t(spark, d, "events")
    results = e.select("user_id", F.when(F.col("value") > 0, 1).otherwise(0).alias("n_items"), (F.col("event_type") == "error").cast("int").alias("n_errors"))
    return workflow.skip_done(e.select("user_id").distinct(), results, "user_id")


@_query("calendar_family_audit", f"{WITH} SELECT unit_id, english, target FROM anchored JOIN (VALUES ('that', '岚石月'), ('with', '雾落月')) m(english, target) USING (english) JOIN units USING (unit_id) WHERE NOT contains(dest, target)")
def calendar_family_audit(spark, d):
    """Units that name a month but lack its rendering with the month sign."""
    months = spark.createDataFrame([("that", "岚石月"), ("with", "雾落月")], "english string, target string")
    u = _units(spark, d)
    return anchored_pairs(u, months, form="english").join(months, "english").join(u.select("unit_id", "dest"), "unit_id").where("not contains(dest, target)").select("unit_id", "english", "target")


@_query("form_layer_mapping", f"{WITH} SELECT unit_id, list_contains(list(english), 'that') AS has_that, list_contains(list(english), 'this') AS has_this, count(*)::BIGINT AS forms FROM anchored GROUP BY unit_id")
def form_layer_mapping(spark, d):
    forms = spark.createDataFrame([("that",), ("with",), ("this",), ("from",)], "english string")
    got = anchored_pairs(_units(spark, d), forms, form="english")
    return got.groupBy("unit_id").agg(F.bool_or(F.col("english") == "that").alias("has_that"), F.bool_or(F.col("english") == "this").alias("has_this"), F.count("*").alias("forms"))


@_query("index_semi_lookup", f"WITH {UNITS} SELECT unit_id, rec FROM units WHERE unit_id IN (SELECT item_id FROM benchmark)")
def index_semi_lookup(spark, d):
    index = _t(spark, d, "benchmark").select(F.col("item_id").alias("unit_id"))
    return _units(spark, d).select("unit_id", "rec").join(index, "unit_id", "left_semi")


@_query("patch_merge", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'PATCH' WHEN c_custkey % 4 = 1 THEN c_mktsegment ELSE c_mktsegment END AS c_mktsegment, (c_custkey % 4 = 0) AS changed FROM customer")
def patch_merge(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    patch = c.where("c_custkey % 4 < 2").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, "PATCH").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return workflow.merge_patch(c, patch, "c_custkey", "c_mktsegment")


@_query("content_hash", "SELECT doc_id, sha256('=' || doc_id || chr(31) || '=' || text) AS content_hash FROM documents")
def content_hash(spark, d):
    return _t(spark, d, "documents").select("doc_id", workflow.content_hash("doc_id", "text").alias("content_hash"))


@_query("length_outliers", rf"WITH {UNITS} SELECT unit_id FROM units WHERE length({_STRIP.format('source').replace('trim', '')}) > 0 AND (length({_STRIP.format('dest').replace('trim', '')})::DOUBLE / length({_STRIP.format('source').replace('trim', '')}) < 0.5 OR length({_STRIP.format('dest').replace('trim', '')})::DOUBLE / length({_STRIP.format('source').replace('trim', '')}) > 1.2)")
def length_outliers(spark, d):
    return workflow.length_outliers(_units(spark, d), 0.5, 1.2).select("unit_id")


@_query("last_line", "SELECT doc_id, left(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')[-1], 200) AS tail FROM documents")
def last_lines(spark, d):
    return _t(spark, d, "documents").select("doc_id", last_line("text").alias("tail"))


@_query("worker_import", "SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'EXTRA' WHEN b.id IS NULL OR b.body = '' THEN 'MISSING' ELSE 'OK' END AS state FROM (SELECT n_nationkey::VARCHAR AS id FROM nation WHERE n_nationkey < 20) a FULL JOIN (SELECT n_nationkey::VARCHAR AS id, CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE n_name END AS body FROM nation WHERE n_nationkey > 5) b ON a.id = b.id")
def worker_import(spark, d):
    n = _t(spark, d, "nation").withColumn("id", F.col("n_nationkey").cast("string"))
    body = F.when(F.col("n_nationkey") % 4 == 0, "").otherwise(F.col("n_name"))
    return workflow.import_worker(n.where("n_nationkey < 20").select("id", F.col("n_name").alias("source")), n.where("n_nationkey > 5").select("id", body.alias("body"))).select("id", "state")


@_query("dialogue_tree", "WITH RECURSIVE e AS (SELECT c_custkey AS parent, c_custkey * 2 + 1 AS child FROM customer UNION ALL SELECT c_custkey, c_custkey * 2 + 2 FROM customer), t(node, depth) AS (SELECT 0::BIGINT, 0 UNION ALL SELECT child, depth + 1 FROM t JOIN e ON node = parent WHERE depth < 6) SELECT node, depth FROM t")
def dialogue_tree(spark, d):
    c = _t(spark, d, "customer").select(F.col("c_custkey").alias("parent"))
    edges = c.select("parent", (F.col("parent") * 2 + 1).alias("child")).unionByName(c.select("parent", (F.col("parent") * 2 + 2).alias("child")))
    return workflow.dialogue_tree(edges, spark.createDataFrame([(0,)], "node bigint"), 6).select("node", "depth")


@_query("progress_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL")
def progress_windows(spark, d):
    from ..streaming import progress_windows as windows

    return windows(_t(spark, d, "events")).select(F.col("start"), "event_type", "n")


@_query("sessions", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events), s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, min(ts) AS start, count(*)::BIGINT AS n FROM s GROUP BY user_id, k")
def session_counts(spark, d):
    from ..streaming import sessions

    return sessions(_t(spark, d, "events")).select("user_id", "start", "n")


@_query("existence_check", "SELECT source, coalesce(bool_or(contains(text, 'License')), false) AS found FROM documents GROUP BY source")
def existence_check(spark, d):
    return workflow.any_contains(_t(spark, d, "documents"), "source", "text", "License")


@_query("marker_filter", f"WITH {UNITS} SELECT unit_id FROM units JOIN labels ON unit_id = doc_id WHERE contains(source, 'License') AND dest <> source AND quality = 1")
def marker_filter(spark, d):
    status = _t(spark, d, "labels").select(F.col("doc_id").alias("unit_id"), F.when(F.col("quality") == 1, "TRANSLATED").otherwise("REVIEW").alias("status"))
    return workflow.marked(_units(spark, d).join(status, "unit_id"), "License").select("unit_id")


@_query("incremental_write", "SELECT c_custkey FROM customer WHERE c_custkey % 4 = 0 OR c_custkey % 10 = 9")
def incremental_write(spark, d):
    new = _t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    old = new.where("c_custkey % 10 <> 9").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 4 == 0, "OLD").otherwise(F.col("c_mktsegment")))
    return workflow.changed_rows(new, old, "c_custkey", "c_name", "c_mktsegment").select("c_custkey")


@_query("keep002", f"WITH {NAMES} SELECT unit_id, 'KEEP002' AS code, source AS expected FROM names WHERE unit_id % 2 = 0 AND dest <> source")
def keep002(spark, d):
    n = _names(spark, d)
    u = contract.compile_contract(n, dims.terms(spark), global_keep=n.where("unit_id % 2 = 0").select(F.col("source").alias("text")))
    return gate.violations(u, gate.GateConfig(rules=("keep",))).select("unit_id", "code", "expected")


@_query("xml001", f"WITH {MARKUP}, n AS (SELECT unit_id, source <> dest AND (contains(source, '<b>') AND unit_id % 3 = 1 OR contains(source, '<article>') AND unit_id % 3 = 2) AS broken FROM markup) SELECT unit_id, 'XML001' AS code FROM n WHERE broken")
def xml001(spark, d):
    u = _markup(spark, d).withColumn("contract", F.lit(None).cast(CONTRACT))
    return gate.violations(u, gate.GateConfig(rules=("xml_structure",))).select("unit_id", "code")


@_query("chained_lookup", "SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 3 = 0 THEN 'id' WHEN c_custkey % 3 = 1 THEN 'place' ELSE 'MISSING' END AS found FROM customer")
def chained_lookup(spark, d):
    c = _t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("source"), F.col("c_custkey").cast("bigint").alias("at"))
    parsed = c.where("at % 3 < 2").select(F.when(F.col("at") % 3 == 0, F.col("id")).otherwise(F.concat(F.lit("x_"), "id")).alias("id"), F.col("source").alias("body"))
    return workflow.chained_lookup(c, parsed).select("id", "found")


@_query("time_delta", "SELECT event_type, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM events GROUP BY event_type")
def time_delta(spark, d):
    return workflow.elapsed(_t(spark, d, "events"), "event_type").select("event_type", "seconds")


@_query("cases_per_file", "SELECT source, count(*)::BIGINT AS n FROM documents GROUP BY source")
def cases_per_file(spark, d):
    return validate.per_file(_t(spark, d, "documents").select("source"), "source")


@_query("decision_states", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'CONFIRMED' WHEN o_orderstatus = 'O' THEN 'REVIEW' WHEN o_orderstatus = 'F' THEN 'KEEP' ELSE 'PROVISIONAL' END AS status, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN 'KEEP to CONFIRMED' END AS error FROM orders WHERE o_orderstatus <> 'P' OR o_orderkey % 2 = 1 UNION ALL SELECT o_orderkey, 'CONFIRMED', NULL FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 2 = 0")
def decision_states(spark, d):
    o = _t(spark, d, "orders")
    s = F.col("o_orderstatus")
    now = o.select("o_orderkey", F.when(s == "O", "REVIEW").when(s == "F", "KEEP").alias("status"))
    asked = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit("CONFIRMED").alias("status"))
    return workflow.advance(now, asked, "o_orderkey").select("o_orderkey", "status", "error")


from . import files  # noqa: E402,F401  adds its own
