"""Queries that write files from the tables and read them back, and those of review, names, ranges and versions.

Files go to a new folder of the shared one, through the same writers and sources that other callers use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import staging
from ..operators import chain, contract, gate, nouns, ranges, review, workflow
from ..schema import CONTRACT
from ..sinks import write_documents
from ..sources import read_cases, read_contracts, read_keep_lists
from ..sources.formats import open_
from . import dims
from .queries import _RULES, BARE, SCOPED, TRUNC, WITH, _contracts, _query, _t, _units

#: Customers in one file.
PER_FILE = 200


def _written(rows: DataFrame, label: str) -> str:
    """The folder that documents (path, content) have been written to."""
    folder = staging.fresh(rows.sparkSession, label)
    bad = write_documents(rows.select(F.col("path").alias("file"), "path", "content"), folder).where("not verified").count()
    if bad:
        raise RuntimeError(f"{bad} documents are not what was written")
    return folder


def _grouped(spark, d, line, begin="", end="", suffix=".txt", sep="\n"):
    """Documents of PER_FILE customers each, one line for each."""
    c = _t(spark, d, "customer").select("c_custkey", line.alias("line"))
    name = F.concat(F.lit("part"), F.floor(F.col("c_custkey") / PER_FILE) % 3, F.lit("/"), F.floor(F.col("c_custkey") / PER_FILE).cast("string"), F.lit(suffix))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "line"))), lambda x: x["line"]), sep)
    return c.groupBy(name.alias("path")).agg(F.concat(F.lit(begin), lines, F.lit(end)).alias("content"))


_PATH = f"'part' || (c_custkey // {PER_FILE} % 3) || '/' || (c_custkey // {PER_FILE})"


def _xml(spark, d):
    key = F.col("c_custkey").cast("string")
    rec = F.when(F.col("c_custkey") % 2 == 0, "BOOK:DESC").otherwise("INFO:NAM1")
    line = F.concat(F.lit('<String List="0"><EDID>e_'), key, F.lit('</EDID><REC id="'), F.col("c_custkey") % 9, F.lit('">'), rec, F.lit("</REC><Source>Caf&#233; &amp; <![CDATA[<b>"), F.col("c_mktsegment"), F.lit("</b>]]> &#x4E00;"), key, F.lit("</Source><Dest>&lt;"), F.col("c_name"), F.lit("&gt;</Dest></String>"))
    return _grouped(spark, d, line, '<?xml version="1.0"?>\n<Content>\n', "\n</Content>\n", ".xml")


XML_ROWS = f"""xml_rows AS (SELECT {_PATH} || '.xml' AS file, row_number() OVER (PARTITION BY c_custkey // {PER_FILE} ORDER BY c_custkey)::BIGINT - 1 AS xml_index,
  CASE WHEN c_custkey % 2 = 0 THEN 'BOOK:DESC' ELSE 'INFO:NAM1' END AS rec, 'e_' || c_custkey AS edid, 'Café & <b>' || c_mktsegment || '</b> 一' || c_custkey AS source, '<' || c_name || '>' AS dest, (c_custkey % 9)::VARCHAR AS rec_id, c_custkey FROM customer)"""


@_query("xml_source", f"WITH {XML_ROWS} SELECT file, xml_index, rec, edid, source, dest, rec_id FROM xml_rows WHERE rec = 'BOOK:DESC'")
def xml_source(spark, d):
    """Units of XML files that executors wrote: attributes, references and CDATA read, a filter pushed to the source."""
    got = open_(spark, "xml", _written(_xml(spark, d), "xml")).where("rec = 'BOOK:DESC'")
    return got.select("file", "xml_index", "rec", "edid", "source", "dest", F.col("attributes")["REC.id"].alias("rec_id"))


@_query("rules_source", f"SELECT {_PATH} || '.rules' AS file, c_name AS search, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS replace FROM customer WHERE c_custkey % 7 <> 0 AND c_name LIKE 'Customer#00000%'")
def rules_source(spark, d):
    """Rules of files read in parts of 4 kB; blocks without a search text are left out."""
    k = F.col("c_custkey")
    line = F.concat(F.lit("StartRule\nSearch="), F.when(k % 7 == 0, "").otherwise(F.col("c_name")), F.lit("\nReplace="), F.when(k % 5 == 0, "").otherwise(F.col("c_mktsegment")), F.lit("\nEndRule"))
    folder = _written(_grouped(spark, d, line, "# rules\n", "\n", ".rules"), "rules")
    return open_(spark, "rules", folder, partBytes=4096).where("search like 'Customer#00000%'")


@_query("index_source", "SELECT c_custkey::BIGINT AS xml_index, count(*)::BIGINT AS n FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey >= 20 GROUP BY 1")
def index_source(spark, d):
    """Numbers of index files, read in parts; lines that are none are left out, and a bound is pushed to the source."""
    k = F.col("c_custkey")
    folder = _written(_grouped(spark, d, F.when(k % 3 == 0, F.concat(F.lit("x"), k)).otherwise(F.concat(F.lit(" "), k)), suffix=".idx"), "index")
    return open_(spark, "index", folder, partBytes=512).where("xml_index >= 20").groupBy("xml_index").agg(F.count("*").alias("n"))


@_query("listing_source", f"SELECT {_PATH} || '.txt' AS path, (sum(length(c_name)) + count(*) - 1)::BIGINT AS length FROM customer WHERE c_custkey // {PER_FILE} % 3 = 1 GROUP BY c_custkey // {PER_FILE}")
def listing_source(spark, d):
    """Files below one folder, by a walk that the filter narrows."""
    return open_(spark, "listing", _written(_grouped(spark, d, F.col("c_name")), "listing")).where("path like 'part1/%'").select("path", "length")


@_query("keep_list_files", "SELECT DISTINCT c_mktsegment AS text FROM customer WHERE c_custkey % 4 <> 3")
def keep_list_files(spark, d):
    """Texts of keep lists of two forms, as JSON files."""
    k = F.col("c_custkey")
    one = F.when(k % 4 < 2, F.to_json(F.array("c_mktsegment"))).when(k % 4 == 2, F.to_json(F.struct(F.array("c_mktsegment").alias("keep_list")))).otherwise(F.concat(F.lit("[\""), "c_mktsegment"))
    files = _t(spark, d, "customer").groupBy(F.concat(F.lit("k/"), k % 8, F.lit("-"), "c_mktsegment", F.lit(".json")).alias("path")).agg(F.min(one).alias("content"))
    return read_keep_lists(spark, _written(files, "keep")).select("text").distinct()


@_query("contract_files", "SELECT n_nationkey % 5 AS id, count(*)::BIGINT AS files, sum(CASE WHEN n_nationkey % 7 = 3 THEN 1 ELSE 0 END)::BIGINT AS broken, string_agg(n_name, ',' ORDER BY n_name) FILTER (n_nationkey % 7 <> 3) AS kept FROM nation GROUP BY 1")
def contract_files(spark, d):
    """Contracts of JSON files, the broken ones told apart."""
    k = F.col("n_nationkey")
    good = F.to_json(F.struct(F.array("n_name").alias("keep_list"), F.create_map(F.concat(F.lit("t"), k % 5), F.struct(F.lit("甲").alias("target"))).alias("terms")))
    files = _t(spark, d, "nation").select(F.concat(k % 5, F.lit("/"), k, F.lit(".json")).alias("path"), F.when(k % 7 == 3, F.lit('{"keep_list": [')).otherwise(good).alias("content"))
    got = read_contracts(spark, _written(files, "contracts"))
    id_ = F.regexp_extract("file", r"/(\d)/\d+\.json$", 1).cast("int")
    kept = F.array_join(F.array_sort(F.flatten(F.collect_list("contract.keep_list"))), ",")
    return got.groupBy(id_.alias("id")).agg(F.count("*").alias("files"), F.count_if(F.col("contract").isNull()).alias("broken"), kept.alias("kept"))


@_query("case_files_gate", "SELECT 'c-' || c_custkey AS case_id, CASE WHEN c_custkey % 3 = 0 THEN 'FAIL' ELSE 'PASS' END AS verdict, CASE WHEN c_custkey % 3 = 0 THEN 'KEEP001' ELSE '' END AS codes, (c_custkey % 3 = 0) = (c_custkey % 2 = 0) AS as_expected FROM customer")
def case_files_gate(spark, d):
    """Cases of JSON files, gated, beside the verdict that they expect."""
    k = F.col("c_custkey")
    input_ = F.struct(F.col("c_name").alias("source"), F.when(k % 3 == 0, "客").otherwise(F.col("c_name")).alias("translation"), F.struct(F.array("c_name").alias("keep_list")).alias("contract"))
    case = F.to_json(F.struct(F.concat(F.lit("c-"), k).alias("case_id"), input_.alias("input"), F.struct(F.when(k % 2 == 0, "FAIL").otherwise("PASS").alias("verdict")).alias("expect")))
    files = _grouped(spark, d, case, '{"schema_version": "1", "cases": [', "]}", ".json", ",")
    cases = read_cases(spark, _written(files, "cases"))
    got = gate.gate(cases.select("case_id", "expect", F.col("input.source").alias("source"), F.col("input.translation").alias("dest"), F.col("input.contract").alias("contract")))
    return got.select("case_id", "verdict", F.array_join("codes", ",").alias("codes"), (F.col("verdict") == F.col("expect.verdict")).alias("as_expected"))


CHANGED = "c_custkey % 4 = 1"


@_query("write_chain", f"WITH {XML_ROWS} SELECT file, xml_index, CASE WHEN {CHANGED} THEN '新 <' || c_custkey || '>' ELSE dest END AS dest, 1::BIGINT AS version FROM xml_rows")
def write_chain(spark, d):
    """Documents as they are after a chain has consumed, written, verified and counted a version of changes to them."""
    folder, home = _written(_xml(spark, d), "chain-in"), staging.fresh(spark, "chain")
    files = open_(spark, "documents", folder).select(F.col("path").alias("file"), F.col("content").alias("xml"))
    units = open_(spark, "xml", folder).withColumn("c_custkey", F.substring("edid", 3, 20).cast("bigint"))
    changes = units.where(CHANGED).select("file", "xml_index", F.concat(F.lit("新 <"), "c_custkey", F.lit(">")).alias("dest"))
    c = chain.WriteChain(spark, home, "nightly")
    snapshot = c.run(files, changes, root="")
    return open_(spark, "xml", c.documents).select("file", "xml_index", "dest", F.lit(snapshot["version"]).cast("bigint").alias("version"))


_CANON = "coalesce(length({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


@_query("canonical_digest", f"WITH h AS (SELECT source, sha256({_CANON.format('doc_id')} || {_CANON.format('text')}) AS h FROM documents), s AS (SELECT source, count(*)::BIGINT AS n, {', '.join(f'sum((chr(48) || chr(120) || substr(h, {8 * i + 1}, 8))::BIGINT)::VARCHAR AS w{i}' for i in range(8))} FROM h GROUP BY source) SELECT n, sha256(concat_ws(':', n::VARCHAR, {', '.join(f'w{i}' for i in range(8))})) AS digest FROM (SELECT sum(n)::BIGINT AS n, {', '.join(f'sum(w{i}::HUGEINT)::VARCHAR AS w{i}' for i in range(8))} FROM s)")
def canonical_digest(spark, d):
    return chain.set_digest(_t(spark, d, "documents"), "doc_id", "text")


@_query("semantic_unit_chunks", "WITH p AS (SELECT conv_id, coalesce(text, '') AS t, coalesce(sum(length(coalesce(text, '')) + 1) OVER (PARTITION BY conv_id ORDER BY turn, coalesce(text, '') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins FROM conversations) SELECT conv_id, begins // 400 AS chunk, min(begins) AS start, string_agg(t, chr(10) ORDER BY begins) AS unit_text, count(*)::BIGINT AS n_parts FROM p GROUP BY conv_id, begins // 400")
def semantic_unit_chunks(spark, d):
    return ranges.chunked_texts(_t(spark, d, "conversations"), "conv_id", "turn", "text", 400)


@_query("running_totals", "SELECT l_orderkey, l_linenumber, coalesce(sum(l_linenumber) OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM lineitem")
def running_totals(spark, d):
    """Running sums where three groups hold all rows."""
    rows = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return ranges.running(rows, "l_returnflag", ["l_orderkey", "l_linenumber"], "before", F.col("l_linenumber").cast("bigint")).select("l_orderkey", "l_linenumber", "before")


_SHORT, _LONG = ("'(^|[^A-Za-z0-9_])(" + v + ")(''s)?([^A-Za-z0-9_]|$)'" for v in ("that|thats", "the that|the thats"))
_CUT = "regexp_replace({0}, " + _LONG + ", '\\1 \\4', 'g')"


@_query("over_reach", f"{WITH} SELECT unit_id, 't.that' AS term_id, 't.pair' AS longer_id, 'the that' AS longer FROM units WHERE regexp_matches(source, {_LONG}) AND NOT regexp_matches({_CUT.format(_CUT.format('source'))}, {_SHORT})")
def over_reach(spark, d):
    """Automatic bindings of a term that stands only inside a longer one."""
    rows = [("t.that", "REQUIRED", "that"), ("t.pair", "REQUIRED", "the that"), ("t.none", "FORBIDDEN_ONLY", "the")]
    terms = spark.createDataFrame(rows, "term_id string, enforcement string, source string")
    return contract.over_reach(_units(spark, d), terms).select("unit_id", "term_id", "longer_id", "longer")


FROZEN = ("src0", "src3")


def _versioned(spark):
    """Terms and bans of two versions: one term has another target, one is new, one ban has gone."""
    one = lambda df: df.withColumn("version", F.lit(1)).withColumn("deleted", F.lit(False))
    t, b = one(dims.terms(spark)), one(dims.bans(spark))
    later = t.where("term_id = 't.follow'").withColumn("version", F.lit(2)).withColumn("target", F.lit("追随"))
    new = t.where("term_id = 't.follow'").withColumn("term_id", F.lit("t.new")).withColumn("version", F.lit(2)).withColumn("source", F.lit("from")).withColumn("target", F.lit("来自"))
    gone = b.where("ban_id = 'b.people'").withColumn("version", F.lit(2)).withColumn("deleted", F.lit(True))
    return t.unionByName(later).unionByName(new), b.unionByName(gone)


@_query(
    "contract_recompile",
    f"""{WITH}, a AS (SELECT unit_id, list(english) AS e FROM anchored GROUP BY unit_id), u AS (SELECT unit_id, plugin IN {FROZEN} AS frozen, coalesce(e, []) AS e FROM units LEFT JOIN a USING (unit_id))
  SELECT unit_id, CASE WHEN frozen THEN 1 ELSE 2 END::BIGINT AS version, concat_ws(',', CASE WHEN list_contains(e, 'this') THEN 't.elf=林谷人' END, CASE WHEN list_contains(e, 'with') THEN CASE WHEN frozen THEN 't.follow=跟随' ELSE 't.follow=追随' END END,
    CASE WHEN list_contains(e, 'that') THEN 't.month=岚石月' END, CASE WHEN list_contains(e, 'from') AND NOT frozen THEN 't.new=来自' END) AS terms,
  concat_ws(',', 'anachronism', CASE WHEN list_contains(e, 'from') AND frozen THEN 'from' END, CASE WHEN list_contains(e, 'that') THEN 'that' END, 'wooden gate') AS bans FROM u""",
)
def contract_recompile(spark, d):
    """Contracts at version 2 from those of version 1: only units that the changes concern are compiled again."""
    u = _units(spark, d).withColumn("frozen", F.col("plugin").isin(*FROZEN))
    terms, bans = _versioned(spark)
    first = contract.compile_contract(u, contract.as_of(terms, 1, "term_id"), contract.as_of(bans, 1, "ban_id")).select("unit_id", F.lit(1).cast("bigint").alias("version"), "contract")
    got = contract.recompile(u, first, terms, bans, 1, 2)
    held = F.array_sort(F.transform(F.map_entries("contract.terms"), lambda e: F.concat(e["key"], F.lit("="), e["value"]["target"])))
    return got.select("unit_id", "version", F.array_join(F.coalesce(held, F.array().cast("array<string>")), ",").alias("terms"), F.array_join(F.array_sort(F.transform("contract.global_bans", lambda b: b["english"])), ",").alias("bans"))


@_query(
    "noun_family_audit",
    f"""{WITH}, f(family, english, target) AS (VALUES ('month', 'that', '岚石月'), ('month', 'with', '雾落月'), ('weekday', 'this', '木曜日')), bare AS (SELECT unit_id, count(*) AS n FROM ({BARE}) GROUP BY unit_id),
  g AS (SELECT unit_id, family, english, target, CASE WHEN english = 'that' THEN coalesce(n, 0) ELSE 0 END::BIGINT AS unsigned, NOT contains(dest, target) AS lacks FROM anchored JOIN f USING (english) JOIN units USING (unit_id) LEFT JOIN bare USING (unit_id) WHERE dest <> source)
  SELECT * FROM g WHERE lacks OR unsigned > 0""",
)
def noun_family_audit(spark, d):
    families = spark.createDataFrame([("month", "that", "岚石月", "月"), ("month", "with", "雾落月", "月"), ("weekday", "this", "木曜日", None)], "family string, english string, target string, sign string")
    return nouns.family_audit(_units(spark, d), families).select("unit_id", "family", "english", "target", "unsigned", "lacks")


@_query("form_layer_audit", f"{WITH} SELECT unit_id, english, form, layer, contains(dest, form) AS carried FROM anchored JOIN (VALUES ('that', '岚石月', 'month'), ('this', '岩泽民', 'people'), ('this', '林谷人', 'common')) l(english, form, layer) USING (english) JOIN units USING (unit_id)")
def form_layer_audit(spark, d):
    layers = spark.createDataFrame([("that", "岚石月", "month"), ("this", "岩泽民", "people"), ("this", "林谷人", "common")], "english string, form string, layer string")
    return nouns.form_layers(_units(spark, d), layers)


@_query(
    "noun_consistency",
    """WITH n AS (SELECT n_nationkey AS k, 'Lord ' || chr((65 + n_nationkey % 26)::INT) || 'en' AS name FROM nation), s AS (SELECT c_custkey, name, k, CASE WHEN c_custkey % 3 = 0 AND k % 4 = 1 THEN '无' ELSE '名' || k END AS dest FROM customer JOIN n ON c_nationkey = k),
  u AS (SELECT name, count(*) AS n, count(*) FILTER (dest = '无') AS missing FROM s GROUP BY name)
  SELECT name, coalesce(u.n, 0)::BIGINT + (CASE k % 4 WHEN 0 THEN 0 WHEN 2 THEN 2 ELSE 1 END) AS uses, (CASE k % 4 WHEN 0 THEN 0 WHEN 2 THEN 2 ELSE 1 END)::BIGINT AS renderings,
    (CASE WHEN k % 4 = 0 THEN 0 ELSE coalesce(missing, 0) + CASE WHEN k % 4 = 2 THEN 1 ELSE 0 END END)::BIGINT AS missing,
    CASE WHEN k % 4 = 0 THEN 'UNKNOWN' WHEN k % 4 = 2 THEN 'INCONSISTENT' WHEN missing > 0 THEN 'MISSING' ELSE 'OK' END AS verdict
  FROM n LEFT JOIN u USING (name) WHERE k % 4 <> 0 OR u.n > 0""",
)
def noun_consistency(spark, d):
    """Names inside sentences, held against what units render that are the name alone."""
    k = F.col("n_nationkey")
    n = _t(spark, d, "nation").select(k.alias("k"), F.concat(F.lit("Lord "), F.chr((65 + k % 26).cast("bigint")), F.lit("en")).alias("name"))
    own = F.concat(F.lit("名"), "k")
    titles = n.where("k % 4 <> 0").select(F.concat(F.lit("t"), "k").alias("unit_id"), F.col("name").alias("source"), own.alias("dest"))
    others = n.where("k % 4 = 2").select(F.concat(F.lit("o"), "k").alias("unit_id"), F.col("name").alias("source"), F.concat(F.lit("异"), "k").alias("dest"))
    c = _t(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("k"))
    said = c.select(F.concat(F.lit("s"), "c_custkey").alias("unit_id"), F.concat(F.lit("They met "), "name", F.lit("'s men.")).alias("source"), F.when((F.col("c_custkey") % 3 == 0) & (F.col("k") % 4 == 1), "无").otherwise(own).alias("dest"))
    return nouns.name_consistency(titles.unionByName(others).unionByName(said)).select("name", "uses", "renderings", "missing", "verdict")


_WARNED = f"SELECT unit_id, 'TRUNC001' AS code, '' AS term FROM ({TRUNC}) UNION ALL SELECT unit_id, 'TERM004', 'anachronism' FROM ({SCOPED}) WHERE severity = 'WARNING'"


@_query(
    "review_queue",
    f"""{WITH}, w AS (SELECT 'warning' AS kind, unit_id || '|' || code || '|' || term AS key, 'low' AS severity, CASE WHEN unit_id % 3 = 0 THEN 'ann' END AS closed_by, 1::BIGINT AS opened FROM ({_WARNED})),
  g AS (SELECT 'golden', conv_id::VARCHAR, 'medium', NULL, 2::BIGINT FROM conversations WHERE turn = 0 AND conv_id % 5 = 0),
  o AS (SELECT 'decision', o_orderkey::VARCHAR, 'high', CASE WHEN o_orderkey % 8 = 0 THEN 'bob' END, 2::BIGINT FROM orders WHERE o_orderstatus = 'P') SELECT * FROM w UNION ALL SELECT * FROM g UNION ALL SELECT * FROM o""",
)
def review_queue(spark, d):
    """Two turns of the queue: warnings of the first, some of them decided, stay when the second finds other things."""
    found = gate.violations(_contracts(spark, d), gate.GateConfig(rules=_RULES))
    # Written once: what is decided on is read from it, and violations are not found anew.
    at = staging.fresh(spark, "warned")
    items = review.warning_items(found)
    items.write.parquet(at)
    warned = spark.read.schema(items.schema).parquet(at)
    decided = warned.where("split_part(key, '|', 1) % 3 = 0").select("kind", "key", "detail", F.lit("ann").alias("by"))
    none = decided.where("false")
    first = review.fold(None, [warned], decided, 1)
    talks = _t(spark, d, "conversations").where("turn = 0").select(F.col("conv_id").alias("case_id"), F.struct((F.col("conv_id") % 5 == 0).alias("golden_review")).alias("assertion"), F.struct(F.col("text").alias("source")).alias("input"))
    orders = _t(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("term_id"), F.lit("REVIEW").alias("status"), F.lit(None).cast("string").alias("error"))
    asked = review.decision_items(orders)
    second = asked.where("key % 8 = 0").select("kind", "key", "detail", F.lit("bob").alias("by")).unionByName(none)
    got = review.fold(first, [review.golden_items(talks), asked], second, 2)
    return got.select("kind", "key", "severity", "closed_by", "opened")


@_query("release_with_review", "SELECT (g = 0 AND r = 0) AS ready, concat_ws(',', CASE WHEN g > 0 THEN 'gaps' END, CASE WHEN r > 0 THEN 'review' END) AS open FROM (SELECT (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS g, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 8 <> 0) AS r)")
def release_with_review(spark, d):
    orders = _t(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("term_id"), F.lit("REVIEW").alias("status"), F.lit(None).cast("string").alias("error"))
    asked = review.decision_items(orders)
    queue = review.fold(None, [asked], asked.where("key % 8 = 0").select("kind", "key", "detail", F.lit("bob").alias("by")), 1)
    bad = workflow.gaps(_t(spark, d, "documents").select("doc_id"), _t(spark, d, "labels"), "doc_id")
    checks = bad.agg((F.count("*") == 0).alias("ok")).select(F.lit("gaps").alias("name"), "ok").unionByName(review.open_issues(queue))
    return workflow.release_ready(checks)


_TAGGED = """tagged AS (SELECT c_custkey AS unit_id, '<font size="' || c_custkey % 5 || '"><b>' || c_name || CASE WHEN c_custkey % 2 = 0 THEN '</b>' ELSE '' END AS source FROM customer),
  marked AS (SELECT unit_id, source, CASE unit_id % 9 WHEN 0 THEN source WHEN 1 THEN replace(source, 'Customer', '客') WHEN 2 THEN replace(source, 'Customer', '客') || '</font>' WHEN 3 THEN replace(source, 'Customer', '客') || '</b></font>' WHEN 4 THEN replace(source, '</b>', '') || '客'
    WHEN 5 THEN replace(source, 'Customer', '客') || '</i>' WHEN 6 THEN replace(source, '<b>', '<B >') WHEN 7 THEN replace(source, 'Customer', '客') || '</font></b>' ELSE replace(source, '<b>', '') || '<b/>' END AS dest FROM tagged)"""
_OPENS = "list_sort(list_transform(regexp_extract_all({0}, '<[A-Za-z][^<>]*>'), lambda t: regexp_replace(t, '\\s+', ' ', 'g')))"
_N = "len(regexp_extract_all(lower({0}), '{1}'))"


def _ends(tag: str, opening: str) -> str:
    """SQL: the dest's closing tags of a name are no fewer than the source's, and no more than those or what it opens."""
    was, now, opens = _N.format("source", f"</{tag}>"), _N.format("dest", f"</{tag}>"), _N.format("source", opening)
    return f"({now} >= {was} AND {now} <= greatest({was}, {opens}))"


@_query(
    "xml001_open_tags",
    f"WITH {_TAGGED} SELECT unit_id, 'XML001' AS code FROM marked WHERE source <> dest AND NOT ({_OPENS.format('source')} = {_OPENS.format('dest')} AND {_ends('b', '<b>')} AND {_ends('font', '<font[^>]*>')} AND NOT contains(dest, '</i>') AND NOT contains(dest, '</font></b>'))",
)
def xml001_open_tags(spark, d):
    """Tags left open, closed in the dest, lost, closed twice, crossed and changed."""
    c, k = _t(spark, d, "customer"), F.col("c_custkey")
    source = F.concat(F.lit('<font size="'), k % 5, F.lit('"><b>'), F.col("c_name"), F.when(k % 2 == 0, "</b>").otherwise(""))
    u = c.select(k.alias("unit_id"), source.alias("source"))
    s, n = F.col("source"), F.col("unit_id") % 9
    put = F.replace(s, F.lit("Customer"), F.lit("客"))
    more = lambda t: F.concat(put, F.lit(t))
    dest = F.when(n == 0, s).when(n == 1, put).when(n == 2, more("</font>")).when(n == 3, more("</b></font>")).when(n == 4, F.concat(F.replace(s, F.lit("</b>"), F.lit("")), F.lit("客"))).when(n == 5, more("</i>"))
    dest = dest.when(n == 6, F.replace(s, F.lit("<b>"), F.lit("<B >"))).when(n == 7, more("</font></b>")).otherwise(F.concat(F.replace(s, F.lit("<b>"), F.lit("")), F.lit("<b/>")))
    u = u.withColumn("dest", dest).withColumn("contract", F.lit(None).cast(CONTRACT))
    return gate.violations(u, gate.GateConfig(rules=("xml_structure",))).select("unit_id", "code")
