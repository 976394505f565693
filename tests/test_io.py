import json

import pytest
from pyspark.sql import functions as F

from lexmill import sinks, sources
from lexmill.operators import validate, workflow
from lexmill.streaming import distinct_revisions, gate_stream, read_unit_stream


def test_cases_and_broken_files(spark, tmp_path):
    case = {"case_id": "a.1", "test_layer": "gate", "category": "keep", "plugin": "p", "origin": "o", "input": {"source": "s", "translation": "t", "contract": {"terms": {"x.y": {"target": "z"}}}}, "expect": {"verdict": "PASS"}}
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep/a.json").write_text(json.dumps({"cases": [case, {**case, "test_layer": "else"}, {**case, "case_id": "a.2", "input": {"source": "s"}}]}))
    (tmp_path / "b.json").write_text("{broken")
    cases = sources.read_cases(spark, str(tmp_path))
    assert cases.count() == 3 and cases.where("input.contract.terms['x.y'].target = 'z'").count() == 2
    errors = {(r.case_id, r.error) for r in validate.check_cases(cases).collect()}
    assert errors == {("a.1", "duplicate case_id"), ("a.1", "missing test_layer"), ("a.2", "missing input.translation"), ("a.2", "missing input.contract")}
    raw = sources.read_raw_json(spark, str(tmp_path))
    assert {r.file.split("/")[-1]: r.parsed is None for r in raw.collect()} == {"a.json": False, "b.json": True}
    assert {r.error for r in validate.schema_errors(raw).collect()} == {"not JSON"}
    assert [(r.n,) for r in validate.per_file(cases).collect()] == [(3,)]


def test_schema_files_and_arrays(spark, tmp_path):
    """Ids are local names; addresses and made-up hosts are errors, and what is missing is none."""
    files = {"local": {"$id": "urn:local:x", "$schema": "https://json-schema.org/draft-07"}, "outer": {"$id": "https://example.org/x"}, "made": {"$schema": "http://agentskills.io/s"}, "bare": {}, "dict": {"cases": {}}, "list": {"cases": []}, "none": {"cases": None}}
    for name, body in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(body))
    raw = sources.read_raw_json(spark, str(tmp_path), recursive=False)
    name = lambda rows: sorted((r.file.split("/")[-1], r.error) for r in rows.collect())
    assert name(validate.schema_errors(raw)) == [("made.json", "$schema"), ("outer.json", "$id")]
    assert [x[0] for x in name(validate.not_arrays(raw))] == ["dict.json", "none.json"]


def test_missing_is_not_null(spark):
    df = spark.createDataFrame([("f", '{"case_id": null, "plugin": 1}'), ("g", "no json")], "file string, j string")
    got = {(r.file, r.key) for r in validate.missing_keys(df, "j", ("case_id", "plugin", "origin")).collect()}
    assert got == {("f", "origin"), ("g", "case_id"), ("g", "plugin"), ("g", "origin")}


def test_translation_sets_last_wins(spark, tmp_path):
    for name, text in (("a", "old"), ("b", "new")):
        (tmp_path / f"{name}.json").write_text(json.dumps({"translations": [{"xml_index": 1, "translation": text}]}))
    got = workflow.last_wins(sources.read_translation_set(spark, str(tmp_path)), "xml_index", "file", "pos").collect()
    assert [(r.xml_index, r.translation) for r in got] == [(1, "new")]


XML = '<?xml version="1.0"?>\n<Root  a="1"><String List="0"><EDID>e</EDID><REC>BOOK:DESC</REC><Source>A &lt;b&gt;</Source><Dest>old</Dest></String>\r\n<String><Source>B</Source><Dest></Dest></String></Root>\n'


def test_xml_reads_and_splices(spark, tmp_path):
    (tmp_path / "x.xml").write_text(XML, newline="")
    units = sources.read_units_xml(spark, str(tmp_path)).collect()
    assert [(u.rec, u.source, u.dest) for u in units][0] == ("BOOK:DESC", "A <b>", "old")
    files = spark.createDataFrame([("x", XML), ("y", XML)], "file string, xml string")
    changes = spark.createDataFrame([("x", 1, "新 <&>")], "file string, xml_index bigint, dest string")
    got = {r.file: r for r in sinks.splice_files(files, changes).collect()}
    assert got["y"].xml == XML and got["y"].changed == 0 and got["y"].unmatched == []
    lost = sinks.splice_files(files, spark.createDataFrame([("x", 7, "n"), ("x", 0, "n")], changes.schema)).where("file = 'x'").first()
    assert lost.changed == 1 and lost.unmatched == [7]
    assert got["x"].xml == XML.replace("<Dest></Dest>", "<Dest>新 &lt;&amp;&gt;</Dest>") and got["x"].intact


def test_xml_to_gate_to_xml(spark, tmp_path):
    """Files are read with their units' numbers, gated, spliced and written as new files, and read back."""
    from lexmill.operators import contract, gate

    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.xml").write_bytes(XML.encode())
    files = sources.read_xml_files(spark, str(tmp_path / "in"))
    units = sources.xml_units(files)
    assert [(u.xml_index, u.rec, u.source, u.dest, u.plugin) for u in units.orderBy("xml_index").collect()] == [(0, "BOOK:DESC", "A <b>", "old", "x.xml"), (1, None, "B", "", "x.xml")]
    none = spark.createDataFrame([], "term_id string, decision_status string, enforcement string, target string, forbidden array<string>, match struct<kind:string,accepted:array<string>,blocked_suffixes:array<string>>, origin string, source string, evidence string, note string")
    keep = spark.createDataFrame([("B",), ("B",), (None,)], "text string")
    got = gate.gate(contract.compile_contract(units, none, global_keep=keep))
    assert [(r.verdict, r.codes) for r in got.orderBy("xml_index").collect()] == [("FAIL", ["XML001"]), ("FAIL", ["KEEP002"])]
    assert gate.summary(got).first().asDict() == {"files": 1, "items": 2, "fails": 2, "warnings": 0, "issues": 2}
    mended = units.select("file", "xml_index", F.when(F.col("xml_index") == 0, "新 <b>").otherwise(F.col("source")).alias("dest"))
    out = sinks.write_xml(sinks.splice_files(files, mended), f"file://{tmp_path}/out").collect()
    assert [r.verified for r in out] == [True]
    again = sources.xml_units(sources.read_xml_files(spark, str(tmp_path / "out")))
    assert sorted(r.dest for r in again.collect()) == ["B", "新 <b>"]
    assert (tmp_path / "out/x.xml").read_bytes() == XML.replace(">old<", ">新 &lt;b&gt;<").replace("<Dest></Dest>", "<Dest>B</Dest>").encode()
    assert {r.verdict for r in gate.gate(contract.compile_contract(again, none, global_keep=keep)).collect()} == {"PASS"}


def test_term_rules_index_listing_table(spark, tmp_path):
    (tmp_path / "r.txt").write_text("StartRule\nSearch=a\nReplace=b\nStartRule\nSearch=\nReplace=c\nStartRule\nSearch=d\nReplace=\n")
    assert {(r.search, r.replace) for r in sources.read_term_rules(spark, str(tmp_path / "r.txt")).collect()} == {("a", "b"), ("d", "")}
    (tmp_path / "i.txt").write_text("3\n x\n7 \n3\n")
    assert sorted(r.xml_index for r in sources.read_index_file(spark, str(tmp_path / "i.txt")).collect()) == [3, 7]
    listing = spark.createDataFrame([("a\\b\0c\0",)], "listing string")
    assert sorted(r.path for r in sources.listing_from_text(listing).collect()) == ["a/b", "c"]
    assert sources.read_listing(spark, str(tmp_path), "*.txt").count() == 2
    lines = spark.createDataFrame([("| English | 中文 |",), ("| --- | --- |",), ("| Stone | 石 |",), ("text",)], "value string")
    assert [tuple(r) for r in sources.parse_pipe_table(lines, ["english", "chinese"], header=["english", "中文"]).collect()] == [("Stone", "石")]


def test_sinks_refuse_to_overwrite(spark, tmp_path):
    df = spark.range(2)
    sinks.write_report(df, str(tmp_path / "r"))
    with pytest.raises(Exception, match="exist"):
        sinks.write_report(df, str(tmp_path / "r"))
    sinks.append_snapshot(df, str(tmp_path / "s"))
    sinks.append_snapshot(df, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 4
    sinks.write_json(df, str(tmp_path / "j"))


def test_stream_gates_files(spark, tmp_path):
    rows = spark.sql("select 'p' plugin, unit_id, 1 version, timestamp'2024-01-01' ts, 'Dragon' source, dest from values (1L, '龍'), (2L, '龙'), (1L, '龍') t(unit_id, dest)")
    rows.write.parquet(str(tmp_path / "in"))
    stream = distinct_revisions(read_unit_stream(spark, str(tmp_path / "in"), "plugin string, unit_id bigint, version int, ts timestamp, source string, dest string"))
    from lexmill.schema import CONTRACT

    seen = []
    q = gate_stream(stream.withColumn("contract", F.lit(None).cast(CONTRACT)), lambda df, _: seen.extend((r.unit_id, r.verdict) for r in df.collect()), str(tmp_path / "c"))
    q.awaitTermination(60)
    assert sorted(seen) == [(1, "FAIL"), (2, "PASS")]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "unit_id bigint, dest string")
    patterns = spark.createDataFrame([("月",), ("岚石",)], "pattern string")
    assert workflow.pattern_hits(empty, patterns, "unit_id", "dest", "pattern").count() == 0
    assert validate.exit_status(empty).first().status == 0
    assert workflow.min_by_version(spark.createDataFrame([], "version struct<major:int,minor:int,patch:int>, name string"), "version", "name", (3, 10, 0)).collect() == [(None, None)]


def test_syntax_errors(spark):
    files = spark.createDataFrame([("a.py", "x = 1\n"), ("b.py", "x = (\n"), ("c.py", "\nif True\n    pass"), ("d.py", None), ("e.py", "\nreturn 1"), ("f.py", "\ufeffx = 1"), ("g.py", "def f(a, a): pass")], "path string, text string")
    assert sorted((r.path, r.line) for r in validate.syntax_errors(files).collect()) == [("b.py", 1), ("c.py", 2), ("e.py", 2), ("g.py", 1)]
    raw = spark.createDataFrame([("a.py", b"\xef\xbb\xbfx = 1"), ("b.py", b"x = '\xff'")], "path string, text binary")
    assert [(r.path, r.line) for r in validate.syntax_errors(raw).collect()] == [("b.py", 0)]


def test_header_blocks(spark):
    text = "lost\n[d-01_002]:\n  first\t\n more\n\t\n12 twelve\nd-x: stays\n d-01_002: last \n"
    got = workflow.header_blocks(spark.createDataFrame([(1, text), (2, None)], "k int, text string"), "k", "text").collect()
    assert {(r.k, r.id): r.body for r in got} == {(1, "d-01_002"): "last", (1, "12"): "twelve\nd-x: stays"}
    first = workflow.header_blocks(spark.createDataFrame([(1, text.rsplit(" d-01", 1)[0])], "k int, text string"), "k", "text")
    assert {r.id: r.body for r in first.collect()}["d-01_002"] == "first\t\n more"


def test_chained_lookup_states_and_time(spark):
    wanted = spark.createDataFrame([("d_0", "s", 0), ("d_1", "s", 1), ("d_2", "s", 2)], "id string, source string, at bigint")
    parsed = spark.createDataFrame([("d_0", "zero"), ("x_1", "one"), ("x_2", " \n")], "id string, body string")
    assert sorted((r.id, r.body, r.found) for r in workflow.chained_lookup(wanted, parsed).collect()) == [("d_0", "zero", "id"), ("d_1", "one", "place"), ("d_2", None, "MISSING")]
    now = spark.createDataFrame([("a", "REVIEW"), ("b", "KEEP"), ("c", None), ("d", "CONFIRMED")], "term_id string, status string")
    asked = spark.createDataFrame([("a", "CONFIRMED"), ("b", "CONFIRMED"), ("c", "KEEP"), ("z", "KEEP")], "term_id string, status string")
    assert sorted((r.term_id, r.status, r.error) for r in workflow.advance(now, asked).collect()) == [("a", "CONFIRMED", None), ("b", "KEEP", "KEEP to CONFIRMED"), ("c", "KEEP", None), ("d", "CONFIRMED", None)]
    events = spark.sql("select 'g' g, explode(array(timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:00:01.5')) ts")
    assert workflow.elapsed(events, "g").first().seconds == 1.5
    names = spark.createDataFrame([("Stone Keep",), ("Nowhere",)], "english string")
    evidence = spark.createDataFrame([("The Stone Keep fell.", "石堡陷落。", "technical"), ("Stone Keeper", "x", "core"), ("To Stone Keep", "往石堡", "core"), ("Stone Keep", "Stone Keep", "core")], "source string, dest string, tier string")
    assert [(r.dest, r.place) for r in workflow.evidence_in_sentences(names, evidence).orderBy("place").collect()] == [("往石堡", 1), ("石堡陷落。", 2)]


def test_triage_and_layers(spark):
    from lexmill.operators import contract

    w = spark.createDataFrame([(1, "t", "D"), (2, "t", "D"), (3, "t", "D"), (1, "none", "D"), (1, "blank", "D"), (9, "t", "D")], "xml_index bigint, term_id string, expected string")
    units = spark.createDataFrame([(1, "a Term", "D"), (2, "a term", "D"), (3, "Term", "x"), (3, "Term", "x")], "unit_id bigint, source string, dest string")
    terms = spark.createDataFrame([("t", "Term"), ("t", "Term"), ("blank", "")], "term_id string, source string")
    got = sorted((r.xml_index, r.term_id, r.triage) for r in contract.triage(w, units, terms).collect())
    assert got == [(1, "blank", "CONTRACT ERROR"), (1, "none", "CONTRACT ERROR"), (1, "t", "FALSE POSITIVE"), (2, "t", "IGNORE"), (3, "t", "REVIEW"), (9, "t", "NOT FOUND")]
    keys, layer = spark.createDataFrame([("k",)], "k string"), spark.createDataFrame([("k", "b"), ("k", "a")], "k string, value string")
    assert [tuple(r) for r in contract.resolve(keys, "k", layer).collect()] == [("k", "a", 1)]
