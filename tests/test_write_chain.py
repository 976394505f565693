"""Executor-side writing, the write chain, and the registered sources."""

import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from lexmill import sinks, staging
from lexmill.functions import xmltext
from lexmill.operators import chain
from lexmill.sources import formats, read_contracts, read_keep_lists, read_xml_files, xml_units

PAGE = """<?xml version="1.0"?>
<!-- as it is -->
<Root a='1'>
 <String List="0" Partial='2'><EDID>e_{i}</EDID><REC id="0" idMax="1">QUST:CNAM</REC><Source>Caf&#233; &amp; &#x41; {i}</Source><Dest>old {i}</Dest></String>
 <String><REC>BOOK:DESC</REC><Source><![CDATA[<b>raw & {i}</b>]]></Source>  <Dest  note="x">&lt;b&gt;</Dest></String>
 <String><Source/><Dest/></String>
</Root>
"""


def documents(spark, n, same=False):
    rows = [(f"mem:/in/{i % 7}/{'same' if same else i}.xml" if not same else f"mem:/in/{i}/same.xml", PAGE.replace("{i}", str(i))) for i in range(n)]
    return spark.createDataFrame(rows, "file string, xml string")


def test_units_have_attributes_and_references():
    got = list(xmltext.units(PAGE.replace("{i}", "7")))
    assert got[0] == (0, {"EDID": "e_7", "REC": "QUST:CNAM", "Source": "Café & A 7", "Dest": "old 7"}, {"List": "0", "Partial": "2", "REC.id": "0", "REC.idMax": "1"})
    assert got[1] == (1, {"REC": "BOOK:DESC", "Source": "<b>raw & 7</b>", "Dest": "<b>"}, {"Dest.note": "x"})
    assert got[2] == (2, {"Source": "", "Dest": ""}, {})
    assert xmltext.unescaped("&#0; &nope; &#xD800; &#128512;") == "&#0; &nope; &#xD800; 😀"
    new, done = xmltext.spliced(PAGE, {0: "a<b&", 1: "x", 2: "y", 9: "z"})
    assert done == {0, 1} and "<Dest>a&lt;b&amp;</Dest>" in new and '<Dest  note="x">x</Dest>' in new
    assert xmltext.skeleton(new) == xmltext.skeleton(PAGE) and [v["Dest"] for _, v, _ in xmltext.units(new)] == ["a<b&", "x", ""]


def test_two_documents_of_one_base_name(spark, tmp_path):
    files = documents(spark, 5, same=True).select("file", "xml", F.lit(True).alias("intact"))
    with pytest.raises(Exception, match="two documents are named"):
        sinks.write_xml(files, f"{tmp_path}/flat").collect()
    assert not list((tmp_path / "flat").glob("*.xml")) and not (tmp_path / "flat" / formats.STAGING).joinpath("x").exists()
    got = sinks.write_xml(files, f"{tmp_path}/tree", root="mem:/in").collect()
    assert sorted(r.path for r in got) == [f"{i}/same.xml" for i in range(5)] and all(r.verified for r in got)
    assert (tmp_path / "tree" / "3" / "same.xml").read_text() == PAGE.replace("{i}", "3")


def test_a_thousand_documents_and_a_killed_task(spark, tmp_path):
    """A task that dies after some of its documents leaves drafts only; the job that runs again completes the folder."""
    rows = spark.range(0, 1000, 1, 8).select(F.concat(F.lit("f"), "id").alias("file"), F.concat(F.col("id") % 10, F.lit("/"), F.col("id"), F.lit(".xml")).alias("path"), F.repeat(F.lit("é"), F.col("id").cast("int")).alias("content"))
    dies = rows.withColumn("content", F.when(F.col("file") == "f777", F.raise_error(F.lit("killed"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="killed"):
        sinks.write_documents(dies, f"file://{tmp_path}/out", job="j")
    assert not list((tmp_path / "out").glob("*/*.xml")) and not list((tmp_path / "out").glob("_staging/*"))
    assert sinks.write_documents(rows, f"file://{tmp_path}/out", job="j").where("verified").count() == 1000
    before = (tmp_path / "out/7/777.xml").stat().st_mtime_ns
    assert sinks.write_documents(rows, f"file://{tmp_path}/out", job="j").where("verified").count() == 1000
    assert (tmp_path / "out/7/777.xml").stat().st_mtime_ns == before
    other = rows.where("file = 'f5'").withColumn("content", F.lit("other"))
    with pytest.raises(Exception, match="with other content"):
        sinks.write_documents(other, f"file://{tmp_path}/out", job="k")


def test_tasks_that_go_on_after_a_job_has_failed(tmp_path):
    """Drafts that come while the staging folder is cleared go as well."""
    at, end = tmp_path / formats.STAGING / "j", time.time() + 0.8

    def late():
        while time.time() < end:
            try:
                at.mkdir(parents=True, exist_ok=True)
                (at / str(time.time_ns())).write_text("x")
            except OSError:
                pass

    tasks = [threading.Thread(target=late) for _ in range(3)]
    for t in tasks:
        t.start()
    time.sleep(0.1)
    formats._DocumentWriter(str(tmp_path), "j").abort([])
    for t in tasks:
        t.join()
    assert not at.exists()


def changes(spark):
    return spark.createDataFrame([(f"mem:/in/{i % 7}/{i}.xml", i % 2, f"新 <{i}>") for i in range(20)], "file string, xml_index bigint, dest string")


@pytest.mark.parametrize("stage,late", [*((s, False) for s in chain.STAGES), ("written", True)])
def test_a_chain_cut_off_after_or_in_any_stage(spark, tmp_path, monkeypatch, stage, late):
    files, home = documents(spark, 20), f"file://{tmp_path}"
    real = chain.staging.create

    def cut(spark_, path, text):
        if path.endswith(f"states/{stage}.json"):
            if late:
                real(spark_, path, text)
            raise KeyboardInterrupt
        return real(spark_, path, text)

    monkeypatch.setattr(chain.staging, "create", cut)
    with pytest.raises(KeyboardInterrupt):
        chain.WriteChain(spark, home, "one").run(files, changes(spark), root="mem:/in")
    monkeypatch.setattr(chain.staging, "create", real)
    got = chain.WriteChain(spark, home, "one").run(files, changes(spark), root="mem:/in")
    assert got == {"version": 1, "chain": "one", "n": 20, "digest": chain.set_digest(changes(spark), "file", "xml_index", "dest").first().digest, "documents": 20}
    assert chain.versions(spark, home) == [1] and len(list(tmp_path.glob("chains/one/documents/*/*.xml"))) == 20
    back = {(r.file, r.xml_index): r.dest for r in formats.open_(spark, "xml", f"{home}/chains/one/documents").collect()}
    assert back["3/3.xml", 1] == "新 <3>" and back["3/3.xml", 0] == "old 3" and back["4/4.xml", 0] == "新 <4>"


def test_one_of_two_chains_gets_a_version(spark, tmp_path):
    files, home = documents(spark, 20), f"file://{tmp_path}"
    late = chain.WriteChain(spark, home, "late")
    staging.create(spark, f"{late.at}/states/consumed.json", json.dumps(late._consumed(files, changes(spark), None)))
    assert chain.WriteChain(spark, home, "first").run(files, changes(spark), "mem:/in")["version"] == 1
    with pytest.raises(chain.Conflict):
        late.run(files, changes(spark), "mem:/in")
    assert chain.WriteChain(spark, home, "next").run(files, changes(spark).limit(3), "mem:/in")["version"] == 2
    assert [tuple(r)[:3] for r in chain.history(spark, home).orderBy("version").collect()] == [(1, "first", 20), (2, "next", 3)]


def test_digest_of_a_set(spark):
    rows = [(1, "a"), (2, None), (2, None), (3, "")]
    one = chain.set_digest(spark.createDataFrame(rows, "i int, t string"), "i", "t").first()
    again = chain.set_digest(spark.createDataFrame(rows[::-1], "i int, t string").repartition(5), "i", "t").first()
    assert one == again and one.n == 4
    for other in (rows[:3], [*rows[:3], (3, None)], [(1, "a"), (2, None), (3, ""), (3, "")], [(12, "")]):
        assert chain.set_digest(spark.createDataFrame(other, "i int, t string"), "i", "t").first().digest != one.digest


def test_sources_split_and_push_down(spark, tmp_path):
    rules = [(f"s{i}" + "x" * (i * 7 % 30), f"r{i}") for i in range(60)]
    (tmp_path / "rules").mkdir()
    (tmp_path / "rules" / "a.txt").write_bytes(b"\xef\xbb\xbf; note\r\n" + "".join(f"StartRule\r\n Search = {s} \r\nReplace={r}\r\nEnd\r\n" for s, r in rules).encode())
    (tmp_path / "rules" / "b.txt").write_text("StartRule\nSearch=\nReplace=c\nStartRule\nSearch=last\nReplace=")
    for size in (9, 1000, 1 << 20):
        got = formats.open_(spark, "rules", str(tmp_path / "rules"), partBytes=size)
        assert sorted((r.search, r.replace) for r in got.collect()) == sorted([*rules, ("last", "")]), size
    few = formats.open_(spark, "rules", str(tmp_path / "rules")).where("search = 'last'")
    assert [tuple(r) for r in few.collect()] == [("b.txt", "last", "")]
    (tmp_path / "n.txt").write_text("5\n x\n\n 12 \n999999999999999999999\n7")
    for size in (1, 100):
        numbers = formats.open_(spark, "index", str(tmp_path / "n.txt"), partBytes=size)
        assert sorted(r.xml_index for r in numbers.collect()) == [5, 7, 12]
    assert sorted(r.xml_index for r in numbers.where("xml_index > 5 and xml_index < 12").collect()) == [7]
    for name in ("a/b/c.txt", "a/d.txt", "e.txt", "f.md", "_hidden/x.txt", "a/.y.txt"):
        (tmp_path / "list" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "list" / name).write_text("12345")
    listing = formats.open_(spark, "listing", str(tmp_path / "list"))
    assert sorted((r.path, r.length) for r in listing.collect()) == [(p, 5) for p in ("a/b/c.txt", "a/d.txt", "e.txt", "f.md")]
    assert [r.path for r in listing.where("path like 'a/%'").orderBy("path").collect()] == ["a/b/c.txt", "a/d.txt"]
    assert sorted(r.path for r in listing.where(F.endswith("path", F.lit(".md"))).collect()) == ["f.md"]


def test_xml_source_equals_units_of_documents(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"{i}").mkdir()
        (tmp_path / f"{i}" / "x.xml").write_text(PAGE.replace("{i}", str(i)))
    got = formats.open_(spark, "xml", str(tmp_path), partBytes=100)
    assert got.rdd.getNumPartitions() == 6
    cols = ["xml_index", "rec", "edid", "source", "dest"]
    want = xml_units(read_xml_files(spark, str(tmp_path)))
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(map(tuple, want.select(*cols).collect()), key=str)
    assert [(r.file, r.xml_index) for r in got.where("file = '4/x.xml' and rec = 'BOOK:DESC'").collect()] == [("4/x.xml", 1)]
    assert got.where("rec is null").count() == 6


def test_contracts_and_keep_lists(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "1.json").write_text(json.dumps({"keep_list": ["A"], "terms": {"t": {"target": "甲"}}}))
    (tmp_path / "c" / "2.json").write_text("{broken")
    got = {r.file[-6:]: r for r in read_contracts(spark, str(tmp_path / "c")).collect()}
    assert got["1.json"].contract.keep_list == ["A"] and got["1.json"].contract.terms["t"].target == "甲" and got["2.json"].contract is None and got["2.json"].corrupt
    (tmp_path / "k").mkdir()
    (tmp_path / "k" / "1.json").write_text('["A", "B", null, "A"]')
    (tmp_path / "k" / "2.json").write_text('{"keep_list": ["C"]}')
    (tmp_path / "k" / "3.json").write_text("[")
    assert sorted(r.text for r in read_keep_lists(spark, str(tmp_path / "k")).collect()) == ["A", "B", "C"]


def test_many_small_parts_are_few_tasks(spark, tmp_path):
    """However small parts are to be, and however many files there are, tasks stay few; every number is read once."""
    (tmp_path / "n").mkdir()
    for i in range(40):
        (tmp_path / "n" / f"{i}.idx").write_text("\n".join(str(1000 * i + j) for j in range(200)))
    got = formats.open_(spark, "index", str(tmp_path / "n"), partBytes=64)
    assert got.rdd.getNumPartitions() <= 2 * formats.MANY_PARTS
    assert sorted(r.xml_index for r in got.collect()) == [1000 * i + j for i in range(40) for j in range(200)]


def test_documents_are_handed_on_in_small_batches(tmp_path):
    """A part of many large documents is never held at once."""
    for i in range(30):
        (tmp_path / f"{i}.xml").write_text("é" * 1_000_000)
    reader = formats.Documents({"path": str(tmp_path)}).reader(None)
    got = [list(reader.read(p)) for p in reader.partitions()]
    assert sum(b.num_rows for part in got for b in part) == 30
    assert max(b.num_rows for part in got for b in part) <= formats.BATCH_BYTES // 1_000_000 + 1
