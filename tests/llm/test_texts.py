"""Encoding, token files, HTML and licences."""

import hashlib
import zlib
from pathlib import Path

import numpy as np
import pytest
from helpers import DATA, same_rows

from lexmill.llm import op2_bpe, op4_tokenfile, op7_html, op8_licenses
from lexmill.llm.queries import ORACLE_SQL, QUERIES

TEXTS = ["", None, "  a  b ", "It's 3 o'clock, don't!", "aaaaaaaaaaaa aaa", "Ünïcode ŁÓDŹ İstanbul", "漢字 ﬁ é Å ΣΑΣ", "<|endoftext|> x <|startoftext|>", "\x00\x1c\x85   z", "😀👩‍👩‍👧", "word " * 3000, "\n\n \n", "½²³ x_y--z"]


@pytest.fixture(scope="module")
def docs(make_docs):
    return make_docs([*enumerate(TEXTS), (2, TEXTS[2]), (None, "null id")])


def test_bpe_equals_library(spark, docs):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(op2_bpe.default_path())
    got = {r.doc_id: r for r in op2_bpe.digest(op2_bpe.encode(docs)).collect()}
    for i, t in enumerate(TEXTS):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert op2_bpe.encode(docs).where("doc_id = 2").count() == 2
    assert op2_bpe.digest(op2_bpe.encode(docs.limit(0))).count() == 0


def test_bpe_table_of_known_pieces_turns_over(monkeypatch):
    monkeypatch.setattr(op2_bpe, "KEPT", 3)
    bpe = op2_bpe.PairIndexBpe(op2_bpe.default_path())
    texts = [t or "" for t in TEXTS]
    assert [bpe.encode([t])[0] for t in texts * 2] == bpe.encode(texts) * 2


def test_bpe_on_documents(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(op2_bpe.default_path())
    got = {r.doc_id: r for r in QUERIES["op2_bpe"](spark, DATA).collect()}
    for r in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(lib.encode(r.text, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()


@pytest.mark.parametrize("block", [1 << 6, 1 << 19])
def test_token_file_round_trip(spark, docs, monkeypatch, block):
    from tokenizers import Tokenizer

    monkeypatch.setattr(op4_tokenfile, "BLOCK_TOKENS", block)
    monkeypatch.setattr(op4_tokenfile, "BUCKET_TOKENS", 1000)
    lib = Tokenizer.from_file(op4_tokenfile.default_path())
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.start, r.n_tokens, r.ids_crc32) for r in op4_tokenfile.write(docs).read().collect())
    start, want = 0, []
    for i, t in [(None, "null id"), (0, TEXTS[0]), (1, TEXTS[1]), (2, TEXTS[2]), (2, TEXTS[2]), *list(enumerate(TEXTS))[3:]]:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        want.append(((i is not None, i or 0), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == sorted(want)


def test_token_file_is_read_by_its_folder(spark, make_docs, monkeypatch, tmp_path):
    """A session that knows the folder alone reads every id back; parts lie in order; a hot id and nulls are dealt out."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(op4_tokenfile, "BUCKET_TOKENS", 150)
    lib = Tokenizer.from_file(op4_tokenfile.default_path())
    rows = [(None if i < 30 else 7 if i < 90 else i, f"text number {i} of {'many ' * (i % 5)}") for i in range(150)]
    at = f"file://{tmp_path}/tokens"
    op4_tokenfile.write(make_docs(rows), to=at)
    got = op4_tokenfile.TokenFile(spark.newSession(), at).ids().collect()
    want = sorted((-1 if i is None else i, np.array([*lib.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, bytes(r.ids)) for r in got) == want
    by_start = sorted(got, key=lambda r: r.start)
    ids = [-1 if r.doc_id is None else r.doc_id for r in by_start]
    assert ids == sorted(ids) and all(a.start + len(a.ids) // 4 == b.start for a, b in zip(by_start, by_start[1:]))
    blocks = spark.read.parquet(f"{at}/blocks").select("bucket", "doc_ids").collect()
    assert max(sum(len(r.doc_ids) for r in blocks if r.bucket == b) for b in {r.bucket for r in blocks}) < 40
    parts = spark.read.parquet(f"{at}/blocks").selectExpr("_metadata.file_name as f", "bucket").groupBy("f").agg({"bucket": "min"}).orderBy("f").collect()
    assert [r[1] for r in parts] == sorted(r[1] for r in parts)


def test_token_file_of_nothing(docs):
    assert op4_tokenfile.write(docs.limit(0)).read().count() == 0


def test_vbyte():
    rng = np.random.default_rng(0)
    for most in (8, 16, 32):
        x = (rng.integers(0, 2**most, 1000) >> rng.integers(0, most, 1000)).astype(np.uint32)
        control, data = op4_tokenfile.vbyte_encode(x, np.array([1, 0, 249]))
        assert (op4_tokenfile.vbyte_decode(control[0], data[0]) == x[:4]).all() and control[1] == data[1] == b""
        assert (op4_tokenfile.vbyte_decode(control[2], data[2]) == x[4:]).all()
        assert (op4_tokenfile.vbyte_decode(b"".join(control), b"".join(data)) == x).all()
    assert op4_tokenfile.vbyte_decode(b"", b"").size == 0


PAGES = {
    "<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><article><h1>Title</h1><p>One &amp; <b>two</b>\n three<br>four.</p><p>x</p></article><footer>&copy; me</footer>": "Title\n\nOne & two three four.\n\nx",
    "<article><p>a<script>var t='</p>';</script>b</p><div class='ad'>buy</div><p>c<!-- <p>no</p> --></p></article>": "ab\n\nc",
    "<article><p>kept</p><section id='comments'><p>" + "rude " * 90 + "</p></section></article>": "kept",
    "<div class=menu><article><p>unclosed menu</p></article>": "unclosed menu",
    "<p>" + "long text " * 30 + "</p><p>short.</p><p>" + "more text " * 30 + "</p>": "long text " * 29 + "long text\n\nshort.\n\n" + "more text " * 29 + "more text",
    "": "",
    "<p></p>": "",
    "<article>&lt;p&gt; &nbsp; &#233; a < b</article>": "<p> é a < b",
}


def test_html(spark):
    rows = [(i, h, "u", "clash") for i, h in enumerate([*PAGES, None])]
    df = spark.createDataFrame(rows, "page_id bigint, html string, url string, text string")
    got = {r.page_id: r for r in op7_html.extract(df).collect()}
    for i, want in enumerate([*PAGES.values(), ""]):
        assert got[i].text == want and got[i].n_chars == len(want) and got[i].url == "u"
    assert op7_html.extract(df.limit(0)).count() == 0


def test_link_lists_are_no_text(spark):
    menu = "".join(f"<li><a href=x>entry number {i} of the list</a></li>" for i in range(40))
    body = "".join(f"<p>Paragraph {i} tells a story of some length about nothing much at all.</p>" for i in range(9))
    got = op7_html.main_text(f"<body><div><ul>{menu}</ul></div><div>{body}</div><div><ul>{menu}</ul></div></body>")
    assert got.startswith("Paragraph 0") and got.count("\n\n") == 8 and "entry" not in got


def test_distribution_decides_where_articles_are_marked():
    body = [f"Paragraph {i} tells a story of some length about nothing much at all." for i in range(9)]
    html = "".join(f"<p>{x}</p>" for x in body)
    cards = "".join(f"<article><h3><a href=x>Card {i}</a></h3><p>Teaser {i}.</p></article>" for i in range(3))
    foot = "".join(f"<div><a href=x>link {i}</a></div>" for i in range(5))
    assert op7_html.main_text(f"<body><div>{html}</div>{foot}<div>{cards}</div></body>").split("\n\n") == body  # the cards do not hide the body
    assert op7_html.main_text(f"<body><div class='content promo'>{html}</div>{foot}</body>").split("\n\n") == body  # nor does a hint on the wrapper
    long = "<p>" + "A comment that goes on and on. " * 60 + "</p>"
    assert op7_html.main_text(f"<body><article><h1>Title</h1><p>Short.</p></article><div class=ad>{'Buy ' * 90}</div><section class=comments>{long}{long}</section></body>") == "Title\n\nShort."
    ads = "<div>Buy one of these.</div>"
    assert op7_html.main_text(f"<body>{ads}{foot}<article>{html}<p>End.</p></article>{foot}{ads}</body>").split("\n\n") == [*body, "End."]
    assert op7_html.main_text(f"<body>{foot}<div>{html}</div>{foot}</body>").split("\n\n") == body  # no mark at all


def test_ends_that_are_left_out():
    body = "".join(f"<p>Paragraph {i} tells a story of some length about nothing much at all.</p>" for i in range(3))
    want = op7_html.main_text(f"<article>{body}</article>")
    assert want.count("\n\n") == 2
    assert op7_html.main_text(f"<article><p class=notice>We set cookies{body}</article>") == want
    assert op7_html.main_text(f"<article><ul><li class=ad>Buy<li class='ad x'>Buy more</ul>{body}</article>") == want
    assert op7_html.main_text(f"<article>{body}<dl><dt class=ad>Buy<dd class=ad>more</dl></article>") == want
    assert op7_html.main_text(f"<body><div class='content with-sidebar'>{body}</div></body>") == want
    assert op7_html.main_text(f"<article><div class=ad><div>Buy</div>this</div>{body}</article>") == want


def test_long_attributes_and_pages(make_docs):
    body = "".join(f"<p title='a > b {i}'>Paragraph {i} tells a story of some length about nothing much at all.</p>" for i in range(4000))
    got = op7_html.main_text(f"<article><img alt='{'x > ' * 20_000}'><p data-x=\"a 'b\">It's one</p>{body}<p it's>end of it all</p></article>")
    assert "x >" not in got and "a > b" not in got and got.count("\n\n") == 4001 and got.endswith("end of it all")


def marked_lines(page):
    """The blocks inside <article> that no boilerplate element holds, by a plain recursive reading of well-formed pages."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.open, self.lines, self.parts = [], [], []

        def flush(self):
            line = " ".join("".join(self.parts).split())
            self.parts = []
            if line:
                self.lines.append(line)

        def handle_starttag(self, tag, attrs):
            if tag in op7_html.BLOCKS:
                self.flush()
            if tag == "br":
                self.parts.append(" ")
            if tag not in op7_html.VOID:
                hinted = any(w.lower() in op7_html.HINTS for k, v in attrs if k in ("class", "id", "role") for w in op7_html._WORD.findall(v or ""))
                self.open.append((tag, tag in op7_html.SILENT or (hinted and tag not in ("article", "main", "body", "html"))))

        def handle_endtag(self, tag):
            if tag in op7_html.BLOCKS:
                self.flush()
            while self.open and any(t == tag for t, _ in self.open) and self.open.pop()[0] != tag:
                pass

        def handle_data(self, data):
            if any(t in op7_html.ARTICLE for t, _ in self.open) and not any(b for _, b in self.open):
                self.parts.append(data)

    r = Reader()
    r.feed(page)
    r.flush()
    return "\n\n".join(r.lines)


def test_html_of_pages(spark):
    """On the tables' pages, which mark their article, the result is that article, and it comes from the distribution."""
    rows = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in QUERIES["op7_html"](spark, DATA).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == marked_lines(h) for i, h in rows.items())


def test_licences_equal_sql(spark, duck):
    same_rows(QUERIES["op8_licenses"](spark, DATA), duck, ORACLE_SQL["op8_licenses"])


def test_licences(make_docs):
    mit = dict(op8_licenses.KNOWN)["MIT"]
    changed = "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(", ", " ,  ").replace("SUBLICENSE", "sub-licence")
    rows = make_docs([(1, mit), (2, changed), (3, mit + " But not quite."), (4, None), (5, ""), (6, "story\nReleased under the MIT Licence!\nstory\nAll rights reserved"), (6, "x")])
    got = sorted((r.doc_id, r.license, r.notices, r.n_notices) for r in op8_licenses.scan(rows).collect())
    assert got == [(1, "MIT", "", 0), (2, "MIT", "", 0), (3, None, "", 0), (4, None, "", 0), (5, None, "", 0), (6, None, "", 0), (6, None, "MIT-notice,all-rights-reserved", 2)]


def test_licence_files(make_docs):
    """Whole licence files, as projects have them."""
    of = lambda name: (Path(op8_licenses.__file__).parent / "licenses" / f"{name}.txt").read_text()
    mit, apache = dict(op8_licenses.KNOWN)["MIT"], of("Apache-2.0")
    files = {
        1: ("MIT", "MIT License\n\nCopyright (c) 2021 Someone\n\n" + mit),
        2: ("ISC", "ISC License\n\nCopyright (c) 2021, Someone\n\n" + dict(op8_licenses.KNOWN)["ISC"]),
        3: ("Apache-2.0", apache),
        4: ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2020 Someone")),
        5: ("Apache-2.0", apache[: apache.index("APPENDIX")]),
        6: ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Someone\nAll rights reserved.\n\n" + of("BSD-3-Clause")),
        7: ("BSD-2-Clause", "Copyright 2020 Someone\n\n" + of("BSD-2-Clause").replace("1. ", "* ").replace("2. ", "* ")),
        8: (None, "MIT License\n\nCopyright (c) 2021 Someone\n\n" + mit + "\nNo use on Sundays."),
        9: (None, "MIT License"),
    }
    names = "GPL-1.0 GPL-2.0 GPL-3.0 LGPL-2.0 LGPL-2.1 LGPL-3.0 GFDL-1.2 GFDL-1.3 MPL-1.1 MPL-2.0 CC0-1.0 Unlicense BSL-1.0 Zlib".split()
    files |= {20 + i: (n, of(n)) for i, n in enumerate(names)}
    got = {r.doc_id: r.license for r in op8_licenses.scan(make_docs([(i, t) for i, (_, t) in files.items()])).collect()}
    assert got == {i: n for i, (n, _) in files.items()}
