"""License scans by canonical digest lookup, in DataFrame functions only.

A text is made canonical: A-Z lower-cased, copyright lines dropped, equivalent spellings unified, punctuation and white
space between words reduced to one space. The SHA-256 of the entire canonical text is hash-joined to the digests of known
licence texts; the same digests are looked up for each line, which finds notices inside longer texts. The known texts are
a fixed list, so the broadcast side has a fixed size; documents are never shuffled.

Known are the notices and texts of KNOWN and the files in ``licenses``, each in the forms that files really have: with and
without its usual titles and "All rights reserved.", without what follows the terms, numbered or not. A text that differs
in a word from all of these is not found.

Null texts are the empty text and match nothing; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Known licences and notices by name.
KNOWN = [
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT-notice", "Released under the MIT License."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0-notice", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0-notice", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0-notice", "Released under CC0 1.0."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
]
#: Title lines that files of these licences may open with.
TITLES = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)", "Zero-Clause BSD (0BSD)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD License"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"],
    "BSL-1.0": ["Boost Software License 1.0"],
    "Unlicense": ["The Unlicense", "Unlicense"],
}
#: Where the terms end in texts that have more to say.
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
#: Spellings that count as one, after case and punctuation.
SPELLINGS = [("licence", "license"), ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("organisation", "organization"), ("favour", "favor"), ("http ", "https ")]
#: Patterns that Java and RE2 read alike.
COPYRIGHT_LINE = r"(^|\n)[ \t*#/;-]*(copyright[ \t]*(\(c\)|©|[0-9][0-9][0-9][0-9])|\(c\)[ \t]|©)[^\n]*"
NOT_WORD = r"[\x00-\x09\x0b-\x2f\x3a-\x60\x7b-\x7f©“”‘’«»–—…]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical_lines(text: Column) -> Column:
    """The canonical text with its line ends."""
    t = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    t = F.regexp_replace(t, COPYRIGHT_LINE, "\n")
    t = F.regexp_replace(t, NOT_WORD, " ")
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def digest_of(line: Column) -> Column:
    return F.sha2(F.trim(line).cast("binary"), 256)


def forms(name: str, text: str) -> list[str]:
    """The text of a licence as its files have it."""
    out = [text]
    if END_OF_TERMS in text:  # with the appendix, without it, and where its copyright line is filled in
        head = text[: text.index(END_OF_TERMS)]
        out += [head + END_OF_TERMS, head, re.sub(r"\n[ ]*Copyright \[yyyy\][^\n]*", "", text)]
    if name == "BSL-1.0":
        out.append(text.split("\n", 1)[1])
    if name.startswith("BSD-"):
        out += [x.replace("COPYRIGHT\nHOLDER OR", "COPYRIGHT\nOWNER OR") for x in out]
        out += [re.sub(r"(?m)^[0-9]\. ", "* ", x) for x in out]
        out += ["All rights reserved.\n" + x for x in out]
    elif name in ("MIT", "ISC", "0BSD"):
        out.append("All rights reserved.\n" + text)
    return out + [f"{title}\n{x}" for title in TITLES.get(name, []) for x in out]


@cache
def all_known() -> list[tuple[str, str]]:
    """(name, text) of KNOWN, then of all forms of its licences and of the files."""
    files = [(p.stem, p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))]
    return KNOWN + [(n, x) for n, t in [*(k for k in KNOWN if k[0] in TITLES), *files] for x in forms(n, t)]


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> list[tuple[str, str]]:
    """(digest, name) of the known texts; a name whose canonical text another one has already is left out."""
    rows = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(known or all_known())], "i int, name string, text string")
    got = rows.select("i", "name", digest_of(F.regexp_replace(canonical_lines(F.col("text")), "[ \n]+", " ")).alias("digest")).orderBy("i").collect()
    out: dict[str, str] = {}
    for r in got:
        out.setdefault(r.digest, r["name"])
    return list(out.items())


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(key, license: of the entire text or null, n_notices, notices: names found on lines, canonical_sha256)."""
    spark = docs.sparkSession
    digests = known_digests(spark, known)
    names = F.create_map(*[F.lit(x) for pair in digests for x in pair])
    rows = docs.select(F.col(key), canonical_lines(F.col(text).cast("string")).alias("c"))
    rows = rows.select(key, digest_of(F.regexp_replace("c", "[ \n]+", " ")).alias("canonical_sha256"), F.transform(F.split("c", "\n"), digest_of).alias("lines"))
    found = F.filter(F.transform("lines", lambda d: F.try_element_at(names, d)), lambda n: n.isNotNull())
    rows = rows.select(key, "canonical_sha256", found.alias("found"))
    table_ = F.broadcast(spark.createDataFrame(digests, "canonical_sha256 string, license string"))
    return rows.join(table_, "canonical_sha256", "left").select(key, "license", F.size("found").cast("bigint").alias("n_notices"), F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("notices"), "canonical_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    canon = f"regexp_replace(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {q(COPYRIGHT_LINE)}, chr(10), 'g'), {q(NOT_WORD)}, ' ', 'g')"
    for a, b in SPELLINGS:
        canon = f"replace({canon}, {q(a)}, {q(b)})"
    values = ", ".join(f"({i}, {q(n)}, {q(t)})" for i, (n, t) in enumerate(KNOWN))
    return f"""
WITH known AS (
  SELECT digest, arg_min(name, i) AS name FROM (
    SELECT i, name, sha256(trim(regexp_replace({canon}, '[ \\n]+', ' ', 'g'))) AS digest FROM (VALUES {values}) v(i, name, text)
  ) GROUP BY digest
),
docs AS (SELECT row_number() OVER () AS r, doc_id, {canon} AS c FROM documents),
whole AS (SELECT r, doc_id, sha256(trim(regexp_replace(c, '[ \\n]+', ' ', 'g'))) AS canonical_sha256 FROM docs),
lines AS (SELECT r, sha256(trim(unnest(string_split(c, chr(10))))) AS digest FROM docs),
hits AS (SELECT r, count(*) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM lines JOIN known USING (digest) GROUP BY r)
SELECT doc_id, k.name AS license, coalesce(h.n, 0)::BIGINT AS n_notices, coalesce(h.names, '') AS notices, canonical_sha256
FROM whole LEFT JOIN known k ON k.digest = canonical_sha256 LEFT JOIN hits h USING (r)
"""


SQL = _sql()
