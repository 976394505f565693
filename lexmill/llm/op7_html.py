"""HTML extraction by line-block distribution.

Markup is stripped to lines, one per block element. The text lengths of the lines are summed over a sliding window;
where the sums surge above a threshold the main text begins, where they dive it ends, and everything between is kept.

Two things bend the raw lengths before the sums are taken, because whole pages often have a single source line and
adverts can be as long as a paragraph:

* elements that are boilerplate by tag or by class, id or role leave an empty line (a valley in the distribution); but a
  block with such a class outside an article is a wrapper, and stays, if it holds more than half of the page's text in
  several lines, and no article beside it holds a tenth as much; comments never do;
* text inside links does not count;
* where a page has articles (article, main), lengths inside and outside are weighed by the share of the text on their
  side, the inside counted MARK times; so the mark helps an article, but cards in article elements do not beat the body.

Lines are joined by a blank line. Boilerplate elements whose end tag is left out end where HTML lets them.

Nulls and pages without text give an empty text. Rows are independent, so repeated rows give repeated results. Pages of
any length are read whole, in time linear in their length; extra columns are left out, whatever their names.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import bound_batches, pick, table

#: Elements whose text is never content.
SILENT = frozenset("script style noscript template svg math iframe object canvas video audio head title select option button textarea form fieldset nav footer aside dialog menu".split())
#: Elements whose raw text holds no markup.
RAW = frozenset("script style textarea title noscript iframe".split())
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block.
BLOCKS = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul aside dialog menu".split())
#: Words in class, id or role that mark boilerplate.
HINTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs sidebar footer header masthead cookie cookies notice consent gdpr popup modal overlay comment comments disqus respond share sharing social related recommended newsletter subscribe signup login search toolbar pagination contentinfo complementary".split())
#: Hints of what readers have written.
READERS = frozenset("comment comments disqus respond".split())
ARTICLE = frozenset(("article", "main"))
#: Elements whose end tag may be left out, and what begins where they end.
IMPLIED = {"p": BLOCKS, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "tbody", "tfoot", "thead")), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "option": frozenset(("option",))}

_ATTR = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
#: A tag: quotes count only after an equals sign. Nothing is tried twice, so time is linear.
_TAG = re.compile(r"""<(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?)*+>""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")

WINDOW = 3
#: How many times the text inside articles counts where it is weighed against the text outside.
MARK = 4
THRESHOLD = 80.0


def _hinted(attrs: str) -> set[str]:
    return {w.lower() for a in _ATTR.finditer(attrs) for w in _WORD.findall(a.group(1))} & HINTS


def _tag_end(page: str, at: int) -> int:
    """Index after the tag that opens at ``at``; quoted values may hold '>'. A quote that never ends is none."""
    m = _TAG.match(page, at)
    if m:
        return m.end()
    end = page.find(">", at)
    return len(page) if end < 0 else end + 1


class _Lines:
    """Lines of a page with the length that counts, whether they are in an article, and in which hinted blocks."""

    def __init__(self):
        self.text: list[str] = []
        self.length: list[int] = []
        self.inside: list[bool] = []
        self.within: list[tuple[int, ...]] = []
        self.scopes: tuple[int, ...] = ()
        self.goes: list[bool] = []  # of each hinted block: whether it can be no wrapper
        self.parts: list[str] = []
        self.linked = 0

    def add(self, text: str, in_link: bool) -> None:
        self.parts.append(text)
        if in_link:
            self.linked += len(text.strip())

    def end(self, inside: bool) -> None:
        if self.parts:
            line = " ".join("".join(self.parts).split())
            if line:
                self.text.append(line)
                self.length.append(max(0, len(line) - self.linked))
                self.inside.append(inside)
                self.within.append(self.scopes)
            self.parts = []
        self.linked = 0

    def close(self, hinted: list[list], inside: bool) -> None:
        """The innermost hinted block ends."""
        self.end(inside)
        hinted.pop()
        self.scopes = self.scopes[:-1]

    def valley(self) -> None:
        self.text.append("")
        self.length.append(0)
        self.inside.append(False)
        self.within.append(self.scopes)

    def drop_hinted(self) -> None:
        """Without the lines of hinted blocks, but for wrappers that hold most of the text."""
        held, beside, lines = ([0] * len(self.goes) for _ in range(3))
        for x, y, scopes in zip(self.length, self.inside, self.within, strict=True):
            for k in scopes:
                held[k] += x
                lines[k] += x > 0
                beside[k] -= x if y else 0
        total, marked = sum(self.length), sum(x for x, y in zip(self.length, self.inside, strict=True) if y)
        stays = [not g and 2 * x > total and n > 1 and 10 * (marked + o) < x for g, x, n, o in zip(self.goes, held, lines, beside, strict=True)]
        keep = [all(stays[k] for k in scopes) for scopes in self.within]
        for name in ("text", "length", "inside"):
            setattr(self, name, [x for x, y in zip(getattr(self, name), keep, strict=True) if y])


def lines_of(page: str) -> _Lines:
    out, i, n = _Lines(), 0, len(page)
    article = link = 0
    silent, depth = "", 0  # the element that silences, and how many of its name are open
    low = None
    hinted: list[list] = []  # open hinted blocks: name, how many of that name are open, and how many other blocks in them
    while i < n:
        at = page.find("<", i)
        if at < 0:
            at = n
        if at > i and not silent:
            out.add(_html.unescape(page[i:at]), link > 0)
        if at == n:
            break
        nxt = page[at + 1 : at + 2]
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            i = n if end < 0 else end + 3
            continue
        if nxt == "!" or nxt == "?":
            i = _tag_end(page, at)
            continue
        closing = nxt == "/"
        m = _NAME.match(page, at + 1 + closing)
        if not m:
            if not silent:
                out.add("<", link > 0)
            i = at + 1
            continue
        end = _tag_end(page, at)
        name = m.group().lower()
        i = end
        if silent:
            if name in ARTICLE and not closing and silent not in RAW:
                silent = ""  # an unclosed boilerplate element does not swallow the article
            elif not closing and silent in IMPLIED and name in IMPLIED[silent]:
                depth = 1
                continue
            elif name == silent:
                depth += -1 if closing else name not in VOID
                if depth <= 0:
                    silent = ""
                continue
            elif closing and name in ("body", "html"):
                silent = ""
            else:
                continue
        if hinted:
            if (name in ARTICLE and not closing and not article) or (closing and name in ("body", "html")):
                out.end(article > 0)
                hinted, out.scopes = [], ()  # nor does an unclosed hinted block
            else:
                # Ends that are left out: by what begins, or by the end of what the block lies in.
                while hinted and hinted[-1][0] in IMPLIED and hinted[-1][2] == 0 and (name in BLOCKS and name != hinted[-1][0] if closing else name in IMPLIED[hinted[-1][0]]):
                    out.close(hinted, article > 0)
                if hinted and name == hinted[-1][0]:
                    hinted[-1][1] += -1 if closing else 1
                    if not hinted[-1][1]:
                        out.close(hinted, article > 0)
                elif hinted and name in BLOCKS and name not in VOID and name not in IMPLIED:
                    hinted[-1][2] = max(0, hinted[-1][2] + (-1 if closing else 1))
        if closing:
            if name == "a":
                link = max(0, link - 1)
            if name in BLOCKS:
                out.end(article > 0)
            if name in ARTICLE:
                article = max(0, article - 1)
            continue
        attrs = page[m.end() : end]
        boiler = name in SILENT or (name == "header" and not article)
        if not boiler and name not in ARTICLE and name not in ("body", "html") and name not in VOID and attrs.strip(" />"):
            boiler = _hinted(attrs)
            if boiler and name in BLOCKS and not attrs.endswith("/>"):
                out.end(article > 0)
                out.valley()
                if hinted and hinted[-1][0] == name:
                    hinted[-1][1] -= 1  # it was counted above
                elif hinted and name not in IMPLIED:
                    hinted[-1][2] -= 1
                hinted.append([name, 1, 0])
                out.scopes += (len(out.goes),)
                out.goes.append(article > 0 or bool(boiler & READERS))
                continue
        if boiler:
            if name in BLOCKS:  # a script or style inside a block does not part it
                out.end(article > 0)
                out.valley()
            if name in RAW:
                low = page.lower() if low is None else low
                close = low.find("</" + name, end)
                i = n if close < 0 else _tag_end(page, close)
                continue
            if not attrs.endswith("/>"):
                silent, depth = name, 1
            continue
        if name == "br":
            out.add(" ", False)
        elif name == "a":
            link += 1
        if name in BLOCKS:
            out.end(article > 0)
        if name in ARTICLE:
            article += 1
    out.end(article > 0)
    out.drop_hinted()
    return out


def main_text(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    got = lines_of(page)
    inside = MARK * sum(x for x, y in zip(got.length, got.inside, strict=True) if y)
    outside = sum(x for x, y in zip(got.length, got.inside, strict=True) if not y)
    share = inside / (inside + outside) if inside else 0
    length = [x * (share if y else 1 - share) for x, y in zip(got.length, got.inside, strict=True)]
    n = len(length)
    sums = [0.0] * (n + 1)
    for i, x in enumerate(length):
        sums[i + 1] = sums[i] + x
    block = [sums[min(n, i + WINDOW)] - sums[i] for i in range(n)]
    most = max(block, default=0)
    if most <= 0:
        return ""
    least = min(THRESHOLD, 0.2 * most)
    kept: list[str] = []
    i = done = 0
    while i < n:
        if block[i] <= least:
            i += 1
            continue
        j = i
        while j < n and block[j] > least:  # from the surge to the dive
            j += 1
        end = min(n, j + WINDOW - 1) if j < n else n
        first = next(k for k in range(i, n) if length[k] > 0)
        last = max((k for k in range(first, end) if length[k] > 0), default=first)
        if share > 0.5:  # short lines at the edges, up to the next valley, belong to the article
            while first > done and got.inside[first - 1] and got.text[first - 1]:
                first -= 1
            while last + 1 < n and got.inside[last + 1] and got.text[last + 1]:
                last += 1
        kept += [got.text[k] for k in range(first, last + 1) if got.text[k]]
        i = done = max(j, last + 1)
    return "\n\n".join(kept)


def extract(pages: DataFrame, key: str = "page_id", html: str = "html", carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """(key, carried columns, text, n_chars) of every page."""
    bound_batches(pages.sparkSession)
    src = pick(pages, key, *carry, html)
    kinds = dict(src.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (key, *carry)) + ", text string, n_chars bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[key, *carry, "text", "n_chars"],
            )

    return src.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
