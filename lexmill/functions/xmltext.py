"""Units of XML text, read and spliced by places in the text, so that what isn't a Dest stays as it is.

Readers and writers number units by the same pattern. Elements may carry attributes; texts may hold character references
and CDATA.
"""

from __future__ import annotations

import re

UNIT = re.compile(r"<String\b([^<>]*)>(.*?)</String\s*>", re.S)
_PART = re.compile(r"<(REC|EDID|Source|Dest)\b([^<>]*?)(?:/>|>((?:<!\[CDATA\[.*?\]\]>|.)*?)</\1\s*>)", re.S)
_DEST = re.compile(r"(<Dest\b[^<>]*(?<!/)>)((?:<!\[CDATA\[.*?\]\]>|.)*?)(</Dest\s*>)", re.S)
_PIECE = re.compile(r"<!\[CDATA\[(.*?)\]\]>|&(#[0-9]+|#x[0-9A-Fa-f]+|lt|gt|quot|apos|amp);", re.S)
_ATTRIBUTE = re.compile(r"""([\w:.-]+)\s*=\s*(?:"([^"]*)"|'([^']*)')""")
_NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}


def unescaped(text: str) -> str:
    """Text of an element: CDATA as it is, references decoded; what names no character stays as it is."""

    def one(m: re.Match) -> str:
        if m[2] is None:
            return m[1]
        if m[2] in _NAMED:
            return _NAMED[m[2]]
        number = int(m[2][2:], 16) if m[2][1] == "x" else int(m[2][1:])
        return chr(number) if 0 < number < 0x110000 and not 0xD800 <= number < 0xE000 else m[0]

    return _PIECE.sub(one, text)


def escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _attributes(text: str, prefix: str = "") -> dict[str, str]:
    return {prefix + m[1]: unescaped(m[2] if m[2] is not None else m[3]) for m in _ATTRIBUTE.finditer(text)}


def units(xml: str):
    """(number, values by element, attributes) of each unit; attributes of inner elements are named ``REC.id``. Of several
    elements of one name in a unit the first counts; an empty one is an empty text, one that isn't there has no value."""
    for i, m in enumerate(UNIT.finditer(xml)):
        values: dict[str, str] = {}
        attributes = _attributes(m[1])
        for p in _PART.finditer(m[2]):
            if p[1] not in values:
                values[p[1]] = unescaped(p[3] or "")
                attributes |= _attributes(p[2], p[1] + ".")
        yield i, values, attributes


def splice(xml: str, new: dict[int, str]) -> str:
    """The document with the Dest of numbered units replaced; every other character stays as it is."""
    return spliced(xml, new)[0]


def spliced(xml: str, new: dict[int, str]) -> tuple[str, set[int]]:
    """The same, and the numbers that have been replaced; others have no such unit, or one without a Dest."""
    out, at, done = [], 0, set()
    for i, unit in enumerate(UNIT.finditer(xml)):
        if i in new and (d := _DEST.search(xml, unit.start(), unit.end())):
            out += [xml[at : d.start(2)], escaped(new[i])]
            at = d.end(2)
            done.add(i)
    return "".join(out) + xml[at:], done


def skeleton(xml: str) -> str:
    """What must be equal before and after writing: everything but Dest texts."""
    return _DEST.sub(r"\1\3", xml)
