"""Spans of forms in text, as column expressions: occurrences, coverage and adjacency. Positions count from 1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def quoted(text: Column) -> Column:
    """A text as a regular expression that matches just itself."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def _found(text: Column, form: Column, but: Column | None = None) -> Column:
    """Start of every occurrence of a form that no pattern ``but`` behind it forbids. A pass of the regular expression begins
    with the form itself, which is fast, unless the form can overlap itself: then each place is looked at."""
    but = F.lit("") if but is None else but
    n = F.length(form)
    overlaps = F.exists(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda k: (k < n) & F.startswith(form, F.substr(form, k + 1)))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("found"))

    def ends(a: Column, p: Column) -> Column:
        at = a["at"] + F.length(p)
        return F.struct((at + n).alias("at"), F.array_append(a["found"], at).alias("found"))

    behind = F.aggregate(F.split(text, F.concat(quoted(form), but), -1), start, ends, lambda a: F.slice(a["found"], F.lit(1), F.size(a["found"]) - 1))
    look = F.concat(F.lit("(?="), quoted(form), but, F.lit(")"))
    return F.when(overlaps, starts(text, look)).otherwise(behind)


def occurrences(text: Column | str, form: Column | str) -> Column:
    """Start of every occurrence, overlapping ones too. The text is cut there in a single pass.

    An empty or null form occurs nowhere; a null text gives null.
    """
    text, form = _col(text), _col(form)
    return F.when((F.length(form) > 0) & F.contains(text, form), _found(text, form)).otherwise(F.when(text.isNotNull(), F.array().cast("array<int>")))


def starts(text: Column, pattern: Column) -> Column:
    """Start of every place where a pattern, made of look-arounds, holds; the text is cut there in a single pass."""
    pieces = F.split(text, pattern, -1)
    begin = F.rlike(text, F.concat(F.lit(r"\A"), pattern))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("found"))
    step = lambda a, p: F.struct((a["at"] + F.length(p)).alias("at"), F.when((a["at"] > 1) | begin, F.array_append(a["found"], a["at"])).otherwise(a["found"]).alias("found"))
    return F.when(F.rlike(text, pattern), F.aggregate(pieces, start, step, lambda a: a["found"])).otherwise(F.array().cast("array<int>"))


def covered(pos: Column, form: Column, target_starts: Column, target: Column) -> Column:
    """Whether the form at a position lies fully inside an occurrence of the target."""
    return F.exists(target_starts, lambda t: (t <= pos) & (pos + F.length(form) <= t + F.length(target)))


def uncovered(text: Column | str, form: Column | str, target: Column | str) -> Column:
    """Starts of the form that no occurrence of the target covers.

    Where the form lies in the target, at each such place, the target's part before the form must not precede it with the
    rest behind it; so one pass over the text tells, however many occurrences there are.
    """
    text, form, target = _col(text), _col(form), F.coalesce(_col(target), F.lit(""))
    places = F.when(F.contains(target, form), _found(target, form)).otherwise(F.array().cast("array<int>"))
    one = lambda p: F.concat(F.lit("(?!(?<="), quoted(F.concat(F.substr(target, F.lit(1), p - 1), form)), F.lit(")"), quoted(F.substr(target, p + F.length(form))), F.lit(")"))
    but = F.array_join(F.transform(places, one), "")
    return F.when((F.length(form) > 0) & F.contains(text, form), _found(text, form, but)).otherwise(F.array().cast("array<int>"))


def text_after(text: Column, pos: Column, form: Column) -> Column:
    return F.substr(text, pos + F.length(form))


def text_before(text: Column, pos: Column) -> Column:
    return F.substr(text, F.lit(1), pos - 1)


def next_to(text: Column, pos: Column, form: Column, left: Column, right: Column) -> Column:
    """Whether one of ``left`` ends at the form and one of ``right`` begins after it; an empty or null list asks nothing."""
    ok_left = F.coalesce(F.size(left) <= 0, F.lit(True)) | F.coalesce(F.exists(left, lambda x: F.endswith(text_before(text, pos), x)), F.lit(True))
    ok_right = F.coalesce(F.size(right) <= 0, F.lit(True)) | F.coalesce(F.exists(right, lambda x: F.startswith(text_after(text, pos, form), x)), F.lit(True))
    return ok_left & ok_right


def split_by_ellipsis(text: Column, pos: Column, form: Column, target: Column) -> Column:
    """Whether the form begins the target and its rest follows after a run of dots: a faithful partial form."""
    rest = F.substr(target, F.length(form) + 1)
    dots = F.substr(text, pos + F.length(form), F.lit(1)).isin(".", "…")  # cheap, and mostly false
    return F.startswith(target, form) & (F.length(rest) > 0) & dots & F.rlike(text_after(text, pos, form), F.concat(F.lit(r"^(\.{2,}|…+)"), quoted(rest)))


def stripped(text: Column | str) -> Column:
    """Text without tags and bracket markers."""
    return F.regexp_replace(_col(text), r"<[^>]+>|\[[^\]]+\]", "")
