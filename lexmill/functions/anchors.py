"""English anchors: whole words with plural and possessive forms, matched by join on their first token."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import quoted, starts

WORD = "A-Za-z0-9_"


def plurals(english: Column | str) -> Column:
    """The form itself and its plurals: +s, +es, f to ves, y to ies. Made once, where the forms are declared."""
    e = F.col(english) if isinstance(english, str) else english
    forms = F.array(
        e,
        F.concat(e, F.lit("s")),
        F.when(F.rlike(e, F.lit("(s|x|z|ch|sh)$")), F.concat(e, F.lit("es"))),
        F.when(F.rlike(e, F.lit("[^f]fe?$")), F.regexp_replace(e, "fe?$", "ves")),
        F.when(F.rlike(e, F.lit("[^aeiou]y$")), F.regexp_replace(e, "y$", "ies")),
    )
    return F.array_distinct(F.array_compact(forms))


def pattern(form: Column) -> Column:
    """A whole-word pattern that consumes its boundaries, so that neighbours of any script are boundaries."""
    safe = F.regexp_replace(form, r"([\\.\[\]{}()*+?^$|])", r"\\$1")
    return F.concat(F.lit(f"(^|[^{WORD}])"), safe, F.lit(f"('s)?([^{WORD}]|$)"))


def anchored(source: Column | str, english: Column | str) -> Column:
    """Whether a source holds an English form as whole words; for one pair of values. Empty forms are nowhere."""
    s, e = (F.col(x) if isinstance(x, str) else x for x in (source, english))
    return (F.length(e) > 0) & F.exists(plurals(e), lambda f: F.contains(s, f) & F.rlike(s, pattern(f)))


def anchor_spans(source: Column | str, english: Column | str) -> Column:
    """(start, end) of every place where a source holds an English form as whole words, plurals too; positions from 1."""
    s, e = (F.col(x) if isinstance(x, str) else x for x in (source, english))
    look = lambda f: F.concat(F.lit(f"(?<![{WORD}])(?="), quoted(f), F.lit(f"('s)?(?![{WORD}]))"))
    one = lambda f: F.transform(starts(s, look(f)), lambda p: F.struct(p.alias("start"), (p + F.length(f)).alias("end")))
    return F.array_distinct(F.flatten(F.transform(F.filter(plurals(e), lambda f: F.contains(s, f) & (F.length(f) > 0)), one)))


def tokens(source: Column | str) -> Column:
    return F.array_distinct(F.filter(F.split(source, f"[^{WORD}]+"), lambda t: t != ""))


def _variants(english: str) -> list[str]:
    """The same forms as ``plurals`` for a value at hand."""
    out = [english, english + "s"]
    if re.search("(s|x|z|ch|sh)$", english):
        out.append(english + "es")
    if re.search("[^f]fe?$", english):
        out.append(re.sub("fe?$", "ves", english))
    if re.search("[^aeiou]y$", english):
        out.append(re.sub("y$", "ies", english))
    return list(dict.fromkeys(out))


#: Forms that are looked for in the text itself, in one pass; more are joined by token.
FEW = 64


def few_forms(forms: DataFrame, form: str, english: str) -> list[tuple] | None:
    """(form, english) of all forms if there are no more than FEW, else None: the limit bounds what is collected."""
    rows = forms.where(F.length(english) > 0).select(F.col(form), F.col(english)).distinct().limit(FEW + 1).collect()
    return None if len(rows) > FEW else sorted((tuple(r) for r in rows), key=repr)


def met_forms(source: Column | str, forms: list[tuple], kind: str = "string") -> Column:
    """The ids of those of a few forms (id, english) that a source holds, in one row: one pass finds the first tokens of
    variants that are there; only variants of several tokens look at the text again, and only behind their first."""
    s = F.col(source) if isinstance(source, str) else source
    parts = {i: [(v, t) for v in _variants(e) if (t := [x for x in re.split(f"[^{WORD}]+", v) if x])] for i, e in forms}
    first = sorted({t[0] for vs in parts.values() for _, t in vs}, key=lambda t: (-len(t), t))
    none = F.array().cast(f"array<{kind}>")
    if not first:
        return none

    def here(found: Column, vs: list) -> Column:
        hits = [F.array_contains(found, t[0]) if t == [v] else F.array_contains(found, t[0]) & F.rlike(s, pattern(F.lit(v))) for v, t in vs]
        return reduce(lambda a, b: a | b, hits)

    each = lambda found: F.array_compact(F.array(*[F.when(here(found, vs), F.lit(i).cast(kind)) for i, vs in parts.items() if vs]))
    found = F.regexp_extract_all(s, F.lit(f"(?<![{WORD}])(?:{'|'.join(first)})(?![{WORD}])"), F.lit(0))
    return F.when(s.isNull(), none).otherwise(F.transform(F.array(F.array_distinct(found)), lambda x: F.when(F.size(x) > 0, each(x)).otherwise(none))[0])


def anchored_pairs(units: DataFrame, forms: DataFrame, unit: str = "unit_id", source: str = "source", form: str = "form_id", english: str = "english") -> DataFrame:
    """(unit, form) for each form that a unit's source holds.

    A few forms are looked for in each text, in its own row. More are joined: tokens of the sources by equality with the
    first token of each variant, without the texts; a variant of one token is settled by that, and only longer ones go back
    to the text. Catalyst broadcasts the forms when they are small. Both ways give the same pairs.
    """
    if (few := few_forms(forms, form, english)) is not None:
        kind = forms.schema[form].dataType.simpleString()
        met = met_forms(source, [(n, e) for n, (_, e) in enumerate(few)], "int")
        back = F.array(*[F.lit(i).cast(kind) for i, _ in few]) if few else F.array().cast(f"array<{kind}>")
        return units.select(F.col(unit), F.explode(F.array_distinct(F.transform(met, lambda n: F.get(back, n)))).alias(form)).distinct()
    return joined_pairs(units, forms, unit, source, form, english)


def joined_pairs(units: DataFrame, forms: DataFrame, unit: str = "unit_id", source: str = "source", form: str = "form_id", english: str = "english") -> DataFrame:
    """``anchored_pairs`` of any number of forms, by a join on tokens."""
    variants = forms.where(F.length(english) > 0).select(F.col(form), F.explode(plurals(english)).alias("variant"))
    variants = variants.withColumn("parts", F.filter(F.split("variant", f"[^{WORD}]+"), lambda t: t != "")).where(F.size("parts") > 0)
    variants = variants.select(form, "variant", F.col("parts")[0].alias("token"), ((F.size("parts") > 1) | (F.col("parts")[0] != F.col("variant"))).alias("long"))
    met = units.select(F.col(unit), F.explode(tokens(source)).alias("token")).join(variants, "token").select(unit, form, "variant", "long")
    short = met.where(~F.col("long")).select(unit, form)
    longer = met.where("long").select(unit, form, "variant").distinct()
    longer = units.select(unit, source).join(longer, unit).where(F.rlike(F.col(source), pattern(F.col("variant")))).select(unit, form)
    return short.unionByName(longer).distinct()
