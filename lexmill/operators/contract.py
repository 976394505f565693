"""Contracts: shared tables of terms, bans and exemptions compiled to what each unit has to be held against."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.anchors import FEW, anchor_spans, anchored_pairs, met_forms
from ..schema import BAN, BINDING, CONTRACT, EXEMPTION, TERM
from .workflow import pattern_hits


def auto_bind(units: DataFrame, terms: DataFrame, unit: str = "unit_id") -> DataFrame:
    """(unit, term_id, source_span, required, auto) for units whose source holds a required term's English form.

    Terms that are FORBIDDEN_ONLY are never bound.
    """
    bindable = terms.where("enforcement = 'REQUIRED'").select("term_id", F.col("source").alias("english"))
    pairs = anchored_pairs(units, bindable, unit=unit, form="term_id")
    return pairs.join(bindable, "term_id").select(unit, "term_id", F.col("english").alias("source_span"), F.lit(True).alias("required"), F.lit(True).alias("auto"))


def _no_bans() -> Column:
    return F.array().cast(f"array<{BAN}>")


def _ban() -> Column:
    return F.struct(*[F.col(c) for c in _fields(BAN)]).cast(BAN)


def _with_always(units: DataFrame, bans: DataFrame, unit: str) -> DataFrame:
    """Units with ``always``: unconditional bans, a literal where there are no more than MOST_UNCONDITIONAL. Of more, a unit
    gets those of which its dest has a forbidden form, as no other can be broken: they are found by a join."""
    rows = bans.where("unconditional").select(F.to_json(_ban()).alias("j")).orderBy("ban_id").limit(MOST_UNCONDITIONAL + 1).collect()
    if len(rows) <= MOST_UNCONDITIONAL:
        return units.withColumn("always", F.array(*[F.from_json(F.lit(r.j), BAN) for r in rows]).cast(f"array<{BAN}>") if rows else _no_bans())
    forms = bans.where("unconditional").select("ban_id", _ban().alias("ban"), F.explode("forbidden").alias("pattern"))
    hits = pattern_hits(units, forms, unit, "dest", "pattern").join(forms, "pattern")
    met = hits.groupBy(unit).agg(F.transform(F.array_sort(F.collect_list(F.struct("ban_id", "ban")), _by("ban_id")), lambda x: x["ban"]).alias("always"))
    return units.join(met, unit, "left").withColumn("always", F.array_distinct(F.coalesce("always", _no_bans())))


def _bound(term_id: Column, term: Column) -> Column:
    return F.struct(term_id, term["source"].alias("source_span"), F.lit(True).alias("required"), term["target"].alias("required_target")).cast(BINDING)


def apart(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that is made once for each row: it comes out of a generator, which neither filters nor projections that use
    it are moved through."""
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def _rows(table: DataFrame, columns: list[str]) -> list[dict] | None:
    """Rows of a table if there are no more than FEW, else None: the limit bounds what is collected."""
    rows = table.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("j")).distinct().limit(FEW + 1).collect()
    return None if len(rows) > FEW else sorted((json.loads(r.j) for r in rows), key=lambda r: json.dumps(r, sort_keys=True))


def _compiled_in_row(units: DataFrame, terms: DataFrame, bans: DataFrame | None) -> DataFrame | None:
    """Terms and bans that are few are literals, picked in each unit's own row: no join and no shuffle. None if they are
    many."""
    held = _rows(terms, ["term_id", *_fields(TERM)])
    banned = [] if bans is None else _rows(bans, ["ban_id", *_fields(BAN)])
    if held is None or banned is None:
        return None
    held, banned = sorted(held, key=lambda r: r["term_id"] or ""), sorted(banned, key=lambda r: r["ban_id"])
    forms = sorted({(f"t:{r['term_id']}", r["source"]) for r in held if r["source"]} | {(f"b:{r['ban_id']}", r["english"]) for r in banned if r["english"]})
    literal = lambda rows, kind: F.from_json(F.lit(json.dumps(rows)), f"array<{kind}>")
    picked = lambda rows, name, kind, mark: F.filter(literal([{"id": mark + r[name], "value": r} for r in rows], f"struct<id:string,value:{kind}>"), lambda x: F.array_contains("__met", x["id"]))
    out = apart(units, "__met", met_forms("source", forms))
    out = apart(out, "__terms", picked([r for r in held if r["term_id"] is not None], "term_id", TERM, "t:"))
    some = F.size("__terms") > 0
    out = out.withColumn("terms", F.when(some, F.map_from_entries(F.transform("__terms", lambda x: F.struct(F.substring(x["id"], 3, 1 << 20).alias("key"), x["value"].alias("value"))))))
    required = F.filter("__terms", lambda x: F.coalesce(x["value"]["enforcement"] == "REQUIRED", F.lit(False)))
    out = out.withColumn("bindings", F.when(some, F.transform(required, lambda x: _bound(F.substring(x["id"], 3, 1 << 20).alias("term_id"), x["value"]))))
    met = F.transform(picked(banned, "ban_id", BAN, "b:"), lambda x: x["value"])
    out = out.withColumn("global_bans", F.array_distinct(F.concat(met, literal([r for r in banned if r["unconditional"]], BAN))))
    english = literal([{"id": i, "e": e} for i, e in forms], "struct<id:string,e:string>")
    return out.withColumn("anchored", F.array_distinct(F.transform(F.filter(english, lambda x: F.array_contains("__met", x["id"])), lambda x: x["e"]))).drop("__met", "__terms")


def _compiled_by_join(units: DataFrame, pairs: DataFrame, terms: DataFrame, bans: DataFrame | None, unit: str) -> DataFrame:
    """Terms and bans of any number, by (unit, form_id) pairs."""
    term = F.struct(*[F.col(c) for c in _fields(TERM)]).cast(TERM)
    held = pairs.where(F.startswith("form_id", F.lit("t:"))).select(unit, F.substring("form_id", 3, 1 << 20).alias("term_id")).join(terms.select("term_id", term.alias("term")), "term_id")
    bound = F.when(F.col("term.enforcement") == "REQUIRED", _bound(F.col("term_id"), F.col("term")))
    held = held.groupBy(unit).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("term_id", "term")), _by("term_id"))).alias("terms"), F.array_sort(F.collect_list(bound), _by("term_id")).alias("bindings"))
    out = units.join(held, unit, "left")
    if bans is None:
        out = out.withColumn("met", _no_bans()).withColumn("always", _no_bans())
    else:
        out = _with_always(out, bans, unit)
        met = pairs.where(F.startswith("form_id", F.lit("b:"))).select(unit, F.substring("form_id", 3, 1 << 20).alias("ban_id")).join(bans.select("ban_id", _ban().alias("ban")), "ban_id")
        met = met.groupBy(unit).agg(F.transform(F.array_sort(F.collect_list(F.struct("ban_id", "ban")), _by("ban_id")), lambda x: x["ban"]).alias("met"))
        out = out.join(met, unit, "left").withColumn("met", F.coalesce("met", _no_bans()))
    english = F.concat(F.coalesce(F.transform(F.map_values("terms"), lambda t: t["source"]), F.array().cast("array<string>")), F.transform("met", lambda b: b["english"]))
    return out.withColumn("anchored", F.array_distinct(english)).withColumn("global_bans", F.array_distinct(F.concat("met", "always"))).drop("met", "always")


def _with_exemptions(units: DataFrame, exemptions: DataFrame | None, unit: str) -> DataFrame:
    """Units with the exemptions of their bans: picked from a literal where there are no more than MOST_UNCONDITIONAL, else
    joined by English form."""
    name, kind = "global_ban_exemptions", f"array<{EXEMPTION}>"
    if exemptions is None:
        return units.withColumn(name, F.lit(None).cast(kind))
    one = F.struct(*_fields(EXEMPTION)).cast(EXEMPTION)
    rows = exemptions.select(F.to_json(one).alias("j")).limit(MOST_UNCONDITIONAL + 1).collect()
    if len(rows) <= MOST_UNCONDITIONAL:
        all_ = F.array(*[F.from_json(F.lit(r.j), EXEMPTION) for r in rows]).cast(kind) if rows else F.array().cast(kind)
        return units.withColumn(name, F.filter(all_, lambda e: F.exists("global_bans", lambda b: b["english"] == e["english"])))
    forms = F.array_distinct(F.transform("global_bans", lambda b: b["english"]))
    met = units.select(unit, F.explode(forms).alias("english")).join(exemptions.select("english", one.alias("e")), "english")
    met = met.groupBy(unit).agg(F.collect_list("e").alias(name))
    return units.join(met, unit, "left").withColumn(name, F.coalesce(name, F.array().cast(kind)))


def compile_contract(units: DataFrame, terms: DataFrame, bans: DataFrame | None = None, exemptions: DataFrame | None = None, unit: str = "unit_id", keep: list[str] | None = None, protected: dict[str, str] | None = None, interjections: dict[str, list[str]] | None = None, global_keep: DataFrame | None = None) -> DataFrame:
    """Units with a ``contract`` of the terms and bans that concern them.

    Terms and bans are found by one token join, or, where they are few, are literals that each unit picks its own from.
    Unconditional bans concern every unit; a few are put in as literals, of more a unit gets those whose forms its dest has,
    so no unit meets every ban. Exemptions go with their bans. protected: patterns of tokens that must survive,
    by class. global_keep: a table of texts (text) that stay as they are wherever they are a whole source; they are joined
    by equality, so there may be any number of them.
    """
    forms = terms.select(F.concat(F.lit("t:"), "term_id").alias("form_id"), F.col("source").alias("english"))
    if bans is not None:
        bans = bans.withColumn("ban_id", F.coalesce("ban_id", F.lit("")))
        forms = forms.unionByName(bans.select(F.concat(F.lit("b:"), "ban_id").alias("form_id"), "english"))
    out = _compiled_in_row(units, terms, bans)
    if out is None:
        out = _compiled_by_join(units, anchored_pairs(units, forms, unit=unit), terms, bans, unit)
    out = _with_exemptions(out, exemptions, unit)
    out = out.withColumn("keep_list", F.array(*[F.lit(k) for k in keep or []]).cast("array<string>"))
    if global_keep is not None:
        texts = global_keep.select(F.col("text").alias("__keep")).where("__keep is not null").distinct()
        out = out.join(texts, out["source"] == texts["__keep"], "left").withColumn("keep", F.when(F.col("__keep").isNotNull(), F.array("__keep"))).drop("__keep")
    else:
        out = out.withColumn("keep", F.lit(None).cast("array<string>"))
    tokens = [F.regexp_extract_all("source", F.lit(p), F.lit(0)) for p in (protected or {}).values()]
    out = out.withColumn("protected_tokens", F.array_distinct(F.concat(*tokens)) if tokens else F.array().cast("array<string>"))
    pairs_ = [x for k, v in (interjections or {}).items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))]
    out = out.withColumn("interjection_map", F.create_map(*pairs_) if pairs_ else F.lit(None).cast("map<string,array<string>>"))
    names = _fields(CONTRACT)
    return apart(out, "contract", F.struct(*[F.col(c) for c in names]).cast(CONTRACT)).drop(*names)


def over_reach(units: DataFrame, terms: DataFrame, unit: str = "unit_id") -> DataFrame:
    """(unit, term_id, english, longer_id, longer, severity) of automatic bindings that reach too far: a term is bound, but
    wherever the source holds its English form, that lies inside a longer bound term's (the longest, then least id).

    These are warnings: the binding stays, and someone has to look. A term that also stands alone somewhere is none.
    """
    bindable = terms.where("enforcement = 'REQUIRED'").select("term_id", F.col("source").alias("english"))
    pairs = anchored_pairs(units, bindable, unit=unit, form="term_id").join(bindable, "term_id")
    # Only units with several terms go back to their text.
    several = pairs.groupBy(unit).agg(F.array_sort(F.collect_set(F.struct("term_id", "english"))).alias("bound")).where("size(bound) > 1")
    held = units.select(unit, "source").join(several, unit)
    spans = F.transform("bound", lambda b: F.struct(b["term_id"].alias("term_id"), b["english"].alias("english"), anchor_spans(F.col("source"), b["english"]).alias("spans")))
    held = held.withColumn("bound", spans)
    inside = lambda a, b: (F.size(a["spans"]) > 0) & F.forall(a["spans"], lambda s: F.exists(b["spans"], lambda t: (t["start"] <= s["start"]) & (s["end"] <= t["end"]) & (t["end"] - t["start"] > s["end"] - s["start"])))
    longest = lambda bs: F.get(F.array_sort(F.transform(bs, lambda b: F.struct((-F.length(b["english"])).alias("n"), b["term_id"].alias("id"), b["english"].alias("e")))), F.lit(0))
    found = F.transform("bound", lambda a: F.struct(a["term_id"].alias("term_id"), a["english"].alias("english"), longest(F.filter("bound", lambda b: (b["term_id"] != a["term_id"]) & inside(a, b))).alias("over")))
    got = held.select(unit, F.inline(F.filter(found, lambda x: x["over"].isNotNull())))
    return got.select(unit, "term_id", "english", F.col("over.id").alias("longer_id"), F.col("over.e").alias("longer"), F.lit("WARNING").alias("severity"))


def as_of(rows: DataFrame, version: int, key: str) -> DataFrame:
    """A table of versioned rows (key, version, deleted, ...) as it was at a version: the newest row of each key, if that is
    no deletion. Several rows of a key and version must be equal."""
    rest = [c for c in rows.columns if c not in (key, "version", "deleted")]
    newest = rows.where(F.col("version") <= version).groupBy(key).agg(F.max_by(F.struct(F.coalesce("deleted", F.lit(False)).alias("deleted"), *rest), "version").alias("r"))
    return newest.where("not r.deleted").select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def _changed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of either table that the other lacks, by content."""
    columns = [c for c in old.columns if c != key]
    mark = lambda df: df.withColumn("__h", F.xxhash64(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))
    a, b = mark(old), mark(new)
    gone = a.join(b.select(key, "__h"), [key, "__h"], "left_anti")
    come = b.join(a.select(key, "__h"), [key, "__h"], "left_anti")
    return gone.unionByName(come).drop("__h")


def recompile(units: DataFrame, compiled: DataFrame, terms: DataFrame, bans: DataFrame, base: int, target: int, exemptions: DataFrame | None = None, frozen: str = "frozen", unit: str = "unit_id") -> DataFrame:
    """(unit, version, contract) at a target version, from contracts compiled at ``base``: (unit, version, contract).

    terms, bans: versioned rows (see ``as_of``). Only units whose source holds the English form of a term or ban that
    changed, before or after, are compiled again; if an unconditional ban changed, all are. Units of frozen plugins
    (``frozen``) keep contract and version; units that are not compiled yet are compiled. The result equals compiling all
    units that aren't frozen anew.
    """
    new_terms, new_bans = as_of(terms, target, "term_id"), as_of(bans, target, "ban_id")
    t, b = _changed(as_of(terms, base, "term_id"), new_terms, "term_id"), _changed(as_of(bans, base, "ban_id"), new_bans, "ban_id")
    live = units.where(~F.coalesce(F.col(frozen), F.lit(False)))
    if b.where("unconditional").limit(1).count():
        touched = live.select(unit).distinct()
    else:
        forms = t.select(F.col("source").alias("english")).unionByName(b.select("english")).distinct().withColumn("form_id", F.col("english"))
        touched = anchored_pairs(live, forms, unit=unit).select(unit).distinct()
        touched = touched.unionByName(live.select(unit).join(compiled.select(unit), unit, "left_anti")).distinct()
    again = compile_contract(live.join(touched, unit, "left_semi"), new_terms, new_bans, exemptions, unit=unit).select(unit, F.lit(target).cast("bigint").alias("version"), "contract")
    kept = compiled.join(touched, unit, "left_anti").join(units.select(unit, F.coalesce(F.col(frozen), F.lit(False)).alias("__frozen")), unit)
    kept = kept.select(unit, F.when(F.col("__frozen"), F.col("version")).otherwise(target).cast("bigint").alias("version"), "contract")
    return kept.unionByName(again)


#: Unconditional bans, and exemptions, that are put into plans as literals; more are joined.
MOST_UNCONDITIONAL = 1000


def _by(name: str):
    """Order of structs by one field: maps in them can't be compared."""
    return lambda a, b: F.when(a[name] < b[name], -1).when(a[name] > b[name], 1).otherwise(0)


def _fields(struct: str) -> list[str]:
    from pyspark.sql.types import _parse_datatype_string

    return [f.name for f in _parse_datatype_string(struct).fields]


def normalise_contract(cases: DataFrame, case: str = "case_id", contract: str = "input.contract") -> dict[str, DataFrame]:
    """Contracts of cases as tables: bindings, terms, bans, exemptions, keep texts, tokens and interjections."""
    c = cases.select(F.col(case).alias("case_id"), F.col(contract).alias("c"))
    return {
        "bindings": c.select("case_id", F.inline("c.bindings")),
        "terms": c.select("case_id", F.explode("c.terms").alias("term_id", "t")).select("case_id", "term_id", "t.*"),
        "bans": c.select("case_id", F.inline("c.global_bans")),
        "exemptions": c.select("case_id", F.inline("c.global_ban_exemptions")),
        "keep": c.select("case_id", F.explode("c.keep_list").alias("text")),
        "protected_tokens": c.select("case_id", F.explode("c.protected_tokens").alias("token")),
        "interjections": c.select("case_id", F.explode("c.interjection_map").alias("source", "allowed")),
    }


def triage(warnings: DataFrame, units: DataFrame, terms: DataFrame) -> DataFrame:
    """Warnings (xml_index, term_id, expected) beside their units: what a reviewer has to look at first.

    NOT FOUND without a unit; CONTRACT ERROR where the term is not there or has no English form, as nothing can be told
    then; IGNORE where the source lacks the term, case counting; FALSE POSITIVE where the dest has the expected form; else
    REVIEW. Nothing is closed by this. Of terms of one id the least English form counts, of units the least by texts.
    """
    units = units.groupBy(F.col("unit_id").alias("xml_index")).agg(F.min(F.struct("source", "dest")).alias("u")).select("xml_index", "u.*")
    terms = terms.groupBy("term_id").agg(F.min(F.nullif(F.col("source"), F.lit(""))).alias("english"))
    got = warnings.join(units, "xml_index", "left").join(terms, "term_id", "left")
    verdict = F.when(F.col("source").isNull(), "NOT FOUND").when(F.col("english").isNull(), "CONTRACT ERROR").when(~F.contains("source", F.col("english")), "IGNORE").when(F.contains("dest", F.col("expected")), "FALSE POSITIVE").otherwise("REVIEW")
    return got.withColumn("triage", verdict)


def resolve(keys: DataFrame, key: str, *layers: DataFrame) -> DataFrame:
    """The first value of layered tables (key, value) for each key, and the number of its layer from 1. Of several values
    of a key in one layer the least counts."""
    out = keys.select(key)
    for i, layer in enumerate(layers):
        out = out.join(layer.groupBy(key).agg(F.min("value").alias(f"v{i}")), key, "left")
    values = [F.col(f"v{i}") for i in range(len(layers))]
    at = F.when(F.lit(False), 0)
    for i, v in enumerate(values):
        at = at.when(v.isNotNull(), i + 1)
    return out.select(key, F.coalesce(*values).alias("value"), at.alias("layer"))


def freeze(units: DataFrame, compiled: DataFrame, frozen: str = "frozen") -> DataFrame:
    """Units of plugins that are not frozen, with the newest compiled version of their plugin's contract."""
    newest = compiled.groupBy("plugin").agg(F.max_by("contract", "version").alias("contract"), F.max("version").alias("version"))
    return units.where(~F.coalesce(F.col(frozen), F.lit(False))).join(newest, "plugin")
