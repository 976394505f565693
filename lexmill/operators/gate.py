"""The deterministic gate: rules over (source, dest, contract), violations, and the verdict of every unit.

A rule is a column expression that gives an array of violations; rules are kept in a registry by name and may be added
to. All rules of a unit are evaluated in one row, without joins: what a unit has to be held against is in its contract
(see ``contract.compile_contract`` for contracts made from shared tables).

Decisions that the rules leave open are parameters of ``GateConfig``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.anchors import anchored
from ..functions.spans import next_to, occurrences, split_by_ellipsis, stripped, uncovered
from ..schema import TERM, VIOLATION

FAIL, WARNING, PASS = "FAIL", "WARNING", "PASS"

#: Traditional characters and, below each, the Simplified one.
TRADITIONAL = "歡來諾這裡衛盡責裝義變們發門龍國學會時間東車馬魚鳥長開關聽說話語讀寫買賣錢銀鐵劍戰爭軍隊將領導師傳統經過還進遠近陽陰雲電風飛機場魯個對幾從後應當點樣種類現實際無為書畫萬與專業兩嚴喪豐臨麗舉樂習鄉亂爾亞產親僅倉儀價眾優傷倫偽體餘傭俠側偵債傾償兒兇內冊凍淨準減幫幣廟廢廳張強彈彎歸錄徹恆悅懸憶憲"
SIMPLIFIED = "欢来诺这里卫尽责装义变们发门龙国学会时间东车马鱼鸟长开关听说话语读写买卖钱银铁剑战争军队将领导师传统经过还进远近阳阴云电风飞机场鲁个对几从后应当点样种类现实际无为书画万与专业两严丧丰临丽举乐习乡乱尔亚产亲仅仓仪价众优伤伦伪体余佣侠侧侦债倾偿儿凶内册冻净准减帮币庙废厅张强弹弯归录彻恒悦悬忆宪"



def _common_plane() -> str:
    """The characters of the first, common plane of the Traditional standard set, in order."""
    codes = ((high, low) for high in range(0xA4, 0xC7) for low in (*range(0x40, 0x7F), *range(0xA1, 0xFF)) if (high, low) <= (0xC6, 0x7E))
    return "".join(bytes(c).decode("big5", "ignore") for c in codes)


@cache
def traditional_only() -> str:
    """Characters that are evidence of Traditional text: those above, and by rule those of the common plane that Unicode's
    own table maps to another, Simplified form, if the Simplified standard set lacks them. A character that has no other
    form, as in many names, is none. Where the session's ICU isn't at hand, the list above alone counts."""
    out = [t for t, s in zip(TRADITIONAL, SIMPLIFIED, strict=True) if t != s]
    spark = SparkSession.getActiveSession()
    plane = _common_plane()
    icu = getattr(getattr(spark, "_jvm", None), "com", None)
    if icu is not None:
        simple = icu.ibm.icu.text.Transliterator.getInstance("Traditional-Simplified").transliterate(plane)
        if len(simple) == len(plane):
            out += [t for t, s in zip(plane, simple, strict=True) if t != s and not t.encode("gb2312", "ignore")]
    return "".join(dict.fromkeys(out))


@dataclass(frozen=True)
class GateConfig:
    """Open decisions: what share of the source's length is short for a truncated text; whether corner quotes alone are
    Traditional; phrases that may hold Traditional characters; how many times a placeholder must occur."""

    short_ratio: float = 0.35
    corner_quotes: bool = False
    allowed_phrases: tuple[str, ...] = ("瞭望",)
    count_placeholders: bool = False
    rules: tuple[str, ...] = field(default=())


def violation(code: str, severity: str, term_id: Column | None = None, form: Column | None = None, pos: Column | None = None, expected: Column | None = None, reason: Column | None = None) -> Column:
    null = F.lit(None).cast("string")
    parts = [F.lit(code), F.lit(severity), *(null if x is None else x for x in (term_id, form)), F.lit(None).cast("int") if pos is None else pos, *(null if x is None else x for x in (expected, reason))]
    return F.struct(*[p.alias(n) for p, n in zip(parts, ("code", "severity", "term_id", "form", "pos", "expected", "reason"), strict=True)])


def none() -> Column:
    return F.array().cast(f"array<{VIOLATION}>")


def when(hit: Column, found: Column) -> Column:
    """One violation where the condition holds; null counts as no."""
    return F.when(F.coalesce(hit, F.lit(False)), F.array(found).cast(f"array<{VIOLATION}>")).otherwise(none())


def each(items: Column, rule: Callable[[Column], Column]) -> Column:
    """Violations of all items of an array; null or empty arrays give none."""
    return F.when(F.size(items) > 0, F.flatten(F.transform(items, rule))).otherwise(none())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


#: Kinds of a term's match: whether a dest has one of the accepted forms; and those kinds that look at blocked suffixes.
MATCH_KINDS: dict[str, Callable[[Column, Column], Column]] = {}
SUFFIX_KINDS: set[str] = set()


def register_match(kind: str, holds: Callable[[Column, Column], Column], suffixes: bool = False) -> None:
    """Adds or replaces a kind: fn(dest, accepted forms) -> whether the dest has the term."""
    MATCH_KINDS[kind] = holds
    (SUFFIX_KINDS.add if suffixes else SUFFIX_KINDS.discard)(kind)


def _any_form(dest: Column, accepted: Column) -> Column:
    return F.exists(accepted, lambda a: F.contains(dest, a))


register_match("contains_phrase", _any_form)
register_match("forms", _any_form, suffixes=True)


def _kind(t: Column) -> Column:
    return F.coalesce(t["match"]["kind"], F.lit("contains_phrase"))


def _matched(t: Column, dest: Column, accepted: Column) -> Column:
    """By the term's kind; an unknown kind is an error of the contract, and no missing term."""
    out = F.when(F.lit(False), F.lit(False))
    for kind, holds in MATCH_KINDS.items():
        out = out.when(_kind(t) == kind, holds(dest, accepted))
    return out.otherwise(F.lit(True))


Rule = Callable[[Column, Column, Column, GateConfig], Column]
RULES: dict[str, Rule] = {}


def register_rule(name: str, rule: Rule) -> None:
    """Adds or replaces a rule: fn(source, dest, contract, config) -> array of violations."""
    RULES[name] = rule


def _rule(name: str):
    def keep(fn: Rule) -> Rule:
        register_rule(name, fn)
        return fn

    return keep


def _bound(contract: Column, rule: Callable[[Column, Column], Column]) -> Column:
    """A rule for each binding with its term; a binding without a term has none to be held against."""
    return each(contract["bindings"], lambda b: F.coalesce(rule(b, F.try_element_at(contract["terms"], b["term_id"])), none()))


def _target(b: Column, t: Column) -> Column:
    return F.coalesce(t["target"], b["required_target"], F.lit(""))


@_rule("unknown_term")
def unknown_term(source, dest, contract, config):
    """A binding whose term the contract does not hold is an error of the contract, and so is a term of an unknown kind."""
    entries = F.filter(F.map_entries(contract["terms"]), lambda e: ~_kind(e["value"]).isin(*MATCH_KINDS))
    odd = each(entries, lambda e: F.array(violation("CONTRACT001", FAIL, e["key"], form=_kind(e["value"]), reason=F.lit("unknown match kind"))).cast(f"array<{VIOLATION}>"))
    unheld = each(contract["bindings"], lambda b: when(~F.coalesce(F.map_contains_key(F.coalesce(contract["terms"], F.create_map().cast(f"map<string,{TERM}>")), b["term_id"]), F.lit(False)), violation("CONTRACT001", FAIL, b["term_id"], reason=F.lit("binding without a term"))))
    return F.concat(unheld, odd)


@_rule("required_term")
def required_term(source, dest, contract, config):
    """A required binding needs one of the accepted forms, once in the whole unit."""

    def one(b: Column, t: Column) -> Column:
        accepted = F.when(F.size(t["match"]["accepted"]) > 0, t["match"]["accepted"]).otherwise(F.array(_target(b, t)))
        return when(F.coalesce(b["required"], F.lit(False)) & ~_matched(t, dest, accepted), violation("TERM001", FAIL, b["term_id"], expected=_target(b, t)))

    return _bound(contract, one)


def _forbidden(dest: Column, code: str, term_id: Column, forms: Column, target: Column, reason: Column | None = None) -> Column:
    return each(forms, lambda f: F.transform(uncovered(dest, f, target), lambda p: violation(code, FAIL, term_id, f, p, target, reason)))


@_rule("forbidden_form")
def forbidden_form(source, dest, contract, config):
    """A bound term's forbidden form outside every occurrence of its target."""
    return _bound(contract, lambda b, t: _forbidden(dest, "TERM002", b["term_id"], t["forbidden"], _target(b, t)))


@_rule("forbidden_only")
def forbidden_only(source, dest, contract, config):
    """Terms that are never bound: their forbidden forms count where the source holds their English form."""
    terms = F.filter(F.map_entries(contract["terms"]), lambda e: F.coalesce(e["value"]["enforcement"] == "FORBIDDEN_ONLY", F.lit(False)))
    return each(terms, lambda e: F.when(F.coalesce(F.when(contract["anchored"].isNotNull(), F.array_contains(contract["anchored"], e["value"]["source"])).otherwise(anchored(source, e["value"]["source"])), F.lit(False)), _forbidden(dest, "TERM002", e["key"], e["value"]["forbidden"], F.coalesce(e["value"]["target"], F.lit("")))).otherwise(none()))


@_rule("blocked_suffix")
def blocked_suffix(source, dest, contract, config):
    """An accepted form with a blocked suffix behind it, where the term's kind looks at suffixes."""

    def one(b: Column, t: Column) -> Column:
        suffixes = t["match"]["blocked_suffixes"]
        hits = lambda a: F.filter(occurrences(dest, a), lambda p: F.exists(suffixes, lambda s: F.startswith(F.substr(dest, p + F.length(a)), s)))
        return F.when((F.size(suffixes) > 0) & _kind(t).isin(*SUFFIX_KINDS), each(t["match"]["accepted"], lambda a: F.transform(hits(a), lambda p: violation("TERM003", FAIL, b["term_id"], a, p, _target(b, t))))).otherwise(none())

    return _bound(contract, one)


@_rule("global_ban")
def global_ban(source, dest, contract, config):
    """Banned forms, bound or not: where the English form is in the source, or unconditionally.

    Not counted are forms inside the target, targets split by an ellipsis, and forms that are the target of another ban
    whose English form is in the source. A declared exemption, if all occurrences satisfy it, leaves a warning.
    """
    bans, exemptions = contract["global_bans"], contract["global_ban_exemptions"]
    # A compiled contract says which English forms its source holds; in others they are looked for.
    here = lambda b: F.when(contract["anchored"].isNotNull(), F.array_contains(contract["anchored"], b["english"])).otherwise(anchored(source, b["english"]))
    found = F.transform(bans, lambda b: F.struct(b.alias("ban"), F.coalesce(here(b), F.lit(False)).alias("here")))

    def exempt(b: Column, f: Column) -> Column:
        def satisfied(e: Column) -> Column:
            s = e["scope"]
            whole = F.coalesce(F.size(s["source_contains"]) <= 0, F.lit(True)) | F.coalesce(F.exists(s["source_contains"], lambda x: F.contains(source, x)), F.lit(True))
            return (e["english"] == b["english"]) & (e["forbidden"] == f) & whole & F.forall(occurrences(dest, f), lambda p: next_to(dest, p, f, s["dest_left"], s["dest_right"]))

        return F.coalesce(F.exists(exemptions, satisfied), F.lit(False))

    def form(b: Column, f: Column, all_: Column) -> Column:
        target = F.coalesce(b["target"], F.lit(""))
        spans = F.filter(uncovered(dest, f, target), lambda p: ~split_by_ellipsis(dest, p, f, target))
        other = F.exists(all_, lambda o: o["here"] & (o["ban"]["target"] == f) & (o["ban"]["english"] != b["english"]))
        row = lambda p, severity: F.struct(F.lit("TERM004").alias("code"), severity.alias("severity"), b["english"].alias("term_id"), f.alias("form"), p.alias("pos"), target.alias("expected"), b["reason"].alias("reason"))
        found = let(F.when(exempt(b, f), WARNING).otherwise(FAIL), lambda severity: F.transform(spans, lambda p: row(p, severity)))
        return F.when(F.coalesce(other, F.lit(False)) | ~F.contains(dest, f), none()).otherwise(found)

    due = lambda all_: F.filter(all_, lambda z: z["here"] | F.coalesce(z["ban"]["unconditional"], F.lit(False)))
    hits = let(found, lambda all_: each(due(all_), lambda z: each(z["ban"]["forbidden"], lambda f: form(z["ban"], f, all_))))
    return F.when(F.coalesce((dest != source) & (F.size(bans) > 0), F.lit(False)), hits).otherwise(none())


@_rule("keep")
def keep(source, dest, contract, config):
    """Texts that must stay as they are: those of the unit's own list, and those of the global one."""
    changed = dest != source
    own = when(F.array_contains(contract["keep_list"], source) & changed, violation("KEEP001", FAIL, expected=source))
    return F.concat(own, when(F.array_contains(contract["keep"], source) & changed, violation("KEEP002", FAIL, expected=source)))


@_rule("placeholder")
def placeholder(source, dest, contract, config):
    """Protected tokens that the dest lacks."""
    count = lambda s, t: F.regexp_count(s, F.concat(F.lit(r"\Q"), t, F.lit(r"\E")))
    lacks = (lambda t: count(dest, t) < count(source, t)) if config.count_placeholders else (lambda t: F.instr(dest, t) == 0)
    return each(contract["protected_tokens"], lambda t: when(lacks(t), violation("PLACEHOLDER001", FAIL, form=t)))


@_rule("charset")
def charset(source, dest, contract, config):
    """Traditional characters outside the phrases that may hold them."""
    d = dest
    for p in config.allowed_phrases:
        d = F.replace(d, F.lit(p), F.lit(""))
    # Only characters of the range are looked up in the table, and only texts that have one.
    han = F.regexp_replace(d, "[^\u3400-\u9FFF「」]+", "")
    rest = lambda h: F.translate(h, traditional_only() + ("「」" if config.corner_quotes else ""), "")
    found = lambda h: F.array_except(F.split(h, ""), F.split(F.translate(h, traditional_only() + "「」", ""), ""))
    one = lambda h: when(F.length(rest(h)) < F.length(h), violation("CHAR001", FAIL, form=F.array_join(found(h), "")))
    return F.when(F.rlike(d, F.lit("[\u3400-\u9FFF「」]")), let(han, one)).otherwise(none())


@_rule("interjection")
def interjection(source, dest, contract, config):
    """A source that is an interjection as a whole has a list of allowed renderings."""
    allowed = F.try_element_at(contract["interjection_map"], source)
    return when(allowed.isNotNull() & ~F.array_contains(allowed, dest), violation("TERM002", FAIL, source, dest, expected=F.array_join(allowed, "|")))


@_rule("truncation")
def truncation(source, dest, contract, config):
    """A short dest that ends in an ellipsis where the source does not."""
    s, d = F.trim(stripped(source)), F.trim(stripped(dest))
    tail = r"(…|\.{2,})$"
    dotted = F.contains(dest, F.lit("…")) | F.rlike(dest, F.lit(r"\.\.|\.[<\[]"))  # cheap: most have no such run, nor could strip to one
    return when(dotted & F.rlike(d, F.lit(tail)) & ~F.rlike(s, F.lit(tail)) & (F.length(d) < F.length(s) * config.short_ratio), violation("TRUNC001", WARNING, form=F.right(d, F.lit(6))))


@_rule("xml_structure")
def xml_structure(source, dest, contract, config):
    """A dest has the opening and empty tags of its source, each as often, and loses no closing tag. It may add closing
    tags, but only of tags that the source leaves open. Where the source's tags don't cross, its own don't either. Tags that
    are protected tokens are another rule's."""
    pattern = F.lit("</?[A-Za-z][^<>]*>")
    held = F.coalesce(contract["protected_tokens"], F.array().cast("array<string>"))
    tags = lambda t: F.filter(F.regexp_extract_all(t, pattern, F.lit(0)), lambda x: ~F.coalesce(F.array_contains(held, x), F.lit(False)))
    name = lambda t: F.lower(F.regexp_extract(t, "^</?([A-Za-z][^ \t\r\n/>]*)", 1))
    closing = lambda t: F.startswith(t, F.lit("</"))
    closed = lambda ts: F.transform(F.filter(ts, closing), name)
    opened = lambda ts: F.transform(F.filter(ts, lambda t: ~closing(t) & ~F.endswith(t, F.lit("/>"))), name)
    start = F.struct(F.array().cast("array<string>").alias("open"), F.lit(True).alias("ok"))

    def step(a: Column, t: Column) -> Column:
        """A closing tag ends the last one open of its name; those opened after that stay without an end."""
        at = F.array_position(a["open"], name(t)).cast("int")  # the last one opened is first
        ended = F.struct(F.when(at > 0, F.slice(a["open"], at + 1, F.greatest(F.size(a["open"]) - at, F.lit(0)))).otherwise(a["open"]).alias("open"), (a["ok"] & (at > 0)).alias("ok"))
        return F.when(closing(t), ended).when(F.endswith(t, F.lit("/>")), a).otherwise(F.struct(F.array_prepend(a["open"], name(t)).alias("open"), a["ok"].alias("ok")))

    nests = lambda ts: F.aggregate(ts, start, step, lambda a: a["ok"])
    spaced = lambda ts: F.array_sort(F.transform(F.filter(ts, lambda t: ~closing(t)), lambda t: F.regexp_replace(t, r"\s+", " ")))
    signs = lambda t: F.regexp_count(F.regexp_replace(t, pattern, F.lit("")), F.lit("[<>]"))
    loose = signs(source) != signs(dest)
    count = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    fits = lambda opens, was, now: F.forall(F.array_distinct(F.concat(was, now)), lambda x: (count(now, x) >= count(was, x)) & (count(now, x) <= F.greatest(count(was, x), count(opens, x))))
    ends = lambda s, d: let(opened(s), lambda o: let(closed(s), lambda was: let(closed(d), lambda now: fits(o, was, now))))
    broken = let(tags(source), lambda s: let(tags(dest), lambda d: (spaced(s) != spaced(d)) | ~ends(s, d) | loose | (nests(s) & ~nests(d))))
    marked = F.contains(source, F.lit("<")) | F.contains(dest, F.lit("<"))
    return when((source != dest) & F.when(marked, broken).otherwise(F.lit(False)), violation("XML001", FAIL))


def violation_array(config: GateConfig = GateConfig()) -> Column:
    source, dest, contract = F.col("source"), F.col("dest"), F.col("contract")
    names = config.rules or tuple(RULES)
    return F.concat(*[F.coalesce(RULES[n](source, dest, contract, config).cast(f"array<{VIOLATION}>"), none()) for n in names])


def violations(units: DataFrame, config: GateConfig = GateConfig(), unit: str = "unit_id") -> DataFrame:
    """One row for each violation of units (unit, source, dest, contract)."""
    return units.select(unit, F.inline(violation_array(config)))


def fold(found: Column) -> Column:
    """Verdict of an array of violations: any failure fails, else any warning warns."""
    has = lambda s: F.exists(found, lambda v: v["severity"] == s)
    return F.when(has(FAIL), FAIL).when(has(WARNING), WARNING).otherwise(PASS)


def gate(units: DataFrame, config: GateConfig = GateConfig()) -> DataFrame:
    """Units with verdict and the set of failed codes; every unit has a row."""
    # Out of a generator, so that filters on the verdict do not make the violations anew.
    got = units.select("*", F.explode(F.array(violation_array(config))).alias("__found"))
    codes = F.array_sort(F.array_distinct(F.transform(F.filter("__found", lambda v: v["severity"] == FAIL), lambda v: v["code"])))
    return got.withColumn("verdict", fold(F.col("__found"))).withColumn("codes", codes).withColumnRenamed("__found", "violations")


def verdicts(units: DataFrame, found: DataFrame, unit: str = "unit_id") -> DataFrame:
    """Verdicts of all units from a table of violations: (unit, verdict, codes)."""
    rank = F.when(F.col("severity") == FAIL, 2).when(F.col("severity") == WARNING, 1).otherwise(0)
    worst = found.groupBy(unit).agg(F.max(rank).alias("worst"), F.array_sort(F.collect_set(F.when(F.col("severity") == FAIL, F.col("code")))).alias("codes"))
    named = F.when(F.col("worst") == 2, FAIL).when(F.col("worst") == 1, WARNING).otherwise(PASS)
    return units.select(unit).join(worst, unit, "left").select(unit, named.alias("verdict"), F.coalesce("codes", F.array().cast("array<string>")).alias("codes"))


def report(units: DataFrame) -> DataFrame:
    """The one-row summary of gated units."""
    worst = F.max(F.when(F.col("verdict") == FAIL, 2).when(F.col("verdict") == WARNING, 1).otherwise(0))
    sums = units.agg(worst.alias("w"), F.count_if(F.col("verdict") == FAIL).alias("fail_count"), F.count_if(F.col("verdict") == WARNING).alias("warning_count"), F.count("*").alias("unit_count"))
    return sums.select(F.when(F.col("w") == 2, FAIL).when(F.col("w") == 1, WARNING).otherwise(PASS).alias("verdict"), "fail_count", "warning_count", "unit_count")


def summary(units: DataFrame, file: str = "plugin") -> DataFrame:
    """One row of counts of gated units: files, items, fails, warnings, and issues of either kind."""
    issues = F.coalesce(F.sum(F.size("violations")), F.lit(0)).alias("issues")
    return units.agg(F.count_distinct(file).alias("files"), F.count("*").alias("items"), F.count_if(F.col("verdict") == FAIL).alias("fails"), F.count_if(F.col("verdict") == WARNING).alias("warnings"), issues)


def assertions(text: Column, wanted: Column, unwanted: Column) -> Column:
    """Whether a text holds all of one list and none of another; null lists ask nothing."""
    return F.coalesce(F.forall(wanted, lambda w: F.contains(text, w)), F.lit(True)) & ~F.coalesce(F.exists(unwanted, lambda w: F.contains(text, w)), F.lit(False))
