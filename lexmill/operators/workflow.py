"""Relational steps of the workflow: merging, gaps, coverage, release, batches, evidence, parsing and audits."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.anchors import anchored_pairs
from ..functions.spans import stripped
from ..functions.text import TOKEN_CLASSES, basename, normal_path, protected_tokens
from ..staging import shared_dir
from .ranges import numbered


def last_wins(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row for each key: the last by the given columns. Pre-aggregated, so repeated keys don't meet in one task."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(key, "r.*")


def top_per_group(rows: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The first n rows of each group, with their place; the limit is pushed below the shuffle."""
    w = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def gaps(planned: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Planned keys that are not done; with the tables turned round, orphans."""
    return planned.join(done.select(key).distinct(), key, "left_anti")


def coverage(units: DataFrame, *by: str, status: str = "status", done: str = "TRANSLATED") -> DataFrame:
    """Share of units done, rolled up."""
    got = units.rollup(*by).agg(F.count("*").alias("total"), F.count_if(F.col(status) == done).alias("done"))
    return got.withColumn("ratio", F.col("done") / F.col("total"))


def release_ready(checks: DataFrame) -> DataFrame:
    """One row: whether all named checks (name, ok) hold, and those that don't."""
    return checks.agg(F.bool_and(F.coalesce("ok", F.lit(False))).alias("ready"), F.array_join(F.array_sort(F.collect_list(F.when(~F.coalesce("ok", F.lit(False)), F.col("name")))), ",").alias("open"))


#: Kinds of records.
RECORD_KINDS = {"INFO": "dialogue", "DIAL": "dialogue", "QUST": "quest", "BOOK": "book", "MESG": "message", "MGEF": "effect", "SPEL": "effect"}


def record_kind(rec: Column | str) -> Column:
    head = F.split_part(F.col(rec) if isinstance(rec, str) else rec, F.lit(":"), F.lit(1))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in RECORD_KINDS.items() for x in kv]), head), F.lit("item"))


def semantic_units(turns: DataFrame, group: str, order: str, text: str) -> DataFrame:
    """The texts of a group in order, as one row; groups that may be long are better cut (see ``ranges.chunked_texts``)."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(text, F.lit("")).alias("t"))))
    return turns.groupBy(group).agg(F.array_join(F.transform(parts, lambda p: p["t"]), "\n").alias("unit_text"), F.count("*").alias("n_parts"))


def batch_plan(units: DataFrame, group: str, order: str, size: int, prefix: str = "") -> DataFrame:
    """Units with the number of their batch within a group. A group may hold most units (see ``ranges.running``)."""
    got = numbered(units, group, [order], "batch")
    return got.withColumn("batch", F.floor(F.col("batch") / size).cast("bigint")).withColumn("batch_name", F.concat(F.lit(prefix), F.col(group), F.lit("-"), F.lpad(F.col("batch").cast("string"), 3, "0")))


def skip_done(batches: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Batches whose results are not proven good: a result counts if it has items and no open error."""
    good = results.groupBy(key).agg(F.bool_and((F.col("n_items") > 0) & (F.col("n_errors") == 0)).alias("good")).where("good")
    return batches.join(good.select(key), key, "left_anti")


def merge_patch(units: DataFrame, patch: DataFrame, key: str, value: str) -> DataFrame:
    """Units with patched values, and whether a value changed. Of several patches of a key the greatest value counts."""
    new = patch.groupBy(key).agg(F.max(value).alias("__new"))
    got = units.join(new, key, "left")
    changed = F.col("__new").isNotNull() & ~F.col("__new").eqNullSafe(F.col(value))
    return got.withColumn("changed", changed).withColumn(value, F.coalesce("__new", value)).drop("__new")


def content_hash(*columns: str) -> Column:
    """Key of a row's content for incremental work; nulls and empty texts differ."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]).cast("binary"), 256)


def ranked_evidence(terms: DataFrame, evidence: DataFrame, tiers: tuple[str, ...] = ("core", "extension", "technical")) -> DataFrame:
    """(english, dest, tier, uses, place): renderings of a source text in dictionaries, official ones first.

    Rows whose source and dest are equal are no evidence.
    """
    rank = F.when(F.lit(False), 0)
    for i, t in enumerate(tiers):
        rank = rank.when(F.col("tier") == t, i)
    counted = evidence.where("source <> dest").groupBy("source", "dest", "tier").agg(F.count("*").alias("uses")).withColumn("r", rank.otherwise(len(tiers)))
    w = Window.partitionBy("english").orderBy("r", F.desc("uses"), "dest")
    return terms.select("english").join(counted, F.col("english") == F.col("source")).withColumn("place", F.row_number().over(w)).select("english", "dest", "tier", "uses", "place")


#: Patterns that every text is searched for; more are joined.
FEW_PATTERNS = 64


def pattern_hits(texts: DataFrame, patterns: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    """(key, pattern) where a text contains a pattern of any script.

    A few patterns are looked for in each text's own row. Of more, texts are cut to distinct bigrams and joined with the
    patterns' first bigrams by equality, and a hit is then verified; those of one character are joined with characters. Both
    ways give the same rows.
    """
    p = patterns.select(F.col(pattern).alias("pattern")).where("length(pattern) > 0").distinct()
    t = texts.select(F.col(key).alias("key"), F.col(text).alias("text"))
    few = [r.pattern for r in p.limit(FEW_PATTERNS + 1).collect()]
    if len(few) <= FEW_PATTERNS:
        here = F.filter(F.array(*map(F.lit, sorted(few))).cast("array<string>"), lambda x: F.contains(F.col("text"), x))
        return t.select(F.col("key").alias(key), F.explode(here).alias("pattern"))
    grams = F.array_distinct(F.regexp_extract_all("text", F.lit("(?s)(?=(..))"), F.lit(1)))
    long = t.select("key", F.explode(grams).alias("gram")).join(p.where("length(pattern) > 1").withColumn("gram", F.left("pattern", F.lit(2))), "gram").select("key", "pattern")
    long = long.join(t, "key").where(F.contains("text", F.col("pattern"))).select("key", "pattern")
    chars = t.select("key", F.explode(F.array_distinct(F.split("text", ""))).alias("pattern"))
    short = chars.join(p.where("length(pattern) = 1"), "pattern").select("key", "pattern")
    return long.unionByName(short).select(F.col("key").alias(key), "pattern")


def scan_rules(texts: DataFrame, rules: DataFrame, evidence: DataFrame, key: str = "unit_id", text: str = "dest") -> DataFrame:
    """Suggestions of replacement rules (search, replace): the old form is in a text; evidence wins where it has a form."""
    hits = pattern_hits(texts, rules, key, text, "search").withColumnRenamed("pattern", "search").join(rules, "search")
    official = evidence.groupBy("search").agg(F.min("official").alias("official"))
    return hits.join(official, "search", "left").select(key, "search", "replace", "official", F.coalesce("official", "replace").alias("suggestion"))


def term_hits(terms: DataFrame, texts: DataFrame, key: str, text: str, term: str = "term") -> DataFrame:
    """(term, n): texts that contain each term; terms of none stay with 0."""
    hits = pattern_hits(texts, terms, key, text, term).groupBy("pattern").agg(F.count("*").alias("n"))
    return terms.select(term).distinct().join(hits, F.col(term) == F.col("pattern"), "left").select(term, F.coalesce("n", F.lit(0)).alias("n"))


def header_blocks(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, id, body): blocks of lines that begin with an id ("[id]:" or "id "), ids with _ or of digits; they may hold
    hyphens.

    Lines before the first header are dropped; of equal ids the last block wins; bodies lose white space at both ends,
    line ends and tabs included.
    """
    head = r"^\s*\[?([A-Za-z0-9_-]+)\]?[:\s]\s*(.*)$"
    lines = texts.select(F.col(key), F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("at", "line"))
    id_ = F.regexp_extract("line", head, 1)
    lines = lines.withColumn("id", F.when(F.contains(id_, F.lit("_")) | F.rlike(id_, F.lit("^[0-9]+$")), id_)).withColumn("body", F.when(F.col("id").isNotNull(), F.regexp_extract("line", head, 2)).otherwise(F.col("line")))
    block = F.count("id").over(Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    blocks = lines.withColumn("block", block).where("block > 0").groupBy(key, "block").agg(F.max("id").alias("id"), F.array_sort(F.collect_list(F.struct("at", "body"))).alias("parts"))
    blocks = blocks.select(key, "block", "id", F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["body"]), "\n"), r"(?U)^\s+|\s+$", "").alias("body"))
    return blocks.groupBy(key, "id").agg(F.max_by("body", "block").alias("body"))


def first_suffix_match(keys: DataFrame, numbers: DataFrame, key: str, number: str) -> DataFrame:
    """Each number with the first key in order that ends in it. For looking, not for repair.

    Keys are joined by their trailing digits' suffixes, by equality.
    """
    tail = F.regexp_extract(key, r"(\d+)$", 1)
    ends = keys.select(F.col(key), F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length(tail), F.lit(1))), lambda i: F.substr(tail, i))).alias("end")).where("end <> ''")
    got = numbers.select(F.col(number), F.col(number).cast("string").alias("end")).distinct().join(ends, "end")
    return got.groupBy(number).agg(F.min(key).alias(key))


def min_by_version(rows: DataFrame, version: str, name: str, floor: tuple[int, int, int]) -> DataFrame:
    """One row: the lowest version below a floor and its name; nulls if there is none."""
    least = F.struct(*[F.lit(x).alias(n) for x, n in zip(floor, ("major", "minor", "patch"), strict=True)])
    got = rows.where(F.col(version) < least).agg(F.min(F.struct(F.col(version).alias("version"), F.col(name).alias("name"))).alias("m"))
    return got.select("m.version", "m.name")


#: Names that a shell redirect to a device leaves behind.
DEVICES = ("nul", "con", "aux", "prn", *[f"{d}{i}" for d in ("com", "lpt") for i in range(1, 10)])


def redirect_artefacts(*listings: DataFrame) -> DataFrame:
    """Distinct paths of all listings whose name begins with $ or is that of a device, in order."""
    every = reduce(DataFrame.unionByName, [x.select(normal_path("path").alias("path")) for x in listings]).distinct()
    name = basename("path")
    return every.where(F.startswith(name, F.lit("$")) | F.lower(F.split_part(name, F.lit("."), F.lit(1))).isin(*DEVICES)).orderBy("path")


def expectations(units: DataFrame, expected: DataFrame, key: str = "source", value: str = "dest") -> DataFrame:
    """Units beside the rendering expected of their source: MATCH, MISMATCH, KEEP (expected unchanged) or UNKNOWN. Of
    several renderings of a source the least counts."""
    got = units.join(expected.groupBy(key).agg(F.min("expected").alias("expected")), key, "left")
    verdict = F.when(F.col("expected").isNull(), "UNKNOWN").when(F.col(value) == F.col("expected"), F.when(F.col("expected") == F.col(key), "KEEP").otherwise("MATCH")).otherwise("MISMATCH")
    return got.withColumn("result", verdict)


def token_audit(units: DataFrame, unit: str = "unit_id") -> DataFrame:
    """Units whose dest lost a tag of the source (``lost``: each such tag), or has another number of %s and %d.

    Tags are counted with a sign, plus in the source and minus in the dest, so a page of many tags costs no more than its
    length. Unit ids are distinct.
    """
    pattern = F.lit(TOKEN_CLASSES["tag"])
    signed = lambda c, n: F.transform(F.regexp_extract_all(c, pattern, F.lit(0)), lambda t: F.struct(t.alias("tag"), F.lit(n).alias("n")))
    both = units.where("source <> dest").select(unit, F.inline(F.concat(signed("source", 1), signed("dest", -1))))
    lost = both.groupBy(unit, "tag").agg(F.sum("n").alias("n")).where("n > 0").groupBy(unit).agg(F.collect_list("tag").alias("lost"))
    count = lambda c: F.regexp_count(c, F.lit("%[sd]"))
    got = units.withColumn("format_gap", (count("source") - count("dest")).cast("bigint")).join(lost, unit, "left")
    return got.where(F.col("lost").isNotNull() | (F.col("format_gap") != 0)).withColumn("lost", F.coalesce("lost", F.array().cast("array<string>")))


def length_outliers(units: DataFrame, low: float, high: float) -> DataFrame:
    """Units whose stripped dest is short or long beside the source."""
    r = F.length(stripped("dest")) / F.nullif(F.length(stripped("source")), F.lit(0))
    return units.withColumn("ratio", r).where((r < low) | (r > high))


def extracted_tokens(units: DataFrame, key: str, text: str) -> DataFrame:
    """(key, kind, token, n) of all protected tokens."""
    return units.select(key, F.inline(protected_tokens(text))).groupBy(key, "kind", "token").agg(F.count("*").alias("n"))


def dialogue_tree(edges: DataFrame, roots: DataFrame, depth: int = 10, cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(root, node, depth) of nodes reached from roots in at most so many steps; a node is visited once for each root.

    ``cut`` writes each level out, so that plans do not grow with the depth; by default levels are checkpointed in the
    shared folder.
    """
    if cut is None:
        context = edges.sparkSession.sparkContext
        if not context.getCheckpointDir():
            context.setCheckpointDir(shared_dir(edges.sparkSession))
        cut = lambda df: df.checkpoint()
    steps = edges.select(F.col("parent").alias("node"), F.col("child"))
    level = roots.select(F.col("node").alias("root"), "node").distinct().withColumn("depth", F.lit(0))
    seen = level
    for d in range(1, depth + 1):
        level = cut(level.join(steps, "node").select("root", F.col("child").alias("node")).distinct().join(seen, ["root", "node"], "left_anti").withColumn("depth", F.lit(d)))
        seen = seen.unionByName(level)
    return seen


def import_worker(request: DataFrame, blocks: DataFrame) -> DataFrame:
    """Requested ids beside parsed ones: OK, MISSING or EXTRA; nothing is taken from the source in place of output."""
    r, b = request.select("id", "source").withColumn("asked", F.lit(True)), blocks.select("id", "body").withColumn("got", F.lit(True))
    got = r.join(b, "id", "full_outer")
    blank = F.coalesce(F.trim("body"), F.lit("")) == ""
    return got.select("id", "source", "body", F.when(F.col("asked").isNull(), "EXTRA").when(F.col("got").isNull() | blank, "MISSING").otherwise("OK").alias("state"))


def chained_lookup(wanted: DataFrame, parsed: DataFrame) -> DataFrame:
    """(id, source, body, found): what a request (id, source, at: its place from 0) got from parsed blocks (id, body).

    Found by the exact ``id``, else by ``place``: the number that a parsed id ends in; else MISSING, and never the source in
    place of a rendering. Of several blocks that end in one number the last id counts; blank bodies are none.
    """
    full = parsed.where(F.regexp_replace("body", r"\s", "") != "")
    exact = full.groupBy("id").agg(F.max("body").alias("by_id"))
    number = F.regexp_extract("id", r"(\d{1,18})$", 1).try_cast("bigint")
    placed = full.withColumn("at", number).where("at is not null").groupBy("at").agg(F.max_by("body", "id").alias("by_place"))
    got = wanted.join(exact, "id", "left").join(placed, "at", "left")
    found = F.when(F.col("by_id").isNotNull(), "id").when(F.col("by_place").isNotNull(), "place").otherwise("MISSING")
    return got.select("id", "source", F.coalesce("by_id", "by_place").alias("body"), found.alias("found"))


#: The states of a decision, which are given, and those that each may go to, which is a rule of ours.
STATES = {"PROVISIONAL": ("CONFIRMED", "REVIEW", "KEEP", "OVERRIDE"), "REVIEW": ("CONFIRMED", "PROVISIONAL", "KEEP", "OVERRIDE"), "CONFIRMED": ("REVIEW", "OVERRIDE"), "KEEP": ("REVIEW", "OVERRIDE"), "OVERRIDE": ("REVIEW",)}


def advance(decisions: DataFrame, asked: DataFrame, key: str = "term_id") -> DataFrame:
    """Decisions (key, status) after what is asked (key, status): with status, and an error where the step is not allowed.

    A state may stay as it is. A key without a state is PROVISIONAL. An unknown state, or several asked of a key, is an
    error, and the state stays.
    """
    want = asked.groupBy(key).agg(F.min("status").alias("to"), F.count_distinct("status").alias("n"))
    got = decisions.join(want, key, "left").withColumn("status", F.coalesce("status", F.lit("PROVISIONAL")))
    allowed = F.create_map(*[x for k, v in STATES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    ok = (F.col("n") == 1) & ((F.col("to") == F.col("status")) | F.coalesce(F.array_contains(F.try_element_at(allowed, F.col("status")), F.col("to")), F.lit(False)))
    error = F.when(F.col("n").isNotNull() & ~ok, F.concat(F.col("status"), F.lit(" to "), F.coalesce("to", F.lit("?"))))
    return got.withColumn("error", error).withColumn("status", F.when(ok, F.col("to")).otherwise(F.col("status"))).drop("to", "n")


def elapsed(events: DataFrame, group: str, ts: str = "ts") -> DataFrame:
    """(group, started, ended, seconds): time from the first to the last event of each group."""
    got = events.groupBy(group).agg(F.min(ts).alias("started"), F.max(ts).alias("ended"))
    return got.withColumn("seconds", F.unix_micros(F.col("ended").cast("timestamp")) / 1e6 - F.unix_micros(F.col("started").cast("timestamp")) / 1e6)


def evidence_in_sentences(names: DataFrame, evidence: DataFrame, tiers: tuple[str, ...] = ("core", "extension", "technical")) -> DataFrame:
    """(english, source, dest, tier, place): evidence rows whose source holds a name as whole words, official ones first.

    Names inside whole sentences, which a join on equality misses; found by a join on tokens.
    """
    rows = evidence.where("source <> dest").select("source", "dest", "tier").distinct().withColumn("row", F.xxhash64("source", "dest", "tier"))
    pairs = anchored_pairs(rows, names.select("english").distinct().withColumn("name", F.col("english")), unit="row", form="name")
    rank = F.when(F.lit(False), 0)
    for i, t in enumerate(tiers):
        rank = rank.when(F.col("tier") == t, i)
    got = pairs.join(rows, "row").withColumn("r", rank.otherwise(len(tiers)))
    w = Window.partitionBy("name").orderBy("r", F.length("source"), "source", "dest")
    return got.withColumn("place", F.row_number().over(w)).select(F.col("name").alias("english"), "source", "dest", "tier", "place")


def any_contains(rows: DataFrame, group: str, text: str, needle: str) -> DataFrame:
    """(group, found): whether any text of a group holds the needle."""
    return rows.groupBy(group).agg(F.coalesce(F.bool_or(F.contains(text, F.lit(needle))), F.lit(False)).alias("found"))


def marked(units: DataFrame, marker: str = "===", status: str = "status", done: str = "TRANSLATED") -> DataFrame:
    """Translated units whose source holds a marker and whose dest differs."""
    return units.where(F.contains("source", F.lit(marker)) & (F.col("dest") != F.col("source")) & (F.col(status) == done))


def changed_rows(new: DataFrame, old: DataFrame, key: str, *columns: str) -> DataFrame:
    """Rows of ``new`` that ``old`` lacks or holds with other content: what an incremental writer writes."""
    was = old.select(key, content_hash(*columns).alias("__hash"))
    return new.withColumn("__hash", content_hash(*columns)).join(was, [key, "__hash"], "left_anti").drop("__hash")
