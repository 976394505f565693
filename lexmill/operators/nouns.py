"""Audit of names: candidates in sources, how they are rendered, and families whose renderings carry a sign."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.anchors import anchored_pairs
from ..functions.spans import uncovered

#: A run of capitalised words, with small words inside.
NAME = r"\b[A-Z][A-Za-z'’-]*(?: (?:(?:of|the|and) )*[A-Z][A-Za-z'’-]*)*"


#: What comes before the first word of a sentence.
BEGIN = r"(?:^|[.!?…:][\"'”’)]*\s+|\n\s*)[\"'“‘(]*"


def candidates(source: Column | str) -> Column:
    """The distinct candidate names of a text: longest runs of capitalised words, without possessive ends and a leading
    The. A single word is none where it only begins sentences, as any word is capitalised there."""
    s = F.coalesce(F.col(source) if isinstance(source, str) else source, F.lit(""))
    clean = lambda n: F.regexp_replace(n, "^The |['’]s$|['’-]+$", "")
    runs = F.transform(F.regexp_extract_all(s, F.lit(NAME), F.lit(0)), clean)
    firsts = F.transform(F.regexp_extract_all(s, F.lit(BEGIN + "(" + NAME + ")"), F.lit(1)), clean)
    count = lambda xs, n: F.size(F.filter(xs, lambda x: x == n))
    one = F.struct(runs.alias("runs"), firsts.alias("firsts"))
    # The lists are made once, however many names there are.
    return F.transform(F.array(one), lambda x: F.filter(F.array_distinct(x["runs"]), lambda n: (n != "") & (n != "The") & (F.contains(n, F.lit(" ")) | (count(x["runs"], n) > count(x["firsts"], n)))))[0]


def name_consistency(units: DataFrame, unit: str = "unit_id") -> DataFrame:
    """(name, uses, renderings, rendering, missing, verdict) of the candidate names of all units (unit, source, dest).

    A name's renderings are the dests of units whose whole source is the name and whose dest differs. OK: one rendering, in
    every dest of a unit whose source has the name. MISSING: ``missing`` of them lack it. INCONSISTENT: several renderings;
    the most used, then least, is held against. UNKNOWN: none, so nothing can be told.
    """
    held = units.select(unit, "dest", F.explode(candidates("source")).alias("name"))
    titles = units.where("dest is not null and source <> dest").select(F.trim("source").alias("name"), F.trim("dest").alias("d"))
    counted = titles.groupBy("name", "d").agg(F.count("*").alias("n"))
    known = counted.groupBy("name").agg(F.count("*").alias("renderings"), F.min(F.struct((-F.col("n")).alias("n"), "d"))["d"].alias("rendering"))
    got = held.join(known, "name", "left").groupBy("name").agg(F.count("*").alias("uses"), F.coalesce(F.max("renderings"), F.lit(0)).alias("renderings"), F.max("rendering").alias("rendering"), F.count_if(~F.contains(F.coalesce("dest", F.lit("")), F.col("rendering"))).alias("missing"))
    verdict = F.when(F.col("renderings") == 0, "UNKNOWN").when(F.col("renderings") > 1, "INCONSISTENT").when(F.col("missing") > 0, "MISSING").otherwise("OK")
    return got.withColumn("verdict", verdict)


def family_audit(units: DataFrame, families: DataFrame, unit: str = "unit_id") -> DataFrame:
    """(unit, family, english, target, unsigned, lacks) of units that break a family's renderings (english, family, target,
    sign): the source holds the English form, and the dest lacks the target, or has it without its sign.

    A target ends in its sign, if it has one; ``unsigned`` counts where the rest stands without it (a bare month). Units whose
    dest is their source are not translated, and are left out.
    """
    forms = families.select("english").distinct().withColumn("form_id", F.col("english"))
    met = anchored_pairs(units, forms, unit=unit).select(unit, F.col("form_id").alias("english")).join(F.broadcast(families) if _few(families) else families, "english")
    got = met.join(units.where("dest <> source").select(unit, "dest"), unit)
    sign = F.coalesce("sign", F.lit(""))
    bare = F.substr(F.col("target"), F.lit(1), F.length("target") - F.length(sign))
    signed = (F.length(sign) > 0) & F.endswith("target", sign) & (F.length(bare) > 0)
    got = got.withColumn("unsigned", F.when(signed, F.size(uncovered("dest", bare, "target"))).otherwise(0).cast("bigint"))
    got = got.withColumn("lacks", ~F.contains("dest", F.col("target")))
    return got.where("lacks or unsigned > 0").select(unit, "family", "english", "target", "unsigned", "lacks")


#: Rows of a family table that are broadcast; more are joined.
FEW_FAMILIES = 10_000


def _few(families: DataFrame) -> bool:
    return families.limit(FEW_FAMILIES + 1).count() <= FEW_FAMILIES


def form_layers(units: DataFrame, layers: DataFrame, unit: str = "unit_id") -> DataFrame:
    """(unit, english, form, layer, carried) of layers (english, form, layer): an English form has its own form in the other
    language, and no synonym of another layer stands in for it."""
    forms = layers.select("english").distinct().withColumn("form_id", F.col("english"))
    met = anchored_pairs(units, forms, unit=unit).select(unit, F.col("form_id").alias("english")).join(layers, "english")
    return met.join(units.select(unit, "dest"), unit).select(unit, "english", "form", "layer", F.contains("dest", F.col("form")).alias("carried"))
