"""Small text projections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normal_path(path: Column | str) -> Column:
    return F.replace(_col(path), F.lit("\\"), F.lit("/"))


def basename(path: Column | str) -> Column:
    return F.substring_index(normal_path(path), "/", -1)


def last_line(text: Column | str, n: int = 200) -> Column:
    """The last line that is not blank, cut to n characters; null where there is none."""
    lines = F.filter(F.split(_col(text), "\n"), lambda x: F.trim(x) != "")
    return F.left(F.when(F.size(lines) > 0, F.element_at(lines, -1)), F.lit(n))


def preview(text: Column | str, n: int = 60) -> Column:
    return F.substring(_col(text), 1, n)


def xml_index(unit_id: Column | str) -> Column:
    """The number of 'xml-index:N'; null for anything else."""
    return F.regexp_extract(_col(unit_id), r"xml-index:(\d{1,18})", 1).try_cast("bigint")


def version(text: Column | str) -> Column:
    """(major, minor, patch), ordered field by field; null where there is no version."""
    part = lambda i: F.regexp_extract(_col(text), r"(\d{1,9})\.(\d{1,9})\.(\d{1,9})", i)
    value = F.struct(*[F.when(part(i) != "", part(i)).cast("int").alias(n) for i, n in ((1, "major"), (2, "minor"), (3, "patch"))])
    return F.when(part(1) != "", value)


def worker_key(text: Column | str, prefix: str, new: str) -> Column:
    return F.replace(_col(text), F.lit(prefix), F.lit(new))


def end_number(text: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(text), r"(\d+)$", 1), F.lit(""))


def without_bom(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), "^﻿", "")


def valid_utf8(raw: Column | str) -> Column:
    return F.is_valid_utf8(_col(raw).cast("string"))


def placeholders(text: Column | str) -> Column:
    """Counts of the protected classes of a text: tags, %s and %d."""
    return F.struct(F.regexp_extract_all(_col(text), F.lit("<[^>]+>"), F.lit(0)).alias("tags"), F.regexp_count(_col(text), F.lit("%[sd]")).alias("formats"))


#: Classes of protected tokens.
TOKEN_CLASSES = {"tag": "<[^>]+>", "bracket": r"\[[^\]]+\]", "format": "%[0-9]*[sd]", "alias": "&[A-Za-z#0-9]+;"}


def protected_tokens(text: Column | str) -> Column:
    """All protected tokens of a text as (class, token), class by class, in order."""

    def of(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(0)), lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("token")))

    return F.concat(*[of(k, p) for k, p in TOKEN_CLASSES.items()])
