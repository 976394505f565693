"""Order inside groups of any size: running sums, numbers and chunks, without a window over a whole group.

Rows are dealt to ranges of (group, order) whose boundaries are fixed once and stand in the plan as literals, so that every
read of the rows, however it is partitioned, agrees on the range of a row. Sums run inside (range, group); what a group has
in earlier ranges is added. Only a group that began in an earlier range has such an offset, and a range can begin inside one
group at most, so there are no more offsets than ranges: that table is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys that are sampled for each range; so many times the ranges, and no more, come to the driver.
SAMPLED = 60


def boundaries(rows: DataFrame, keys: list[str], parts: int) -> list[tuple]:
    """Up to parts - 1 keys that cut the rows to ranges of about the same size, in order; null keys come first."""
    n = rows.count()
    few = rows.select(*keys) if n <= SAMPLED * parts else rows.select(*keys).sample(SAMPLED * parts / n, seed=1)
    drawn = few.orderBy(F.rand(1)).limit(SAMPLED * parts).orderBy(*keys).collect()
    cuts = [tuple(drawn[len(drawn) * i // parts]) for i in range(1, parts)] if drawn else []
    return list(dict.fromkeys(cuts))


def range_of(keys: list[str], cuts: list[tuple], types: list[str]) -> Column:
    """The number of boundaries that are not above a row's key: a tree of comparisons, as deep as their logarithm."""
    row = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    point = lambda c: F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(c, types, strict=True))])

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(row < point(cuts[middle]), tree(low, middle)).otherwise(tree(middle + 1, high))

    return tree(0, len(cuts))


def running(rows: DataFrame, group: str, order: list[str], name: str, value: Column | None = None, parts: int | None = None, ties: list[str] | None = None) -> DataFrame:
    """Rows with the sum of ``value`` (1 for each row, if not given) over the rows of their group that come before, by
    ``order`` and then ``ties``; null groups are one group. Only ``order`` is sampled, so ties may be long texts. Rows
    equal in both come in any order, each after the other."""
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [group, *order]
    value = F.lit(1).cast("bigint") if value is None else value
    types = [rows.schema[k].dataType.simpleString() for k in keys]
    at, own, begins, g, r = (_free(x, [*rows.columns, name]) for x in ("range", "value", "begins", "range_group", "range_at"))
    dealt = rows.withColumn(at, range_of(keys, boundaries(rows, keys, parts), types)).withColumn(own, value)
    held = dealt.groupBy(group, at).agg(F.sum(own).alias(own))
    earlier = F.sum(own).over(Window.partitionBy(group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1))
    offsets = held.select(F.col(group).alias(g), F.col(at).alias(r), earlier.alias(begins)).where(F.col(begins).isNotNull())
    inside = F.sum(own).over(Window.partitionBy(group, at).orderBy(*order, *(ties or [])).rowsBetween(Window.unboundedPreceding, -1))
    numbered = dealt.withColumn(name, F.coalesce(inside, F.lit(0)))
    got = numbered.join(F.broadcast(offsets), numbered[group].eqNullSafe(offsets[g]) & (numbered[at] == offsets[r]), "left")
    return got.withColumn(name, F.col(name) + F.coalesce(begins, F.lit(0))).select(*rows.columns, name)


def numbered(rows: DataFrame, group: str, order: list[str], name: str = "place", parts: int | None = None) -> DataFrame:
    """Rows with their number in their group, from 0."""
    return running(rows, group, order, name, parts=parts)


def chunked_texts(rows: DataFrame, group: str, order: str, text: str, size: int, sep: str = "\n", parts: int | None = None) -> DataFrame:
    """(group, chunk, start, unit_text, n_parts): the texts of each group in order, joined, cut to chunks between texts.

    A chunk begins in the first text that begins at or after a multiple of ``size`` characters, so it is no longer than that
    and one text; ``start`` is its place in the whole, from 0. All chunks of a group joined by ``sep`` are the whole, so a
    group of any length is many rows. Null texts are empty; chunks are numbered upwards, perhaps with gaps.
    """
    slim = rows.select(F.col(group), F.col(order), F.coalesce(F.col(text), F.lit("")).alias("t"))
    placed = running(slim, group, [order], "start", (F.length("t") + len(sep)).cast("bigint"), parts, ["t"])
    each = placed.withColumn("chunk", F.floor(F.col("start") / size).cast("bigint")).groupBy(group, "chunk")
    got = each.agg(F.array_sort(F.collect_list(F.struct("start", "t"))).alias("p"), F.min("start").alias("start"), F.count("*").alias("n_parts"))
    return got.select(group, "chunk", "start", F.array_join(F.transform("p", lambda p: p["t"]), sep).alias("unit_text"), "n_parts")


def _free(name: str, taken: list[str]) -> str:
    """A column name that is not taken, whatever its case."""
    have = {t.lower() for t in taken}
    while name.lower() in have:
        name += "_"
    return name
