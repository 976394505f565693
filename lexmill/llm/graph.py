"""Connected components of links held in a DataFrame, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage


def _least(edges: DataFrame) -> DataFrame:
    """Each node with its least neighbour; pre-aggregated, so a hub's links never meet in one task."""
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select("a", F.least("a", "m").alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges hold b < a."""
    least = _least(edges)
    moved = edges.join(least, "a").where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(id, component) of every node of links (a, b): the least node that links reach. Nulls and loops take no part.

    Rounds go on until nothing changes; each is written to the shared folder, which cuts lineage.
    """
    edges = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    old = Stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    mark = _mark(old.df)
    while True:
        new = Stage(_small_star(_large_star(old.df)), label)
        was, mark = mark, _mark(new.df)
        old.drop()
        old = new
        if mark == was:
            break
    roots = old.df.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return old.df.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Two sums and the count tell whether the edges have changed."""
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 30))).alias("s")).first()
    return r.n, r.x, r.s
