"""Numbers, running sums and chunks of groups, where one group holds nearly all rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexmill.operators.ranges import chunked_texts, numbered, running
from lexmill.operators.workflow import batch_plan


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """400,000 units with a wide text, four of five in one group, as files."""
    at = str(tmp_path_factory.mktemp("wide"))
    key = F.col("id") * 7919 % 400_009
    rows = spark.range(0, 400_000, 1, 16).select(key.alias("unit_id"), F.when(F.col("id") % 5 == 0, F.concat(F.lit("g"), F.col("id") % 3)).otherwise("A").alias("rec"), F.repeat(F.sha2(key.cast("string"), 256), 10).alias("source"))
    rows.write.parquet(at + "/t")
    return at + "/t"


@pytest.mark.parametrize("conf", [{}, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}, {"spark.sql.adaptive.enabled": "false"}])
def test_batches_lose_nothing(spark, wide, conf):
    was = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = batch_plan(spark.read.parquet(wide), "rec", "unit_id", 500, "B-")
        assert got.columns == ["unit_id", "rec", "source", "batch", "batch_name"]
        sums = got.groupBy("rec").agg(F.count("*").alias("n"), F.count_distinct("unit_id").alias("ids"), F.max("batch").alias("last")).orderBy("rec").collect()
        assert sum(r.n for r in sums) == 400_000 and sums[0].n == 320_000 and all(r.n == r.ids and r.last == (r.n - 1) // 500 for r in sums)
        assert got.groupBy("rec", "batch").count().where("count > 500").count() == 0
        place = F.row_number().over(Window.partitionBy("rec").orderBy("unit_id")) - 1
        want = spark.read.parquet(wide).select("unit_id", F.floor(place / 500).alias("want"))
        assert got.join(want, "unit_id").where("batch <> want").count() == 0
        assert got.where("sha2(cast(unit_id as string), 256) <> left(source, 64)").count() == 0
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_running_sums_with_nulls_and_ties(spark, parts):
    rows = [(g, o, i % 7, "x") for i, (g, o) in enumerate([(None, 1), ("a", None), ("a", 2), ("a", 2), ("b", 9), (None, None), ("a", 1), ("a", None), ("", 0)] * 20)]
    df = spark.createDataFrame(rows, "g string, o int, n int, range string")
    got = running(df, "g", ["o"], "before", F.col("n").cast("bigint"), parts, ["n"])
    assert got.columns == ["g", "o", "n", "range", "before"]
    at = {}
    for r in sorted(got.collect(), key=lambda r: (r.g is not None, r.g or "", r.o is not None, r.o or 0, r.n, r.before)):
        assert r.before == at.get(r.g, 0)
        at[r.g] = at.get(r.g, 0) + r.n
    assert numbered(df.where("false"), "g", ["o"], parts=parts).count() == 0


def test_a_million_turns_in_chunks(spark):
    turns = spark.range(0, 1_000_000, 1, 8).select(F.lit("d").alias("g"), (F.lit(999_999) - F.col("id")).alias("turn"), F.repeat(F.lit("ab"), (F.col("id") % 4).cast("int")).alias("text"))
    got = chunked_texts(turns, "g", "turn", "text", 100_000, parts=16).cache()
    assert got.agg(F.sum("n_parts")).first()[0] == 1_000_000 and got.agg(F.max(F.length("unit_text"))).first()[0] <= 100_006
    chunks = got.orderBy("start").collect()
    assert [c.chunk for c in chunks] == sorted({c.chunk for c in chunks}) and len(chunks) > 35
    at = 0
    for c in chunks:
        assert c.start == at
        at += len(c.unit_text) + 1
    assert "\n".join(c.unit_text for c in chunks) == "\n".join("ab" * ((999_999 - i) % 4) for i in range(1_000_000))
    got.unpersist()


def test_chunks_of_small_and_null_groups(spark):
    rows = [(None, 1, "a"), (None, 0, None), ("x", 1, "long text"), ("x", 2, ""), ("x", 2, "b"), ("y", None, "z")]
    got = chunked_texts(spark.createDataFrame(rows, "g string, o int, text string"), "g", "o", "text", 10).collect()
    assert sorted(((r.g or "-"), r.chunk, r.start, r.unit_text, r.n_parts) for r in got) == [("-", 0, 0, "\na", 2), ("x", 0, 0, "long text", 1), ("x", 1, 10, "\nb", 2), ("y", 0, 0, "z", 1)]
