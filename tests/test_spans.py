from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.functions.anchors import anchored, anchored_pairs
from lexmill.functions.spans import occurrences, split_by_ellipsis, uncovered

TEXT = st.text("ab泉岩渡.月", max_size=14)
FORM = st.text("ab泉岩渡", max_size=3)


def starts(text, form):
    return [i + 1 for i in range(len(text)) if form and text.startswith(form, i)]


def bare(text, form, target):
    return [p for p in starts(text, form) if not any(t <= p and p + len(form) <= t + len(target) for t in starts(text, target))]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TEXT, FORM, FORM), min_size=20, max_size=40))
def test_spans_equal_brute_force(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, f string, g string")
    got = {r.i: r for r in df.select("i", occurrences("t", "f").alias("o"), uncovered("t", "f", "g").alias("u")).collect()}
    for i, (t, f, g) in enumerate(rows):
        assert got[i].o == starts(t, f)
        assert got[i].u == (bare(t, f, g) if f and f in t else [])


def test_partly_covered_form_is_uncovered(spark):
    r = spark.sql("select '泉岩渡' t").select(uncovered("t", F.lit("岩渡"), F.lit("泉岩")).alias("u"), occurrences("t", F.lit("")).alias("e")).first()
    assert r.u == [2] and r.e == []


def test_regex_characters_in_forms(spark):
    r = spark.sql(r"select 'a.b a\\Eb (a)' t").select(occurrences("t", F.lit("a.b")).alias("x"), occurrences("t", F.lit("(a)")).alias("y"), occurrences("t", F.lit("\\E")).alias("z")).first()
    assert (r.x, r.y, r.z) == ([1], [10], [6])


def test_split_target(spark):
    df = spark.createDataFrame([("岚石...月",), ("岚石……月",), ("岚石……光",), ("岚石月",)], "t string")
    assert [r[0] for r in df.select(split_by_ellipsis(F.col("t"), F.lit(1), F.lit("岚石"), F.lit("岚石月"))).collect()] == [True, True, False, False]


CASES = [("High Elves came", "High Elf", True), ("PreBrightholm-era", "Brightholm", False), ("归来Harlow了", "Harlow", True), ("Marion's note", "Marion", True), ("sandcrabs", "Sandcrab", False), ("Two Cities", "City", True), ("x_Orc", "Orc", False), ("a.b here", "a.b", True), ("acb here", "a.b", False), (None, "x", None)]


def test_anchors_agree(spark):
    units = spark.createDataFrame([(i, s) for i, (s, _, _) in enumerate(CASES)], "unit_id bigint, source string")
    forms = spark.createDataFrame([(i, e) for i, (_, e, _) in enumerate(CASES)], "form_id bigint, english string")
    pairs = {(r.unit_id, r.form_id) for r in anchored_pairs(units, forms).collect()}
    for i, (s, e, want) in enumerate(CASES):
        got = spark.createDataFrame([(s, e)], "s string, e string").select(anchored("s", "e")).first()[0]
        assert got == want, (s, e)
        assert ((i, i) in pairs) == bool(want), (s, e)
