"""Where the test tables are, and the comparison of Spark rows with DuckDB's, whatever their order."""

import os

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def same_rows(df, duck, sql):
    got = df.collect()
    want = duck.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    names = sorted(df.columns)
    at = [want.columns.index(n) for n in names]
    a = sorted((tuple(plain(r[n]) for n in names) for r in got), key=repr)
    b = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert a == b
