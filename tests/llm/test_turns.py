"""Conversation repair against a plain reading of its rules."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from lexmill.llm import op11_turns

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def cheapest(rows):
    """Least (cost, audit) over all edits, by what may follow a place: rows of (initial, fault)."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def rest(i, state, inserts):
        options = [(0, "")] if i == len(rows) and state in ("", "a") else []
        if inserts < 2:
            options += [(3 + c, "I" + a) for r in "ua" if r in follow[state] for c, a in [rest(i, r, inserts + 1)] if c is not None]
        if i < len(rows):
            initial, fault = rows[i]
            c, a = rest(i + 1, state, 0)
            options += [(4 + c, "D" + a)] if c is not None else []
            if fault not in ("blank", "duplicate"):
                for r in follow[state]:
                    c, a = rest(i + 1, r, 0)
                    more = 3 if fault == "truncated" else 0
                    if c is not None:
                        options += [(c + more, "K" + a)] if r == initial else []
                        options += [(c + more + 3, "R" + a)] if r in "ua" else []
        return min(options, default=(None, ""))

    for i in range(len(rows), 0, -50):  # so that no call goes deep
        for state in follow:
            rest(i, state, 0)
    return rest(0, "", 0)


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        tail = text.rstrip(WHITE)
        out.append("blank" if not tail else "duplicate" if (role, text) in seen else "truncated" if tail[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def rebuilt(rows, audit):
    out, i, last = [], 0, ""
    for e in audit:
        if e == "D":
            i += 1
        elif e == "K":
            out.append(rows[i])
            last, i = rows[i][0][0], i + 1
        else:
            last = "a" if last == "u" else "u"
            out.append(({"u": "user", "a": "assistant"}[last], rows[i][1] if e == "R" else ""))
            i += e == "R"
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out))
    return out


def expected(rows):
    """rows of (conv, turn, role, text) -> {conv: the query's other columns}."""
    one = lambda x: " " if x is None else str(x)
    convs = {c: [] for c, *_ in rows}
    for c, turn, role, text in rows:
        k = zlib.crc32(f"{one(c)}:{one(turn)}".encode()) % 20
        role, text = "user" if k == 4 else one(role), "" if k == 1 else re.sub("[.!?]", "", one(text)) if k == 2 else one(text)
        convs[c] += [(turn is not None, turn or 0, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    out = {}
    for c, got in convs.items():
        got.sort()
        turns, body = [t for some, t, *_ in got if some], [r[2:] for r in got]
        fault = faults(body)
        heads = [(r[:1] if r[:1] in "sua" else "", f) for (r, _), f in zip(body, fault, strict=True)]
        cost, audit = cheapest(tuple(heads))
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(body, body[1:])]
        lines = "\n".join(f"{r}:{t}" for r, t in rebuilt(body, audit))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[c] = (gaps, *(fault.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(lines.encode()).hexdigest())
    return out


def test_edits_equal_all_edits():
    rng = random.Random(4)
    names = {"blank": op11_turns.BLANK, "duplicate": op11_turns.DUPLICATE, "truncated": op11_turns.CUT, "": op11_turns.FINE}
    for _ in range(4000):
        rows = tuple((rng.choice(["s", "u", "u", "a", "a", ""]), rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(rng.randrange(9)))
        codes = bytes(" sua".index(i or " ") + 4 * names[f] for i, f in rows)
        assert op11_turns.solve(codes) == cheapest(rows), rows


def conversations():
    rng, rows = random.Random(9), []
    for c in [*range(60), None]:
        for t in range(rng.randrange(1, 12)):
            text = rng.choice(["So it is.", "Is it?", "cut off", "a b. ", "", " \t", "So it is. \n", "é!", None])
            rows.append((c, rng.choice([t, t, t, t + 2, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", None]), text))
    rows += [(900, t, "user" if t % 2 else "assistant", f"{t}. " + "word " * (t * 37 % 50) + "!") for t in range(700)] + [(901, 5, "user", "x" * 300_000 + ".")]
    dropped = next(i for i in range(1000, 9999) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    return [*rows, *rows[:40], (dropped, 1, "user", "Gone.")]


@pytest.mark.parametrize("parts", ["8", "64"])
def test_repair_equals_plain_reading(spark, tmp_path, parts):
    rows = conversations()
    want = expected(rows)
    spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, conv int, at string, h string").write.parquet(f"{tmp_path}/conversations.parquet")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = op11_turns.query(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert len(got) == len(want)
    assert {r[0]: tuple(r[1:]) for r in got} == want


def test_repaired_turns_are_the_edited_rows(spark):
    rows = [r for r in conversations() if r[0] in (3, 4, 5, 900)]
    got = op11_turns.Repair(op11_turns.plain(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")))
    audits = {r.conv: r.audit for r in got.edits.collect()}
    turns = {}
    for r in got.repaired().orderBy("conv", "place").collect():
        assert r.place == len(turns.setdefault(r.conv, []))
        turns[r.conv].append((r.role, r.text))
    for c, audit in audits.items():
        body = sorted((t is not None, t or 0, role or (" " if role is None else role), " " if text is None else text) for k, t, role, text in rows if k == c)
        assert turns.get(c, []) == rebuilt([b[2:] for b in body], audit)
    got.drop()


def test_repair_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert op11_turns.query(spark, str(tmp_path)).count() == 0
