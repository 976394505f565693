"""Repair of conversations: the cheapest edits that make a conversation's turns legal, and what was wrong before.

A legal conversation has role initials ``(s?(ua)+)?``. Rows may be kept (0), reroled to user or assistant (3) or deleted
(4); blank and repeated rows must go; a truncated row that stays costs 3 more; empty user or assistant turns may be
inserted anywhere (3). Of edits of equal cost those whose initials (D, I, K, R) are least in ASCII are taken.

Retained-subsequence DP. A solution is the subsequence of rows that stay, each with a role. All costs are held less the
prefix sum of deletions, so a row that is passed over changes nothing, and the running minimum of each role (the best
solution whose last retained turn has it) is all that a later row has to look at: the gap's deletions are priced by the
prefix sum, its inserts by the pair of roles. Ties are broken by the audits without ever comparing them: audits of different
states are never equal nor the beginning of one another, so it is enough to carry their order, and to compare the initials
that one step adds (see ``solve``). One byte a row and state leads back.

On Spark: rows are put in order once, over ranges of (conversation, turn), so that a conversation of any length is many
parts; first occurrences are found by an aggregate and joined back in salted parts; what the DP needs of a row is one byte.
Bytes are packed by range, then by conversation. One worker holds some bytes for each row of a conversation, as the audit,
one value of the result, does; texts are never gathered: ``repaired`` sends each text once to where its edit is, and
digests are fed row by row.

Defined results: nulls of role and text count as one space, and so do null ids and turns in the key of the damage. Rows of
a null conversation are one conversation. Null turns come first; rows of one turn are in order of role and text. Rows are
told apart by 128-bit hashes of role and text. A role's initial is its first character, case counting. Equal rows, empty
tables, long texts and extra columns are fine. A conversation without rows has zeros, an empty audit and the digest of an
empty text. Turns are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stage, bound_batches, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: the role of the last turn that stays; 0 before any.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Inserts that a role needs before it, after each state; None where it can't follow. Then those needed at the end.
BEFORE = {SYSTEM: (0, None, None, None), USER: (0, 0, 1, 0), ASSISTANT: (1, 1, 0, 1)}
AT_END = (0, 2, 1, 0)
#: Faults of a row, of which the first counts.
FINE, BLANK, DUPLICATE, CUT = range(4)
#: What a step adds to an audit, in ASCII order.
STEPS = ("D", "IK", "IR", "K", "R")
SPACE = " \t\n\x0b\x0c\r"
#: Parts that a key of first occurrences is joined in.
SALTS = 16


def _options() -> dict[int, list[tuple[int, int, int, int]]]:
    """For each code of a row (initial + 4 * fault): (state, state before, step, cost beside a deletion)."""
    out = {}
    for fault in range(4):
        for initial in range(4):
            rows = []
            for to in () if fault in (BLANK, DUPLICATE) else (SYSTEM, USER, ASSISTANT):
                if to == SYSTEM and initial != SYSTEM:
                    continue
                own = (KEEP if initial == to else REROLE) + (TRUNCATED if fault == CUT else 0)
                for before, inserts in enumerate(BEFORE[to]):
                    if inserts is not None:
                        rows.append((to, before, STEPS.index("I" * inserts + ("K" if initial == to else "R")), own + INSERT * inserts - DELETE))
            out[initial + 4 * fault] = rows
    return out


OPTIONS = _options()
FAR = 1 << 60


def solve(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of rows of these codes.

    The running minimum of a state has a value, less the deletions so far, and a rank: the place of its audit among those of
    the states. Two audits of one row either come from different states, and then keep their order, as neither begins with
    the other (both hold one edit of each row and end in one, so the longer would go on with inserts alone), or from one
    state, and then the step decides.
    """
    value, rank = [0, FAR, FAR, FAR], [0, 1, 2, 3]
    back = bytearray(4 * len(codes))
    at = 0
    for code in codes:
        best = [(value[s], rank[s], 0, s) for s in range(4)]  # deleted
        for to, before, step, cost in OPTIONS[code]:
            if value[before] < FAR:
                new = (value[before] + cost, rank[before], step, before)
                if new < best[to]:
                    best[to] = new
        for s, b in enumerate(best):
            back[at + s] = b[2] * 4 + b[3]
        order = sorted(range(4), key=lambda s: best[s][1:3])
        value = [b[0] for b in best]
        for i, s in enumerate(order):
            rank[s] = i
        at += 4
    end = min((value[s] + INSERT * AT_END[s], rank[s], s) for s in range(4) if value[s] < FAR)
    state, steps = end[2], []
    for at in range(at - 4, -1, -4):
        step, before = divmod(back[at + state], 4)
        steps.append(STEPS[step])
        state = before
    return end[0] + DELETE * len(codes), "".join(reversed(steps)) + "I" * AT_END[end[2]]


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, copy, gone) with faults seeded by a checksum of their key; dropped rows are marked."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    body = F.when(k == 1, "").when(k == 2, F.regexp_replace(space(text), "[.!?]", "")).otherwise(space(text))
    copies = F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.when(k == 4, "user").otherwise(space(role)).alias("role"), body.alias("text"), F.explode(copies).alias("copy"), (k == 0).alias("gone"))


def plain(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, copy, gone) as they are."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), space(role).alias("role"), space(text).alias("text"), F.lit(0).alias("copy"), F.lit(False).alias("gone"))


def _initial(role: Column) -> Column:
    head = F.left(role, F.lit(1))
    return F.when(head == "s", SYSTEM).when(head == "u", USER).when(head == "a", ASSISTANT).otherwise(0)


class Repair:
    """Conversations put in order and repaired: ``edits`` (one row a conversation) and ``repaired`` (its turns)."""

    def __init__(self, rows: DataFrame):
        bound_batches(rows.sparkSession)
        start = F.left("text", F.lit(32))  # ranges are drawn from samples of keys, so these are short
        order = ["conv", "turn", "role", start, "text", "copy"]
        ranged = rows.repartitionByRange("conv", "turn", "role", start).sortWithinPartitions(*order)
        # The order is written down once: a number that grows with range and place.
        self._rows = Stage(ranged.withColumn("at", F.monotonically_increasing_id()), "turns-rows")
        self.rows = self._rows.df
        self._edits = Stage(self._solved(), "turns-edits")
        self.edits = self._edits.df

    def _coded(self) -> DataFrame:
        """(conv, turn, at, code): code null for rows that the damage dropped."""
        tail = F.rtrim("text", F.lit(SPACE))
        same = [F.xxhash64("role", "text").alias("h"), F.xxhash64(F.lit("turn"), "text", "role").alias("g")]
        slim = self.rows.select("conv", "turn", "at", "copy", "gone", *same, _initial(F.col("role")).alias("initial"), (tail == "").alias("blank"), (~F.right(tail, F.lit(1)).isin(".", "!", "?")).alias("cut"))
        # A copy made by the damage always has its like before it. Others are few, once counted.
        seen = slim.where("not gone and copy = 0").groupBy("conv", "h", "g").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        seen = seen.select(F.col("conv").alias("c"), F.col("h").alias("h1"), F.col("g").alias("g1"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s1"))
        slim = slim.withColumn("salt", F.pmod(F.xxhash64("at"), F.lit(SALTS)).cast("int"))
        same_key = slim["conv"].eqNullSafe(seen["c"]) & (slim["h"] == seen["h1"]) & (slim["g"] == seen["g1"]) & (slim["salt"] == seen["s1"])
        repeat = (F.col("copy") == 1) | F.coalesce(F.col("at") > F.col("first"), F.lit(False))
        fault = F.when(F.col("blank"), BLANK).when(repeat, DUPLICATE).when(F.col("cut"), CUT).otherwise(FINE)
        return slim.join(seen, same_key, "left").select("conv", "turn", "at", F.when(~F.col("gone"), F.col("initial") + 4 * fault).alias("code"))

    def _solved(self) -> DataFrame:
        coded = self._coded()
        kept = F.col("code").isNotNull()
        # One byte a row: packed by range first, so that what meets for one conversation is as long as its audit.
        by_range = coded.groupBy("conv", F.shiftright("at", 33).alias("range")).agg(F.array_sort(F.collect_list(F.when(kept, F.struct("at", "code")))).alias("x"), F.min(F.when(kept, F.col("turn"))).alias("lo"), F.max(F.when(kept, F.col("turn"))).alias("hi"))
        packed = by_range.select("conv", "range", F.unhex(F.array_join(F.transform("x", lambda r: F.lpad(F.hex(r["code"]), 2, "0")), "")).alias("codes"), "lo", "hi")
        each = packed.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("range", "codes"))).alias("parts"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        turns = coded.where(kept & F.col("turn").isNotNull()).select("conv", "turn").distinct().groupBy(F.col("conv").alias("c")).agg(F.count("*").alias("turns"))
        each = each.join(turns, each["conv"].eqNullSafe(turns["c"]), "left")
        each = each.select("conv", F.coalesce(F.expr("hi - lo + 1 - turns"), F.lit(0)).cast("bigint").alias("gaps"), F.transform("parts", lambda p: p["codes"]).alias("codes"))
        kind = each.schema["conv"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for parts in b.column(2).to_pylist():
                    codes = b"".join(parts)
                    faults, initials = bytes(c >> 2 for c in codes), bytes(c & 3 for c in codes)
                    legal = sum(1 for p in zip(initials, initials[1:]) if p in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)))
                    rows.append((*(faults.count(f) for f in (BLANK, DUPLICATE, CUT)), max(0, len(codes) - 1) - legal, *solve(codes)))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 6
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.string())], names=["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

        return each.mapInArrow(run, f"conv {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")

    def _woven(self) -> DataFrame:
        """Edits before the rows of each conversation, in order, all in one stream."""
        none = lambda t: F.lit(None).cast(t)
        edits = self.edits.select("conv", F.lit(-1).cast("bigint").alias("at"), "audit", none("string").alias("role"), none("string").alias("text"))
        rows = self.rows.where("not gone").select("conv", "at", none("string").alias("audit"), "role", "text")
        return edits.unionByName(rows).repartition("conv").sortWithinPartitions("conv", "at")

    def repaired(self) -> DataFrame:
        """(conv, place, role, text, edit) of each turn that stays or is put in, in order from 0."""
        kind = self.rows.schema["conv"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for conv, fresh, place, turns in _turns(batches):
                if fresh:
                    continue
                yield pa.RecordBatch.from_arrays([pa.array([conv] * len(turns), kinds), pa.array(range(place, place + len(turns)), pa.int64()), *(pa.array([t[i] for t in turns], pa.string()) for i in range(3))], names=["conv", "place", "role", "text", "edit"])

        kinds = _arrow(self.rows, "conv")
        return self._woven().mapInArrow(run, f"conv {kind}, place bigint, role string, text string, edit string")

    def digests(self) -> DataFrame:
        """(conv, sha256) of the repaired ``role:text`` lines, joined by newlines and fed turn by turn."""
        kinds, kind = _arrow(self.rows, "conv"), self.rows.schema["conv"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, sha, done = None, None, []
            for conv, fresh, place, turns in _turns(batches):
                if fresh:
                    if sha:
                        done.append((now, sha.hexdigest()))
                    now, sha = conv, hashlib.sha256()
                for i, (role, text, _) in enumerate(turns):
                    sha.update((("\n" if place + i else "") + role + ":" + text).encode("utf-8", "replace"))
                if len(done) >= 512:
                    yield _digest_rows(done, kinds)
                    done = []
            if sha:
                done.append((now, sha.hexdigest()))
            yield _digest_rows(done, kinds)

        return self._woven().mapInArrow(run, f"conv {kind}, sha256 string")

    def drop(self) -> None:
        self._rows.drop()
        self._edits.drop()


def _digest_rows(done: list[tuple], kinds: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kinds), pa.array([d[1] for d in done], pa.string())], names=["conv", "sha256"])


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, fresh, place of the first, [(role, text, edit)]) from woven rows; ``fresh`` begins a conversation, without
    turns. A turn's role follows from those before: after a kept system turn, user and assistant alternate."""
    conv, audit, at, last_row, role, place = None, "", 0, 0, START, 0
    for b in batches:
        out: list[tuple] = []

        def put(own: str | None, text: str, edit: str) -> None:
            nonlocal role
            if edit == "K":
                role = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[own[0]]
            else:
                role = ASSISTANT if role == USER else USER
            out.append((own if edit == "K" else ROLES[role], text, edit))

        for c, edits, own, text in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
            if edits is not None:
                if out:
                    yield conv, False, place, out
                conv, audit, at, last_row, role, place, out = c, edits, 0, len(edits.rstrip("I")), START, 0, []
                yield conv, True, 0, []
                continue
            while audit[at] == "I":
                put(None, "", "I")
                at += 1
            if audit[at] != "D":
                put(own, text, audit[at])
            at += 1
            if at == last_row:
                for _ in audit[at:]:
                    put(None, "", "I")
        if out:
            yield conv, False, place, out
            place += len(out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = Repair(damaged(table(spark, sf_dir, "conversations")))
    digests = got.digests().withColumnRenamed("conv", "c")
    edits = got.edits
    both = edits.join(digests, edits["conv"].eqNullSafe(digests["c"]))
    return both.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha256").alias("repaired_sha256"))
