"""Least repairs of damaged conversations, by layers of cost over the states of a grammar.

Rule: a conversation is its rows by turn (nulls first). A row's fault is the first that holds: blank (the text has no
`[^\\x20\\x09-\\x0D]`), duplicate (a row before has the same role and text), truncated (the last such character isn't
`[.!?]`). Edits: keep a row (K, 0), make its role user or assistant (R, 1), delete it (D, 2; a must for blank and
duplicate rows), insert a user or assistant turn without text anywhere (I, 5); a truncated row that isn't deleted
costs 5 more. The repaired role initials must match `(s?(ua)+)?`. Of the cheapest repairs the one whose edits spell
the least ASCII string is taken; it fixes all roles, as each state asks for one initial.

Method: an automaton with four states (start, after s, u, a). For every row, from the last to the first, a bit set
holds the states from which the rest can be repaired at each cost: nibble c is the layer of cost base + c. An edit is
a shift by its cost of the states that it leads back from, so a row takes a dozen operations on one word. States of a
row differ in cost by 12 at most (what else they can do is insert u and a and delete an s), so sixteen layers hold
every least cost, whatever the length. The first layer with the start state is the cost; the trace goes forward
through the sets and takes the least letter whose layer fits.

Rows are dealt out by ranges of (conversation, turn, role, digest of text), so a long conversation lies in many
tasks; there each row becomes one character of initial and fault, and stretches of these are joined to a string per
conversation, as long as its audit, which is a cell of the result. Repeated texts are found by the least place of each
digest. Then audits and rows are sorted by conversation and place and read as a stream: a task holds one batch of
rows. A SHA-256 runs from the first text to the last, so one task reads a conversation's texts, in order, by an
external sort, and keeps none.

Nulls: a null role or text is one space, so such a text is blank and such a role illegal. Null turns come first and
don't count for gaps; rows with a null conv_id are one conversation. Rows of one turn are ordered by role, then by the
SHA-256 of their text; repeated rows are duplicates of the first. An empty role has no initial. gaps is null where
turns are further apart than a long can say. Other columns aren't read. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, join_groups, table, tasks, tune

INITIALS, FAULTS = "uasx", ("ok", "blank", "duplicate", "truncated")
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LAYERS = 16
START, S, U, A = range(4)
ROLES = {U: "user", A: "assistant"}
_ONES = int("1" * LAYERS, 16)
_ALL = (1 << 4 * LAYERS) - 1
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def onward(state: int) -> int:
    """The only state that a row of role user or assistant can lead to."""
    return A if state == U else U


def kept_state(state: int, initial: str) -> int | None:
    """The state behind a row that is kept, if it may stand there."""
    if initial == "s":
        return S if state == START else None
    return onward(state) if initial == "ua"[onward(state) - U] else None


def _back(x: int, initial: str = "ua") -> int:
    """In each layer, the states from which a row with one of the initials leads to a state of x."""
    out = 0
    if "s" in initial:
        out |= x >> S & _ONES
    if "u" in initial:
        u = x >> U & _ONES
        out |= u << START | u << S | u << A
    if "a" in initial:
        out |= (x >> A & _ONES) << U
    return out


def _inserts(x: int) -> int:
    """x, and the states that reach it by one or two inserted turns."""
    once = _back(x) << 4 * INSERT & _ALL
    return x | once | _back(once) << 4 * INSERT & _ALL


def repair(codes: str) -> tuple[int, str]:
    """The least cost and the audit of a conversation given by a character per row, as `code` has them."""
    rows = [divmod(ord(c) - 97, 4) for c in codes]
    n = len(rows)
    sets, bases = array("Q", bytes(8 * (n + 1))), array("q", bytes(8 * (n + 1)))
    sets[n] = x = _inserts(1 << START | 1 << A)
    base = 0
    for i in range(n - 1, -1, -1):
        who, fault = rows[i]
        y = x << 4 * DELETE
        if fault not in (1, 2):
            more = TRUNCATED if fault == 3 else 0
            y |= _back(x, INITIALS[who]) << 4 * more | _back(x) << 4 * (REROLE + more)
        low = ((y & -y).bit_length() - 1) // 4
        base += low
        sets[i] = x = _inserts(y >> 4 * low & _ALL)
        bases[i] = base

    def fits(i: int, state: int | None, left: int) -> bool:
        at = left - bases[i]
        return state is not None and 0 <= at < LAYERS and bool(sets[i] >> 4 * at + state & 1)

    cost = next(c for c in range(base, base + LAYERS) if fits(0, START, c))
    out, i, state, left = [], 0, START, cost
    while i < n or left:
        who, fault = rows[i] if i < n else (3, 1)
        more = TRUNCATED if fault == 3 else 0
        stays = None if fault in (1, 2) else kept_state(state, INITIALS[who])
        if i < n and fits(i + 1, state, left - DELETE):
            out.append("D")
            i, left = i + 1, left - DELETE
        elif fits(i, onward(state), left - INSERT):
            out.append("I")
            state, left = onward(state), left - INSERT
        elif i < n and fits(i + 1, stays, left - more):
            out.append("K")
            i, state, left = i + 1, stays, left - more
        else:
            out.append("R")
            i, state, left = i + 1, onward(state), left - REROLE - more
    return cost, "".join(out)


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and gone: rows damaged by crc32 of `conv_id:turn` modulo 20; dropped ones stay, marked."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("h"))
    rows = rows.withColumn("_copy", F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    left = F.when(F.col("h") == 1, F.lit("")).when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), left.alias("text"), (F.col("h") == 0).alias("gone"))


def placed(rows: DataFrame) -> DataFrame:
    """rows with pos, which rises by conversation, turn, role and digest of the text; written once."""
    digest, n = F.sha2("text", 256), tasks(rows)
    # rows that are alike in all of these are the same, so it doesn't matter which comes first: the salt deals them out
    keyed = rows.withColumns({"_d": digest, "_salt": F.rand(13)})
    order = ("conv_id", "turn", "role", "_d", "_salt")
    return cut(keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id()).drop("_salt"), "placed")


def plans(rows: DataFrame) -> DataFrame:
    """conv_id, the counts, cost and audit of each conversation. rows as `placed` gives them."""
    tune(rows.sparkSession)
    blank = ~F.col("text").rlike("[^ \\t-\\r]")
    slim = rows.withColumn("blank", blank)
    own = F.concat_ws("\n", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role").cast("string"), "role", "_d")
    slim = slim.withColumn("key", F.unhex(F.sha2(F.when(F.col("gone") | F.col("blank"), F.concat(F.lit(" "), F.col("pos").cast("string"))).otherwise(own), 256)))
    trimmed = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", " " * 5))
    slim = slim.select("conv_id", "turn", "gone", "pos", "blank", "key", F.substring("role", 1, 1).alias("initial"), F.substring(trimmed, -1, 1).isin(".", "!", "?").alias("ends"))
    several = slim.groupBy("key").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    told = join_groups(slim, several, "key", "n")
    who = F.when(F.col("initial").isin(*INITIALS[:3]), F.instr(F.lit(INITIALS), F.col("initial")) - 1).otherwise(3)
    fault = F.when(F.col("blank"), 1).when(F.col("pos") > F.col("first"), 2).when(~F.col("ends"), 3).otherwise(0)
    code = F.when(~F.col("gone"), F.struct("pos", F.chr(F.lit(97) + 4 * who + fault).alias("code"), "turn"))
    # a stretch is what one range holds of a conversation
    told = told.withColumns({"part": F.shiftright("pos", 33), "code": code})
    stretch = told.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("code")).alias("rows"), F.min("code.turn").alias("lo"), F.max("code.turn").alias("hi"))
    stretch = stretch.select("conv_id", F.struct("part", F.array_join(F.transform("rows", lambda x: x["code"]), "").alias("codes"), "lo", "hi", F.size(F.array_distinct(F.filter(F.transform("rows", lambda x: x["turn"]), lambda x: x.isNotNull()))).alias("turns")).alias("stretch"))
    whole = stretch.groupBy("conv_id").agg(F.sort_array(F.collect_list("stretch")).alias("stretches"))
    dated = F.filter("stretches", lambda x: x["lo"].isNotNull())
    whole = whole.select("conv_id", F.array_join(F.transform("stretches", lambda x: x["codes"]), "").alias("codes"), dated.alias("dated"))
    shared = F.size(F.filter(F.zip_with("dated", F.expr("slice(dated, 2, greatest(size(dated) - 1, 0))"), lambda a, b: a["hi"] == b["lo"]), lambda x: x))
    turns = F.aggregate("dated", F.lit(0).cast("long"), lambda a, x: a + x["turns"]) - shared
    span = F.try_subtract(F.array_max(F.transform("dated", lambda x: x["hi"])), F.array_min(F.transform("dated", lambda x: x["lo"])))
    gaps = F.when(F.size("dated") == 0, F.lit(0).cast("long")).otherwise(F.try_add(span, F.lit(1) - turns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got: list[tuple] = []
            for codes in b.column(1).to_pylist():
                initials = "".join(INITIALS[(ord(c) - 97) // 4] for c in codes)
                faults = [codes.count(c) for c in map(chr, range(97, 113))]
                legal = sum(initials.count(p) for p in ("su", "ua", "au"))  # no two of one pair overlap
                got.append((*(sum(faults[k::4]) for k in (1, 2, 3)), max(0, len(codes) - 1) - legal, *repair(codes)))
            cols = list(zip(*got, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *[pa.array(c, pa.int64()) for c in cols[:5]], pa.array(cols[5], pa.string())], names=["conv_id", *_COUNTS, "audit"])

    kind = rows.schema["conv_id"].dataType.simpleString()
    return whole.select("conv_id", "codes", gaps.alias("gaps")).mapInArrow(run, f"conv_id {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string")


def _streamed(rows: DataFrame) -> DataFrame:
    """Each conversation's plan, then its rows in order, in one task."""
    heads = cut(plans(rows), "plans").withColumns({"pos": F.lit(-1).cast("long"), "role": F.col("audit"), "text": F.lit("")})
    nothing = {c: F.lit(0).cast("long") for c in _COUNTS}
    every = heads.drop("audit").unionByName(rows.where("NOT gone").select("conv_id", "pos", "role", "text").withColumns(nothing))
    return every.repartition(tasks(rows), "conv_id").sortWithinPartitions("conv_id", "pos").select("conv_id", "pos", "role", "text", *_COUNTS)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of a stream as above: (head,) at each plan, then (edit, role, text) for each row of the repair; deleted rows don't come."""
    audit, at, state = "", 0, START

    def inserted():
        nonlocal at, state
        while audit[at : at + 1] == "I":
            state, at = onward(state), at + 1
            yield "I", ROLES[state], ""

    for b in batches:
        cols = [c.to_pylist() for c in b.columns]
        for conv, pos, role, text, *counts in zip(*cols, strict=True):
            if pos < 0:
                yield from inserted()
                audit, at, state = role, 0, START
                yield ((conv, *counts, audit),)
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "R":
                state = onward(state)
                yield edit, ROLES[state], text
            elif edit == "K":
                state = kept_state(state, role[:1])
                yield edit, role, text
    yield from inserted()


def repaired_turns(rows: DataFrame, most: int = 1000) -> DataFrame:
    """conv_id, turn (dense from 0), role, text and edit of the repaired conversations. rows as `damage` gives them; gone may be all false."""

    def run(batches):
        out, conv, turn = [], None, 0
        for x in _edited(batches):
            if len(x) == 1:
                conv, turn = x[0][0], 0
                continue
            out.append((conv, turn, x[1], x[2], x[0]))
            turn += 1
            if len(out) == most:
                yield _batch(out)
                out = []
        yield _batch(out)

    def _batch(out):
        cols = list(zip(*out, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(cols[0], ids), pa.array(cols[1], pa.int64()), *[pa.array(c, pa.string()) for c in cols[2:]]], names=["conv_id", "turn", "role", "text", "edit"])

    ids = _arrow(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _streamed(placed(rows)).mapInArrow(run, f"conv_id {kind}, turn long, role string, text string, edit string")


def _arrow(rows: DataFrame) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[rows.schema["conv_id"].dataType.simpleString()]


def repaired(rows: DataFrame, most: int = 1000) -> DataFrame:
    """conv_id, the counts, cost, audit and repaired_sha256: the digest of the repaired turns as `role:text`, newline-joined."""

    def run(batches):
        out: list[list] = []
        sha, first = None, True
        for x in _edited(batches):
            if len(x) == 1:
                if out:
                    out[-1].append(sha.hexdigest())
                if len(out) == most:
                    yield _batch(out)
                    out = []
                out.append(list(x[0]))
                sha, first = hashlib.sha256(), True
                continue
            sha.update(f"{'' if first else chr(10)}{x[1]}:{x[2]}".encode())
            first = False
        if out:
            out[-1].append(sha.hexdigest())
        yield _batch(out)

    def _batch(out):
        cols = list(zip(*out, strict=True)) or [()] * 9
        return pa.RecordBatch.from_arrays([pa.array(cols[0], ids), *[pa.array(c, pa.int64()) for c in cols[1:7]], *[pa.array(c, pa.string()) for c in cols[7:]]], names=["conv_id", *_COUNTS, "audit", "repaired_sha256"])

    ids = _arrow(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _streamed(placed(rows)).mapInArrow(run, f"conv_id {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string, repaired_sha256 string")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damage(table(spark, sf_dir, "conversations")))
