"""Repair of conversations by the cheapest edits of their rows, a run-length dynamic program.

A repaired conversation is empty, or pairs of a user and an assistant row that a system row may precede. ``Keep`` costs
0, ``Rerole`` (to user or assistant) 3, ``Delete`` 4, ``Insert`` (an empty user or assistant row) 3; a truncated row that
stays adds 3; blank and duplicate rows must go. Of equally cheap edits the least string of initials is taken.

Rows become symbols of role initial and fault. Equal symbols in a row are one run, and a run of any length is a few
products with powers of two of its min-plus transition, which are remembered. Min-plus products can be grouped at will,
so a conversation is cut into segments of bounded length that tasks advance and unroll apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import BLANK_CHARS, column, stage

SEGMENT_BITS = 14
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NONE = 1 << 60

# States: nothing yet, after a system row, after a user row, after an assistant row.
STATES = range(4)
# What a state accepts, by role initial, and the one of user and assistant that may come next.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = "uuau"
# What it costs to end in a state.
ENDING = (0, 2 * INSERT, INSERT, 0)
# Symbols by fault (none, truncated, must go) and initial (system, user, assistant, any other).
SYMBOLS = ("suao", "SUAO", "1234")
INITIALS = {c: i for row in SYMBOLS for c, i in zip(row, "suao")}
LEGAL = {"su", "ua", "au"}
# One character of a plan per edit, and its initial in the audit.
AUDIT = str.maketrans("UAua", "RRII")
ROLES = {"u": "user", "a": "assistant"}


def _moves(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """Edits that use up a row, as (plan character, cost, next state), in the order of their initials."""
    moves = [("D", DELETE, state)]
    if symbol in SYMBOLS[2]:
        return moves
    more = TRUNCATED if symbol in SYMBOLS[1] else 0
    if (after := NEXT[state].get(INITIALS[symbol])) is not None:
        moves.append(("K", KEEP + more, after))
    wanted = WANTED[state]
    return [*moves, (wanted.upper(), REROLE + more, NEXT[state][wanted])]


@lru_cache
def _inserted(state: int) -> list[tuple[int, int]]:
    """(cost, state) that inserts alone reach."""
    reached = {state: 0}
    at, cost = state, 0
    while (at := NEXT[at][WANTED[at]]) not in reached:
        reached[at] = cost = cost + INSERT
    return [(cost, at) for at, cost in reached.items()]


def _times(a: tuple, b: tuple) -> tuple:
    """The min-plus product."""
    return tuple(tuple(min(min(a[i][k] + b[k][j] for k in STATES), NONE) for j in STATES) for i in STATES)


def _before(a: tuple, after: tuple) -> tuple:
    """Costs to the end ahead of ``a``, from those behind it."""
    return tuple(min(a[i][k] + after[k] for k in STATES) for i in STATES)


@lru_cache
def _power(symbol: str, k: int) -> tuple:
    """The transition of 2 ** k rows of a symbol."""
    if k:
        half = _power(symbol, k - 1)
        return _times(half, half)
    rows = [[NONE] * 4 for _ in STATES]
    for i in STATES:
        for inserts, state in _inserted(i):
            for _, cost, after in _moves(symbol, state):
                rows[i][after] = min(rows[i][after], inserts + cost)
    return tuple(map(tuple, rows))


def _powers(length: int) -> list[int]:
    return [k for k in range(length.bit_length()) if length >> k & 1]


def _runs(symbols: str) -> list[tuple[str, int]]:
    return [(symbol, sum(1 for _ in run)) for symbol, run in groupby(symbols)]


@lru_cache(1 << 14)
def _unroll_run(symbol: str, length: int, state: int, after: tuple) -> tuple[str, int]:
    """The plan of a run from a state, with the costs behind it, and the state that it ends in.

    Halves are remembered, so a long run of the same choices costs about the logarithm of its length.
    """
    if length > 1:
        half = 1 << (length - 1).bit_length() - 1
        middle = after
        for k in _powers(length - half):
            middle = _before(_power(symbol, k), middle)
        first, state = _unroll_run(symbol, half, state, _least_zero(middle)[0])
        second, state = _unroll_run(symbol, length - half, state, after)
        return first + second, state
    plan, ahead = "", _before(_power(symbol, 0), after)
    while True:
        moves = _moves(symbol, state)
        wanted = WANTED[state]
        moves.insert(1, (wanted, INSERT, NEXT[state][wanted]))
        for edit, cost, then in moves:
            if cost + (ahead if edit == wanted else after)[then] == ahead[state]:
                plan, state = plan + edit, then
                break
        if edit != wanted:
            return plan, state


def _least_zero(costs: tuple) -> tuple[tuple, int]:
    """Costs less their least, so that equal choices look equal, and the least."""
    least = min(costs)
    return tuple(c - least for c in costs), least


def transition(symbols: str) -> tuple:
    """The min-plus transition of a row of symbols, run by run."""
    whole = None
    for symbol, length in _runs(symbols):
        for k in _powers(length):
            whole = _power(symbol, k) if whole is None else _times(whole, _power(symbol, k))
    return whole


def unroll(symbols: str, after: tuple, last: bool) -> list[tuple[str, int, int]]:
    """(plan, cost, end state) from each start state; ``last`` adds the inserts that end the conversation."""
    runs, behind = _runs(symbols), []
    for symbol, length in reversed(runs):
        behind.append(after)
        for k in _powers(length):
            after = _before(_power(symbol, k), after)
    behind.reverse()
    found = []
    for start in STATES:
        state, plan = start, []
        for (symbol, length), costs in zip(runs, behind):
            part, state = _unroll_run(symbol, length, state, _least_zero(costs)[0])
            plan.append(part)
        cost = after[start] - behind[-1][state]
        if last:
            cost = after[start]
            while ENDING[state]:
                plan.append(WANTED[state])
                state = NEXT[state][WANTED[state]]
        found.append(("".join(plan), cost, state))
    return found


transition_of_short = lru_cache(1 << 12)(transition)
unroll_short = lru_cache(1 << 12)(unroll)
SHORT = 64


def _illegal(symbols: str) -> int:
    return sum(INITIALS[a] + INITIALS[b] not in LEGAL for a, b in zip(symbols, symbols[1:]))


def _out(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("conv_id", pa.int64()), ("seg", pa.int64()), ("costs", pa.list_(pa.int64())), ("ends", pa.string())])
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            of = transition_of_short if len(row["symbols"]) <= SHORT else transition
            matrix = of(row["symbols"])
            rows.append({"conv_id": row["conv_id"], "seg": row["seg"], "costs": [c for line in matrix for c in line],
                         "ends": row["symbols"][0] + row["symbols"][-1]})
        yield _out(kind, rows)


def _look_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs behind each segment of the conversations that have several."""
    kind = pa.schema([("conv_id", pa.int64()), ("seg", pa.int64()), ("after", pa.list_(pa.int64())), ("last", pa.bool_()),
                      ("joint", pa.int64())])
    for batch in batches:
        for row in batch.to_pylist():
            after, rows, then = ENDING, [], None
            for part in reversed(row["parts"]):
                joint = then is not None and _illegal(part["ends"][1] + then)
                rows.append({"conv_id": row["conv_id"], "seg": part["seg"], "after": list(after), "last": then is None,
                             "joint": int(joint)})
                flat = part["costs"]
                after, then = _before([flat[i:i + 4] for i in range(0, 16, 4)], after), part["ends"][0]
            yield _out(kind, rows)


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("conv_id", pa.int64()), ("seg", pa.int64()), ("plans", pa.list_(pa.string())),
                      ("costs", pa.list_(pa.int64())), ("exits", pa.list_(pa.int32())), ("illegal", pa.int64())])
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            symbols = row["symbols"]
            of = unroll_short if len(symbols) <= SHORT else unroll
            plans, costs, exits = zip(*of(symbols, tuple(row["after"] or ENDING), row["last"] is not False))
            rows.append({"conv_id": row["conv_id"], "seg": row["seg"], "plans": plans, "costs": costs, "exits": exits,
                         "illegal": _illegal(symbols) + (row["joint"] or 0)})
        yield _out(kind, rows)


def _look_ahead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each segment of the conversations that have several starts."""
    kind = pa.schema([("conv_id", pa.int64()), ("seg", pa.int64()), ("start", pa.int32())])
    for batch in batches:
        for row in batch.to_pylist():
            state, rows = 0, []
            for part in row["parts"]:
                rows.append({"conv_id": row["conv_id"], "seg": part["seg"], "start": state})
                state = part["exits"][state]
            yield _out(kind, rows)


def conversation_rows(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """Just the columns that a repair works on; a null role or text is one space."""
    return df.select(
        column(conv_col).cast("long").alias("conv_id"), column(turn_col).cast("long").alias("turn"),
        F.coalesce(column(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(column(text_col).cast("string"), F.lit(" ")).alias("text"))


def damage(df: DataFrame) -> DataFrame:
    """Rows with the faults that the check prescribes, by the crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ends of sentences, 3 repeats it, 4 makes it a user's.
    """
    rows = conversation_rows(df)
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fate = F.crc32(key.cast("binary")) % 20
    times = F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


def _symbol(initial: Column, fault: Column) -> Column:
    """The symbol of a row; ``fault`` is 0, 1 for truncated, 2 for rows that must go."""
    which = F.when(initial.isin("s", "u", "a"), F.instr(F.lit("sua"), initial)).otherwise(4)
    return F.substring(F.lit("".join(SYMBOLS)), (fault * 4 + which).cast("int"), F.lit(1))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def repair_plans(rows: DataFrame, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """One row per segment of a conversation: conv_id, seg, turn, role, digest, plan, cost, faults.

    ``turn``, ``role`` and ``digest`` (MD5 of the text) are those of the segment's first row; ``plan`` has one character
    per edit: K, D, U and A for a new role, u and a for an inserted row. ``blank``, ``duplicate``, ``truncated`` and
    ``illegal`` (places where a role must not follow) count what was found.

    Texts are read once for their faults and digests; all that is shuffled is narrow. Rows are ordered by ranges, so that
    a conversation of any size is dealt over many tasks, and numbered by place. Segments have 2 ** ``segment_bits`` rows
    at most; what is brought together per conversation is one small matrix for each. Earlier copies of a row come from an
    aggregate by role and digest that combines per task.
    """
    bare = F.rtrim(F.col("text"), F.lit(BLANK_CHARS))
    end = F.substring(bare, F.lit(-1), F.lit(1))
    numbered = stage(
        rows.select("conv_id", "turn", "role", F.md5("text").alias("digest"),
                    F.when(bare == "", 2).when(end.isin(".", "!", "?"), 0).otherwise(1).alias("fault"),
                    F.monotonically_increasing_id().alias("row"))
        .repartitionByRange("conv_id", "turn", "role", "digest", "row")
        .sortWithinPartitions("conv_id", "turn", "role", "digest", "row")
        .drop("row").withColumn("at", F.monotonically_increasing_id()), "repair-rows")

    firsts = stage(
        numbered.filter("fault < 2").groupBy("conv_id", "role", "digest").agg(
            F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1").select(
            F.col("conv_id").alias("of"), F.col("role").alias("by"), F.col("digest").alias("what"), "first"), "repair-firsts")
    marked = numbered.join(
        firsts, _same(F.col("conv_id"), F.col("of")) & (F.col("role") == F.col("by")) & (F.col("digest") == F.col("what"))
        & (F.col("fault") < 2), "left")
    again = F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    faults = {"blank": F.col("fault") == 2, "duplicate": again, "truncated": (F.col("fault") == 1) & ~again}
    symbol = _symbol(F.substring("role", 1, 1), F.when(again, 2).otherwise(F.col("fault")))
    segments = stage(
        marked.withColumn("symbol", symbol)
        .groupBy("conv_id", F.shiftright("at", segment_bits).alias("seg")).agg(
            F.array_sort(F.collect_list(F.struct("at", "symbol"))).alias("found"),
            F.min_by(F.struct("turn", "role", "digest"), "at").alias("head"),
            *[F.count_if(c).alias(name) for name, c in faults.items()])
        .select("conv_id", "seg", "head.*", F.array_join("found.symbol", "").alias("symbols"), *faults), "repair-segments")

    measured = stage(segments.select("conv_id", "seg", "symbols").mapInArrow(
        _measure, "conv_id long, seg long, costs array<long>, ends string"), "repair-costs")
    several = measured.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("conv_id").alias("of"))
    several = stage(several, "repair-several")
    parts = measured.join(several, _same(F.col("conv_id"), F.col("of")), "left_semi").groupBy("conv_id")
    behind = stage(
        parts.agg(F.array_sort(F.collect_list(F.struct("seg", "costs", "ends"))).alias("parts")).mapInArrow(
            _look_back, "conv_id long, seg long, after array<long>, last boolean, joint long")
        .withColumnsRenamed({"conv_id": "of", "seg": "no"}), "repair-behind")
    here = _same(F.col("conv_id"), F.col("of")) & (F.col("seg") == F.col("no"))
    planned = stage(
        segments.join(behind, here, "left").select("conv_id", "seg", "symbols", "after", "last", "joint").mapInArrow(
            _plan, "conv_id long, seg long, plans array<string>, costs array<long>, exits array<int>, illegal long"),
        "repair-planned")
    parts = planned.join(several, _same(F.col("conv_id"), F.col("of")), "left_semi").groupBy("conv_id")
    starts = stage(
        parts.agg(F.array_sort(F.collect_list(F.struct("seg", "exits"))).alias("parts")).mapInArrow(
            _look_ahead, "conv_id long, seg long, start int")
        .withColumnsRenamed({"conv_id": "of", "seg": "no"}), "repair-starts")
    start = F.coalesce(F.col("start"), F.lit(0))
    chosen = planned.join(starts, here, "left").select(
        F.col("conv_id").alias("of"), F.col("seg").alias("no"), F.get("plans", start).alias("plan"),
        F.get("costs", start).alias("cost"), "illegal")
    return segments.join(chosen, here).select(
        "conv_id", "seg", "turn", "role", "digest", "plan", "cost", *faults, "illegal")


EDITS = "conv_id long, place long, edit string, turn long, role string, text string"


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits in order, from plans and rows in order; a plan comes ahead of its first row."""
    kind = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
                      ("role", pa.string()), ("text", pa.string())])
    conv, plan, at, tail, place = None, "", 0, 0, 0
    for batch in batches:
        rows = []

        def put(edit, turn=None, role=None, text=""):
            nonlocal place
            rows.append({"conv_id": conv, "place": place, "edit": edit.translate(AUDIT), "turn": turn,
                         "role": ROLES.get(edit.lower(), role), "text": text})
            place += 1

        def inserts():
            nonlocal at
            while at < len(plan) and plan[at] in ROLES:
                put(plan[at])
                at += 1

        for row in batch.to_pylist():
            if row["conv_id"] != conv:
                conv, plan, at, place = row["conv_id"], "", 0, 0
            if row["plan"] is not None:
                plan, at = plan[at:] + row["plan"], 0
                tail = len(plan.rstrip("ua"))
                continue
            inserts()
            put(plan[at], row["turn"], row["role"], row["text"])
            at += 1
            if at == tail:
                inserts()
        yield _out(kind, rows)


def repair_conversations(rows: DataFrame, plans: DataFrame | None = None) -> DataFrame:
    """One row per edit: conv_id, place (from 0), edit (K, R, D or I), turn, role and text after it.

    ``rows`` has conv_id, turn, role and text (see ``conversation_rows``). Rows are taken by turn, nulls first, rows of
    one turn by role and MD5 of the text. Deleted rows are given with the role and text that they had; inserted rows have
    no turn and an empty text; the other rows are the repaired conversation. A null conv_id is a conversation like any
    other. An empty table gives an empty result.

    Texts are shuffled once, by conversation, and pass their task in order: nothing is kept but the rest of a plan. Each
    task gives its conversations one after the other, in order of place.
    """
    plans = repair_plans(rows) if plans is None else plans
    order = ("conv_id", "turn", "role", "digest", "kind", "seg")
    heads = plans.select("conv_id", "turn", "role", "digest", F.lit(0).alias("kind"), "seg", "plan",
                         F.lit(None).cast("string").alias("text"))
    texts = rows.select("conv_id", "turn", "role", F.md5("text").alias("digest"), F.lit(1).alias("kind"),
                        F.lit(None).cast("long").alias("seg"), F.lit(None).cast("string").alias("plan"), "text")
    return heads.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_apply, EDITS)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    conv, audit, digest, empty = None, None, None, True

    def done():
        return {"conv_id": conv, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if row["place"] == 0:
                if audit:
                    rows.append(done())
                conv, audit, digest, empty = row["conv_id"], [], hashlib.sha256(), True
            audit.append(row["edit"])
            if row["edit"] != "D":
                digest.update(f"{'' if empty else chr(10)}{row['role']}:{row['text']}".encode())
                empty = False
        yield _out(kind, rows)
    if audit:
        yield _out(kind, [done()])


def repair_digests(edits: DataFrame) -> DataFrame:
    """conv_id, audit and repaired_sha256 of what ``repair_conversations`` gives, as its tasks give it.

    A digest needs a conversation's lines one after the other, so they pass one task, which keeps none of them.
    """
    return edits.mapInArrow(_digest, "conv_id long, audit string, repaired_sha256 string")


def repair_report(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``: what was found in ``rows``, the cost, the audit and the digest.

    ``gaps`` counts the turns that are missing between the first and the last. A conversation without rows has zeros, an
    empty audit and the digest of the empty string.
    """
    plans = stage(repair_plans(rows), "repair-plans")
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    found = plans.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in counts])
    gaps = rows.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    digests = repair_digests(repair_conversations(rows, plans))
    out = conversations.select(column("conv_id").cast("long").alias("conv_id")).distinct()
    for part, name in ((found, "of"), (gaps, "with"), (digests, "on")):
        out = out.join(part.withColumnRenamed("conv_id", name), _same(F.col("conv_id"), F.col(name)), "left").drop(name)
    zero = {c: F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *counts)}
    return out.select(
        "conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
