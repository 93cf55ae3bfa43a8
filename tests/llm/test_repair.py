import hashlib
import random
import zlib
from functools import cache

import pytest

from activity_lake.llm import repair
from activity_lake.llm.queries import QUERIES
from tests.llm.helpers import CLASHING, LONG

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def ordered(rows):
    """Rows of each conversation as the operator takes them."""
    groups = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        groups.setdefault(conv, []).append((turn, role, text))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest())
    return {conv: sorted(found, key=key) for conv, found in groups.items()}


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        found.append("blank" if not bare else "duplicate" if (role, text) in seen
                     else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows, found):
    """(cost, audit) by trying every edit at every row."""
    grammar = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @cache
    def best(i, state, inserted):
        options = [(0, "")] if i == len(rows) and state in ("", "a") else []
        if inserted < 2:
            options += [(3 + c, "I" + a) for s in "ua" if s in grammar[state]
                        for c, a in [best(i, grammar[state][s], inserted + 1)]]
        if i < len(rows):
            c, a = best(i + 1, state, 0)
            options.append((4 + c, "D" + a))
            if found[i] not in ("blank", "duplicate"):
                more = 3 * (found[i] == "truncated")
                for s, edit, cost in [(rows[i][1][:1], "K", 0), ("u", "R", 3), ("a", "R", 3)]:
                    if s in grammar[state]:
                        c, a = best(i + 1, grammar[state][s], 0)
                        options.append((cost + more + c, edit + a))
        return min(options, default=(10 ** 9, ""))

    return best(0, "", 0)


def plain(rows):
    """(blank, duplicate, truncated, illegal, cost, audit, digest) of a conversation."""
    found = faults(rows)
    cost, audit = cheapest(tuple(rows), tuple(found))
    size, lines, i = sum(e != "D" for e in audit), [], 0
    for edit in audit:
        place = len(lines) - size % 2
        if edit in "RI":
            role = "user" if place % 2 == 0 else "assistant"
        if edit != "D":
            lines.append(f"{rows[i][1] if edit == 'K' else role}:{'' if edit == 'I' else rows[i][2]}")
        i += edit != "I"
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (*[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)


def gaps(rows):
    turns = [t for t, _, _ in rows if t is not None]
    return max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0


def report(spark, rows, extra=True):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.selectExpr("*", *[f"{v} as `{k}`" for k, v in CLASHING.items() if k not in ("turn", "role", "text")])
    return {r["conv_id"]: tuple(r)[1:] for r in repair.repair_report(repair.conversation_rows(df), df).collect()}


def expected(rows):
    return {conv: (gaps(found), *plain(found)) for conv, found in ordered(rows).items()}


def made(n, seed):
    """Conversations with every kind of fault, ties, nulls and odd roles."""
    draw = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(draw.randrange(9)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = draw.choice(["one.", "two!", "three?", "cut", "cut off ", "", " \n", None, f"own {turn}."])
            rows += [(conv, draw.choice([turn, turn, turn + 3, None]), role, text)] * draw.choice([1, 1, 1, 1, 2])
    return rows


def test_reports_equal_plain_search(spark):
    rows = made(120, 1)
    assert report(spark, rows) == expected(rows)


@pytest.mark.parametrize("bits", [0, 2])
def test_segments_change_nothing(spark, monkeypatch, bits):
    plans = repair.repair_plans
    monkeypatch.setattr(repair, "repair_plans", lambda rows: plans(rows, segment_bits=bits))
    rows = made(40, 2) + [(7, t, "user", f"{t}.") for t in range(40)]
    assert report(spark, rows) == expected(rows)


def test_long_runs_and_texts(spark):
    rows = [(1, t, "user", f"{t}") for t in range(150)] + [(1, 150 + t, "assistant", "same.") for t in range(150)]
    rows += [(2, 0, "user", LONG), (2, 1, "assistant", LONG + ".")]
    assert report(spark, rows) == expected(rows)


def test_runs_by_powers_equal_single_rows():
    draw = random.Random(3)
    for _ in range(60):
        symbols = "".join(draw.choice("suaoSUAO1234") * draw.randrange(1, 40) for _ in range(draw.randrange(1, 6)))
        after = tuple(draw.choice([0, 3, 4, 7]) for _ in range(4))
        after = tuple(min(c for c in (after[s], *(after[t] + k for k, t in repair._inserted(s)))) for s in range(4))
        one = None
        for symbol in symbols:
            step = repair._power(symbol, 0)
            one = step if one is None else repair._times(one, step)
        assert repair.transition(symbols) == one
        state_costs = repair._before(one, after)
        for start, (plan, cost, end) in enumerate(repair.unroll(symbols, after, False)):
            assert cost + after[end] == state_costs[start]
            assert sum(e not in "ua" for e in plan) == len(symbols)


def test_edits_are_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Yes."), (1, 2, "assistant", " "), (1, 2, "user", "Why")]
    df = spark.createDataFrame(rows, SCHEMA)
    edits = repair.repair_conversations(repair.conversation_rows(df)).orderBy("place").collect()
    assert [tuple(r)[1:] for r in edits] == [
        (0, "K", 0, "system", "Be kind."), (1, "I", None, "user", ""), (2, "K", 1, "assistant", "Yes."),
        (3, "D", 2, "assistant", " "), (4, "D", 2, "user", "Why")]


def test_conversations_without_rows_are_reported(spark):
    df = spark.createDataFrame([(1, 0, "user", "a."), (None, None, None, None)], SCHEMA)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair_report(
        repair.conversation_rows(df).filter("false"), df).collect()}
    zeros = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {1: zeros, None: zeros}


def test_empty_table(spark):
    assert report(spark, []) == {}


def test_damage(spark):
    rows = [(c, t, None if t == 5 else "assistant", None if t == 6 else f"Is {c}? {t}. Yes!") for c in range(60) for t in range(8)]
    rows += [(None, None, "user", "x"), (5, None, "user", "y")]
    want = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else text.translate({ord(c): None for c in ".!?"}) if fate == 2 else text
        want += [(conv, turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    got = [tuple(r) for r in repair.damage(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query_equals_plain_search(spark, sf_dir):
    rows = [tuple(r) for r in repair.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")).collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op11_repair"](spark, sf_dir).collect()}
    want = expected(rows)
    assert {c: got[c] for c in want} == want
