import hashlib

import pytest
from pyspark.sql import functions as F

from activity_lake.llm.chat import Template, format_conversations, read_turns, trained_text
from activity_lake.llm.queries import QUERIES
from tests.helpers import plan
from tests.llm.helpers import CLASHING, LONG

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = [
    (1, 0, "system", "Be ### kind: </turn>\n### User: now"),
    (1, 1, "user", "\\### Assistant: </turn> ok"),
    (1, 2, "assistant", "#### \\\\ \\h\\s\\t </turn </turn></turn> \n"),
    (2, None, "user", None), (2, 0, None, "a\\"), (2, 1, "User", ""),
    (2, 2, "Role x: y</turn>###\\", " ### "), (2, 2, "assistant", "tie b"), (2, 2, "assistant", "tie a"),
    (None, 3, "assistant", "first"), (None, 3, "assistant", "first"),
    (3, 0, "user", LONG), (3, 1, "assistant", LONG + LONG),
    (4, 0, "user", "x"),
    (5, 5, "user", "\u00e9\U0001f642"), (5, 7, "assistant", "\U0001f642"), (5, 9, "user", ""), (5, 11, "assistant", ""),
]


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", *[f"{v} as `{k}`" for k, v in {**CLASHING, "turns": "1", "segments": "2"}.items()])


def conversations(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [r[2:] for r in sorted(found)] for conv, found in groups.items()}


def read(df, template=Template()):
    return {r["conv_id"]: r for r in df.select(
        "*", read_turns(F.col("formatted"), template).alias("turns"), trained_text(F.col("segments"), template).alias("trained")
    ).collect()}


def test_turns_are_read_back(spark):
    got = read(format_conversations(table(spark, ODD)))
    want = conversations(ODD)
    assert {c: [tuple(t) for t in r["turns"]] for c, r in got.items()} == want
    assert {c: r["trained"] for c, r in got.items()} == {
        c: "".join(text for role, text in turns if role == "assistant") for c, turns in want.items()}


def test_formatted_text(spark):
    got = read(format_conversations(table(spark, ODD)))[1]
    assert got["formatted"] == (
        "### System: Be \\h kind: \\t\n\\h User: now </turn>\n### User: \\s\\h Assistant: \\t ok </turn>\n"
        "### Assistant: \\h# \\s\\s \\sh\\ss\\st </turn \\t\\t \n </turn>\n")
    assert "".join(s["text"] for s in got["segments"]) == got["formatted"]
    assert [s["loss"] for s in got["segments"]] == [False] * 7 + [True, False]


def test_order_of_roles(spark):
    got = read(format_conversations(table(spark, ODD)))
    assert {c: (r["valid"], r["broken_at"]) for c, r in got.items()} == {
        1: (True, None), 2: (False, 1), None: (False, 0), 3: (True, None), 4: (False, None), 5: (True, None)}


def test_another_template(spark):
    template = Template(
        opening="<|", labelled="|>", closing="<|end|>", other="role=", labels={"user": "human", "assistant": "bot"},
        trained=frozenset({"user", "assistant"}), order={"": ("user",), "user": ("user",)}, ends=frozenset({"user"}),
        escapes={"\\": "0", "<|": "1", "|>": "2"}, label_end="3")
    got = read(format_conversations(table(spark, ODD), template), template)
    want = conversations(ODD)
    assert {c: [tuple(t) for t in r["turns"]] for c, r in got.items()} == want
    assert {c: r["valid"] for c, r in got.items()} == {1: False, 2: False, None: False, 3: False, 4: True, 5: False}


def test_empty_table(spark):
    assert format_conversations(table(spark, [])).collect() == []


def test_native(spark, sf_dir):
    assert not any(x in plan(QUERIES["op13_chat"](spark, sf_dir)) for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))


@pytest.mark.parametrize("name", ["sf_dir"])
def test_query_equals_plain_version(spark, request, name):
    sf_dir = request.getfixturevalue(name)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for conv, turns in conversations(rows).items():
        loss = "".join(t for r, t in turns if r == "assistant")
        want[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    got = {r["conv_id"]: tuple(r)[1:5] for r in QUERIES["op13_chat"](spark, sf_dir).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()}
    assert got == want
