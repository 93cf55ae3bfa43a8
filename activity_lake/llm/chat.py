"""Chat formatting by a declarative template: segments with loss flags, an order check, and reading back."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import column

# Where every conversation starts, and where one is that broke the order.
START, BROKEN = "", "\0"


@dataclass(frozen=True)
class Template:
    """How turns are marked, which count for the loss, and in which order roles may come.

    A turn is ``opening`` + its role's label + ``labelled`` + its text + ``closing``. Texts and unknown roles are escaped:
    each string of ``escapes`` becomes the escape character and its code, the escape character itself first, so that no
    control string is left in an escaped text. A role without a label is named, after ``other``, with the end of a label
    escaped as well.
    """

    opening: str = "### "
    labelled: str = ": "
    closing: str = " </turn>\n"
    other: str = "Role "
    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    trained: frozenset[str] = frozenset({"assistant"})
    order: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    ends: frozenset[str] = frozenset({START, "assistant"})
    escapes: dict[str, str] = field(default_factory=lambda: {"\\": "s", "###": "h", "</turn>": "t"})
    label_end: str = "c"

    def escape(self, text: Column) -> Column:
        """The escape character comes first in ``escapes``: from then on each one is followed by a code."""
        return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit("\\" + e[1])), self.escapes.items(), text)

    def unescape(self, text: Column) -> Column:
        """In the opposite order, as a string that was put back holds no escape character but the last."""
        return reduce(lambda c, e: F.replace(c, F.lit("\\" + e[1]), F.lit(e[0])), reversed(self.escapes.items()), text)

    def name(self, role: Column) -> Column:
        """The label of a role that the template does not know."""
        return F.concat(F.lit(self.other), F.replace(
            self.escape(role), F.lit(self.labelled), F.lit("\\" + self.label_end)))

    def named(self, label: Column) -> Column:
        role = F.substring(label, F.lit(len(self.other) + 1), F.length(label))
        return self.unescape(F.replace(role, F.lit("\\" + self.label_end), F.lit(self.labelled)))


def _turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    return df.select(
        column(conv_col).cast("long").alias("conv_id"), column(turn_col).cast("long").alias("turn"),
        F.coalesce(column(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"))


def turn_segments(role: Column, text: Column, template: Template) -> Column:
    """The segments of a turn: its mark, its escaped text, its end, each with the loss flag."""
    label = template.name(role)
    for known, name in template.labels.items():
        label = F.when(role == known, name).otherwise(label)

    def segment(content: Column, loss: Column) -> Column:
        return F.struct(content.alias("text"), loss.alias("loss"))

    return F.array(
        segment(F.concat(F.lit(template.opening), label, F.lit(template.labelled)), F.lit(False)),
        segment(template.escape(text), role.isin(*template.trained)),
        segment(F.lit(template.closing), F.lit(False)))


def _walk(turns: Column, template: Template) -> Column:
    """The machine over roles: the state after all turns, and the first turn that broke the order, else -1."""
    moves = F.create_map(*[
        F.lit(x) for state, roles in template.order.items() for role in roles for x in (f"{state}>{role}", role)])

    def step(at: Column, turn: Column) -> Column:
        to = F.coalesce(F.element_at(moves, F.concat(at["state"], F.lit(">"), turn["role"])), F.lit(BROKEN))
        broken = F.when((to == BROKEN) & (at["broken"] < 0), at["seen"]).otherwise(at["broken"])
        return F.struct(to.alias("state"), (at["seen"] + 1).alias("seen"), broken.alias("broken"))

    start = F.struct(F.lit(START).alias("state"), F.lit(0).alias("seen"), F.lit(-1).alias("broken"))
    return F.aggregate(turns, start, step)


def format_conversations(
    df: DataFrame, template: Template = Template(), conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, segments (text, loss), formatted, valid, broken_at.

    Turns are taken by their number, nulls first, those of one number by role and text. A null role or text is empty, a
    null conv_id is a conversation like any other, repeated rows are repeated turns. ``valid`` says that the template's
    machine accepts the roles; ``broken_at`` is the place (from 0) of the first turn that it does not. A broken order is
    formatted all the same. An empty table gives an empty result. Other columns are not read.

    A conversation becomes one value, so it has to fit into one; it is shuffled once and gathered by its id only.
    """
    turns = _turns(df, conv_col, turn_col, role_col, text_col).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: turn_segments(t["role"], t["text"], template)))
    return turns.select("conv_id", segments.alias("segments"), _walk(F.col("turns"), template).alias("walk")).select(
        "conv_id", "segments", F.array_join("segments.text", "").alias("formatted"),
        F.col("walk.state").isin(*template.ends).alias("valid"),
        F.when(F.col("walk.broken") >= 0, F.col("walk.broken")).alias("broken_at"))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns (role, text) that a formatted conversation was made of."""
    pieces = F.split(formatted, re.escape(template.closing))
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: _turn(p, template))


def _turn(piece: Column, template: Template) -> Column:
    marked = F.substring_index(piece, template.labelled, 1)
    text = F.substring(piece, F.length(marked) + len(template.labelled) + 1, F.length(piece))
    name = F.substring(marked, F.lit(len(template.opening) + 1), F.length(marked))
    role = template.named(name)
    for known, shown in template.labels.items():
        role = F.when(name == shown, known).otherwise(role)
    return F.struct(role.alias("role"), template.unescape(text).alias("text"))


def trained_text(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "")
