"""Quality rules: figures of a text, and lines that many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import BLANK_CHARS, BLANKS, column, stage

# Limits and classes the base rules are stated with.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# A line is common when more than this many documents of one host have it.
MAX_DOCS = 10
# A document is depleted when its words outside common lines are fewer than either bound.
MIN_LEFT_WORDS = 50
MIN_LEFT_PERCENT = 50


def trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(BLANK_CHARS))


def words_of(text: Column) -> Column:
    bare = trimmed(text)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANKS))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often a lambda reads it."""
    return F.transform(F.array(value), use)[0]


def repeat_words(words: Column) -> Column:
    """How many words lie in a window of three words that the text has at least twice.

    Windows are hashed and sorted with their start; equal neighbours are repeats; each start then adds the words
    that the start before it did not cover.
    """
    def covered(w: Column) -> Column:
        windows = F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
        return bound(F.sort_array(windows), starts)

    def starts(s: Column) -> Column:
        repeated = F.filter(s, lambda x, j: F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False))
                            | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False)))
        return F.aggregate(
            F.sort_array(F.transform(repeated, lambda x: x["i"])),
            F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total")),
            lambda a, i: F.struct(i.alias("last"), (a["total"] + F.least(F.lit(3), i - a["last"])).alias("total")),
            lambda a: a["total"])

    return bound(words, covered)


def line_key(line: Column) -> Column:
    """Hash of a line without regard to case, digits and blanks around or between words."""
    return F.xxhash64(F.regexp_replace(F.regexp_replace(F.lower(trimmed(line)), BLANKS, " "), "[0-9]+", "0"))


def lines_left(text: Column, removed: Column) -> Column:
    """The text without the lines at these places, counted from 0."""
    return bound(F.split(text, "\n"), lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x) - 1), removed), lambda i: F.get(x, i)), "\n"))


def base_figures(text: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n"), lambda x: trimmed(x) != "")
    return {
        "word_chars": F.length(F.translate(text, BLANK_CHARS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": bound(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
    }


def line_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = MAX_DOCS,
    min_left_words: int = MIN_LEFT_WORDS,
    min_left_percent: int = MIN_LEFT_PERCENT,
    with_text: bool = False,
) -> DataFrame:
    """One row per input row: the base figures, base_failed, n_common_lines, n_words_left, kept.

    Lines are compared by ``line_key`` within a host. One that more than ``max_docs`` documents of its host have, by
    their ids, is common and counts as removed; a row without an id is a document of its own.
    A document whose words outside common lines are fewer than ``min_left_words``, or than ``min_left_percent`` of
    its words, is depleted. ``kept`` is false for documents that fail the base rules or are depleted. ``with_text``
    adds ``text_left``, the text without its common lines, whether kept or not; the texts are then written on the way.

    Null text has no words and fails the base rules; a null host is a host of its own. Repeated rows are judged
    alike, each in a row of its own; an empty table gives an empty result; other columns are not read.
    """
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        column(id_col).cast("long").alias("doc_id"),
        column(host_col).cast("string").alias("host"),
        text.alias("text"))
    per_line = F.transform(
        F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("no"))),
                 lambda x: trimmed(x["x"]) != ""),
        lambda x: F.struct(line_key(x["x"]).alias("line"), F.size(words_of(x["x"])).alias("words"), x["no"]))
    judged = stage(rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id", "host", *(["text"] if with_text else []),
        *[c.alias(n) for n, c in base_figures(F.col("text")).items()],
        bound(words_of(F.col("text")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words"))).alias("of_words"),
        per_line.alias("lines"),
    ).select("*", "of_words.*").drop("of_words"), "line-rules")

    lines = judged.select("row", "doc_id", "host", F.explode("lines").alias("l")).select("row", "doc_id", "host", "l.*")
    nameless = F.when(F.col("doc_id").isNull(), F.col("row"))
    docs_with = lines.groupBy("host", "line", "doc_id", nameless.alias("nameless")).agg(F.lit(1).alias("one"))
    common = docs_with.groupBy("host", "line").agg(F.count("*").alias("n_docs")).filter(
        F.col("n_docs") > max_docs).select(F.col("host").alias("c_host"), F.col("line").alias("c_line"))
    common = stage(common, "common-lines")
    removed = lines.join(
        common, F.col("host").eqNullSafe(F.col("c_host")) & (F.col("line") == F.col("c_line"))
    ).groupBy("row").agg(F.count("*").alias("n_common_lines"), F.sum("words").alias("words_removed"),
                         *([F.collect_list("no").alias("removed")] if with_text else []))

    n_words, left = F.col("n_words"), F.col("n_words_left")
    base_failed = (n_words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n_words)
    depleted = (F.col("n_common_lines") > 0) & (
        (left < min_left_words) | (100 * left < min_left_percent * n_words))
    text_left = [F.when(F.col("removed").isNull(), F.col("text")).otherwise(
        lines_left(F.col("text"), F.col("removed"))).alias("text_left")] if with_text else []
    return judged.drop("lines", "host").join(removed, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.coalesce("n_common_lines", F.lit(0)).cast("long").alias("n_common_lines"),
        (n_words - F.coalesce("words_removed", F.lit(0))).alias("n_words_left"),
        *text_left,
    ).select("*", base_failed.alias("base_failed"), (~base_failed & ~depleted).alias("kept")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_common_lines", "n_words_left",
        "base_failed", "kept", *(["text_left"] if with_text else []))
