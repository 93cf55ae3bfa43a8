"""Spelling variants: words one edit apart, found among the sorted rotations of marked words.

A word is closed with a terminator and rotated. The rotation that ends in an edited character starts with all the rest
of the word, so words that differ in that character share its prefix, and a word without the character has that prefix
as a whole rotation. A range of equal prefixes holds one word per character at most: it is as small as the alphabet,
however many words or copies there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import id_and_text, stage

# The letters of words, and those that are made lower case.
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "$"
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
DAMAGE = 199


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    damage: int | None = None,
) -> DataFrame:
    """word, n: the runs of letters of all texts with A-Z in lower case, long and frequent enough.

    ``damage`` takes a character from the words whose crc32 with the id it divides, to plant misspellings: the one at
    the crc32 modulo the length. Null text has no words, a null id counts as empty there. Counts combine per task.
    """
    runs = id_and_text(docs, id_col, text_col).select(
        "doc_id", F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(LETTERS), F.lit(0))).alias("word"))
    if damage is None:
        words = runs.filter(F.length("word") >= min_length)
    else:
        key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        words = runs.filter(F.length("word") >= min_length).withColumn("h", F.crc32(key.cast("binary"))).select(
            F.when(F.col("h") % damage == 0, cut).otherwise(F.col("word")).alias("word")
        ).filter(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """prefix, skipped, again, word, n: every rotation of every word as it is and without its last character.

    ``skipped`` is the character left out, empty for whole rotations. ``again`` says that the same character stands
    before it: taking either from the word gives the same rest, so only the first of a run counts as taken out.
    """
    at = F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at")
    placed = words.select("word", "n", at)
    head, tail = F.substring("word", F.lit(1), F.col("at")), F.expr("substring(word, at + 1)")
    char, rest = F.expr("substring(word, at + 1, 1)"), F.expr("substring(word, at + 2)")
    whole = F.struct(F.concat(tail, F.lit(END), head).alias("prefix"), F.lit("").alias("skipped"), F.lit(False).alias("again"))
    without = F.struct(
        F.concat(rest, F.lit(END), head).alias("prefix"), char.alias("skipped"),
        ((F.col("at") > 0) & (F.expr("substring(word, at, 1)") == char)).alias("again"))
    both = F.when(F.col("at") < F.length("word"), F.array(whole, without)).otherwise(F.array(whole))
    return placed.select(F.inline(both), "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near, best: how many words are one edit away, and the most frequent of them as (n, word).

    Each range of equal prefixes is sorted, most frequent first. A member gets the number of the others and the first of
    them, so what a range gives grows with its members and not with their pairs. No pair is found in two ranges: a
    replaced character has one place, and of a run of characters only the first counts as the one taken out or put in.
    """
    member = F.struct((-F.col("n")).alias("less"), "word", "skipped", "again")
    ranges = rotations(words).groupBy("prefix").agg(F.array_sort(F.collect_list(member)).alias("found")).filter(
        F.size("found") > 1)
    others = F.expr("""transform(found, m -> struct(m.word as word, filter(found, o -> o.word <> m.word and
        (o.skipped <> '' or not m.again) and (m.skipped <> '' or not o.again)) as others))""")
    near = ranges.select(F.inline(others)).filter(F.size("others") > 0)
    first = F.element_at("others", 1)
    return near.groupBy("word").agg(
        F.sum(F.size("others")).alias("n_near"),
        F.min(F.struct(first["less"].alias("less"), first["word"].alias("word"))).alias("best")
    ).select("word", "n_near", F.struct((-F.col("best.less")).alias("n"), F.col("best.word").alias("word")).alias("best"))


def last_of_chains(forms: DataFrame) -> DataFrame:
    """word, root: where following ``forms`` (word, form) ends. Every round doubles the steps, in written tables."""
    reached, left = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots"), None
    while True:
        step = reached.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = reached.join(step, F.col("root") == F.col("at"), "left")
        if moved.filter(F.col("next").isNotNull()).isEmpty():
            return reached
        reached = stage(moved.select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    ``form`` is the most frequent word one edit away (inserted, deleted or replaced code point), ties by code point order,
    if it is ``ratio`` times as frequent or more; ``root`` is where following forms ends. As forms grow by that factor, a
    chain is as short as the logarithm of the largest count. An empty table gives an empty result.
    """
    words = stage(words, "spelling-words")
    near = neighbours(words).withColumnRenamed("word", "of")
    chosen = F.when(F.col("best.n") >= ratio * F.col("n"), F.col("best"))
    formed = stage(
        words.join(near, F.col("word") == F.col("of"), "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), chosen["word"].alias("form"),
            chosen["n"].alias("form_n")), "spelling-forms")
    roots = last_of_chains(formed.filter(F.col("form").isNotNull())).withColumnRenamed("word", "of")
    return formed.join(roots, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
