"""Exact dedup by progressive refinement: length, then prefix hash, then the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_lake.llm.common import BLANKS, column, fresh, id_and_text, keep_rows, stage

PREFIX_CHARS = 64


def normal_text(text: Column) -> Column:
    """Text with each run of blanks as one space."""
    return F.regexp_replace(text, BLANKS, " ")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    digest_all: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after ``normal_text``. Rows that are alone with their length, or with
    length and hashed prefix, are settled from those two numbers. Only the texts of the others are read and hashed
    whole; ``digest_all`` hashes the settled ones as well, else their ``text_sha256`` is null.

    Null text is empty. Of equal texts the smallest doc_id stays, nulls last: a null id stays only in a group that has
    no other. Of rows that repeat both id and text one stays. An empty table gives an empty result. Other columns are
    not read. Every grouping counts per task before it shuffles; hot groups only appear as the many side of a join
    whose other side has one row per key.
    """
    rows = id_and_text(docs, id_col, text_col).select("doc_id", normal_text(F.col("text")).alias("norm"))
    keys = stage(rows.select(
        "doc_id",
        F.octet_length("norm").alias("size"),
        F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("head"),
    ), "exact-keys")
    sizes = stage(keys.groupBy("size").agg(F.count("*").alias("n")).filter("n > 1").select("size"), "exact-sizes")
    by_size = keys.join(sizes, "size", "left_semi")
    heads = stage(by_size.groupBy("size", "head").agg(F.count("*").alias("n")).filter("n > 1").select("size", "head"), "exact-heads")
    open_ids = stage(
        by_size.join(heads, ["size", "head"], "left_semi").select("doc_id").distinct(), "exact-open")

    digest = F.sha2("norm", 256).alias("text_sha256")
    hashed = stage(
        keep_rows(rows, open_ids).select("doc_id", digest)
        .groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n_rows")), "exact-hashed")
    groups = stage(hashed.groupBy("text_sha256").agg(
        F.min("doc_id").alias("keep_id"), F.sum("n_rows").alias("group_size")), "exact-groups")
    grouped = hashed.join(groups, "text_sha256").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
    grouped = grouped.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")

    settled = rows.select("doc_id", digest) if digest_all else keys.select(
        "doc_id", F.lit(None).cast("string").alias("text_sha256"))
    taken = open_ids.toDF("open_id")
    settled = settled.join(taken, F.col("doc_id").eqNullSafe(F.col("open_id")), "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    return settled.unionByName(grouped)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, with all their columns, that ``exact_dedup`` keeps.

    Where ids are unique they name the rows. Otherwise a row is named by its id and its digest, and of rows that repeat
    both one stays.
    """
    n, ids = docs.agg(F.count("*"), F.count_distinct(column(id_col))).first()
    repeated = n != ids
    kept = exact_dedup(docs, id_col, text_col, digest_all=repeated).filter("kept")
    if not repeated:
        return keep_rows(docs, kept.select("doc_id"), id_col)
    number, digest = fresh(docs, "number"), fresh(docs, "digest")
    kept_number, kept_digest = fresh(docs, "kept_number"), fresh(docs, "kept_digest")
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    marked = docs.withColumn(digest, F.sha2(normal_text(text), 256)).withColumn(number, column(id_col).cast("long"))
    return marked.join(
        kept.select(F.col("doc_id").alias(kept_number), F.col("text_sha256").alias(kept_digest)),
        column(number).eqNullSafe(column(kept_number)) & (column(digest) == column(kept_digest)), "left_semi",
    ).dropDuplicates([number, digest]).drop(number, digest)
