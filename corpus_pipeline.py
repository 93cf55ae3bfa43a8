"""The corpus pipeline: stages from documents to packed sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_lake.llm.common import ARROW_ROWS, documents, keep_rows, small_batches, stage
from activity_lake.llm.exact import drop_copies
from activity_lake.llm.near_copies import near_copy_groups
from activity_lake.llm.packing import pack_documents
from activity_lake.llm.substrings import substring_dedup
from activity_lake.llm.toxicity import drop_toxic, train_toxicity

# Chunks of text that a worker remembers while encoding: executors are fuller here than in a query of its own.
CHUNKS_KEPT = 300_000
# Rounding a linear program and training a classifier have no SQL; the tests compare with plain versions.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on what is there and the labels, does not call toxic."""
    small_batches(spark)
    return drop_toxic(docs, train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of texts with 80 % of their five-word shingles in common.

    SimHash fingerprints link most of them; an exact search by prefixes finds the others. Rows that repeat its id stay
    with it.
    """
    small_batches(spark)
    groups = near_copy_groups(docs)
    return keep_rows(docs, groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct())


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that start earlier in the corpus; those with no word left go.

    A text that loses nothing stays as it is. ``n_chars`` follows the text.
    """
    small_batches(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    left = substring_dedup(docs, carry=others, keep_layout=True).filter(
        (F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    changed = F.col("n_removed") > 0
    carried = {c: F.col("carried")[c] for c in others}
    if "n_chars" in carried:
        carried["n_chars"] = F.when(changed, F.length("kept_text")).otherwise(carried["n_chars"])
    values = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), **carried}
    return left.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in docs.schema])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    small_batches(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, kept=CHUNKS_KEPT)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("substring_dedup", without_repeats),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), spark.conf.get(ARROW_ROWS)
    try:
        for name, apply in STAGES:
            docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    finally:
        spark.conf.set(ARROW_ROWS, before)
    return docs
