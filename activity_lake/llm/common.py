"""What the operators share: input columns, word rules, stages."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_lake.sources.tables import write_stage

# Fixed value: the blanks that separate words, as Java, Python and DuckDB write the class.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Whole texts that cross to Python at a time.
BATCH_ROWS = 2_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def column(name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the columns an operator works on, so that no other column can clash; null text is empty."""
    return docs.select(
        column(id_col).cast("long").alias("doc_id"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).alias("text"),
    )


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write and reread in the shared folder; survives lost executors and has a known size."""
    return write_stage(df, name=name)


def small_batches(spark: SparkSession) -> None:
    """Let no more than ``BATCH_ROWS`` rows cross to Python at a time: a batch is held by the JVM and by the worker."""
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))


def give_back() -> None:
    """Hands memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, a task of ``mapInArrow``, that gives its memory back when it ends: workers live on, idle, beside others."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its names."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_rows(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is in the one column of ``ids``, with exactly the columns of ``docs``."""
    name = fresh(docs, "wanted_id")
    return docs.join(ids.toDF(name), column(id_col).cast("long").eqNullSafe(column(name)), "left_semi")


def bins_of(df: DataFrame, rows_per_bin: int) -> int:
    """Number of bins so that one holds about ``rows_per_bin`` rows; grows with the input."""
    return max(1, -(-df.count() // rows_per_bin))
