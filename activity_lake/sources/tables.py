"""Sheets, stage files, tables and token logs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_lake import schemas
from activity_lake.session import new_path

# Stages of the jobs that run, innermost last.
_owned: list[list[str]] = []


def typed_scan(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    max_rows: int | None = None,
    multi_line: bool = False,
    reject_column: str | None = None,
) -> DataFrame:
    """Sheet exported as CSV; the schema names and types columns by position.

    Cells with line breaks need ``multi_line``: many tasks read a file then as
    well, and its records are cut by the parity of quotes. ``reject_column`` adds a column that holds the line of a row that
    does not fit the schema and is null for the others. A line break in a cell
    shows there by the second half of its row: the sheet then needs
    ``multi_line``. ``max_rows`` caps a trial run and is off by default.
    """
    if reject_column:
        schema = T.StructType([*schema.fields, T.StructField(reject_column, T.StringType())])
    if multi_line:
        from activity_lake.sources.records import parsed_records, quoted_records

        sheet = parsed_records(quoted_records(spark, path), schema, header, reject_column)
    else:
        reader = spark.read.option("header", header).option("enforceSchema", True).option("escape", '"')
        if reject_column:
            reader = reader.option("columnNameOfCorruptRecord", reject_column)
        sheet = reader.schema(schema).csv(path)
    return sheet if max_rows is None else sheet.limit(max_rows)


def write_stage(df: DataFrame, path: str | None = None, name: str = "stage") -> DataFrame:
    """Write a stage table and return it read back, which cuts the lineage."""
    spark = df.sparkSession
    if path is None:
        path = new_path(spark, name)
        if _owned:
            _owned[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_missing(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


@contextmanager
def job_stages(spark: SparkSession) -> Iterator[None]:
    """Own the stages written inside and remove them at the end.

    Nothing that is read after the job may still depend on them.
    """
    _owned.append([])
    try:
        yield
    finally:
        for path in _owned.pop():
            remove_path(spark, path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A table, empty if nothing was written there yet."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def table_scan(
    spark: SparkSession,
    source: str | dict[str, Any],
    columns: list[str] | dict[str, str] | None = None,
) -> DataFrame:
    """Stored table, whole or projected.

    ``source`` is a Parquet path or the options of a JDBC table; for a large
    JDBC table give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` so that executors read it in parallel. ``columns`` may
    map names to new names. The projection reaches the scan.
    """
    if isinstance(source, dict):
        table = spark.read.format("jdbc").options(**source).load()
    else:
        table = spark.read.parquet(source)
    if columns is None:
        return table
    if isinstance(columns, dict):
        return table.select(*[F.col(old).alias(new) for old, new in columns.items()])
    return table.select(*columns)


def table_append(df: DataFrame, target: str | dict[str, Any]) -> None:
    """Append a batch in one write job: a Parquet path or JDBC options.

    A JDBC append commits per partition: a failed job may leave a part behind.
    Append to a staging table there and move its rows in one transaction.
    """
    if isinstance(target, dict):
        df.write.format("jdbc").options(**target).mode("append").save()
    else:
        df.write.mode("append").parquet(target)


def is_empty(df: DataFrame) -> bool:
    """Whether a table has no row; the first load runs only then."""
    return df.isEmpty()


def rows(spark: SparkSession, data: list[tuple], schema: T.StructType | str) -> DataFrame:
    """Literal rows as a table."""
    return spark.createDataFrame(data, schema)


def append_token_records(df: DataFrame, path: str) -> None:
    """Append one JSON line per model call, with its total."""
    df.withColumn("total_tokens", token_total()).write.mode("append").json(path)


def token_total():
    """Query, context and model tokens together."""
    return F.col("query_tokens") + F.col("context_tokens") + F.col("llm_tokens")


def token_log(spark: SparkSession, path: str) -> DataFrame:
    """Token records; blank lines are skipped.

    A record without a session takes it from a file named
    ``tokens_<session>.jsonl``.
    """
    named = F.nullif(
        F.regexp_extract("_metadata.file_name", r"^tokens_(.+)\.jsonl$", 1), F.lit(""))
    log = spark.read.schema(schemas.TOKEN_RECORD).json(path)
    return log.withColumn("session_id", F.coalesce("session_id", named)).filter(
        F.col("operation").isNotNull())
