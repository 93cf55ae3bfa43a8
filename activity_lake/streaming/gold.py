"""Append-only gold tables fed by the change streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from activity_lake import schemas
from activity_lake.functions.business import BONUS_RATE, with_bonus
from activity_lake.functions.dates import activity_date, social_year
from activity_lake.functions.privacy import decrypt
from activity_lake.operators.cdc import cdc_rows
from activity_lake.operators.shaping import stamp
from activity_lake.sources.commits import BatchStore


def activities_gold(raw: DataFrame, first_month: int = 6) -> DataFrame:
    """Activities with their date and social year, one row per change event."""
    dated = cdc_rows(raw, schemas.ACTIVITY_EVENT).withColumn("activity_date", activity_date("begin_date"))
    dated = dated.withColumn("social_year", social_year("activity_date", first_month))
    dated = dated.withColumn("start_year", F.substring_index("social_year", "-", 1).cast("int"))
    return stamp(dated, "_event_timestamp")


def employees_gold(raw: DataFrame, key: str, rate: str | float = BONUS_RATE) -> DataFrame:
    """Employees with readable names and their bonus, one row per change event."""
    named = decrypt(cdc_rows(raw, schemas.EMPLOYEE_EVENT), ["first_name", "last_name"], key)
    return with_bonus(stamp(named), rate)


def enrich_stream(stream: DataFrame, static: DataFrame, on: str) -> DataFrame:
    """Left join of a stream with a table of one row per key."""
    return stream.join(static, on, "left")


def start_enriched(
    stream: DataFrame, dimension: Callable[[], DataFrame], on: str, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Left join of each micro-batch with the dimension as it is then, one row per key.

    ``dimension`` is asked for every batch: the newest version of a table in
    buckets, or the current state that another stream keeps. Batches are kept
    and marked as those of the upserted state, so a repeated one counts once.
    """
    store = BatchStore(stream.sparkSession, path)
    store.claim("enriched rows")

    def write(batch: DataFrame, batch_id: int) -> None:
        store.add(enrich_stream(batch, dimension(), on), batch_id)

    return foreach_batch(stream, write, checkpoint, once)


def enriched(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that ``start_enriched`` has finished so far."""
    return BatchStore(spark, path).read(schema)[0]


def start_gold(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    once: bool = False,
    every: str = "1 minute",
) -> StreamingQuery:
    """Append the stream to a table; ``once`` stops after what is there now.

    Each micro-batch adds files, so ``every`` keeps them from becoming very
    many and very small.

    The file sink commits each micro-batch in its log, so a repeated batch
    adds nothing. ``fmt`` may be ``delta`` where its jar is on the classpath.
    """
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start(path)


def foreach_batch(
    df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Run a function on every micro-batch."""
    writer = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
