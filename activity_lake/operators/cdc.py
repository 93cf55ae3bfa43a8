"""Change envelopes and the state they describe."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_lake.schemas import envelope

# One transaction gives its changes the same time; their places in the log differ.
EVENT_ORDER = ("ts_ms", "lsn")


def cdc_parse(df: DataFrame, row: T.StructType, with_event: bool = True, old_image: bool = False) -> DataFrame:
    """Message bytes or text as a typed envelope ``data``; unreadable ones become null.

    Exploding a list of one keeps the parsed value in a column of its own:
    otherwise a later filter is pushed below it and parses every message again.
    """
    parsed = F.from_json(F.col("value").cast("string"), envelope(row, with_event, old_image))
    return df.select(F.explode(F.array(parsed)).alias("data"))


def cdc_flatten(parsed: DataFrame, with_event: bool = False) -> DataFrame:
    """The new row image as columns.

    ``with_event`` adds ``op``, ``ts_ms`` and ``lsn``, the place in the source's
    log, and takes the id of a deleted row from its old image.
    """
    if not with_event:
        return parsed.select("data.payload.after.*")
    after = parsed.schema["data"].dataType["payload"].dataType["after"].dataType
    names = [n for n in after.fieldNames() if n != "id"]
    return parsed.select(
        F.coalesce("data.payload.after.id", "data.payload.before.id").alias("id"),
        *[F.col(f"data.payload.after.{n}").alias(n) for n in names],
        F.col("data.payload.op").alias("op"),
        F.col("data.payload.ts_ms").alias("ts_ms"),
        F.col("data.payload.source.lsn").alias("lsn"),
    )


def cdc_upserts(flat: DataFrame) -> DataFrame:
    """Rows with an id: deletes, tombstones and unreadable messages vanish."""
    return flat.filter(F.col("id").isNotNull())


def cdc_rows(raw: DataFrame, row: T.StructType) -> DataFrame:
    """Messages to row images, for batch and stream alike."""
    return cdc_upserts(cdc_flatten(cdc_parse(raw, row, with_event=False)))


def cdc_events(raw: DataFrame, row: T.StructType) -> DataFrame:
    """Messages to events that keep deletes."""
    return cdc_upserts(cdc_flatten(cdc_parse(raw, row), with_event=True))


def first_deliveries(events: DataFrame, within: str) -> DataFrame:
    """Events of a stream without those that are delivered again, by id and place in the log.

    A source that delivers at least once may repeat what it sent. Keys are
    remembered for ``within`` of event time (``ts_ms``), which bounds the state; an
    event that comes again after that counts as new. Events without a time take
    that of their arrival.
    """
    time = F.coalesce(F.timestamp_millis("ts_ms"), F.current_timestamp())
    return events.withColumn("_event_time", time).withWatermark("_event_time", within).dropDuplicatesWithinWatermark(
        ["id", "lsn"]).drop("_event_time")


def cdc_images(raw: DataFrame, row: T.StructType) -> DataFrame:
    """Messages to ``id``, ``op``, ``ts_ms``, ``lsn`` and the whole rows ``before`` and ``after`` the change."""
    image = cdc_parse(raw, row, old_image=True).select(
        F.coalesce("data.payload.after.id", "data.payload.before.id").alias("id"), F.col("data.payload.op").alias("op"),
        F.col("data.payload.ts_ms").alias("ts_ms"), F.col("data.payload.source.lsn").alias("lsn"),
        F.col("data.payload.before").alias("before"), F.col("data.payload.after").alias("after"))
    return cdc_upserts(image)


def latest_state(log: DataFrame, key: str = "id", order: tuple[str, ...] | None = None) -> DataFrame:
    """Last row of each key, by time and then by place in the source's log.

    Filtering the row number to 1 lets Spark keep only the best row of each
    key per task before the shuffle, so a key with very many events does not
    gather in one task. Ties in ``order`` fall to a hash of the row, so that a
    recomputed task chooses the same one; changes with a place have none.
    """
    order = order or tuple(c for c in EVENT_ORDER if c in log.columns)
    last_first = Window.partitionBy(key).orderBy(
        *[F.col(c).desc_nulls_last() for c in order], F.xxhash64(*log.columns))
    return log.withColumn("_n", F.row_number().over(last_first)).filter("_n = 1").drop("_n")


def latest_state_with_deletes(
    events: DataFrame, key: str = "id", order: tuple[str, ...] | None = None, op: str = "op"
) -> DataFrame:
    """Last row of each key whose last event is not a delete."""
    alive = F.coalesce(F.col(op) != "d", F.lit(True))
    return latest_state(events, key, order).filter(alive)
