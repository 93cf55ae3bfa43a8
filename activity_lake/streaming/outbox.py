"""Notifications as an outbox table; sending them is left to a consumer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from activity_lake import schemas
from activity_lake.functions.privacy import decrypted
from activity_lake.functions.text import clean_comment, clean_markup
from activity_lake.operators.cdc import cdc_events, cdc_rows, first_deliveries
from activity_lake.streaming.gold import foreach_batch

# Notification targets.
SLACK, LOG, NONE = "SLACK", "LOG", "NONE"
# Fixed value: heading of a logged alert, between the status and the status again.
ALERT_HEADING = " **ALERT MESSAGE : Abnormal termination of flow : "


def clean_comments(df: DataFrame, key: str) -> DataFrame:
    """Readable comments, as ``id, text``; empty ones are dropped.

    Dropping inside the list that is exploded decrypts each comment once.
    """
    text = F.array(clean_comment(decrypted("comment", key)))
    return df.select("id", F.explode(F.filter(text, lambda t: F.length(t) > 0)).alias("text"))


def notifications(raw: DataFrame, key: str, target: str, within: str | None = None) -> DataFrame:
    """One message per change event with a comment, as ``id, target, text``.

    ``within`` gives no second message for an event that a stream delivers again
    within that event time.
    """
    if within:
        rows = first_deliveries(cdc_events(raw, schemas.COMMENT_EVENT), within)
    else:
        rows = cdc_rows(raw, schemas.COMMENT_EVENT)
    messages = clean_comments(rows, key)
    return messages.select("id", F.lit(target).alias("target"), "text")


def start_outbox(
    raw: DataFrame, key: str, target: str, path: str, checkpoint: str, once: bool = False, within: str | None = None
) -> StreamingQuery:
    """Write each micro-batch to its own folder of the outbox.

    A repeated batch replaces its folder, so a message is never listed twice.
    Outbox and checkpoint belong together, as batches are numbered by the
    checkpoint: a new checkpoint needs a new path, or it replaces old messages.
    Target ``NONE`` writes nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if target != NONE:
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return foreach_batch(notifications(raw, key, target, within), write, checkpoint, once)


def route(outbox: DataFrame) -> DataFrame:
    """What to do with each message: send it, log it, or neither."""
    branch = F.when(F.col("target") == SLACK, "send").when(F.col("target") == LOG, "log")
    return outbox.withColumn("route", branch.otherwise("ignore"))


def alert_messages(alerts: DataFrame, test: bool = True) -> DataFrame:
    """Alerts with a route and a text.

    A test is logged under a heading; otherwise the message itself is sent,
    without markup.
    """
    if test:
        heading = F.concat(F.col("status"), F.lit(ALERT_HEADING), F.col("status"), F.lit("**"))
        text = F.concat_ws("\n&nbsp;\n", heading, "message")
    else:
        text = clean_markup("message")
    return alerts.withColumns({"route": F.lit("log" if test else "send"), "text": text})
