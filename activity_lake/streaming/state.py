"""Current state kept from a change stream.

Each micro-batch adds its last event per key to a change folder of its own, at
a cost that depends on the batch and not on the table. Readers take the last
event of each key; compacting bounds what they have to read. Folders count only
once they are marked complete (see ``sources.commits``), so readers and
compaction may run beside the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from activity_lake.operators.cdc import EVENT_ORDER, cdc_events, latest_state
from activity_lake.operators.diff import chosen_actions
from activity_lake.sources.commits import BatchStore
from activity_lake.streaming.gold import foreach_batch

ORDER = (*EVENT_ORDER, "batch_id")
# A stream's events are ordered by the source's clock, runs by their number: they cannot share a state.
STREAM, RUNS = "events of a stream", "numbered runs"


def start_upsert(
    raw: DataFrame, row: T.StructType, path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Keep the state under ``path`` up to date.

    A repeated batch that is complete is left as it is. State and checkpoint
    belong together: a new checkpoint needs a new path.
    """
    store = BatchStore(raw.sparkSession, path)
    store.claim(STREAM)

    def write(batch: DataFrame, batch_id: int) -> None:
        store.add(latest_state(batch).withColumn("batch_id", F.lit(batch_id).cast("long")), batch_id)

    return foreach_batch(cdc_events(raw, row), write, checkpoint, once)


def record_changes(actions: DataFrame, row: T.StructType, path: str, run: int, key: str = "id") -> bool:
    """Carry the actions of a snapshot comparison out as changes of run ``run``.

    What is written depends on the actions, not on the table. Runs are numbered
    without gaps from the first one on. A run that is complete is not repeated:
    its actions were found against a state that had none of them.
    """
    store = BatchStore(actions.sparkSession, path)
    store.claim(RUNS, first=run)
    op = F.when(F.col("status") == "deleted", "d").when(F.col("status") == "new", "c").otherwise("u")
    number = F.lit(run).cast("long")
    return store.add(chosen_actions(actions, key).select(
        *row.fieldNames(), op.alias("op"), number.alias("ts_ms"), F.lit(None).cast("long").alias("lsn"),
        number.alias("batch_id")), run)


def _event_schema(row: T.StructType) -> T.StructType:
    return T.StructType([
        *row.fields, T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()),
        T.StructField("lsn", T.LongType()), T.StructField("batch_id", T.LongType()),
    ])


def current_state(spark: SparkSession, path: str, row: T.StructType) -> DataFrame:
    """The rows alive now; none before the first batch."""
    alive = F.coalesce(F.col("op") != "d", F.lit(True))
    events, _ = BatchStore(spark, path).read(_event_schema(row))
    return latest_state(events, order=ORDER).filter(alive).select(*row.fieldNames())


def compact(spark: SparkSession, path: str, row: T.StructType) -> int:
    """Write a new snapshot and then point to it; deleted keys stay marked in it.

    Returns the last batch it covers: the last of the unbroken run of complete
    ones. Without a batch after the snapshot there is nothing to do.
    """
    store = BatchStore(spark, path)
    upto, _ = store.snapshot()
    events, last = store.read(_event_schema(row))
    if last > upto:
        store.point(latest_state(events, order=ORDER), last)
    return last


def prune(spark: SparkSession, path: str, keep_hours: float = 24.0) -> int:
    """Remove change folders and snapshots that the pointer has superseded; returns how many."""
    return BatchStore(spark, path).prune(keep_hours)
