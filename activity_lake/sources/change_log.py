"""Change topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Messages of a micro-batch, over all partitions of the topic.
OFFSETS_PER_TRIGGER = 5_000_000


def kafka_options(
    topic: str, servers: str, starting: str = "earliest", fail_on_loss: bool = True,
    offsets_per_trigger: int | None = OFFSETS_PER_TRIGGER, min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source; limits that are not given are left out."""
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_loss).lower(),
        "maxOffsetsPerTrigger": offsets_per_trigger, "minPartitions": min_partitions,
    }
    return {name: str(value) for name, value in options.items() if value is not None}


def cdc_source(
    spark: SparkSession,
    source: str,
    servers: str | None = None,
    starting: str = "earliest",
    fail_on_loss: bool = True,
    files_per_trigger: int | None = None,
    offsets_per_trigger: int | None = OFFSETS_PER_TRIGGER,
    min_partitions: int | None = None,
) -> DataFrame:
    """Stream of change messages with a ``value`` column.

    With ``servers`` the source is a Kafka topic (the connector must be on the
    classpath), otherwise a folder of text files with one message per line.
    ``offsets_per_trigger`` and ``files_per_trigger`` bound a micro-batch, also
    the first one over all that is there; ``min_partitions`` lets more tasks
    read than the topic has partitions.
    """
    if servers:
        options = kafka_options(source, servers, starting, fail_on_loss, offsets_per_trigger, min_partitions)
        return spark.readStream.format("kafka").options(**options).load()
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(source)
