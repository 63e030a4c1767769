"""Kafka sinks. Needs the ``spark-sql-kafka-0-10`` package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import JSON_OPTIONS

# Delivery settings of the producer.
PRODUCER = {"kafka.acks": "all", "kafka.retries": "3", "kafka.compression.type": "snappy"}


def as_values(rows: DataFrame) -> DataFrame:
    """One JSON text ``value`` per row, nulls written out, no key.

    Timestamps are written without a zone, as ISO-8601 with microseconds.
    """
    return rows.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"))


def publish(rows: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Write a batch to a topic."""
    settings = {**PRODUCER, "kafka.bootstrap.servers": servers, "topic": topic, **options}
    as_values(rows).write.format("kafka").options(**settings).save()


def publish_stream(
    rows: DataFrame, servers: str, topic: str, checkpoint: str, trigger: str = "5 seconds", **options: str
) -> StreamingQuery:
    """Write a stream to a topic."""
    settings = {**PRODUCER, "kafka.bootstrap.servers": servers, "topic": topic, **options}
    return (
        as_values(rows)
        .writeStream.format("kafka")
        .options(**settings)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger)
        .start()
    )
