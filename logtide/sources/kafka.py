"""Kafka topics. Needs the ``spark-sql-kafka-0-10`` package on the cluster."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import parse_lines
from ..session import use_utc

META = ("topic", "partition", "offset")


def parse_values(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed logs from Kafka rows; ``keep`` names Kafka columns to carry along."""
    return messages.select(*keep, F.col("value").cast("string").alias("value")).transform(parse_lines)


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    keep: tuple[str, ...] = (),
    **options: str,
) -> DataFrame:
    """Logs of a topic as they arrive; ``maxOffsetsPerTrigger`` among the options bounds a batch."""
    source = (
        use_utc(spark).readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
    )
    return parse_values(source.load(), keep)


Ranges = dict[int, tuple[int, int]]


def read_topic(spark: SparkSession, servers: str, topic: str, ranges: Ranges | None = None, **options: str) -> DataFrame:
    """What the topic holds now, with partition and offset; of each partition only its range
    (start, end before) where ``ranges`` are given."""
    starting, ending = offsets_json(topic, ranges) if ranges else ("earliest", "latest")
    source = (
        use_utc(spark).read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("endingOffsets", ending)
        .options(**options)
    )
    return parse_values(source.load(), META)


def offsets_json(topic: str, ranges: Ranges) -> tuple[str, str]:
    """Starting and ending offsets as the reader takes them."""
    return tuple(json.dumps({topic: {str(p): r[side] for p, r in sorted(ranges.items())}}) for side in (0, 1))


def plan_offsets(first: dict[int, int], last: dict[int, int], n: int) -> Ranges:
    """The range of each partition that makes the first ``n`` offsets, partition after partition.

    ``first`` and ``last`` are the lowest offset and the one after the highest; a partition that
    has none, or whose turn does not come, gets an empty range.
    """
    ranges = {}
    for partition in sorted(first):
        start = first[partition]
        end = min(start + n, max(start, last.get(partition, start)))
        ranges[partition] = (start, end)
        n -= end - start
    return ranges


def first_messages(
    first: dict[int, int], last: dict[int, int], n: int, read: Callable[[Ranges], DataFrame]
) -> DataFrame:
    """The first ``n`` messages in partition and offset order, without reading or sorting the rest.

    ``read`` opens ranges of offsets. Offsets without a message (compacted topics) make a round
    come short; the next one takes twice the offsets, from where that ended.
    """
    ranges = plan_offsets(first, last, n)
    taken = read(ranges)
    found, at, span = taken.count(), {p: end for p, (_, end) in ranges.items()}, n
    while found < n and any(at[p] < last.get(p, 0) for p in at):
        span *= 2
        ranges = plan_offsets(at, last, span)
        more = read(ranges)
        found += more.count()
        taken = taken.unionByName(more)
        at = {p: end for p, (_, end) in ranges.items()}
    return taken.orderBy("partition", "offset").limit(n)  # what was opened, not the topic


def topic_offsets(spark: SparkSession, servers: str, topic: str) -> tuple[dict[int, int], dict[int, int]]:
    """Lowest offset of each partition and the one after its highest, from the broker's metadata."""
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.Properties()
    settings.put("bootstrap.servers", servers)
    for side in ("key", "value"):
        settings.put(f"{side}.deserializer", "org.apache.kafka.common.serialization.ByteArrayDeserializer")
    consumer = jvm.org.apache.kafka.clients.consumer.KafkaConsumer(settings)
    try:
        places = jvm.java.util.ArrayList()
        for info in consumer.partitionsFor(topic):
            places.add(jvm.org.apache.kafka.common.TopicPartition(topic, info.partition()))
        sides = (consumer.beginningOffsets(places), consumer.endOffsets(places))
        first, last = ({place.partition(): side[place] for place in places} for side in sides)
        return first, last
    finally:
        consumer.close()


def read_first(spark: SparkSession, servers: str, topic: str, n: int, **options: str) -> DataFrame:
    """The first ``n`` messages of a topic; what comes after them is not read."""
    first, last = topic_offsets(spark, servers, topic)
    return first_messages(first, last, n, lambda ranges: read_topic(spark, servers, topic, ranges, **options))


def display_rows(logs: DataFrame) -> DataFrame:
    """Messages for reading: clock time to the millisecond, ``N/A`` for absent values."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("N/A")).alias(name)

    fields = ("service", "host", "log_level", "message", "status_code", "response_time_ms")
    return logs.select(
        "partition", "offset", F.date_format("timestamp", "HH:mm:ss.SSS").alias("time"), *map(shown, fields)
    )
