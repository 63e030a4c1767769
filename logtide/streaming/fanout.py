"""Several outputs from one stream, and updates kept as files.

Each micro-batch is written to a folder of its own number and overwrites it, so a
batch that is repeated after a failure does not add rows twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed_values as fv
from ..operators.anomalies import live_view
from ..settings import Settings
from ..sinks.kafka import publish
from .live import live_metrics, writer

BatchSink = Callable[[DataFrame, int], None]


def parquet_sink(path: str) -> BatchSink:
    """A folder per micro-batch. Rebalanced, so that a small batch is not many small files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.hint("rebalance").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def kafka_sink(servers: str, topic: str, **options: str) -> BatchSink:
    """At-least-once: the batch number goes along so that readers can drop repeats."""

    def write(batch: DataFrame, batch_id: int) -> None:
        publish(batch.withColumn("batch", F.lit(batch_id)), servers, topic, **options)

    return write


def fan_out(metrics: BatchSink, alerts: BatchSink) -> BatchSink:
    """Metrics to one sink, the anomalous ones as alerts to another."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            metrics(kept, batch_id)
            alerts(kept.where("is_anomaly").withColumn("source", F.lit("AUTOMATED_ALERT")), batch_id)
        finally:
            kept.unpersist()

    return write


def topics(servers: str, **options: str) -> BatchSink:
    """Metrics to the processed topic, alerts to the alert topic."""
    return fan_out(
        kafka_sink(servers, fv.PROCESSED_TOPIC, **options), kafka_sink(servers, fv.ALERT_TOPIC, **options)
    )


def start_live(
    logs: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    settings: Settings = Settings(),
    mode: str = "update",
    trigger: str | None = "5 seconds",
) -> StreamingQuery:
    """Live view into ``sink``, one call per micro-batch; from panes in append mode."""
    view = live_metrics(logs, settings, chained=mode == "append").transform(live_view)
    return writer(view, checkpoint, mode, trigger).foreachBatch(sink).start()


def latest_rows(spark: SparkSession, path: str, schema: str, keys: Sequence[str]) -> DataFrame:
    """Newest version of each row of an update stream kept by ``parquet_sink``."""
    written = spark.read.schema(f"{schema}, batch BIGINT").parquet(path)
    rest = [name for name in written.columns if name not in (*keys, "batch")]
    newest = F.max_by(F.struct(*rest), "batch").alias("_row")
    return written.groupBy(*keys).agg(newest).select(*keys, "_row.*")
