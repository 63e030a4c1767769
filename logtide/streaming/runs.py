"""Consecutive errors on a stream.

Rows wait until the watermark has passed them, so batches may arrive out of order within the
delay; rows that come later than that are counted and left out. What the watermark has passed
goes through the sliced batch operator in order, so a busy service does not end up in one task.
Carried from batch to batch are the waiting rows and one row per service, its open run. The
carry is a table numbered by batch; a repeated batch reads the same carry and overwrites its
own results.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed_values as fv
from ..functions.records import error_filter
from ..operators.runs import RUN_COLUMNS, sliced_segments, stitch
from .live import writer

SALTS = 1024


def advance(rows: DataFrame, carry: DataFrame | None, shortest: int) -> DataFrame:
    """Runs of ``rows`` (service, ts, id, is_bad), all later than before, continued from ``carry``.

    Adds ``is_open`` (may go on) and ``is_new`` (grew or ended now). A run that a good row ends
    comes out once more, closed. Runs shorter than ``shortest`` are kept only while they are open.
    """
    found = stitch(sliced_segments(rows, F.col("is_bad"), order=("ts", "id"), shortest=shortest))
    if carry is None:
        merged, ended = found.withColumn("is_new", F.lit(True)), None
    else:
        # One row per service is held, and only the first segment of a service can match it.
        # The salt keeps the other segments of a busy service from meeting in one task.
        salt = F.when(F.col("open_start"), 0).otherwise(F.pmod(F.hash("first_id"), F.lit(SALTS)) + 1)
        held = carry.select(F.col("service").alias("_service"), F.lit(0).alias("_at"), F.struct("*").alias("_held"))
        new = found.withColumns({"is_new": F.lit(True), "_salt": salt})
        same = new["service"].eqNullSafe(held["_service"]) & (new["_salt"] == held["_at"])
        both = new.join(held, same, "full_outer")
        resting = F.col("is_new").isNull()
        extends = F.coalesce(F.col("is_bad") & F.col("_held").isNotNull(), F.lit(False))
        merged = both.select(
            F.when(resting, F.col("_service")).otherwise(F.col("service")).alias("service"),
            F.coalesce("is_bad", F.lit(True)).alias("is_bad"),
            F.when(extends | resting, F.col("_held.run_start")).otherwise(F.col("run_start")).alias("run_start"),
            F.coalesce("run_end", "_held.run_end").alias("run_end"),
            F.when(extends | resting, F.col("_held.first_id")).otherwise(F.col("first_id")).alias("first_id"),
            F.coalesce("last_id", "_held.last_id").alias("last_id"),
            (
                F.coalesce("run_length", F.lit(0))
                + F.when(extends | resting, F.col("_held.run_length")).otherwise(F.lit(0))
            ).alias("run_length"),
            F.coalesce("open_end", F.lit(True)).alias("open_end"),
            F.coalesce("is_new", F.lit(False)).alias("is_new"),
        )
        ended = both.where("NOT is_bad AND _held IS NOT NULL").select(
            "_held.service", *(f"_held.{name}" for name in RUN_COLUMNS), F.lit(False).alias("is_open"), F.lit(True).alias("is_new")
        )
    runs = (
        merged.where("is_bad")
        .where(F.col("open_end") | (F.col("run_length") >= shortest))
        .select("service", *RUN_COLUMNS, F.col("open_end").alias("is_open"), "is_new")
    )
    return runs if ended is None else runs.unionByName(ended.where(F.col("run_length") >= shortest))


class RunState:
    """Folders of the carry: waiting rows, open runs and the watermark after each batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, batch_id: int, part: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/batch={batch_id}/{part}")

    def write(self, batch_id: int, part: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}/{part}")

    def purge(self, batch_id: int) -> None:
        """Drop what no batch can read again: a repeated batch reads the one before it."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch={batch_id - 2}")
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def start_runs(
    logs: DataFrame,
    output: str,
    carry: str,
    checkpoint: str,
    shortest: int = fv.CONSECUTIVE_ERRORS,
    trigger: str | None = "5 seconds",
    order=("timestamp", "event_id"),
    delay: timedelta = timedelta(0),
    keywords: Iterable[str] = fv.ERROR_KEYWORDS,
) -> StreamingQuery:
    """Write, per micro-batch, the runs of at least ``shortest`` errors that grew or ended in it.

    Rows may be ``delay`` older than the newest row of earlier batches; what is older still is
    left out and counted in ``output``-late (batch, late_rows). ``fanout.latest_rows`` over
    ``output`` by (service, first_id) gives each run once. Rows of the last ``delay`` wait for
    the batches that pass them.
    """
    ts, tie = order

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = RunState(spark, carry)
        first = batch_id == 0
        passed = None if first else state.read(batch_id - 1, "watermark").first()["passed"]
        slim = batch.where(F.col(ts).isNotNull()).select(
            "service", F.col(ts).alias("ts"), F.col(tie).alias("id"), F.coalesce(error_filter(keywords), F.lit(False)).alias("is_bad")
        )
        in_time = F.lit(True) if passed is None else F.col("ts") > F.lit(passed)
        # Read once: the slices below sample their input, and the source may be remote.
        fresh = slim.withColumn("in_time", in_time).persist()
        try:
            newest, late = fresh.agg(F.max("ts"), F.count_if(~F.col("in_time"))).first()
            now = passed if newest is None or (passed is not None and newest - delay < passed) else newest - delay
            spark.createDataFrame([(batch_id, late)], "batch BIGINT, late_rows BIGINT").coalesce(1).write.mode(
                "overwrite"
            ).parquet(f"{output}-late/batch={batch_id}")
            rows = fresh.where("in_time").drop("in_time")
            if not first:
                rows = rows.unionByName(state.read(batch_id - 1, "waiting"))
            ready = F.lit(False) if now is None else F.col("ts") <= F.lit(now)
            open_before = None if first else state.read(batch_id - 1, "open")
            runs = advance(rows.where(ready), open_before, shortest).persist()
            grown = runs.where(F.col("is_new") & (F.col("run_length") >= shortest))
            grown.drop("is_new").write.mode("overwrite").parquet(f"{output}/batch={batch_id}")
            state.write(batch_id, "open", runs.where("is_open").select("service", *RUN_COLUMNS))
            state.write(batch_id, "waiting", rows.where(~ready))
            kind = batch.schema[ts].dataType.simpleString()
            state.write(batch_id, "watermark", spark.createDataFrame([(now,)], f"passed {kind}").coalesce(1))
            state.purge(batch_id)
            runs.unpersist()
        finally:
            fresh.unpersist()

    return writer(logs, checkpoint, "append", trigger).foreachBatch(step).start()
