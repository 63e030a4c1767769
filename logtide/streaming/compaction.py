"""Updates of a stream kept in a bounded number of folders, apart for each run.

A run (the identity of the checkpoint unless named) has its own folder, so two streams over one
path do not mix and a restarted one goes on. Below it:

* ``live/batch=n``: the rows of a micro-batch. A repeated batch overwrites its folder.
* ``open/upto=n``: the newest version of each row that may still change, of all batches up to n.
* ``closed/upto=n/hour=...`` (or ``day``): rows of hours that the stream has left behind, written once.

After every ``every`` batches the versions in ``open`` and the live batches before the current one
are merged, hours that ended are moved to ``closed`` and the rest becomes the next ``open``. Its
success file is the swap: readers take the newest complete ``open``, older ``closed`` folders and
newer batches. What a swap replaces is removed by the one after it, so a reader that began before
still finds its files. Failing anywhere in between leaves the state of the last swap, and the
repeated batch does the work again.

An hour is closed too early only if late rows are let in later; the update then is one more version
of a row, and readers take the newest. So results do not depend on the closing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..settings import Settings
from ..sinks.files import UNITS
from .fanout import BatchSink

START, END = "window_start", "window_end"
WINDOW_KEYS = (START, END, "service")


def run_of(batch: DataFrame) -> str:
    """Identity of the query that a micro-batch belongs to; it lies in the checkpoint."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("not a micro-batch of a query; name the run")
    return found


class RunFolder:
    """The folders of one run."""

    def __init__(self, spark: SparkSession, path: str, run: str):
        self.spark, self.root = spark, f"{path.rstrip('/')}/run={run}"

    def numbers(self, kind: str, marked: bool = False) -> list[int]:
        """Numbers of the folders of a kind; with ``marked`` of those that were written to the end."""
        names = _names(self.spark, f"{self.root}/{kind}")
        found = sorted(int(n[1]) for n in (re.fullmatch(r"(?:batch|upto)=(\d+)", name) for name in names) if n)
        return [n for n in found if not marked or "_SUCCESS" in _names(self.spark, self.at(kind, n))]

    def at(self, kind: str, number: int) -> str:
        return f"{self.root}/{kind}/{'batch' if kind == 'live' else 'upto'}={number}"

    def swapped(self) -> int:
        """The batch that the newest complete ``open`` reaches to; -1 for none."""
        return max(self.numbers("open", marked=True), default=-1)

    def versions(self, schema: T.StructType, upto: int | None = None, closed: bool = True) -> DataFrame:
        """Rows with their ``batch`` as of the last swap and the batches after it (until ``upto``)."""
        done = self.swapped()
        schema = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        names = [f.name for f in schema]
        parts = [self.at("live", n) for n in self.numbers("live") if n > done and (upto is None or n <= upto)]
        kept = [self.at("open", done)] if done >= 0 else []
        kept += [self.at("closed", n) for n in self.numbers("closed") if closed and n <= done]
        rows = self.spark.createDataFrame([], schema)
        if parts:
            # The number of a live batch is its folder's name.
            rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/live").parquet(*parts).select(*names)
        for group in (kept[:1], kept[1:]) if done >= 0 else ():
            if group:
                rows = rows.unionByName(self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*group))
        return rows

    def remove(self, kind: str, below: int) -> None:
        for number in self.numbers(kind):
            if number < below:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.at(kind, number))
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def newest(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The version of the highest batch per key, with its ``batch``."""
    rest = [name for name in versions.columns if name not in keys]
    # The number leads, so that versions are told apart by it alone.
    row = F.max_by(F.struct(*rest), "batch").alias("_row")
    return versions.groupBy(*keys).agg(row).select(*keys, "_row.*")


def compact(folder: RunFolder, schema: T.StructType, upto: int, keys: Sequence[str], delay: str, unit: str = "hour") -> bool:
    """Merge all up to batch ``upto``; False if that was done before."""
    before = folder.swapped()
    if before >= upto:
        return False
    rows = newest(folder.versions(schema, upto, closed=False), keys).persist()
    try:
        # No event is newer than the watermark plus the delay, and the newest window began before the newest event.
        latest = rows.agg(F.max(START)).first()[0]
        ended = F.date_trunc(unit, START) + F.expr(f"INTERVAL 1 {unit}") + (F.col(END) - F.col(START))
        left = F.lit(False) if latest is None else F.coalesce(ended <= F.lit(latest) - F.expr(f"INTERVAL '{delay}'"), F.lit(False))
        closed = rows.where(left)
        if not closed.isEmpty():
            closed = closed.withColumn(unit, F.date_format(START, UNITS[unit])).hint("rebalance", unit)
            closed.write.mode("overwrite").partitionBy(unit).parquet(folder.at("closed", upto))
        rows.where(~left).hint("rebalance").write.mode("overwrite").parquet(folder.at("open", upto))
    finally:
        rows.unpersist()
    if folder.swapped() == upto:
        folder.remove("open", before)
        folder.remove("live", before + 1)
    return True


def compacting_sink(
    path: str,
    keys: Sequence[str],
    every: int = 100,
    delay: str = Settings.watermark,
    run: str | None = None,
    unit: str = "hour",
) -> BatchSink:
    """Keep the updates of windows (``window_start``, ``window_end`` among ``keys``) below ``path``.

    ``delay`` is the delay of the stream's watermark, ``unit`` (hour, day) what closed rows are filed by. Batch n is not merged before batch n + 1
    arrives, as it may be repeated. Rows equal in ``keys`` within a batch are one row.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = RunFolder(batch.sparkSession, path, run or run_of(batch))
        batch.hint("rebalance").write.mode("overwrite").parquet(folder.at("live", batch_id))
        if batch_id % every == 0 and batch_id:
            compact(folder, batch.schema, batch_id - 1, keys, delay, unit)

    return write


def runs_of(spark: SparkSession, path: str) -> list[str]:
    """Runs that have written below a path."""
    return sorted(name.removeprefix("run=") for name in _names(spark, path) if name.startswith("run="))


def latest_updates(spark: SparkSession, path: str, schema: str, keys: Sequence[str], run: str | None = None) -> DataFrame:
    """Newest version of each row of a run kept by ``compacting_sink``; a path with several needs its name."""
    if run is None:
        runs = runs_of(spark, path)
        if len(runs) != 1:
            raise ValueError(f"{path} holds {len(runs)} runs; name one of {runs}")
        run = runs[0]
    return newest(RunFolder(spark, path, run).versions(T.StructType.fromDDL(schema)), keys).drop("batch")
