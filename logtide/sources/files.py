"""Log files on any Hadoop file system (local, hdfs:// ...), batch and streaming."""

from __future__ import annotations

from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cleaning import parse_checked, parse_timestamps
from ..schema import LOG_DDL, LOG_FIELDS
from ..session import use_utc
from ..sinks.files import UNITS, services_path, sketch_path

# The folder names of ``UNITS`` in the notation of Python.
UNIT_FORMATS = {"hour": "%Y-%m-%d-%H", "day": "%Y-%m-%d"}


def read_logs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON Lines with the fixed schema; unknown fields are dropped, bad ones become null."""
    return use_utc(spark).read.schema(LOG_DDL).json(path).transform(parse_timestamps)


def read_lines(spark: SparkSession, path: str | list[str], missing_ok: bool = True) -> DataFrame:
    """Each line as text (``value``) and as log columns, with ``missing_fields`` and ``is_valid``.

    Blank lines are skipped. A path that does not exist has no lines unless ``missing_ok``
    is turned off.
    """
    try:
        lines = use_utc(spark).read.text(path)
    except AnalysisException as problem:
        if not missing_ok or problem.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], "value STRING")
    return lines.where("trim(value) <> ''").transform(parse_checked)


def split_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Logs of the valid lines, and the quarantined rest as text with what they lack."""
    return (
        lines.where("is_valid").select(*LOG_FIELDS),
        lines.where("not is_valid").select("value", "missing_fields"),
    )


def stream_logs(spark: SparkSession, folder: str, files_per_trigger: int | None = 1, **options: str) -> DataFrame:
    """Watch a folder of JSON Lines files."""
    reader = use_utc(spark).readStream.schema(LOG_DDL).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder).transform(parse_timestamps)


def read_landed_logs(spark: SparkSession, path: str, condition: str | None = None) -> DataFrame:
    """Logs landed by ``sinks.files.land_logs``.

    A condition on ``timestamp_hour`` or ``service`` prunes folders; one on ``is_error``
    is pushed into the Parquet scan.
    """
    stored = use_utc(spark).read.parquet(path).schema
    # Values of the folders stay text: a service '007' is no number.
    folders = {"service", *(f"timestamp_{unit}" for unit in UNITS)}
    schema = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in folders else f.dataType) for f in stored]
    )
    landed = spark.read.schema(schema).parquet(path)
    return landed.where(condition) if condition else landed


def read_landed_services(spark: SparkSession, path: str) -> DataFrame | None:
    """(service, first, newest) of a log landed by ``land_logs``; None if a stream landed it, which
    keeps no such table."""
    try:
        spans = use_utc(spark).read.parquet(services_path(path))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return spans.groupBy("service").agg(F.min("first").alias("first"), F.max("newest").alias("newest"))


def read_landed_sketch(spark: SparkSession, path: str) -> DataFrame | None:
    """Latency sketch per folder of a log landed by ``land_logs``, for ``summaries.metrics_summary``; None
    if a stream landed it."""
    try:
        return use_utc(spark).read.parquet(sketch_path(path))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_landed_tail(spark: SparkSession, path: str, seconds: int, unit: str = "hour", ts: str = "timestamp") -> DataFrame:
    """Rows of the last ``seconds`` of a landed log; folders that end before are not read.

    The newest time comes from the table that landing keeps; without it from the newest folder,
    which takes a scan for the folder names.
    """
    landed = read_landed_logs(spark, path)
    folder = F.col(f"timestamp_{unit}")
    spans = read_landed_services(spark, path)
    if spans is not None:
        newest = spans.agg(F.max("newest")).first()[0]
        if newest is None:
            return landed
    else:
        last = landed.agg(F.max(folder)).first()[0]
        if last is None:
            return landed
        newest = landed.where(folder == last).agg(F.max(ts)).first()[0]
    cut = newest - timedelta(seconds=seconds)
    return landed.where((folder >= cut.strftime(UNIT_FORMATS[unit])) & (F.col(ts) > F.lit(cut)))
