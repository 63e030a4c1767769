"""Shared pieces: table readers, word splitting, tables that cut lineage."""

from __future__ import annotations

import shutil
import tempfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.session import scratch_dir

# Words are runs of anything but these six characters, in every operator.
BLANKS = " \t\n\x0b\f\r"
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and what is
    read survives the loss of any executor."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(spark: SparkSession) -> int:
    """Number of groups to cut work into so that every task of a shuffle has some."""
    return max(32, int(spark.conf.get("spark.sql.shuffle.partitions")))


@lru_cache(maxsize=8)
def _archive_for(application: str) -> str:
    package = Path(__file__).resolve().parents[1]
    base = f"{tempfile.mkdtemp(prefix='run-')}/{package.name}"
    return shutil.make_archive(base, "zip", package.parent, package.name)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application; Spark serves the archive itself."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        context.addPyFile(_archive_for(context.applicationId))
        _shipped.add(context.applicationId)
