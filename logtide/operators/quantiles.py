"""Exact percentiles of a column without holding its values in one task.

A sketch counts the values in logarithmic buckets; sketches of parts of the data merge by sums. The
buckets that hold the wanted ranks bound them, and one pass over the data counts the different
values inside the bounds. Where these are many, the counted values are kept in a table and
narrowed there, all bounds at a time, until the part with a rank is small or holds a single value.
So the data are read twice, or once where a sketch is at hand, however many they are. All
passes combine on the map side, so equal values never meet as rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir

# Buckets per doubling of the value: a bucket spans 0.017 % of its value.
RESOLUTION = 4096
# Parts of a range that is cut again, and rows of a part whose values are counted one by one.
PARTS = 4096
PART_ROWS = 100_000


class Part(NamedTuple):
    """A range of values, its rows, and the rows before it."""

    low: float
    high: float
    n: int
    before: int


def log_bucket(value: Column, resolution: int = RESOLUTION) -> Column:
    """Bucket number that never decreases as ``value`` grows; null for NaN."""
    number = (F.signum(value) * F.floor(F.log2(F.abs(value) + 1) * resolution)).cast("bigint")
    return F.when(~F.isnan(value), number)


def bucket_edge(bucket: Column, resolution: int = RESOLUTION) -> Column:
    """The end of a bucket that is nearer to zero."""
    return F.signum(bucket) * (F.pow(F.lit(2.0), F.abs(bucket) / resolution) - 1)


def _locate(counted: Iterable[tuple], ranks: Iterable[int], before: int = 0) -> dict[int, Part]:
    """For each rank the one of the ranges (low, high, rows) that holds it."""
    found, todo = {}, sorted(ranks)
    for low, high, n in sorted(counted):
        while todo and todo[0] < before + n:
            found[todo.pop(0)] = Part(low, high, n, before)
        before += n
    if todo:
        raise ValueError(f"the sketch counts more rows than the data hold: nothing at rank {todo[0]} of {before}")
    return found


def value_counts(rows: DataFrame, column: str, missing: float | None = None) -> DataFrame:
    """(low, high, n): the log buckets of a column without NaN; nulls count as ``missing`` or not at all."""
    value = _value(column, missing)
    values = rows.select(value.alias("_value")).where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    return (
        values.groupBy(log_bucket(F.col("_value")).alias("_bucket"))
        .agg(F.min("_value").alias("low"), F.max("_value").alias("high"), F.count(F.lit(1)).alias("n"))
        .drop("_bucket")
    )


def _value(column: str, missing: float | None) -> Column:
    value = F.col(column).cast("double")
    return value if missing is None else F.coalesce(value, F.lit(float(missing)))


def _inside(value: Column, parts: Iterable[Part]) -> Column:
    return reduce(or_, (value.between(p.low, p.high) for p in parts))


def counts_inside(rows: DataFrame, column: str, parts: Iterable[Part], missing: float | None = None) -> DataFrame:
    """(_value, n): how often each value inside the parts occurs. The test is on the column itself, so
    that a scan is given the bounds."""
    parts = list(parts)
    wanted = _inside(F.col(column).cast("double"), parts)
    if missing is not None and any(p.low <= missing <= p.high for p in parts):
        wanted = wanted | F.col(column).isNull()
    return rows.where(wanted).groupBy(_value(column, missing).alias("_value")).agg(F.count(F.lit(1)).alias("n"))


def _cut(counts: DataFrame, parts: list[Part]) -> dict[Part, list[tuple]]:
    """Ranges of equal width of each part, as far as they hold values, in one pass."""
    place, number, value = F.lit(None).cast("int"), F.lit(None).cast("bigint"), F.col("_value")
    for i, p in enumerate(parts):
        # Halves first, so that the width of a wide part is finite.
        step = F.floor((value / 2 - p.low / 2) / (p.high / 2 - p.low / 2) * PARTS).cast("bigint")
        mine = value.between(p.low, p.high)
        place, number = F.when(mine, i).otherwise(place), F.when(mine, step).otherwise(number)
    finer = counts.where(_inside(value, parts)).groupBy(place.alias("_part"), number.alias("_number"))
    out: dict[Part, list[tuple]] = {p: [] for p in parts}
    for row in finer.agg(F.min("_value"), F.max("_value"), F.sum("n"), F.count(F.lit(1))).collect():
        out[parts[row[0]]].append(tuple(row[2:]))
    return out


def exact_percentiles(
    rows: DataFrame,
    column: str,
    fractions: Sequence[float],
    part_rows: int = PART_ROWS,
    missing: float | None = None,
    counted: Iterable[tuple] | None = None,
) -> DataFrame:
    """One row per fraction (``fraction``, ``value``), linear between neighbours.

    NaN is ignored, and so are nulls unless ``missing`` gives a value for them; no values, no rows.
    ``counted`` are the ranges (low, high, n) of a sketch of the same rows; without it they are counted
    first. What comes to the driver is counts: of the buckets that differ (some ten thousand at
    most for latencies, two million for any double), of ``PARTS`` ranges per part, and of the
    values of a part, ``part_rows`` at most.
    """
    spark = rows.sparkSession
    if counted is None:
        counted = [tuple(r) for r in value_counts(rows, column, missing).collect()]
    counted = list(counted)
    total = sum(n for _, _, n in counted)
    schema = "fraction DOUBLE, value DOUBLE"
    if not total:
        return spark.createDataFrame([], schema)
    positions = {float(f): (total - 1) * float(f) for f in fractions}
    at = _locate(counted, {side for p in positions.values() for side in (math.floor(p), math.ceil(p))})

    def open_parts() -> list[Part]:
        return sorted({p for p in at.values() if p.low != p.high})

    if parts := open_parts():
        counts = counts_inside(rows, column, parts, missing)
        if max(p.n for p in parts) > part_rows:
            path = scratch_dir(spark, "values")
            counts.write.parquet(path)
            counts = spark.read.schema("_value DOUBLE, n BIGINT").parquet(path)
        different = {p: p.n for p in parts}
        while wide := [p for p in open_parts() if different[p] > part_rows]:
            for part, cut in _cut(counts, wide).items():
                kinds = {(low, high): k for low, high, _, k in cut}
                inside = [rank for rank, p in at.items() if p == part]
                at.update(_locate([c[:3] for c in cut], inside, part.before))
                # Neighbouring doubles that no step tells apart are few: counted by value below.
                different |= {at[r]: 0 if len(cut) == 1 else kinds[at[r].low, at[r].high] for r in inside}
    if parts := open_parts():
        each = [(v, v, n) for v, n in counts.where(_inside(F.col("_value"), parts)).collect()]
        for part in parts:
            inside = [rank for rank, p in at.items() if p == part]
            at.update(_locate([c for c in each if part.low <= c[0] <= part.high], inside, part.before))
    out = []
    for fraction, p in positions.items():
        low, high = at[math.floor(p)].low, at[math.ceil(p)].low
        out.append((fraction, low + (high - low) * (p - math.floor(p))))
    return spark.createDataFrame(out, schema)
