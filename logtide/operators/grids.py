"""Per-service time grids: counts per step with the empty steps filled in.

Trailing sums over a grid need the steps in order. Ordering all steps of a service in
one task would tie the parallelism to the number of services, so the grid is cut into
chunks of consecutive steps and every chunk also receives the steps just before it
(its margin). The log is counted into steps before any of this happens.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def step_number(ts: Column, step_s: int, closed: str = "right") -> Column:
    """Number of the step a timestamp belongs to, counted from the epoch.

    ``right``: step k covers ((k-1)*step, k*step]; ``left``: [k*step, (k+1)*step).
    """
    micros = F.unix_micros(ts.cast("timestamp"))
    size = F.lit(step_s * 1_000_000).cast("bigint")
    whole = F.floor((micros - F.pmod(micros, size)) / size)
    if closed == "left":
        return whole
    return whole + F.when(F.pmod(micros, size) > 0, 1).otherwise(0)


def step_time(number: Column, step_s: int) -> Column:
    """Zone-less timestamp of a step number."""
    return F.expr(EPOCH) + F.make_dt_interval(secs=number.cast("bigint") * F.lit(step_s))


def count_steps(
    logs: DataFrame,
    values: Mapping[str, Column],
    step_s: int,
    by: str = "service",
    ts: str = "timestamp",
    closed: str = "right",
) -> DataFrame:
    """Aggregates ``values`` per ``by`` and ``step``."""
    return (
        logs.where(F.col(ts).isNotNull())
        .groupBy(by, step_number(F.col(ts), step_s, closed).alias("step"))
        .agg(*(value.alias(name) for name, value in values.items()))
    )


def fill_steps(
    steps: DataFrame,
    values: list[str],
    reach: int,
    margin: int,
    until: Column | None = None,
    by: str = "service",
    chunk: int | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Grid rows (``by``, ``_chunk``, ``step``, values) with zeros in the empty steps.

    A step is present when it or one of the ``reach - 1`` steps before it holds rows;
    elsewhere every trailing sum is zero and nothing can be said. ``margin`` earlier
    steps are repeated in front of each chunk (``_own`` is false there). Steps after
    ``until`` are left out. ``carried`` columns are the same in all steps of ``by``.
    """
    size = chunk or max(512, 8 * margin)
    own = F.floor(F.col("step") / size)
    spills = F.pmod(F.col("step"), F.lit(size)) >= size - margin
    # A margin longer than a chunk would have to spill further than one chunk.
    if margin > size:
        raise ValueError("chunk must be at least as long as the margin")
    copies = steps.withColumn(
        "_chunk", F.explode(F.when(spills, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    lane = Window.partitionBy(by, "_chunk").orderBy("step")
    last = (F.col("_chunk") + 1) * size - 1
    stops = [F.lead("step").over(lane) - 1, last, F.col("step") + reach - 1]
    end = F.least(*stops, *([] if until is None else [until]))
    filled = (
        copies.withColumn("_end", end)
        .where(F.col("_end") >= F.col("step"))
        .withColumn("_at", F.explode(F.sequence("step", "_end")))
    )
    zeros = {name: F.when(F.col("_at") == F.col("step"), F.col(name)).otherwise(F.lit(0)) for name in values}
    return (
        filled.withColumns(zeros)
        .withColumn("_own", F.col("_at") >= F.col("_chunk") * size)
        .select(by, "_chunk", F.col("_at").alias("step"), "_own", *values, *carried)
    )


def trailing(by: str, first: int, last: int = 0):
    """Window over the steps from ``first`` to ``last`` relative to the current step."""
    return Window.partitionBy(by, "_chunk").orderBy("step").rangeBetween(first, last)
