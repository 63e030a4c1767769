"""Runs of consecutive error events per service.

The order (timestamp, event_id) is global per service, so a service with many rows is cut into
slices of time. How wide these are follows from the rows per service and minute, which are
counted first; the log itself is then shuffled once, by service and slice. Runs are found
inside each slice; only the runs that touch the edge of a slice are stitched across slices,
and there are at most a few of those per service and slice.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.records import error_filter

RUN_COLUMNS = ("run_start", "run_end", "first_id", "last_id", "run_length")
SLICE_ROWS = 1_000_000
UNIT_S = 60
WIDTHS = tuple(4**k for k in range(13))  # of a slice, in units: a minute to thirty years
MAX_CUT = 10_000  # services that are cut into slices


def unit_number(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(UNIT_S * 1_000_000))


def slice_widths(slim: DataFrame, key: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(``_cut``, ``_width``): for each ``key`` with more rows than a slice, the widest slice that holds
    no more, or a single unit.

    A slice holds ``slice_rows`` rows, or a ``MAX_CUT``-th of all if that is more; so no more than
    ``MAX_CUT`` keys come out, however long the log is.
    """
    counts = slim.groupBy(F.col(key).alias("_cut"), unit_number(F.col("_ts")).alias("_unit")).agg(F.count(F.lit(1)).alias("_n"))
    share = F.coalesce(counts.agg((F.sum("_n") / MAX_CUT).cast("bigint").alias("share")).scalar(), F.lit(0))
    room = F.greatest(F.lit(slice_rows), share)
    large = counts.withColumns({"_all": F.sum("_n").over(Window.partitionBy("_cut")), "_room": room}).where(F.col("_all") > F.col("_room"))
    tried = large.withColumn("_width", F.explode(F.array(*(F.lit(w) for w in WIDTHS))))
    held = tried.groupBy("_cut", "_width", F.floor(F.col("_unit") / F.col("_width")).alias("_slot")).agg(
        F.sum("_n").alias("_n"), F.first("_room").alias("_room")
    )
    fits = F.col("_n") <= F.col("_room")
    widest = held.groupBy("_cut", "_width").agg(F.bool_and(fits).alias("_fits")).groupBy("_cut")
    return widest.agg(F.coalesce(F.max(F.when(F.col("_fits"), F.col("_width"))), F.lit(1)).alias("_width"))



def sliced_segments(
    logs: DataFrame,
    is_error: Column,
    key: str = "service",
    order: Sequence[str] = ("timestamp", "event_id"),
    shortest: int = 1,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Maximal segments of equal ``is_error`` inside time slices of ``key``, in ``order``.

    Kept are error segments of at least ``shortest`` rows and every segment at the edge
    of a slice. ``at_start``/``at_end`` tell which edge a segment touches.
    """
    ts, tie = order
    slim = logs.where(F.col(ts).isNotNull()).select(
        F.col(key), F.col(ts).alias("_ts"), F.col(tie).alias("_id"), F.coalesce(is_error, F.lit(False)).alias("_bad")
    )
    widths = F.broadcast(slice_widths(slim, key, slice_rows))  # MAX_CUT rows at most
    slot = F.floor(unit_number(F.col("_ts")) / F.col("_width"))
    sliced = slim.join(widths, F.col(key).eqNullSafe(F.col("_cut")), "left").withColumn("_slice", F.coalesce(slot, F.lit(0)))
    sliced = sliced.drop("_cut", "_width")
    ordered = Window.partitionBy(key, "_slice").orderBy("_ts", "_id")
    before, after = F.lag("_bad").over(ordered), F.lead("_bad").over(ordered)
    same = F.col("_bad").eqNullSafe
    borders = (
        sliced.withColumns({"_opens": ~same(before), "_closes": ~same(after)})
        .withColumns(
            {
                "_at": F.row_number().over(ordered),
                "_head": before.isNull(),
                "_end": F.struct(F.col("_ts"), F.col("_id"), after.isNull().alias("last")),
            }
        )
        .where(F.col("_opens") | F.col("_closes"))
    )
    # Only the first and last row of each segment are left, so the row after an opening
    # row closes it unless the row closes itself. Same partitioning and order: no shuffle.
    closing = F.lead(F.struct("_end", "_at")).over(ordered)
    end = F.when(F.col("_closes"), F.struct("_end", "_at")).otherwise(closing)
    return (
        borders.withColumn("_until", end)
        .where("_opens")
        .select(
            key,
            "_slice",
            F.col("_bad").alias("is_bad"),
            F.col("_ts").alias("run_start"),
            F.col("_until._end._ts").alias("run_end"),
            F.col("_id").alias("first_id"),
            F.col("_until._end._id").alias("last_id"),
            (F.col("_until._at") - F.col("_at") + 1).cast("bigint").alias("run_length"),
            F.col("_head").alias("at_start"),
            F.col("_until._end.last").alias("at_end"),
        )
        .where(F.col("at_start") | F.col("at_end") | (F.col("is_bad") & (F.col("run_length") >= shortest)))
    )


def stitch(segments: DataFrame, key: str = "service") -> DataFrame:
    """Join the edge segments that continue each other; one row per maximal segment.

    Inner segments are complete and stay in a group of their own slice. Edge segments
    of a key are ordered by their first row. ``open_start``/``open_end`` mark a segment
    at the very start or end of the key's rows.
    """
    edge = F.col("at_start") | F.col("at_end")
    lane = F.when(edge, F.lit(-1)).otherwise(F.col("_slice"))
    ordered = Window.partitionBy(key, "_lane").orderBy("run_start", "first_id")
    previous = F.lag(F.struct("is_bad", "at_end")).over(ordered)
    joins = edge & F.col("at_start") & previous["at_end"] & (previous["is_bad"] == F.col("is_bad"))
    is_edge = F.col("_lane") == -1
    return (
        segments.withColumn("_lane", lane)
        .withColumns(
            {
                "_new": 1 - F.coalesce(joins.cast("int"), F.lit(0)),
                "_head": is_edge & previous.isNull(),
                "_tail": is_edge & F.lead("_slice").over(ordered).isNull(),
            }
        )
        .withColumn("_run", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(key, "_lane", "_run", "is_bad")
        .agg(
            F.min("run_start").alias("run_start"),
            F.max("run_end").alias("run_end"),
            F.min_by("first_id", F.struct("run_start", "first_id")).alias("first_id"),
            F.max_by("last_id", F.struct("run_end", "last_id")).alias("last_id"),
            F.sum("run_length").alias("run_length"),
            F.bool_or("_head").alias("open_start"),
            F.bool_or("_tail").alias("open_end"),
        )
        .drop("_lane", "_run")
    )


def runs_of(
    rows: DataFrame, condition: Column, key: str, order: Sequence[str], shortest: int = 1, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Maximal runs per ``key`` of at least ``shortest`` consecutive rows that meet ``condition``."""
    segments = sliced_segments(rows, condition, key, order, shortest, slice_rows)
    return (
        stitch(segments, key)
        .where(F.col("is_bad") & (F.col("run_length") >= shortest))
        .select(key, *RUN_COLUMNS)
    )


def consecutive_errors(
    logs: DataFrame,
    shortest: int = fv.CONSECUTIVE_ERRORS,
    is_error: Column | None = None,
    order: Sequence[str] = ("timestamp", "event_id"),
    keywords: Iterable[str] = fv.ERROR_KEYWORDS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Maximal runs of at least ``shortest`` consecutive error events per service."""
    condition = error_filter(keywords) if is_error is None else is_error
    return runs_of(logs, condition, "service", order, shortest, slice_rows)


def held_gauge(
    samples: DataFrame, limit: float, hold_s: int, key: str, order: Sequence[str], value: str = "value"
) -> DataFrame:
    """Stretches of consecutive samples above ``limit`` that span at least ``hold_s`` seconds."""

    def micros(column: str) -> Column:
        return F.unix_micros(F.col(column).cast("timestamp"))

    return runs_of(samples, F.col(value) > limit, key, order).where(
        micros("run_end") - micros("run_start") >= hold_s * 1_000_000
    )
