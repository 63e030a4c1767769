"""Synthetic logs from row numbers.

Every draw is a hash of (seed, draw, row number). A record depends on its number only,
so it comes out the same whatever the partitioning and however often a task is retried,
and batch and stream share one definition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv


@dataclass(frozen=True)
class ErrorKind:
    """One component of the error mixture. No message list means a latency message."""

    weight: float
    latency: tuple[int, int]
    statuses: tuple[int, ...]
    levels: tuple[str, ...]
    messages: tuple[str, ...] = ()
    prefix: str = ""


@dataclass(frozen=True)
class Profile:
    """Distribution of the records."""

    errors: tuple[ErrorKind, ...]
    normal_messages: tuple[str, ...]
    success_weights: tuple[float, ...]
    latency_message: str
    services: tuple[str, ...] = fv.SERVICES
    hosts: tuple[str, ...] = fv.HOSTS
    anomaly_share: float = 0.15


# Level and status weights of normal records, and the two error mixtures.
NORMAL_LEVELS = {"DEBUG": 0.3, "INFO": 0.6, "WARNING": 0.1}
NORMAL_LATENCY = (50, 500)
STANDARD = Profile(
    errors=(
        ErrorKind(0.3, (3000, 15000), (200,), ("WARNING",)),
        ErrorKind(0.3, (50, 300), fv.CLIENT_ERROR_CODES, ("WARNING",), fv.ERROR_MESSAGES),
        ErrorKind(0.3, (100, 2000), fv.SERVER_ERROR_CODES, ("ERROR",), fv.ERROR_MESSAGES),
        ErrorKind(0.1, (100, 1000), (500,), ("CRITICAL",), fv.ERROR_MESSAGES, "Exception: "),
    ),
    normal_messages=fv.NORMAL_MESSAGES,
    success_weights=(0.7, 0.2, 0.1),
    latency_message="High latency detected: {}ms",
)
COMPACT = Profile(
    errors=(
        ErrorKind(0.4, (3000, 10000), (200,), ("WARNING",)),
        ErrorKind(0.4, (100, 1000), fv.COMPACT_ERROR_CODES, ("ERROR",), fv.COMPACT_ERROR_MESSAGES),
        ErrorKind(0.2, (100, 1000), fv.COMPACT_ERROR_CODES, ("CRITICAL",), fv.COMPACT_ERROR_MESSAGES),
    ),
    normal_messages=fv.COMPACT_NORMAL_MESSAGES,
    success_weights=(1 / 3, 1 / 3, 1 / 3),
    latency_message="High response time detected",
)


class Draws:
    """Independent uniform draws in [0, 1) per row, told apart by name."""

    def __init__(self, number: Column, seed: int) -> None:
        self.number, self.seed = number, seed

    def uniform(self, name: str) -> Column:
        hashed = F.xxhash64(F.lit(self.seed).cast("bigint"), F.lit(name), self.number)
        return F.pmod(hashed, F.lit(1 << 53)) / F.lit(float(1 << 53))

    def integer(self, name: str, low: int, high: int) -> Column:
        """Whole number from ``low`` to ``high``, both included."""
        return (F.floor(self.uniform(name) * (high - low + 1)) + low).cast("bigint")

    def choice(self, name: str, options: Sequence) -> Column:
        if len(options) == 1:
            return F.lit(options[0])
        return F.element_at(F.array(*map(F.lit, options)), self.integer(name, 1, len(options)).cast("int"))

    def weighted(self, name: str, options: Sequence[tuple[float, Column]]) -> Column:
        draw, edge, out = self.uniform(name), 0.0, None
        for weight, column in options[:-1]:
            edge += weight
            out = (F if out is None else out).when(draw < edge, column)
        return options[-1][1] if out is None else out.otherwise(options[-1][1])


def as_records(
    numbered: DataFrame,
    number: str,
    at: Column,
    seed: int = 42,
    profile: Profile = STANDARD,
) -> DataFrame:
    """One log record per row of ``numbered``; ``at`` is its event time."""
    draws = Draws(F.col(number), seed)
    # Kind 0 is a normal record, the others are the components of the error mixture.
    component = draws.weighted("kind", [(kind.weight, F.lit(i)) for i, kind in enumerate(profile.errors, 1)])
    kind = F.when(draws.uniform("anomaly") < profile.anomaly_share, component).otherwise(0)
    ranges = [NORMAL_LATENCY, *(k.latency for k in profile.errors)]
    low = F.element_at(F.array(*(F.lit(lo) for lo, _ in ranges)), F.col("_kind") + 1)
    width = F.element_at(F.array(*(F.lit(hi - lo + 1) for lo, hi in ranges)), F.col("_kind") + 1)

    def by_kind(normal: Column, failing: Callable[[ErrorKind], Column]) -> Column:
        out = F.when(F.col("_kind") == 0, normal)
        for i, error in enumerate(profile.errors, 1):
            out = out.when(F.col("_kind") == i, failing(error))
        return out

    def failing_message(error: ErrorKind) -> Column:
        if error.messages:
            return draws.choice("message", [error.prefix + text for text in error.messages])
        before, mark, after = profile.latency_message.partition("{}")
        return F.concat(F.lit(before), F.col("_latency"), F.lit(after)) if mark else F.lit(before)

    level = by_kind(
        draws.weighted("level", [(w, F.lit(name)) for name, w in NORMAL_LEVELS.items()]),
        lambda error: draws.choice("level", error.levels),
    )
    message = by_kind(draws.choice("message", profile.normal_messages), failing_message)
    status = by_kind(
        draws.weighted("status", list(zip(profile.success_weights, map(F.lit, fv.SUCCESS_CODES)))),
        lambda error: draws.choice("status", error.statuses),
    )
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col(number)))
    parts = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return (
        numbered.withColumn("_kind", kind)
        .withColumn("_latency", (low + F.floor(draws.uniform("latency") * width)).cast("bigint"))
        .select(
            at.alias("timestamp"),
            draws.choice("service", profile.services).alias("service"),
            draws.choice("host", profile.hosts).alias("host"),
            level.alias("log_level"),
            message.alias("message"),
            F.concat_ws("-", *parts).alias("request_id"),
            F.col("_latency").cast("double").alias("response_time_ms"),
            status.cast("bigint").alias("status_code"),
        )
    )


def generate_logs(
    spark: SparkSession,
    n: int,
    start: str | None = None,
    seed: int = 42,
    profile: Profile = STANDARD,
    span_s: float = 60,
) -> DataFrame:
    """``n`` records spread evenly over ``span_s`` seconds from ``start`` (now unless given)."""
    begin = F.current_timestamp() if start is None else F.to_timestamp(F.lit(start))
    offset = F.make_dt_interval(secs=(F.col("id") * F.lit(span_s / n)).cast("decimal(18,6)"))
    return as_records(spark.range(n), "id", begin + offset, seed, profile)


def stream_synthetic(
    spark: SparkSession,
    batch_size: int = 100,
    delay_ms: int = 100,
    n: int | None = None,
    seed: int = 42,
    profile: Profile = STANDARD,
) -> DataFrame:
    """Records at ``batch_size`` per ``delay_ms``, stamped with their arrival; the first ``n`` or endless."""
    per_second = max(1, round(batch_size * 1000 / max(delay_ms, 1)))
    rate = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    if n is not None:
        rate = rate.where(F.col("value") < n)
    return as_records(rate, "value", F.col("timestamp"), seed, profile)
