"""Sustained alert rules on trailing windows, and the dashboard series built from them.

A rule is evaluated at every step on the events in (t - lookback, t]. It fires at t
when its condition held at every evaluation in [t - hold, t]. Steps whose lookback
holds no events evaluate to false.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import rates
from ..functions.records import error_filter
from .grids import count_steps, fill_steps, step_number, step_time, trailing

COUNTS = ["events", "errors", "criticals", "latency_sum", "latency_n"]


@dataclass(frozen=True)
class Rule:
    """``measure`` is one of error_ratio, critical_ratio, avg_latency, error_spike."""

    name: str
    measure: str
    threshold: float
    hold_s: int
    severity: str
    lookback_s: int = 300
    baseline_s: int = 3600
    step_s: int = 30

    def scaled(self, step_s: int, lookback_s: int, hold_s: int, baseline_s: int | None = None) -> Rule:
        """The same rule on another time scale."""
        return replace(
            self,
            step_s=step_s,
            lookback_s=lookback_s,
            hold_s=hold_s,
            baseline_s=baseline_s or lookback_s * (self.baseline_s // self.lookback_s),
        )

    @property
    def span_s(self) -> int:
        return self.baseline_s if self.measure == "error_spike" else self.lookback_s

    @property
    def hold_steps(self) -> int:
        return -(-self.hold_s // self.step_s)

    def steps(self, seconds: int) -> int:
        if seconds % self.step_s:
            raise ValueError(f"{seconds} s is not a whole number of {self.step_s} s steps")
        return seconds // self.step_s


# Names, limits, lookbacks and hold times of the monitoring rules.
HIGH_ERROR_RATE = Rule("HighErrorRate", "error_ratio", 0.15, 300, "warning")
CRITICAL_ERROR_RATE = Rule("CriticalErrorRate", "critical_ratio", 0.05, 120, "critical")
HIGH_RESPONSE_TIME = Rule("HighResponseTime", "avg_latency", 5000, 300, "warning")
CONSECUTIVE_ERROR_SPIKE = Rule("ConsecutiveErrorSpike", "error_spike", 2, 120, "critical")
SERVICE_DEGRADED = Rule("ServiceDegraded", "error_ratio", 0.25, 60, "critical")
LOG_RULES = (
    HIGH_ERROR_RATE,
    CRITICAL_ERROR_RATE,
    HIGH_RESPONSE_TIME,
    CONSECUTIVE_ERROR_SPIKE,
    SERVICE_DEGRADED,
)


def _last_step(logs: DataFrame, step_s: int, ts: str = "timestamp") -> Column:
    """Step of the newest event, as a scalar subquery over the timestamp column."""
    return logs.agg(step_number(F.max(ts), step_s).alias("last")).scalar()


def _value(rule: Rule, by: str) -> Column:
    """The rule's measure at a step, null when the lookback holds no events."""

    def over(name: str, seconds: int) -> Column:
        return F.sum(name).over(trailing(by, 1 - rule.steps(seconds)))

    near = rule.lookback_s
    match rule.measure:
        case "error_ratio":
            return rates.ratio(over("errors", near), over("events", near))
        case "critical_ratio":
            return rates.ratio(over("criticals", near), over("events", near))
        case "avg_latency":
            return rates.ratio(over("latency_sum", near), over("latency_n", near))
        case "error_spike":
            # The mean of the lookback-long counts that tile the baseline span, of those that
            # exist: a tile that ended before the series began is no sample.
            since = F.floor((F.col("step") - F.col("_began")) / rule.steps(near)) + 1
            tiles = F.least(F.lit(rule.baseline_s // near), since)
            return rates.ratio(over("errors", near) * tiles, over("errors", rule.baseline_s))
    raise ValueError(f"unknown measure {rule.measure!r}")


def rule_values(
    logs: DataFrame,
    rules: Sequence[Rule],
    by: str = "service",
    keywords: Iterable[str] = fv.ERROR_KEYWORDS,
    began: DataFrame | None = None,
) -> DataFrame:
    """Grid with one value column per rule (its position in ``rules``); one pass over the log.

    All rules share a step. ``began`` (``by``, step) says when each series began, if ``logs``
    is only the tail of the log; otherwise its own first step does.
    """
    (step_s,) = {rule.step_s for rule in rules}
    counted = count_steps(
        logs,
        {
            "events": F.count(F.lit(1)),
            "errors": F.count_if(error_filter(keywords)),
            "criticals": F.count_if(F.col("log_level") == "CRITICAL"),
            "latency_sum": F.coalesce(F.sum("response_time_ms"), F.lit(0.0)),
            "latency_n": F.count("response_time_ms"),
        },
        step_s,
        by,
    )
    reach = max(rule.steps(rule.span_s) for rule in rules)
    margin = reach - 1 + max(rule.hold_steps for rule in rules)
    carried: list[str] = []
    if any(rule.measure == "error_spike" for rule in rules):
        # Joined to the counted steps, before the grid is filled.
        first = counted.groupBy(by).agg(F.min("step").alias("_began")) if began is None else began
        counted, carried = _with_start(counted, first, by), ["_began"]
    grid = fill_steps(counted, COUNTS, reach, margin, _last_step(logs, step_s), by, carried=carried)
    return grid.withColumns({f"_value{i}": _value(rule, by) for i, rule in enumerate(rules)})


def _with_start(counted: DataFrame, first: DataFrame, by: str) -> DataFrame:
    named = first.withColumnRenamed(by, "_by")
    return counted.join(named, counted[by].eqNullSafe(named["_by"])).drop("_by")


def evaluate_rules(
    logs: DataFrame,
    rules: Sequence[Rule] = LOG_RULES,
    by: str = "service",
    keywords: Iterable[str] = fv.ERROR_KEYWORDS,
    began: DataFrame | None = None,
) -> DataFrame:
    """Every step at which a rule fires: rule, severity, ``by``, evaluated_at, value, threshold."""
    values = rule_values(logs, rules, by, keywords, began)
    firing = []
    for i, rule in enumerate(rules):
        true = F.coalesce((F.col(f"_value{i}") > rule.threshold).cast("int"), F.lit(0))
        firing.append(F.sum(true).over(trailing(by, -rule.hold_steps)) == rule.hold_steps + 1)
    flags = {f"_fires{i}": fires for i, fires in enumerate(firing)}
    outcomes = F.array(
        *(
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.severity).alias("severity"),
                F.col(f"_value{i}").alias("value"),
                F.lit(float(rule.threshold)).alias("threshold"),
                F.col(f"_fires{i}").alias("firing"),
            )
            for i, rule in enumerate(rules)
        )
    )
    return (
        values.withColumns(flags)
        .where(F.col("_own") & reduce(or_, map(F.col, flags)))
        .select(by, "step", F.inline(outcomes))
        .where("firing")
        .select(
            "rule",
            "severity",
            by,
            step_time(F.col("step"), rules[0].step_s).alias("evaluated_at"),
            "value",
            "threshold",
        )
    )


def evaluate_rule(
    logs: DataFrame, rule: Rule, by: str = "service", keywords: Iterable[str] = fv.ERROR_KEYWORDS
) -> DataFrame:
    return evaluate_rules(logs, [rule], by, keywords)


def error_rate_series(
    logs: DataFrame, step_s: int = 30, lookback_s: int = 300, by: str = "service"
) -> DataFrame:
    """Error share of the trailing lookback at every step, per ``by``."""
    return _series(logs, HIGH_ERROR_RATE.scaled(step_s, lookback_s, 0), "error_rate", by)


def latency_series(
    logs: DataFrame, step_s: int = 30, lookback_s: int = 300, limit: float = fv.HIGH_LATENCY_MS
) -> DataFrame:
    """Mean latency of the trailing lookback at every step over all services."""
    rule = replace(HIGH_RESPONSE_TIME.scaled(step_s, lookback_s, 0), threshold=limit)
    everything = logs.withColumn("_all", F.lit("all"))
    return _series(everything, rule, "avg_response_time_ms", "_all").drop("_all").withColumn(
        "above_limit", F.col("avg_response_time_ms") > limit
    )


def _series(logs: DataFrame, rule: Rule, name: str, by: str) -> DataFrame:
    return (
        rule_values(logs, [rule], by)
        .where(F.col("_own") & F.col("_value0").isNotNull())
        .select(by, step_time(F.col("step"), rule.step_s).alias("evaluated_at"), F.col("_value0").alias(name))
    )


def active_alerts(
    logs: DataFrame,
    rules: Sequence[Rule] = LOG_RULES,
    by: str = "service",
    keywords: Iterable[str] = fv.ERROR_KEYWORDS,
) -> DataFrame:
    """Number of (rule, ``by``) pairs firing at the step of the newest event."""
    step_s = rules[0].step_s
    latest = step_time(_last_step(logs, step_s), step_s)
    # Nothing older can reach the last step, so the rules see the tail of the log alone.
    tail = since_newest(logs, reach_s(rules))
    began = None
    if any(rule.measure == "error_spike" for rule in rules):
        # Whether a series is younger than the baseline shows in its first event only, which takes
        # a pass over all times; on a landed log ``active_alerts_of_tail`` does without.
        first = step_number(F.min("timestamp"), step_s).alias("_began")
        began = logs.where(F.col("timestamp").isNotNull()).groupBy(by).agg(first)
    firing = evaluate_rules(tail, rules, by, keywords, began).where(F.col("evaluated_at") == latest)
    return firing.agg(F.count(F.lit(1)).alias("active_alerts"))


def reach_s(rules: Sequence[Rule]) -> int:
    """Seconds before a step that can decide what fires at it."""
    return max(rule.span_s + rule.hold_steps * rule.step_s for rule in rules)


def active_alerts_of_tail(
    tail: DataFrame,
    first: DataFrame,
    rules: Sequence[Rule] = LOG_RULES,
    by: str = "service",
    keywords: Iterable[str] = fv.ERROR_KEYWORDS,
) -> DataFrame:
    """As ``active_alerts`` from the last ``reach_s(rules)`` seconds of a log and a small table that
    says when each series began (``by``, first): the rest of the log is not needed."""
    step_s = rules[0].step_s
    latest = step_time(_last_step(tail, step_s), step_s)
    began = first.select(by, step_number(F.col("first"), step_s).alias("_began"))
    firing = evaluate_rules(tail, rules, by, keywords, began).where(F.col("evaluated_at") == latest)
    return firing.agg(F.count(F.lit(1)).alias("active_alerts"))


def since_newest(logs: DataFrame, seconds: int, ts: str = "timestamp") -> DataFrame:
    """Rows of the last ``seconds`` of the log.

    The newest timestamp is a scalar subquery over the one column. On a log landed by
    ``sinks.files.land_logs`` use ``read_landed_tail``, which reads the newest folders only.
    """
    newest = logs.agg(F.max(ts).alias("newest")).scalar()
    return logs.where(F.col(ts) > newest - F.make_dt_interval(secs=F.lit(seconds)))


def recent_events(logs: DataFrame, seconds: int = 3600) -> DataFrame:
    """Number of events in the last hour of the log."""
    return since_newest(logs, seconds).agg(F.count(F.lit(1)).alias("event_count"))


def spikes(
    logs: DataFrame,
    factor: float = fv.SPIKE_FACTOR,
    pane_s: int = 60,
    history: int = 12,
    min_history: int = 0,
    by: str = "service",
    keywords: Iterable[str] = fv.ERROR_KEYWORDS,
) -> DataFrame:
    """Panes whose errors exceed ``factor`` times the mean of the ``history`` panes before.

    Empty panes count as zero errors. With ``min_history``, only where at least so many of
    the previous panes hold events.
    """
    counted = count_steps(
        logs, {"events": F.count(F.lit(1)), "errors": F.count_if(error_filter(keywords))}, pane_s, by, closed="left"
    )
    grid = fill_steps(counted, ["events", "errors"], reach=1, margin=history, by=by)
    past = trailing(by, -history, -1)
    return (
        grid.withColumns(
            {
                "baseline": F.sum("errors").over(past) / history,
                "_seen": F.count_if(F.col("events") > 0).over(past),
            }
        )
        .where(
            F.col("_own")
            & (F.col("_seen") >= min_history)
            & (F.col("baseline") > 0)
            & (F.col("errors") > F.col("baseline") * factor)
        )
        .select(
            by,
            step_time(F.col("step"), pane_s).alias("pane_start"),
            F.col("errors").alias("error_count"),
            "baseline",
        )
    )
