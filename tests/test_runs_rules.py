"""Consecutive errors, grids and rules against brute force in Python."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import timedelta

import pytest
from helpers import START, as_dicts, frame, log
from pyspark.sql import functions as F

from logtide.operators import grids, rules
from logtide.operators.runs import consecutive_errors, held_gauge, slice_widths, sliced_segments


@pytest.fixture
def many_slices(spark):
    """Keep small shuffles from being merged, so that runs really cross slices."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def random_logs(seed, n=400, error_share=0.5, ties=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        service = rng.choice(["hot"] * 8 + ["a", "b"])
        at = 5.0 if ties and rng.random() < 0.5 else float(rng.randrange(2000))
        bad = rng.random() < error_share
        rows.append(log(i, at, service, "ERROR" if bad else "INFO", 500 if bad else 200))
    rng.shuffle(rows)
    return rows


def brute_runs(rows, shortest):
    runs, by = [], defaultdict(list)
    for r in rows:
        if r[1] is not None:
            by[r[2]].append(r)
    for service, members in by.items():
        members.sort(key=lambda r: (r[1], r[0]))
        current = []
        for r in members + [None]:
            if r is not None and r[8] >= 400:
                current.append(r)
                continue
            if len(current) >= shortest:
                runs.append((service, current[0][1], current[-1][1], current[0][0], current[-1][0], len(current)))
            current = []
    return sorted(runs)


@pytest.mark.parametrize(
    "seed, share, shortest, ties",
    [(1, 0.5, 3, False), (2, 0.9, 5, False), (3, 1.0, 5, False), (4, 0.6, 1, True), (5, 0.97, 2, True)],
)
def test_runs_by_brute_force(spark, many_slices, seed, share, shortest, ties):
    rows = random_logs(seed, error_share=share, ties=ties) + [log(9999, None, "hot", "ERROR", 500)]
    logs = frame(spark, rows).repartition(7)
    slices = sliced_segments(logs, F.col("status_code") >= 400, slice_rows=20).select("_slice").distinct().count()
    assert slices > 4, "a hot service has to be cut into several slices"
    found = consecutive_errors(logs, shortest, slice_rows=20).select(
        "service", "run_start", "run_end", "first_id", "last_id", "run_length"
    )
    assert sorted(map(tuple, found.collect())) == brute_runs(rows, shortest)


def test_run_over_all_slices(spark, many_slices):
    logs = frame(spark, [log(i, i, "one", "ERROR", 500) for i in range(300)]).repartition(3)
    (row,) = consecutive_errors(logs, slice_rows=20).collect()
    assert (row.first_id, row.last_id, row.run_length) == (0, 299, 300)


def test_width_of_slices(spark):
    """A hot service is cut so that no slice is too large, a burst down to a minute; small ones are not cut."""
    rows = [log(i, i * 60.0, "steady") for i in range(256)] + [log(1000 + i, i * 600.0, "small") for i in range(10)]
    rows += [log(2000 + i, i * 3600.0, None) for i in range(30)] + [log(3000 + i, 7.0, None) for i in range(40)]
    slim = frame(spark, rows).select("service", F.col("timestamp").alias("_ts"))
    found = {r["_cut"]: r["_width"] for r in slice_widths(slim, "service", 20).collect()}
    assert found == {"steady": 16, None: 1}
    logs = frame(spark, [(*r[:4], "ERROR", *r[5:8], 500) for r in rows])
    runs = {(r["service"], r["run_length"]) for r in consecutive_errors(logs, slice_rows=20).collect()}
    assert runs == {("steady", 256), ("small", 10), (None, 70)}


def test_the_log_is_shuffled_once(spark):
    """Besides the counts per service and minute, one exchange holds the rows; nothing is sampled for ranges."""
    logs = frame(spark, random_logs(1))
    plan = sliced_segments(logs, F.col("status_code") >= 400)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange " in line and "BroadcastExchange" not in line]
    assert "rangepartitioning" not in plan
    assert len([line for line in exchanges if "_slice" in line]) == 1
    # The others carry counts per key and unit, or what is made of them.
    rest = [line for line in exchanges if "_slice" not in line]
    assert rest and all(any(word in line for word in ("_cut", "_groupingexpression", "SinglePartition")) for line in rest), rest


def test_held_gauge(spark):
    values = [1, 9, 9, 9, 1, 9, 9]
    rows = [("q", START + timedelta(seconds=60 * i), i, float(v)) for i, v in enumerate(values)]
    gauge = spark.createDataFrame(rows, "q STRING, at TIMESTAMP, n BIGINT, value DOUBLE")
    found = held_gauge(gauge, 5, 120, "q", ("at", "n")).collect()
    assert [(r.first_id, r.last_id) for r in found] == [(1, 3)]


def test_step_numbers(spark):
    rows = frame(spark, [log(1, 0), log(2, 0.000001), log(3, 29.9), log(4, 30), log(5, 30.5)])
    right = grids.step_number(F.col("timestamp"), 30)
    left = grids.step_number(F.col("timestamp"), 30, "left")
    found = rows.orderBy("event_id").select(
        grids.step_time(right, 30).alias("r"), grids.step_time(left, 30).alias("l")
    ).collect()
    assert [(r.r - START).total_seconds() for r in found] == [0, 30, 30, 30, 60]
    assert [(r.l - START).total_seconds() for r in found] == [0, 0, 0, 30, 30]


@pytest.mark.parametrize("chunk, reach, margin", [(8, 3, 5), (8, 3, 8), (16, 10, 12), (64, 4, 4)])
def test_filled_grid_by_brute_force(spark, chunk, reach, margin):
    rng = random.Random(chunk + reach)
    counts = {("a", s): rng.randrange(1, 5) for s in rng.sample(range(-20, 120), 35)}
    counts |= {("b", s): 1 for s in (7, 8, 40)}
    steps = spark.createDataFrame([(k, s, n) for (k, s), n in counts.items()], "service STRING, step BIGINT, n BIGINT")
    grid = grids.fill_steps(steps, ["n"], reach, margin, F.lit(110), chunk=chunk)
    trail = F.sum("n").over(grids.trailing("service", 1 - reach))
    found = grid.withColumn("trail", trail).where("_own").select("service", "step", "n", "trail").collect()
    expected = set()
    for key in ("a", "b"):
        for step in range(-20, 111):
            window = [counts.get((key, s), 0) for s in range(step - reach + 1, step + 1)]
            if any(window):
                expected.add((key, step, counts.get((key, step), 0), sum(window)))
    assert len(found) == len(expected) and set(map(tuple, found)) == expected


def test_margin_must_fit(spark):
    steps = spark.createDataFrame([("a", 1, 1)], "service STRING, step BIGINT, n BIGINT")
    with pytest.raises(ValueError):
        grids.fill_steps(steps, ["n"], 3, 9, chunk=8)


def brute_rule(rows, rule, last):
    """(service, step) pairs at which an error-ratio or spike rule fires."""
    step, near, far = rule.step_s, rule.lookback_s, rule.baseline_s
    fired = set()
    for service in {r[2] for r in rows}:
        mine = [((r[1] - START).total_seconds(), r[8] >= 400) for r in rows if r[2] == service]

        def true_at(t):
            seen = [bad for s, bad in mine if t - near < s <= t]
            if not seen:
                return False
            if rule.measure == "error_ratio":
                return sum(seen) / len(seen) > rule.threshold
            # avg_over_time: the samples of the tiles that end after the series began.
            began = -(-min(s for s, _ in mine) // step) * step
            ends = [t - k * near for k in range(far // near) if t - k * near >= began]
            samples = [sum(bad for s, bad in mine if e - near < s <= e) for e in ends]
            return sum(samples) > 0 and sum(seen) / (sum(samples) / len(samples)) > rule.threshold

        for k in range(0, last + 1):
            if all(true_at((k - back) * step) for back in range(rule.hold_steps + 1)):
                fired.add((service, k))
    return fired


@pytest.mark.parametrize(
    "rule",
    [
        rules.HIGH_ERROR_RATE.scaled(30, 120, 90),
        rules.SERVICE_DEGRADED.scaled(30, 60, 0),
        rules.CONSECUTIVE_ERROR_SPIKE.scaled(30, 60, 45, 300),
    ],
)
def test_rules_by_brute_force(spark, rule):
    # 20000 s in 30 s steps is more than one chunk of 512 steps.
    rng = random.Random(11)
    rows = []
    for i in range(700):
        at = float(rng.choice([rng.randrange(1000), rng.randrange(14000, 20000)]))
        bad = rng.random() < (0.5 if at % 3000 < 1200 else 0.05)
        rows.append(log(i, at, rng.choice("aab"), "INFO", 500 if bad else 200))
    last = -int(-max((r[1] - START).total_seconds() for r in rows) // rule.step_s)
    found = rules.evaluate_rule(frame(spark, rows), rule)
    got = [(r["service"], round((r["evaluated_at"] - START).total_seconds() / rule.step_s)) for r in as_dicts(found)]
    expected = brute_rule(rows, rule, last)
    assert expected and len(got) == len(set(got)) and set(got) == expected
    latest = {k for _, k in expected if k == last}
    active = as_dicts(rules.active_alerts(frame(spark, rows), [rule]))[0]["active_alerts"]
    assert active == sum(1 for _, k in expected if k == last) and (latest or active == 0)


def test_rule_needs_whole_steps():
    with pytest.raises(ValueError):
        rules.HIGH_ERROR_RATE.scaled(50, 120, 60).steps(120)


def test_spikes_need_history(spark):
    rows = [log(i, i * 60, "a", "INFO", 200) for i in range(12)]
    rows += [log(100, 30, "a", "ERROR", 500)] + [log(200 + i, 600 + i, "a", "ERROR", 500) for i in range(3)]
    found = as_dicts(rules.spikes(frame(spark, rows), pane_s=60, history=10, min_history=5))
    assert [(r["pane_start"], r["error_count"], r["baseline"]) for r in found] == [
        (START + timedelta(seconds=600), 3, 0.1)
    ]


def test_spikes_have_no_gate_by_default(spark):
    rows = [log(0, 0, "a", "ERROR", 500)] + [log(10 + i, 600 + i, "a", "ERROR", 500) for i in range(3)]
    assert len(as_dicts(rules.spikes(frame(spark, rows), pane_s=60, history=10))) == 1
    assert not as_dicts(rules.spikes(frame(spark, rows), pane_s=60, history=10, min_history=5))


def test_steady_series_never_spikes_on_a_cold_start(spark):
    rule = rules.CONSECUTIVE_ERROR_SPIKE.scaled(30, 60, 30, 300)
    rows = [log(i, i * 10.0, "a", "ERROR", 500) for i in range(200)]
    assert rules.evaluate_rule(frame(spark, rows), rule).count() == 0
    assert as_dicts(rules.active_alerts(frame(spark, rows), [rule]))[0]["active_alerts"] == 0


def test_keywords_reach_rules_runs_and_spikes(spark):
    rows = [log(i, i * 10.0, "a", "INFO", 200, "kaputt") for i in range(40)]
    logs = frame(spark, rows)
    assert consecutive_errors(logs).count() == 0 and consecutive_errors(logs, keywords=["KAPUTT"]).count() == 1
    rule = rules.HIGH_ERROR_RATE.scaled(30, 60, 30)
    assert rules.evaluate_rule(logs, rule).count() == 0 < rules.evaluate_rule(logs, rule, keywords=["kaputt"]).count()
