"""Registered queries: equality with their SQL, and the shape of their plans."""

from __future__ import annotations

import os

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from logtide.plans.catalog import QUERIES
from logtide.plans.oracles import ORACLES

FOLDER = f"/root/testdata/{os.environ.get('ORACLE_SF', 'sf0.001')}"
BATCH = [name for name in QUERIES if not name.startswith("stream_") and not name.endswith("_roundtrip")]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, db, name):
    problem, _ = compare(spark, db, FOLDER, name)
    assert problem is None


def test_rows_only_queries_run(spark):
    rest = set(QUERIES) - set(ORACLES)
    assert rest == {"generated_logs"}
    for name in rest:
        assert queries()[name](spark, FOLDER).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n.endswith("_dirty")))
def test_gaps_matter(db, name):
    """The SQL over records with gaps gives other rows than its twin over clean ones."""
    twin = {"error_flag_dirty": "error_flag_record", "window_anomalies_dirty": "window_anomalies_all_events"}
    clean = twin.get(name, name.removesuffix("_dirty"))
    assert sorted(map(str, db.execute(ORACLES[name]).fetchall())) != sorted(map(str, db.execute(ORACLES[clean]).fetchall()))


def test_entry(spark):
    alerts = entry(spark)
    assert alerts.columns[:3] == ["window_start", "window_end", "service"] and alerts.count() > 0


@pytest.mark.parametrize("name", BATCH)
def test_plan_stays_in_the_engine(spark, name):
    """No Python in the plan, no product of two tables, only the needed columns read."""
    plan = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate[^(]*collect_set"):
        assert word not in plan, word
    assert "props" not in plan


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("service_metrics_tumbling", 1),
        ("window_alerts", 1),
        ("service_metrics_sliding", 2),
        ("status_metrics", 2),
        ("service_profile", 2),
        ("overall_stats", 1),
        ("null_report", 1),
        ("filter_errors", 0),
        ("record_alerts", 0),
        ("consecutive_errors", 7),  # the log once; the others hold counts, widths (one is a broadcast) and segments
        ("rule_high_error_rate", 2),
        ("spikes", 2),
    ],
)
def test_number_of_shuffles(spark, name, shuffles):
    plan = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    main = [line for line in plan.splitlines() if "Exchange " in line and "Subquery" not in line]
    subquery = [line for line in main if "SinglePartition" in line and name.startswith("rule")]
    assert len(main) - len(subquery) == shuffles, plan
