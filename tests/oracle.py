"""Side-by-side comparison of the registered queries with their SQL in DuckDB.

Run as a script for a report: ``python tests/oracle.py [folder] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def canonical(value):
    """Same value, same text, whatever the engine's Python type."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(canonical(row[n]) for n in names) for row in df.collect())


def duck_rows(db, sql):
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = sorted(tuple(canonical(row[i]) for i in order) for row in result.fetchall())
    return [names[i] for i in order], rows


def compare(spark, db, folder, name):
    """Problem text, or None when both sides agree; and the number of rows."""
    left_names, left = spark_rows(queries()[name](spark, folder))
    right_names, right = duck_rows(db, oracle_sql()[name])
    if left_names != right_names:
        return f"columns {left_names} != {right_names}", len(left)
    if left != right:
        ours, theirs = set(left) - set(right), set(right) - set(left)
        return f"{len(left)} vs {len(right)} rows; ours {sorted(ours)[:2]} theirs {sorted(theirs)[:2]}", len(left)
    return None, len(left)


def main() -> int:
    from conftest import make_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, db, bad = make_session(), connect(folder), 0
    for name in sys.argv[2:] or queries():
        began = time.time()
        if name in oracle_sql():
            try:
                problem, rows = compare(spark, db, folder, name)
            except Exception as failure:  # report and go on with the next query
                problem, rows = str(failure)[:500], -1
        else:
            problem, rows = None, queries()[name](spark, folder).count()
        bad += problem is not None
        checked = "rows only" if name not in oracle_sql() else problem or "equal"
        print(f"{name:32s} {rows:8d} {time.time() - began:6.2f}s {checked}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
