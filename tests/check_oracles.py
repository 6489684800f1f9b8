"""Run registered queries next to their DuckDB oracles: ``python tests/check_oracles.py <sf_dir> [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
import numpy as np
import pandas as pd

import __spark_entry__ as entry
from lexmill.session import local_session


def canonical(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(canonical(item) for item in value)
    if isinstance(value, float):
        return None if value != value else repr(value)
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    if isinstance(value, (int, np.integer)):
        return int(value)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    return sorted((tuple(canonical(row[index]) for index in order) for row in rows), key=repr)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def compare(spark, connection, sf_dir: str, name: str) -> str:
    """``ok``, ``rows only`` or a description of the first difference."""
    frame = entry.queries()[name](spark, sf_dir)
    mine = rows_of(frame.columns, frame.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows only {len(mine)}"
    cursor = connection.execute(sql)
    columns = [column[0] for column in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    if mine == theirs:
        return f"ok {len(mine)}"
    extra = [row for row in mine if row not in set(theirs)][:2] if len(mine) < 100000 else []
    lacking = [row for row in theirs if row not in set(mine)][:2] if len(theirs) < 100000 else []
    return f"DIFFERENT {len(mine)} against {len(theirs)} rows\n  mine {str(extra)[:600]}\n  oracle {str(lacking)[:600]}"


if __name__ == "__main__":
    spark = local_session("check")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = sys.argv[1]
    connection = duck(sf_dir)
    for name in sys.argv[2:] or entry.queries():
        started = time.time()
        try:
            outcome = compare(spark, connection, sf_dir, name)
        except Exception as problem:  # report and go on with the next query
            outcome = f"FAILED {type(problem).__name__} {str(problem)[:700]}"
        print(f"{name} {time.time() - started:.1f}s {outcome}", flush=True)
