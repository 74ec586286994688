"""Compare registered queries with their SQL twins in DuckDB.

usage: python tools/check.py [--sf sf0.01] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

from tideline.catalog import ORACLES, QUERIES
from tideline.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return ""
    if isinstance(value, bool) or type(value).__name__ == "bool":
        return str(bool(value))
    if isinstance(value, (int, float)) or hasattr(value, "dtype"):
        return repr(float(value))
    return str(value)


def rows(pdf: pd.DataFrame) -> list[tuple]:
    columns = sorted(pdf.columns)
    return sorted(tuple(normal(v) for v in row) for row in pdf[columns].astype(object).itertuples(index=False, name=None))


def compare(actual: pd.DataFrame, expected: pd.DataFrame) -> str:
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    a, b = rows(actual), rows(expected)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return "" if not wrong else f"{len(wrong)} of {len(a)} rows differ, e.g. {wrong[0]}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/{args.sf}"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                         "spark.driver.memory": "4g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    names = [n for n in QUERIES if not args.names or any(n == a or n.startswith(a) for a in args.names)]
    for name in names:
        start = time.time()
        try:
            actual = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name in ORACLES:
                start = time.time()
                problem = compare(actual, con.execute(ORACLES[name]).df())
                note = f"sql {time.time() - start:.1f}s"
            else:
                problem, note = "", "rows only"
            if not problem and not len(actual):
                problem = "no rows"
        except Exception as error:  # noqa: BLE001 - a report line per query
            problem, note, took, actual = f"{type(error).__name__}: {str(error)[:600]}", "", time.time() - start, []
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:38s} {len(actual):7d} rows {took:6.1f}s {note} {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} passed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
