"""Run registered queries beside their SQL twins in DuckDB.

As a script: ``python tests/compare.py <sf_dir> [name ...]``.
"""

from __future__ import annotations

import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of text, columns by name."""
    frame = frame[sorted(frame.columns)]

    def text(value) -> str:
        if value is None or value is pd.NaT or (isinstance(value, float) and np.isnan(value)) or value is pd.NA:
            return "<null>"
        if isinstance(value, (bool, np.bool_)):
            return str(bool(value))
        if isinstance(value, (int, np.integer, float, np.floating)):
            return repr(round(float(value), 9) + 0.0)
        if isinstance(value, (pd.Timestamp, np.datetime64)):
            return pd.Timestamp(value).isoformat()
        return str(value)

    return sorted(tuple(text(v) for v in row) for row in frame.itertuples(index=False, name=None))


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    left, right = canonical(got), canonical(want)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as contract
    from kerbside.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, bad = connect(sf_dir), contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            got = run(spark, sf_dir).toPandas()
            took = time.time() - started
            verdict = None
            if name in oracles:
                verdict = difference(got, connection.execute(oracles[name]).fetchdf())
            elif not len(got):
                verdict = "no rows"
        except Exception as error:  # report and go on
            verdict, got, took = f"{type(error).__name__}: {str(error)[:600]}", [], time.time() - started
        bad += verdict is not None
        mark = "ok" if verdict is None else "BAD"
        print(f"{mark:4}{name:28}{len(got):8} rows {took:6.1f} s  {'' if name in oracles else '(no twin) '}{verdict or ''}", flush=True)
    print(f"{bad} bad", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
