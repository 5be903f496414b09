"""Run registered queries next to their oracle SQL and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KIND = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN"}


def difference(df, connection, sql: str) -> str | None:
    """None when both sides agree on columns, types and every value."""
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = _rows(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    for name, kind in df.dtypes:
        if KIND.get(kind) != types[name]:
            return f"type of {name}: {kind} != {types[name]}"
    actual = _rows(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{a} != {e}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from wardlens.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for key, query in entry.queries().items():
        if only and key not in only:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problem = difference(df, connection, oracle[key]) if key in oracle else None
            rows = "" if key in oracle else f" rows={df.count()} (no oracle)"
        except Exception as error:  # report and go on
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {key} {time.time() - start:.2f}s{rows} {problem or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
