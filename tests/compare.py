"""Run registered queries next to their SQL in DuckDB and report differences.

``python tests/compare.py [folder] [name ...]``
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as registry  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


# Type names of Spark, as DuckDB calls them.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, connection, name: str, folder: str) -> str | None:
    """None if the query and its SQL agree, otherwise what differs."""
    df = registry.queries()[name](spark, folder)
    names, got = _sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return None if names else "no columns"
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    for name, kind in df.dtypes:
        if TYPES.get(kind) != types.get(name):
            return f"column {name} is {kind} but expected {types.get(name)}"
    expected_names, expected = _sorted_rows(columns, result.fetchall())
    if names != expected_names:
        return f"columns {names} but expected {expected_names}"
    if len(got) != len(expected):
        return f"{len(got)} rows but expected {len(expected)}"
    for one, other in zip(got, expected):
        if one != other:
            return f"row {one} but expected {other}"
    return None if got else "no rows"


if __name__ == "__main__":
    from lakeops.session import local_session

    arguments = sys.argv[1:]
    chosen_folder = arguments.pop(0) if arguments and "/" in arguments[0] else FOLDER
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    views = database(chosen_folder)
    failed = 0
    for query_name in arguments or registry.queries():
        started = time.time()
        try:
            problem = differences(session, views, query_name, chosen_folder)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{query_name:24} {time.time() - started:6.2f}s  {problem or 'ok'}", flush=True)
    sys.exit(1 if failed else 0)
