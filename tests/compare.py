"""Run registered queries beside their SQL and compare the results.

``python -m tests.compare [name ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

FOLDER = os.environ.get("COMPARE_SF_DIR", "/root/testdata/sf0.01")


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .appName("tracewright-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def _same(a, b) -> bool:
    return type(a) is type(b) and a == b


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def difference(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a query's result and its SQL, or None."""
    columns = sorted(result.columns)
    found = sorted((tuple(r) for r in result.select(*columns).collect()), key=_key)
    relation = connection.execute(sql)
    names = [d[0] for d in relation.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    declared = {d[0]: str(d[1]) for d in relation.description}
    for column, spark_type in result.select(*columns).dtypes:
        if TYPES.get(spark_type) != declared[column]:
            return f"{column} is {spark_type} against {declared[column]}"
    wanted = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=_key)
    if len(found) != len(wanted):
        return f"{len(found)} rows against {len(wanted)}"
    for a, b in zip(found, wanted):
        if not all(_same(x, y) for x, y in zip(a, b)):
            return f"{columns}: {a} against {b}"
    return None if found else "no rows"


def main(names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    spark, connection = session(), duck(FOLDER)
    spark.sparkContext.setLogLevel("ERROR")
    registered, oracles = queries(), oracle_sql()
    failures = 0
    for name in names or registered:
        started = time.time()
        try:
            result = registered[name](spark, FOLDER)
            if name in oracles:
                problem = difference(result, connection, oracles[name])
            else:
                rows = len(result.collect())
                problem = None if rows else "no rows"
        except Exception as exc:  # noqa: BLE001
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        failures += problem is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{name:28} {kind:4} {time.time() - started:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{failures} failed")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
