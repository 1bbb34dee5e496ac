"""Run registered queries against their SQL on the same tables.

``python -m tests.compare [sf_dir] [query …]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    shaped = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(shaped, key=lambda row: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row))


SPARK_TO_SQL = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN",
}


def difference(spark_df, connection, sql: str) -> str | None:
    """Nothing if both sides agree in columns, types and rows, else what differs."""
    relation = connection.execute(sql)
    names = [d[0] for d in relation.description]
    types = {d[0]: str(d[1]) for d in relation.description}
    expected = rows_of(names, relation.fetchall())
    ours_types = {n: SPARK_TO_SQL.get(t, t) for n, t in spark_df.dtypes}
    if ours_types != types:
        return f"types {ours_types} against {types}"
    ours = rows_of(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if len(ours) != len(expected):
        return f"{len(ours)} rows against {len(expected)}"
    for mine, theirs in zip(ours, expected):
        if mine != theirs:
            return f"row {mine} against {theirs}"
    return None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from __spark_entry__ import oracle_sql, queries
    from tallyloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark = build_session(
        "compare",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
         "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name in chosen:
        start = time.time()
        try:
            found = difference(queries()[name](spark, sf_dir), connection, oracle_sql()[name])
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failures += found is not None
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
