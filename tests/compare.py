"""Strict comparison of a Spark result with the oracle's, as sorted typed rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

#: Spark type -> oracle type
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _rows(rows, order):
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(df, con, sql: str) -> list[str]:
    """Empty when row count, column names, types and all values agree."""
    relation = con.sql(sql)
    want_names, want_types = list(relation.columns), [str(t) for t in relation.types]
    got = dict(df.dtypes)
    problems = []
    if sorted(got) != sorted(want_names):
        return [f"columns {sorted(set(got) ^ set(want_names))}"]
    for name, kind in zip(want_names, want_types):
        if TYPES.get(got[name]) != kind:
            problems.append(f"type of {name}: {got[name]} / {kind}")
    names = sorted(want_names)
    spark_rows = _rows([tuple(r) for r in df.collect()], [df.columns.index(n) for n in names])
    oracle_rows = _rows(relation.fetchall(), [want_names.index(n) for n in names])
    if len(spark_rows) != len(oracle_rows):
        problems.append(f"rows {len(spark_rows)} / {len(oracle_rows)}")
    bad = [(a, b) for a, b in zip(spark_rows, oracle_rows) if a != b]
    if bad:
        a, b = bad[0]
        cells = [f"{n}: {x!r} / {y!r}" for n, x, y in zip(names, a, b) if x != y]
        problems.append(f"{len(bad)} rows differ, first: " + ", ".join(cells[:6]))
    return problems
