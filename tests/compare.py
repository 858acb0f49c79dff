"""Order-free comparison of a Spark result with DuckDB's, by column name."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    return value


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides have the same columns, types and rows."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = _bag(names, cursor.fetchall())
    found = _bag(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} against {sorted(names)}")
        return problems
    for name, kind in df.dtypes:
        if _SAME_TYPE.get(kind) != types[name]:
            problems.append(f"type of {name}: {kind} against {types[name]}")
    if sum(found.values()) != sum(expected.values()):
        problems.append(f"{sum(found.values())} rows against {sum(expected.values())}")
    extra, lacking = found - expected, expected - found
    if extra or lacking:
        problems.append(f"only here {list(extra)[:3]}, only there {list(lacking)[:3]}")
    return problems
