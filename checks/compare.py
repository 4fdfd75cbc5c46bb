"""Run a query on Spark and its SQL on DuckDB over the same files and compare all rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


# The types the registered queries return, by engine.
SAME_TYPE = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def type_differences(spark_types: dict[str, str], relation: duckdb.DuckDBPyRelation) -> list[str]:
    theirs = dict(zip(relation.columns, map(str, relation.types), strict=True))
    return [
        f"{name}: {kind} and {theirs.get(name)}"
        for name, kind in spark_types.items()
        if SAME_TYPE.get(kind) != theirs.get(name)
    ]


def _rows(frame: pd.DataFrame) -> list[str]:
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(repr(tuple(_plain(v) for v in row)) for row in plain.itertuples(index=False))


def _plain(value):
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    value = value.item() if hasattr(value, "item") else value
    # A whole-number column with nulls is floating in one frame and not in the other.
    return int(value) if isinstance(value, float) and value.is_integer() else value


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> list[str]:
    """What differs: columns first, then up to a few rows of each side."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return [f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"]
    left, right = _rows(ours), _rows(theirs)
    if left == right:
        return []
    only_left = sorted(set(left) - set(right))[:3]
    only_right = sorted(set(right) - set(left))[:3]
    return [f"{len(left)} and {len(right)} rows", *only_left, "--", *only_right]
