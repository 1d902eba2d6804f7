"""Run a query and its oracle on the same tables and compare rows as multisets."""

from __future__ import annotations

import time
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.sql(f"create view {file.stem} as select * from '{file}'")
    return db


def _rows(table, names) -> list[tuple]:
    columns = [table.column(n).to_pylist() for n in names]
    return [tuple(_plain(v) for v in row) for row in zip(*columns)]


def _plain(v):
    if isinstance(v, float):
        return "nan" if v != v else v + 0.0
    return tuple(map(_plain, v)) if isinstance(v, list) else v


# Spark type and the DuckDB type with the same values.
_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT",
}


def compare(df, sql: str | None, db) -> dict:
    """Row counts, type differences and sample rows that only one side has."""
    start = time.time()
    got = df.toArrow()
    report = {"seconds": round(time.time() - start, 2), "rows": got.num_rows, "ok": got.num_rows > 0}
    if sql is None:
        return report
    relation = db.sql(sql)
    names = sorted(relation.columns)
    if sorted(df.columns) != names:
        return report | {"ok": False, "columns": sorted(set(df.columns) ^ set(names))}
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    types = {f.name: (f.dataType.simpleString(), kinds[f.name]) for f in df.schema
             if _TYPES.get(f.dataType.simpleString(), "?") != kinds[f.name]}
    want = relation.to_arrow_table() if hasattr(relation, "to_arrow_table") else relation.arrow()
    a, b = Counter(_rows(got, names)), Counter(_rows(want, names))
    extra, missing = list((a - b).elements()), list((b - a).elements())
    key = lambda r: tuple(map(str, r))
    report |= {
        "expected": want.num_rows, "types": types, "extra": len(extra), "missing": len(missing), "names": names,
        "sample": (sorted(extra, key=key)[:3], sorted(missing, key=key)[:3]),
    }
    report["ok"] = not extra and not missing and not types and got.num_rows > 0
    return report
