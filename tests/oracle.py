"""Run registered queries against their SQL: ``python -m tests.oracle <sf_dir> [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def kind(name: str) -> str:
    """One name for a type in both engines."""
    fixed = {"string": "VARCHAR", "long": "BIGINT", "integer": "INTEGER", "double": "DOUBLE"}
    return fixed.get(name, name.upper())


def sort_key(row):
    return tuple((value is not None, value) for value in row)


def compare(spark, db, sf_dir: str, query, sql: str) -> str | None:
    """What differs between the two results, or None."""
    frame = query(spark, sf_dir)
    columns = sorted(frame.columns)
    relation = db.sql(sql)
    if columns != sorted(relation.columns):
        return f"columns {columns} != {sorted(relation.columns)}"
    types = dict(zip(relation.columns, (str(t) for t in relation.types)))
    ours = {field.name: kind(field.dataType.typeName()) for field in frame.schema}
    if ours != types:
        return f"types {ours} != {types}"
    left = sorted((tuple(row) for row in frame.select(*columns).collect()), key=sort_key)
    right = sorted(db.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall(), key=sort_key)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    if not left:
        return "no rows"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str, *names: str) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    spark = make_session()
    db, sqls, failures = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        began = time.time()
        problem = compare(spark, db, sf_dir, query, sqls[name]) if name in sqls else "no SQL"
        failures += problem is not None
        print(f"{'ok' if problem is None else 'FAIL':4} {name:28} {time.time() - began:6.2f}s {problem or ''}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
