"""Compare registered queries with their SQL on the same parquet tables."""

from __future__ import annotations

import math
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat()
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark, query, sql: str | None, sf_dir: str, connection=None) -> tuple[bool, str]:
    start = time.time()
    frame = query(spark, sf_dir)
    got_columns, got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    seconds = time.time() - start
    if sql is None:
        return True, f"rows-only {len(got)} rows {seconds:.1f}s"
    cursor = (connection or duck(sf_dir)).execute(sql)
    want_columns, want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}"
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        return False, f"{len(got)} rows vs {len(want)}; {got_columns}\n   spark only {only_got}\n   sql only   {only_want}"
    return True, f"{len(got)} rows {seconds:.1f}s"
