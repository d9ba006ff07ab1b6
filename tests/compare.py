"""Run a registered query and its SQL twin on the same tables and compare them."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_cell(r[i]) for i in order] for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
}


def difference(spark, con, query, sql, sf_dir) -> str | None:
    """None when both agree, else what differs first."""
    df = query(spark, sf_dir)
    got = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for f in df.schema.fields:
        if SPARK_TYPES.get(types[f.name]) != f.dataType.simpleString():
            return f"type of {f.name}: {f.dataType.simpleString()} != {types[f.name]}"
    a, b = _rows(df.columns, got), _rows(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ; columns {sorted(names)}; first {bad[0][0]} != {bad[0][1]}"
    return f"empty result" if not a else None
