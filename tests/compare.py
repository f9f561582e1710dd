"""Compare registered queries with their SQL in DuckDB: columns, types, row count and values."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, repr(0.0 if v == 0 else v) if not math.isnan(v) else "nan")
    if isinstance(v, datetime.datetime):
        return (1, v.replace(tzinfo=None).isoformat())
    return (1, str(v))


def normal(rows, order):
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql):
    """A list of complaints, empty when both sides agree."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]) for d in found.description}
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind.upper()) != kinds[name]:
            out.append(f"{name}: {kind} != {kinds[name]}")
    theirs = normal(found.fetchall(), [names.index(n) for n in sorted(names)])
    rows = df.collect()
    ours = normal(rows, [df.columns.index(n) for n in sorted(df.columns)])
    if len(ours) != len(theirs):
        out.append(f"{len(ours)} rows != {len(theirs)}")
    elif ours != theirs:
        bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
        out.append(f"{len(bad)} of {len(ours)} rows differ, first {bad[0]}")
    return out
