"""Run catalogue queries and their plain SQL side by side."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of_sql(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    return names, types, cur.fetchall()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, query, folder: str) -> str | None:
    """None when both agree, else what differs."""
    df = query.run(spark, folder)
    got = [tuple(r) for r in df.collect()]
    names, types, want = rows_of_sql(con, query.sql)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}
    for name, kind in df.dtypes:
        if kinds.get(kind) != types[name]:
            return f"type of {name}: {kind} vs {types[name]}"
    a, b = canonical(df.columns, got), canonical(names, want)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}: {[x for x in a if x not in set(b)][:2]} / {[x for x in b if x not in set(a)][:2]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, columns {sorted(names)}, first {bad[0]}" if bad else None
