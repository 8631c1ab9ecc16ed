"""Compare a query with DuckDB SQL over the same tables."""

import os

import duckdb

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for name in NAMES:
        path = f"{folder}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def normal(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return v.isoformat() if hasattr(v, "isoformat") else v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def differences(df, sql, con):
    """None if equal, else what differs."""
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    theirs = rows_of([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if mine[1] == theirs[1]:
        return None
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows != {len(theirs[1])}"
    return next(f"{a} != {b}" for a, b in zip(mine[1], theirs[1], strict=True) if a != b)
