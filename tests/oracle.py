"""Compare a registered query with its SQL on DuckDB, values exact."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dict):
        return tuple(_plain(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(con, spark_df, sql):
    """Empty string when equal, else a short description of the difference."""
    left = _sorted(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    right = _sorted([d[0] for d in cur.description], cur.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}: {left[1][:2]} {right[1][:2]}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(left[1])} rows differ, e.g. {bad[0][0]} != {bad[0][1]} (columns {left[0]})"
    kinds = [{type(v).__name__ for v in col if v is not None} for col in zip(*left[1])]
    other = [{type(v).__name__ for v in col if v is not None} for col in zip(*right[1])]
    mixed = [(n, k, o) for n, k, o in zip(left[0], kinds, other) if k != o]
    return f"types {mixed}" if mixed else ""
