"""Compare a Spark result with a DuckDB result: columns by name, rows in any order."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows), key=repr
    )


def differences(frame, con, sql, limit=3):
    """An empty list when both sides agree."""
    got_columns, got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    relation = con.sql(sql)
    want_columns, want = canonical(relation.columns, relation.fetchall())
    if got_columns != want_columns:
        return [f"columns {got_columns} != {want_columns}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}"]
    return [f"{g} != {w}" for g, w in zip(got, want) if repr(g) != repr(w)][:limit]
