"""Runs registered queries and their SQL on the same tables and compares the rows."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        if isinstance(v, (bytes, bytearray)):
            return bytes(v).hex()
        return str(v)

    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, query, sql):
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    ours = canonical(df.columns, df.collect())
    result = con.execute(sql)
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}"
    different = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(different)} rows differ, first {different[0]}" if different else None
