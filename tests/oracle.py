"""Side-by-side comparison of a Spark result with DuckDB."""

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def expected(sql, sf_dir=SF_DIR):
    con = duckdb.connect()
    try:
        for name in TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
        cursor = con.execute(sql)
        return [d[0] for d in cursor.description], cursor.fetchall()
    finally:
        con.close()


def bag(columns, rows):
    """Rows as a multiset, columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(df, sql, sf_dir=SF_DIR):
    """Rows missing from and surplus in ``df``, or a column mismatch."""
    columns, rows = expected(sql, sf_dir)
    if sorted(columns) != sorted(df.columns):
        return {"columns": (sorted(columns), sorted(df.columns))}
    want, got = bag(columns, rows), bag(df.columns, df.collect())
    if want == got:
        return {}
    return {
        "rows": (sum(want.values()), sum(got.values())),
        "missing": list((want - got).items())[:3],
        "surplus": list((got - want).items())[:3],
    }
