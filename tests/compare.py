"""Rows of a Spark query and of its SQL in a second engine, in a form that compares."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(x):
    if isinstance(x, float):
        return ("f", round(x, 6))
    if isinstance(x, bool) or x is None or isinstance(x, str):
        return x
    if isinstance(x, int):
        return ("f", float(x)) if abs(x) < 2**53 else x
    return str(x)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in values), key=repr)


def of_spark(df):
    return sorted(df.columns), rows(df.columns, df.collect())


def of_sql(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    r = con.execute(sql)
    columns = [c[0] for c in r.description]
    return sorted(columns), rows(columns, r.fetchall())
