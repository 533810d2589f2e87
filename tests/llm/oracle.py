"""Comparison of a Spark result with the registered SQL, run on the same rows."""

import duckdb


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def by_sql(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        frame = df.toArrow()
        con.register(f"_{name}", frame)
        con.execute(f"create table {name} as select * from _{name}")
    res = con.execute(sql)
    return sorted(d[0] for d in res.description), rows_of([d[0] for d in res.description], res.fetchall())


def by_spark(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])
