"""Comparing a query's rows with its SQL."""


def _value(v):
    return repr(round(v, 9)) if isinstance(v, float) else repr(v)


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_value(r[c]) for c in cols) for r in df.collect())


def sql_rows(con, sql):
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted(tuple(_value(r[i]) for i in at) for r in got.fetchall())
