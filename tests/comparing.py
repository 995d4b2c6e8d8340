"""Comparison of a query's rows with those of its SQL."""

import math


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return str([normal(v) for v in value])
    return str(value)


def rows_of(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(normal(r[n]) for n in names) for r in frame.collect())


def rows_of_sql(database, sql):
    result = database.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    return names, sorted(tuple(normal(r[columns.index(n)]) for n in names) for r in result.fetchall())
