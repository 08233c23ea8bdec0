"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import datetime as dt
import decimal
import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=_key)


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted((tuple(norm(r[i]) for i in idx) for r in cur.fetchall()), key=_key)


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE", "float": "FLOAT",
}


def type_diffs(sdf, con, sql):
    cur = con.execute(f"SELECT * FROM ({sql}) LIMIT 0")
    otypes = {d[0]: str(d[1]) for d in cur.description}
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    return {c: (t, otypes.get(c)) for c, t in stypes.items() if otypes.get(c) != t}
