"""Compare a Spark result with a duckdb result, whatever the order of rows and columns."""

import math

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_views(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return [(v is None, str(type(v)), v if v is not None else 0) for v in row]


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=_key)


def assert_same(df, con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {name: TYPES[t] for name, t in df.dtypes}
    assert types == {d[0]: str(d[1]) for d in result.description}
    expected = _rows(columns, result.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(actual) == len(expected)
    for mine, theirs in zip(actual, expected, strict=True):
        for a, b in zip(mine, theirs, strict=True):
            assert type(a) is type(b), (mine, theirs)
            same = a == b or (isinstance(a, float) and math.isnan(a) and math.isnan(b))
            assert same, (mine, theirs)
    return len(actual)
