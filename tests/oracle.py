"""Holds a registered query against its SQL in DuckDB."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def same(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = query(spark, sf_dir)
    got = df.select(*sorted(df.columns)).collect()
    ran = con.execute(sql)
    names = [d[0] for d in ran.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert [names[i] for i in order] == sorted(df.columns)
    key = lambda row: tuple((v is None, str(v)) for v in row)
    want = sorted((tuple(r[i] for i in order) for r in ran.fetchall()), key=key)
    assert sorted((tuple(r) for r in got), key=key) == want
    return len(want)
