"""Spark result vs DuckDB oracle: column names plus an order-insensitive
hash of the values (columns sorted by name)."""

import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), len(lines)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN"}


def compare(spark_df, con, sql):
    s_types = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in spark_df.schema.fields}
    d_types = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    assert s_types == d_types, (s_types, d_types)
    s_cols, s_rows = spark_df.columns, [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols, d_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols), (s_cols, d_cols)
    assert digest(s_cols, s_rows) == digest(d_cols, d_rows)
    return len(s_rows)
