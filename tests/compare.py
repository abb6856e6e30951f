"""Compare a Spark result with a DuckDB oracle: column names, types, row
count and an order-insensitive multiset of exact values. Test support only;
the DuckDB side runs in the local Python process on the same Parquet files."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

_SPARK_TO_DUCK = {
    T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.ShortType: "SMALLINT",
    T.DoubleType: "DOUBLE", T.FloatType: "FLOAT", T.StringType: "VARCHAR",
    T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP",
    T.TimestampType: "TIMESTAMP WITH TIME ZONE",
}


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return ("f", repr(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if v is None:
        return ("null", "")
    return (type(v).__name__, str(v))


def spark_types(df: DataFrame) -> dict[str, str]:
    return {f.name: _SPARK_TO_DUCK.get(type(f.dataType), f.dataType.simpleString())
            for f in df.schema.fields}


def compare(df: DataFrame, con, sql: str, ordered: bool = False) -> list[str]:
    """Return a list of mismatch descriptions (empty when equal). With
    ``ordered`` the rows must also come in the same order."""
    problems = []
    rel = con.sql(sql)
    duck_cols = rel.columns
    duck_types = {c: str(t) for c, t in zip(duck_cols, rel.types)}
    duck_rows = rel.fetchall()
    s_types = spark_types(df)
    if sorted(s_types) != sorted(duck_cols):
        return [f"columns differ: spark={sorted(s_types)} oracle={sorted(duck_cols)}"]
    for c in duck_cols:
        if s_types[c] != duck_types[c]:
            problems.append(f"type of {c}: spark={s_types[c]} oracle={duck_types[c]}")
    names = sorted(duck_cols)
    spark_rows = [tuple(_norm(r[c]) for c in names) for r in df.collect()]
    idx = [duck_cols.index(c) for c in names]
    oracle_rows = [tuple(_norm(r[i]) for i in idx) for r in duck_rows]
    if len(spark_rows) != len(oracle_rows):
        problems.append(f"row count: spark={len(spark_rows)} oracle={len(oracle_rows)}")
    elif sorted(spark_rows) != sorted(oracle_rows):
        extra = list((Counter(spark_rows) - Counter(oracle_rows)).elements())[:3]
        missing = list((Counter(oracle_rows) - Counter(spark_rows)).elements())[:3]
        problems.append(f"values differ: spark has {extra}, oracle has {missing}")
    elif ordered and spark_rows != oracle_rows:
        problems.append("same rows, different order")
    return problems
