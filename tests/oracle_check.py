"""Compare a registered Spark query with its DuckDB SQL: row count, column names,
and an order-insensitive multiset of rows (doubles compared after rounding to 9 digits)."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return v


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(_norm(x) for x in r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if out["columns_match"]:
        order = [d_cols.index(c) for c in s_cols]
        d_rows = [tuple(r[i] for i in order) for r in d_rows]
        sc, dc = Counter(s_rows), Counter(d_rows)
        out["values_match"] = sc == dc
        if sc != dc:
            out["only_spark"] = list((sc - dc).elements())[:3]
            out["only_oracle"] = list((dc - sc).elements())[:3]
    else:
        out["values_match"] = False
        out["spark_columns"], out["oracle_columns"] = s_cols, d_cols
    return out
