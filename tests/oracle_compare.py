"""Run registered queries in Spark and their SQL oracle in DuckDB, compare.

Usable from pytest and as a script:
    python tests/oracle_compare.py /root/testdata/sf0.01 [query ...]

ORACLE_PLAIN_SESSION=1 runs the queries in a plain session instead of ours
(as a caller's own session would be), with ORACLE_TZ as its time zone and
ORACLE_ANSI=false to turn ANSI mode off.
"""

from __future__ import annotations

import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v)
    if v is None:
        return "<null>"
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [columns[i] for i in order]


_DUCK_TYPE = {"StringType()": "VARCHAR", "IntegerType()": "INTEGER", "LongType()": "BIGINT",
              "DoubleType()": "DOUBLE", "BooleanType()": "BOOLEAN", "DateType()": "DATE"}


def compare(spark, sf_dir: str, names=None, con=None):
    from shopscope.plans.catalog import QUERIES
    from shopscope.plans.oracle import oracle_sql

    qs, oracle = QUERIES, oracle_sql()
    con = con or duck_connection(sf_dir)
    results = {}
    for name in names or sorted(qs):
        df = qs[name](spark, sf_dir)
        s_rows, s_cols = _rows(df.columns, [tuple(r) for r in df.collect()])
        if name not in oracle:
            results[name] = ("no-oracle", len(s_rows))
            continue
        rel = con.sql(oracle[name])
        d_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
        s_types = {f.name: _DUCK_TYPE.get(str(f.dataType), str(f.dataType)) for f in df.schema}
        d_rows, d_cols = _rows(rel.columns, rel.fetchall())
        if s_cols != d_cols:
            results[name] = ("columns", s_cols, d_cols)
        elif s_types != d_types:
            results[name] = ("types", {k: (s_types[k], d_types.get(k)) for k in s_types if s_types[k] != d_types.get(k)})
        elif s_rows != d_rows:
            diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
            results[name] = ("values", len(s_rows), len(d_rows), diff)
        else:
            results[name] = ("ok", len(s_rows))
    return results


if __name__ == "__main__":
    from shopscope.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    if os.environ.get("ORACLE_PLAIN_SESSION") == "1":
        from pyspark.sql import SparkSession

        builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config(
            "spark.ui.enabled", "false")
        if os.environ.get("ORACLE_TZ"):
            builder = builder.config("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
        if os.environ.get("ORACLE_ANSI"):
            builder = builder.config("spark.sql.ansi.enabled", os.environ["ORACLE_ANSI"])
        spark = builder.getOrCreate()
    else:
        spark = build_session("local[8]", shuffle_partitions=8, conf={"spark.sql.session.timeZone": "UTC"})
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = 0
    for k, v in res.items():
        print(k, v)
        bad += v[0] not in ("ok", "no-oracle")
    print("mismatches:", bad)
