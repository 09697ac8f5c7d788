"""Run a registered query on Spark and its oracle SQL on DuckDB, compare.

Comparison as the driver does it: row count, column names and types, and an
order-insensitive hash of the values with columns sorted by name.
"""

from __future__ import annotations

import collections
import datetime as dt
import math
import sys

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

_TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
             "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, sf_dir: str, query, sql: str | None, con=None) -> dict:
    con = con or duck(sf_dir)
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_types = [_TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    res = {"query": name, "spark_rows": len(s_rows)}
    if sql is None:
        res["oracle"] = "none"
        return res
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    d_types = [str(t) for t in con.execute(f"DESCRIBE ({sql})").fetchall() for t in [t[1]]]
    res["oracle_rows"] = len(d_rows)
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    res["types_match"] = sorted(zip(s_cols, s_types)) == sorted(zip(d_cols, d_types))
    if not res["types_match"]:
        res["spark_types"] = sorted(zip(s_cols, s_types))
        res["oracle_types"] = sorted(zip(d_cols, d_types))
    sc, dc = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["values_match"] = sc == dc
    if not res["values_match"]:
        res["only_spark"] = list((sc - dc).items())[:3]
        res["only_oracle"] = list((dc - sc).items())[:3]
    res["ok"] = res["cols_match"] and res["types_match"] and res["values_match"] \
        and len(s_rows) == len(d_rows)
    return res


def main(argv):
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from shoal.session import build_session
    from shoal.plans.catalog import REGISTRY
    from shoal.plans.oracle import SQL
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = argv or sorted(REGISTRY)
    if os.environ.get("PLAIN_SESSION"):
        # a bare session like the driver's: none of the library defaults
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
                 .getOrCreate())
    else:
        spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, REGISTRY[n], SQL.get(n), con)
        except Exception as e:  # report and continue
            r = {"query": n, "error": repr(e)[:600]}
        ok = r.get("ok", r.get("oracle") == "none")
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])
