"""Run a registered Spark query and its DuckDB twin; compare row count,
column names and the multiset of row values (columns sorted by name)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

import duckdb
import numpy as np
import pandas as pd

from slawatch.sources.testdata import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if v is pd.NaT:
        return None
    if isinstance(v, (np.floating, float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_,)):
        return bool(v)
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).to_pydatetime() if v.tzinfo else v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(pdf: pd.DataFrame) -> Counter:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object)
    return Counter(tuple(_norm(v) for v in row) for row in pdf.itertuples(index=False, name=None))


#: One name per kind of value in both engines.
KINDS = {"string": "text", "VARCHAR": "text", "bigint": "long", "BIGINT": "long", "int": "int", "INTEGER": "int",
         "double": "double", "DOUBLE": "double", "boolean": "flag", "BOOLEAN": "flag", "date": "date", "DATE": "date",
         "timestamp": "time", "timestamp_ntz": "time", "TIMESTAMP": "time"}


def _kind(name: str) -> str:
    return KINDS.get(name, name)


def compare(spark, name: str, sf_dir: str, fn, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    rows = sdf.collect()
    s_pdf = pd.DataFrame([r.asDict(recursive=True) for r in rows], columns=sdf.columns)
    t1 = time.time()
    kinds = {f.name: _kind(f.dataType.simpleString()) for f in sdf.schema.fields}
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    described = cur.description
    d_pdf = pd.DataFrame(cur.fetchall(), columns=d_cols)
    t2 = time.time()
    res = {"name": name, "spark_rows": len(s_pdf), "duck_rows": len(d_pdf),
           "spark_sec": round(t1 - t0, 2), "duck_sec": round(t2 - t1, 2)}
    res["cols_match"] = sorted(s_pdf.columns) == sorted(d_pdf.columns)
    if not res["cols_match"]:
        res["spark_cols"] = sorted(s_pdf.columns)
        res["duck_cols"] = sorted(d_pdf.columns)
        res["match"] = False
        return res
    res["types_match"] = kinds == {d[0]: _kind(str(d[1])) for d in described}
    a, b = rows_of(s_pdf), rows_of(d_pdf)
    res["match"] = a == b and res["types_match"]
    if not res["types_match"]:
        res["types"] = (kinds, {d[0]: str(d[1]) for d in described})
    if not res["match"]:
        res["only_spark"] = list((a - b).elements())[:3]
        res["only_duck"] = list((b - a).elements())[:3]
    return res


def main(argv: list[str]) -> int:
    from slawatch.plans.catalog import ORACLE, QUERIES
    from slawatch.session import build_session

    sf_dir = "/root/testdata/sf0.01"
    names = argv or sorted(ORACLE)
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.ui.showConsoleProgress": "false"})
    con = duck(sf_dir)
    bad = 0
    for n in names:
        if n not in ORACLE:
            print(n, "no oracle")
            continue
        try:
            r = compare(spark, n, sf_dir, QUERIES[n], ORACLE[n], con)
        except Exception as e:  # report and go on
            r = {"name": n, "match": False, "error": repr(e)[:500]}
        bad += not r["match"]
        print(r, flush=True)
    print("mismatches:", bad, "of", len(names))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
