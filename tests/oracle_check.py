"""Run checked queries in Spark and their SQL in DuckDB; compare results.

Comparison: column names (sorted), row count, and the multiset of rows with
columns in name order.  Usable from pytest and as a script::

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(t[i]) for i in order) for t in tuples)


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con=None) -> dict:
    df = query(spark, sf_dir)
    s_names = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"name": name, "spark_rows": len(s_rows)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_names = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    if sorted(s_names) != sorted(d_names):
        out["status"] = f"columns differ: spark-only={sorted(set(s_names) - set(d_names))} " \
                        f"oracle-only={sorted(set(d_names) - set(s_names))}"
        return out
    a, b = rows_of(s_names, s_rows), rows_of(d_names, d_rows)
    types = type_mismatches(df, res.description)
    if types:
        out["status"] = f"types differ: {types}"
    elif a == b:
        out["status"] = "match"
    else:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        out["status"] = f"values differ: spark-only={only_s} oracle-only={only_d}"
    return out


def main(argv):
    import __spark_entry__ as e
    from stratum.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session(8)
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names or list(qs):
        try:
            r = compare(spark, sf_dir, n, qs[n], sqls.get(n), con)
        except Exception as ex:  # report and go on
            r = {"name": n, "status": f"error: {type(ex).__name__}: {str(ex)[:400]}"}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    return bad



SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "smallint": "SMALLINT", "float": "FLOAT"}


def type_mismatches(df, description) -> list:
    """Columns whose Spark type does not map to the DuckDB result type."""
    duck_types = {c[0]: str(c[1]).upper() for c in description}
    bad = []
    for f in df.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        got = duck_types.get(f.name)
        if got is not None and got != want:
            bad.append((f.name, f.dataType.simpleString(), got))
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
