"""Run registered queries and their DuckDB SQL side by side; report
row-count, column-name, column-type and order-insensitive value matches.
Doubles are compared to 6 places, or bit for bit with ``ORACLE_STRICT=1``.

    python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

STRICT = os.environ.get("ORACLE_STRICT") == "1"  # compare floats bit for bit

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "date": "DATE",
                 "binary": "BLOB"}


def spark_types(df):
    return {n: SPARK_TO_DUCK.get(t, t) for n, t in df.dtypes}


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir, names=None):
    from quarry.plans.registry import all_oracle_sql, all_queries
    qs, sqls = all_queries(), all_oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or list(qs):
        t0 = time.time()
        rec = {}
        try:
            df = qs[name](spark, sf_dir)
            srows = df.collect()
            scols = df.columns
            rec["rows"] = len(srows)
            if name in sqls:
                rel = con.sql(sqls[name])
                dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
                res = con.execute(sqls[name])
                dcols = [d[0] for d in res.description]
                drows = res.fetchall()
                st = spark_types(df)
                rec["types_match"] = st == dtypes
                if not rec["types_match"]:
                    rec["types"] = {c: (st.get(c), dtypes.get(c)) for c in set(st) | set(dtypes)
                                    if st.get(c) != dtypes.get(c)}
                rec["oracle_rows"] = len(drows)
                rec["cols_match"] = sorted(scols) == sorted(dcols)
                rec["values_match"] = rec["cols_match"] and rows_of(scols, srows) == rows_of(dcols, drows)
                if not rec["cols_match"]:
                    rec["cols"] = [scols, dcols]
                elif not rec["values_match"]:
                    a, b = rows_of(scols, srows), rows_of(dcols, drows)
                    sa, sb = set(a), set(b)
                    rec["diff"] = [repr(x)[:200] for x in list(sa - sb)[:2]] + ["|"] + \
                                  [repr(x)[:200] for x in list(sb - sa)[:2]]
            else:
                rec["oracle"] = "none"
        except Exception as e:  # noqa: BLE001
            rec["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        rec["sec"] = round(time.time() - t0, 2)
        report[name] = rec
        ok = rec.get("values_match", rec.get("oracle") == "none" and "error" not in rec) and \
            rec.get("types_match", True)
        print(("OK  " if ok else "BAD ") + name, json.dumps(rec), flush=True)
    return report


if __name__ == "__main__":
    from quarry.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8, 8)
    rep = compare(spark, sf, names)
    bad = [k for k, v in rep.items() if not v.get("values_match", v.get("oracle") == "none" and "error" not in v)
           or not v.get("types_match", True)]
    print("BAD:", bad)
