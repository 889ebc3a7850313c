"""Run registered queries on Spark and their oracle SQL on DuckDB; compare results.

usage: python tools/oracle_check.py [sf_dir] [query ...]
Prints one line per query: rows, column names, canonical column types and an
order-insensitive value hash. SPENDLENS_EXACT=1 compares floats bit for bit (default:
rounded to 6 places); SPENDLENS_SESSION_TZ runs Spark under another session time zone;
SPENDLENS_CONF="key=value,..." sets further session settings.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from spendlens.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


EXACT = os.environ.get("SPENDLENS_EXACT") == "1"  # compare floats bit for bit


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(v) if EXACT else f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{v:f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def spark_type(t) -> str:
    """Canonical type name of a Spark field, in DuckDB spelling."""
    s = t.simpleString()
    if s.startswith("decimal"):
        return s.upper()
    return {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
            "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT", "date": "DATE",
            "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
            "boolean": "BOOLEAN", "binary": "BLOB"}.get(s, s.upper())


def types_of(spark_schema, duck_description):
    a = {f.name: spark_type(f.dataType) for f in spark_schema.fields}
    b = {d[0]: str(d[1]).upper() for d in duck_description}
    return a, b


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    import importlib
    entry = importlib.import_module("__spark_entry__")
    qs, oracles = entry.queries(), entry.oracle_sql()
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.isdir(p):  # a table written by Spark: a directory of part files
            p = p + "/*.parquet"
        if os.path.exists(p) or "*" in p:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    extra = {}
    if os.environ.get("SPENDLENS_SESSION_TZ"):  # check independence of the session zone
        extra["spark.sql.session.timeZone"] = os.environ["SPENDLENS_SESSION_TZ"]
    for item in filter(None, os.environ.get("SPENDLENS_CONF", "").split(",")):
        key, _, value = item.partition("=")  # e.g. spark.sql.ansi.enabled=false
        extra[key.strip()] = value.strip()
    spark = local_session(8, warehouse=os.environ.get("SPENDLENS_WAREHOUSE"), extra=extra)
    ok = True
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        t1 = time.time()
        if name not in oracles:
            print(f"{name:28s} spark_rows={len(rows):7d} (no oracle) {t1-t0:.1f}s")
            continue
        res = con.execute(oracles[name])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ta, tb = types_of(df.schema, res.description)
        types_ok = ta == tb
        same = (len(rows) == len(orows) and sorted(cols) == sorted(ocols) and h1 == h2
                and types_ok)
        ok &= same
        print(f"{name:28s} rows={len(rows):7d}/{len(orows):7d} cols={'ok' if sorted(cols)==sorted(ocols) else 'DIFF'} "
              f"types={'ok' if types_ok else 'DIFF'} hash={'ok' if h1 == h2 else 'DIFF'} {t1-t0:.1f}s",
              flush=True)
        if not types_ok:
            print("   types:", {k: (ta.get(k), tb.get(k)) for k in set(ta) | set(tb)
                              if ta.get(k) != tb.get(k)})
        if not same:
            print("   spark cols:", sorted(cols))
            print("   duck  cols:", sorted(ocols))
            a, b = set(l1), set(l2)
            for x in sorted(a - b)[:3]:
                print("   only spark:", x)
            for x in sorted(b - a)[:3]:
                print("   only duck :", x)
    spark.stop()
    print(f"{'all match' if ok else 'MISMATCHES'}: {len(qs) if not only else len(only)} "
          f"queries at {sf_dir}{' (exact floats)' if EXACT else ''}")
    sys.exit(0 if ok else 1)


if __name__ == "__main__":
    main()
