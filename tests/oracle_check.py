"""Run a registered query on Spark and its SQL formulation on DuckDB over the
same parquet folder; compare column names, row counts, types and the
order-insensitive multiset of values.

CLI:  python tests/oracle_check.py [/root/testdata/sf0.01] [key ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, Decimal):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _kind(t: str) -> str:
    t = t.upper()
    for k, names in {
        "int": ("INTEGER", "INT", "INT32"), "long": ("BIGINT", "LONG", "INT64"),
        "double": ("DOUBLE", "FLOAT64"), "string": ("VARCHAR", "STRING"), "bool": ("BOOLEAN",),
        "date": ("DATE",),
    }.items():
        if t in names:
            return k
    if t.startswith("DECIMAL"):
        return t.replace(" ", "")
    if t.startswith("TIMESTAMP"):
        return "ts"
    return t


def spark_kind(dt) -> str:
    s = dt.simpleString().upper()
    if s.startswith("DECIMAL"):
        return s.replace(" ", "")
    return _kind({"INT": "INTEGER", "BIGINT": "BIGINT", "DOUBLE": "DOUBLE", "STRING": "VARCHAR",
                  "BOOLEAN": "BOOLEAN", "DATE": "DATE"}.get(s, s))


def compare(spark, key: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[key](spark, sf_dir)
    srows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    scols = sdf.columns
    stypes = {f.name: spark_kind(f.dataType) for f in sdf.schema.fields}
    sql = E.oracle_sql().get(key)
    res = {"key": key, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    dcols = rel.columns
    dtypes = {c: _kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    drows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    res["duck_rows"] = len(drows)
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={scols} duck={dcols}")
    else:
        bad = {c: (stypes[c], dtypes[c]) for c in scols if stypes[c] != dtypes[c]}
        if bad:
            problems.append(f"types {bad}")
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        sc = Counter(tuple(r[i] for i in si) for r in srows)
        dc = Counter(tuple(r[i] for i in di) for r in drows)
        if sc != dc:
            only_s = list((sc - dc).elements())[:3]
            only_d = list((dc - sc).elements())[:3]
            problems.append(f"values differ; spark-only {only_s} duck-only {only_d}")
    res["status"] = "ok" if not problems else "FAIL"
    if problems:
        res["problems"] = problems
    return res


def main(argv):
    from replenix.session import build_session
    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv if not a.startswith("/")]
    import __spark_entry__ as E
    spark = build_session(shuffle_partitions=8)
    con = duck(sf_dir)
    keys = keys or list(E.queries())
    fails = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir, con)
        except Exception as e:  # report and go on
            r = {"key": k, "status": "ERROR", "error": repr(e)[:600]}
        fails += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{len(keys) - fails}/{len(keys)} ok")
    return fails


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
