"""Run registered queries in Spark and their DuckDB oracle side by side.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Compares row count, column names and the multiset of rows (exactly, and
with floats rounded to 9 significant digits as a fallback diagnosis).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, approx: bool):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        if approx:
            return (1, float(f"{v:.9g}"))
        return (1, v)
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), approx)
    if isinstance(v, (bytes, bytearray, memoryview)):
        return (1, bytes(v).decode("utf-8", "replace"))
    if isinstance(v, dt.datetime):
        return (1, v.isoformat())
    if isinstance(v, dt.date):
        return (1, v.isoformat())
    if isinstance(v, bool):
        return (1, int(v))
    return (1, v)


SPARK_TO_DUCK = {
    "IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "FloatType": "FLOAT",
    "DateType": "DATE", "StringType": "VARCHAR", "BooleanType": "BOOLEAN", "ShortType": "SMALLINT",
    "ByteType": "TINYINT", "TimestampNTZType": "TIMESTAMP", "BinaryType": "BLOB",
}


def type_mismatches(sdf, rel):
    """Columns whose Spark and DuckDB types differ (by name)."""
    spark_t = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, str(f.dataType)) for f in sdf.schema.fields}
    duck_t = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return {c: (spark_t[c], duck_t.get(c)) for c in spark_t if spark_t[c] != duck_t.get(c)}


def rows_of(columns, rows, approx: bool):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i], approx) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, sf_dir: str, key: str, con=None):
    """Return (ok, message)."""
    from __spark_entry__ import oracle_sql, queries

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[key](spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark-only {sorted(set(scols) - set(dcols))} duck-only {sorted(set(dcols) - set(scols))}"
    bad_types = type_mismatches(sdf, con.sql(oracle_sql()[key]))
    if bad_types:
        return False, f"column types differ (spark, duck): {bad_types}"
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duck={len(drows)}"
    if rows_of(scols, srows, False) == rows_of(dcols, drows, False):
        return True, f"exact, {len(srows)} rows, spark {t1 - t0:.1f}s"
    if rows_of(scols, srows, True) == rows_of(dcols, drows, True):
        return True, f"APPROX only (float noise), {len(srows)} rows"
    a, b = rows_of(scols, srows, True), rows_of(dcols, drows, True)
    diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
    names = sorted(scols)
    detail = []
    for x, y in diff:
        detail.append({names[i]: (x[i], y[i]) for i in range(len(names)) if x[i] != y[i]})
    return False, f"values differ ({len(srows)} rows): {detail}"


def main(argv):
    from customer360.plans.settings import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from __spark_entry__ import queries

    keys = argv[2:] or list(queries())
    spark = local_session(8, 8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            ok, msg = compare(spark, sf_dir, k, con)
        except Exception as e:  # noqa: BLE001 - report and continue
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {k}: {msg}", flush=True)
    print(f"{len(keys) - bad}/{len(keys)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
