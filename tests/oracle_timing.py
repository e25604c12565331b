"""Time the DuckDB oracle statements (single-node reference point).

Usage: python tests/oracle_timing.py [sf_dir]
Prints one JSON line {key: seconds} (best of 2 runs, full result fetched).
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)


def main(argv):
    from oracle_check import duck
    from oracle_queries import oracle_sql

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    con = duck(sf_dir)
    out = {}
    for k, sql in oracle_sql().items():
        best = float("inf")
        for _ in range(2):
            t0 = time.perf_counter()
            con.execute(sql).fetchall()
            best = min(best, time.perf_counter() - t0)
        out[k] = round(best, 3)
    print(json.dumps({"total": round(sum(out.values()), 3), "queries": out}))


if __name__ == "__main__":
    main(sys.argv)
