"""Summarise the physical plan of every registered query.

Usage: python tests/plan_report.py [sf_dir]
Prints a markdown table: parquet scans, shuffle exchanges (hash / round
robin), broadcast exchanges, sort-merge joins, windows and sort aggregates,
read from ``explain("formatted")`` before execution (AQE may still turn a
sort-merge join into a broadcast join at runtime).
"""

from __future__ import annotations

import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))


def main(argv):
    from __spark_entry__ import queries

    from customer360.plans.inspect import plan_summary
    from customer360.plans.settings import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    cols = ["scans", "hash_shuffles", "spread_shuffles", "broadcasts", "smj", "windows", "sort_aggs"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for k, q in queries().items():
        s = plan_summary(q(spark, sf_dir))
        print(f"| {k} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
