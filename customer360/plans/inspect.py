"""Plan inspection: the text of ``explain`` and a count of its costly nodes.

Useful to check a report's plan before running it at scale: how many
parquet scans, shuffles (hash / round robin), broadcasts, sort-merge joins,
windows and sort aggregates it has, and which filters reach the scans.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as ``df.explain(mode)`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def plan_summary(df: DataFrame) -> dict[str, int]:
    """Counts of the plan's costly nodes (before execution; AQE may still
    turn a sort-merge join into a broadcast join at runtime)."""
    txt = plan_text(df, "formatted")
    tree = txt.split("\n\n")[0]
    args = re.findall(r"Arguments: (hashpartitioning|RoundRobinPartitioning|SinglePartition|rangepartitioning)", txt)
    return {
        "scans": tree.count("Scan parquet"),
        "hash_shuffles": args.count("hashpartitioning"),
        "spread_shuffles": args.count("RoundRobinPartitioning"),
        "broadcasts": tree.count("BroadcastExchange"),
        "smj": tree.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \(", tree)),
        "sort_aggs": tree.count("SortAggregate"),
    }


def pushed_filters(df: DataFrame) -> list[str]:
    """The ``PushedFilters`` list of every parquet scan in the plan."""
    return re.findall(r"PushedFilters: \[(.*)\]", plan_text(df, "formatted"))
