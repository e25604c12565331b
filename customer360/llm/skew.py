"""Joins of rows with the facts of their groups when groups may be of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fewer groups than this can each hold more than one in HEAVY of all rows, so
#: the facts of those groups are a table of proven size.
HEAVY = 10_000


def free_name(base: str, *frames: DataFrame) -> str:
    """``base``, lengthened until no frame has a column of that name in any case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while base.lower() in taken:
        base += "_"
    return base


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, heavy: int = HEAVY) -> DataFrame:
    """``rows`` inner-joined with ``groups`` (one row per ``key``; ``size`` is the
    number of rows with that key, ``total`` that of all rows).

    Rows of a group with more than one in ``heavy`` of all rows stay where they
    are: there are fewer than ``heavy`` such groups, and their facts are
    broadcast. All others are shuffled by key, where no key is large."""
    most = total // heavy
    big, small = groups.where(F.col(size) > most), groups.where(F.col(size) <= most)
    there = rows.join(F.broadcast(big), key)
    rest = rows.join(F.broadcast(big.select(key)), key, "left_anti")
    return there.unionByName(rest.join(small, key))
