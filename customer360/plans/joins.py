"""Join helpers.

``left_join_all``: attach several per-customer frames to a base. Each frame
comes out of a ``groupBy(key)`` and is therefore already hash-partitioned on
the key; Spark's sort-merge joins reuse that partitioning, so the chain adds
no shuffle beyond the one per frame that produced it.

``null_safe_left_join``: a left join where NULL keys match each other (the
semantics of a pandas merge). All NULL keys hash to one value, which makes
NULL the hottest key of the join; the NULL group of the left side is split
into as many fragments as its measured size asks for, and the right side's
NULL rows are copied to each, so the work of that group spreads over many
tasks. Non-NULL keys join as usual. The output equals ``left.join(right, l.eqNullSafe(r), 'left')``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: NULL rows of the left side in one fragment of a NULL-safe join.
NULL_GROUP_ROWS = 10_000


def left_join_all(base: DataFrame, frames: Iterable[DataFrame], key: str, base_key: str | None = None) -> DataFrame:
    """``base`` left-joined to each frame on ``key`` (frames carry ``key``)."""
    out = base
    bk = base_key or key
    for f in frames:
        if bk == key:
            out = out.join(f, key, "left")
        else:
            r = f.withColumnRenamed(key, f"_{key}_r")
            out = out.join(r, out[bk] == r[f"_{key}_r"], "left").drop(f"_{key}_r")
    return out


def suffix_overlaps(left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes=("_x", "_y")):
    """Rename columns present on both sides (other than ``keys``) with suffixes.

    Names are compared exactly (case-sensitive), as a pandas merge does.
    """
    lk = set(keys)
    common = [c for c in left.columns if c in set(right.columns) and c not in lk]
    for c in common:
        left = left.withColumnRenamed(c, c + suffixes[0])
        right = right.withColumnRenamed(c, c + suffixes[1])
    return left, right


def fresh_names(bases: Sequence[str], *frames: DataFrame) -> list[str]:
    """``bases``, each lengthened until no frame has a column of that name in any case."""
    taken = {c.lower() for f in frames for c in f.columns}
    out = []
    for base in bases:
        while base.lower() in taken:
            base += "_"
        taken.add(base.lower())
        out.append(base)
    return out


def null_safe_left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    group_rows: int = NULL_GROUP_ROWS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Left join on ``left_key <=> right_key`` with the NULL group split up.

    The output holds every pair of a NULL left row and a NULL right row, as
    merge semantics ask. That group is joined by fragment and replicate with a
    measured fan: one aggregation counts the NULL rows of both sides, and the
    left ones are dealt into as many fragments as make about ``group_rows``
    left rows, and about ``group_rows`` x 100 rows of output, in each. The
    right side's NULL rows are copied once per fragment; no other row is
    copied, and without NULL rows nothing is. The counts are a scalar subquery
    of the join's own plan: building the join starts no job.

    ``sized_by`` is a cheaper frame to count the left side's NULL keys in (the
    table that ``left_key`` comes from, say). By default ``left`` itself is
    counted, which computes it a second time unless it is stored.

    The fragment of a left row is a hash of its columns, so it is the same if a
    task is recomputed after an executor loss.
    """
    salt, rsalt = fresh_names(["salt", "right_salt"], left, right)
    sides = [(left if sized_by is None else sized_by, left_key), (right, right_key)]
    nulls = [f.where(F.col(k).isNull()).select(F.lit(i).alias("side")) for i, (f, k) in enumerate(sides)]
    a, b = (F.count(F.when(F.col("side") == i, 1)) for i in (0, 1))
    fragments = F.greatest(F.ceil(a / group_rows), F.ceil(a * b.cast("double") / (group_rows * 100)))
    # No more fragments than left rows, and one at least.
    fan = nulls[0].unionByName(nulls[1]).agg(F.greatest(F.least(fragments, a), F.lit(1)).cast("int").alias("fan")).scalar()
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), fan).cast("int")
    l2 = left.withColumn(salt, F.when(F.col(left_key).isNull(), spread).otherwise(0))
    copies = F.when(F.col(right_key).isNull(), F.sequence(F.lit(0), fan - 1)).otherwise(F.array(F.lit(0)))
    r2 = right.withColumn(rsalt, F.explode(copies))
    # Both predicates are equi-join keys (Spark turns <=> into a
    # (coalesce(key), isnull(key)) key pair), so this stays a hash-partitioned join.
    cond = (l2[salt] == r2[rsalt]) & l2[left_key].eqNullSafe(r2[right_key])
    return l2.join(r2, cond, "left").drop(salt, rsalt)
