"""Labelled rows for classifiers, and bounded samples of them for those fitted on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_ids(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of every labelled id. Rows with NULLs or other labels are
    left out; of an id that repeats, the larger label counts."""
    lab = labels.select("doc_id", F.col(label).alias("label")).where("label in (0, 1) and doc_id is not null")
    return lab.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))


def sampled_ids(labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, float]:
    """(doc_id, label) of at most ``per_class`` ids of either class, smallest
    xxhash64(doc_id) first, and how many times more thinly class 0 is sampled
    than class 1."""
    lab = labelled_ids(labels, label)
    parts = [lab.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    total = {r["label"]: r["n"] for r in lab.groupBy("label").agg(F.count("*").alias("n")).collect()}
    rate = [min(1.0, per_class / max(1, total.get(c, 0))) for c in (0, 1)]
    return parts[0].unionByName(parts[1]), rate[1] / rate[0]


def fold() -> F.Column:
    """0 to 4 by doc_id; fold 0 calibrates."""
    return F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(5)).cast("int")
