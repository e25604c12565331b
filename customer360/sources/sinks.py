"""Dated report datasets.

The source jobs write one spreadsheet per run named after the day before the
run. Here a report is a dataset with one folder per ``report_date`` under
``<root>/<name>``. A day's folder holds versions (:mod:`customer360.sources.versions`):
re-running a day writes a new version and publishes it with one marker file,
so a run that fails half way leaves the day as it was, and other days are not
touched.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from customer360.functions.formatting import report_date
from customer360.sources.versions import Versions

DAY = "report_date="


def with_report_label(df: DataFrame, asof, name: str) -> DataFrame:
    """Add ``report_date`` (asof - 1 day, MM-dd-yyyy) and ``report_name`` (``<name>_<date>``)."""
    d = report_date(asof)
    return df.withColumns({"report_date": d, "report_name": F.concat(F.lit(f"{name}_"), d)})


def _options(fmt: str, header: bool) -> dict[str, str]:
    return {"header": str(header).lower()} if fmt == "csv" else {}


def publish(df: DataFrame, asof, name: str, root: str, fmt: str = "parquet", header: bool = True, keep: int = 0) -> str:
    """Write ``df`` as one day of the dated dataset ``<root>/<name>``; returns its path.

    The day is replaced as a whole, so an empty result empties it. ``fmt`` is
    ``parquet`` or ``csv`` (with a header line, for spreadsheet users). Versions
    of the day before this one are removed once it is published, but for the
    last ``keep``, which readers that began before may still need; with none kept the
    dataset's folder can be read as a plain partitioned dataset, too.
    """
    path = f"{root.rstrip('/')}/{name}"
    label = df.sparkSession.range(1).select(report_date(asof).alias("d")).first()["d"]
    Versions(df.sparkSession, f"{path}/{DAY}{label}", fmt, _options(fmt, header)).write(df, keep)
    return path


def published(spark: SparkSession, name: str, root: str, days: Iterable[str] | None = None, fmt: str = "parquet",
              header: bool = True) -> DataFrame | None:
    """The published days of ``<root>/<name>`` (all, or the ``report_date`` labels in
    ``days``) with a ``report_date`` column; None if none is published."""
    path = f"{root.rstrip('/')}/{name}"
    if days is None:
        days = [n.removeprefix(DAY) for n in Versions(spark, path)._names("") if n.startswith(DAY)]
    out = None
    for day in days:
        df = Versions(spark, f"{path}/{DAY}{day}", fmt, _options(fmt, header)).read()
        if df is not None:
            df = df.withColumn("report_date", F.lit(day))
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
