"""Datasets that are replaced as a whole, and only ever seen whole.

A dataset is a folder of versions. Writing makes a new version beside the
others; creating one empty marker file, whose name carries a running number and
the version, publishes it. File systems and object stores create a file
atomically, so a reader, which follows the marker of the highest number, sees
the former version or the new one, whatever becomes of the writer. A write
that fails leaves a version without a marker, which no reader follows and the
next write removes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MARKERS = "_versions"


class Versions:
    """The versions of one dataset under ``path``. Files go through the path's own
    Hadoop file system (local, HDFS, object store)."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet", options: dict[str, str] | None = None):
        self.spark, self.path, self.fmt, self.options = spark, path.rstrip("/"), fmt, options or {}
        self._jvm = spark.sparkContext._jvm
        self._fs = self._hadoop("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _hadoop(self, below: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}" if below else self.path)

    def _names(self, below: str) -> list[str]:
        at = self._hadoop(below)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _markers(self) -> list[tuple[int, str]]:
        """(number, version) of every published version, oldest first."""
        out = [n.split("-", 1) for n in self._names(MARKERS)]
        return sorted((int(n), v) for n, v in (x for x in out if len(x) == 2 and x[0].isdigit()))

    def current(self) -> str | None:
        """Folder of the published version; None if nothing is published."""
        found = self._markers()
        return f"{self.path}/{found[-1][1]}" if found else None

    def read(self, schema: StructType | None = None) -> DataFrame | None:
        """The published version, None if there is none."""
        at = self.current()
        if at is None:
            return None
        r = self.spark.read.format(self.fmt).options(**self.options)
        return (r.schema(schema) if schema is not None else r).load(at)

    def write(self, df: DataFrame, keep: int = 1) -> str:
        """Write ``df`` as a new version and publish it; returns its folder. Of the
        versions before it, the last ``keep`` stay for readers that are at them."""
        return self.write_tables({"": df}, keep)

    def write_tables(self, tables: dict[str, DataFrame], keep: int = 1) -> str:
        """Write several tables as one version, a folder each, and publish them
        together. One writer at a time."""
        before, version = self._markers(), f"v-{uuid.uuid4().hex}"
        for name, df in tables.items():
            at = f"{self.path}/{version}/{name}" if name else f"{self.path}/{version}"
            df.write.format(self.fmt).options(**self.options).save(at)
        number = before[-1][0] + 1 if before else 1
        self._fs.create(self._hadoop(f"{MARKERS}/{number:010d}-{version}"), False).close()
        stay = before[-keep:] if keep else []
        self._forget([x for x in before if x not in stay], {version, *(v for _, v in stay)})
        return f"{self.path}/{version}"

    def _forget(self, old: list[tuple[int, str]], stay: set[str]) -> None:
        for number, version in old:
            self._fs.delete(self._hadoop(f"{MARKERS}/{number:010d}-{version}"), False)
        for name in self._names(""):
            if name.startswith("v-") and name not in stay:
                self._fs.delete(self._hadoop(name), True)
