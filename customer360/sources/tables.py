"""Table loading: parquet directories and partitioned JDBC reads.

The source jobs run one SQL text per database and pull the whole result into
a single process. Here each table is a lazily-read DataFrame; filters and
column selections written later reach the scan (parquet ``PushedFilters`` /
``ReadSchema``, JDBC ``WHERE`` / column list), and a JDBC table is read by
several tasks at once when a numeric partition column is given.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from customer360.sources.splits import read_split


class TableSet:
    """Named tables under one directory, read on first use.

    Only plan objects are kept (a DataFrame is an immutable lazy plan); no
    data is cached. :meth:`shared` returns one TableSet per session and
    directory so repeated queries do not re-read file footers.
    """

    _shared: dict[tuple, "TableSet"] = {}

    @classmethod
    def shared(cls, spark: SparkSession, root: str, fmt: str = "parquet") -> "TableSet":
        key = (id(spark), root.rstrip("/"), fmt)
        ts = cls._shared.get(key)
        if ts is None or ts.spark is not spark:
            ts = cls._shared[key] = cls(spark, root, fmt)
        return ts

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        """``<root>/<name>.<fmt>`` if the root's file system has it, else ``<root>/<name>``."""
        p = f"{self.root}/{name}.{self.fmt}"
        return p if path_exists(self.spark, p) else f"{self.root}/{name}"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.format(self.fmt).load(self.path(name))
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its own Hadoop file system (local, HDFS, object
    store). Any other trouble, such as a missing permission, is raised."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def read_tables(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Read several parquet tables of ``root`` into a name -> DataFrame map."""
    ts = TableSet(spark, root)
    return {n: ts[n] for n in names}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    options: Mapping[str, str] | None = None,
    split_key: str | None = None,
    splits: int | None = None,
    split_then: str | None = None,
) -> DataFrame:
    """Read a database table or query over JDBC.

    Connection details (user, password, driver) come only from ``options``.
    With ``partition_column`` and bounds the read is split into
    ``num_partitions`` range queries that run in parallel; with ``split_key``
    into ``splits`` queries of equal shares, whose bounds the database gives
    (:mod:`customer360.sources.splits`; numbers, texts, dates). Without either the
    whole table arrives through one task, so give one for large tables.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    if split_key is not None:
        if table is None or splits is None:
            raise ValueError("a read by shares needs table and splits")
        return read_split(spark, url, table, split_key, splits, options, split_then)[0]
    r = spark.read.format("jdbc").option("url", url)
    r = r.option("dbtable", table) if table is not None else r.option("query", query)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        if query is not None:
            raise ValueError("Spark partitions only dbtable reads; wrap the query as '(...) t'")
        r = (
            r.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load()
