"""Session settings the report plans rely on.

* AQE on: shuffle partitions are coalesced to the data actually produced,
  a sort-merge join whose build side turns out small at runtime becomes a
  broadcast join, and skewed join partitions are split.
* The static broadcast threshold stays Spark's size-checked default; the report
  operators broadcast nothing by hint, so a side is broadcast only when its
  measured size is under the threshold, and shuffled otherwise.
* ``spark.sql.shuffle.partitions`` sizes the largest shuffle; pass a value
  of about (input bytes of the largest fact) / 128 MB on a cluster
  (:func:`shuffle_partitions_for`), and let AQE coalesce the small shuffles
  down to ``advisoryPartitionSizeInBytes``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 << 20, minimum: int = 8) -> int:
    """Shuffle partition count so that the largest shuffle's partitions are
    about ``target_bytes`` (an upper bound: shuffles carry pruned, partially
    aggregated rows, and AQE merges partitions that come out small)."""
    return max(minimum, -(-int(input_bytes) // target_bytes))


def tune_session(spark: SparkSession, shuffle_partitions: int | None = None,
                 parallelism_first: bool | None = None) -> SparkSession:
    """Apply the settings above. ``parallelism_first=False`` (for shared
    clusters) makes AQE coalesce shuffles to the advisory partition size
    instead of keeping as many partitions as there are cores."""
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if parallelism_first is not None:
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = str(parallelism_first).lower()
    for k, v in conf.items():
        spark.conf.set(k, v)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "customer360",
                  driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no ports beyond Spark's own)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune_session(spark)
