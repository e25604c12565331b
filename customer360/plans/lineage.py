"""Lineage cuts on the cluster's shared checkpoint folder.

The folder comes from the session's ``spark.checkpoint.dir``. Only a local
session (tests, ``local[...]`` master) with the setting unset gets a default
under the system temp dir; on a cluster an unset folder is an error, since a
machine-local folder would not be shared. A checkpointed frame is written
reliably (not executor-local), so losing an executor after the cut does not
recompute the plan before it.
"""

from __future__ import annotations

import os
import tempfile
from gc import collect as collect_garbage

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULT = os.path.join(tempfile.gettempdir(), "customer360-checkpoints")


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session, setting a local one only if unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return d
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = _LOCAL_DEFAULT
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder and return the re-read frame.

    A reliable checkpoint (never ``localCheckpoint``): the files live in the
    shared folder, so they survive the loss of the executor that wrote them.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_stored(spark: SparkSession, path: str) -> None:
    """Delete a stored table that is no longer read, in its own file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def release_unreachable(spark: SparkSession) -> None:
    """Let Spark clean up after frames that nothing refers to any more.

    Checkpoints, shuffle files and broadcasts are removed when the driver's garbage
    collector finds their frames unreachable, which may never happen in a long job
    on a roomy heap. A job of several stages calls this between them."""
    collect_garbage()
    spark.sparkContext._jvm.System.gc()
