"""The checkpoint folder, and tables written to it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def use_checkpoints(spark: SparkSession) -> None:
    """Makes checkpoint() usable: the folder in spark.checkpoint.dir, else, in local mode only, a temporary one.

    On a cluster a missing setting is an error, as executors share no temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for a new table in the checkpoint folder; drop_folders() deletes what was written there."""
    use_checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    if not hasattr(spark.sparkContext, "_quillstone_folders"):
        spark.sparkContext._quillstone_folders = []
    spark.sparkContext._quillstone_folders.append(path)
    return path


def drop_folders(spark: SparkSession) -> int:
    """Deletes the intermediate tables of all results so far, once those results are stored; returns their number."""
    made = getattr(spark.sparkContext, "_quillstone_folders", [])
    n = len(made)
    while made:
        path = spark._jvm.org.apache.hadoop.fs.Path(made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n
