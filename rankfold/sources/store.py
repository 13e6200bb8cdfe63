"""Working tables on the storage all executors share.

A table written here cuts the lineage of whatever produced it and outlives any
executor. The folder is the one the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder that every executor can reach"
            )
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rankfold-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, kind: str) -> str:
    """A path nothing has been written to yet, grouped by application."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/rankfold/{application}/{kind}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as the cluster completes it."""
    place, system = _place(spark, path)
    return system.makeQualified(place).toString()


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """The folders in a folder, as whole addresses; none where it is not there."""
    place, system = _place(spark, path)
    if not system.exists(place):
        return []
    return [str(e.getPath().toString()) for e in system.listStatus(place) if e.isDirectory()]


def inside_saved(spark: SparkSession, path: str) -> bool:
    """Whether a folder above this one was saved by an ML writer, as a chain's is above its stages."""
    place, system = _place(spark, path)
    above = system.makeQualified(place).getParent()
    while above is not None:
        if system.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(above, "metadata")):
            return True
        above = above.getParent()
    return False


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a working folder; one that is gone already is no error."""
    place, system = _place(spark, path)
    system.delete(place, True)


def remove_working_tables(spark: SparkSession) -> None:
    """Remove the working tables of this application's models, at its end; saved models stay.

    Models whose mapping is such a table cannot be used afterwards.
    """
    application = spark.sparkContext.applicationId
    place, system = _place(spark, f"{shared_folder(spark)}/rankfold/{application}")
    if not system.exists(place):
        return
    for entry in system.listStatus(place):
        if entry.getPath().getName().startswith(("mapping-", "ranked-")):
            system.delete(entry.getPath(), True)


def _place(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())
