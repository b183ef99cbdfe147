"""Lineage cuts for tables that several later stages read.

The table is written once as Parquet under the shared folder the cluster
names in ``spark.checkpoint.dir`` and read back.  Compared with an RDD
``checkpoint()`` this runs the upstream plan once (a reliable RDD checkpoint
recomputes it to write the files), stores columns compactly, and gives the
planner real file sizes (so AQE and the broadcast size checks see measured
bytes).  A lost executor then costs only the tasks of the current stage, and
later filters cannot be pushed back through (and inline) long parse chains.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame

from larder.session import checkpoint_dir


#: Where set while a plan runs, Spark deletes its shuffle files as soon as it is through.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the session's checkpoint folder and return the written table.

    The shuffle files of the write are deleted with its end: nothing reads them again, and otherwise
    they stay until the driver's garbage collector comes across them.
    """
    spark = df.sparkSession
    path = _track(os.path.join(checkpoint_dir(spark), f"larder-{name}-{uuid.uuid4().hex}"))
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.parquet(path)


def _delete(spark, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(path))
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*written: DataFrame) -> None:
    """Delete tables of ``materialize`` that no later step reads; what was made from them is written."""
    for df in written:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            _delete(df.sparkSession, folder)


def new_folder(spark, name: str) -> str:
    """The URI of a new folder under the session's shared folder, for files that tasks write through ``pyarrow.fs``."""
    path = _track(os.path.join(checkpoint_dir(spark), f"larder-{name}-{uuid.uuid4().hex}"))
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def opened(folder: str):
    """(file system, path) of a folder's URI, which is made if need be."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    return store, path


def discard_folder(spark, folder: str) -> None:
    _delete(spark, folder)


_WRITTEN: list[str] = []


def _track(path: str) -> str:
    _WRITTEN.append(path)
    return path


def clear_stages(spark) -> int:
    """Delete the stage tables this process wrote (through Hadoop's FileSystem, so
    it works on the cluster's shared storage), forget memoized stages, and return
    how many were removed.  Call once the outputs that read them are written."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            fs.delete(path, True)
            removed += 1
    try:
        from larder.plans.queries import _STAGES
        _STAGES.clear()
    except ImportError:
        pass
    return removed
