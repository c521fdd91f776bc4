"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, a temporary one of this process, in local mode only."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext._jsc.sc().isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="lodestack-")
        atexit.register(shutil.rmtree, where, True)
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


#: Folders written by this process and not deleted yet, with their sessions.
_WRITTEN: dict[str, SparkSession] = {}


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one; it is deleted by release(), or when the process ends."""
    path = f"{shared_dir(spark)}/lodestack-{label}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_release_all)
    _WRITTEN[path] = spark
    return path


def _release_all() -> None:
    for path in list(_WRITTEN):
        try:
            _delete(path)
        except Exception:  # the session has ended already
            return


def _delete(path: str) -> None:
    spark = _WRITTEN.pop(path, None)
    if spark is not None:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for t in tables:
        _delete(getattr(t, "_stored_at", ""))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    This cuts the lineage: what follows survives lost executors without the
    steps before being done again, and a costly step runs once.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out
