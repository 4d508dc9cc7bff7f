"""Lineage cuts in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset, a folder of our own in local mode, and an error on a cluster."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = f"file://{tempfile.gettempdir()}/vigil-checkpoints"
    return where.rstrip("/")


#: Folders that each application has written and not deleted.
_WRITTEN: dict[str, list[str]] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder, for ``release`` to delete."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete all intermediate folders of this application and return their number; for when no result that reads them is needed any more."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def materialize(df: DataFrame, name: str = "part") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    The files survive lost executors and cost less than a row checkpoint. ``discard`` deletes one, ``release`` all that are left.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt over a fixed number of partitions, for long expressions on rows that come out of a shuffle.

    Spark merges a shuffle's partitions by their bytes, so that a million short values would meet a row's milliseconds in one task.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *keys)


def discard(df: DataFrame) -> None:
    """Delete the files under a table that ``materialize`` wrote and nobody reads any more."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    seen = set()
    for f in df.inputFiles():
        folder = f.rsplit("/", 1)[0]
        if folder not in seen and "/part-" in f:
            seen.add(folder)
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
