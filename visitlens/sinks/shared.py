"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``, the checkpoint folder set in code, or
    the warehouse, which executors share too. An application's folders are in one, which is deleted
    when the driver ends, if not before: results are read from it until then."""
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    own = f"{root.rstrip('/')}/visitlens-{spark.sparkContext.applicationId}"
    path, files = _files(spark, own)
    if files is not None and files.mkdirs(path):
        files.deleteOnExit(path)
    return f"{own}/{uuid.uuid4().hex}"


def _files(spark: SparkSession, folder: str):
    """The folder's path and file system; nothing where the session has no JVM of its own to ask."""
    try:
        jvm = spark._jvm
    except Exception:
        return None, None
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read back.

    Cuts the lineage, so later queries read columns of this table instead of running
    its plan again, and a lost executor costs no recomputation of it.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of intermediate tables once nothing reads them."""
    path, files = _files(spark, folder)
    if files is not None:
        files.delete(path, True)
