"""Intermediate tables in the folder that the session names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a local folder that only a local session may use."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def temporary(spark: SparkSession, path: str) -> str:
    """``path``, which goes when the application ends."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's name in the shared folder, for files of this application alone."""
    return temporary(spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")


def delete(spark: SparkSession, path: str) -> bool:
    """Deletes a file or folder of any file system that Spark knows; false if there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def names(spark: SparkSession, folder: str) -> set[str]:
    """What a folder holds; nothing where there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in fs.listStatus(p)} if fs.exists(p) else set()


def move(spark: SparkSession, old: str, new: str) -> None:
    """Renames a file of any file system that Spark knows."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    make(old).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(make(old), make(new))


@contextmanager
def owned(*frames: DataFrame) -> Iterator[list[DataFrame]]:
    """``frames`` written once and read back, for as long as the block lasts: what is
    made of them must be written or collected in it. Their files are deleted then."""
    spark = frames[0].sparkSession
    folder = f"{shared_folder(spark)}/owned-{uuid.uuid4().hex}"
    try:
        for i, df in enumerate(frames):
            df.write.parquet(f"{folder}/{i}")
        yield [spark.read.schema(df.schema).parquet(f"{folder}/{i}") for i, df in enumerate(frames)]
    finally:
        delete(spark, folder)


def written(df: DataFrame) -> DataFrame:
    """``df`` written once and read back, for plans that use it several times; its files
    go when the application ends. Where the end of their use is known, see ``owned``."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    temporary(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
