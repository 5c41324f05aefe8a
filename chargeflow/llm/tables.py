"""Written intermediate tables and other small helpers that the operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the corpus contracts define it: space and U+0009 to U+000D.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share. Where
    the setting is absent, a new local folder is set once, which only a local
    session may use: elsewhere each machine would write to its own disk."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back: this cuts the
    lineage, and what follows survives the loss of any executor."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(table: DataFrame) -> None:
    """Deletes the files of a table that ``materialize`` has written and that nothing will read again."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_to)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def runs(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of batches; what Arrow no longer uses goes back to the system after each batch."""
    for b in batches:
        for at in range(0, len(b), rows):
            yield b.slice(at, rows)
        del b
        pa.default_memory_pool().release_unused()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids give null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus
