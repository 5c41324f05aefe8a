"""The header line of each file, from its first blocks alone."""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that are read at a time, and the longest line that can be a header.
BLOCK = 1 << 14
LONGEST = 1 << 20
#: Stores that tasks can open by themselves.
KNOWN = ("file", "s3", "s3a", "s3n", "gs", "hdfs", "abfs", "abfss")
_SCHEMA = "file string, head string, encoding string, rows boolean, bytes_read long"


class Head(NamedTuple):
    """``head``: the first line that is neither blank nor a comment (None without);
    ``rows``: another follows it; ``bytes_read``."""

    head: str | None
    encoding: str
    rows: bool
    bytes_read: int


def first_line(stream: BinaryIO, block: int = BLOCK) -> Head:
    """Reads block by block until a second line of use begins. What was read tells the
    encoding: UTF-16 by its mark, else UTF-8, or ISO-8859-1 where it isn't that."""
    raw = stream.read(block)
    done = len(raw)
    encoding = {codecs.BOM_UTF16_LE: "UTF-16LE", codecs.BOM_UTF16_BE: "UTF-16BE"}.get(raw[:2], "UTF-8")
    held, head = raw, None
    while True:
        ended = len(raw) < block
        newline = "\n".encode(encoding)
        width = len(newline)
        at = 0
        while True:
            cut = held.find(newline, at)
            while cut >= 0 and (cut - at) % width:
                cut = held.find(newline, cut + 1)
            if cut < 0 and not (ended and at < len(held)):
                break
            line = held[at : cut if cut >= 0 else len(held)]
            at = cut + width if cut >= 0 else len(held)
            text, encoding = _decoded(line, encoding)
            text = text.replace("﻿", "").strip()
            if text and not text.startswith("#"):
                if head is not None:
                    return Head(head, encoding, True, done)
                head = text
        held = held[at:]
        if head is not None and held and _decoded(held, encoding)[0].strip() and not _decoded(held, encoding)[0].lstrip().startswith("#"):
            return Head(head, encoding, True, done)
        if ended or len(held) > LONGEST:
            return Head(head, encoding, False, done)
        raw = stream.read(block)
        done += len(raw)
        held += raw


def _decoded(line: bytes, encoding: str) -> tuple[str, str]:
    if encoding != "UTF-8":
        return line.decode(encoding, "replace"), encoding
    try:
        return line.decode(), encoding
    except UnicodeDecodeError as e:
        # A character that the block cuts is no sign of another encoding.
        cut = e.reason == "unexpected end of data"
        return line.decode("latin-1"), encoding if cut else "ISO-8859-1"


def opened(path: str) -> BinaryIO:
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/"), compression=None)
    store, place = fs.FileSystem.from_uri(("s3" if scheme in ("s3a", "s3n") else scheme) + ":" + quote(rest, safe="/:@"))
    return store.open_input_stream(place, compression=None)


def headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A row for each file under ``paths``: ``file``, ``head``, ``encoding``, ``rows``
    (lines follow), ``bytes_read``. Files are dealt over tasks, which open each and read
    its first blocks, so that a file's length doesn't matter. Empty files and files of
    comments have no head, nor has one whose first line is longer than LONGEST. Where
    only Spark's own readers reach the store, the files' lines are read by them."""
    # Of binary files, only names and lengths are read here.
    listed = spark.read.format("binaryFile").load(paths).select("path")
    first = listed.take(1)
    if not first:
        return spark.createDataFrame([], _SCHEMA)
    if first[0].path.partition(":")[0] not in KNOWN:
        return _by_spark(spark, paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            files = b.column(0).to_pylist()
            found = []
            for f in files:
                with opened(f) as stream:
                    found.append(first_line(stream))
            columns = [pa.array(files, pa.string()), *(pa.array([h[i] for h in found], k) for i, k in enumerate((pa.string(), pa.string(), pa.bool_(), pa.int64())))]
            yield pa.record_batch(columns, names=[x.split()[0] for x in _SCHEMA.split(", ")])

    return listed.repartition(max(1, spark.sparkContext.defaultParallelism), "path").mapInArrow(run, _SCHEMA)


def _by_spark(spark: SparkSession, paths: list[str]) -> DataFrame:
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("b"), "value")
    lines = lines.withColumn("i", F.monotonically_increasing_id())
    bare = F.trim(F.regexp_replace("value", "﻿", ""))
    used = lines.withColumn("bare", bare).filter((bare != "") & ~bare.startswith("#"))
    heads = used.groupBy("file").agg(F.min_by("bare", F.struct("b", "i")).alias("head"), F.max(F.instr("value", "�") > 0).alias("latin"), F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("bytes_read"))
    return heads.select("file", "head", F.when(F.col("latin"), "ISO-8859-1").otherwise("UTF-8").alias("encoding"), (F.col("n") > 1).alias("rows"), "bytes_read")
