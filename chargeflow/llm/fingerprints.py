"""Fingerprints of documents: canonical exact digests."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import materialize, read

#: Bits of the filter that tells which digests may have several rows. A full
#: filter lets more rows through to the comparison; it never loses one.
FILTER_BITS = 1 << 23


def canonical(text: str | None) -> str:
    """NFKC, case folded, then NFKC again (folding can undo it), each run of
    white space one blank, none at the ends. Null is empty."""
    if not text:
        return ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    else:
        text = text.lower()
    return " ".join(text.split())


def digest(canonical_text: str) -> str:
    """The 128-bit xxHash of a canonical text, in hex."""
    return xxhash.xxh3_128_hexdigest(canonical_text.encode("utf-8", "surrogatepass"))


def _bits(low_hex: str) -> int:
    return int(low_hex[:8], 16) % FILTER_BITS


def colliding(docs: DataFrame, digests: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_of=digest) -> DataFrame:
    """``digest``s of which two different canonical texts exist (none, as a rule):
    the texts of equal digests are compared byte by byte.

    ``digests`` has the ``digest`` of each row. Only rows whose digest may have
    several rows bring their canonical text; they are told by a bit map of fixed
    size (FILTER_BITS) over the digests. Equal texts collapse in each task before
    they are shuffled, so a hot group is a few rows.
    """
    several = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")
    # The bit map, 64 bits a row: a table of at most FILTER_BITS / 64 rows.
    bit = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % FILTER_BITS
    words = several.select(bit.alias("bit")).groupBy((F.col("bit") / 64).cast("long").alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(bit % 64)))").alias("map"))
    held = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words.collect():
        held[r.word] = r.map
    bits = docs.sparkSession.sparkContext.broadcast(held.view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, t = [], []
            for text in b.column(0).to_pylist():
                c = canonical(text)
                x = digest_of(c)
                at = _bits(x)
                if int(bits.value[at >> 6]) >> (at & 63) & 1:
                    d.append(x)
                    t.append(c)
            yield pa.record_batch([pa.array(d, pa.string()), pa.array(t, pa.string())], names=["digest", "canonical"])

    texts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "digest string, canonical string")
    return texts.groupBy("digest", "canonical").agg(F.count(F.lit(1))).groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")


def resolved(rows: DataFrame, collisions: DataFrame, digest_col: str, sha_col: str, out: str) -> DataFrame:
    """``out``: the digest, and where it collides also the SHA-256 of the canonical
    text. ``collisions`` is a written table, as a rule an empty one: then no join is planned."""
    if collisions.isEmpty():
        return rows.withColumn(out, F.col(digest_col))
    c = collisions.select(F.col("digest").alias("_d"))
    full = F.when(F.col("_d").isNull(), F.col(digest_col)).otherwise(F.concat_ws("-", digest_col, sha_col))
    return rows.join(c, F.col(digest_col) == F.col("_d"), "left").withColumn(out, full).drop("_d")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_of=digest) -> DataFrame:
    """``doc_id``, ``fingerprint`` of each row of ``docs``. Texts have equal
    fingerprints exactly if their canonical forms are equal, byte by byte. Null
    and blank texts share the fingerprint of the empty text; null and repeated
    ids are returned as they are; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            forms = [canonical(t) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array([digest_of(c) for c in forms], pa.string()), pa.array([_sha(c) for c in forms], pa.string())], names=["doc_id", "digest", "sha"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = materialize(rows.mapInArrow(run, "doc_id long, digest string, sha string"))
    collisions = materialize(colliding(docs, rows, id_col, text_col, digest_of))
    return resolved(rows, collisions, "digest", "sha", "fingerprint").select("doc_id", "fingerprint")


def with_next(docs: DataFrame, make, fields: str) -> DataFrame:
    """``make(id, text, next text)`` for each row, ``fields`` long, where next is
    the following row in descending order of id (null last; equal ids by a hash of the text);
    after the last comes the first.

    The rows are range-partitioned by the order and each partition is read in
    order once, so texts are shuffled once and nothing is held but two rows.
    A partition's last row meets the next partition's first through a table of
    two rows a partition.
    """
    names = [f.split()[0] for f in fields.split(", ")]
    # The ranges are cut by samples of the sort keys, which come to the driver: so texts are no keys, their hashes are.
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    schema = f"{fields}, part int, edge string, edge_id long, edge_text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None
        for b in batches:
            out, edges = [], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if last is None:
                    edges.append((part, "first", doc, text))
                else:
                    out.append(make(last[0], last[1], text))
                last = (doc, text)
            yield _batch(out, edges)
        if last is not None:
            yield _batch([], [(part, "last", *last)])

    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}
    full = [(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")]

    def _batch(out: list, edges: list) -> pa.RecordBatch:
        k = len(names)
        rows = [(*x, None, None, None, None) for x in out] + [(*[None] * k, *e) for e in edges]
        return pa.record_batch([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(full)], names=[n for n, _ in full])

    # What a task finds at its edges goes with its rows, in one table: both come from the same ranges.
    found = materialize(docs.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema))
    edge = found.filter("edge is not null").select("part", "edge", "edge_id", "edge_text")
    parts = [r.part for r in edge.filter("edge = 'first'").select("part").orderBy("part").collect()]
    if not parts:
        return found.select(*names)
    follow = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, after int")
    firsts = edge.filter("edge = 'first'").select(F.col("part").alias("after"), F.col("edge_text").alias("next_text"))
    lasts = edge.filter("edge = 'last'").join(follow, "part").select("after", "edge_id", "edge_text")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [make(*r) for r in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.record_batch([pa.array([r[i] for r in out], kind) for i, (_, kind) in enumerate(full[: len(names)])], names=names)

    closed = lasts.join(firsts, "after").select("edge_id", "edge_text", "next_text").mapInArrow(close, fields)
    return found.filter("edge is null").select(*names).union(closed)


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as
    many (or all) of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(doc: int | None, text: str | None, following: str | None) -> tuple:
    text, following = text or "", following or ""
    new = edited(text, following)
    own, changed, after = canonical(text), canonical(new), canonical(following)
    return doc, len(text), _sha(new), digest(own), _sha(own), digest(changed), _sha(changed), float(own == changed), float(own == after)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fields = "doc_id long, n_chars long, edited_sha256 string, digest string, sha string, edited_digest string, edited_sha string, near_edited double, near_next double"
    rows = with_next(docs, _compare, fields)
    collisions = materialize(colliding(docs, rows))
    rows = resolved(rows, collisions, "digest", "sha", "fingerprint")
    rows = resolved(rows, collisions, "edited_digest", "edited_sha", "edited_fingerprint")
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
