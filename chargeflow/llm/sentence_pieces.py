"""SentencePiece encoding and decoding of whole texts, giant ones in chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pieces import Pieces, Step, best_path, product
from .tables import materialize, read, runs

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of a chunk. Texts with as many are encoded in several tasks.
CHUNK = 1 << 15
#: Transfer matrices that are multiplied in one group.
BLOCK = 64

_MATRIX = "row string, chunk long, matrix array<long>"
_STEP = "row string, chunk long, step array<long>"

_ENCODED = "doc_id long, n_chars long, text_sha256 string, ids array<int>"


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _lists(parts: list[bytes]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    return pa.record_batch([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])


def _four(flat: list[int]) -> list[Step]:
    return list(zip(flat[::4], flat[1::4], flat[2::4], flat[3::4]))


def _steps(matrices: DataFrame) -> DataFrame:
    """``row``, ``chunk``, ``step``: the place of each transfer matrix on its row's
    best path. The matrices of ``BLOCK`` chunks are multiplied together; a scan over
    the products gives the pieces at the borders of the blocks, one within each
    block those of its chunks."""
    held = F.array_sort(F.collect_list(F.struct("chunk", "matrix"))).alias("held")
    blocks = matrices.groupBy("row", F.floor(F.col("chunk") / BLOCK).alias("block")).agg(held)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runs(batches, 16):
            yield _batch(_MATRIX, [(row, k, [x for s in reduce(product, [_four(m["matrix"]) for m in ms]) for x in s]) for row, k, ms in zip(*(c.to_pylist() for c in b.columns))])

    def over_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runs(batches, 16):
            for row, ms in zip(*(c.to_pylist() for c in b.columns)):
                path = best_path([_four(m["matrix"]) for m in ms], (0, 0))
                yield _batch(_STEP.replace("chunk", "block"), [(row, m["chunk"], list(s)) for m, s in zip(ms, path)])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runs(batches, 16):
            for row, ms, step in zip(*(c.to_pylist() for c in b.columns)):
                path = best_path([_four(m["matrix"]) for m in ms], tuple(step[:2]), tuple(step[2:]))
                yield _batch(_STEP, [(row, m["chunk"], list(s)) for m, s in zip(ms, path)])

    products = blocks.mapInArrow(multiply, _MATRIX).groupBy("row").agg(held)
    ends = products.mapInArrow(over_blocks, _STEP.replace("chunk", "block"))
    return blocks.join(ends, ["row", "block"]).select("row", "held", "step").mapInArrow(within, _STEP)


def encode(docs: DataFrame, model_file: str = MODEL_FILE, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_chars``, ``text_sha256``, ``ids``.

    The ids are those that sentencepiece gives with the model (see ``Pieces``). A
    text of ``chunk`` characters or more is cut after each ``chunk`` of them, wherever
    that is: every chunk gives a transfer matrix between the pieces over its two
    borders, products of these name the piece over each border, and each chunk is
    then traced back by itself. Rows without text (null or empty) have no ids; null
    and repeated ids are kept as they are; other columns are ignored. The model file
    is read on the driver, must be of the BPE kind, and its pieces are broadcast.
    """
    held = docs.sparkSession.sparkContext.broadcast(Pieces.load(model_file))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runs(batches):
            texts = b.column(1).to_pylist()
            ids = _lists([held.value.encode(t).tobytes() for t in texts])
            yield pa.record_batch([b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([_sha(t) for t in texts], pa.string()), ids], names=["doc_id", "n_chars", "text_sha256", "ids"])

    short = rows.filter(F.length("text") < chunk).mapInArrow(whole, _ENCODED)

    part_of = "row string, doc_id long, n_chars long, text_sha256 string, chunk long, start long, p long, q long, text string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, halo = TaskContext.get().partitionId(), 0, held.value.longest
        for b in runs(batches, 8):
            for doc, text in zip(*(c.to_pylist() for c in b.columns)):
                n, sha, t = len(text), _sha(text), held.value.prepared(text)
                starts = [max(0, p - halo) for p in range(0, len(t), chunk)]
                at = [(p - s, min(p + chunk, len(t)) - s, t[s : p + chunk + halo]) for p, s in zip(range(0, len(t), chunk), starts)]
                for k in range(0, len(at), 256):
                    yield _batch(part_of, [(f"{part}-{count}", doc, n, sha, k + i, s, *x) for i, (s, x) in enumerate(zip(starts[k : k + 256], at[k : k + 256]))])
                count += 1

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runs(batches, 64):
            rows = zip(*(b.column(c).to_pylist() for c in ("row", "chunk", "start", "p", "q", "text")))
            yield _batch(_MATRIX, [(row, k, [s + x for step in held.value.transfer(t, p, q) for x in step]) for row, k, s, p, q, t in rows])

    # The parts are written once, so that the numbers that name their rows never change.
    parts = materialize(rows.filter(F.length("text") >= chunk).mapInArrow(cut, part_of))
    spread = parts.repartition("row", "chunk")
    steps = _steps(materialize(spread.select("row", "chunk", "start", "p", "q", "text").mapInArrow(transfer, _MATRIX)))

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runs(batches, 64):
            ids = [held.value.between(t, tuple(x - s for x in step)).tobytes() for s, t, step in zip(*(c.to_pylist() for c in b.columns[5:]))]
            yield pa.record_batch([*b.columns[:5], pa.array(ids, pa.binary())], names=[*b.schema.names[:5], "ids"])

    traced = spread.join(steps, ["row", "chunk"]).select("row", "doc_id", "n_chars", "text_sha256", "chunk", "start", "text", "step")
    traced = traced.mapInArrow(trace, "row string, doc_id long, n_chars long, text_sha256 string, chunk long, ids binary")
    ordered = traced.groupBy("row", "doc_id", "n_chars", "text_sha256").agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))

    def glue(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runs(batches, 16):
            ids = _lists([b"".join(p["ids"] for p in parts) for parts in b.column(3).to_pylist()])
            yield pa.record_batch([*b.columns[:3], ids], names=["doc_id", "n_chars", "text_sha256", "ids"])

    return short.union(ordered.select("doc_id", "n_chars", "text_sha256", "parts").mapInArrow(glue, _ENCODED))


def decode(encoded: DataFrame, model_file: str = MODEL_FILE, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded`` to a table with a column of ids, which keeps its columns
    (that one is replaced). Null ids decode to null, no ids to the empty text."""
    held = encoded.sparkSession.sparkContext.broadcast(Pieces.load(model_file).decoder)
    encoded = encoded.drop("decoded")
    column = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in runs(batches):
            out = [None if not x.is_valid else held.value.decode(x.values.to_numpy(zero_copy_only=False)) for x in b.column(column)]
            yield pa.record_batch([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))


def digests(encoded: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """What the query returns of each encoded row, decoded again."""
    back = decode(encoded, model_file)
    sha = F.sha2("decoded", 256)
    ids = F.sha2(F.array_join("ids", " "), 256)
    return back.select("doc_id", "n_chars", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), sha.alias("decoded_sha256"), (sha == F.col("text_sha256")).alias("round_trip"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(read(spark, sf_dir, "documents")))
