"""Quality classification by nearest labelled neighbours in a latent space."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import crc_remainder, read

#: Labelled texts at most (the first by a hash of the id), latent dimensions, neighbours that vote.
SAMPLE, DIMENSIONS, NEIGHBOURS = 4000, 48, 25
#: Terms: buckets of n-grams of character shapes, and buckets of other measures of a text.
SHAPES, BUCKETS = 1 << 11, 16
SLICE = 1 << 20
BLOCK = 512

_KIND = np.full(0x110000, 3, np.uint8)  # other letters and signs


def _kinds() -> np.ndarray:
    """Shape of each code point: lower case, upper case, digit, blank, line end,
    or one of the printable signs; what is none of these is one shape."""
    k = _KIND
    if k[97] == 3:
        for c in range(0x250):
            x = chr(c)
            k[c] = 0 if x.islower() else 1 if x.isupper() else 2 if x.isdigit() else 3
        k[10], k[32], k[9] = 5, 4, 4
        signs = [c for c in range(33, 127) if not chr(c).isalnum()]
        k[signs] = 6 + np.arange(len(signs))
    return k


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return h ^ (h >> np.uint32(12))


def terms(text: str) -> np.ndarray:
    """Counts, damped and of length 1, of a text's shape 1- to 3-grams, and how
    varied its words and lines are. Whole texts, in slices."""
    shape = np.zeros(SHAPES, np.int64)
    for at in range(0, max(1, len(text)), SLICE):
        # Two characters of the slice before, so that no n-gram is lost between slices.
        seen = _kinds()[_points(text[max(0, at - 2) : at + SLICE])].astype(np.uint32)
        for n in (1, 2, 3):
            k = seen[3 - n :] if at else seen
            if len(k) >= n:
                h = k[: len(k) - n + 1] + np.uint32(n << 24)
                for j in range(1, n):
                    h = h * np.uint32(48) + k[j : len(k) - n + 1 + j]
                shape += np.bincount(_mixed(h) % np.uint32(SHAPES), minlength=SHAPES)
    words, lines = text.split(), text.split("\n")
    distinct = len(set(words))
    measures = [
        distinct / max(1, len(words)),
        len(set(zip(words, words[1:]))) / max(1, len(words) - 1),
        len(set(lines)) / len(lines),
        min(1.0, sum(map(len, words)) / max(1, len(words)) / 16),
        min(1.0, np.log1p(len(words)) / 10),
    ]
    out = np.log1p(shape * (1000 / max(1, len(text))))
    out /= np.linalg.norm(out) or 1
    soft = np.concatenate([np.maximum(0, 1 - np.abs(np.arange(BUCKETS) - m * (BUCKETS - 1))) for m in measures])
    return np.concatenate([out, soft * 0.35]).astype(np.float32)


class Model:
    """Latent-semantic vectors of labelled texts (truncated singular value
    decomposition of their centred term vectors); a text's score is the mean
    label of the nearest ones by cosine, weighted by similarity."""

    def __init__(self, x: np.ndarray, labels: list[int], dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS):
        """From term vectors (rows of ``x``) and their labels."""
        self.neighbours = min(neighbours, len(labels))
        self.labels = np.array(labels, np.float32)
        if not len(labels):
            return
        self.mean = x.mean(0)
        x = x - self.mean
        value, vector = np.linalg.eigh(x.T @ x)
        self.axes = np.ascontiguousarray(vector[:, ::-1][:, :dimensions], np.float32)
        self.vectors = self._latent(x)
        self.prior = float(self.labels.mean())

    def _latent(self, centred: np.ndarray) -> np.ndarray:
        z = centred @ self.axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Scores of whole texts; null counts as empty. 0.5 without any label."""
        out = np.full(len(texts), 0.5)
        if not self.neighbours:
            return out
        for at in range(0, len(texts), BLOCK):
            x = np.array([terms(t or "") for t in texts[at : at + BLOCK]])
            cosine = self._latent(x - self.mean) @ self.vectors.T
            near = np.argpartition(-cosine, self.neighbours - 1, axis=1)[:, : self.neighbours]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** 4 + 1e-6
            out[at : at + BLOCK] = (weight * self.labels[near]).sum(1) / weight.sum(1)
        return np.clip(out, 0, 1)


def train(docs: DataFrame, labels: DataFrame, allowed, sample: int = SAMPLE) -> Model:
    """Fits on the labelled rows that are ``allowed`` (a condition on doc_id),
    ``sample`` at most. Null labels and texts are left out; of an id's several
    labels the smallest counts. Term vectors, whose size is fixed, come to the
    driver, not texts."""
    usable = labels.filter(allowed & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    first = usable.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(sample)
    label = {r.doc_id: r.quality for r in first.collect()}
    usable_docs = docs.filter(F.col("doc_id").isin(list(label)) & F.col("text").isNotNull()).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # Half precision holds what the fit needs.
            vectors = [zlib.compress(terms(t).astype(np.float16).tobytes(), 1) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(vectors, pa.binary())], names=["doc_id", "vector"])

    # Rows that repeat an id count once, so that what is collected stays bounded.
    found = usable_docs.mapInArrow(run, "doc_id long, vector binary").groupBy("doc_id").agg(F.min("vector").alias("vector"))
    rows = sorted(found.collect()) if label else []
    x = np.array([np.frombuffer(zlib.decompress(r.vector), np.float16) for r in rows], np.float32)
    return Model(x, [label[r.doc_id] for r in rows])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``quality_score`` (0 to 1) to ``docs``, which keeps its columns (that
    one is replaced). Every text is compared with every labelled vector, in
    blocks. Null texts score as empty ones."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("quality_score")
    column = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = held.value.scores(b.column(column).to_pylist())
            yield pa.record_batch([*b.columns, pa.array(scores)], names=[*b.schema.names, "quality_score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("quality_score", T.DoubleType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels"), crc_remainder("doc_id", 5) != 0)
    held_out = F.coalesce(crc_remainder("doc_id", 5) == 0, F.lit(False))
    scored = score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))
