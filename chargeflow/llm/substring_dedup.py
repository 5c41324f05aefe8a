"""Removal of repeated passages by hashing lines and their sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import read

#: A unit of at least so many words is compared by itself, a shorter one joined with those beside it.
MIN_WORDS = 8
#: A unit is what lies between two line ends, or two ends of sentences with white space after them.
#: A run of white space is tried from its first character only.
UNIT_END = re.compile(r"(?<=[.!?])[\x20\x09-\x0D]+|(?<![\x20\x09-\x0D])[\x20\x09-\x0D]*[\n\r][\x20\x09-\x0D]*")
_FOLD = re.compile(r"[\W_]+")


def normalised(unit: str) -> str:
    """Lower case, letters and digits only, one blank between words."""
    return _FOLD.sub(" ", unit.lower()).strip()


def units(text: str) -> list[tuple[int, int]]:
    """(start, end) of each unit of a whole text, in code points."""
    out, at = [], 0
    for m in UNIT_END.finditer(text):
        if m.start() > at:
            out.append((at, m.start()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


def keys(text: str, min_words: int = MIN_WORDS) -> list[tuple[int, int, str]]:
    """(start, end, key) of each stretch that is compared: equal keys mark repeats.
    A unit of ``min_words`` is one. From a shorter unit on, and back from it,
    units are joined until they hold so many words, so that a common short
    sentence is a repeat only inside a repeated passage, and any passage of so
    many words is covered to its first and last unit. Units without letters or
    digits are passed over. A text of fewer words is one stretch with both its
    ends, which equals only such texts."""
    spans = [(a, b, f) for a, b in units(text) if (f := normalised(text[a:b]))]
    upto = [0]
    for _, _, f in spans:
        upto.append(upto[-1] + f.count(" ") + 1)
    if upto[-1] < min_words:
        return [(spans[0][0], spans[-1][1], "\n".join(["", *(f for _, _, f in spans), ""]))] if spans else []
    found, last, first = set(), 0, 0
    for i in range(len(spans)):  # the shortest stretch on from each unit
        while last <= len(spans) and upto[last] - upto[i] < min_words:
            last += 1
        if last > len(spans):
            break
        found.add((i, last - 1))
    for j in range(len(spans)):  # and back from each
        while upto[j + 1] - upto[first] >= min_words:
            first += 1
        if first:
            found.add((first - 1, j))
    return [(spans[i][0], spans[j][1], "\n".join(f for _, _, f in spans[i : j + 1])) for i, j in sorted(found)]


def _repeats(doc: np.ndarray, row: np.ndarray, start: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which stretches come after another of the same digest, by (doc, row, start)."""
    order = np.lexsort((start, row, doc, h[:, 1], h[:, 0]))
    again = np.zeros(len(h), bool)
    d, r, s, x = doc[order], row[order], start[order], h[order]
    new = np.concatenate([[True], (x[1:] != x[:-1]).any(1)])
    least = np.flatnonzero(new)[np.cumsum(new) - 1]
    again[order] = (d != d[least]) | (r != r[least]) | (s != s[least])
    return again


def _units_of(min_words: int):
    names = ["doc", "row", "start", "end", "h1", "h2", "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count, start, end, digest = [], [], [], []
            for at in range(0, len(b), 500):
                for text in b.column(2).slice(at, 500).to_pylist():
                    found = keys(text or "", min_words)
                    count.append(len(found))
                    for a, z, key in found:
                        start.append(a)
                        end.append(z)
                        digest.append(xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass")))
            if not digest:
                continue
            doc, row = (np.repeat(b.column(i).to_numpy(), count) for i in (0, 1))
            start, h = np.array(start, np.int32), np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2).copy()
            again = _repeats(doc, row, start, h)
            # What the batch itself shows as repeats need not meet the others: any key will do that no digest has.
            h[again, 0], h[again, 1] = row[again], start[again]
            yield pa.record_batch([pa.array(x) for x in (doc, row, start, np.array(end, np.int32), h[:, 0], h[:, 1], again)], names=names)

    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc``, the rank of an id, null ids last; ``row``, which tells texts of one rank apart."""
    id_ = F.col(id_col).cast("long")
    row = F.xxhash64(F.col(text_col).cast("string"), id_.isNull())
    return docs.select(id_.alias("doc_id"), F.coalesce(id_, F.lit(2**63 - 1)).alias("doc"), row.alias("row"), F.col(text_col).cast("string").alias("text"))


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc``, ``row`` (see ``_rows``), ``start``, ``end`` of every stretch (see ``keys``)
    that occurs before, in code points of the original; stretches overlap.

    They go by the rank (doc, row, start); the first of each digest stays, unless
    it is part of another that occurs before. Of the stretches of an Arrow batch
    only the first of each digest meet those of other batches, in one shuffle: so
    a line that half of all documents have is a row a batch there. Equal rows have
    equal ranks here; ``remove_repeats`` tells them apart.
    """
    found = _rows(docs, id_col, text_col).select("doc", "row", "text").mapInArrow(_units_of(min_words), "doc long, row long, start int, end int, h1 long, h2 long, again boolean")
    rank = F.struct("doc", "row", "start")
    first = F.min(rank).over(Window.partitionBy("h1", "h2"))
    return found.withColumn("first", first).filter(F.col("again") | (rank != F.col("first"))).select("doc", "row", "start", "end")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_units_removed`` (with letters
    or digits), ``removed`` (array of start, end: offsets in the original, adjacent
    ones joined over the white space between them), ``chars_removed`` and
    ``clean_text``.

    Null and empty texts have no units and stay as they are, as do texts without
    repeats. Of rows that repeat both id (null ids too) and text, one counts as
    the first; the others repeat it and lose all their stretches. Rows that
    repeat an id with other texts are documents of their own. Other columns are
    ignored.
    """
    gone = repeated_units(docs, id_col, text_col, min_words)
    gone = gone.groupBy("doc", "row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("gone"))
    # The window and the join part the texts alike: one shuffle.
    copy = F.row_number().over(Window.partitionBy("doc", "row").orderBy("doc", "row")) > 1
    both = _rows(docs, id_col, text_col).withColumn("copy", copy).join(gone, ["doc", "row"], "left").select("doc_id", "text", "gone", "copy")
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count, spans, chars, texts = [], [], [], []
            for text, units_, copy in zip(*(c.to_pylist() for c in b.columns[1:])):
                if copy:
                    units_ = sorted(({"start": a, "end": z} for a, z, _ in keys(text or "", min_words)), key=lambda u: (u["start"], u["end"]))
                joined: list[dict] = []
                for u in units_ or []:
                    if joined and not text[joined[-1]["end"] : u["start"]].strip():
                        joined[-1]["end"] = max(joined[-1]["end"], u["end"])
                    else:
                        joined.append(dict(u))
                kept, at = [], 0
                for s in joined:
                    kept.append(text[at : s["start"]])
                    at = s["end"]
                count.append(sum(bool(normalised(u)) for s in joined for u in UNIT_END.split(text[s["start"] : s["end"]])))
                spans.append(joined)
                chars.append(sum(s["end"] - s["start"] for s in joined))
                texts.append("".join(kept) + text[at:] if joined else text)
            yield pa.record_batch([b.column(0), pa.array(count, pa.int64()), pa.array(spans, span), pa.array(chars, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "n_units_removed", "removed", "chars_removed", "clean_text"])

    return both.mapInArrow(run, "doc_id long, n_units_removed long, removed array<struct<start:int,end:int>>, chars_removed long, clean_text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))
