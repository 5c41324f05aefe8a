"""Fill-in-middle transformation of texts that are stored as compressed frames."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import FRAME, FRAMES, Frames, packed
from .tables import read

#: Bytes of frames in a batch that is given on.
BATCH = 8 << 20


@dataclass(frozen=True)
class Marks:
    """What is put before prefix, suffix and middle. Marks must be told apart
    wherever they meet text: none may hold another, nor end as one begins."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        if not all(marks) or any(a in b for i, a in enumerate(marks) for j, b in enumerate(marks) if i != j):
            raise ValueError("marks are empty, or one holds another")
        if any(a[-n:] == b[:n] for a in marks for b in marks for n in range(1, min(len(a), len(b)))):
            raise ValueError("a mark ends as one begins")

    def encoded(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


_FRAMES = pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("open", pa.bool_()), ("data", pa.binary())]))


def _batches(rows: Iterator[tuple], names: list[str], kinds: list) -> Iterator[pa.RecordBatch]:
    """Batches of about BATCH bytes of frames, which are the rows' last field."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 256 + sum(len(f["data"]) for f in row[-1] or ())
        if size > BATCH:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame: int = FRAME) -> DataFrame:
    """``doc_id``, ``n`` (units), ``n_chars``, ``n_bytes`` and ``frames`` of each row;
    null texts are empty ones, which have no frame. Ids are returned as they are,
    null and repeated ones too; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                    f = packed([text.as_py().encode()] if text.is_valid else [], frame)
                    yield i, f.units, f.chars, f.bytes, f.held

        yield from _batches(rows(), ["doc_id", "n", "n_chars", "n_bytes", "frames"], [pa.int64()] * 4 + [_FRAMES])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, f"doc_id long, n long, n_chars long, n_bytes long, frames {FRAMES}")


def _draws(seed: int, doc_id: int | None) -> list[int]:
    hex_ = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(hex_[i : i + 8], 16) for i in range(0, 32, 8)]


def fill_in_middle(stored: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80, marks: Marks = Marks(), frame: int = FRAME) -> DataFrame:
    """The transformed texts of a table of ``store``: ``doc_id``, ``n``, ``form``
    (plain, psm, spm), ``prefix_chars`` and ``middle_chars`` (null if plain),
    ``n_chars``, ``n_bytes`` and ``frames`` of the output.

    Four numbers drawn from ``seed`` and the id choose two cuts between units
    (by which only the frames that hold them are decompressed), whether a text
    changes (``rate`` percent) and whether its suffix comes first (``spm``
    percent of these). Empty texts and those that hold a mark are plain. Rows
    of equal ids and texts come out equal; null ids draw as one id. Nothing is
    shuffled, and of an output only one frame is in memory uncompressed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, s, m = marks.encoded()

        def output(text: Frames, form: str, first: int, second: int) -> Iterator[bytes]:
            head = (p, text.stream(0, first)), (s, text.stream(second))
            for mark, part in (*(head if form == "psm" else reversed(head)), (m, text.stream(first, second))):
                yield mark
                yield from part

        def rows():
            for b in batches:
                for doc_id, n, chars, size, held in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "n_chars", "n_bytes", "frames"))):
                    text = Frames(frame, held, n, chars, size)
                    a, c, change, order = _draws(seed, doc_id)
                    if not size or change % 100 >= rate or any(text.find(x) >= 0 for x in (p, s, m)):
                        yield doc_id, n, "plain", None, None, chars, size, held
                        continue
                    (before, first), (upto, second) = (text.cut(x) for x in sorted((a % (n + 1), c % (n + 1))))
                    form = "spm" if order % 100 < spm else "psm"
                    out = packed(output(text, form, first, second), frame)
                    yield doc_id, n, form, before, upto - before, out.chars, out.bytes, out.held

        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "n_chars", "n_bytes", "frames"]
        yield from _batches(rows(), names, [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4, _FRAMES])

    return stored.mapInArrow(run, f"doc_id long, n long, form string, prefix_chars long, middle_chars long, n_chars long, n_bytes long, frames {FRAMES}")


def original(output: Frames, form: str, marks: Marks = Marks()) -> Iterator[bytes]:
    """The text from an output and its form alone: the marks are sought in the
    stream of frames, then prefix, middle and suffix are streamed in this order."""
    p, s, m = marks.encoded()
    if form == "plain":
        yield from output.stream()
        return
    lead, follow = (p, s) if form == "psm" else (s, p)
    second = output.find(follow, len(lead))
    third = output.find(m, second + len(follow))
    one, two = (len(lead), second), (second + len(follow), third)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    for begin, end in (prefix, (third + len(m), output.bytes), suffix):
        yield from output.stream(begin, end)


def texts(transformed: DataFrame, restored: bool = False, marks: Marks = Marks()) -> DataFrame:
    """``doc_id``, ``text``: the outputs, or (``restored``) the texts before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(len(b)):
                row = b.slice(at, 1).to_pylist()[0]
                out = Frames(FRAME, row["frames"], 0, row["n_chars"], row["n_bytes"])
                parts = original(out, row["form"], marks) if restored else out.stream()
                yield pa.record_batch([pa.array([row["doc_id"]], pa.int64()), pa.array([b"".join(parts).decode()], pa.string())], names=["doc_id", "text"])

    return transformed.mapInArrow(run, "doc_id long, text string")


def with_digests(transformed: DataFrame, marks: Marks = Marks()) -> DataFrame:
    """``output_sha256`` and ``restored_sha256`` instead of the frames, both digests
    of streams of frames."""
    kept = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]

    def digest(parts: Iterator[bytes]) -> str:
        h = hashlib.sha256()
        for part in parts:
            h.update(part)
        return h.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            outs, backs = [], []
            for form, size, held in zip(*(b.column(c).to_pylist() for c in ("form", "n_bytes", "frames"))):
                out = Frames(FRAME, held, n_bytes=size)
                outs.append(digest(out.stream()))
                backs.append(digest(original(out, form, marks)))
            yield pa.record_batch([*[b.column(c) for c in kept], pa.array(outs, pa.string()), pa.array(backs, pa.string())], names=[*kept, "output_sha256", "restored_sha256"])

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return transformed.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_digests(fill_in_middle(store(read(spark, sf_dir, "documents"))))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
        CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
