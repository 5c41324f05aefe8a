"""Times that depend on the row before, as an associative scan.

Each row maps the time before it to its own: a constant; the next time at which a
clock shows a value; or, for values that must not go back, "up to ``t`` it is ``c``,
beyond it goes on". All are of one form, x <= t -> c, else g(x) + k, where g leaves x
or takes the next moment of a time of day. Such maps compose to one of the same
form (they never fall as x grows), so that a stretch of any length is four numbers,
stretches of a file combine in any grouping, and each is then replayed by itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import written

DAY = 86_400_000_000
#: Times beyond which a threshold always or never holds.
ALWAYS, NEVER = 1 << 61, -(1 << 61)
BIG = 1 << 60
KINDS = {"abs": 0, "clock": 1, "minutes": 2, "number": 3}


class Maps(NamedTuple):
    """x <= t -> c, else g(x) + k; g is the next moment of ``tod`` (-1: x itself)."""

    t: np.ndarray
    c: np.ndarray
    tod: np.ndarray
    k: np.ndarray

    def __call__(self, x):
        step = np.where(self.tod >= 0, (self.tod - x) % DAY, 0)
        return np.where(x <= self.t, self.c, x + step + self.k)

    def at(self, i) -> Maps:
        return Maps(*(f[i] for f in self))


def identity(n: int) -> Maps:
    return Maps(np.full(n, NEVER), np.zeros(n, np.int64), np.full(n, -1), np.zeros(n, np.int64))


def constant(values: np.ndarray) -> Maps:
    n = len(values)
    return Maps(np.full(n, ALWAYS), np.asarray(values, np.int64), np.full(n, -1), np.zeros(n, np.int64))


def then(f: Maps, g: Maps) -> Maps:
    """First ``f``, then ``g``, element by element."""
    # Up to which x the second threshold holds beyond the first.
    reach = g.t - f.k
    reach = np.where(f.tod >= 0, reach - (reach - f.tod) % DAY, reach)
    reach = np.where(g.t >= BIG, ALWAYS, np.where(g.t <= -BIG, NEVER, reach))
    c = np.where(reach > f.t, g.c, g(f.c))
    both = (f.tod >= 0) & (g.tod >= 0)
    tod = np.where(f.tod >= 0, f.tod, np.where(g.tod >= 0, (g.tod - f.k) % DAY, -1))
    k = f.k + g.k + np.where(both, (g.tod - f.tod - f.k) % DAY, 0)
    return Maps(np.maximum(f.t, reach), c, tod, k)


def joined(maps: Maps) -> Maps:
    """All of them in order, as one."""
    while len(maps.t) > 1:
        if len(maps.t) % 2:
            one = identity(1)
            maps = Maps(*(np.concatenate([a, b]) for a, b in zip(maps, one)))
        maps = then(maps.at(slice(0, None, 2)), maps.at(slice(1, None, 2)))
    return maps if len(maps.t) else identity(1)


def scanned(maps: Maps) -> Maps:
    """Of each the composition of all up to it."""
    step = 1
    while step < len(maps.t):
        tail = then(maps.at(slice(None, -step)), maps.at(slice(step, None)))
        maps = Maps(*(np.concatenate([a[:step], b]) for a, b in zip(maps, tail)))
        step *= 2
    return maps


def row_maps(kind: np.ndarray, at: np.ndarray, after_number: np.ndarray) -> Maps:
    """The map of each row. ``at``: its time, or time of day of a clock; ``after_number``:
    the last valid row before it is a number. Kind -1 is a bad row, which carries nothing."""
    out = identity(len(kind))
    fixed = (kind == 0) | ((kind == 3) & ~after_number)
    held = (kind == 2) | ((kind == 3) & after_number)
    out.t[fixed], out.c[fixed] = ALWAYS, at[fixed]
    out.t[held], out.c[held] = at[held], at[held]
    out.k[kind == 2] = 1_000_000
    out.tod[kind == 1] = at[kind == 1]
    return out


def last_valid(kind: np.ndarray, before: int) -> np.ndarray:
    """The kind of the last valid row before each, ``before`` that before the first."""
    where = np.where(kind >= 0, np.arange(len(kind)), -1)
    upto = np.concatenate([[-1], np.maximum.accumulate(where)[:-1]]) if len(kind) else where
    return np.where(upto >= 0, kind[upto], before)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Pieces of batches in which file and block stay the same."""
    for b in batches:
        if not len(b):
            continue
        files, blocks = b.column("_file"), b.column("_block").to_numpy()
        codes = files.dictionary_encode().indices.to_numpy()
        edges = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1).tolist(), len(b)]
        for i, j in zip(edges, edges[1:]):
            yield files[i].as_py(), int(blocks[i]), b.slice(i, j - i)


def _columns(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    kind = piece.column("_code").to_numpy(zero_copy_only=False).astype(np.int64)
    return kind, piece.column("_at").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


_SUMMARY = "_file string, _block long, _base long, last_kind long, f_t long, f_c long, f_tod long, f_k long, n_t long, n_c long, n_tod long, n_k long"
_FIELDS = [f.split()[0] for f in _SUMMARY.split(", ")]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block two maps: when the valid row before it is no number (f), and when it is one (n)."""
    held: list | None = None

    def packed(x: list) -> pa.RecordBatch:
        row = [x[0], x[1], x[2], x[5], *(int(v[0]) for m in (x[3], x[4]) for v in m)]
        return pa.record_batch([pa.array([v], pa.string() if i == 0 else pa.int64()) for i, v in enumerate(row)], names=_FIELDS)

    for file, block, piece in _runs(batches):
        kind, at = _columns(piece)
        if held is None or held[:2] != [file, block]:
            if held:
                yield packed(held)
            held = [file, block, piece.column("_base")[0].as_py(), identity(1), identity(1), -1]
        for slot, code in ((3, 0), (4, 3)):
            before = held[5] if held[5] >= 0 else code
            held[slot] = then(held[slot], joined(row_maps(kind, at, last_valid(kind, before) == 3)))
        valid = kind[kind >= 0]
        if len(valid):
            held[5] = int(valid[-1])
    if held:
        yield packed(held)


_STARTS = "_file string, _block long, _last long, _kind_before long"


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The time and kind of the valid row before each block of a file; its month's begin before the first."""
    for b in batches:
        out = []
        for file, blocks in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            last, kind = blocks[0]["_base"], -1
            for x in blocks:
                out.append((file, x["_block"], last, kind))
                name = "n" if kind == 3 else "f"
                own = Maps(*(np.array([x[f"{name}_{f}"]]) for f in Maps._fields))
                last = int(own(np.array([last]))[0])
                kind = x["last_kind"] if x["last_kind"] >= 0 else kind
        names = [f.split()[0] for f in _STARTS.split(", ")]
        yield pa.record_batch([pa.array([r[i] for r in out], pa.string() if i == 0 else pa.int64()) for i in range(4)], names=names)


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``_us``: each row's time; null of a bad row. Goes from batch to batch of a block."""
    key, last, before = None, 0, -1
    for file, block, piece in _runs(batches):
        if (file, block) != key:
            key, last, before = (file, block), piece.column("_last")[0].as_py(), piece.column("_kind_before")[0].as_py()
        kind, at = _columns(piece)
        upto = scanned(row_maps(kind, at, last_valid(kind, before) == 3))
        times = upto(np.full(len(kind), last))
        last = int(times[-1])
        valid = kind[kind >= 0]
        before = int(valid[-1]) if len(valid) else before
        yield piece.append_column("_us", pa.array(times, pa.int64(), mask=kind < 0))


def times_in_order(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``_us`` (microseconds, null of bad rows) to rows of files, which ``keys`` tell
    apart and whose lines ``order`` sorts. Rows have ``_code`` (KINDS, -1: bad),
    ``_at`` (see ``row_maps``) and ``_base``, the begin of the file's month.

    Lines are dealt to ranges of (file, order): a file of any length is worked on by
    as many tasks as it needs, once for the blocks' maps and once to replay them.
    Only a row a block comes together by file in between.
    """
    dealt = rows.withColumn("_file", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})).repartitionByRange("_file", *order).sortWithinPartitions("_file", *order)
    dealt = written(dealt.withColumns({"_block": F.spark_partition_id().cast("long"), "_row": F.monotonically_increasing_id()}))
    # A block's rows come back in order, whatever the files they were written to.
    in_blocks = dealt.select("_file", "_block", "_row", "_code", "_at", "_base").repartition("_block").sortWithinPartitions("_block", "_row")
    blocks = in_blocks.mapInArrow(_summaries, _SUMMARY)
    by_file = blocks.groupBy("_file").agg(F.array_sort(F.collect_list(F.struct(*_FIELDS[1:]))).alias("blocks"))
    starts = by_file.mapInArrow(_starts, _STARTS)
    ready = dealt.join(starts, ["_file", "_block"]).repartition("_block").sortWithinPartitions("_block", "_row")
    schema = ", ".join(f"`{n}` {k}" for n, k in ready.dtypes)
    return ready.mapInArrow(_replayed, f"{schema}, _us long").drop("_file", "_block", "_row", "_last", "_kind_before")
