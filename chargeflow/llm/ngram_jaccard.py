"""Near duplicates by the Jaccard similarity of word shingles."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import connected_components
from .signature_tree import bitmap, folded, linked_pairs, possible_links
from .tables import materialize, read, runs
from .words import shingle_sets

#: Shingles of the sets that one traversal holds: 32 MB.
BLOCK = 4_000_000
#: Counters of shingles' frequencies, and the rows in which a task hands them on.
COUNTERS, SLICES = 1 << 22, 16
#: Shingles that are counted together.
HELD = 1 << 19

_A = np.uint64(0x9FB21C651E98DF25)


def _digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: equal sets, equal digests."""
    pair = np.array([(s * _A).sum(), ((s ^ (s >> np.uint64(29))) * (s | np.uint64(1))).sum()], np.uint64).view(np.int64)
    return int(pair[0]), int(pair[1])


def _counter(s: np.ndarray) -> np.ndarray:
    return (s & np.uint64(COUNTERS - 1)).astype(np.int64)


def _sized(k: int):
    """Of each row its set's size and digest; then, with ``slice``, the task's counts
    of shingles by counter, 255 at most each."""
    names = ["doc_id", "n", "d1", "d2", "slice", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, many = np.zeros(COUNTERS, np.uint8), [], 0

        def add() -> None:
            at, n = np.unique(np.concatenate(held), return_counts=True)
            total[at] = np.minimum(total[at] + n, 255)

        for b in runs(batches):
            n, d1, d2 = [], [], []
            for s in shingle_sets(b.column(1), k):
                x, y = _digest(s)
                n.append(len(s))
                d1.append(x)
                d2.append(y)
                held.append(_counter(s).astype(np.int32))
                many += len(s)
                if many > HELD:
                    add()
                    held, many = [], 0
            digests = [pa.array(d, pa.int64()) for d in (n, d1, d2)]
            yield pa.record_batch([b.column(0), *digests, pa.nulls(len(b), pa.int32()), pa.nulls(len(b), pa.binary())], names=names)
        if held:
            add()
        if total.any():
            parts = total.reshape(SLICES, -1)
            none = pa.nulls(SLICES, pa.int64())
            yield pa.record_batch([none, none, none, none, pa.array(range(SLICES), pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())], names=names)

    return run


def _levels(counted: DataFrame) -> np.ndarray:
    """Of each counter how frequent its shingles are in the corpus: twice the binary
    logarithm of its count over the mean. Four megabytes, whatever the corpus."""
    mean = max(1.0, (counted.agg(F.sum("n")).first()[0] or 0) / COUNTERS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[k] = total.get(k, 0) + np.frombuffer(zlib.decompress(c), np.uint8).astype(np.int64)
        levels = [np.floor(2 * np.log2(np.maximum(1, c / mean))).astype(np.uint8).tobytes() for c in total.values()]
        yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array(levels, pa.binary())], names=["slice", "levels"])

    rows = counted.filter("slice is not null").select("slice", "counts").repartition(SLICES, "slice").mapInArrow(add, "slice int, levels binary").collect()
    return np.frombuffer(b"".join(r.levels for r in sorted(rows)), np.uint8) if rows else np.zeros(COUNTERS, np.uint8)


def prefix_length(n: int, num: int, den: int) -> int:
    """Two sets at num/den or above share one of the first so many shingles of
    each, in any order that is the same for both."""
    return n - (num * n + den - 1) // den + 1


def prefix(s: np.ndarray, levels: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of which two sets at num/den or above have one in common: the set's first
    shingles, rare ones before frequent ones, equal ones by their hash."""
    order = levels[_counter(s)].astype(np.uint64) << np.uint64(56) | s >> np.uint64(8)
    p = prefix_length(len(s), num, den)
    return np.partition(order, p - 1)[:p] if p < len(s) else order


def _keyed(k: int, num: int, den: int, held):
    """(doc_id, digest, size, bitmap, keys) of the first row of each set in a task;
    later rows of the set are its copies."""
    names = ["doc_id", "d1", "d2", "n", "bits", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, seen = held.value, set()
        for b in runs(batches):
            rows: list[tuple] = []
            ends, flat = [0], [np.empty(0, np.uint64)]
            if len(seen) > 1_000_000:
                seen.clear()
            for doc, s in zip(b.column(0).to_pylist(), shingle_sets(b.column(1), k)):
                if not len(s) or (d := _digest(s)) in seen:
                    continue
                seen.add(d)
                bits = folded(bitmap(s)[None], max(64, 1 << (len(s) - 1).bit_length()) // 64)
                rows.append((doc, *d, len(s), bits.tobytes()))
                flat.append(prefix(s, levels, num, den))
                ends.append(ends[-1] + len(flat[-1]))
            keys = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat).view(np.int64)))
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.record_batch([*(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)), keys], names=names)

    return run


def _traversals(batches: Iterator[pa.RecordBatch], rows_of) -> Iterator[tuple[dict, pa.RecordBatch | None]]:
    """The rows of each traversal, which follow each other, by set: the first row of each."""
    key, held = None, {}
    for b in runs(batches):
        for task, d, row in rows_of(b):
            if task != key:
                if len(held) > 1:
                    yield held
                key, held = task, {}
            if d is not None:
                held.setdefault(d, row)
    if len(held) > 1:
        yield held


def _sides(rows: list[tuple]) -> np.ndarray | None:
    sides = np.array([r[1] for r in rows])
    return None if sides[0] < 0 else sides


def _possible(num: int, den: int):
    """Links that bitmaps and sizes don't rule out, as many as span the groups of each traversal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(b):
            for task, rep, side, n, bits in zip(*(c.to_pylist() for c in b.columns)):
                yield task, (rep, n, bits), (rep, side, n, bits)

        for held in _traversals(batches, rows_of):
            rows = list(held.values())
            links = possible_links([np.frombuffer(r[3], np.uint64) for r in rows], np.array([r[2] for r in rows]), num, den, _sides(rows))
            yield pa.record_batch([pa.array([rows[link[x]][0] for link in links], pa.int64()) for x in (0, 1)], names=["a", "b"])

    return run


def _links(k: int, num: int, den: int, count: bool):
    """``a``, ``b``: exact links that span the groups of each traversal, where ``n`` is
    null; with ``count`` there is also a row for each set that has links here: its
    ``d1``, ``d2`` and the documents ``n`` it links with."""
    names = ["a", "b", "d1", "d2", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(b):
            for task, rep, side, copies, d1, d2, s in zip(*(c.to_pylist() for c in b.columns[:6]), shingle_sets(b.column(6), k)):
                # A repeated id may have other texts.
                yield task, (d1, d2) if _digest(s) == (d1, d2) else None, (rep, side, copies, s)

        for held in _traversals(batches, rows_of):
            rows = list(held.values())
            counts = np.zeros(len(rows), np.int64) if count else None
            pairs = linked_pairs([r[3] for r in rows], num, den, _sides(rows), counts, np.array([r[2] for r in rows]))
            out: list[tuple] = [(rows[i][0], rows[j][0], None, None, None) for i, j in pairs]
            out += [(None, None, *d, int(n)) for d, n in zip(held, counts) if n] if count else []
            yield pa.record_batch([pa.array([r[i] for r in out], pa.int64()) for i in range(5)], names=names)

    return run


def _tasks(cells: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """The rows of ``cells`` (``cell``, a set's ``rep``, ``d1``, ``d2``, ``n``, ``copies``)
    with ``task`` and ``side``: the traversals that a set takes part in; the side is -1
    where there are not two. A cell of up to ``block`` shingles is one. In a larger
    one, sets are dealt to blocks by size class (a pair's classes differ by one at
    most) and hash; each pair of blocks that can hold a pair of sets is a traversal."""
    own = ["rep", "copies", "d1", "d2", "n"]
    total = cells.groupBy("cell").agg(F.sum("n").alias("total"))
    cells = cells.join(total, "cell")
    small = cells.filter(F.col("total") <= block).select(*own, F.col("cell").cast("string").alias("task"), F.lit(-1).alias("side"))
    class_ = F.floor(F.log("n") / F.log(F.lit(den / num)) + 1e-9)
    large = cells.filter(F.col("total") > block).withColumn("class", class_)
    parts = large.groupBy("cell", "class").agg(F.ceil(F.sum("n") * 2 / block).alias("parts"))
    large = large.join(parts, ["cell", "class"]).select(*own, "cell", "class", F.pmod(F.xxhash64("d1", "d2"), F.col("parts")).alias("part"))
    blocks = parts.select("cell", "class", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    other = blocks.select("cell", F.col("class").alias("class2"), F.col("part").alias("part2"))
    after = (F.col("class2") == F.col("class") + 1) | ((F.col("class2") == F.col("class")) & (F.col("part2") >= F.col("part")))
    pairs = blocks.join(other, "cell").filter(after)
    task = F.concat_ws("/", "cell", "class", "part", "class2", "part2")
    same = (F.col("class2") == F.col("class")) & (F.col("part2") == F.col("part"))
    seats = pairs.select("cell", "class", "part", task.alias("task"), F.when(same, -1).otherwise(0).alias("side")).union(
        pairs.filter(~same).select("cell", F.col("class2"), F.col("part2"), task, F.lit(1))
    )
    return small.union(large.join(seats, ["cell", "class", "part"]).select(*own, "task", "side"))


def _cells(docs: DataFrame, reps: DataFrame, levels: np.ndarray, k: int, num: int, den: int, block: int) -> DataFrame:
    """``rep``, ``cell``: sets that can be linked, directly or in a chain, by all that
    their sizes and bitmaps tell. Sets without a partner are in no cell."""
    held = docs.sparkSession.sparkContext.broadcast(levels)
    keyed = materialize(docs.filter("doc_id is not null").mapInArrow(_keyed(k, num, den, held), "doc_id long, d1 long, d2 long, n long, bits binary, keys array<long>"))
    # Of a key's sets, in order of size, only those need a look that have one beside
    # them within the ratio; a wider step parts the group.
    by_size = Window.partitionBy("key").orderBy("n")
    near = lambda a, b: F.coalesce(F.col(b) * den >= F.col(a) * num, F.lit(False))
    keys = keyed.select("doc_id", "n", F.explode("keys").alias("key"))
    beside = keys.withColumns({"below": F.lag("n").over(by_size), "above": F.lead("n").over(by_size)})
    step = F.sum(F.when(near("n", "below"), 0).otherwise(1)).over(by_size.rowsBetween(Window.unboundedPreceding, 0))
    several = beside.withColumn("step", step).filter(near("n", "below") | near("above", "n")).select("key", "step", "doc_id")
    sets = keyed.select("doc_id", "d1", "d2").distinct()
    groups = several.select(F.concat_ws("/", "key", "step").alias("cell"), "doc_id").join(sets, "doc_id").select("cell", "d1", "d2").distinct()
    groups = materialize(groups)
    # Groups of the same sets say the same: one of them stands for all.
    member = F.xxhash64("d1", "d2")
    alike = groups.groupBy("cell").agg(F.count(F.lit(1)).alias("sets"), F.sum(member % (1 << 31)).alias("s1"), F.bit_xor(member).alias("s2")).filter("sets > 1")
    stand = alike.groupBy("sets", "s1", "s2").agg(F.min("cell").alias("cell")).select("cell")
    cells = groups.join(stand, "cell").join(reps, ["d1", "d2"]).select("cell", "rep", "d1", "d2", "n", F.lit(1).cast("long").alias("copies"))
    tasks = _tasks(materialize(cells), num, den, block)
    # Equal sets have equal bitmaps: any will do.
    bits = keyed.select("d1", "d2", "bits").join(reps, ["d1", "d2"], "left_semi").groupBy("d1", "d2").agg(F.min("bits").alias("bits"))
    seated = tasks.join(bits, ["d1", "d2"]).select("task", "rep", "side", "n", "bits")
    seated = seated.repartition("task").sortWithinPartitions("task", "rep")
    edges = seated.mapInArrow(_possible(num, den), "a long, b long")
    return connected_components(edges).select(F.col("node").alias("rep"), F.col("component").alias("cell"))


def jaccard_groups(
    docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, count: bool = False
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for each row of ``docs``, and
    with ``count`` ``n_links``: how many other documents the row's document links
    with, where documents are the distinct pairs of id and set, without null ids.

    A document's set holds its distinct k-word shingles (A-Z as a-z, words
    parted by white space; fewer words are one shingle; no words, no set, no
    link). Documents link when den * intersection >= num * union;
    ``component_id`` is the smallest id that links reach.

    1. Equal sets collapse to one: copies cost nothing further.
    2. Two sets that link share one of the first shingles of each, rare ones
       first by a fixed-size count of all shingles: passages that many documents
       share are frequent and give no keys. In the group of each such shingle a
       signature tree (OR-combined bitmaps and size ranges) is traversed in
       pairs, on the sets' bitmaps alone, pruned by the largest possible overlap.
    3. Sets whose pairs are left, directly or in a chain, are one cell: no link
       leaves it. Only their texts are brought together, traversed by the same
       trees and compared exactly; without ``count``, a pair that is linked by
       others already isn't looked at. Groups and cells over ``block`` shingles
       are traversed block by block, in many tasks.
    4. The links found span each group; their components are the result.

    Nothing is capped or sampled: ``block`` and the counts change the cost only.
    Sets are compared by 64-bit hashes of shingles. Rows with a null id are
    returned with a null component and link with nothing; rows that repeat an id
    are one node, and each is returned. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = materialize(docs.mapInArrow(_sized(k), "doc_id long, n long, d1 long, d2 long, slice int, counts binary"))
    sets = counted.filter("slice is null").select("doc_id", "n", "d1", "d2")
    named = sets.filter("n > 0 and doc_id is not null")
    ids = named.select("doc_id", "d1", "d2").distinct()
    reps = materialize(named.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")))

    cells = materialize(_cells(docs, reps, _levels(counted), k, num, den, block))
    copies = materialize(ids.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("copies"))) if count else None
    members = cells.join(reps, "rep")
    members = members.join(copies, ["d1", "d2"]) if count else members.withColumn("copies", F.lit(1).cast("long"))
    tasks = _tasks(materialize(members), num, den, block)
    held = docs.join(tasks, docs["doc_id"] == tasks["rep"]).select("task", "rep", "side", "copies", "d1", "d2", "text")
    held = held.repartition("task").sortWithinPartitions("task", "rep")
    looked = held.mapInArrow(_links(k, num, den, count), "a long, b long, d1 long, d2 long, n long")
    if count:
        looked = materialize(looked)
    links = looked.filter("a is not null").select("a", "b")

    # Ids that stand for several sets join these.
    several = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    of_several = several.join(ids, "doc_id").join(reps, ["d1", "d2"]).select("doc_id", "rep")
    found = connected_components(links.union(of_several)).select(F.col("node").alias("rep"), "component")
    of_set = reps.join(found, "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    linked = sets.filter("n > 0").join(of_set, ["d1", "d2"], "left")
    out = [F.col("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")]
    if not count:
        return linked.select(*out).union(sets.filter("n = 0").select("doc_id", "n", "doc_id"))
    # Copies of the set itself, and what its traversals have counted.
    others = looked.filter("n is not null").groupBy("d1", "d2").agg(F.sum("n").alias("others"))
    of_links = copies.join(others, ["d1", "d2"], "left").select("d1", "d2", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    linked = linked.join(of_links, ["d1", "d2"], "left")
    out.append(F.when(F.col("doc_id").isNotNull(), F.col("n_links")).otherwise(0).alias("n_links"))
    return linked.select(*out).union(sets.filter("n = 0").select("doc_id", "n", "doc_id", F.lit(0).cast("long")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(read(spark, sf_dir, "documents"), k=3, num=9, den=10, count=True)
