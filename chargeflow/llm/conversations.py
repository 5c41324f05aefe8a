"""Repair of conversations: the cheapest edits that make the order of roles legal.

A conversation's rows pass a machine over role initials, ``(s?(ua)+)?``. Each row
is kept, given the role that is due, or deleted, and turns that are due may be
inserted anywhere. The costs of a stretch of rows are a 4 x 4 matrix over the
machine's states; matrices combine by (min, +), so that a conversation of any
length is worked on in stretches: one pass makes matrices, a short chain of these
gives each stretch the costs that follow it, and a second pass finds the arcs of
cheapest paths and, among these, the path of the least audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import discard, materialize, read

#: Costs of edits, and of a truncated row that stays.
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after the system's turn, the user's, the assistant's. What is due next, and where a conversation may end.
DUE = (2, 2, 3, 2)
ENDS = (0, 3)
#: Where a kept row of an initial leads.
KEEPS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
LEGAL = ("su", "ua", "au")
FAR = 1 << 50
#: Rows whose paths are ranked at a time, if a stretch has no more.
BLOCK = 1 << 15

_SPACES = " \t\n\x0b\x0c\r"
_NAMES = {2: "user", 3: "assistant"}
_LABELS = "DIKR"


def before_inserts(after: list[int]) -> list[int]:
    """Costs to the end from each state, if turns may be inserted first."""
    b0, b1, b2, b3 = after
    u, a = min(b2, b3 + INSERT), min(b3, b2 + INSERT)
    return [min(b0, u + INSERT), min(b1, u + INSERT), u, a]


def before_row(after: list[int], initial: str, must_go: bool, cut: bool) -> list[int]:
    """Costs to the end from each state, if a row is edited first."""
    out = [x + DELETE for x in after]
    if not must_go:
        for s in range(4):
            out[s] = min(out[s], after[DUE[s]] + RENAME + cut)
            to = KEEPS.get((initial, s))
            if to is not None:
                out[s] = min(out[s], after[to] + cut)
    return out


def _inserted(v: list[int]) -> list[int]:
    u = min(v[2], v[0] + INSERT, v[1] + INSERT, v[3] + INSERT)
    return [v[0], v[1], u, min(v[3], u + INSERT)]


def _edited(v: list[int], initial: str, must_go: bool, cut: bool) -> list[int]:
    out = [x + DELETE for x in v]
    if not must_go:
        for s in range(4):
            out[DUE[s]] = min(out[DUE[s]], v[s] + RENAME + cut)
            to = KEEPS.get((initial, s))
            if to is not None:
                out[to] = min(out[to], v[s] + cut)
    return out


# ---------------------------------------------------------------- facts of rows


def ordered(rows: DataFrame) -> DataFrame:
    """Rows as a written table in order: ``conv`` (the id as text, '' if null), turn,
    role, text, initial, blank, cut, digest, ``chunk`` (the stretch: a partition of
    the order) and ``place`` in it. Null roles and texts are one space."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    shown = F.rtrim(text, F.lit(_SPACES))
    slim = rows.select(
        F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.substring(role, 1, 1).alias("initial"),
        (shown == "").alias("blank"),
        ((shown != "") & ~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
    )
    # The last key parts rows that are equal in all others, so that no group of copies fills a partition.
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "digest", "_copy"]
    dealt = slim.withColumn("_copy", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("_copy")
    return materialize(dealt.withColumns({"chunk": F.spark_partition_id().cast("long"), "place": F.monotonically_increasing_id()}))


def with_duplicates(table: DataFrame) -> DataFrame:
    """The slim columns of ``ordered`` and ``again``: the same role and text stand
    earlier in the conversation. First places are found by partial aggregation."""
    firsts = table.groupBy("conv", "digest").agg(F.min(F.struct("chunk", "place")).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    slim = table.select("conv", "chunk", "place", "turn", "initial", "blank", "cut", "digest")
    again = F.coalesce(F.struct("chunk", "place") > F.col("_first"), F.lit(False)) & ~F.col("blank")
    return slim.join(firsts, ["conv", "digest"], "left").select("conv", "chunk", "place", "turn", "initial", "blank", "cut", again.alias("again"))


# ---------------------------------------------------------------- stretches


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[dict]]]:
    """Rows of sorted batches by conversation and chunk: no more than a chunk at a time."""
    key, held = None, []
    for b in batches:
        for row in b.to_pylist():
            if (now := (row["conv"], row["chunk"])) != key:
                if held:
                    yield *key, held
                key, held = now, []
            held.append(row)
    if held:
        yield *key, held


@dataclass
class Summary:
    """What later steps need of a stretch of rows."""

    conv: str
    chunk: int
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first: str = ""
    last: str = ""
    matrix: list[int] | None = None


def summary_of(conv: str, chunk: int, rows: list[dict]) -> Summary:
    out = Summary(conv, chunk, first=rows[0]["initial"], last=rows[-1]["initial"])
    ways = [[0 if s == t else FAR for t in range(4)] for s in range(4)]
    before = None
    for r in rows:
        must_go = r["blank"] or r["again"]
        cut = r["cut"] and not must_go
        out.blank += r["blank"]
        out.duplicate += r["again"]
        out.truncated += cut
        out.illegal += before is not None and before + r["initial"] not in LEGAL
        before = r["initial"]
        if r["turn"] is not None:
            out.first_turn = r["turn"] if out.first_turn is None else out.first_turn
            out.turns += r["turn"] != out.last_turn
            out.last_turn = r["turn"]
        ways = [_edited(_inserted(v), r["initial"], must_go, cut) for v in ways]
    out.matrix = [x for v in ways for x in v]
    return out


_SUMMARY = "conv string, chunk long, blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long, first string, last string, matrix array<long>"
_KINDS = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}


def _fields(schema: str) -> list[tuple[str, pa.DataType]]:
    return [(f.split()[0], _KINDS[f.split()[1]]) for f in schema.split(", ")]


def _emit(rows: Iterator[tuple], schema: str, at_once: int = 4096) -> Iterator[pa.RecordBatch]:
    fields, held = _fields(schema), []
    for row in rows:
        held.append(row)
        if len(held) == at_once:
            yield pa.record_batch([pa.array(c, k) for c, (_, k) in zip(zip(*held), fields)], names=[n for n, _ in fields])
            held = []
    if held:
        yield pa.record_batch([pa.array(c, k) for c, (_, k) in zip(zip(*held), fields)], names=[n for n, _ in fields])


def summarise(facts: DataFrame) -> DataFrame:
    """A ``Summary`` of each stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _emit((tuple(vars(summary_of(*x)).values()) for x in _stretches(batches)), _SUMMARY)

    return facts.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "place").mapInArrow(run, _SUMMARY)


_TOTALS = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def chained(summaries: DataFrame) -> DataFrame:
    """One row per conversation: its totals, and ``stretches`` with the costs from each
    state at their ends. A conversation has no more summaries than there are
    partitions of the order."""
    parts = F.array_sort(F.collect_list(F.struct("chunk", *[f.split()[0] for f in _SUMMARY.split(", ")[2:]])))
    kind = "stretches array<struct<chunk:bigint,after:array<bigint>,closing:boolean>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_chain(conv, held) for conv, held in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            arrays = [pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(_fields(_TOTALS))]
            stretch = pa.list_(pa.struct([("chunk", pa.int64()), ("after", pa.list_(pa.int64())), ("closing", pa.bool_())]))
            yield pa.record_batch([*arrays, pa.array([r[-1] for r in rows], stretch)], names=[*[n for n, _ in _fields(_TOTALS)], "stretches"])

    return summaries.groupBy("conv").agg(parts.alias("parts")).mapInArrow(run, f"{_TOTALS}, {kind}")


def _chain(conv: str, parts: list[dict]) -> tuple:
    turns = [p for p in parts if p["first_turn"] is not None]
    distinct = sum(p["turns"] for p in turns) - sum(p["last_turn"] == q["first_turn"] for p, q in zip(turns, turns[1:]))
    gaps = turns[-1]["last_turn"] - turns[0]["first_turn"] + 1 - distinct if turns else 0
    illegal = sum(p["illegal"] for p in parts) + sum(p["last"] + q["first"] not in LEGAL for p, q in zip(parts, parts[1:]))
    after = before_inserts([0 if s in ENDS else FAR for s in range(4)])
    stretches = []
    for k, p in enumerate(reversed(parts)):
        stretches.append({"chunk": p["chunk"], "after": after, "closing": k == 0})
        m = p["matrix"]
        after = [min(m[s * 4 + t] + after[t] for t in range(4)) for s in range(4)]
    return conv, gaps, *(sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated")), illegal, after[0], stretches


# ---------------------------------------------------------------- least paths


def optimal_arcs(rows: list[dict], after: list[int], closing: bool) -> list[tuple[int, int]]:
    """(label, next node) of the least-labelled arc on a cheapest path out of each
    node, four nodes (states) a row and four behind the last; (-1, node) where a
    path ends. A node's arcs have different labels, so that an audit tells its path."""
    n = len(rows)
    to_end = [after] * (n + 1)  # with inserts before the row
    edited: list[list[int]] = [after] * n
    for i in range(n - 1, -1, -1):
        r = rows[i]
        must_go = r["blank"] or r["again"]
        edited[i] = before_row(to_end[i + 1], r["initial"], must_go, r["cut"] and not must_go)
        to_end[i] = before_inserts(edited[i])
    out = []
    for i in range(n + 1):
        now, final = to_end[i], i == n
        for s in range(4):
            node = 4 * i + s
            if final and (not closing or (s in ENDS)):
                out.append((-1, node))
                continue
            arcs = []
            if not final:
                r, follow = rows[i], to_end[i + 1]
                must_go = r["blank"] or r["again"]
                cut = r["cut"] and not must_go
                arcs.append((0, 4 * i + 4 + s, DELETE + follow[s]))
                if not must_go:
                    to = KEEPS.get((r["initial"], s))
                    if to is not None:
                        arcs.append((2, 4 * i + 4 + to, cut + follow[to]))
                    arcs.append((3, 4 * i + 4 + DUE[s], RENAME + cut + follow[DUE[s]]))
            arcs.append((1, 4 * i + DUE[s], INSERT + now[DUE[s]]))
            out.append(min((label, to) for label, to, cost in arcs if cost == now[s]))
    return out


def ranked(arcs: list[tuple[int, int]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rank, pointers) of nodes by prefix doubling. After round k a node's rank orders
    the first 2**k labels of its least audit, and pointer k leads to where these
    end; ranks of twice the length come from pairs of ranks. The rounds stop when
    every path has ended. Of equal audits the ranks are equal."""
    label = np.array([a for a, _ in arcs], np.int64)
    to = np.array([t for _, t in arcs], np.int64)
    rank, pointers = np.unique(label, return_inverse=True)[1].astype(np.int64), [to]
    ended = label < 0
    while not ended[pointers[-1]].all():
        p = pointers[-1]
        pairs = rank * (int(rank.max()) + 1) + rank[p]
        rank = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        pointers.append(p[p])
    return rank, pointers


def path(start: int, pointers: list[np.ndarray]) -> np.ndarray:
    """The nodes from ``start`` on: the longest pointer first, then those halfway."""
    nodes = np.array([start], np.int64)
    for p in reversed(pointers):
        nodes = np.stack([nodes, p[nodes]], 1).ravel()
    return nodes


def audits(stretches: list[tuple[list[dict], list[int], bool]]) -> Iterator[tuple[list[int], list[str]]]:
    """For each stretch the state at its end and the least cheapest audit, from each of
    the four states at its begin. Stretches of one call are ranked together."""
    arcs: list[tuple[int, int]] = []
    begins = []
    for rows, after, closing in stretches:
        base = len(arcs)
        # A row has one edit and at most two inserts before it.
        begins.append((base, (3 * len(rows) + 3).bit_length()))
        arcs += [(label, base + to) for label, to in optimal_arcs(rows, after, closing)]
    rank, pointers = ranked(arcs)
    label = np.array([a for a, _ in arcs], np.int64)
    letters = np.frombuffer(_LABELS.encode(), np.uint8)
    for base, rounds in begins:
        ends, found, known = [], [], {}
        for s in range(4):
            # States of one rank have one audit.
            nodes = path(base + s, pointers[:rounds])
            ends.append(int((nodes[-1] - base) % 4))
            r = int(rank[base + s])
            if r not in known:
                taken = label[nodes]
                known[r] = letters[taken[taken >= 0]].tobytes().decode()
            found.append(known[r])
        yield ends, found


_PATHS = "conv string, chunk long, ends array<long>, audits array<string>"


def least_paths(facts: DataFrame, chains: DataFrame) -> DataFrame:
    """``ends`` and ``audits`` of each stretch by the state at its begin."""
    heads = chains.select("conv", F.explode("stretches").alias("_s")).select("conv", F.col("_s.chunk").alias("chunk"), F.lit(-1).cast("long").alias("place"), F.col("_s.after").alias("after"), F.col("_s.closing").alias("closing"))
    # A stretch's costs come as a row before its first.
    mixed = facts.select("conv", "chunk", "place", "initial", "blank", "cut", "again").unionByName(heads, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(keys, block):
            for key, (ends, found) in zip(keys, audits(block)):
                yield *key, ends, found

        def rows():
            keys, block, n = [], [], 0
            for conv, chunk, held in _stretches(batches):
                keys.append((conv, chunk))
                block.append((held[1:], held[0]["after"], held[0]["closing"]))
                n += len(held)
                if n >= BLOCK:
                    yield from results(keys, block)
                    keys, block, n = [], [], 0
            if block:
                yield from results(keys, block)

        yield from _emit(rows(), _PATHS, 512)

    return mixed.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "place").mapInArrow(run, _PATHS)


def composed(paths: DataFrame) -> DataFrame:
    """``conv`` and ``taken``: of each stretch in order, the state at its begin and its
    audit; states are handed on from stretch to stretch."""
    parts = F.array_sort(F.collect_list(F.struct("chunk", "ends", "audits")))
    begin = F.struct(F.lit(0).cast("long").alias("state"), F.array().cast("array<struct<chunk:bigint,begin:bigint,audit:string>>").alias("taken"))
    at = lambda xs, s: F.element_at(xs, (s + 1).cast("int"))
    step = lambda acc, x: F.struct(
        at(x["ends"], acc["state"]).alias("state"),
        F.concat(acc["taken"], F.array(F.struct(x["chunk"].alias("chunk"), acc["state"].alias("begin"), at(x["audits"], acc["state"]).alias("audit")))).alias("taken"),
    )
    return paths.groupBy("conv").agg(F.aggregate(parts, begin, step)["taken"].alias("taken"))


_REPAIRED = "conv string, chunk long, place long, edit string, role string, text string"


def apply_edits(table: DataFrame, taken: DataFrame) -> DataFrame:
    """The rows after repair, deleted ones with their edit ``D`` too; ``place`` counts
    them within the stretch, inserted ones included."""
    heads = taken.select("conv", F.explode("taken").alias("_t")).select("conv", F.col("_t.chunk").alias("chunk"), F.lit(-1).cast("long").alias("place"), F.col("_t.begin").alias("begin"), F.col("_t.audit").alias("audit"))
    mixed = table.select("conv", "chunk", "place", "initial", "role", "text").unionByName(heads, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            key, audit, at, state = None, "", 0, 0

            def due():
                nonlocal at, state
                while audit[at : at + 1] == "I":
                    state = DUE[state]
                    yield *key, at, "I", _NAMES[state], ""
                    at += 1

            for b in batches:
                for r in b.to_pylist():
                    if r["place"] < 0:
                        if key:
                            yield from due()
                        key, audit, at, state = (r["conv"], r["chunk"]), r["audit"], 0, r["begin"]
                        continue
                    yield from due()
                    edit, role = audit[at], r["role"]
                    if edit == "K":
                        state = KEEPS[r["initial"], state]
                    elif edit == "R":
                        state = DUE[state]
                        role = _NAMES[state]
                    yield *key, at, edit, role, r["text"]
                    at += 1
            if key:
                yield from due()

        yield from _emit(rows(), _REPAIRED, 1024)

    return mixed.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "place").mapInArrow(run, _REPAIRED)


@dataclass
class Repair:
    """``rows``: conv_id, chunk, place, edit (K, R, I; D of a deleted row), role, text, in
    the order of chunk and place. ``summary``: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit. Both read written tables, which ``close`` deletes."""

    rows: DataFrame
    summary: DataFrame
    tables: list[DataFrame]

    def close(self) -> None:
        for t in self.tables:
            discard(t)


def _conv_id() -> Column:
    return F.nullif(F.col("conv"), F.lit("")).cast("long").alias("conv_id")


def repair(rows: DataFrame) -> Repair:
    """Repairs a table (conv_id, turn, role, text). Rows go by turn (null first), of
    equal turns by role and a digest of role and text. A row's first fault counts:
    blank, duplicate (role and text stand earlier) or truncated (no [.!?] at the end).
    Blank and duplicate rows are deleted. Null roles and texts are one space; a role
    goes by its first letter, and an unknown one is renamed or deleted. Rows with a
    null conv_id are one conversation; an empty table gives empty results; other
    columns are ignored.

    A conversation of any length is dealt over as many tasks as its rows need: none
    but its matrices and its audit come together.
    """
    table = ordered(rows)
    facts = materialize(with_duplicates(table))
    chains = materialize(chained(summarise(facts)))
    taken = materialize(composed(least_paths(facts, chains)))
    audit = F.array_join(F.transform("taken", lambda t: t["audit"]), "").alias("audit")
    totals = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    summary = chains.join(taken.select("conv", audit), "conv").select(_conv_id(), *totals, "audit")
    edited = apply_edits(table, taken).select(_conv_id(), "chunk", "place", "edit", "role", "text")
    discarded = [table, facts, chains, taken]
    return Repair(edited, summary, discarded)


def repaired_digests(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``repaired_sha256`` of the rows that stay, ``role:text`` joined by
    newlines. A digest is a chain over all of a conversation, so that one task
    streams it in order, and holds a row of it."""
    kept = rows.filter("edit <> 'D'").select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "chunk", "place", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests():
            key, h = None, None
            for b in batches:
                for conv, _, _, role, text in zip(*(c.to_pylist() for c in b.columns)):
                    if conv != key:
                        if h:
                            yield key, h.hexdigest()
                        key, h = conv, hashlib.sha256()
                    else:
                        h.update(b"\n")
                    h.update(f"{role}:{text}".encode())
            if h:
                yield key, h.hexdigest()

        yield from _emit(digests(), "conv string, repaired_sha256 string")

    found = kept.repartition("conv").sortWithinPartitions("conv", "chunk", "place").mapInArrow(run, "conv string, repaired_sha256 string")
    return found.select(_conv_id(), "repaired_sha256")


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's faults, by a checksum of ``conv_id:turn`` (nulls as one space)."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    faulty = rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), fault.alias("_fault")).filter("_fault <> 0")
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fault") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_fault") == 3, 2).otherwise(1)))
    return faulty.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_time")).drop("_time")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = repair(damaged(rows))
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    same = lambda c: F.col("conv_id").eqNullSafe(F.col(c))
    out = every.join(fixed.summary.withColumnRenamed("conv_id", "_c"), same("_c"), "left")
    out = out.join(repaired_digests(fixed.rows).withColumnRenamed("conv_id", "_d"), same("_d"), "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def _oracle() -> str:
    """The same in DuckDB: from a conversation's last row on, the least text of (cost,
    audit, repaired lines) for each state, by one fold over its rows."""

    def before(state: str, cost: str, label: str, line: str) -> str:
        at = f"strpos({state}, chr(1))"
        return f"printf('%08d', CAST({state}[1:8] AS INT) + {cost}) || '{label}' || {state}[9:{at} - 1] || chr(1) || {line} || {state}[{at} + 1:]"

    def named(name: str, value: str, body: str) -> str:
        return f"list_transform([{value}], lambda {name}: {body})[1]"

    def inserted(edited: str) -> str:
        user, assistant = "'user:' || chr(10)", "'assistant:' || chr(10)"
        asked = f"least(e[3], {before('e[4]', '2', 'I', assistant)})"
        first = [f"least(e[{s}], {before('u', '2', 'I', user)})" for s in (1, 2)]
        return named("e", edited, named("u", asked, f"[{first[0]}, {first[1]}, u, least(e[4], {before('e[3]', '2', 'I', user)})]"))

    states = []
    # States count from 1 here: nothing yet, system, user, assistant. Each with what is due and what an initial leads to.
    for s, due, name, kept in ((1, 3, "user", {"s": 2, "u": 3}), (2, 3, "user", {"u": 3}), (3, 4, "assistant", {"a": 4}), (4, 3, "user", {"u": 3})):
        gone = before(f"v[{s}]", "3", "D", "''")
        other = before(f"v[{due}]", "2 + CAST(r[4] AS INT)", "R", f"'{name}:' || r[2] || chr(10)")
        same = " ".join(f"WHEN '{x}' THEN {before(f'v[{to}]', 'CAST(r[4] AS INT)', 'K', 'r[1] || chr(58) || r[2] || chr(10)')}" for x, to in kept.items())
        states.append(f"CASE WHEN r[3] = '1' THEN {gone} ELSE least({gone}, {other}, CASE r[1][1] {same} ELSE {gone} END) END")
    end = inserted("['00000000' || chr(1), '50000000' || chr(1), '50000000' || chr(1), '00000000' || chr(1)]")
    fold = f"list_reduce(rows, lambda v, r: {inserted('[' + ', '.join(states) + ']')}, {end})"
    return rf"""
WITH said AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
crc AS (SELECT k, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1))), 4294967295), 4294967295) % 20 AS fault FROM (SELECT DISTINCT k FROM said)),
hurt AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM said JOIN crc USING (k)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), copy) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown FROM hurt),
facts AS (SELECT *, shown = '' AS blank, shown <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM placed),
marked AS (SELECT *, NOT blank AND NOT again AND right(shown, 1) NOT IN ('.', '!', '?') AS cut FROM facts),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, list([role, text, CASE WHEN blank OR again THEN '1' ELSE '0' END, CASE WHEN cut THEN '1' ELSE '0' END] ORDER BY i DESC) AS rows FROM marked GROUP BY conv_id),
best AS (SELECT *, {fold}[1] AS b FROM sums),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(CAST(b[1:8] AS BIGINT), 0) AS cost, coalesce(b[9:strpos(b, chr(1)) - 1], '') AS audit, sha256(coalesce(regexp_replace(b[strpos(b, chr(1)) + 1:], '
$', ''), '')) AS repaired_sha256
FROM every e LEFT JOIN best ON e.conv_id IS NOT DISTINCT FROM best.conv_id
"""


ORACLE = _oracle()
