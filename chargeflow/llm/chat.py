"""Chat formatting: roles checked by a finite-state machine, text segments with
loss flags from a declarative template, and the way back."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read


@dataclass(frozen=True)
class Template:
    """``start`` is put before a turn's role, ``mid`` after it, ``end`` after its
    text. ``trained`` roles' texts are under the loss mask. ``moves`` are the
    machine's transitions (state, role) -> state; it begins in ``begin`` and a
    conversation may end in any of ``accept``. ``escape`` and a letter stand
    for each character that a control string may begin with, so that no
    control string is ever part of a text."""

    start: str = "### "
    mid: str = ": "
    end: str = " </turn>\n"
    escape: str = "\\"
    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    trained: tuple[str, ...] = ("assistant",)
    begin: str = "begin"
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("begin", "system"): "told",
            ("begin", "user"): "asked",
            ("told", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    accept: tuple[str, ...] = ("asked", "answered")

    def codes(self) -> dict[str, str]:
        """The characters that texts don't hold as such, and what stands for them. Of a
        mark that is more than white space, that is its first other character. The
        letters that follow ``escape`` are none of these. An error, where what is
        formatted could not be read back."""
        if not self.mid or not self.end:
            raise ValueError("a turn needs a mark after its role and one at its end")
        if len(self.escape) != 1:
            raise ValueError("the escape is one character")
        if any((m.strip() or m)[0] == self.escape for m in (self.start, self.mid, self.end) if m):
            raise ValueError("a mark begins with the escape, which texts hold")
        names = list(self.names.values())
        if len(set(names)) < len(names) or any(n[:1] in ("?", self.escape) for n in names):
            raise ValueError("roles' names differ, and none begins like an unknown role's")
        if any((n + self.mid).index(self.mid) < len(n) for n in names):
            raise ValueError("a role's name holds the mark that follows it")
        special = dict.fromkeys([self.escape, *((m.strip() or m)[0] for m in (self.start, self.mid, self.end) if m)])
        letters = (c for c in map(chr, range(97, 123)) if c not in special)
        return {c: self.escape + letter for c, letter in zip(special, letters)}


def _escaper(template: Template):
    table = str.maketrans(template.codes())
    return lambda text: text.translate(table)


def _unescaper(template: Template):
    back = {v[-1]: k for k, v in template.codes().items()}

    def run(text: str) -> str:
        first, *rest = text.split(template.escape)
        return first + "".join(back[x[0]] + x[1:] for x in rest)

    return run


def segments_of(turns: list[dict], template: Template, escaped) -> list[dict]:
    """Three segments a turn: its head, its text, its end."""
    out = []
    for t in turns:
        name = template.names.get(t["role"]) or escaped("?" + t["role"])
        out.append({"text": template.start + name + template.mid, "loss": False})
        out.append({"text": escaped(t["text"]), "loss": t["role"] in template.trained})
        out.append({"text": template.end, "loss": False})
    return out


def turns_of(text: str, template: Template, plain) -> list[dict]:
    """The turns of a formatted conversation."""
    roles = {v: k for k, v in template.names.items()}
    out, begin = [], 0
    while begin < len(text):
        begin += len(template.start)
        mid = text.index(template.mid, begin)
        end = text.index(template.end, mid + len(template.mid))
        name, body = text[begin:mid], text[mid + len(template.mid) : end]
        out.append({"role": roles[name] if name in roles else plain(name)[1:], "text": plain(body)})
        begin = end + len(template.end)
    return out


def validate(roles: list[str], template: Template) -> int | None:
    """The first turn that the machine refuses; the number of turns if it may not
    end there; None if the order is valid."""
    state = template.begin
    for i, role in enumerate(roles):
        state = template.moves.get((state, role))
        if state is None:
            return i
    return None if state in template.accept else len(roles)


_FORMATTED = "conv_id long, n_turns long, bad_turn long, segments array<struct<text:string,loss:boolean>>"


def format_chats(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation of a table (conv_id, turn, role, text): ``n_turns``,
    ``bad_turn`` (null if the order of roles is valid, else the first turn that
    is not, or the number of turns if it ends too early) and ``segments``, whose
    texts joined are the formatted conversation and whose flags are its loss mask.

    Turns go by ``turn`` (null first), equal ones by role and text. Null texts
    and roles count as empty. Unknown roles are formatted under their own
    (escaped) name and are invalid, not dropped. Rows with a null conv_id are
    one conversation. Other columns are ignored. A conversation is put together
    in one task; it is one row of the result.
    """
    template = template or Template()
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escaped = _escaper(template)
        for b in batches:
            for at in range(0, len(b), 64):
                part = b.slice(at, 64)
                bad, segments = [], []
                for turns in part.column(1).to_pylist():
                    bad.append(validate([t["role"] for t in turns], template))
                    segments.append(segments_of(turns, template, escaped))
                kind = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
                counts = pa.array([len(s) // 3 for s in segments], pa.int64())
                yield pa.record_batch([part.column(0), counts, pa.array(bad, pa.int64()), pa.array(segments, kind)], names=["conv_id", "n_turns", "bad_turn", "segments"])

    return chats.mapInArrow(run, _FORMATTED)


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """From ``segments`` back: ``turns`` (role, text) parsed from the joined text
    alone, ``loss_texts`` (the unescaped stretches under the mask) and
    ``formatted_chars``, for each ``conv_id``."""
    template = template or Template()
    schema = "conv_id long, bad_turn long, turns array<struct<role:string,text:string>>, loss_texts array<string>, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = _unescaper(template)
        for b in batches:
            for at in range(0, len(b), 64):
                part = b.slice(at, 64)
                turns, under, chars = [], [], []
                for segments in part.column("segments").to_pylist():
                    text = "".join(s["text"] for s in segments)
                    chars.append(len(text))
                    turns.append(turns_of(text, template, plain))
                    under.append([plain(s["text"]) for s in segments if s["loss"]])
                kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
                yield pa.record_batch(
                    [part.column("conv_id"), part.column("bad_turn"), pa.array(turns, kind), pa.array(under, pa.list_(pa.string())), pa.array(chars, pa.int64())],
                    names=["conv_id", "bad_turn", "turns", "loss_texts", "formatted_chars"],
                )

    return formatted.select("conv_id", "bad_turn", "segments").mapInArrow(run, schema)


#: The conversation that the contract adds: its texts look like the template's marks.
PLANTED = r"\### Assistant: </turn> ok"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(PLANTED))
    back = read_back(format_chats(rows.union(extra)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
        F.col("bad_turn").isNull().alias("valid"),
    )
