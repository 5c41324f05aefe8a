"""License scans: identifier tags and notice phrases by one automaton, license
expressions by a shunting-yard parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read

#: Bytes of text that are scanned at a time; longer texts are cut between words.
SLICE = 1 << 20

# The phrases and labels that every scan has.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Further notices and their labels.
NOTICES = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl", "mozilla public license": "mpl",
    "eclipse public license": "epl", "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd", "isc license": "isc",
    "permission is hereby granted free of charge to any person": "mit", "boost software license": "bsl", "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd", "creative commons attribution": "cc-by", "cc0 1 0": "cc0", "creative commons zero": "cc0",
    "released into the public domain": "public-domain", "all rights reserved": "reserved",
}
#: After these words an expression stands.
TAGS = ("spdx license identifier",)

#: How much a license asks of those who use a text, from 0 to 1.
WEIGHTS = {
    "public-domain": 0.05, "cc0": 0.05, "mit": 0.2, "bsd": 0.2, "isc": 0.2, "bsl": 0.2, "apache": 0.25, "cc-by": 0.3, "mpl": 0.5, "epl": 0.5,
    "lgpl": 0.6, "cc-by-sa": 0.7, "gpl": 0.8, "agpl": 0.9, "cc-by-nd": 0.9, "cc-by-nc": 0.9, "reserved": 1.0,
}
UNKNOWN_WEIGHT = 0.5

_FAMILY = re.compile(r"(cc-by-nc|cc-by-nd|cc-by-sa|cc-by|cc0|agpl|lgpl|gpl|apache|mit|bsd|isc|bsl|mpl|epl)(?![a-z])")
_TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_LEAD = re.compile(rb"[ \t]*[:=]?[ \t]*")
#: Operators by how tightly they bind.
_BINDS = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str:
    """The label of a license identifier: its family without version; ``other`` of an
    unknown one."""
    found = _FAMILY.match(identifier.lower())
    return found.group(1) if found else "other"


def reverse_polish(raw: bytes, at: int) -> tuple[list[str], int]:
    """The longest expression at ``at``, on one line, as operands and operators in
    reverse Polish order, and its end. Operators without a right side and
    brackets that aren't closed are left out; what isn't an operator after an
    operand ends it."""
    out: list[str] = []
    stack: list[str] = []
    need, end = True, at

    def unwind(least: int) -> None:
        while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= least:
            out.append(stack.pop())

    waiting = None
    while found := _TOKEN.match(raw, at):
        token = found.group(1).decode()
        low = token.lower()
        if need and low == "(":
            if waiting:
                unwind(_BINDS[waiting])
                stack.append(waiting)
                waiting = None
            stack.append("(")
        elif need and low not in _BINDS and low != ")":
            if waiting:
                unwind(_BINDS[waiting])
                stack.append(waiting)
                waiting = None
            token = token.rstrip(".:-") or token
            out.append(token)
            need, end = False, found.start(1) + len(token)
            if len(token) < len(found.group(1)):  # the sentence ends here
                break
        elif not need and low == ")" and "(" in stack:
            unwind(0)
            stack.pop()
            end = found.end()
        elif not need and low in _BINDS:
            waiting, need = low, True
        else:
            break
        at = found.end()
    if need and not waiting:  # brackets that nothing follows, and the operator before them
        while stack and stack[-1] == "(":
            stack.pop()
        stack = stack[:-1]
    out += [x for x in reversed(stack) if x != "("]
    return out, end


def evaluate(polish: list[str]) -> tuple[frozenset[str], float] | None:
    """(labels, weight): ``and`` asks what either side asks, so the greater weight;
    ``or`` leaves the choice, so the lesser; an exception (``with``) halves the
    weight of its license and is no label. None without operands."""
    stack: list[tuple[frozenset[str], float]] = []
    for x in polish:
        if x in _BINDS:
            right, left = stack.pop(), stack.pop()
            if x == "with":
                stack.append((left[0], left[1] / 2))
            else:
                stack.append((left[0] | right[0], (max if x == "and" else min)(left[1], right[1])))
        else:
            label = family(x)
            stack.append((frozenset([label]), WEIGHTS.get(label, UNKNOWN_WEIGHT)))
    return stack[-1] if stack else None


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass(frozen=True)
class Scanner:
    """``base`` and ``notices`` are phrases with labels, ``tags`` what an expression follows."""

    base: dict[str, str] = field(default_factory=lambda: dict(BASE))
    notices: dict[str, str] = field(default_factory=lambda: dict(NOTICES))
    tags: tuple[str, ...] = TAGS

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for kind, phrases in (("notice", self.notices), ("tag", dict.fromkeys(self.tags, "")), ("base", self.base)):
            for phrase, label in phrases.items():
                out.add_word(f" {phrase} ", (kind, label, len(phrase.split())))
        out.make_automaton()
        return out

    @cached_property
    def longest(self) -> int:
        return max(len(p.split()) for p in (*self.base, *self.notices, *self.tags))

    def hits(self, raw: bytes) -> Iterator[tuple[str, str, int, int, int, int]]:
        """(kind, label, first word, words, first byte, byte after) of each phrase that
        stands in the UTF-8 of a text; last, ("end", "", words of the text, 0, 0, 0)."""
        data = np.frombuffer(raw, np.uint8)
        before, at, carried = 0, 0, np.empty(0, np.int64)  # words and bytes done; where the last words began
        while at < len(data):
            end = min(len(data), at + SLICE)
            while end < len(data) and _IS_WORD[data[end]] and _IS_WORD[data[end - 1]]:
                end += 1
            begin = int(carried[0]) if len(carried) else at
            part = data[begin:end]
            inside = _IS_WORD[part]
            starts = inside.copy()
            starts[1:] &= ~inside[:-1]
            closes = ~inside
            closes[1:] &= inside[:-1]
            closes[:1] = False
            where = np.flatnonzero(starts) + begin
            # Words with one space around each; every byte counts as a character, as the phrases are ASCII.
            low = _LOWER[part]
            low[~inside] = 32
            line = b" " + low[inside | closes].tobytes() + (b" " if len(part) and inside[-1] else b"")
            spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
            first = before - len(carried)
            for last, (kind, label, n) in self.automaton.iter(line.decode("latin-1")):
                i = int(np.searchsorted(spaces, last)) - n
                if i + n > len(carried):  # else it was found before the cut
                    tail = int(where[i + n - 1])
                    while tail < len(data) and _IS_WORD[data[tail]]:
                        tail += 1
                    yield kind, label, first + i, n, int(where[i]), tail
            before = first + len(where)
            carried = where[-(self.longest - 1) :] if self.longest > 1 else where[:0]
            at = end
        yield "end", "", before, 0, 0, 0

    def scan(self, text: str) -> dict:
        """Words, places of phrases and tags' expressions of a text."""
        raw = text.encode()
        spans, expressions, n = [], [], 0
        for kind, label, first, words, begin, end in self.hits(raw):
            if kind == "end":
                n = first
            elif kind == "tag":
                at = _LEAD.match(raw, end).end()
                polish, stop = reverse_polish(raw, at)
                if found := evaluate(polish):
                    expressions.append({"text": raw[at:stop].decode("utf-8", "replace"), "labels": sorted(found[0]), "weight": found[1], "word": first})
            else:
                spans.append({"label": label, "base": kind == "base", "word": first, "n_words": words, "begin": begin, "end": end})
        return {"n_words": n, "spans": spans, "expressions": expressions}


_SPAN = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("word", pa.int64()), ("n_words", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])
_EXPRESSION = pa.struct([("text", pa.string()), ("labels", pa.list_(pa.string())), ("weight", pa.float64()), ("word", pa.int64())])
_SCANNED = (
    "doc_id long, n_words long, spans array<struct<label:string,base:boolean,word:bigint,n_words:bigint,begin:bigint,end:bigint>>, "
    "expressions array<struct<text:string,labels:array<string>,weight:double,word:bigint>>"
)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scanner: Scanner | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``spans`` (each place of a phrase: label, first word,
    byte range in the UTF-8 of the text) and ``expressions`` (what follows a tag on
    its line, evaluated) of each row. A-Z count as a-z; words are letters, digits
    and whatever isn't ASCII. Places may overlap and all count. Null texts have
    nothing; null and repeated ids are returned as they are; other columns are
    ignored. Rows are independent: nothing is shuffled."""
    scanner = scanner or Scanner()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [scanner.scan(t.as_py() or "") for t in b.column(1)]
            cols = [pa.array([f[k] for f in found], kind) for k, kind in (("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("expressions", pa.list_(_EXPRESSION)))]
            yield pa.record_batch([b.column(0), *cols], names=["doc_id", "n_words", "spans", "expressions"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, _SCANNED)


def summarised(scanned: DataFrame) -> DataFrame:
    """Counts, first and last base place, labels and ``score``, the greatest weight of
    anything found (0 if nothing was)."""
    base = F.filter("spans", lambda s: s["base"])
    words = F.transform(base, lambda s: s["word"])
    names = lambda xs: F.array_join(F.array_sort(F.array_distinct(xs)), ",")
    own = F.transform("spans", lambda s: s["label"])
    told = F.flatten(F.transform("expressions", lambda e: e["labels"]))
    weight = F.create_map(*[F.lit(x) for pair in WEIGHTS.items() for x in pair])
    asked = F.transform(own, lambda x: F.coalesce(F.try_element_at(weight, x), F.lit(UNKNOWN_WEIGHT)))
    score = F.coalesce(F.array_max(F.concat(asked, F.transform("expressions", lambda e: e["weight"]))), F.lit(0.0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        names(F.transform(base, lambda s: s["label"])).alias("base_labels"),
        names(F.concat(own, told)).alias("labels"),
        score.alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarised(license_scan(read(spark, sf_dir, "documents")))
