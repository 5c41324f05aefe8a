"""Fill-in-middle, conversation repair and license scans."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chargeflow.llm import chat, conversations, fill_in_middle, frames, licenses

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = ["", None, " ", "\n\t ", "a", " a", "a ", "ab  cd\x0bef", "漢字 é 😀 x", "holds <P> itself", "<S>", "x" * 300_000, "word " * 60_000, "< P> <", "<", "a <M", "  b\x1cc"]


@pytest.fixture
def sf_dir():
    return "/root/testdata/sf0.001"


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


# ---------------------------------------------------------------- fill in middle


def plain_fim(doc_id, text):
    text = text or ""
    u = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    lo, hi = sorted((a % (len(u) + 1), b % (len(u) + 1)))
    pre, mid, suf = ("".join(x) for x in (u[:lo], u[lo:hi], u[hi:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= 50:
        return len(u), "plain", None, None, text
    if d % 100 < 80:
        return len(u), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(u), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_frames_cut_find_and_stream():
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice("ab é漢😀 \t\n") for _ in range(rng.randint(0, 60)))
        f = frames.packed([text[:7].encode(), text[7:].encode()], rng.choice([4, 7, 64]))
        units = UNIT.findall(text)
        assert (f.units, f.chars, f.bytes) == (len(units), len(text), len(text.encode()))
        assert b"".join(f.stream()).decode() == text
        for k in range(len(units) + 1):
            chars, size = f.cut(k)
            assert text[:chars] == "".join(units[:k]) and size == len(text[:chars].encode())
        for mark in (b"ab", b" \t", b"a"):
            assert f.find(mark, 3) == text.encode().find(mark, 3)
        a, b = sorted((rng.randint(0, f.bytes), rng.randint(0, f.bytes)))
        assert b"".join(f.stream(a, b)) == text.encode()[a:b]


def test_fill_in_middle_of_odd_texts(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD * 6)] + [(None, "no id here at all"), (None, None), (5, "twice the id"), (5, "twice the id")]
    rows = [r if len(r) == 3 else (*r, "x") for r in rows]
    docs = table(spark, rows, "doc_id long, text string, frames string").withColumn("n", F.lit(1))
    for frame in (64, frames.FRAME):
        out = fill_in_middle.fill_in_middle(fill_in_middle.store(docs, frame=frame), frame=frame)
        full = out.drop("frames").collect()
        want = sorted(((r[0] is None, r[0] or 0, *(str(x) for x in plain_fim(r[0], r[1])[:4])) for r in rows))
        assert sorted((r.doc_id is None, r.doc_id or 0, str(r.n), r.form, str(r.prefix_chars), str(r.middle_chars)) for r in full) == want
        assert {r.form for r in full} == {"plain", "psm", "spm"}
        key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text)
        got = sorted(map(key, fill_in_middle.texts(out).collect()))
        assert got == sorted((r[0] is None, r[0] or 0, plain_fim(r[0], r[1])[4]) for r in rows)
        back = sorted(map(key, fill_in_middle.texts(out, restored=True).collect()))
        assert back == sorted((r[0] is None, r[0] or 0, r[1] or "") for r in rows)


def test_fill_in_middle_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    got = fill_in_middle.query(spark, sf_dir)
    want = con.execute(fill_in_middle.ORACLE)
    assert [d[0] for d in want.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    assert got.filter("restored_sha256 = output_sha256 and form <> 'plain'").count() == 0


def test_fill_in_middle_of_an_empty_table_and_of_wrong_marks(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fill_in_middle.with_digests(fill_in_middle.fill_in_middle(fill_in_middle.store(empty))).collect() == []
    for marks in (("", "b", "c"), ("ab", "abc", "d"), ("ab", "bc", "d"), ("aba", "c", "d")):
        with pytest.raises(ValueError):
            fill_in_middle.Marks(*marks)


# ---------------------------------------------------------------- conversations


def plain_repair(rows):
    """rows: (turn, role, text) in order. Cost and audit as the least pair from each place on."""
    facts, seen = [], set()
    for _, role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        blank, again = not shown, (role, text) in seen and bool(shown)
        seen.add((role, text))
        facts.append((role[:1], blank, again, not blank and not again and shown[-1] not in ".!?"))
    step = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    due = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
    n = len(rows)

    @cache
    def best(i, s, inserts=3):
        options = []
        if i == n and s in (0, 3):
            options.append((0, ""))
        if inserts:
            cost, tail = best(i, due[s][1], inserts - 1)
            options.append((cost + 2, "I" + tail))
        if i < n:
            letter, blank, again, cut = facts[i]
            cost, tail = best(i + 1, s)
            options.append((cost + 3, "D" + tail))
            if not blank and not again:
                if (letter, s) in step:
                    cost, tail = best(i + 1, step[letter, s])
                    options.append((cost + cut, "K" + tail))
                cost, tail = best(i + 1, due[s][1])
                options.append((cost + 2 + cut, "R" + tail))
        return min(options) if options else (10**9, "")

    for i in range(n, -1, -1):  # from the end, so that calls don't nest
        for s in range(4):
            best(i, s)
    cost, audit = best(0, 0)
    lines, at, state = [], 0, 0
    for x in audit:
        if x == "I":
            state = due[state][1]
            lines.append({2: "user:", 3: "assistant:"}[state])
            continue
        _, role, text = rows[at]
        at += 1
        if x == "K":
            state = step[role[:1], state]
        elif x == "R":
            state = due[state][1]
            role = {2: "user", 3: "assistant"}[state]
        if x != "D":
            lines.append(f"{role}:{text}")
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        sum(f[1] for f in facts), sum(f[2] for f in facts), sum(f[3] for f in facts),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def in_order(rows):
    digest = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[1], r[2])))


def check_repair(spark, rows):
    """rows: (conv_id, turn, role, text)."""
    fixed = conversations.repair(table(spark, [(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, edit string"))
    got = {r.conv_id: tuple(r)[1:] for r in fixed.summary.collect()}
    digests = {r.conv_id: r.repaired_sha256 for r in conversations.repaired_digests(fixed.rows).collect()}
    groups = {}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    assert got.keys() == groups.keys()
    for c, members in groups.items():
        want = plain_repair(in_order(members))
        assert got[c] == want[:-1], (c, members)
        assert digests.get(c, hashlib.sha256(b"").hexdigest()) == want[-1], (c, members)
    fixed.close()


def test_repair_of_odd_conversations(spark):
    rng = random.Random(5)
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (None, None, "tool", "x"), (0, 0, "user", "Only one."), (1, 5, "assistant", "I begin."), (2, 1, "", "No role.")]
    rows += [(3, 0, "user", "same."), (3, 0, "user", "same."), (3, 0, "user", "same."), (4, 1, "user", "\n\t "), (5, 2, "system", "Alone")]
    for c in range(10, 130):
        turn = 0
        for _ in range(rng.randint(1, 7)):
            turn += rng.choice([0, 1, 1, 1, 3])
            rows.append((c, rng.choice([turn, turn, turn, None]), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None]), rng.choice(["a.", "b!", "c", " ", "", "d?\n", "é", None])))
    check_repair(spark, rows)


def test_repair_of_a_conversation_over_many_partitions(spark):
    rng = random.Random(6)
    kinds = ["user", "assistant", "user", "assistant", "system", "x"]
    rows = [(7, i // 2, kinds[rng.randrange(6)], f"{rng.randrange(60)}{rng.choice(['.', '', '!'])}") for i in range(300)]
    rows += [(c, i, kinds[rng.randrange(6)], f"{i}.") for c in (6, 8, 9) for i in range(9)]
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = conversations.ordered(table(spark, rows, "conv_id long, turn long, role string, text string"))
        assert ordered.filter("conv = '7'").select("chunk").distinct().count() > 3
        check_repair(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_ranks_order_audits():
    rng = random.Random(8)
    for _ in range(60):
        rows = [{"initial": rng.choice("usax"), "blank": rng.random() < 0.1, "again": False, "cut": rng.random() < 0.3} for _ in range(rng.randint(0, 9))]
        after = conversations.before_inserts([0, conversations.FAR, conversations.FAR, 0])
        arcs = conversations.optimal_arcs(rows, after, True)
        rank, pointers = conversations.ranked(arcs)
        said = []
        for node in range(len(arcs)):
            text, at = "", node
            while arcs[at][0] >= 0:
                text, at = text + "DIKR"[arcs[at][0]], arcs[at][1]
            said.append(text)
            walked = [arcs[x][0] for x in conversations.path(node, pointers)]
            assert "".join("DIKR"[x] for x in walked if x >= 0) == text
        for i, j in itertools.combinations(range(len(arcs)), 2):
            assert (rank[i] < rank[j]) == (said[i] < said[j]) and (rank[i] == rank[j]) == (said[i] == said[j])


def test_repair_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    groups = {}
    for c, t, role, text in sorted(rows):
        groups.setdefault(c, [])
        fault = zlib.crc32(f"{c}:{t}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        groups[c] += [(t, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.query(spark, sf_dir).collect()}
    assert got == {c: plain_repair(members) for c, members in groups.items()}


def test_repair_of_an_empty_table(spark):
    fixed = conversations.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert fixed.summary.collect() == [] and fixed.rows.collect() == [] and conversations.repaired_digests(fixed.rows).collect() == []


def test_conversations_that_lose_all_rows(spark, tmp_path):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(lost, 0, "user", "Gone.")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert [tuple(r) for r in conversations.query(spark, str(tmp_path)).collect()] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# ---------------------------------------------------------------- licenses


def plain_scan(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    own = {label for phrase, label in licenses.NOTICES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()}
    at = [i for i, _ in places]
    base = {x for _, x in places}
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), base | own


def test_license_scan_of_odd_texts(spark, monkeypatch):
    rng = random.Random(9)
    pool = ["gnu", "General", "public", "LICENSE", "apache", "license", "cc", "by", "mit", "nc", "é", "漢字", "x", "-", ".", "\n", "all rights reserved"]
    texts = [*ODD, "mit license", "MIT LICENSE", "mit license", "émit license", "mit license" * 3, "cc by cc by"] + [rng.choice(["", " "]).join(rng.choice(pool) + rng.choice([" ", "", "-"]) for _ in range(rng.randint(1, 40))) for _ in range(200)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "mit license", "x"), (3, "cc by", "x")]
    for size in (licenses.SLICE, 16):
        monkeypatch.setattr(licenses, "SLICE", size)
        if size == 16:  # slices, on the driver
            found = [(licenses.Scanner().scan(t or ""), plain_scan(t)) for t in texts if len(t or "") < 9999]
            for got, want in found:
                base = [s["word"] for s in got["spans"] if s["base"]]
                assert (got["n_words"], len(base), min(base, default=None), max(base, default=None)) == want[:4]
                assert {s["label"] for s in got["spans"]} == want[5]
            continue
        out = licenses.summarised(licenses.license_scan(table(spark, rows, "doc_id long, text string, spans string")))
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_base, str(r.first_word), str(r.last_word), r.base_labels, r.labels) for r in out.collect())
        want = [(i is None, i or 0, *(p := plain_scan(t))[:2], str(p[2]), str(p[3]), p[4], ",".join(sorted(p[5]))) for i, t, _ in rows]
        assert got == sorted(want)


def test_spans_tell_the_bytes_of_a_notice():
    text = "É! Released under the\tMIT\nLicense. (cc-by-nc)"
    found = {s["label"]: text.encode()[s["begin"] : s["end"]].decode() for s in licenses.Scanner().scan(text)["spans"]}
    assert found == {"mit": "MIT\nLicense", "cc-by": "cc-by", "cc-by-nc": "cc-by-nc"}


@pytest.mark.parametrize(
    "text, labels, weight",
    [
        ("MIT", ["mit"], 0.2),
        ("GPL-2.0-only OR MIT", ["gpl", "mit"], 0.2),
        ("GPL-2.0-only AND MIT", ["gpl", "mit"], 0.8),
        ("MIT or Apache-2.0 and GPL-3.0+", ["apache", "gpl", "mit"], 0.2),
        ("(MIT OR Apache-2.0) AND GPL-3.0-or-later", ["apache", "gpl", "mit"], 0.8),
        ("GPL-2.0 WITH Classpath-exception-2.0 AND MIT", ["gpl", "mit"], 0.4),
        ("AGPL-3.0 OR (LGPL-2.1 AND (BSD-3-Clause", ["agpl", "bsd", "lgpl"], 0.6),
        ("MIT OR (Apache-2.0 AND (", ["apache", "mit"], 0.2),
        ("MIT AND", ["mit"], 0.2),
        ("MIT) AND GPL-2.0", ["mit"], 0.2),
        ("LicenseRef-own", ["other"], 0.5),
        ("MIT. Further words", ["mit"], 0.2),
    ],
)
def test_license_expressions(text, labels, weight):
    polish, _ = licenses.reverse_polish(text.encode(), 0)
    found = licenses.evaluate(polish)
    assert (sorted(found[0]), found[1]) == (labels, weight)


def test_tags_are_found_with_their_expressions():
    found = licenses.Scanner().scan("// SPDX-License-Identifier: MIT OR GPL-2.0\nSPDX-License-Identifier=\n# spdx-license-identifier Apache-2.0 */")
    assert [(e["text"], e["labels"]) for e in found["expressions"]] == [("MIT OR GPL-2.0", ["gpl", "mit"]), ("Apache-2.0", ["apache"])]
    assert [licenses.evaluate(licenses.reverse_polish(t, 0)[0]) for t in (b"", b"AND MIT", b")", b"((")] == [None] * 4


def test_license_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = licenses.query(spark, sf_dir).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in got} == {i: plain_scan(t)[:5] for i, t in texts.items()}
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)


# ---------------------------------------------------------------- chat templates

MARK = st.text("ab:#< \n!\\?", max_size=4)


@settings(max_examples=300, deadline=None)
@given(MARK, MARK, MARK, st.sampled_from(["\\", "a", ":", "ab", ""]), st.lists(MARK, min_size=2, max_size=2), st.lists(st.tuples(st.sampled_from(["user", "assistant", "tool", ":", "a b", ""]), st.text("ab:#< \n!\\?dce", max_size=8)), max_size=4))
def test_templates_read_back_or_are_refused(start, mid, end, escape, names, turns):
    template = chat.Template(start=start, mid=mid, end=end, escape=escape, names=dict(zip(("user", "assistant"), names)))
    try:
        template.codes()
    except ValueError:
        return
    turns = [{"role": r, "text": t} for r, t in turns]
    text = "".join(s["text"] for s in chat.segments_of(turns, template, chat._escaper(template)))
    assert chat.turns_of(text, template, chat._unescaper(template)) == turns


def test_templates_of_the_review():
    template = chat.Template(start="", mid=": ", end="b!")
    segments = chat.segments_of([{"role": "user", "text": ":!"}], template, chat._escaper(template))
    assert chat.turns_of("".join(s["text"] for s in segments), template, chat._unescaper(template)) == [{"role": "user", "text": ":!"}]
    with pytest.raises(ValueError):
        chat.Template(names={"user": "User: human", "assistant": "A"}).codes()


@pytest.mark.parametrize("marks", [{"mid": "a"}, {"end": " a"}, {"start": "a#"}])
def test_marks_that_begin_with_the_escape_are_refused(marks):
    with pytest.raises(ValueError):
        chat.Template(escape="a", **marks).codes()
