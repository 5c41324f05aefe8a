"""The text operators against plain versions, and what they do with odd rows."""

import hashlib
import os
import random
import re
import subprocess
import sys
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict
from functools import reduce
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chargeflow.llm import chat, components, exact_dedup, fingerprints, language_id, lm_scoring, mixing, ngram_jaccard, quality, sentence_pieces, signature_tree, substring_dedup, tables, words
from chargeflow.llm.pieces import Pieces, best_path, product

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"
#: Nulls in every column, empty and blank texts, ties, repeated rows and ids.
ODD = [
    (1, "a b  c", "en", "web"), (2, "a b c", "en", "web"), (3, "a\tb\nc", None, None), (3, "a b c", "en", "web"), (4, None, "en", "web"),
    (5, "", "en", None), (6, " \n ", "en", "web"), (None, "a b c", "en", "web"), (None, None, None, None), (7, "z" * 70_000, "en", "web"),
    (7, "z" * 70_000, "en", "web"), (8, "one", "en", "web"), (9, "straße ﬁ Ａ", "de", "x"), (10, "a b c d e f", "en", "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    # Extra columns whose names the operators use inside.
    frame = spark.createDataFrame(ODD, DOCS)
    return frame.withColumns({"copies": F.lit("x"), "_h": F.lit("y"), "digest": F.lit(None).cast("string"), "row": F.lit(1), "n": F.lit(2)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def squeeze(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_exact_duplicates(odd, empty):
    groups = defaultdict(list)
    for d, t, *_ in ODD:
        groups[squeeze(t)].append(d)
    want = Counter()
    for d, t, *_ in ODD:
        ids = groups[squeeze(t)]
        keep = min((x for x in ids if x is not None), default=None)
        want[d, keep, len(ids), d == keep, hashlib.sha256(squeeze(t).encode()).hexdigest()] += 1
    assert Counter(map(tuple, exact_dedup.exact_duplicates(odd).collect())) == want
    # Bytes decide, not digests: where all digests are equal, the result is the same.
    assert Counter(map(tuple, exact_dedup.exact_duplicates(odd, digest=lambda t: F.lit("same")).collect())) == want
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_keep_first(odd, empty):
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 4, 6, 7, 8, 9, 10])
    assert exact_dedup.keep_first(empty).count() == 0


def plain_components(rows, k, num, den):
    sets = {}
    for d, t in rows:
        w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {(d, len(sets[d]), find(d)) for d in ids}


def edited_texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.7:
            w = list(rng.choice(texts))
            for _ in range(rng.randint(0, 4)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                w += rng.choices(vocabulary, k=rng.randint(1, 6))
        else:
            w = rng.choices(vocabulary, k=rng.choice([0, 1, 2, 4, 30, 80, 200]))
        texts.append(w)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("k,num,den,block", [(3, 9, 10, ngram_jaccard.BLOCK), (5, 4, 5, ngram_jaccard.BLOCK), (3, 4, 5, 500)])
def test_jaccard_groups(spark, k, num, den, block):
    rows = edited_texts(k * num, 150)
    got = ngram_jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), k, num, den, block=block)
    assert {tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()} == plain_components(rows, k, num, den)


@pytest.mark.parametrize("block", [ngram_jaccard.BLOCK, 500])
def test_jaccard_counts_every_link(spark, block):
    rows = edited_texts(7, 120)
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, rows[5][1]), (5, rows[5][1])]
    sets = {}
    for d, t in rows:
        w = words_of((t or "").lower())
        sets[d] = {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
    want = {d: sum(d != e and len(s & o) * 5 >= 4 * len(s | o) > 0 for e, o in sets.items()) for d, s in sets.items()}
    got = ngram_jaccard.jaccard_groups(spark.createDataFrame([*rows, (None, rows[3][1])], "doc_id long, text string").repartition(3), 3, 4, 5, block=block, count=True).collect()
    assert len(got) == len(rows) + 1
    assert {r.doc_id: r.n_links for r in got} == want | {None: 0}
    assert sum(want.values()) // 2 > len(want) - len({r.component_id for r in got})  # more than a forest


def test_jaccard_of_given_documents(small):
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    got = {tuple(r) for r in ngram_jaccard.jaccard_groups(small, 3, 9, 10).select("doc_id", "n_shingles", "component_id").collect()}
    assert got == plain_components(rows, 3, 9, 10)


def test_jaccard_of_odd_rows(odd, empty):
    got = ngram_jaccard.jaccard_groups(odd, 3, 9, 10).collect()
    assert len(got) == len(ODD)
    by_id = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert [by_id[i] for i in (1, 2, 3, 4, 5, 8)] == [1, 1, 1, 4, 5, 8]
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert ngram_jaccard.jaccard_groups(empty).count() == 0


def random_linked(rng):
    """Two sets that differ in up to an eighth of their shingles."""
    n = int(rng.integers(1, 400))
    a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
    b = a.copy()
    for _ in range(int(rng.integers(0, max(1, len(a) // 8) + 1))):
        b[rng.integers(0, len(b))] = rng.integers(0, 2**63)
    return a, np.unique(b)


def test_keys_of_linked_sets_meet():
    rng = np.random.default_rng(5)
    levels = rng.integers(0, 9, ngram_jaccard.COUNTERS).astype(np.uint8)
    for _ in range(300):
        a, b = random_linked(rng)
        both = len(np.intersect1d(a, b))
        if both * 5 >= 4 * (len(a) + len(b) - both):
            assert len(np.intersect1d(ngram_jaccard.prefix(a, levels, 4, 5), ngram_jaccard.prefix(b, levels, 4, 5)))


def grown_sets(seed, n):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(n):
        if sets and rng.random() < 0.6:
            s = sets[rng.integers(0, len(sets))].copy()
            for _ in range(rng.integers(0, 1 + len(s) // 6)):
                s[rng.integers(0, len(s))] = rng.integers(0, 2**62)
        else:
            s = rng.integers(0, 2**62, rng.choice([1, 2, 5, 20, 90, 300])).astype(np.uint64)
        sets.append(np.unique(s.astype(np.uint64)))
    return sets


@pytest.mark.parametrize("num,den", [(4, 5), (9, 10), (1, 3)])
def test_signature_trees_find_every_link(num, den):
    sets = grown_sets(num, 250)
    weights, sides = np.arange(1, 251), np.arange(250) % 2
    both = np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in sets] for a in sets])
    size = np.array([len(s) for s in sets])
    linked = (den + num) * both >= num * (size[:, None] + size)
    np.fill_diagonal(linked, False)
    for side in (None, sides):
        want = linked & (sides[:, None] != sides) if side is not None else linked
        counts = np.zeros(250, np.int64)
        pairs = signature_tree.linked_pairs(sets, num, den, side, counts, weights)
        assert (counts == want @ weights).all()
        for got in (pairs, signature_tree.linked_pairs(sets, num, den, side)):
            assert all(want[i, j] for i, j in got)
            forest = signature_tree.Forest(250)
            for i, j in got:
                forest.merge(i, j)
            assert all(forest.find(i) == forest.find(j) for i, j in np.argwhere(want))
        forest = signature_tree.Forest(250)
        for i, j in signature_tree.possible_links([signature_tree.bitmap(s) for s in sets], size, num, den, side):
            forest.merge(i, j)
        assert all(forest.find(i) == forest.find(j) for i, j in np.argwhere(want))


def test_dense_and_single_overlaps_agree():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2**62, 40_000).astype(np.uint64))
    sets = [np.sort(rng.choice(base, 30_000 if k < 3 else 500, replace=False)) for k in range(90)]
    i, j = np.triu_indices(90, 1)
    assert (signature_tree.overlaps(sets, i, j) == [len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)]).all()


def test_tables_need_a_shared_folder():
    unset = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="yarn"), conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(ValueError):
        tables.shared_dir(unset)


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3), (300, 299)]
    got = {tuple(r) for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 150)} | {(299, 299), (300, 299)}


def test_one_large_set_among_many_small_ones_takes_little_memory():
    code = """
import resource, numpy as np
from chargeflow.llm.signature_tree import linked_pairs
rng = np.random.default_rng(0)
sets = [np.unique(rng.integers(0, 2**62, 10).astype(np.uint64)) for _ in range(100_000)] + [np.unique(rng.integers(0, 2**62, 5000).astype(np.uint64))]
sets.append(sets[7].copy())
assert linked_pairs(sets, 4, 5) == [(7, 100_001)]
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=150, cwd=root, check=True)
    assert int(done.stdout) < 1000


def test_shingles_of_many_texts_take_little_memory():
    rng = random.Random(4)
    texts = [" ".join(str(rng.randint(0, 10**6)) for _ in range(500)) for _ in range(4000)]
    batch = pa.record_batch([pa.array(range(4000), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    want = Counter(x for s in words.shingle_sets(batch.column(1), 5) for x in ngram_jaccard._counter(s).tolist())
    levels = SimpleNamespace(value=np.zeros(ngram_jaccard.COUNTERS, np.uint8))
    for run in (ngram_jaccard._sized(5), ngram_jaccard._keyed(5, 4, 5, levels)):
        tracemalloc.start()
        for b in run(iter([batch])):
            if "counts" in b.schema.names and b.column(5).null_count == 0:
                counts = np.concatenate([np.frombuffer(zlib.decompress(c), np.uint8) for c in b.column(5).to_pylist()])
        assert tracemalloc.get_traced_memory()[1] < 50e6
        tracemalloc.stop()
    assert all(counts[k] == min(n, 255) for k, n in want.items()) and np.count_nonzero(counts) == len(want)


def plain_targets(sizes, weights=(5, 2, 1), share=1.0):
    names = sorted((s for s in sizes if s is not None), key=str) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * float(sum(sizes.values()))
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > 3 * sizes[s]}
        if not over:
            return target | {s: level * w[s] for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_mix(spark, small):
    rng = random.Random(3)
    # One source holds most rows; another has one document.
    rows = [(i, "w " * rng.choice([1, 5, 9, 40, 300]), "en", rng.choice(["hot"] * 8 + ["b", "c", None])) for i in range(900)] + [(900, "x", "en", "zz")]
    for docs in (spark.createDataFrame(rows, DOCS), small):
        got = mixing.mix(docs).collect()
        sizes, largest = Counter(), Counter()
        for r in docs.collect():
            n = len(words_of(r.text))
            sizes[r.source] += n
            largest[r.source] = max(largest[r.source], n)
        target, taken = plain_targets(dict(sizes)), Counter()
        assert len(got) == docs.count()
        for r in got:
            taken[r.source] += r.taken
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) and 0 <= r.taken <= 3 * r.size
        for s in sizes:
            # Whole copies: half a document at most is missing or over.
            assert abs(taken[s] - target[s]) <= max(1, largest[s] / 2)
        assert Counter(map(tuple, mixing.mix(docs.repartition(5)).collect())) == Counter(map(tuple, got))


def test_mix_of_odd_rows(odd, empty):
    got = mixing.mix(odd).collect()
    assert len(got) == len(ODD) and all(r.taken == 0 and r.copies == 1 for r in got if not r["size"])
    assert mixing.mix(empty).count() == 0


def test_rates_are_the_entropy_balance(spark):
    rng = random.Random(8)
    rows = [(i, "w " * rng.choice([1, 2, 7, 30, 200]), "en", rng.choice(["a", "a", "a", "b", "c", "d"])) for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    for source in "abcd":
        mine = [r for r in got if r.source == source]
        target, size = mine[0].target, np.array([r["size"] for r in mine], float)
        # The tilt by bisection, apart from the operator.
        low, high = -50.0, 50.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if (size * np.minimum(3, np.exp(mid * size / size.max()))).sum() < target else (low, mid)
        want = np.minimum(3, np.exp(low * size / size.max()))
        assert [r.rate for r in mine] == pytest.approx(want.tolist(), abs=2e-3)
        assert sum(r.rate * r["size"] for r in mine) == pytest.approx(target, abs=1)
        # A group of equal sizes gets its rate, rounded; the smallest sizes make up for the rest.
        group = [r for r in mine if r["size"] == 200]
        assert abs(sum(r.copies - r.rate for r in group)) <= 1 and max(r.copies for r in group) - min(r.copies for r in group) <= 1


def test_ranks_and_levels_of_many_sources(spark):
    rng = random.Random(2)
    sizes = {f"s{rng.random()}": rng.choice([0, 1, 5, 100, 10_000]) for _ in range(300)} | {None: 40, "": 9}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(7)
    for share in (1.0, 0.5):
        got = {r.source: r.target for r in mixing.water_filled(frame, (5, 2, 1), share, 3.0).collect()}
        want = plain_targets(sizes, share=share)
        assert set(got) == set(want) and all(got[s] == pytest.approx(want[s], abs=1e-6) for s in want)


def test_sentence_pieces_in_chunks_are_as_good_as_whole(spark, small):
    docs = small.filter("n_chars between 200 and 4000").union(spark.createDataFrame([(-1, "", "en", "x", 0), (-2, None, "en", "x", 0), (-3, "ab " * 900 + "日本\t  é😀", "en", "x", 0)], small.schema))
    whole = {r.doc_id: r.ids for r in sentence_pieces.encode(docs).collect()}
    cut = sentence_pieces.decode(sentence_pieces.encode(docs, chunk=97)).collect()
    assert len(cut) == docs.count()
    pieces = Pieces.load(sentence_pieces.MODEL_FILE)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in cut:
        assert r.decoded == texts[r.doc_id]
        assert pieces.score_sum(np.array(r.ids, np.int64)) == pytest.approx(pieces.score_sum(np.array(whole[r.doc_id], np.int64)), rel=1e-9)


def test_sentence_pieces_are_those_of_the_model(spark, small):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL_FILE)
    more = [(-1, "international " * 60, "en", "x", 0), (-2, "  a   b\t\n" * 40 + "日本é😀" * 30, "en", "x", 0), (-3, "=" * 500 + "ab" * 300 + "\0", "en", "x", 0)]
    docs = small.filter("n_chars < 6000").union(spark.createDataFrame(more, small.schema)).cache()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for chunk in (97, sentence_pieces.CHUNK):
        for r in sentence_pieces.encode(docs, chunk=chunk).collect():
            assert r.ids == model.encode(texts[r.doc_id])


def plain_merges(pieces, text):
    """Merges one by one: of all neighbours the pair of the best rank, the leftmost of equal ones."""
    parts = list(pieces.prepared(text))
    while pairs := [(-pieces.score[pieces.id[x + y]], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in pieces.id]:
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def test_sentence_pieces_transfer_matrices(small):
    pieces = Pieces.load(sentence_pieces.MODEL_FILE)
    rng = random.Random(6)
    texts = [r.text for r in small.filter("n_chars > 300").orderBy("doc_id").limit(20).collect()]
    texts = [rng.choice(texts)[:300] if k % 3 == 0 else "".join(rng.choices(rng.choice(["ab", "= ", " ", "the =", "日本é😀ab ", "-*/="]), k=rng.randint(1, 120))) for k in range(120)]
    for k, text in enumerate(texts):
        t, chunk = pieces.prepared(text), (1, 3, 16, 40, 97)[k % 5]
        matrices, parts = [], []
        for p in range(0, len(t), chunk):
            s, q = max(0, p - pieces.longest), min(p + chunk, len(t))
            parts.append((s, t[s : p + chunk + pieces.longest]))
            matrices.append([tuple(x + s for x in step) for step in pieces.transfer(parts[-1][1], p - s, q - s)])
            # One encoding for each begin and end.
            assert len({(a, d) for a, _, _, d in matrices[-1]}) == len(matrices[-1])
        ids = [i for (s, part), step in zip(parts, best_path(matrices, (0, 0))) for i in pieces.between(part, tuple(x - s for x in step)).tolist()]
        assert ids == pieces.encode(text).tolist()
        assert [pieces.raw[i] for i in ids if pieces.width[i] > 0 and i in pieces.id.values()] == [p.replace("▁", " ").encode() for p in plain_merges(pieces, text) if p in pieces.id]
        # The product doesn't depend on where it is begun; of the whole text one place is finite.
        m = len(matrices) // 2
        halves = [x for x in (matrices[:m], matrices[m:]) if x]
        whole = reduce(product, matrices)
        assert whole == reduce(product, [reduce(product, x) for x in halves]) and len(whole) == 1


def test_sentence_pieces_of_a_run_without_a_cut(spark):
    # No place of these texts is free of pieces that span it; one is in very many chunks.
    docs = spark.createDataFrame([(1, "thequickbrownfox" * 3000), (2, "=" * 3000), (3, "ab" * 1000), (3, "ab" * 1000)], "doc_id long, text string")
    pieces = Pieces.load(sentence_pieces.MODEL_FILE)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = sentence_pieces.encode(docs, chunk=300).collect()
    assert len(got) == 4 and all(r.ids == pieces.encode(texts[r.doc_id]).tolist() for r in got)


def test_sentence_pieces_of_odd_rows(odd, empty):
    got = sentence_pieces.decode(sentence_pieces.encode(odd)).collect()
    assert Counter((r.doc_id, r.decoded) for r in got) == Counter((d, t or "") for d, t, *_ in ODD)
    assert sentence_pieces.encode(empty).count() == 0


def test_substring_dedup(spark, empty):
    line = "this line has quite enough words to be counted as a unit here"
    rows = [(2, f"{line}\nfirst own line that nobody else has in any document", "en", "x"), (1, f"  {line.upper()}  \nanother line that is only in this one document", "en", "x"), (3, f"{line}\n{line}", "en", "x"), (4, None, None, None), (5, "", None, None)]
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert [got[i].n_units_removed for i in (1, 2, 3, 4, 5)] == [0, 1, 2, 0, 0]
    text = dict((r[0], r[1]) for r in rows)
    assert line in text[2][got[2].removed[0].start : got[2].removed[0].end] and line not in got[2].clean_text
    assert got[1].clean_text == text[1] and "first own line" in got[2].clean_text
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_substring_dedup_of_passages_of_short_units(spark):
    passage = " ".join(f"ERW{i}HED.!! Eh{i}.\n" for i in range(40))
    own = "here begins what only this one document says to its readers"
    rows = [(1, passage), (2, passage.lower()), (3, f"{own} one.\n{passage}\n{own} three."), (4, "Ho ho. Hi."), (5, "ho ho! hi"), (6, f"Ho ho. Hi.\n{own} six.")]
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].n_units_removed for i in range(1, 7)] == [0, 80, 80, 0, 2, 0]
    assert not re.search("[a-z]", got[2].clean_text) and "hed" not in got[3].clean_text.lower() and got[3].clean_text.count(own) == 2


def test_substring_dedup_covers_every_repeated_passage():
    rng = random.Random(4)
    unit = lambda: " ".join(rng.choices("abcdefgh", k=rng.choice([1, 1, 2, 4, 9, 12]))) + rng.choice([". ", "!\n", ".\n---\n"])
    for _ in range(300):
        passage = "".join(unit() for _ in range(rng.randint(1, 12)))
        if len(re.findall("[a-h]", passage)) < substring_dedup.MIN_WORDS:
            continue
        here, there = (f"{''.join(unit() for _ in range(rng.randint(0, 3)))}\n" for _ in "ab")
        known = {k for *_, k in substring_dedup.keys(there + passage + unit())}
        spans = [(a, b) for a, b, k in substring_dedup.keys(here + passage + unit()) if k in known]
        text = here + passage
        assert all(any(a <= i < b for a, b in spans) for i in range(len(here), len(text)) if text[i].isalpha())


def plain_units(text):
    """Units by a scan of characters: (start, end, folded words)."""
    ws, out, at, i = " \t\n\v\f\r", [], 0, 0
    while i <= len(text):
        j = i
        while j < len(text) and text[j] in ws:
            j += 1
        if i == len(text) or (j > i and (set(text[i:j]) & set("\n\r") or (i and text[i - 1] in ".!?"))):
            if i > at:
                out.append((at, i, re.sub(r"[\W_]+", " ", text[at:i].lower()).split()))
            at = j
        if i == len(text):
            break
        i = max(j, i + 1)
    return [(a, b, w) for a, b, w in out if w]


def plain_removed(rows, least=8):
    """Removed characters of each row, by comparing every stretch with all ranked
    before it; a stretch is a shortest run of units of ``least`` words."""
    stretches = []
    for r, (d, text) in enumerate(rows):
        u = plain_units(text or "")
        n = [len(w) for *_, w in u]
        if sum(n) < least:
            spans = {(0, len(u) - 1)} if u else set()
        else:
            spans = {(i, j) for i in range(len(u)) for j in range(i, len(u)) if sum(n[i : j + 1]) >= least and (sum(n[i:j]) < least or sum(n[i + 1 : j + 1]) < least)}
        whole = sum(n) < least
        for i, j in spans:
            stretches.append((d is None, d or 0, r, u[i][0], u[j][1], (whole, tuple(tuple(w) for *_, w in u[i : j + 1]))))
    removed = defaultdict(set)
    for s in stretches:
        if any(o[5] == s[5] and (o[0], o[1], o[2], o[3]) < (s[0], s[1], s[2], s[3]) for o in stretches):
            removed[s[2]] |= set(range(s[3], s[4]))
    return removed


def test_substring_dedup_against_comparing_all(spark):
    rng = random.Random(9)
    unit = lambda: " ".join(rng.choices(["ab", "Cd", "e-f", "gh", "1"], k=rng.choice([1, 2, 3, 9, 12]))) + rng.choice([". ", "!\n", "  \r\n", "? ", ".\n---\n", ", "])
    pool = [unit() for _ in range(25)]
    rows = [(i, "".join(rng.choice(pool) if rng.random() < 0.7 else unit() for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [(70, rows[4][1] + rows[9][1]), (71, ""), (72, " \n "), (73, "Hi. Ho."), (74, "hi ho!"), (75, "Hi.\tHO")]
    want = plain_removed(rows)
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for k, (d, text) in enumerate(rows):
        have = {i for s in got[d].removed for i in range(s.start, s.end)}
        blank = lambda chars: {i for i in chars if not text[i].isspace()}
        assert blank(have) == blank(want[k])
        assert got[d].clean_text == "".join(c for i, c in enumerate(text) if i not in have)


def test_substring_dedup_keeps_the_first_of_equal_rows(spark):
    t, u = "one line of quite enough words to count as a unit", "another line of quite enough words to count as one"
    rows = [(1, t), (1, t), (None, u), (None, u), (2, "own words that are in no other row of this table")]
    got = Counter((r.doc_id, r.clean_text) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter({(1, t): 1, (1, ""): 1, (None, u): 1, (None, ""): 1, rows[4]: 1})


def test_substring_dedup_of_a_megabyte_of_blanks(spark):
    began = time.time()
    text = "a first line here." + " " * (1 << 20) + "x" + " \n" * (1 << 19) + "end"
    got = substring_dedup.remove_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got.clean_text == text and time.time() - began < 30


def test_substring_dedup_of_odd_rows(odd):
    assert substring_dedup.remove_repeats(odd).count() == len(ODD)


def test_language_id(small, odd, empty):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language_id.train(small, ~held)
    got = language_id.identify(small.filter(held & F.col("lang").isNotNull()), model).filter("lang_pred != 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.9 * len(got)
    rows = language_id.identify(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.lang_score <= 1 for r in rows)
    assert all(r.lang_pred == "und" and r.lang_score == 0 for r in rows if not (r.text or "").strip())
    assert language_id.identify(empty, model).count() == 0
    assert {r.lang_pred for r in language_id.identify(odd, language_id.train(empty, F.lit(True))).collect()} == {"und"}


def test_quality(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = quality.train(docs, labels, ~held)
    rows = quality.score(docs.filter(held), model).join(labels, "doc_id").select("quality", "quality_score").collect()
    good, bad = [r.quality_score for r in rows if r.quality == 1], [r.quality_score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) >= 0.8
    got = quality.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.quality_score <= 1 for r in got)
    assert quality.score(empty, model).count() == 0


def test_quality_against_comparing_with_every_vector(small):
    rng = np.random.default_rng(3)
    texts = [r.text or "" for r in small.select("text").collect()]
    x, labels = np.array([quality.terms(t) for t in texts[:120]]), rng.integers(0, 2, 120)
    model = quality.Model(x, labels.tolist())
    # The latent space by a singular value decomposition, votes one by one.
    centred = x - x.mean(0)
    axes = np.linalg.svd(centred.astype(np.float64), full_matrices=False)[2][: quality.DIMENSIONS]
    unit = lambda z: z / max(1e-9, np.linalg.norm(z))
    known = [unit(axes @ c) for c in centred]
    for text, got in zip(texts[120:], model.scores(texts[120:])):
        z = unit(axes @ (quality.terms(text) - x.mean(0)))
        near = sorted(((z @ v, y) for v, y in zip(known, labels)), reverse=True)[: quality.NEIGHBOURS]
        weight = [max(c, 0) ** 4 + 1e-6 for c, _ in near]
        assert got == pytest.approx(sum(w * y for w, (_, y) in zip(weight, near)) / sum(weight), abs=0.02)


def test_long_texts_are_as_one_piece(monkeypatch, small):
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("abcdeé日ÄZ.,\n7", k=rng.randint(1, 9))) for _ in range(3000))
    want = quality.terms(text)
    symbols = language_id.alphabet(*language_id.letter_counts(text))
    grams = language_id.of_text(symbols, text)
    sets = list(words.shingle_sets(pa.array([text, "a b", text[:99]]), 5))
    model = lm_scoring.train(small.limit(50), rounds=1)
    table = lm_scoring.token_table(model.letters)
    n, total = model.scores([text, "ab", text], table)
    for module in (quality, language_id, words, lm_scoring):
        monkeypatch.setattr(module, "SLICE", 501)
    assert quality.terms(text) == pytest.approx(want)
    assert (language_id.of_text(symbols, text) == grams).all()
    assert all((a == b).all() for a, b in zip(words.shingle_sets(pa.array([text, "a b", text[:99]]), 5), sets))
    again = model.scores([text, "ab", text], table)
    assert (again[0] == n).all() and again[1] == pytest.approx(total, rel=1e-6)


def test_language_kernel_against_plain_sets(small):
    rows = small.filter("lang is not null and text is not null").select("text", "lang").limit(60).collect()
    counts = Counter(c.lower()[0] for r in rows for c in r.text if c.isalpha())
    table = language_id.alphabet([ord(c) for c in counts], list(counts.values()))
    sets = [language_id.of_text(table, r.text) for r in rows]
    model = language_id.Model(table, sets, [r.lang for r in rows])
    plain = [set(s.tolist()) for s in sets]
    chosen = [i for x in model.langs for i in [j for j, r in enumerate(rows) if r.lang == x][: language_id.LANDMARKS]]
    kernel = [[len(a & plain[j]) / np.sqrt(len(a) * len(plain[j])) for j in chosen] for a in plain]
    assert model._kernel(sets) == pytest.approx(np.array(kernel), abs=1e-4)


def test_lm_scores_are_sums_of_conditionals(small, odd, empty):
    model = lm_scoring.train(small, rounds=4)
    net, table = lm_scoring.Network(np.frombuffer(model.flat)), lm_scoring.token_table(model.letters)
    docs = small.filter("n_chars < 3000").orderBy("doc_id").limit(20)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in lm_scoring.score(docs, model).collect():
        s = [0, 0, *(table[ord(c)] for c in texts[r.doc_id].replace("\0", "\1")), 0, 0]
        near = np.array([[s[i - 2], s[i - 1], s[i + 1], s[i + 2]] for i in range(2, len(s) - 2)], np.int64).reshape(-1, 4)
        want = net.log_probabilities(near)[np.arange(len(near)), s[2:-2]].sum() if len(near) else 0
        assert r.n_tokens == len(near) and r.log_likelihood == pytest.approx(want, rel=1e-4)
    rows = lm_scoring.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(r.log_likelihood == 0 and r.mean_log_likelihood is None for r in rows if not r.n_tokens)
    assert lm_scoring.score(empty, lm_scoring.train(empty, rounds=1)).count() == 0


def test_lm_tells_rare_characters_apart(spark):
    # 40 letters, digits and a second script, all often; a few characters are rare.
    alphabet = "abcdefghijklmnopqrstuvwxyzäöüßñíçêABC0123456789абвгд"
    docs = spark.createDataFrame([(i, "".join(c + " " for c in alphabet)) for i in range(30)] + [(99, "".join(map(chr, range(0x4E00, 0x4E40))))], "doc_id long, text string")
    letters = lm_scoring.letters_of(docs)
    assert set(letters) == {*alphabet, " "}
    table = lm_scoring.token_table(letters)
    assert len({table[ord(c)] for c in letters}) == len(letters) and len({table[p] for p in range(0x4E00, 0x4E40)} - {table[ord(c)] for c in letters}) > 20


def test_lm_gradient_passes_over_all_windows(spark):
    rng = np.random.default_rng(2)
    net = lm_scoring.Network(tokens=70, seed=3)
    w, n = rng.integers(1, 70, (50, 5)), rng.integers(1, 9, 50)
    loss = lambda flat: -(n * np.log(np.take_along_axis(np.exp(lm_scoring.Network(flat).log_probabilities(w[:, :4]).astype(np.float64)), w[:, 4:], 1)[:, 0])).sum()
    g, way = net.gradient(w, n), rng.normal(size=len(net.flat))
    assert (loss(net.flat + 1e-3 * way) - loss(net.flat - 1e-3 * way)) / 2e-3 == pytest.approx(g @ way, rel=0.02)
    # A window counted twice weighs as two; none is left out.
    assert np.allclose(net.gradient(np.repeat(w, n, 0), np.ones(n.sum())), g, rtol=1e-3, atol=1e-3)
    docs = spark.createDataFrame([(1, "abcabc" * 50), (2, "äöü" * 9), (3, None)], "doc_id long, text string")
    counts = lm_scoring.window_counts(docs, ["a", "b"])
    assert counts.agg(F.sum("n")).first()[0] == 327


@pytest.mark.parametrize("tokens", [9, 5000])
def test_lm_network_sees_a_window_once_a_task(monkeypatch, tokens):
    letters = [chr(0x4E00 + i) for i in range(tokens)]
    rng, table, seen = random.Random(8), lm_scoring.token_table(letters), []
    texts = ["".join(rng.choices(letters[-9:], k=900)) for _ in range(6)]
    model = lm_scoring.Model(letters, lm_scoring.Network(tokens=1 + lm_scoring.HASHED + tokens, seed=4))
    plain = Counter(tuple(w) for _, _, p, _ in lm_scoring.windows(texts, table) for w in lm_scoring.unpacked(p).tolist())
    for _, _, p, _ in lm_scoring.windows(texts, table):
        once, n = lm_scoring.counted(p)
        assert dict(zip(map(tuple, lm_scoring.unpacked(once).tolist()), n.tolist())) == plain
    want = [model.scores([t], table)[1][0] for t in texts]
    work = lm_scoring.Network.of_windows
    monkeypatch.setattr(lm_scoring.Network, "of_windows", lambda self, w: seen.append(len(w)) or work(self, w))
    for many in (lm_scoring.KNOWN, 100):
        monkeypatch.setattr(lm_scoring, "KNOWN", many)
        known, seen[:] = lm_scoring.Known(), []
        got = np.concatenate([model.scores(texts[i : i + 2], table, known)[1] for i in (0, 2, 4, 0)])
        assert got == pytest.approx([*want, *want[:2]], rel=1e-6)
        if tokens == 9 and many > 100:
            assert sum(seen) == len(plain)


def test_lm_likes_prose_better_than_noise(spark, small):
    model = lm_scoring.train(small)
    prose = small.filter("lang = 'en' and n_chars > 500").orderBy("doc_id").first().text
    letters = list(prose)
    random.Random(1).shuffle(letters)
    a, b = (r.mean_log_likelihood for r in lm_scoring.score(spark.createDataFrame([(1, prose), (2, "".join(letters))], "doc_id long, text string"), model).orderBy("doc_id").collect())
    assert a > b + 0.2


def test_chat(spark):
    rows = [(1, 2, "assistant", "hi </turn> \\### x"), (1, 1, "user", None), (2, 1, "assistant", ""), (3, 1, "wizard", "</turn>"), (None, 1, "user", "u"), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    out = chat.format_chats(frame)
    back = {r.conv_id: r for r in chat.read_back(out).collect()}
    turns = {k: [(t.role, t.text) for t in r.turns] for k, r in back.items()}
    assert turns == {1: [("user", ""), ("assistant", "hi </turn> \\### x")], 2: [("assistant", "")], 3: [("wizard", "</turn>")], None: [("", ""), ("user", "u")]}
    assert back[1].loss_texts == ["hi </turn> \\### x"] and back[1].bad_turn is None and back[2].bad_turn == 0 and back[3].bad_turn == 0
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_chat_templates_with_blank_marks(spark):
    texts = ["one\ntwo", "\n\n", " \\ ", "", "<a>: b"]
    frame = spark.createDataFrame([(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    for template in (chat.Template(start="<|", mid="\n", end="\n"), chat.Template(start="", mid=" ", end="\n\n"), chat.Template(start="\t", mid="\n", end="\t\n")):
        back = chat.read_back(chat.format_chats(frame, template), template).first()
        assert [t.text for t in back.turns] == texts and back.loss_texts == texts[1::2]
    with pytest.raises(ValueError):
        chat.Template(end="").codes()


def test_chat_query_reads_every_conversation_back(spark):
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").collect()
    chats = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.turn):
        chats[r.conv_id].append((r.role, r.text or ""))
    chats[-7] = [("user", chat.PLANTED), ("assistant", chat.PLANTED)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {(c, len(t), sha("".join(f"{a}\n{b}\n" for a, b in t)), sha("".join(b for a, b in t if a == "assistant"))) for c, t in chats.items()}
    assert {(r.conv_id, r.n_turns, r.turns_sha256, r.loss_sha256) for r in chat.query(spark, SMALL).collect()} == want


def test_fingerprints(odd, empty):
    got = fingerprints.fingerprints(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in ODD)
    by_id = {r.doc_id: r.fingerprint for r in got if r.doc_id is not None}
    assert by_id[1] == by_id[2] == by_id[3] and by_id[4] == by_id[5] == by_id[6] and by_id[1] != by_id[10]
    # Where every digest collides, the bytes still tell texts apart.
    worst = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(odd, digest_of=lambda c: "0" * 32).collect() if r.doc_id is not None}
    assert worst[1] == worst[2] == worst[3] and len(set(worst.values())) == len(set(by_id.values()))
    assert fingerprints.fingerprints(empty).count() == 0


def test_fingerprint_query(spark, small):
    texts = {r.doc_id: r.text or "" for r in small.select("doc_id", "text").collect()}
    down = sorted(texts, reverse=True)
    follow = dict(zip(down, down[1:] + down[:1]))
    for r in fingerprints.query(spark, SMALL).collect():
        t, nxt = texts[r.doc_id], texts[follow[r.doc_id]]
        half = len(t) // 2
        new = t[: len(t) - half] + nxt[:half]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1.0)
