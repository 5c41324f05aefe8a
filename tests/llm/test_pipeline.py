"""The corpus pipeline, stage by stage, against the operators' plain rules."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chargeflow.llm import mixing
from chargeflow.llm.exact_dedup import exact_duplicates
from chargeflow.llm.ngram_jaccard import jaccard_groups

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        left[name] = (before, docs)
    before, after = left["language_id"]
    letters = {r.doc_id for r in before.collect() if re.search(r"[^\W\d_]", r.text or "")}
    kept = {r.doc_id for r in after.collect()}
    assert kept <= letters and len(kept) >= 0.95 * len(letters)
    before, after = left["exact_dedup"]
    assert {r.doc_id for r in after.collect()} == {r.keep_id for r in exact_duplicates(before).collect()}
    before, after = left["ngram_jaccard"]
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in jaccard_groups(before).collect()}
    before, after = left["mixing"]
    # Which of a source's documents of one size get the extra copy goes by a hash of the key.
    plan, want, got, words = mixing.mix(before).collect(), Counter(), Counter(), Counter()
    for r in plan:
        want[r.source, r.size] += r.copies
    for r in after.collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        got[r.source, n] += 1
        words[r.source] += n
    assert got == +want
    assert all(abs(words[r.source] - r.target) <= 0.02 * r.target + 50 for r in plan)
    before, after = left["sentence_pieces"]
    rows = after.collect()
    assert len(rows) == before.count() and all(r.round_trip for r in rows)


def test_run(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.count() > 0 and got.filter("not round_trip").count() == 0


PROSE = "the quick brown fox jumps over the lazy dog and then it rests in the warm sun beside the old river bank while birds sing"
ODD = [
    (1, PROSE, "en", "web"), (2, PROSE, "en", "web"), (2, PROSE, "en", "web"), (3, PROSE + " again", "en", "web"), (None, PROSE + " alone", "en", None),
    (4, None, "en", "web"), (5, "", None, None), (6, "ein ganz anderer Text mit vielen Worten über das Wetter", "de", "x"), (6, "noch ein Text derselben Nummer", "de", "x"),
    (7, "word " * 20_000, "en", "x"), (8, "12 34", "de", "x"),
]
KEPT = {
    "language_id": [1, 2, 2, 3, 6, 6, 7, None],
    "exact_dedup": [1, 3, 6, 6, 7, 8, 4, None],
    "ngram_jaccard": [1, 4, 5, 6, 6, 7, 8, None],
}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows_and_empty_tables(spark, name, stage):
    # Extra columns whose names the stages use inside.
    odd = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string").withColumns({c: F.lit("x") for c in ("copies", "_key", "_copy", "_id", "_sha", "_n", "_nth", "size", "row", "n", "lang_pred", "lang_score")})
    got = stage(spark, odd.drop_duplicates(["doc_id", "text"]) if name == "mixing" else odd, SMALL)
    ids = sorted((r.doc_id for r in got.collect()), key=lambda x: (x is None, x))
    if name in KEPT:
        assert ids == sorted(KEPT[name], key=lambda x: (x is None, x))
    if name == "mixing":
        assert {4, 5} <= set(ids) <= {r[0] for r in ODD}
    if name == "sentence_pieces":
        assert len(ids) == len(ODD)
    else:
        assert got.columns == odd.columns and {x for r in got.select(*odd.columns[4:]).collect() for x in r} <= {"x"}
    assert stage(spark, odd.limit(0), SMALL).count() == 0


def test_pieces_are_decoded_in_one_python_worker_a_task(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = corpus_pipeline.pieces(spark, docs, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
