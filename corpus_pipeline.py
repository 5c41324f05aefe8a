"""A corpus pipeline of five stages, each on all that the one before kept.

Every stage but the last returns the columns of ``documents``; each result is
written as Parquet and read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chargeflow.llm import exact_dedup, language_id, mixing, ngram_jaccard, sentence_pieces
from chargeflow.llm.tables import WORD, materialize, shared_dir

#: A document whose best language scores less is rejected, as is one without letters.
LEAST_LANGUAGE_SCORE = 0.3


def unused(docs: DataFrame, name: str) -> str:
    """A name that no column of ``docs`` has, in whatever case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (7), learned from the labelled rows of ``docs``: documents
    without a language go, null and empty texts among them, and all where no row
    is labelled, as there is no language then."""
    model = language_id.train(docs, F.lit(True))
    pred, score = unused(docs, "lang_pred"), unused(docs, "lang_score")
    found = language_id.identify(docs, model, pred=pred, score=score)
    return found.filter((F.col(pred) != "und") & (F.col(score) >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup (3): of equal texts, the row with the smallest id stays; null
    ids come last. Of an id's different texts each stays."""
    return exact_dedup.keep_first(docs).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (4), five words, similarity of 0.8: of each group the
    document with the smallest id stays. Texts of one id are one document, which
    stays or goes whole; rows with a null id link with nothing and stay."""
    groups = ngram_jaccard.jaccard_groups(docs)
    gone = groups.filter("doc_id > component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources (10): each document as many times as the mix takes it, not
    at all where that is 0. Texts without words have no part in it and stay once."""
    # Exact dedup has left each pair of id and text once. Their key is a hash: of rows that
    # share one, the n-th by source and size meets the n-th of the mix, so that none is joined twice.
    # Rows are held as one column, so that no name of theirs clashes.
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("_key"), F.struct("*").alias("_row"))
    sized = keyed.select("_key", F.col("_row.text").alias("text"), F.col("_row.source").alias("source"))
    same = Window.partitionBy("_key")
    words = F.regexp_count(F.coalesce("_row.text", F.lit("")), F.lit(WORD))
    keyed = keyed.withColumn("_nth", F.row_number().over(same.orderBy("_row.source", words)))
    copies = mixing.mix(sized, id_col="_key").select(F.col("doc_id").alias("_key"), "copies", "source", "size")
    copies = copies.withColumn("_nth", F.row_number().over(same.orderBy("source", "size"))).filter("copies > 0").select("_key", "_nth", "copies")
    taken = keyed.join(copies, ["_key", "_nth"])
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("_row.*")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding (2), decoded again as proof; the ids stay. Each row,
    repeated ones too, gives one; null and empty texts have no ids."""
    # Written between, so that no task has two Python workers at a time, each with its tables.
    encoded = sentence_pieces.decode(materialize(sentence_pieces.encode(docs)))
    same = F.sha2("decoded", 256) == F.col("text_sha256")
    return encoded.select("doc_id", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", languages),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard", near_copies),
    ("mixing", mixed),
    ("sentence_pieces", pieces),
]

#: SQL can express neither the language model nor the segmentation; the tests compare stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
