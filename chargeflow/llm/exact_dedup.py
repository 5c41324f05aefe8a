"""Exact deduplication with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import SPACE_RUN, read


def folded(text: Column) -> Column:
    """The text with each run of white space replaced by one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = F.md5
) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``.

    Rows are grouped by ``digest`` (128 bits) of the folded text *and* the text
    itself, so that a collision of digests never merges two texts: the bytes
    are compared inside each digest's group, by the partial aggregation of
    each task first. A group of a million copies is thus one row a task before
    anything is shuffled. The members find their group again by two digests of
    a few bytes; that join's large keys are split by adaptive execution.

    Nulls count as empty texts, empty texts are equal to each other; rows that
    repeat an id are counted each and are all kept if the id is the group's
    smallest; null ids come last, and stay only where a group has no other id
    (``keep_id`` is null then). Columns other than the two are ignored.
    """
    text = folded(F.col(text_col))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("_text"))
    groups = (
        slim.withColumn("_digest", digest("_text"))
        .groupBy("_digest", "_text")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("_digest", F.sha2("_text", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    members = slim.select("doc_id", digest("_text").alias("_digest"), F.sha2("_text", 256).alias("text_sha256"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return members.join(groups, ["_digest", "text_sha256"]).select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; of rows that repeat
    both the id and the text, the least by all columns that can be ordered stays."""
    # Each text's smallest id is found on digests; only ids and digests meet the rows again.
    id_ = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    stay = exact_duplicates(docs, id_col, text_col).filter("kept").select(F.coalesce("doc_id", F.lit(-(2**63))).alias("_id"), F.col("text_sha256").alias("_sha"))
    # Rows are held as one column, so that no name of theirs clashes.
    rows = docs.select(id_.alias("_id"), F.sha2(folded(F.col(text_col)), 256).alias("_sha"), F.struct("*").alias("_row"))
    # The same keys part the rows of the join and of the window: one shuffle of texts.
    ordered = [F.col("_row").getField(f.name) for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    same = Window.partitionBy("_id", "_sha").orderBy(*ordered)
    return rows.join(stay, ["_id", "_sha"], "left_semi").withColumn("_n", F.row_number().over(same)).filter("_n = 1").select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
