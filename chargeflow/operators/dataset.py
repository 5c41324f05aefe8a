"""From labelled minutes to a training set: bounds, pruning, leak-free splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import label_clip
from ..settings import LABEL
from ..storage import written


def label_and_bounds(rows: DataFrame) -> DataFrame:
    """Rows with a positive label (cut to a day) and plausible, or unknown, voltage and current."""
    rows = rows.withColumn(LABEL, label_clip(F.col(LABEL)))
    volts = F.col("voltage").isNull() | F.col("voltage").between(200, 900)
    amps = F.col("current").isNull() | F.col("current").between(-500, 500)
    return rows.filter((F.col(LABEL) > 0) & volts & amps)


def column_profile(rows: DataFrame, max_missing: float = 0.98, label: str = LABEL) -> DataFrame:
    """One row per numeric column: rows, values, share missing, whether all its
    values are equal, and whether it is kept. One pass over the table."""
    numeric = [n for n, t in rows.dtypes if t in ("double", "float", "bigint", "int", "smallint", "tinyint") or t.startswith("decimal")]
    found = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.struct(F.count(c).alias("present"), F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")).alias(f"c{i}") for i, c in enumerate(numeric)],
    )
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("s")) for i, c in enumerate(numeric)])).alias("x")
    out = found.select("n", each).select(F.col("x.column").alias("column"), "n", F.col("x.s.present").alias("n_present"), F.col("x.s.low").alias("_l"), F.col("x.s.high").alias("_h"))
    missing = F.when(F.col("n") > 0, 1 - F.col("n_present") / F.col("n")).otherwise(1.0)
    out = out.select("column", "n", "n_present", missing.alias("missing_share"), F.coalesce(F.col("_l") == F.col("_h"), F.lit(True)).alias("constant"))
    return out.withColumn("kept", (F.col("column") == label) | ((F.col("n_present") > 0) & ~F.col("constant") & (F.col("missing_share") < max_missing)))


def prune_features(rows: DataFrame, max_missing: float = 0.98, label: str = LABEL) -> DataFrame:
    """Only the columns that the profile keeps, the label last."""
    kept = {r.column for r in column_profile(rows, max_missing, label).filter("kept").collect()}
    return rows.select(*[c for c in rows.columns if c in kept and c != label], *([label] if label in kept else []))


def _ranked(keys: DataFrame, hash_: str) -> DataFrame:
    """Adds ``rank`` (1, 2, ...) in the order of a hex hash, and ``n``, the number of
    rows. Counts by the hash's first three digits are cumulated (4096 rows); rows
    are ranked within those: nothing is sorted in one task."""
    keys = keys.withColumn("_p", F.substring(hash_, 1, 3))
    counts = keys.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    counts = counts.withColumn("n", F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    within = F.row_number().over(Window.partitionBy("_p").orderBy(hash_))
    ranked = keys.withColumn("_r", within).join(F.broadcast(counts), "_p")
    return ranked.withColumn("rank", F.col("_before") + F.col("_r")).drop("_p", "_c", "_before", "_r")


def _shares(test: float, val: float, groups: bool) -> Column:
    """Split by rank: the first are test, the next val."""
    n = F.col("n")
    n_test = F.greatest(F.lit(1), F.bround(n * test, 0))
    rest = n - n_test
    n_val = F.greatest(F.lit(1), F.bround(rest * val, 0))
    if groups:
        n_val = F.when(rest >= 2, n_val).otherwise(0)
        n_test = F.when(n <= 1, 0).when(n == 2, 1).otherwise(n_test)
        n_val = F.when(n <= 2, 0).otherwise(n_val)
    return F.when(F.col("rank") <= n_test, "test").when(F.col("rank") <= n_test + n_val, "val").otherwise("train")


def group_split(rows: DataFrame, group: str = "session_key", test: float = 0.2, val: float = 0.1, seed: int = 42) -> DataFrame:
    """Adds ``split``: whole groups go to test (a fifth), val (a tenth of the rest)
    or train; rows without a group to train. Which ones goes by a hash, so
    reruns agree, and no group is in two splits."""
    # A row a group, written: its hashes are counted and ranked.
    groups = written(rows.filter(F.col(group).isNotNull()).select(group).distinct().withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), group))))
    named = _ranked(groups, "_h").select(group, _shares(test, val, True).alias("split"))
    return rows.join(named, group, "left").withColumn("split", F.coalesce("split", F.lit("train")))


def row_split(rows: DataFrame, key: list[str], test: float = 0.2, val: float = 0.1, seed: int = 42) -> DataFrame:
    """The same shares of single rows, told apart by ``key``: leaks between rows of a session."""
    hashed = rows.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])))
    return _ranked(hashed, "_h").withColumn("split", _shares(test, val, False)).drop("_h", "rank", "n")
