"""Exact quantiles of large tables: no group's values are held in one buffer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written


def between(low: Column, high: Column, part: Column) -> Column:
    """``part`` of the way from ``low`` to ``high``, one product of the two rounded with
    the sum (a fused multiply-add, as DuckDB has it): next to values that differ in their
    last digit alone it decides which of them are above. Equal values give that value."""
    fused = F.reflect(F.lit("java.lang.Math"), F.lit("fma"), low, 1 - part, high * part).cast("double")
    return F.when((part == 0) | (low == high), low).when(low.isNotNull() & high.isNotNull(), fused)


def quantiles(rows: DataFrame, value: Column, shares: Sequence[float], by: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """``by`` and ``quantiles``, an array in the order of ``shares``: linear between
    the two neighbours, as ``percentile`` gives them (see ``between``). Null values are left out.
    ``weight``: how many times each row counts, once without.

    Equal values are counted, the counts are dealt to ranges of values and
    cumulated there; the sums of ranges before (a row a range) give the offset.
    """
    keys = [F.col(k) for k in by]
    times = F.lit(1).cast("long") if weight is None else weight.cast("long")
    counts = rows.select(*keys, value.cast("double").alias("_v"), times.alias("_w")).filter("_v is not null").groupBy(*keys, "_v").agg(F.sum("_w").alias("_c"))
    dealt = written(counts.repartitionByRange(*keys, "_v").withColumn("_p", F.spark_partition_id()))
    own = list(by) or [F.lit(0)]
    sums = dealt.groupBy(*by, "_p").agg(F.sum("_c").alias("_s"))
    sums = sums.withColumns({"_before": F.coalesce(F.sum("_s").over(Window.partitionBy(*own).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_n": F.sum("_s").over(Window.partitionBy(*own))})
    sums = sums.select(F.col("_p").alias("_q"), "_before", "_n", *[F.col(k).alias(f"_{k}") for k in by])
    same = F.col("_p") == F.col("_q")
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    within = F.sum("_c").over(Window.partitionBy(*by, "_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = dealt.withColumn("_upto", within).join(sums, same).select(*by, "_v", "_n", (F.col("_before") + F.col("_upto") - F.col("_c")).alias("_from"), (F.col("_before") + F.col("_upto")).alias("_to"))
    at = lambda rank: F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_to")), F.col("_v")))
    parts = []
    for share in shares:
        exact = (F.col("_n") - 1) * F.lit(float(share))
        low, high = at(F.floor(exact)), at(F.ceil(exact))
        parts.append(F.struct(low.alias("low"), high.alias("high"), F.max(exact - F.floor(exact)).alias("part")))
    found = ranked.groupBy(*by).agg(F.array(*parts).alias("_found"))
    each = [F.col("_found")[i] for i in range(len(shares))]
    return found.select(*by, F.array(*[between(x["low"], x["high"], x["part"]) for x in each]).alias("quantiles"))
