"""Figures of many months from what each month left: sums and quantile sketches.

A month's row holds sums and KLL sketches of fixed size, whatever the number of its
rows; rows of months merge into one of any span, so that no month is read again.
Sums are exact. A quantile from a sketch is that of a rank at most RANK_ERROR away
(with great probability), merged or not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch; twice as much halves the error of ranks.
K = 400
RANK_ERROR = 0.01


def month_sketches(rows: DataFrame, values: Mapping[str, Column], by: Sequence[str] = ("yyyymm",), k: int = K) -> DataFrame:
    """A row for each of ``by``: for each value its number, sum, sum of squares, extremes
    and sketch as one struct column of its name. Null values count nowhere."""
    known = rows.select(*by, *[v.cast("double").alias(n) for n, v in values.items()])
    figures = {
        n: F.struct(
            F.count(n).alias("n"),
            F.sum(n).alias("sum"),
            F.sum(F.col(n) * F.col(n)).alias("squares"),
            F.min(n).alias("low"),
            F.max(n).alias("high"),
            F.kll_sketch_agg_double(n, F.lit(k)).alias("sketch"),
        ).alias(n)
        for n in values
    }
    return known.groupBy(*by).agg(*figures.values())


def merged(sketches: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The rows of months (and other keys) as one for each of ``by``."""
    figures = [
        F.struct(
            F.sum(f"{n}.n").alias("n"),
            F.sum(f"{n}.sum").alias("sum"),
            F.sum(f"{n}.squares").alias("squares"),
            F.min(f"{n}.low").alias("low"),
            F.max(f"{n}.high").alias("high"),
            F.kll_merge_agg_double(f"{n}.sketch").alias("sketch"),
        ).alias(n)
        for n in names
    ]
    return sketches.groupBy(*by).agg(*figures)


def quantile(name: str, share: float) -> Column:
    """A quantile of a merged column; null where there are no values."""
    return F.when(F.col(f"{name}.n") > 0, F.kll_sketch_get_quantile_double(F.col(f"{name}.sketch"), F.lit(float(share))))


def described(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number, mean, deviation, extremes and (approximate) quartiles of each column over
    all months, a row each, in the columns of ``evaluate.described``."""
    whole = merged(sketches, columns)
    parts = []
    for c in columns:
        n, total, squares = F.col(f"{c}.n"), F.col(f"{c}.sum"), F.col(f"{c}.squares")
        spread = F.greatest(F.lit(0.0), squares - total * total / n)
        figures = [n.alias("n"), F.try_divide(total, n).alias("mean"), F.when(n > 1, F.sqrt(spread / (n - 1))).alias("std"), F.col(f"{c}.low").alias("lowest"), F.col(f"{c}.high").alias("highest")]
        parts.append(F.struct(F.lit(c).alias("column"), *figures, *[quantile(c, q).alias(f"p{int(100 * q)}") for q in (0.25, 0.5, 0.75)]))
    return whole.select(F.explode(F.array(*parts)).alias("_x")).select("_x.*")
