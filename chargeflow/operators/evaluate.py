"""Scores of predictions, whole and by slice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sketches as S
from ..functions.columns import soc_band_right
from ..functions.quantiles import quantiles
from ..storage import written


#: Edges of the bands of charge by which errors are broken down.
SOC_EDGES = [0, 20, 40, 60, 80, 100]


def metric_columns(label: str = "rct_minutes", prediction: str = "prediction") -> list[Column]:
    error = F.abs(F.col(label) - F.col(prediction))
    return [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(error).alias("mae"),
        (F.avg(F.when(F.col(label) >= 1, error / F.col(label))) * 100).alias("mape"),
        F.count(F.lit(1)).alias("n"),
    ]


def _known(rows: DataFrame, label: str, prediction: str) -> DataFrame:
    return rows.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())


def regression_metrics(rows: DataFrame, by: list[str] | None = None, label: str = "rct_minutes", prediction: str = "prediction") -> DataFrame:
    """Errors of each group of ``by`` (of all rows without), null keys apart; MAPE
    over labels of a minute and more. ``p90`` and the median come from counts of
    equal values (see ``quantiles``), so that no group is sorted in one buffer."""
    by = by or []
    known = written(_known(rows, label, prediction).select(*by, label, prediction))  # read twice
    out = known.groupBy(*by).agg(*metric_columns(label, prediction))
    error = F.abs(F.col(label) - F.col(prediction))
    both = F.array(*[F.struct(F.lit(n).alias("k"), v.cast("double").alias("v")) for n, v in (("p90", error), ("median", F.col(prediction)))])
    long = known.select(*by, F.explode(both).alias("_x")).select(*by, F.col("_x.k").alias("_kind"), F.col("_x.v").alias("_value"))
    found = quantiles(long, F.col("_value"), [0.5, 0.9], [*by, "_kind"]).groupBy(*[F.col(k).alias(f"_{k}") for k in by])
    found = found.agg(F.max(F.when(F.col("_kind") == "p90", F.col("quantiles")[1])).alias("p90"), F.max(F.when(F.col("_kind") == "median", F.col("quantiles")[0])).alias("median_prediction"))
    on = F.lit(True)
    for k in by:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return out.join(found, on, "left").select(*by, "rmse", "mae", "mape", "p90", "median_prediction", "n")


def metrics_by_soc_band(rows: DataFrame, label: str = "rct_minutes", prediction: str = "prediction") -> DataFrame:
    """By 20 % bands of charge, closed on the right, the first on both sides."""
    rows = rows.withColumn("soc_lo", soc_band_right(F.col("soc"), SOC_EDGES, True))
    return regression_metrics(rows.filter("soc_lo is not null"), ["soc_lo"], label, prediction)


def metrics_by_current_decile(rows: DataFrame, label: str = "rct_minutes", prediction: str = "prediction") -> DataFrame:
    """By deciles of |A| over the table; equal edges are one, bins are closed on
    the right, the first on both sides."""
    rows = written(rows.filter("current is not null").select(F.abs("current").alias("_a"), label, prediction))
    edges = quantiles(rows, F.col("_a"), [i / 10 for i in range(11)]).select(F.array_distinct("quantiles").alias("edges"))
    rows = rows.crossJoin(F.broadcast(edges))
    index = F.greatest(F.lit(1), F.size(F.filter("edges", lambda e: e < F.col("_a"))))
    rows = rows.withColumn("decile", index)
    rows = rows.withColumns({"amps_lo": F.element_at("edges", F.col("decile")), "amps_hi": F.try_element_at("edges", F.col("decile") + 1)})
    return regression_metrics(rows, ["decile", "amps_lo", "amps_hi"], label, prediction)


def metrics_bundle(rows: DataFrame, label: str = "rct_minutes", prediction: str = "prediction", split: str = "split") -> DataFrame:
    """Errors of each split, whole and by slice, as rows (split, slice_type, slice,
    slice_lo, slice_hi, rmse, mae, mape, n). ``slice_type`` is ``all``, ``soc_band``
    (20 % bands, closed on the right, the first on both sides) or ``current_decile``
    (of |A| within the split; equal edges are one, closed like the bands).

    ``rows`` are read once: their error sums go by split, band and |A| into a table
    of partial sums, from which both the deciles' edges and, by one pass over
    grouping sets, all slices come. Rows without a label or prediction count
    nowhere, those without charge or current in no slice of it.
    """
    error, amps = F.abs(F.col(label) - F.col(prediction)), F.abs("current")
    known = _known(rows, label, prediction)
    partial = known.groupBy(F.col(split).alias("split"), soc_band_right(F.col("soc"), SOC_EDGES, True).alias("band"), amps.alias("amps")).agg(
        F.sum(error * error).alias("sq"),
        F.sum(error).alias("ab"),
        F.sum(F.when(F.col(label) >= 1, error / F.col(label))).alias("rel"),
        F.count_if(F.col(label) >= 1).alias("n_rel"),
        F.count(F.lit(1)).alias("n"),
    )
    partial = written(partial)
    edges = quantiles(partial, F.col("amps"), [i / 10 for i in range(11)], ["split"], F.col("n")).select(F.col("split").alias("_s"), F.array_distinct("quantiles").alias("edges"))
    sliced = partial.join(F.broadcast(edges), F.col("split").eqNullSafe(F.col("_s")), "left").drop("_s")
    decile = F.when(F.col("amps").isNotNull(), F.greatest(F.lit(1), F.size(F.filter("edges", lambda e: e < F.col("amps")))))
    sliced = sliced.select("split", "band", decile.alias("decile"), "edges", "sq", "ab", "rel", "n_rel", "n")
    sets = sliced.groupingSets([["split"], ["split", "band"], ["split", "decile"]], "split", "band", "decile").agg(
        F.grouping_id("split", "band", "decile").alias("_g"),
        F.sqrt(F.sum("sq") / F.sum("n")).alias("rmse"),
        (F.sum("ab") / F.sum("n")).alias("mae"),
        (F.try_divide(F.sum("rel"), F.sum("n_rel")) * 100).alias("mape"),
        F.sum("n").alias("n"),
        F.first("edges", True).alias("edges"),
    )
    kind = F.when(F.col("_g") == 3, "all").when(F.col("_g") == 1, "soc_band").otherwise("current_decile")
    sets = sets.withColumn("slice_type", kind).filter((F.col("slice_type") == "all") | F.coalesce("band", "decile").isNotNull())
    lo = F.when(F.col("slice_type") == "soc_band", F.col("band").cast("double")).when(F.col("slice_type") == "current_decile", F.get("edges", F.col("decile") - 1))
    hi = F.when(F.col("slice_type") == "soc_band", F.col("band") + 20.0).when(F.col("slice_type") == "current_decile", F.get("edges", F.col("decile")))
    name = F.when(F.col("slice_type") == "soc_band", F.concat("band", F.lit("-"), F.col("band") + 20)).otherwise(F.col("decile").cast("string"))
    return sets.select("split", "slice_type", F.coalesce(name, F.lit("all")).alias("slice"), lo.alias("slice_lo"), hi.alias("slice_hi"), "rmse", "mae", "mape", "n")


#: Width, in ampere, of the cells in which months keep their error sums.
AMPS_CELL = 0.1


def month_metrics(rows: DataFrame, label: str = "rct_minutes", prediction: str = "prediction", by: Sequence[str] = ("yyyymm",)) -> DataFrame:
    """What a month (each of ``by``) leaves of its errors: a row for each cell of |A|
    (null: unknown) with error sums and sketches of errors, predictions and |A|. At
    most as many rows as there are cells, however many predictions there were."""
    error = F.abs(F.col(label) - F.col(prediction))
    known = _known(rows, label, prediction).select(*by, F.floor(F.abs("current") / AMPS_CELL).alias("cell"), error.alias("error"), F.col(prediction).alias("predicted"), F.abs("current").alias("amps"), F.when(F.col(label) >= 1, error / F.col(label)).alias("relative"))
    return S.month_sketches(known, {c: F.col(c) for c in ("error", "predicted", "amps", "relative")}, [*by, "cell"])


def metrics_of_months(months: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``regression_metrics`` of rows of ``month_metrics``, merged: ``p90`` and the median
    within the sketches' error of rank, the rest exact."""
    whole = S.merged(months, ["error", "predicted", "relative"], by)
    n = F.col("error.n")
    return whole.select(
        *by,
        F.sqrt(F.col("error.squares") / n).alias("rmse"),
        (F.col("error.sum") / n).alias("mae"),
        (F.try_divide(F.col("relative.sum"), F.col("relative.n")) * 100).alias("mape"),
        S.quantile("error", 0.9).alias("p90"),
        S.quantile("predicted", 0.5).alias("median_prediction"),
        n.alias("n"),
    )


def deciles_of_months(months: DataFrame) -> DataFrame:
    """``metrics_by_current_decile`` of rows of ``month_metrics``: edges from the merged
    sketch, a cell's errors in the decile of the cell's middle."""
    amps = S.merged(months.filter("cell is not null"), ["amps"])
    shares = [i / 10 for i in range(11)]
    edges = amps.select(F.array_distinct(F.array(F.col("amps.low"), *[S.quantile("amps", q) for q in shares[1:-1]], F.col("amps.high"))).alias("edges"))
    middle = F.least(F.greatest((F.col("cell") + 0.5) * AMPS_CELL, F.get("edges", F.lit(0))), F.element_at("edges", -1))
    cells = months.filter("cell is not null").crossJoin(F.broadcast(edges)).withColumn("decile", F.greatest(F.lit(1), F.size(F.filter("edges", lambda e: e < middle))))
    cells = cells.withColumns({"amps_lo": F.element_at("edges", F.col("decile")), "amps_hi": F.try_element_at("edges", F.col("decile") + 1)})
    return metrics_of_months(cells, ["decile", "amps_lo", "amps_hi"])


def avg_prediction_by_band(rows: DataFrame, prediction: str = "prediction", step: int = 5) -> DataFrame:
    """Mean prediction in each band of ``step`` percent from 20 to 80 (closed on the
    right, the first on both sides), the total of all predictions there, and the mean
    of the first band less that of the last, whose lower edge counts here too."""
    edges = list(range(20, 81, step))
    band = soc_band_right(F.col("soc"), edges, True)
    known = rows.withColumn("soc_lo", band).filter(F.col("soc_lo").isNotNull() & F.col(prediction).isNotNull())
    last = F.when(F.col("soc") >= edges[-2], F.col(prediction))
    sums = known.groupBy("soc_lo").agg(F.sum(prediction).alias("_s"), F.count(F.lit(1)).alias("_n"), F.sum(last).alias("_last"), F.count(last).alias("_n_last"))
    first = F.max(F.when(F.col("soc_lo") == edges[0], F.col("_s") / F.col("_n")))
    whole = sums.agg(F.sum("_s").alias("total_prediction"), (first - F.try_divide(F.sum("_last"), F.sum("_n_last"))).alias("first_less_last"))
    return sums.select("soc_lo", (F.col("_s") / F.col("_n")).alias("mean_prediction")).crossJoin(F.broadcast(whole))


def success_checks(metrics: DataFrame) -> DataFrame:
    """From rows (model, split, rmse): is the tree model's val error within 1.1 of
    its test error, and its val error at least a fifth below the linear model's?"""
    of = lambda m, s: F.max(F.when((F.col("model") == m) & (F.col("split") == s), F.col("rmse")))
    return metrics.agg((of("gbt", "val") <= 1.1 * of("gbt", "test")).alias("stable"), (of("gbt", "val") <= 0.8 * of("ridge", "val")).alias("better_than_linear"))


def step_distribution(rct: DataFrame, keys: list[str]) -> DataFrame:
    """``step`` (minutes between neighbouring rows of a session, to three digits) and how often it occurs."""
    w = Window.partitionBy(*keys).orderBy("elapsed_min")
    steps = rct.select(F.round(F.col("elapsed_min") - F.lag("elapsed_min").over(w), 3).alias("step"))
    return steps.filter("step is not null").groupBy("step").agg(F.count(F.lit(1)).alias("n"))


def described(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Number, mean, deviation, extremes and quartiles of columns, a row each."""
    rows = written(rows.select(*columns))
    each = lambda c: F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev(c).alias("std"), F.min(c).cast("double").alias("lowest"), F.max(c).cast("double").alias("highest"))
    sums = rows.agg(*[each(c).alias(f"s{i}") for i, c in enumerate(columns)])
    sums = sums.select(F.explode(F.array(*[f"s{i}" for i in range(len(columns))])).alias("x")).select("x.*")
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")).select(F.col("x.k").alias("_k"), F.col("x.v").alias("_value"))
    q = quantiles(long, F.col("_value"), [0.25, 0.5, 0.75], ["_k"]).select("_k", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(["p25", "p50", "p75"])])
    return sums.join(F.broadcast(q), F.col("column") == F.col("_k"), "left").drop("_k")


def quality_report(rct: DataFrame, keys: list[str]) -> DataFrame:
    """One row of checks on labelled rows: values out of range, missing ones,
    repeated times, steps other than a minute (``step_distribution`` has them all)."""
    w = Window.partitionBy(*keys).orderBy("elapsed_min")
    rows = rct.withColumns({"_step": F.round(F.col("elapsed_min") - F.lag("elapsed_min").over(w), 3), "_again": F.col("elapsed_min") == F.lag("elapsed_min").over(w)})
    per = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("soc") < 0) | (F.col("soc") > 100)).alias("out"),
        F.count_if(F.col("current") < 0).alias("neg"),
        F.count_if(F.col("soc").isNull()).alias("no_soc"),
        F.count_if(F.col("current").isNull()).alias("no_amps"),
        F.count_if(F.col("elapsed_min").isNull()).alias("no_time"),
        F.count_if("_again").alias("again"),
        F.count_if(F.col("_step") == 1).alias("ones"),
        F.count_if(F.col("_step").isNotNull()).alias("steps"),
        F.max("_step").alias("longest"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per.agg(
        total("n").alias("n_rows"),
        total("out").alias("soc_out_of_range"),
        (100 * F.sum("neg") / F.sum("n")).alias("percent_negative_current"),
        total("no_soc").alias("null_soc"),
        total("no_amps").alias("null_current"),
        total("no_time").alias("null_elapsed"),
        total("again").alias("repeated_times"),
        total("ones").alias("steps_of_a_minute"),
        total("steps").alias("steps"),
        F.max("longest").alias("longest_step"),
        F.count_if(F.col("ones") < F.col("steps")).alias("sessions_with_other_steps"),
    )
