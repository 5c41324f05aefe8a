"""From predictions to minutes in each band of charge that are possible in physics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import bucket_label, current_bucket
from ..settings import SESSION
from ..storage import written


def _w():
    return Window.partitionBy(*SESSION).orderBy("elapsed_min")


def smooth_median3(rows: DataFrame, column: str = "predicted_rct", out: str = "smooth") -> DataFrame:
    """Median of each value and its neighbours in time; unknown ones are left out."""
    near = F.array_sort(F.array_compact(F.array(F.lag(column).over(_w()), F.col(column), F.lead(column).over(_w()))))
    rows = rows.withColumn("_near", near)
    n = F.size("_near")
    middle = (F.try_element_at("_near", F.floor((n + 1) / 2).cast("int")) + F.try_element_at("_near", F.floor(n / 2).cast("int") + 1)) / 2
    return rows.withColumn(out, F.when(n > 0, middle)).drop("_near")


def monotone_decreasing(rows: DataFrame, column: str = "smooth", out: str = "monotone") -> DataFrame:
    """Not below 0, and never above an earlier value of the session."""
    upto = _w().rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.min(F.when(F.col(column).isNotNull(), F.greatest(F.col(column), F.lit(0.0)))).over(upto))


def prepared(predictions: DataFrame) -> DataFrame:
    return monotone_decreasing(smooth_median3(predictions))


def rct_at_soc(rows: DataFrame, step: int = 5) -> DataFrame:
    """``soc_at``, ``rct_at`` at 0, ``step``, ... 100 percent for each session: linear
    over the running maximum of the charge (of equal ones the latest value),
    the first and last value beyond its ends."""
    rows = rows.filter("soc is not null and monotone is not null")
    mono = rows.withColumn("_s", F.max("soc").over(_w().rowsBetween(Window.unboundedPreceding, 0)))
    knots = mono.groupBy(*SESSION, "_s").agg(F.max_by("monotone", "elapsed_min").alias("_y"))
    w = Window.partitionBy(*SESSION).orderBy("_s")
    knots = knots.withColumns({"_s0": F.lag("_s").over(w), "_y0": F.lag("_y").over(w), "_last": F.lead("_s").over(w).isNull()})
    low = F.when(F.col("_s0").isNull(), 0).otherwise(F.floor(F.col("_s0") / step) + 1)
    high = F.when(F.col("_last"), 100 // step).otherwise(F.least(F.floor(F.col("_s") / step), F.lit(100 // step)))
    points = F.when(low <= high, F.sequence(low.cast("int"), high.cast("int"))).otherwise(F.array().cast("array<int>"))
    out = knots.withColumn("_k", F.explode(points)).withColumn("soc_at", F.col("_k") * step)
    between = F.col("_y0") + (F.col("_y") - F.col("_y0")) * (F.col("soc_at") - F.col("_s0")) / (F.col("_s") - F.col("_s0"))
    value = F.when(F.col("_s0").isNull() | (F.col("soc_at") >= F.col("_s")), F.col("_y")).otherwise(between)
    return out.select(*SESSION, "soc_at", value.alias("rct_at"))


def session_soc_ranges(rows: DataFrame) -> DataFrame:
    low, high = F.min("soc"), F.max("soc")
    return rows.groupBy(*SESSION).agg(low.alias("soc_min"), high.alias("soc_max"), (high - low).alias("soc_span"))


def band_coverage(ranges: DataFrame, step: int = 5) -> DataFrame:
    """``soc_lo``, ``n_sessions``: how many sessions span each band entirely. A
    session explodes into the bands it spans; no pair is formed for others."""
    first, last = F.ceil(F.col("soc_min") / step), F.floor(F.col("soc_max") / step) - 1
    spans = ranges.filter(first <= last).select(F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("_k"))
    return spans.groupBy((F.col("_k") * step).alias("soc_lo")).agg(F.count(F.lit(1)).alias("n_sessions"))


def best_soc_window(ranges: DataFrame, low: int = 20, high: int = 80, step: int = 5) -> DataFrame:
    """One row ``soc_low``, ``soc_high``: the ideal window if a session spans it,
    else the longest unbroken run of bands that sessions span, the first of equal ones."""
    ideal = ranges.agg(F.max((F.col("soc_min") <= low) & (F.col("soc_max") >= high)).alias("ideal"))
    bands = band_coverage(ranges, step)
    island = F.col("soc_lo") / step - F.row_number().over(Window.orderBy("soc_lo"))  # at most 20 rows
    runs = bands.withColumn("_i", island).groupBy("_i").agg(F.min("soc_lo").alias("lo"), (F.max("soc_lo") + step).alias("hi"))
    best = runs.agg(F.max(F.struct((F.col("hi") - F.col("lo")).alias("len"), (-F.col("lo")).alias("neg"), "lo", "hi")).alias("b"))
    out = ideal.crossJoin(best)
    return out.select(F.when(F.col("ideal"), low).otherwise(F.col("b.lo")).cast("int").alias("soc_low"), F.when(F.col("ideal"), high).otherwise(F.col("b.hi")).cast("int").alias("soc_high"))


def chosen_sessions(rows: DataFrame, window: DataFrame) -> DataFrame:
    """The rows of sessions that span the window (a table of one row)."""
    fit = session_soc_ranges(rows).crossJoin(F.broadcast(window)).filter("soc_min <= soc_low and soc_max >= soc_high")
    return rows.join(fit.select(*SESSION), SESSION, "left_semi")


def minutes_per_band(rows: DataFrame, low: int = 20, high: int = 80, step: int = 5) -> DataFrame:
    """Per session and band: predicted minutes at its begin less those at its end
    (not below 0), median |A| of the units in it, and their ranges."""
    # Read twice: what leads to these rows is worked out once.
    rows = written(rows.select(*SESSION, "elapsed_min", "soc", "monotone", "current_master", "current_slave"))
    at = rct_at_soc(rows, step)
    w = Window.partitionBy(*SESSION).orderBy("soc_at")
    bands = at.withColumn("_next", F.lead("rct_at").over(w)).filter((F.col("soc_at") >= low) & (F.col("soc_at") < high))
    bands = bands.select(*SESSION, F.col("soc_at").alias("soc_lo"), F.greatest(F.lit(0.0), F.col("rct_at") - F.col("_next")).alias("minutes"))
    amps = rows.groupBy(*SESSION, (F.floor(F.col("soc") / step) * step).cast("int").alias("soc_lo")).agg(
        F.median(F.abs("current_master")).alias("median_master"), F.median(F.abs("current_slave")).alias("median_slave")
    )
    out = bands.join(amps, [*SESSION, "soc_lo"], "left")
    label = lambda c: bucket_label(current_bucket(F.col(c), beyond="last"))
    return out.withColumns({"master_label": label("median_master"), "slave_label": label("median_slave")})


def fleet_band_average(bands: DataFrame) -> DataFrame:
    """Mean minutes of each band over sessions, and the sum of these means."""
    mean = bands.groupBy("soc_lo").agg(F.avg("minutes").alias("avg_minutes"))
    return mean.crossJoin(F.broadcast(mean.agg(F.sum("avg_minutes").alias("total_minutes"))))


def total_time_between(rows: DataFrame, low: int = 20, high: int = 80) -> DataFrame:
    """Mean over sessions of the predicted minutes from one charge to another."""
    at = rct_at_soc(rows).filter(F.col("soc_at").isin(low, high))
    of = lambda p: F.max(F.when(F.col("soc_at") == p, F.col("rct_at")))
    per = at.groupBy(*SESSION).agg(F.greatest(F.lit(0.0), of(low) - of(high)).alias("minutes"))
    return per.agg(F.avg("minutes").alias("avg_total_minutes"), F.count(F.lit(1)).alias("n_sessions"))


def session_span_total(rows: DataFrame) -> DataFrame:
    """Each session's predicted minutes over its own range of charge."""
    rows = rows.filter("soc is not null and monotone is not null")
    mono = rows.withColumn("_s", F.max("soc").over(_w().rowsBetween(Window.unboundedPreceding, 0)))
    first = F.max_by("monotone", F.struct(-F.col("_s"), "elapsed_min"))
    last = F.max_by("monotone", F.struct("_s", "elapsed_min"))
    return mono.groupBy(*SESSION).agg(F.min("soc").alias("soc_low"), F.max("soc").alias("soc_high"), F.greatest(F.lit(0.0), first - last).alias("total_minutes"))


SQL = """
predicted AS (SELECT *, rct_minutes * 0.97 + (vehicle_id * 7 + CAST(elapsed_min AS BIGINT) * 3) % 11 - 4 AS predicted_rct FROM rct),
smoothed AS (SELECT * EXCLUDE (a, b), (SELECT median(x) FROM unnest([a, predicted_rct, b]) t(x)) AS smooth FROM (SELECT *, lag(predicted_rct) OVER w AS a, lead(predicted_rct) OVER w AS b FROM predicted WINDOW w AS (PARTITION BY vehicle_id, yyyymm, session_id ORDER BY elapsed_min))),
prepared AS (SELECT *, min(greatest(smooth, 0)) OVER (PARTITION BY vehicle_id, yyyymm, session_id ORDER BY elapsed_min) AS monotone FROM smoothed),
pmono AS (SELECT *, max(soc) OVER (PARTITION BY vehicle_id, yyyymm, session_id ORDER BY elapsed_min) AS s FROM prepared WHERE soc IS NOT NULL),
knots AS (SELECT *, lag(s) OVER w AS s0, lag(y) OVER w AS y0, lead(s) OVER w IS NULL AS islast FROM (SELECT vehicle_id, yyyymm, session_id, s, arg_max(monotone, elapsed_min) AS y FROM pmono GROUP BY ALL) WINDOW w AS (PARTITION BY vehicle_id, yyyymm, session_id ORDER BY s)),
rctat AS (SELECT vehicle_id, yyyymm, session_id, p.x::INT AS soc_at, CASE WHEN s0 IS NULL OR p.x >= s THEN y ELSE y0 + (y - y0) * (p.x - s0) / (s - s0) END AS rct_at
  FROM knots JOIN range(0, 101, 5) p(x) ON (s0 IS NULL OR p.x > s0) AND (islast OR p.x <= s)),
ranges AS (SELECT vehicle_id, yyyymm, session_id, min(soc) AS soc_min, max(soc) AS soc_max, max(soc) - min(soc) AS soc_span FROM prepared GROUP BY ALL),
coverage AS (SELECT x::INT AS soc_lo, count(*) AS n_sessions FROM ranges JOIN range(0, 100, 5) t(x) ON soc_min <= x AND soc_max >= x + 5 GROUP BY ALL),
runs AS (SELECT min(soc_lo) AS lo, max(soc_lo) + 5 AS hi FROM (SELECT *, soc_lo // 5 - row_number() OVER (ORDER BY soc_lo) AS i FROM coverage) GROUP BY i),
bestwindow AS (SELECT CASE WHEN ideal THEN 20 ELSE lo END::INT AS soc_low, CASE WHEN ideal THEN 80 ELSE hi END::INT AS soc_high FROM (SELECT coalesce(bool_or(soc_min <= 20 AND soc_max >= 80), false) AS ideal FROM ranges) LEFT JOIN (SELECT lo, hi FROM runs ORDER BY hi - lo DESC, lo LIMIT 1) ON true),
bandmin AS (SELECT vehicle_id, yyyymm, session_id, soc_at AS soc_lo, greatest(0, rct_at - nx) AS minutes FROM (SELECT *, lead(rct_at) OVER (PARTITION BY vehicle_id, yyyymm, session_id ORDER BY soc_at) AS nx FROM rctat) WHERE soc_at >= 20 AND soc_at < 80),
bandamps AS (SELECT vehicle_id, yyyymm, session_id, (floor(soc / 5) * 5)::INT AS soc_lo, median(abs(current_master)) AS median_master, median(abs(current_slave)) AS median_slave FROM prepared GROUP BY ALL)"""
