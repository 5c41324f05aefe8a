"""Queries over months: monthly tables, sessions over month ends, live alignment, errors by slice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import sketches as S
from ..operators import borders, evaluate
from ..settings import DEFAULTS, KEYS
from ..sources import unit_files as U
from ..storage import scratch, written
from ..streaming import live, live_align
from .queries_core import ALIGNED, K, RCT, Query, curated, r, rct, rounded, samples, sql
from .queries_io import DESCRIBED, streamed
from .queries_predictions import ERRORS, P, keyed, predictions, ready

#: The given rows are of one month: stretches of half an hour stand for months.
STRETCH = 30


def moved(spark: SparkSession, d: str) -> DataFrame:
    """Curated minutes whose month is their stretch."""
    since = F.floor(C.seconds_between(F.col("minute"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")) / 60).cast("long")
    month = F.concat(F.lit("2024-"), F.lpad((F.floor(since / STRETCH) + 1).cast("string"), 2, "0"))
    return curated(spark, d).withColumn("yyyymm", month)


MOVED = f"moved AS (SELECT * REPLACE ('2024-' || lpad(CAST(1 + date_diff('minute', TIMESTAMP '2024-01-01', minute) // {STRETCH} AS VARCHAR), 2, '0') AS yyyymm) FROM curated)"


def appended(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(minutes, pieces) of months that were appended one by one."""
    path = scratch(spark, "months")
    rows = written(moved(spark, d))
    after = None
    for (month,) in sorted(map(tuple, rows.select("yyyymm").distinct().collect())):
        borders.append_month(rows, path, month, after)
        after = month
    return spark.read.parquet(f"{path}/minutes"), spark.read.parquet(f"{path}/pieces")


def _w2(spark, d):
    return appended(spark, d)[0].filter("charging").select("vehicle_id", "minute", "session_id")


def _quality(spark, d):
    found = borders.merged_quality(appended(spark, d)[1])
    return rounded(found.select("vehicle_id", "session_id", "n_minutes", "started", "ended", *QUALITY, F.array_join("reasons", ",").alias("reasons")))


QUALITY = ["duration_min", "delta_soc", "idle_frac", "median_abs_current", "energy_master_kwh", "energy_slave_kwh", "total_energy_kwh", "mean_pack_kw"]
LABELS = ["soc_rate_per_min", "temp_rise_rate", "elapsed_min", "rct_minutes", "slave_power_kw", "soc_delta_to_full"]


def _w5(spark, d):
    minutes, pieces = appended(spark, d)
    rows = borders.rct_across(minutes, borders.merged_quality(pieces))
    return rounded(rows.select("vehicle_id", "session_id", "timestamp_local", *RCT))


def _s5(spark, d):
    """Months written at once, then one of them again with other values, then read together."""
    path = scratch(spark, "monthly")
    rows = moved(spark, d).select(*KEYS, "minute", "soc", "current")
    U.write_monthly(rows, path)
    again = rows.filter("yyyymm = '2024-02'").withColumn("soc", F.col("soc") + 1)
    for _ in range(2):
        U.write_monthly(again, path, months=["2024-02"])
    U.write_monthly(again, path, months=["2024-03"])  # which has no rows
    return rounded(U.consolidate_curated(spark, path).select(*KEYS, "minute", "soc", "current"))


def _live(spark, d):
    rows = samples(spark, d)
    return rounded(streamed(rows, lambda s: live_align.stream_align(s).drop("ts"), live_align.STATE_STORE).select(*KEYS, "ts_local", *ALIGNED))


def _live_minutes(spark, d):
    rows = samples(spark, d)
    return rounded(streamed(rows, lambda s: live.stream_curate_minute(live_align.stream_align(s), lag_s=DEFAULTS.tolerance_s), live_align.STATE_STORE).select(*KEYS, "minute", *ALIGNED))


def _bundle(spark, d):
    rows = keyed(spark, d).withColumn("predicted_rct", F.col("rct_minutes") * 0.97 + (F.col("vehicle_id") * 7 + F.col("elapsed_min").cast("long") * 3) % 11 - 4)
    rows = rows.withColumn("split", F.when(F.col("vehicle_id") % 5 == 0, "test").when(F.col("vehicle_id") % 5 == 1, "val").otherwise("train"))
    return rounded(evaluate.metrics_bundle(rows, "rct_minutes", "predicted_rct"))


_SUMS = "sqrt(avg(e * e)) AS rmse, avg(e) AS mae, 100 * avg(e / rct_minutes) FILTER (rct_minutes >= 1) AS mape, count(*) AS n"
BUNDLE = f"""
named AS (SELECT *, CASE vehicle_id % 5 WHEN 0 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END AS split FROM errors),
cut AS (SELECT split AS s, list_sort(list_distinct(quantile_cont(abs(current), [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS edges FROM named GROUP BY split),
bins AS (SELECT lo, lo + 20 AS hi FROM (SELECT unnest([0, 20, 40, 60, 80]) AS lo)),
slices AS (
  SELECT split, 'all' AS slice_type, 'all' AS slice, NULL::DOUBLE AS slice_lo, NULL::DOUBLE AS slice_hi, {_SUMS} FROM named GROUP BY split
  UNION ALL SELECT split, 'soc_band', lo || '-' || hi, lo::DOUBLE, hi::DOUBLE, {_SUMS} FROM named JOIN bins ON (soc > lo OR (lo = 0 AND soc = 0)) AND soc <= hi GROUP BY split, lo, hi
  UNION ALL SELECT split, 'current_decile', i::VARCHAR, edges[i], edges[i + 1], {_SUMS} FROM named JOIN cut ON split = s JOIN (SELECT unnest(range(1, 11)) AS i) ON i < len(edges) AND (abs(current) > edges[i] OR (i = 1 AND abs(current) = edges[1])) AND abs(current) <= edges[i + 1] GROUP BY split, i, edges)"""
_UPTO = "(SELECT date_trunc('millisecond', max(ts_local)) - INTERVAL 2 MINUTE FROM telemetry)"

def _by_month(spark, d):
    """Metrics of all months from what each has left; quantiles are tested apart."""
    rows = predictions(spark, d).withColumn("yyyymm", F.concat(F.lit("m"), (F.col("vehicle_id") % 4).cast("string")))
    months = written(evaluate.month_metrics(rows, "rct_minutes", "predicted_rct"))
    return rounded(evaluate.metrics_of_months(months).select("rmse", "mae", "mape", "n"))


def _described(spark, d):
    rows = P.session_soc_ranges(ready(spark, d)).withColumn("month", F.col("vehicle_id") % 4)
    columns = ["soc_min", "soc_max", "soc_span"]
    months = S.month_sketches(rows, {c: F.col(c) for c in columns}, ["month"])
    return rounded(S.described(months, columns).select("column", "n", "mean", "std", "lowest", "highest"))


QUERIES: dict[str, tuple[Query, str]] = {
    "s5_write_monthly": (
        _s5,
        sql("curated", f"SELECT {K}, minute, round(CASE WHEN yyyymm = '2024-02' THEN soc + 1 ELSE soc END + 1e-9, 6) + 0.0 AS soc, {r('current')} FROM moved WHERE yyyymm <> '2024-03'", MOVED),
    ),
    "w2_across_months": (_w2, sql("curated", "SELECT vehicle_id, minute, session_id FROM xsess", MOVED, borders.SQL)),
    "w2_windows_by_vehicle": (
        lambda s, d: borders.across_months(moved(s, d)).filter("charging").select("vehicle_id", "minute", "session_id"),
        sql("curated", "SELECT vehicle_id, minute, session_id FROM xsess", MOVED, borders.SQL),
    ),
    "a4_across_months": (
        _quality,
        sql("curated", f"""SELECT vehicle_id, session_id, n_minutes, started, ended, {r(*QUALITY)}, array_to_string(list_filter([CASE WHEN duration_min < 4 THEN 'duration' END, CASE WHEN delta_soc < 0.2 THEN 'delta_soc' END,
          CASE WHEN idle_frac < 0.8 THEN 'idle_frac' END, CASE WHEN median_abs_current < 5 THEN 'median_current' END, CASE WHEN total_energy_kwh < 0.1 THEN 'min_energy' END], lambda x: x IS NOT NULL), ',') AS reasons FROM xq""", MOVED, borders.SQL),
    ),
    "w5_across_months": (
        _w5,
        sql("curated", f"""SELECT vehicle_id, session_id, timestamp_local, {r(*RCT)} FROM (SELECT *, minute AS timestamp_local, (soc - soc0) / (us / 60e6) AS soc_rate_per_min, (temp - temp0) / (us / 60e6) AS temp_rise_rate,
          (epoch_us(minute) - epoch_us(started)) / 60e6 AS elapsed_min, (epoch_us(ended) - epoch_us(minute)) / 60e6 AS rct_minutes, voltage_slave * current_slave / 1000 AS slave_power_kw, 100 - soc AS soc_delta_to_full FROM xlag) WHERE rct_minutes > 0""", MOVED, borders.SQL),
    ),
    "j1_live_align": (_live, sql("aligned", f"SELECT {K}, ts_local, {r(*ALIGNED)} FROM aligned WHERE ts_local + INTERVAL 15 SECOND <= {_UPTO}")),
    "r1_live_minutes": (
        _live_minutes,
        sql("curated", f"SELECT {K}, minute, {r(*[c for c in ALIGNED if c != 'km'])}, round(km0 + 1e-9, 6) + 0.0 AS km FROM minutes WHERE minute + INTERVAL 75 SECOND <= {_UPTO}"),
    ),
    "a12_metrics_of_months": (_by_month, sql("rct", f"SELECT {r('rmse', 'mae', 'mape')}, n FROM (SELECT {_SUMS} FROM errors)", P.SQL, ERRORS)),
    "a14_deciles_of_months": (
        lambda s, d: rounded(evaluate.deciles_of_months(evaluate.month_metrics(predictions(s, d), "rct_minutes", "predicted_rct"))),
        "",
    ),
    "a16_described_by_month": (
        _described,
        sql("rct", f'SELECT "column", n, {r("mean", "std", "lowest", "highest")} FROM (' + " UNION ALL ".join(DESCRIBED.format(c=c, t="ranges") for c in ("soc_min", "soc_max", "soc_span")) + ")", P.SQL),
    ),
    "a12_metrics_bundle": (_bundle, sql("rct", f"SELECT split, slice_type, slice, {r('slice_lo', 'slice_hi', 'rmse', 'mae', 'mape')}, n FROM slices", P.SQL, ERRORS, BUNDLE)),
}
