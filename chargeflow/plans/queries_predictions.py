"""Queries over training sets, scores and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import dataset as D
from ..operators import evaluate as E
from ..operators import postprocess as P
from ..settings import FEATURES, LABEL, SESSION
from .queries_core import RCT, Query, S, r, rct, rounded, samples, sql


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """Labelled rows with a prediction that is off by a rule, so that SQL can follow."""
    off = (F.col("vehicle_id") * 7 + F.col("elapsed_min").cast("long") * 3) % 11 - 4
    return rct(spark, d).withColumn("predicted_rct", F.col("rct_minutes") * 0.97 + off)


def ready(spark: SparkSession, d: str) -> DataFrame:
    return P.prepared(predictions(spark, d))


def keyed(spark: SparkSession, d: str) -> DataFrame:
    return rct(spark, d).withColumn("session_key", F.concat_ws("-", "vehicle_id", C.session_key(F.col("yyyymm"), F.col("session_id"))))


def _messy(spark, d):
    """Labelled rows with outliers, as a raw table would have them."""
    odd = F.col("vehicle_id") % 4 == 0
    return rct(spark, d).withColumns({"voltage": F.when(odd, F.col("voltage") * 1.4).otherwise(F.col("voltage")), LABEL: F.col(LABEL) * 40 - 100})


METRICS = ["rmse", "mae", "mape", "p90", "median_prediction"]
METRICS_SQL = """sqrt(avg(e * e)) AS rmse, avg(e) AS mae, 100 * avg(CASE WHEN rct_minutes >= 1 THEN e / rct_minutes END) AS mape,
  quantile_cont(e, 0.9) AS p90, median(predicted_rct) AS median_prediction, count(*) AS n"""
ERRORS = "errors AS (SELECT *, abs(rct_minutes - predicted_rct) AS e FROM predicted)"


def _split_sql(groups: str, key: str, small: str) -> str:
    return f"""ranked AS (SELECT {groups}, row_number() OVER (ORDER BY md5('42|' || {key})) AS rk, count(*) OVER () AS n FROM (SELECT DISTINCT {groups} FROM keyed)),
sized AS (SELECT *, {small} FROM ranked),
splits AS (SELECT {groups}, CASE WHEN rk <= nt THEN 'test' WHEN rk <= nt + nv THEN 'val' ELSE 'train' END AS split FROM sized)"""


KEYED = "keyed AS (SELECT *, vehicle_id || '-' || yyyymm || '-' || lpad(CAST(session_id AS VARCHAR), 6, '0') AS session_key FROM rct)"
GROUP_SIZES = """CASE WHEN n <= 1 THEN 0 WHEN n = 2 THEN 1 ELSE greatest(1, round_even(0.2 * n, 0)) END AS nt,
  CASE WHEN n <= 2 OR n - greatest(1, round_even(0.2 * n, 0)) < 2 THEN 0 ELSE greatest(1, round_even(0.1 * (n - greatest(1, round_even(0.2 * n, 0))), 0)) END AS nv"""
ROW_SIZES = "greatest(1, round_even(0.2 * n, 0)) AS nt, greatest(1, round_even(0.1 * (n - greatest(1, round_even(0.2 * n, 0))), 0)) AS nv"
PROFILED = [*FEATURES, LABEL]


def _profile_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", count(*) AS n, count({c}) AS n_present, min({c}) AS lo, max({c}) AS hi FROM rct" for c in PROFILED]
    return "profile AS (" + " UNION ALL ".join(parts) + ")"


def _p17(spark, d):
    rows = samples(spark, d).select("seq", F.col("current").cast("string").alias("amps"), "unit")
    return rounded(C.as_numeric(rows))


def _p15(spark, d):
    # The vehicle and the minute as numbers among the features, so that rows can be told apart.
    rows = rct(spark, d).drop("km", "bms_temp").withColumn("minute_number", C.clock(F.col("timestamp_local")) / 60_000_000)
    return rounded(C.align_features(rows, ["vehicle_id", "minute_number", *FEATURES, "absent_feature"], 0.0))


def _l1(spark, d):
    return D.group_split(keyed(spark, d).select("session_key", *SESSION, "timestamp_local"))


def _l2(spark, d):
    rows = keyed(spark, d).select("session_key", "timestamp_local").withColumn("row_key", F.concat_ws("/", "session_key", F.date_format("timestamp_local", "yyyyMMddHHmm")))
    return D.row_split(rows, ["row_key"]).select("row_key", "split")


_metrics = lambda df: rounded(df)

QUERIES: dict[str, tuple[Query, str]] = {
    "p14_soc_sample_weight": (lambda s, d: samples(s, d).select("seq", C.soc_weight(F.col("soc")).alias("weight")), sql("telemetry", "SELECT seq, CASE WHEN soc >= 0 AND soc < 20 THEN 1.5 WHEN soc >= 20 AND soc < 40 THEN 1.2 ELSE 1.0 END::DOUBLE AS weight FROM telemetry")),
    "p15_align_features": (
        _p15,
        sql("rct", f"SELECT vehicle_id::DOUBLE AS vehicle_id, epoch_us(timestamp_local) / 60e6 AS minute_number, {r(*[f for f in FEATURES if f not in ('km', 'bms_temp')])}, 0.0::DOUBLE AS km, 0.0::DOUBLE AS bms_temp, 0.0::DOUBLE AS absent_feature FROM rct"),
    ),
    "p16_drop_forbidden": (
        lambda s, d: rounded(C.drop_forbidden(rct(s, d).withColumn("loss_kwh", F.lit(1.0)).drop("sign", "charging", "dsoc"))),
        sql("rct", f"SELECT {r(*[c for c in RCT if c not in ('speed', 'slave_power_kw')])} FROM rct"),
    ),
    "p17_as_numeric": (_p17, sql("telemetry", "SELECT seq, round(current + 1e-9, 6) + 0.0 AS amps, unit FROM telemetry")),
    "f2_label_and_bounds": (
        lambda s, d: rounded(D.label_and_bounds(_messy(s, d)).select(*SESSION, "timestamp_local", LABEL, "voltage", "current")),
        sql("rct", f"""SELECT {S}, timestamp_local, {r(LABEL, 'voltage', 'current')} FROM (SELECT vehicle_id, yyyymm, session_id, timestamp_local, least(rct_minutes * 40 - 100, 1440) AS rct_minutes,
          CASE WHEN vehicle_id % 4 = 0 THEN voltage * 1.4 ELSE voltage END AS voltage, current FROM rct) WHERE rct_minutes > 0 AND (voltage IS NULL OR voltage BETWEEN 200 AND 900) AND (current IS NULL OR current BETWEEN -500 AND 500)"""),
    ),
    "f3_soc_current_slice": (
        lambda s, d: rounded(C.soc_current_slice(rct(s, d)).select(*SESSION, "timestamp_local", "soc", "current")),
        sql("rct", f"SELECT {S}, timestamp_local, {r('soc', 'current')} FROM rct WHERE soc BETWEEN 20 AND 80 AND abs(current) BETWEEN 10 AND 15"),
    ),
    "a11_column_profile": (
        lambda s, d: rounded(D.column_profile(rct(s, d).select(*PROFILED))),
        sql("rct", "SELECT \"column\", n, n_present, round(1 - n_present / n + 1e-9, 6) + 0.0 AS missing_share, coalesce(lo = hi, true) AS constant, \"column\" = 'rct_minutes' OR (n_present > 0 AND NOT coalesce(lo = hi, true) AND 1 - n_present / n < 0.98) AS kept FROM profile", _profile_sql()),
    ),
    "l1_group_split": (_l1, sql("rct", f"SELECT session_key, {S}, timestamp_local, split FROM keyed JOIN splits USING (session_key)", KEYED, _split_sql("session_key", "session_key", GROUP_SIZES))),
    "l2_row_split": (
        _l2,
        sql("rct", "SELECT row_key, split FROM splits", "keyed AS (SELECT vehicle_id || '-' || yyyymm || '-' || lpad(CAST(session_id AS VARCHAR), 6, '0') || '/' || strftime(timestamp_local, '%Y%m%d%H%M') AS row_key FROM rct)", _split_sql("row_key", "row_key", ROW_SIZES)),
    ),
    "a12_regression_metrics": (
        lambda s, d: _metrics(E.regression_metrics(predictions(s, d), None, "rct_minutes", "predicted_rct")),
        sql("rct", f"SELECT {r(*METRICS)}, n FROM (SELECT {METRICS_SQL} FROM errors)", P.SQL, ERRORS),
    ),
    "a13_metrics_by_soc_band": (
        lambda s, d: _metrics(E.metrics_by_soc_band(predictions(s, d), "rct_minutes", "predicted_rct")),
        sql("rct", f"SELECT soc_lo, {r(*METRICS)}, n FROM (SELECT CASE WHEN soc <= 20 THEN 0 WHEN soc <= 40 THEN 20 WHEN soc <= 60 THEN 40 WHEN soc <= 80 THEN 60 ELSE 80 END AS soc_lo, {METRICS_SQL} FROM errors WHERE soc >= 0 AND soc <= 100 GROUP BY 1)", P.SQL, ERRORS),
    ),
    "a14_metrics_by_current_decile": (
        lambda s, d: _metrics(E.metrics_by_current_decile(predictions(s, d), "rct_minutes", "predicted_rct")),
        sql("rct", f"""SELECT decile, {r('amps_lo', 'amps_hi', *METRICS)}, n FROM (SELECT decile, edges[decile] AS amps_lo, edges[decile + 1] AS amps_hi, {METRICS_SQL} FROM (
            SELECT *, greatest(1, len(list_filter(edges, lambda q: q < abs(current))))::INT AS decile FROM errors CROSS JOIN (SELECT list_sort(list_distinct(quantile_cont(abs(current), [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS edges FROM errors) WHERE current IS NOT NULL) GROUP BY decile, edges)""", P.SQL, ERRORS),
    ),
    "a15_quality_report": (
        lambda s, d: rounded(E.quality_report(rct(s, d), SESSION)),
        sql("rct", """SELECT count(*)::BIGINT AS n_rows, count(*) FILTER (soc < 0 OR soc > 100)::BIGINT AS soc_out_of_range, round(100 * count(*) FILTER (current < 0) / count(*) + 1e-9, 6) + 0.0 AS percent_negative_current,
          count(*) FILTER (soc IS NULL) AS null_soc, count(*) FILTER (current IS NULL) AS null_current, count(*) FILTER (elapsed_min IS NULL) AS null_elapsed, count(*) FILTER (st = 0) AS repeated_times, count(*) FILTER (round(st, 3) = 1) AS steps_of_a_minute, count(st) AS steps,
          round(max(round(st, 3)) + 1e-9, 6) + 0.0 AS longest_step, count(DISTINCT CASE WHEN round(st, 3) <> 1 THEN vehicle_id || '/' || yyyymm || '/' || session_id END) AS sessions_with_other_steps
          FROM (SELECT *, elapsed_min - lag(elapsed_min) OVER (PARTITION BY vehicle_id, yyyymm, session_id ORDER BY elapsed_min) AS st FROM rct)"""),
    ),
    "a16_session_soc_ranges": (lambda s, d: rounded(P.session_soc_ranges(ready(s, d))), sql("rct", f"SELECT {S}, {r('soc_min', 'soc_max', 'soc_span')} FROM ranges", P.SQL)),
    "a17_avg_prediction_by_band": (
        lambda s, d: rounded(E.avg_prediction_by_band(predictions(s, d), "predicted_rct")),
        sql("rct", """SELECT lo::INT AS soc_lo, round(avg(predicted_rct) + 1e-9, 6) + 0.0 AS mean_prediction, round((SELECT sum(predicted_rct) FROM predicted WHERE soc BETWEEN 20 AND 80) + 1e-9, 6) + 0.0 AS total_prediction,
          round((SELECT avg(predicted_rct) FILTER (soc BETWEEN 20 AND 25) - avg(predicted_rct) FILTER (soc BETWEEN 75 AND 80) FROM predicted) + 1e-9, 6) + 0.0 AS first_less_last
          FROM predicted JOIN (SELECT unnest(range(20, 80, 5)) AS lo) ON (soc > lo OR (lo = 20 AND soc = 20)) AND soc <= lo + 5 GROUP BY lo""", P.SQL),
    ),
    "w6_smooth_median3": (lambda s, d: rounded(P.smooth_median3(predictions(s, d)).select(*SESSION, "timestamp_local", "smooth")), sql("rct", f"SELECT {S}, timestamp_local, {r('smooth')} FROM smoothed", P.SQL)),
    "w7_monotone_decreasing": (lambda s, d: rounded(ready(s, d).select(*SESSION, "timestamp_local", "monotone")), sql("rct", f"SELECT {S}, timestamp_local, {r('monotone')} FROM prepared", P.SQL)),
    "w8_rct_at_soc": (lambda s, d: rounded(P.rct_at_soc(ready(s, d))), sql("rct", f"SELECT {S}, soc_at, {r('rct_at')} FROM rctat", P.SQL)),
    "w9_minutes_per_band": (
        lambda s, d: rounded(P.minutes_per_band(ready(s, d))),
        sql("rct", f"""SELECT {S}, soc_lo, {r('minutes', 'median_master', 'median_slave')}, L[CASE WHEN median_master >= 200 THEN 8 WHEN median_master >= 80 THEN 7 WHEN median_master >= 40 THEN 6 WHEN median_master >= 20 THEN 5 WHEN median_master >= 10 THEN 4 WHEN median_master >= 5 THEN 3 WHEN median_master >= 1 THEN 2 WHEN median_master >= 0 THEN 1 END] AS master_label,
          L[CASE WHEN median_slave >= 200 THEN 8 WHEN median_slave >= 80 THEN 7 WHEN median_slave >= 40 THEN 6 WHEN median_slave >= 20 THEN 5 WHEN median_slave >= 10 THEN 4 WHEN median_slave >= 5 THEN 3 WHEN median_slave >= 1 THEN 2 WHEN median_slave >= 0 THEN 1 END] AS slave_label
          FROM bandmin LEFT JOIN bandamps USING (vehicle_id, yyyymm, session_id, soc_lo) CROSS JOIN (SELECT ['0–1 A','1–5 A','5–10 A','10–20 A','20–40 A','40–80 A','80–200 A','200+ A'] AS L)""", P.SQL),
    ),
    "j2_band_coverage": (lambda s, d: P.band_coverage(P.session_soc_ranges(ready(s, d))), sql("rct", "SELECT soc_lo, n_sessions FROM coverage", P.SQL)),
    "w13_best_soc_window": (lambda s, d: P.best_soc_window(P.session_soc_ranges(ready(s, d))), sql("rct", "SELECT soc_low, soc_high FROM bestwindow", P.SQL)),
    "j3_chosen_sessions": (
        lambda s, d: rounded(P.chosen_sessions(ready(s, d), P.best_soc_window(P.session_soc_ranges(ready(s, d)))).select(*SESSION, "timestamp_local", "soc")),
        sql("rct", f"SELECT {S}, timestamp_local, {r('soc')} FROM prepared JOIN ranges USING (vehicle_id, yyyymm, session_id) CROSS JOIN bestwindow WHERE soc_min <= soc_low AND soc_max >= soc_high", P.SQL),
    ),
    "a9_fleet_band_average": (
        lambda s, d: rounded(P.fleet_band_average(P.minutes_per_band(ready(s, d)))),
        sql("rct", "SELECT soc_lo, round(a + 1e-9, 6) + 0.0 AS avg_minutes, round(sum(a) OVER () + 1e-9, 6) + 0.0 AS total_minutes FROM (SELECT soc_lo, avg(minutes) AS a FROM bandmin GROUP BY 1)", P.SQL),
    ),
    "a10_total_time_between": (
        lambda s, d: rounded(P.total_time_between(ready(s, d))),
        sql("rct", "SELECT round(avg(greatest(0, a - b)) + 1e-9, 6) + 0.0 AS avg_total_minutes, count(*) AS n_sessions FROM (SELECT vehicle_id, yyyymm, session_id, max(rct_at) FILTER (soc_at = 20) AS a, max(rct_at) FILTER (soc_at = 80) AS b FROM rctat GROUP BY ALL)", P.SQL),
    ),
    "a19_session_span_total": (
        lambda s, d: rounded(P.session_span_total(ready(s, d))),
        sql("rct", f"SELECT {S}, round(lo + 1e-9, 6) + 0.0 AS soc_low, round(hi + 1e-9, 6) + 0.0 AS soc_high, round(greatest(0, y1 - y2) + 1e-9, 6) + 0.0 AS total_minutes FROM (SELECT vehicle_id, yyyymm, session_id, arg_min(y, s) AS y1, arg_max(y, s) AS y2 FROM knots GROUP BY ALL) JOIN (SELECT vehicle_id, yyyymm, session_id, min(soc) AS lo, max(soc) AS hi FROM pmono GROUP BY ALL) USING (vehicle_id, yyyymm, session_id)", P.SQL),
    ),
}
