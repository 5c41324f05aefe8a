"""Queries over bands of charge: prevailing currents, lookups, estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import range_labels
from ..operators import soc_bands as B
from ..operators import soc_bins as M
from ..settings import SESSION
from ..storage import written
from .queries_core import Query, S, gated, r, rct, rounded, sql

BIN_FIGURES = ["minutes_total", "mode_minutes", "confidence", "median_abs_current", "mean_abs_current"]


def rows(spark: SparkSession, d: str) -> DataFrame:
    return B.minutes_in_session(B.charging_rows(rct(spark, d)))


def stats(spark: SparkSession, d: str) -> DataFrame:
    return B.interval_samples(rct(spark, d))


def pivot(spark: SparkSession, d: str) -> DataFrame:
    return B.interval_pivot(stats(spark, d))


def estimator_requests(spark: SparkSession, d: str) -> DataFrame:
    """A request for each labelled minute."""
    own = rct(spark, d).filter("soc is not null")
    name = F.concat_ws("/", F.col("vehicle_id"), "session_id", F.date_format("timestamp_local", "yyyyMMddHHmm"))
    return own.select(name.alias("request_id"), F.col("soc").alias("cur_soc"), (F.col("soc") + 25 - F.col("vehicle_id") % 7 * 5).alias("tgt_soc"), F.when(F.col("vehicle_id") % 5 != 0, F.col("current")).alias("amps"))


def _crossed(pair: tuple[DataFrame, DataFrame]) -> DataFrame:
    return pair[0].crossJoin(F.broadcast(pair[1]))


REQUESTS_SQL = """requests AS (SELECT concat_ws('/', vehicle_id, session_id, strftime(timestamp_local, '%Y%m%d%H%M')) AS request_id, soc AS cur_soc, soc + 25 - vehicle_id % 7 * 5 AS tgt_soc,
  CASE WHEN vehicle_id % 5 <> 0 THEN current END AS amps FROM rct WHERE soc IS NOT NULL)"""


def _j6(spark, d):
    req = estimator_requests(spark, d).select("request_id", F.col("cur_soc").alias("soc_from"), F.col("tgt_soc").alias("soc_to"), "amps")
    return rounded(M.lookup_minutes(req, M.soc_current_lookup(rct(spark, d))))


QUERIES: dict[str, tuple[Query, str]] = {
    "a5_soc_modal_buckets": (
        lambda s, d: rounded(M.soc_modal_buckets(gated(s, d))),
        sql("sessions", f"SELECT {S}, {r('soc_lo', 'soc_hi', *BIN_FIGURES)}, mode_bucket FROM soc_intervals", M.SQL_BINS),
    ),
    "a18_confidence_summary": (
        lambda s, d: rounded(M.confidence_summary(M.soc_modal_buckets(gated(s, d)))),
        sql("sessions", "SELECT round(avg(coalesce(confidence, 0)) + 1e-9, 6) + 0.0 AS mean_confidence, count(*) AS n FROM soc_intervals", M.SQL_BINS),
    ),
    "a8_soc_current_lookup": (
        lambda s, d: rounded(M.soc_current_lookup(rct(s, d))),
        sql("rct", f"SELECT soc_lo, bin, {r('avg_minutes')}, n_sessions FROM lookup", M.SQL_LOOKUP),
    ),
    "j4_complete_grid": (
        lambda s, d: rounded(M.complete_grid(M.soc_current_lookup(rct(s, d)))),
        sql("rct", "SELECT g.soc_lo, g.bin, ['≤1A', '1–5A', '5–10A', '>10A'][g.bin + 1] AS current_bin, round(avg_minutes + 1e-9, 6) + 0.0 AS avg_minutes, coalesce(n_sessions, 0) AS n_sessions FROM (SELECT DISTINCT soc_lo, x::INT AS bin FROM lookup, range(4) t(x)) g LEFT JOIN lookup l ON g.soc_lo = l.soc_lo AND g.bin = l.bin", M.SQL_LOOKUP),
    ),
    "j6_lookup_minutes": (
        _j6,
        sql("rct", """SELECT request_id, round(sum(avg_minutes) + 1e-9, 6) + 0.0 AS minutes FROM (SELECT * FROM requests LEFT JOIN range(0, 200, 10) t(x) ON x >= floor(cur_soc / 10) * 10 AND x <= ceil(tgt_soc / 10) * 10 - 10) q
          LEFT JOIN lookup l ON l.soc_lo = q.x AND l.bin = CASE WHEN abs(amps) <= 1 THEN 0 WHEN abs(amps) <= 5 THEN 1 WHEN abs(amps) <= 10 THEN 2 WHEN amps IS NOT NULL THEN 3 END GROUP BY request_id""", M.SQL_LOOKUP, REQUESTS_SQL),
    ),
    "f4_charging_rows": (
        lambda s, d: rounded(rows(s, d).select(*SESSION, "timestamp_local", "sign", "i_eff", "tmin")),
        sql("rct", f"SELECT {S}, timestamp_local, sign, round(current + 1e-9, 6) + 0.0 AS i_eff, {r('tmin')} FROM crows", B.SQL),
    ),
    "w10_time_at_soc": (lambda s, d: rounded(B.time_at_soc(rows(s, d))), sql("rct", f"SELECT {S}, soc_at, {r('t_at')} FROM attimes", B.SQL)),
    "w11_sliding_soc_bands": (lambda s, d: rounded(B.sliding_soc_bands(rows(s, d))), sql("rct", f"SELECT {S}, soc_start, soc_end, {r('t0', 't1', 'minutes_total')} FROM bands", B.SQL)),
    "w12_band_current_stats": (
        lambda s, d: rounded(stats(s, d).select(*SESSION, "soc_start", "series", "bucket", "confidence", "mean_abs_current", "median_abs_current")),
        sql("rct", f"SELECT {S}, soc_start, series, bucket, {r('confidence', 'mean_abs_current', 'median_abs_current')} FROM stats", B.SQL, B.SQL_STATS),
    ),
    "a6_interval_pivot": (lambda s, d: rounded(pivot(s, d)), sql("rct", f"SELECT soc_start, bucket, {r('mean_minutes')}, n FROM pivot_pack", B.SQL, B.SQL_STATS)),
    "a6_interval_pivots": (
        lambda s, d: rounded(B.interval_pivots(stats(s, d))),
        sql("rct", f"SELECT series, soc_start, bucket, round(avg(minutes_total) + 1e-9, 6) + 0.0 AS mean_minutes, count(*) AS n FROM stats GROUP BY series, soc_start, bucket", B.SQL, B.SQL_STATS),
    ),
    "a6_pivot_wide": (
        lambda s, d: rounded(B.pivot_wide(B.interval_pivots(stats(s, d)))),
        sql("rct", "SELECT series, soc_start, " + ", ".join(f'round(avg(minutes_total) FILTER (bucket = {i}) + 1e-9, 6) + 0.0 AS "{x}"' for i, x in enumerate(range_labels())) + " FROM stats GROUP BY series, soc_start", B.SQL, B.SQL_STATS),
    ),
    "a7_estimator_params": (
        lambda s, d: rounded(_crossed(B.estimator_params(written(pivot(s, d))))),
        sql("rct", f"SELECT soc_start, {r('band_minutes', 'minutes_per_percent')} FROM band_means CROSS JOIN per_percent", B.SQL, B.SQL_STATS),
    ),
    "j5_estimate_remaining_time": (
        lambda s, d: rounded(B.estimate_remaining_time(estimator_requests(s, d), pivot(s, d))),
        sql("rct", """SELECT request_id, round(sum(CASE WHEN x IS NULL THEN 0 ELSE coalesce(mean_minutes, band_minutes, minutes_per_percent * 5) END) + 1e-9, 6) + 0.0 AS minutes FROM (
            SELECT r.*, x, (SELECT arg_min(bucket, abs(mid - abs(r.amps)) + bucket * 1e-9) FROM (SELECT DISTINCT p.bucket, [0.5, 3, 7.5, 15, 30, 60, 140, 201][p.bucket + 1] AS mid FROM pivot_pack p)) AS nb FROM requests r
            LEFT JOIN range(0, 200, 5) t(x) ON tgt_soc > cur_soc AND x >= floor(cur_soc / 5) * 5 AND x <= floor(tgt_soc / 5) * 5 - 5) q
          LEFT JOIN pivot_pack p ON p.soc_start = q.x AND p.bucket = CASE WHEN q.amps IS NOT NULL THEN q.nb END LEFT JOIN band_means b ON b.soc_start = q.x CROSS JOIN per_percent GROUP BY request_id""", B.SQL, B.SQL_STATS, REQUESTS_SQL),
    ),
}
