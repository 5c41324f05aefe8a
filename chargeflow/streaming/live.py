"""Curation and sessions of live telemetry, by the rules of the batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import DEFAULTS, LAST_FIELDS, MEAN_FIELDS, Settings


def event_time(rows: DataFrame, delay: str) -> DataFrame:
    """Adds ``ts``, the wall clock as an instant with a watermark; where there is one already, it stays."""
    # A watermark needs an instant: the wall clock counts as UTC, in which no hour is missing.
    if rows.sparkSession.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z", "GMT"):
        raise ValueError("set spark.sql.session.timeZone to UTC: the wall clock of live rows counts as such")
    if "ts" in rows.columns:
        return rows
    return rows.withColumn("ts", F.col("ts_local").cast("timestamp")).withWatermark("ts", delay)


def stream_curate_minute(aligned: DataFrame, delay: str = "2 minutes", lag_s: float = 0.0) -> DataFrame:
    """The minute rows of the batch curation, each once its minute is older than
    the watermark; later samples are dropped. State: one row per open minute.
    ``lag_s``: by how much the rows' ``ts`` is behind their time, as it is by the
    tolerance behind ``stream_align``."""
    rows = event_time(aligned, delay)
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ts"))).alias(c) for c in LAST_FIELDS if c in aligned.columns]
    mean = [F.avg(c).alias(c) for c in MEAN_FIELDS if c in aligned.columns]
    out = rows.groupBy("vehicle_id", F.window("ts", "1 minute", startTime=f"{round(lag_s * 1000)} milliseconds").alias("w")).agg(*last, *mean)
    begin = F.col("w.start").cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(lag_s).cast("decimal(18,6)"))
    return out.withColumn("minute", begin).withColumn("yyyymm", F.date_format("minute", "yyyy-MM")).drop("w")


def stream_sessions(charging: DataFrame, settings: Settings = DEFAULTS, delay: str = "2 minutes") -> DataFrame:
    """Begin, end and number of rows of each vehicle's runs of charging rows with
    no gap above ``session_gap_min``, each once no row can join it any more."""
    rows = event_time(charging, delay)
    gap = F.session_window("ts", f"{int(settings.session_gap_min * 60)} seconds").alias("w")
    out = rows.groupBy("vehicle_id", gap).agg(F.min("ts").cast("timestamp_ntz").alias("started"), F.max("ts").cast("timestamp_ntz").alias("ended"), F.count(F.lit(1)).alias("n"))
    return out.drop("w")
