"""Labelled minutes: rates, time since the start and to the end of a session."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import seconds_between
from ..settings import SESSION


def rate_features(minutes: DataFrame) -> DataFrame:
    """Adds the changes of charge and temperature a minute since the session's row
    before (cell temperature, else that of the management system)."""
    w = Window.partitionBy(*SESSION).orderBy("minute")
    dt = seconds_between(F.col("minute"), F.lag("minute").over(w)) / 60
    dt = F.when(dt == 0, 1.0).otherwise(dt)
    temp = F.coalesce("cell_temp", "bms_temp")
    return minutes.withColumns(
        {
            "soc_rate_per_min": (F.col("soc") - F.lag("soc").over(w)) / dt,
            "temp_rise_rate": (temp - F.lag(temp).over(w)) / dt,
        }
    )


def rct_rows(minutes: DataFrame) -> DataFrame:
    """Session minutes with ``rct_minutes``, the minutes left in the session, where
    any are left; ``elapsed_min``, the slave's power and the charge missing to full."""
    whole = Window.partitionBy(*SESSION)
    rows = rate_features(minutes.filter("session_id is not null"))
    rows = rows.withColumns(
        {
            "elapsed_min": seconds_between(F.col("minute"), F.min("minute").over(whole)) / 60,
            "rct_minutes": seconds_between(F.max("minute").over(whole), F.col("minute")) / 60,
            "slave_power_kw": F.col("voltage_slave") * F.col("current_slave") / 1000,
            "soc_delta_to_full": 100 - F.col("soc"),
        }
    )
    return rows.filter("rct_minutes > 0").withColumnRenamed("minute", "timestamp_local")


def dedupe_keep_first(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row by ``order`` of each combination of ``keys``."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def ordered_output(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in the order of ``keys`` over all partitions, for writing: ranges are
    dealt to partitions and each is sorted; nothing is sorted in one task."""
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


SQL = """
rates AS (
  SELECT *, CASE WHEN dtm = 0 THEN 1 ELSE dtm END AS dt1, coalesce(cell_temp, bms_temp) AS temp FROM (
    SELECT *, (epoch_us(minute) - epoch_us(lag(minute) OVER (PARTITION BY vehicle_id, yyyymm, session_id ORDER BY minute))) / 60e6 AS dtm FROM gated)),
rct0 AS (
  SELECT *, (soc - lag(soc) OVER w) / dt1 AS soc_rate_per_min, (temp - lag(temp) OVER w) / dt1 AS temp_rise_rate,
    (epoch_us(minute) - epoch_us(min(minute) OVER v)) / 60e6 AS elapsed_min, (epoch_us(max(minute) OVER v) - epoch_us(minute)) / 60e6 AS rct_minutes,
    voltage_slave * current_slave / 1000 AS slave_power_kw, 100 - soc AS soc_delta_to_full
  FROM rates WINDOW w AS (PARTITION BY vehicle_id, yyyymm, session_id ORDER BY minute), v AS (PARTITION BY vehicle_id, yyyymm, session_id)),
rct AS (SELECT * RENAME (minute AS timestamp_local) FROM rct0 WHERE rct_minutes > 0)"""
