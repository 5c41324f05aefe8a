"""The driver's ``events`` table read as battery telemetry of two units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import clock, wall


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sample: vehicle, month, unit and the ten measured values."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    e = clock(F.col("ts")) - 1704067200000000
    k = F.get_json_object("props", "$.k").cast("int")
    rows = events.select(F.col("user_id").alias("vehicle_id"), F.col("event_id").alias("seq"), "event_type", "value", e.alias("e"), k.alias("k"))
    e, k = F.col("e"), F.col("k")
    day = 86_400_000_000
    ts = wall(1704067200000000 + F.floor(e / 400))
    ramp = 150 + F.expr(f"(700 * (e % {10 * day})) div {10 * day}") - F.when(k % 13 == 0, 15).otherwise(0)
    sign = F.when(F.col("vehicle_id") % 3 == 0, 1).otherwise(-1) * F.when(F.expr(f"(e div {day}) % 7 = 6"), -1).otherwise(1)
    return rows.select(
        "vehicle_id",
        F.date_format(ts, "yyyy-MM").alias("yyyymm"),
        "seq",
        F.when(F.col("event_type").isin("click", "view", "purchase"), "master").otherwise("slave").alias("unit"),
        ts.alias("ts_local"),
        F.when(k != 50, ramp / 10.0).alias("soc"),
        F.when(k < 3, 250.0).otherwise(640.0 + k).alias("voltage"),
        (sign * F.col("value")).alias("current"),
        F.when(k % 10 == 7, 12.0).when(k % 10 == 3, None).otherwise(0.0).alias("speed"),
        F.when(k % 4 != 0, 25 + k / 10.0).alias("cell_temp"),
        (27 + k / 20.0).alias("bms_temp"),
        (k / 1000.0).alias("pack_delta"),
        (100.0 + k).alias("charge_limit"),
        (200.0 - k).alias("discharge_limit"),
        F.when(k == 99, -1.0).otherwise(1000.0 * F.col("vehicle_id") + F.expr("e div 3600000000") - F.when(k % 17 == 0, 5).otherwise(0)).alias("km"),
    )


#: The same in DuckDB.
SQL = """
raw AS (SELECT user_id AS vehicle_id, event_id AS seq, event_type, value, epoch_us(ts) - 1704067200000000 AS e, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
telemetry AS (
  SELECT vehicle_id, strftime(make_timestamp(1704067200000000 + e // 400), '%Y-%m') AS yyyymm, seq,
    CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'master' ELSE 'slave' END AS unit,
    make_timestamp(1704067200000000 + e // 400) AS ts_local,
    CASE WHEN k <> 50 THEN (150 + (700 * (e % 864000000000)) // 864000000000 - CASE WHEN k % 13 = 0 THEN 15 ELSE 0 END) / 10.0 END::DOUBLE AS soc,
    CASE WHEN k < 3 THEN 250.0 ELSE 640.0 + k END::DOUBLE AS voltage,
    (CASE WHEN vehicle_id % 3 = 0 THEN 1 ELSE -1 END * CASE WHEN (e // 86400000000) % 7 = 6 THEN -1 ELSE 1 END * value)::DOUBLE AS current,
    CASE WHEN k % 10 = 7 THEN 12.0 WHEN k % 10 = 3 THEN NULL ELSE 0.0 END::DOUBLE AS speed,
    CASE WHEN k % 4 <> 0 THEN 25 + k / 10.0 END::DOUBLE AS cell_temp, (27 + k / 20.0)::DOUBLE AS bms_temp, (k / 1000.0)::DOUBLE AS pack_delta,
    (100.0 + k)::DOUBLE AS charge_limit, (200.0 - k)::DOUBLE AS discharge_limit,
    CASE WHEN k = 99 THEN -1.0 ELSE 1000.0 * vehicle_id + e // 3600000000 - CASE WHEN k % 17 = 0 THEN 5 ELSE 0 END END::DOUBLE AS km
  FROM raw)"""
