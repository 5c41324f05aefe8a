"""From aligned samples to one row a minute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..settings import DEFAULTS, KEYS, LAST_FIELDS, MEAN_FIELDS, Settings


def minute_of(ts: str = "ts_local"):
    """The wall clock cut to its minute, whatever the session's time zone."""
    return F.col(ts) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.extract(F.lit("SECOND"), F.col(ts)))


def curate_minute(aligned: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """A row per vehicle, month and minute: the last known charge and odometer,
    the mean of everything else. Minutes without samples have no row. Rows that
    are dealt out by further ``keys``, of which a minute has one, stay where they are."""
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ts_local"))).alias(c) for c in LAST_FIELDS]
    mean = [F.avg(c).alias(c) for c in MEAN_FIELDS]
    rows = aligned.filter("ts_local is not null").withColumn("minute", minute_of())
    return rows.groupBy(*keys, "minute").agg(*last, *mean)


def with_power_idle(curated: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Power of the mean voltage and current; idle where the speed is unknown or small."""
    return curated.withColumns(
        {
            "power_kw": F.col("voltage") * F.col("current") / 1000,
            "idle": F.abs(F.coalesce("speed", F.lit(0.0))) <= settings.idle_speed,
        }
    )


def sanitize_km(curated: DataFrame) -> DataFrame:
    """The odometer without negative values and without those below the value of
    the minute before, carried forward over the gaps."""
    w = Window.partitionBy(*KEYS).orderBy("minute")
    valid = F.when(F.col("km") >= 0, F.col("km"))
    rows = curated.withColumn("_km", valid)
    before = F.lag("_km").over(w)
    rows = rows.withColumn("_ok", F.when(before.isNull() | (F.col("_km") >= before), F.col("_km")))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("km", F.last("_ok", True).over(upto)).drop("_km", "_ok")


def curate(aligned: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The three steps in order."""
    return sanitize_km(with_power_idle(curate_minute(aligned), settings))


SQL = """
minutes AS (
  SELECT vehicle_id, yyyymm, date_trunc('minute', ts_local) AS minute,
    arg_max(soc, ts_local) FILTER (soc IS NOT NULL) AS soc, arg_max(soc_master, ts_local) FILTER (soc_master IS NOT NULL) AS soc_master,
    arg_max(soc_slave, ts_local) FILTER (soc_slave IS NOT NULL) AS soc_slave, arg_max(km, ts_local) FILTER (km IS NOT NULL) AS km0,
    avg(voltage) AS voltage, avg(voltage_master) AS voltage_master, avg(voltage_slave) AS voltage_slave, avg(current) AS current,
    avg(current_master) AS current_master, avg(current_slave) AS current_slave, avg(speed) AS speed, avg(cell_temp) AS cell_temp, avg(bms_temp) AS bms_temp,
    avg(pack_delta) AS pack_delta, avg(charge_limit) AS charge_limit, avg(discharge_limit) AS discharge_limit
  FROM aligned GROUP BY ALL),
odo1 AS (SELECT *, CASE WHEN km0 >= 0 THEN km0 END AS k1 FROM minutes),
odo2 AS (SELECT *, lag(k1) OVER (PARTITION BY vehicle_id, yyyymm ORDER BY minute) AS kb FROM odo1),
curated AS (
  SELECT vehicle_id, yyyymm, minute, soc, soc_master, soc_slave, voltage, voltage_master, voltage_slave, current, current_master, current_slave,
    speed, cell_temp, bms_temp, pack_delta, charge_limit, discharge_limit,
    last_value(CASE WHEN kb IS NULL OR k1 >= kb THEN k1 END IGNORE NULLS) OVER (PARTITION BY vehicle_id, yyyymm ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS km,
    voltage * current / 1000 AS power_kw, abs(coalesce(speed, 0)) <= 0.5 AS idle
  FROM odo2)"""
