"""Charging sessions: sign of the current, mask, islands, energy, quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.columns import seconds_between
from ..settings import DEFAULTS, KEYS, SESSION, Settings


def _order():
    return Window.partitionBy(*KEYS).orderBy("minute")


def sign_of(median: Column, correlation: Column) -> Column:
    """-1 if charging raises the current, else 1: by the median current while the
    charge rises, or by the correlation of current and charge where there is none."""
    by_correlation = F.when(correlation > 0, -1).otherwise(1)
    return F.when(median.isNull(), by_correlation).when(median > 0, -1).otherwise(1)


def together(over: WindowSpec | None = None, change: str = "dsoc", amps: str = "current") -> Column:
    """Above 0 if current and change of charge rise together (unknown ones as 0); null
    where either is the same in all rows. Of the correlation only the sign is asked,
    and a division by a spread of 0 would end the job."""
    x, y = F.coalesce(amps, F.lit(0.0)), F.coalesce(change, F.lit(0.0))
    on = (lambda c: c) if over is None else (lambda c: c.over(over))
    varies = (on(F.max(x)) > on(F.min(x))) & (on(F.max(y)) > on(F.min(y)))
    return F.when(varies, on(F.covar_pop(x, y)))


def with_charge_sign(curated: DataFrame) -> DataFrame:
    """Adds ``dsoc``, the change of charge since the row before, and ``sign`` of the
    vehicle's month. All by windows over one partitioning: no further shuffle."""
    rows = curated.withColumn("dsoc", F.col("soc") - F.lag("soc").over(_order()))
    month = Window.partitionBy(*KEYS)
    rising = F.median(F.when(F.col("dsoc") > 0, F.col("current"))).over(month)
    return rows.withColumn("sign", sign_of(rising, together(month)))


def charge_sign(curated: DataFrame) -> DataFrame:
    """``sign`` of each vehicle's month."""
    rows = curated.withColumn("dsoc", F.col("soc") - F.lag("soc").over(_order()))
    found = rows.groupBy(*KEYS).agg(F.median(F.when(F.col("dsoc") > 0, F.col("current"))).alias("m"), together().alias("c"))
    return found.select(*KEYS, sign_of(F.col("m"), F.col("c")).alias("sign"))


def charge_mask(settings: Settings = DEFAULTS) -> Column:
    """Charging: current of the charging sign within its limits, voltage up, charge
    not falling. What is unknown is not charging."""
    amps = F.abs("current")
    ok = (
        (F.col("sign") * F.col("current") < 0)
        & (amps >= settings.min_charge_a)
        & (amps <= settings.max_charge_a)
        & (F.col("voltage") > settings.min_voltage)
        & (F.coalesce("dsoc", F.lit(0.0)) >= settings.min_soc_step)
    )
    return F.coalesce(ok, F.lit(False))


def split_sessions(masked: DataFrame, settings: Settings = DEFAULTS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Adds ``session_id`` (1, 2, ... in each vehicle's month, or other ``keys``; null
    outside) to rows with a boolean ``charging``: a gap of more than
    ``session_gap_min`` between charging minutes begins a new session."""
    w = Window.partitionBy(*keys).orderBy("minute")
    before = F.last(F.when(F.col("charging"), F.col("minute")), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = masked.withColumn("_before", before)
    fresh = F.col("_before").isNull() | (seconds_between(F.col("minute"), F.col("_before")) > settings.session_gap_min * 60)
    count = F.sum(F.when(F.col("charging") & fresh, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("session_id", F.when(F.col("charging"), count)).drop("_before")


def sessionize(curated: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Curated minutes with ``session_id``."""
    rows = with_charge_sign(curated).withColumn("charging", charge_mask(settings))
    return split_sessions(rows, settings)


def synthesize_sessions(rows: DataFrame, keys: list[str], order: str = "elapsed_min") -> DataFrame:
    """Adds ``session_id`` (0, 1, ...) to predictions without one: a new session
    where the charge falls by more than 1, or time jumps by over 60 minutes or back."""
    w = Window.partitionBy(*keys).orderBy("seq")
    ds, dt = F.col("soc") - F.lag("soc").over(w), F.col(order) - F.lag(order).over(w)
    fresh = F.coalesce((ds < -1) | (dt > 60) | (dt < 0), F.lit(False))
    rows = rows.withColumn("_new", fresh.cast("long"))
    return rows.withColumn("session_id", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def session_energy_columns(max_dt_s: float = DEFAULTS.max_dt_s) -> tuple[dict[str, Column], dict[str, Column]]:
    """(columns to add to session minutes, aggregates over a session): energies by
    the trapezoid rule, unknown power as 0, steps cut to ``max_dt_s``."""
    w = Window.partitionBy(*SESSION).orderBy("minute")
    power = lambda u: F.coalesce(F.col(f"voltage_{u}") * F.col(f"current_{u}") / 1000, F.lit(0.0))
    dt = F.least(F.greatest(F.coalesce(seconds_between(F.col("minute"), F.lag("minute").over(w)), F.lit(0.0)), F.lit(0.0)), F.lit(float(max_dt_s)))
    parts = {"m": power("master"), "s": power("slave"), "p": power("master") + power("slave")}
    add = {f"_area_{k}": (p + F.coalesce(F.lag(p).over(w), F.lit(0.0))) / 2 * dt for k, p in parts.items()} | {"_pack_kw": parts["p"]}
    names = {"m": "energy_master_kwh", "s": "energy_slave_kwh", "p": "total_energy_kwh"}
    return add, {n: F.abs(F.sum(f"_area_{k}")) / 3600 for k, n in names.items()} | {"mean_pack_kw": F.avg("_pack_kw")}


def session_energy(minutes: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    add, found = session_energy_columns(settings.max_dt_s)
    rows = minutes.filter("session_id is not null").withColumns(add)
    return rows.groupBy(*SESSION).agg(*[c.alias(n) for n, c in found.items()])


def session_quality(minutes: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per session: duration, change of charge, idle share, median |A|,
    energy, and ``reasons``, what it falls short of."""
    add, energy = session_energy_columns(settings.max_dt_s)
    rows = minutes.filter("session_id is not null").withColumns(add)
    found = rows.groupBy(*SESSION).agg(
        F.count(F.lit(1)).alias("n_minutes"),
        (seconds_between(F.max("minute"), F.min("minute")) / 60).alias("duration_min"),
        (F.max_by("soc", "minute") - F.min_by("soc", "minute")).alias("delta_soc"),
        F.avg(F.col("idle").cast("int")).alias("idle_frac"),
        F.median(F.abs("current")).alias("median_abs_current"),
        energy["total_energy_kwh"].alias("total_energy_kwh"),
    )
    return with_reasons(found, settings)


def with_reasons(found: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Adds ``reasons``, what a session falls short of."""
    checks = {
        "duration": F.col("duration_min") < settings.min_session_min,
        "delta_soc": F.col("delta_soc") < settings.min_delta_soc,
        "idle_frac": F.col("idle_frac") < settings.min_idle_share,
        "median_current": F.col("median_abs_current") < settings.min_median_a,
        "min_energy": F.col("total_energy_kwh") < settings.min_energy_kwh,
    }
    return found.withColumn("reasons", F.array_compact(F.array(*[F.when(c, n) for n, c in checks.items()])))


def hard_fail() -> Column:
    """Only too short a session, or too little energy, drops it."""
    return F.array_contains("reasons", "duration") | F.array_contains("reasons", "min_energy")


def gate_sessions(minutes: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Session minutes of the sessions that pass ``hard_fail``: its two figures are
    taken over each session by windows, so that the table is read and dealt once."""
    add, energy = session_energy_columns(settings.max_dt_s)
    whole = Window.partitionBy(*SESSION)
    rows = minutes.filter("session_id is not null").withColumns(add)
    lasts = seconds_between(F.max("minute").over(whole), F.min("minute").over(whole)) / 60
    rows = rows.withColumns({"_lasts": lasts, "_kwh": F.abs(F.sum("_area_p").over(whole)) / 3600})
    fails = (F.col("_lasts") < settings.min_session_min) | (F.col("_kwh") < settings.min_energy_kwh)
    return rows.filter(~F.coalesce(fails, F.lit(False))).select(*minutes.columns)


SQL = """
dsoc0 AS (SELECT *, soc - lag(soc) OVER (PARTITION BY vehicle_id, yyyymm ORDER BY minute) AS dsoc FROM curated),
signs AS (SELECT vehicle_id, yyyymm, median(CASE WHEN dsoc > 0 THEN current END) AS md, corr(coalesce(current, 0), coalesce(dsoc, 0)) AS co FROM dsoc0 GROUP BY ALL),
sign AS (SELECT vehicle_id, yyyymm, CASE WHEN md IS NULL THEN CASE WHEN NOT isnan(co) AND co > 0 THEN -1 ELSE 1 END WHEN md > 0 THEN -1 ELSE 1 END AS sign FROM signs),
masked AS (SELECT d.*, g.sign, coalesce(g.sign * current < 0 AND abs(current) BETWEEN 6 AND 350 AND voltage > 300 AND coalesce(dsoc, 0) >= -0.05, false) AS charging FROM dsoc0 d JOIN sign g USING (vehicle_id, yyyymm)),
gaps AS (SELECT *, last_value(CASE WHEN charging THEN minute END IGNORE NULLS) OVER (PARTITION BY vehicle_id, yyyymm ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS tb FROM masked),
sessions AS (SELECT * EXCLUDE (tb), CASE WHEN charging THEN sum(CASE WHEN charging AND (tb IS NULL OR epoch_us(minute) - epoch_us(tb) > 600000000) THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle_id, yyyymm ORDER BY minute) END::BIGINT AS session_id FROM gaps),
areas AS (
  SELECT *, least(greatest(coalesce((epoch_us(minute) - epoch_us(lag(minute) OVER w)) / 1e6, 0), 0), 180) AS dt,
    coalesce(voltage_master * current_master / 1000, 0) AS pm, coalesce(voltage_slave * current_slave / 1000, 0) AS ps,
    coalesce(lag(coalesce(voltage_master * current_master / 1000, 0)) OVER w, 0) AS pm0, coalesce(lag(coalesce(voltage_slave * current_slave / 1000, 0)) OVER w, 0) AS ps0
  FROM sessions WHERE session_id IS NOT NULL WINDOW w AS (PARTITION BY vehicle_id, yyyymm, session_id ORDER BY minute)),
quality0 AS (
  SELECT vehicle_id, yyyymm, session_id, count(*) AS n_minutes, (epoch_us(max(minute)) - epoch_us(min(minute))) / 60e6 AS duration_min,
    max(soc) FILTER (minute = lastm) - max(soc) FILTER (minute = firstm) AS delta_soc,
    avg(idle::INT) AS idle_frac, median(abs(current)) AS median_abs_current, abs(sum((pm + ps + pm0 + ps0) / 2 * dt)) / 3600 AS total_energy_kwh,
    abs(sum((pm + pm0) / 2 * dt)) / 3600 AS energy_master_kwh, abs(sum((ps + ps0) / 2 * dt)) / 3600 AS energy_slave_kwh, avg(pm + ps) AS mean_pack_kw
  FROM (SELECT *, max(minute) OVER (PARTITION BY vehicle_id, yyyymm, session_id) AS lastm, min(minute) OVER (PARTITION BY vehicle_id, yyyymm, session_id) AS firstm FROM areas) GROUP BY vehicle_id, yyyymm, session_id),
quality AS (SELECT *, list_filter([CASE WHEN duration_min < 4 THEN 'duration' END, CASE WHEN delta_soc < 0.2 THEN 'delta_soc' END, CASE WHEN idle_frac < 0.8 THEN 'idle_frac' END,
    CASE WHEN median_abs_current < 5 THEN 'median_current' END, CASE WHEN total_energy_kwh < 0.1 THEN 'min_energy' END], lambda x: x IS NOT NULL) AS reasons FROM quality0),
gated AS (SELECT s.* FROM sessions s JOIN quality q USING (vehicle_id, yyyymm, session_id) WHERE NOT list_contains(reasons, 'duration') AND NOT list_contains(reasons, 'min_energy'))"""
