"""Nearest-in-time alignment of a vehicle's two battery units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import clock, fused
from ..settings import DEFAULTS, KEYS, MASTER_FIELDS, SLAVE_FIELDS, Settings


def timestamp_spine(samples: DataFrame) -> DataFrame:
    """The distinct times at which either unit has a sample."""
    return samples.filter("ts_local is not null").select(*KEYS, "ts_local").distinct()


def align_nearest(samples: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """For each time of either unit the nearest sample of both, at most
    ``tolerance_s`` away; of two equally near ones the earlier, of several at one
    time that of the highest ``seq``. A sample is attached whole, with its nulls.
    Adds the fused ``soc``, ``voltage`` and ``current``.

    ``samples`` has a row per sample with ``unit`` ("master" or "slave"). Both
    units are one input: a group by time gives the spine and settles repeated
    times in one step, and two running windows find the neighbours, so there is
    no range join, and no pair of rows that doesn't belong together is formed.
    An absent unit gives null columns; an empty input an empty result.
    """
    return _attached(samples.filter("ts_local is not null").repartition(*KEYS), KEYS, settings)


def chunk_of(micros: Column, chunk_s: float) -> Column:
    """The number of the stretch of ``chunk_s`` seconds that a ``clock`` value is in."""
    width = int(chunk_s * 1e6)
    return ((micros - F.pmod(micros, F.lit(width))) / width).cast("long")


def align_in_chunks(samples: DataFrame, settings: Settings = DEFAULTS, chunk_s: float = 86_400.0, keep_chunk: bool = False) -> DataFrame:
    """The rows of ``align_nearest``, with each vehicle's month dealt out in stretches of
    ``chunk_s`` seconds, so that a chatty vehicle's month is never in one task.

    A sample goes to its own stretch and, within the tolerance of an edge, to the
    neighbour too; each time is answered by the stretch that it lies in alone. What a
    time can be attached to is thus always beside it, and nothing else is copied.
    Months stay apart as in ``align_nearest``. ``keep_chunk`` keeps the stretch, so
    that minutes can be grouped within it without another shuffle (stretches must
    then be whole minutes).
    """
    reach = int(settings.tolerance_s * 1e6)
    if chunk_s * 1e6 <= reach:
        raise ValueError("a stretch must be longer than the tolerance")
    keys, at = [*KEYS, "chunk"], clock(F.col("ts_local"))
    near = F.array_distinct(F.array(*[chunk_of(at + d, chunk_s) for d in (-reach, 0, reach)]))
    dealt = samples.filter("ts_local is not null").withColumn("chunk", F.explode(near)).repartition(*keys)
    out = _attached(dealt, keys, settings).filter(F.col("chunk") == chunk_of(at, chunk_s))
    return out if keep_chunk else out.drop("chunk")


def _attached(samples: DataFrame, keys: list[str], settings: Settings) -> DataFrame:
    """The nearest samples of both units for each time, within each of ``keys``."""
    sample = {
        "master": F.struct("ts_local", *MASTER_FIELDS),
        "slave": F.struct("ts_local", *SLAVE_FIELDS),
    }
    at = [F.max_by(F.when(F.col("unit") == u, s), F.when(F.col("unit") == u, F.col("seq"))).alias(u) for u, s in sample.items()]
    spine = samples.groupBy(*keys, "ts_local").agg(*at)
    onward = Window.partitionBy(*keys).orderBy("ts_local").rowsBetween(Window.unboundedPreceding, 0)
    backward = Window.partitionBy(*keys).orderBy(F.col("ts_local").desc()).rowsBetween(Window.unboundedPreceding, 0)

    def nearest(unit: str) -> Column:
        before, after = F.col(f"_{unit}_before"), F.col(f"_{unit}_after")
        now = clock(F.col("ts_local"))
        back, ahead = now - clock(before["ts_local"]), clock(after["ts_local"]) - now
        found = F.when(ahead.isNull() | (back <= ahead), before).otherwise(after)
        gap = F.least(back, ahead)
        return F.when(gap <= int(settings.tolerance_s * 1e6), found)

    around = spine.select(
        *keys,
        "ts_local",
        *[F.last(u, True).over(onward).alias(f"_{u}_before") for u in sample],
        *[F.last(u, True).over(backward).alias(f"_{u}_after") for u in sample],
    )
    joined = around.select(*keys, "ts_local", nearest("master").alias("m"), nearest("slave").alias("s"))
    m, s = F.col("m"), F.col("s")
    both = []
    for name, how in (("soc", "first"), ("voltage", "mean"), ("current", "sum")):
        both += [fused(m[name], s[name], how).alias(name), m[name].alias(f"{name}_master"), s[name].alias(f"{name}_slave")]
    return joined.select(*keys, "ts_local", *both, *[m[c].alias(c) for c in MASTER_FIELDS if c not in SLAVE_FIELDS])


SQL = """
m AS (SELECT * FROM telemetry WHERE unit = 'master'), s AS (SELECT * FROM telemetry WHERE unit = 'slave'),
spine AS (SELECT DISTINCT vehicle_id, yyyymm, ts_local FROM telemetry),
mb AS (SELECT p.*, m.seq AS bseq, m.ts_local AS bts FROM spine p ASOF LEFT JOIN m ON p.vehicle_id = m.vehicle_id AND p.yyyymm = m.yyyymm AND p.ts_local >= m.ts_local),
ma AS (SELECT p.*, m.seq AS aseq, m.ts_local AS ats FROM mb p ASOF LEFT JOIN m ON p.vehicle_id = m.vehicle_id AND p.yyyymm = m.yyyymm AND p.ts_local <= m.ts_local),
mn AS (SELECT vehicle_id, yyyymm, ts_local, CASE WHEN least(coalesce(epoch_us(ts_local) - epoch_us(bts), 1e18), coalesce(epoch_us(ats) - epoch_us(ts_local), 1e18)) <= 15000000
         THEN CASE WHEN ats IS NULL OR epoch_us(ts_local) - epoch_us(bts) <= epoch_us(ats) - epoch_us(ts_local) THEN bseq ELSE aseq END END AS mseq FROM ma),
sb AS (SELECT p.*, s.seq AS bseq, s.ts_local AS bts FROM mn p ASOF LEFT JOIN s ON p.vehicle_id = s.vehicle_id AND p.yyyymm = s.yyyymm AND p.ts_local >= s.ts_local),
sa AS (SELECT p.*, s.seq AS aseq, s.ts_local AS ats FROM sb p ASOF LEFT JOIN s ON p.vehicle_id = s.vehicle_id AND p.yyyymm = s.yyyymm AND p.ts_local <= s.ts_local),
sn AS (SELECT vehicle_id, yyyymm, ts_local, mseq, CASE WHEN least(coalesce(epoch_us(ts_local) - epoch_us(bts), 1e18), coalesce(epoch_us(ats) - epoch_us(ts_local), 1e18)) <= 15000000
         THEN CASE WHEN ats IS NULL OR epoch_us(ts_local) - epoch_us(bts) <= epoch_us(ats) - epoch_us(ts_local) THEN bseq ELSE aseq END END AS sseq FROM sa),
aligned AS (
  SELECT n.vehicle_id, n.yyyymm, n.ts_local,
    coalesce(m.soc, s.soc) AS soc, m.soc AS soc_master, s.soc AS soc_slave,
    coalesce((m.voltage + s.voltage) / 2, m.voltage, s.voltage) AS voltage, m.voltage AS voltage_master, s.voltage AS voltage_slave,
    coalesce(m.current + s.current, m.current, s.current) AS current, m.current AS current_master, s.current AS current_slave,
    m.speed, m.cell_temp, m.bms_temp, m.pack_delta, m.charge_limit, m.discharge_limit, m.km
  FROM sn n LEFT JOIN m ON n.mseq = m.seq LEFT JOIN s ON n.sseq = s.seq)"""
