"""Column expressions: conversions, ranges of current and charge, formats."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import CURRENT_EDGES


def to_double(c: Column) -> Column:
    """A number, or null where the value isn't one. NaN is null, too."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x), x)


def clock(c: Column) -> Column:
    """A wall-clock time as microseconds, for differences: each day has 24 hours,
    whatever the session's time zone."""
    since = c.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    # An interval is a number of microseconds; to a decimal of seconds it goes without loss.
    return (since.cast("interval second").cast("decimal(18,6)") * 1_000_000).cast("long")


def wall(micros: Column) -> Column:
    """The wall-clock time of ``clock``."""
    seconds = (micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def seconds_between(later: Column, earlier: Column) -> Column:
    gap = later.cast("timestamp_ntz") - earlier.cast("timestamp_ntz")
    return gap.cast("interval second").cast("decimal(18,6)").cast("double")


def fused(master: Column, slave: Column, how: str) -> Column:
    """One value for both units: ``first`` known, ``mean`` of the known, or ``sum``
    in which a missing one counts 0. Null where both are missing."""
    if how == "first":
        return F.coalesce(master, slave)
    if how == "mean":
        return F.coalesce((master + slave) / 2, master, slave)
    return F.coalesce(master + slave, master, slave)


def range_labels(edges: Sequence[float] = CURRENT_EDGES) -> list[str]:
    """``lo–hi A`` for each range; open upwards where it ends at 1000 or above."""
    pairs = zip(edges, edges[1:])
    return [f"{int(a)}–{int(b)} A" if b < 1000 else f"{int(a)}+ A" for a, b in pairs]


def current_bucket(amps: Column, edges: Sequence[float] = CURRENT_EDGES, beyond: str = "null") -> Column:
    """Index of the range of |amps|, closed on the left. At the last edge and
    above: ``null``; the last range (``last``); or the last range, where null
    amps are range 0 (``clip``)."""
    x, n = F.abs(amps), len(edges) - 1
    index = F.when(x >= edges[-1], F.lit(None) if beyond == "null" else F.lit(n - 1))
    for i in reversed(range(n)):
        index = index.when(x >= edges[i], i)
    return F.coalesce(index, F.lit(0)) if beyond == "clip" else index


def bucket_label(index: Column, edges: Sequence[float] = CURRENT_EDGES) -> Column:
    return F.get(F.array(*[F.lit(x) for x in range_labels(edges)]), index)


def bucket_middle(index: Column, edges: Sequence[float] = CURRENT_EDGES) -> Column:
    """The middle of a range; one ampere above its begin if it is open."""
    mids = [(a + b) / 2 if b < 1000 else a + 1.0 for a, b in zip(edges, edges[1:])]
    return F.get(F.array(*[F.lit(float(x)) for x in mids]), index)


# The coarse ranges of current, closed on the right.
BINS4 = ["≤1A", "1–5A", "5–10A", ">10A"]


def current_bin4(amps: Column) -> Column:
    """Index of the coarse range of |amps|; null stays null."""
    x = F.abs(amps)
    return F.when(x <= 1, 0).when(x <= 5, 1).when(x <= 10, 2).when(x.isNotNull(), 3)


def bin4_label(index: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in BINS4]), index)


def soc_floor(soc: Column, step: float) -> Column:
    """Begin of the band of ``step`` percent, at least 0.1."""
    step = max(0.1, float(step))
    return F.floor(soc / step) * step


def soc_band10(soc: Column) -> Column:
    """Begin of the ten-percent band [lo, lo + 10) of the value cut to 0 .. 100; exactly 100 has none."""
    x = F.least(F.greatest(soc, F.lit(0.0)), F.lit(100.0))
    return F.when(soc.isNotNull() & (x < 100), F.floor(x / 10) * 10).cast("int")


def soc_band_right(soc: Column, edges: Sequence[float], first_closed: bool = False) -> Column:
    """Begin of the band (lo, hi] among ``edges``; the first may be closed on both sides."""
    out = F.when(F.lit(False), F.lit(None).cast("int"))
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        low = (soc >= a) if first_closed and i == 0 else (soc > a)
        out = out.when(low & (soc <= b), int(a))
    return out


def session_key(yyyymm: Column, session_id: Column) -> Column:
    """``2024-03-000012``; the id alone without a month."""
    number = F.lpad(session_id.cast("long").cast("string"), 6, "0")
    return F.when(yyyymm.isNotNull() & session_id.isNotNull(), F.concat_ws("-", yyyymm, number)).otherwise(session_id.cast("string"))


def label_clip(minutes: Column, most: float = 1440.0) -> Column:
    return F.when(minutes.isNotNull(), F.least(minutes, F.lit(most)))


def clip_minutes(minutes: Column, most: float = 240.0) -> Column:
    return F.when(minutes.isNotNull(), F.greatest(F.lit(0.0), F.least(minutes, F.lit(most))))


def format_minutes(minutes: Column) -> Column:
    """``1 hr 5 min``, rounded half to even."""
    whole = F.bround(clip_minutes(minutes), 0).cast("long")
    return F.when(minutes.isNotNull(), F.format_string("%d hr %d min", F.floor(whole / 60), whole % 60))


def soc_weight(soc: Column) -> Column:
    """Training weight: low states of charge count more."""
    return F.when((soc >= 0) & (soc < 20), 1.5).when((soc >= 20) & (soc < 40), 1.2).otherwise(1.0)


def soc_to_percent(df: DataFrame, column: str = "soc") -> DataFrame:
    """Fractions to percent, if no value of the whole table is above 1.5."""
    top = df.agg(F.max(column).alias("_top"))
    return df.crossJoin(F.broadcast(top)).withColumn(column, F.when(F.col("_top") <= 1.5, F.col(column) * 100).otherwise(F.col(column))).drop("_top")


def align_features(df: DataFrame, features: Sequence[str], missing: float | None = None) -> DataFrame:
    """Exactly ``features``, in order, as doubles; absent ones are ``missing``."""
    have = set(df.columns)
    return df.select(*[(to_double(F.col(f)) if f in have else F.lit(missing).cast("double")).alias(f) for f in features])


# Columns that are no features.
ALWAYS_DROPPED = (
    "timestamp_local", "session_id", "t_start", "t_end", "vehicle", "fail_reason", "speed", "idle", "slave_power_kw",
)
#: This library's own keys.
OWN_KEYS = ("vehicle_id", "yyyymm", "session_key")
# Words that no feature's name may hold.
GUARDED = ("energy", "efficiency")
ENERGY_NAMES = (
    "estimated_energy_stored_kwh", "efficiency_pct", "charging_efficiency_pct", "charger_energy_kwh", "session_energy_in_kwh",
    "pack_energy_in_kwh", "dc_energy_in_kwh", "ac_energy_in_kwh", "energy_in_kwh", "energy_stored_kwh_estimate", "inferred_efficiency",
    "efficiency", "loss_kwh", "net_energy_kwh", "total_energy_kwh",
)
ENERGY_PATTERN = re.compile(r"(efficien|energy[_\-]stored|charger[_\-]?energy|energy[_\-]?loss|loss[_\-]?kwh)", re.I)


def guarded(features: Sequence[str]) -> list[str]:
    """The features without ids and without any whose name speaks of energy or
    efficiency: the last guard before training."""
    return [f for f in features if f not in {*ALWAYS_DROPPED[:2], "vehicle", *OWN_KEYS} and not any(w in f for w in GUARDED)]


def soc_current_slice(rows: DataFrame, soc: tuple[float, float] = (20, 80), amps: tuple[float, float] = (10, 15)) -> DataFrame:
    """Rows within a range of charge and one of |A|, ends included."""
    return rows.filter(F.col("soc").between(*soc) & F.abs("current").between(*amps))


def drop_forbidden(df: DataFrame, names: Sequence[str] = (*ALWAYS_DROPPED, *OWN_KEYS)) -> DataFrame:
    """Without ids, operating columns and whatever tells of energy or efficiency."""
    gone = {*names, *ENERGY_NAMES}
    return df.drop(*[c for c in df.columns if c in gone or ENERGY_PATTERN.search(c)])


def as_numeric(df: DataFrame) -> DataFrame:
    """Text columns become numbers if any of their values is one."""
    texts = [n for n, t in df.dtypes if t == "string"]
    if not texts:
        return df
    found = df.agg(*[F.count(to_double(F.col(c))).alias(c) for c in texts]).first()
    return df.withColumns({c: to_double(F.col(c)) for c in texts if found[c]})
