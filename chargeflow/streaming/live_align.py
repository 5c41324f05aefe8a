"""Alignment of live samples: the nearest samples of both units, by keyed state.

A time is answered once no sample can come any more that might be nearer: when the
watermark has passed its tolerance. Until then its samples are held; a sample that
no open or later time can reach is forgotten. A vehicle's state is thus what it
sends in the watermark's delay and twice the tolerance, however long it runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.columns import fused
from ..settings import DEFAULTS, MASTER_FIELDS, SLAVE_FIELDS, Settings
from .live import event_time

#: The state store that keyed state with timers needs.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_HELD = "unit string, seq long, at long, " + ", ".join(f"{f} double" for f in MASTER_FIELDS)
_ATTACHED = [*[f"m_{f}" for f in MASTER_FIELDS], *[f"s_{f}" for f in SLAVE_FIELDS]]


def nearest(times: np.ndarray, at: np.ndarray, tolerance: int) -> np.ndarray:
    """For each time the index of the nearest of the sorted ``at``, -1 if none is within
    ``tolerance``; of two equally near ones the earlier."""
    if not len(at):
        return np.full(len(times), -1)
    after = np.searchsorted(at, times, "left")
    before = np.clip(np.searchsorted(at, times, "right") - 1, 0, None)
    after_ = np.clip(after, None, len(at) - 1)
    gap_b = np.where(at[before] <= times, times - at[before], np.iinfo(np.int64).max)
    gap_a = np.where(at[after_] >= times, at[after_] - times, np.iinfo(np.int64).max)
    found = np.where(gap_b <= gap_a, before, after_)
    return np.where(np.minimum(gap_b, gap_a) <= tolerance, found, -1)


def _tuples(rows: pd.DataFrame) -> list[tuple]:
    """Rows as the state holds them: plain numbers, unknown ones None."""
    out = []
    for unit, seq, at, *fields in rows.itertuples(index=False):
        out.append((unit, int(seq), int(at), *(None if x is None or x != x else float(x) for x in fields)))
    return out


class _Aligner(StatefulProcessor):
    """State of a vehicle's month: ``held`` samples, and ``done``, up to which time
    (microseconds) all is answered."""

    def __init__(self, tolerance_us: int):
        self.tolerance = tolerance_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _HELD)
        self.done = handle.getValueState("done", StructType([StructField("at", LongType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        earliest = None
        for pdf in rows:
            self.held.appendList(_tuples(pdf[["unit", "seq", "at", *MASTER_FIELDS]]))
            least = int(pdf["at"].min())
            earliest = least if earliest is None else min(earliest, least)
        # One timer a key: for the earliest time that waits.
        timers = list(self.handle.listTimers())
        due = self._ms(earliest + self.tolerance)
        if not timers or due < min(timers):
            for t in timers:
                self.handle.deleteTimer(t)
            self.handle.registerTimer(due)
        yield from ()

    @staticmethod
    def _ms(us: int) -> int:
        return -(-us // 1000)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs() * 1000 - self.tolerance
        done = self.done.get()[0] if self.done.exists() else np.iinfo(np.int64).min
        held = pd.DataFrame([tuple(r) for r in self.held.get()], columns=["unit", "seq", "at", *MASTER_FIELDS])
        times = np.unique(held["at"].to_numpy(np.int64))
        open_ = times[times > done]
        due = open_[open_ <= upto]
        rest = open_[open_ > upto]
        # A later time reaches no further back than the tolerance.
        least = (int(rest[0]) if len(rest) else upto + 1) - self.tolerance
        keep = held[held["at"] >= least]
        if len(keep):
            self.held.put(_tuples(keep))
        else:
            self.held.clear()
        self.done.update((max(int(upto), int(done)),))
        if len(rest):
            self.handle.registerTimer(self._ms(int(rest[0]) + self.tolerance))
        if not len(due):
            return
        out = {"vehicle_id": np.full(len(due), key[0]), "yyyymm": [key[1]] * len(due), "at": due, "ts": pd.to_datetime(due + self.tolerance, unit="us", utc=True)}
        for unit, prefix, fields in (("master", "m_", MASTER_FIELDS), ("slave", "s_", SLAVE_FIELDS)):
            own = held[held["unit"] == unit].sort_values(["at", "seq"]).drop_duplicates("at", keep="last")
            i = nearest(due, own["at"].to_numpy(np.int64), self.tolerance)
            for f in fields:
                values = own[f].to_numpy(np.float64)
                out[prefix + f] = np.where(i >= 0, values[np.maximum(i, 0)] if len(values) else np.nan, np.nan)
        yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def stream_align(samples: DataFrame, settings: Settings = DEFAULTS, delay: str = "2 minutes") -> DataFrame:
    """The rows of ``align_nearest`` from a stream of samples, each once its time lies
    further back than the watermark by the tolerance. Samples may come in any order
    within ``delay``; later ones are dropped, and so never change what is put out.
    Each time comes once. ``ts`` is the instant at which a row was due, its time and
    the tolerance, with the watermark that windows further on go by.

    Needs the state store of STATE_STORE and UTC as the session's zone.
    """
    spark = samples.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != STATE_STORE:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {STATE_STORE}")
    rows = event_time(samples.filter("ts_local is not null"), delay)
    rows = rows.select("vehicle_id", "yyyymm", "unit", F.col("seq").cast("long").alias("seq"), F.unix_micros("ts").alias("at"), *[F.col(f).cast("double").alias(f) for f in MASTER_FIELDS], "ts")
    schema = "vehicle_id long, yyyymm string, at long, ts timestamp, " + ", ".join(f"{f} double" for f in _ATTACHED)
    found = rows.groupBy("vehicle_id", "yyyymm").transformWithStateInPandas(_Aligner(int(settings.tolerance_s * 1e6)), schema, "append", "eventtime", eventTimeColumnName="ts")
    # Frames have NaN where a field is unknown.
    known = {c: F.when(~F.isnan(c), F.col(c)) for c in _ATTACHED}
    both = []
    for name, how in (("soc", "first"), ("voltage", "mean"), ("current", "sum")):
        m, s = known[f"m_{name}"], known[f"s_{name}"]
        both += [fused(m, s, how).alias(name), m.alias(f"{name}_master"), s.alias(f"{name}_slave")]
    others = [known[f"m_{c}"].alias(c) for c in MASTER_FIELDS if c not in SLAVE_FIELDS]
    return found.select("vehicle_id", "yyyymm", F.timestamp_micros("at").cast("timestamp_ntz").alias("ts_local"), *both, *others, "ts")
