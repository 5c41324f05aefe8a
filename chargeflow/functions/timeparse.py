"""Timestamps in the many forms that unit files hold, to local wall-clock time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..settings import DEFAULTS
from . import clock_scan
from .columns import clock, wall

# The accepted forms.
LOCALE = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s{1,2}(\d{1,2}):(\d{2})(?::(\d{2}))?\s*(AM|PM|am|pm)?\s*$"
CLOCK = r"^\s*((?:[01]?\d|2[0-3])):([0-5]\d)(?::([0-5]\d))?\s*$"
MINUTES = r"^\s*(\d{1,3}):([0-5]\d)\s*$"
NUMBER = r"^\s*\d+(\.\d+)?\s*$"
ISO = r"^\s*\d{4}-\d{1,2}-\d{1,2}"
ZONED = r"(?:[Zz]|[+-]\d{2}:?\d{2})\s*$"


def _group(text: Column, pattern: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, i), F.lit("")).try_cast("int")


def parse_local_absolute(text: Column, time_zone: str = DEFAULTS.time_zone) -> Column:
    """Day-first dates with 12- or 24-hour clock, and ISO forms; with a zone they
    are brought to ``time_zone``. What is neither, or no date, is null."""
    hour = _group(text, LOCALE, 4)
    half = F.lower(F.regexp_extract(text, LOCALE, 7))
    hour = F.when((half == "pm") & (hour != 12), hour + 12).when((half == "am") & (hour == 12), 0).otherwise(hour)
    second = F.coalesce(_group(text, LOCALE, 6), F.lit(0)).cast("decimal(8,6)")
    day_first = F.try_make_timestamp_ntz(_group(text, LOCALE, 3), _group(text, LOCALE, 2), _group(text, LOCALE, 1), hour, _group(text, LOCALE, 5), second)
    trimmed = F.trim(text)
    instant = trimmed.try_cast("timestamp")
    zoned = F.convert_timezone(F.current_timezone(), F.lit(time_zone), instant.cast("timestamp_ntz"))
    iso = F.when(F.regexp_like(text, F.lit(ZONED)), zoned).otherwise(trimmed.try_cast("timestamp_ntz"))
    return F.when(F.regexp_like(text, F.lit(LOCALE)), day_first).when(F.regexp_like(text, F.lit(ISO)), iso)


def _kind(text: Column, absolute: Column) -> Column:
    return (
        F.when(F.regexp_like(text, F.lit(LOCALE)), F.when(absolute.isNotNull(), "abs"))
        .when(F.regexp_like(text, F.lit(CLOCK)), "clock")
        .when(F.regexp_like(text, F.lit(MINUTES)), "minutes")
        .when(F.regexp_like(text, F.lit(NUMBER)), "number")
        .when(absolute.isNotNull(), "abs")
    )


def parse_local(rows: DataFrame, text: str, month: str, keys: Sequence[str], order: Sequence[str], time_zone: str = DEFAULTS.time_zone) -> DataFrame:
    """Adds ``ts_local`` to the rows of files (told apart by ``keys``, in ``order``).

    Beside absolute forms: ``HH:MM[:SS]`` on the date of the valid row before, a
    day later when the clock goes back; plain numbers are seconds since the
    begin of ``month`` (``YYYY-MM``), never falling within a run of numbers;
    ``MMM:SS`` with minutes that are no hour are minutes since then, or a second
    after the row before if that would go back. Bad values are null and carry
    nothing. Files that hold ``MMM:SS``, whose rows depend on all before, are
    scanned in blocks (see ``clock_scan``); all others are windows in file order.
    """
    t = F.col(text)
    start = F.to_timestamp_ntz(F.concat(F.col(month), F.lit("-01")), F.lit("yyyy-MM-dd"))
    rows = rows.withColumns({"_abs": parse_local_absolute(t, time_zone), "_start": start})
    rows = rows.withColumn("_kind", _kind(t, F.col("_abs")))
    second_of_day = _group(t, CLOCK, 1) * 3600 + _group(t, CLOCK, 2) * 60 + F.coalesce(_group(t, CLOCK, 3), F.lit(0))
    seconds = F.when(F.col("_kind") == "number", F.trim(t).try_cast("double")).when(F.col("_kind") == "minutes", (_group(t, MINUTES, 1) * 60 + _group(t, MINUTES, 2)).cast("double"))
    rows = rows.withColumns({"_tod": F.when(F.col("_kind") == "clock", second_of_day), "_sec": seconds})
    file_ = Window.partitionBy(*keys)
    own = [f"_key{i}" for i in range(len(keys))]
    # One row a file with such values; a file's rows stay where they are.
    looping = rows.filter("_kind = 'minutes'").select(*[F.col(k).alias(o) for k, o in zip(keys, own)]).distinct().withColumn("_loop", F.lit(True))
    same = F.lit(True)
    for k, o in zip(keys, own):
        same = same & F.col(k).eqNullSafe(F.col(o))
    rows = rows.join(looping, same, "left").drop(*own).withColumn("_loop", F.coalesce("_loop", F.lit(False)))

    plain = rows.filter(~F.col("_loop"))
    w = file_.orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    last_kind = F.last(F.col("_kind"), True).over(before)
    plain = plain.withColumn("_fresh", (F.col("_kind") == "number") & F.coalesce(last_kind != "number", F.lit(True)))
    plain = plain.withColumn("_run", F.sum(F.col("_fresh").cast("int")).over(upto))
    in_run = Window.partitionBy(*keys, "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    held = F.max(F.when(F.col("_kind") == "number", F.col("_sec"))).over(in_run)
    counted = wall(clock(F.col("_start")) + F.round(F.col("_held") * 1e6).cast("long"))
    plain = plain.withColumn("_held", held).withColumn("_anchor", F.when(F.col("_kind") == "abs", F.col("_abs")).when(F.col("_kind") == "number", counted))
    # Clock values: the date of the last anchor, and a day for each time that the clock went back since.
    clock_now = F.coalesce("_tod", F.hour("_anchor") * 3600 + F.minute("_anchor") * 60 + F.second("_anchor"))
    plain = plain.withColumn("_now", F.when(F.col("_kind").isNotNull(), clock_now))
    plain = plain.withColumn("_part", F.count("_anchor").over(upto)).withColumn("_from", F.coalesce(F.last("_anchor", True).over(upto), F.col("_start")))
    since = Window.partitionBy(*keys, "_part").orderBy(*order)
    back = (F.col("_kind") == "clock") & (F.col("_tod") < F.coalesce(F.last("_now", True).over(since.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    plain = plain.withColumn("_days", F.sum(F.coalesce(back, F.lit(False)).cast("int")).over(since.rowsBetween(Window.unboundedPreceding, 0)))
    midnight = clock(F.col("_from").cast("date"))
    clocked = wall(midnight + (F.col("_days") * 86400 + F.col("_tod")).cast("long") * 1_000_000)
    names = [c for c in rows.columns if not c.startswith("_")]
    plain = plain.select(*names, F.when(F.col("_kind") == "clock", clocked).otherwise(F.col("_anchor")).alias("ts_local"))

    since_start = clock(F.col("_start")) + F.round(F.col("_sec") * 1e6).cast("long")
    at = F.when(F.col("_kind") == "abs", clock(F.col("_abs"))).when(F.col("_kind") == "clock", F.col("_tod").cast("long") * 1_000_000).otherwise(since_start)
    code = F.lit(-1)
    for kind, number in clock_scan.KINDS.items():
        code = F.when(F.col("_kind") == kind, number).otherwise(code)
    # Without a month, what counts from its begin is bad.
    scan = rows.filter("_loop").withColumns({"_at": at, "_base": F.coalesce(clock(F.col("_start")), F.lit(0)).cast("long")})
    scan = scan.withColumn("_code", F.when(F.col("_at").isNull(), -1).otherwise(code).cast("long")).select(*names, "_code", "_at", "_base")
    looped = clock_scan.times_in_order(scan, keys, order)
    return plain.unionByName(looped.select(*names, wall(F.col("_us")).alias("ts_local")))
