"""Sessions over month ends, from month-local work and what stands at the borders.

A month is worked on alone. Of all months before, it needs one row a vehicle: the
charge in the last minute, how many sessions there were, and the last charging
minute, to which the month's first session may belong. A month leaves such a row
to the next. Its sessions are *pieces*, whose sums add up to those of the whole
session, so that an appended month reads the border of one old partition and
writes its own three (minutes, pieces, border), and no old minute is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import seconds_between
from ..settings import DEFAULTS, KEYS, SESSION, Settings
from ..sources.unit_files import write_monthly
from ..storage import exists
from .sessions import charge_mask, sign_of, split_sessions, together, with_reasons

_TAIL = "struct<minute:timestamp_ntz,soc:double,temp:double,kw_m:double,kw_s:double>"
#: What a month hands on for a vehicle.
BORDER = f"vehicle_id long, last_soc double, n_sessions long, tail {_TAIL}"


def no_border(spark: SparkSession) -> DataFrame:
    """What the first month begins with."""
    return spark.createDataFrame([], BORDER)


def _power(unit: str) -> Column:
    return F.coalesce(F.col(f"voltage_{unit}") * F.col(f"current_{unit}") / 1000, F.lit(0.0))


def _temp() -> Column:
    return F.coalesce("cell_temp", "bms_temp")


def month_sessions(curated: DataFrame, before: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Curated minutes of one month of each vehicle with ``session_id`` counted over all
    months. ``before`` is the border of the months before; vehicles that it lacks
    begin anew. Adds ``charging``, ``joined`` (the month's first session continues the
    tail) and, in sessions, ``_tail``, the row before of the session, over the border too."""
    w = Window.partitionBy(*KEYS).orderBy("minute")
    b = before.select(F.col("vehicle_id").alias("_v"), F.col("last_soc").alias("_soc0"), F.col("n_sessions").alias("_n0"), F.col("tail").alias("_tail0"))
    rows = curated.join(b, F.col("vehicle_id") == F.col("_v"), "left").drop("_v")
    first = F.row_number().over(w) == 1
    rows = rows.withColumn("dsoc", F.col("soc") - F.when(first, F.col("_soc0")).otherwise(F.lag("soc").over(w)))
    month = Window.partitionBy(*KEYS)
    rising = F.median(F.when(F.col("dsoc") > 0, F.col("current"))).over(month)
    rows = rows.withColumn("sign", sign_of(rising, together(month)))
    rows = split_sessions(rows.withColumn("charging", charge_mask(settings)), settings)
    head = F.min(F.when(F.col("charging"), F.col("minute"))).over(month)
    near = seconds_between(head, F.col("_tail0.minute")) <= settings.session_gap_min * 60
    rows = rows.withColumn("joined", F.coalesce(near, F.lit(False)))
    own = F.struct("minute", "soc", _temp().alias("temp"), _power("master").alias("kw_m"), _power("slave").alias("kw_s"))
    in_session = Window.partitionBy(*SESSION).orderBy("minute")
    seam = F.when(F.col("joined") & (F.col("session_id") == 1), F.col("_tail0"))
    rows = rows.withColumn("_tail", F.when(F.col("charging"), F.coalesce(F.lag(own).over(in_session), seam)))
    counted = F.col("session_id") + F.coalesce("_n0", F.lit(0)) - F.col("joined").cast("long")
    return rows.withColumn("session_id", counted).drop("_soc0", "_n0", "_tail0")


def next_border(month: DataFrame, before: DataFrame) -> DataFrame:
    """The border behind a month of ``month_sessions``; vehicles without rows in it keep theirs."""
    tail = F.struct("minute", "soc", _temp().alias("temp"), _power("master").alias("kw_m"), _power("slave").alias("kw_s"))
    own = month.groupBy("vehicle_id").agg(
        F.max_by("soc", "minute").alias("_soc"),
        F.max("session_id").alias("_n"),
        F.max_by(tail, F.when(F.col("charging"), F.col("minute"))).alias("_tail"),
        F.lit(True).alias("_here"),
    )
    both = before.join(own, "vehicle_id", "full")
    return both.select(
        "vehicle_id",
        F.when(F.col("_here"), F.col("_soc")).otherwise(F.col("last_soc")).alias("last_soc"),
        F.coalesce("_n", "n_sessions", F.lit(0)).cast("long").alias("n_sessions"),
        F.coalesce("_tail", "tail").alias("tail"),
    )


def month_pieces(month: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """A row for each session's part in the month: sums that add up over months. The
    step from the month before counts to the part that it leads to. ``amps``, the
    absolute currents from which a median over months is taken, are kept of the
    month's first and last session alone, the only ones that may go on."""
    rows = month.filter("charging").withColumn("_amps", F.abs("current"))
    dt = F.least(F.greatest(F.coalesce(seconds_between(F.col("minute"), F.col("_tail.minute")), F.lit(0.0)), F.lit(0.0)), F.lit(float(settings.max_dt_s)))
    areas = {}
    for k, now, then in (("m", _power("master"), F.col("_tail.kw_m")), ("s", _power("slave"), F.col("_tail.kw_s")), ("p", _power("master") + _power("slave"), F.col("_tail.kw_m") + F.col("_tail.kw_s"))):
        areas[f"_area_{k}"] = (now + F.coalesce(then, F.lit(0.0))) / 2 * dt
    rows = rows.withColumns(areas)
    found = rows.groupBy(*SESSION).agg(
        F.count(F.lit(1)).alias("n_minutes"),
        F.min("minute").alias("first_minute"),
        F.max("minute").alias("last_minute"),
        F.min_by("soc", "minute").alias("first_soc"),
        F.max_by("soc", "minute").alias("last_soc"),
        F.sum(F.col("idle").cast("int")).alias("n_idle"),
        F.count("idle").alias("n_idle_known"),
        *[F.sum(f"_area_{k}").alias(f"area_{k}") for k in "msp"],
        F.sum(_power("master") + _power("slave")).alias("sum_kw"),
        F.median("_amps").alias("median_amps"),
        F.array_agg("_amps").alias("amps"),
    )
    w = Window.partitionBy(*KEYS)
    edge = (F.col("session_id") == F.min("session_id").over(w)) | (F.col("session_id") == F.max("session_id").over(w))
    return found.withColumn("amps", F.when(edge, F.col("amps")))


def merged_quality(pieces: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per session over all months, as ``session_quality`` and ``session_energy``
    have it of a month; ``started``, ``ended``."""
    amps = F.array_sort(F.flatten(F.collect_list("amps")))
    n = F.size("_amps")
    middle = (F.try_element_at("_amps", F.floor((n + 1) / 2).cast("int")) + F.try_element_at("_amps", F.floor(n / 2).cast("int") + 1)) / 2
    sums = pieces.groupBy("vehicle_id", "session_id").agg(
        F.sum("n_minutes").alias("n_minutes"),
        F.min("first_minute").alias("started"),
        F.max("last_minute").alias("ended"),
        (F.max_by("last_soc", "last_minute") - F.min_by("first_soc", "first_minute")).alias("delta_soc"),
        (F.sum("n_idle") / F.sum("n_idle_known")).alias("idle_frac"),
        F.count(F.lit(1)).alias("n_months"),
        F.max("median_amps").alias("_median"),
        amps.alias("_amps"),
        *[(F.abs(F.sum(f"area_{k}")) / 3600).alias(name) for k, name in (("m", "energy_master_kwh"), ("s", "energy_slave_kwh"), ("p", "total_energy_kwh"))],
        (F.sum("sum_kw") / F.sum("n_minutes")).alias("mean_pack_kw"),
    )
    found = sums.withColumns({"duration_min": seconds_between(F.col("ended"), F.col("started")) / 60, "median_abs_current": F.when(F.col("n_months") == 1, F.col("_median")).otherwise(middle)})
    return with_reasons(found.drop("_median", "_amps"), settings)


def rct_across(months: DataFrame, quality: DataFrame) -> DataFrame:
    """Labelled minutes of the given months: time since the session's start and to its
    end, wherever in other months these are. Only rows that are asked for are read;
    ``quality`` has a row a session."""
    span = quality.select(F.col("vehicle_id").alias("_v"), F.col("session_id").alias("_s"), "started", "ended")
    rows = months.filter("charging").join(span, (F.col("vehicle_id") == F.col("_v")) & (F.col("session_id") == F.col("_s"))).drop("_v", "_s")
    dt = seconds_between(F.col("minute"), F.col("_tail.minute")) / 60
    dt = F.when(dt == 0, 1.0).otherwise(dt)
    rows = rows.withColumns(
        {
            "soc_rate_per_min": (F.col("soc") - F.col("_tail.soc")) / dt,
            "temp_rise_rate": (_temp() - F.col("_tail.temp")) / dt,
            "elapsed_min": seconds_between(F.col("minute"), F.col("started")) / 60,
            "rct_minutes": seconds_between(F.col("ended"), F.col("minute")) / 60,
            "slave_power_kw": F.col("voltage_slave") * F.col("current_slave") / 1000,
            "soc_delta_to_full": 100 - F.col("soc"),
        }
    )
    return rows.filter("rct_minutes > 0").drop("_tail", "started", "ended").withColumnRenamed("minute", "timestamp_local")


def append_month(curated: DataFrame, path: str, month: str, after: str | None = None, settings: Settings = DEFAULTS) -> None:
    """Adds a month to the tables under ``path``: ``minutes``, ``pieces``, ``borders``, a
    partition each. ``after`` is the month whose border it begins with (None for the
    first): that partition is all that is read of what was there. A rerun of the last
    month replaces it; an older month's rerun needs the later ones run again."""
    spark = curated.sparkSession
    before = spark.read.schema(BORDER).parquet(f"{path}/borders/yyyymm={after}") if after else no_border(spark)
    rows = month_sessions(curated.filter(F.col("yyyymm") == month), before, settings)
    write_monthly(rows, f"{path}/minutes", months=[month])
    done = spark.read.schema(rows.schema).parquet(f"{path}/minutes").filter(F.col("yyyymm") == month) if exists(spark, f"{path}/minutes") else rows
    write_monthly(month_pieces(done, settings), f"{path}/pieces", months=[month])
    write_monthly(next_border(done, before).withColumn("yyyymm", F.lit(month)), f"{path}/borders", months=[month])


def across_months(curated: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Curated minutes with ``session_id`` counted by vehicle, sessions going on over
    month ends: the same by windows over each vehicle's whole time. For tables that
    are worked on at once; ``append_month`` gives the same month by month."""
    w = Window.partitionBy("vehicle_id").orderBy("minute")
    rows = curated.withColumn("dsoc", F.col("soc") - F.lag("soc").over(w))
    month = Window.partitionBy(*KEYS)
    rising = F.median(F.when(F.col("dsoc") > 0, F.col("current"))).over(month)
    rows = rows.withColumn("sign", sign_of(rising, together(month)))
    return split_sessions(rows.withColumn("charging", charge_mask(settings)), settings, ["vehicle_id"])


#: Sessions over all months, in DuckDB, from curated rows; the sign stays that of the month.
SQL = """
xd AS (SELECT *, soc - lag(soc) OVER (PARTITION BY vehicle_id ORDER BY minute) AS dsoc FROM moved),
xsign AS (SELECT vehicle_id, yyyymm, CASE WHEN md IS NULL THEN CASE WHEN NOT isnan(co) AND co > 0 THEN -1 ELSE 1 END WHEN md > 0 THEN -1 ELSE 1 END AS sign
  FROM (SELECT vehicle_id, yyyymm, median(current) FILTER (dsoc > 0) AS md, corr(coalesce(current, 0), coalesce(dsoc, 0)) AS co FROM xd GROUP BY ALL)),
xmask AS (SELECT xd.*, coalesce(sign * current < 0 AND abs(current) BETWEEN 6 AND 350 AND voltage > 300 AND coalesce(dsoc, 0) >= -0.05, false) AS charging FROM xd JOIN xsign USING (vehicle_id, yyyymm)),
xcharge AS (SELECT *, lag(minute) OVER (PARTITION BY vehicle_id ORDER BY minute) AS pm0 FROM xmask WHERE charging),
xsess AS (SELECT *, count(*) FILTER (pm0 IS NULL OR minute - pm0 > INTERVAL 10 MINUTE) OVER (PARTITION BY vehicle_id ORDER BY minute ROWS UNBOUNDED PRECEDING)::BIGINT AS session_id FROM xcharge),
xrow AS (SELECT *, coalesce(cell_temp, bms_temp) AS temp, coalesce(voltage_master * current_master / 1000, 0) AS km_, coalesce(voltage_slave * current_slave / 1000, 0) AS ks_ FROM xsess),
xlag AS (SELECT *, epoch_us(minute) - epoch_us(lag(minute) OVER v) AS us, lag(soc) OVER v AS soc0, lag(temp) OVER v AS temp0, coalesce(lag(km_) OVER v, 0) AS km0_, coalesce(lag(ks_) OVER v, 0) AS ks0_,
  min(minute) OVER (PARTITION BY vehicle_id, session_id) AS started, max(minute) OVER (PARTITION BY vehicle_id, session_id) AS ended FROM xrow WINDOW v AS (PARTITION BY vehicle_id, session_id ORDER BY minute)),
xq AS (SELECT vehicle_id, session_id, count(*) AS n_minutes, max(started) AS started, max(ended) AS ended, (epoch_us(max(ended)) - epoch_us(max(started))) / 60e6 AS duration_min,
  max(soc) FILTER (minute = ended) - max(soc) FILTER (minute = started) AS delta_soc, avg(idle::INT) AS idle_frac, median(abs(current)) AS median_abs_current,
  abs(sum((km_ + km0_) / 2 * least(coalesce(us, 0) / 1e6, 180))) / 3600 AS energy_master_kwh, abs(sum((ks_ + ks0_) / 2 * least(coalesce(us, 0) / 1e6, 180))) / 3600 AS energy_slave_kwh,
  abs(sum((km_ + ks_ + km0_ + ks0_) / 2 * least(coalesce(us, 0) / 1e6, 180))) / 3600 AS total_energy_kwh, avg(km_ + ks_) AS mean_pack_kw FROM xlag GROUP BY vehicle_id, session_id)"""
