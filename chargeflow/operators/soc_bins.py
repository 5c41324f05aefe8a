"""Which range of current prevailed in each band of charge, and how long bands take."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import bin4_label, bucket_label, current_bin4, current_bucket, seconds_between, soc_band10, soc_floor
from ..settings import CURRENT_EDGES, DEFAULTS, SESSION, Settings


def soc_modal_buckets(minutes: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Per session and band of charge: minutes, the prevailing range of current
    (the lowest of equal ones), its minutes and share, median and mean |A|.

    ``minutes`` are session minutes with ``sign``. A minute weighs the time since
    the row before, 1 s to ``max_dt_s``; only minutes of the charging sign count.
    """
    w = Window.partitionBy(*SESSION).orderBy("minute")
    step = F.coalesce(seconds_between(F.col("minute"), F.lag("minute").over(w)), F.lit(0.0))
    rows = minutes.filter("session_id is not null").withColumn("dt_min", F.least(F.greatest(step, F.lit(1.0)), F.lit(settings.max_dt_s)) / 60)
    amps = F.abs("current")
    rows = rows.filter((F.col("sign") * F.col("current") < 0) & (amps <= float(CURRENT_EDGES[-1])) & F.col("soc").isNotNull())
    rows = rows.withColumns({"soc_lo": soc_floor(F.col("soc"), settings.soc_step).cast("double"), "bucket": current_bucket(F.col("current")), "amps": amps})
    keys = [*SESSION, "soc_lo"]
    # One pass: minutes by bucket first, with what the bands' own figures need.
    by_bucket = rows.groupBy(*keys, "bucket").agg(F.sum("dt_min").alias("m"), F.collect_list("amps").alias("a"))
    known = F.col("bucket").isNotNull()
    band = by_bucket.groupBy(*keys).agg(
        F.sum(F.when(known, F.col("m"))).alias("minutes_total"),
        F.max(F.when(known, F.struct("m", (-F.col("bucket")).alias("b")))).alias("top"),
        F.array_sort(F.flatten(F.collect_list("a"))).alias("a"),
    )
    n = F.size("a")
    median = (F.element_at("a", F.floor((n + 1) / 2).cast("int")) + F.element_at("a", F.floor(n / 2).cast("int") + 1)) / 2
    mean = F.aggregate("a", F.lit(0.0), lambda x, y: x + y) / n
    return band.filter("minutes_total is not null").select(
        *keys,
        (F.col("soc_lo") + max(0.1, settings.soc_step)).alias("soc_hi"),
        "minutes_total",
        bucket_label(-F.col("top.b")).alias("mode_bucket"),
        F.col("top.m").alias("mode_minutes"),
        (F.col("top.m") / F.col("minutes_total")).alias("confidence"),
        median.alias("median_abs_current"),
        mean.alias("mean_abs_current"),
    )


def confidence_summary(intervals: DataFrame) -> DataFrame:
    """Mean share of the prevailing range; unknown counts 0."""
    return intervals.agg(F.avg(F.coalesce("confidence", F.lit(0.0))).alias("mean_confidence"), F.count(F.lit(1)).alias("n"))


def soc_current_lookup(rct: DataFrame) -> DataFrame:
    """Per ten-percent band and coarse range of current: median minutes that
    sessions spent in the band at that mean current, and their number."""
    rows = rct.withColumn("soc_lo", soc_band10(F.col("soc"))).filter("soc_lo is not null and current is not null")
    per = rows.groupBy(*SESSION, "soc_lo").agg(F.count(F.lit(1)).alias("minutes"), F.avg(F.abs("current")).alias("amps"))
    per = per.withColumn("bin", current_bin4(F.col("amps")))
    return per.groupBy("soc_lo", "bin").agg(F.median("minutes").alias("avg_minutes"), F.count(F.lit(1)).alias("n_sessions"))


def complete_grid(lookup: DataFrame, bins: int = 4) -> DataFrame:
    """All pairs of a band that occurs and a range; missing ones have no minutes and no sessions."""
    spark = lookup.sparkSession
    grid = lookup.select("soc_lo").distinct().crossJoin(F.broadcast(spark.range(bins).select(F.col("id").cast("int").alias("bin"))))
    out = grid.join(lookup, ["soc_lo", "bin"], "left")
    return out.select("soc_lo", "bin", bin4_label(F.col("bin")).alias("current_bin"), "avg_minutes", F.coalesce("n_sessions", F.lit(0)).alias("n_sessions"))


def lookup_minutes(requests: DataFrame, lookup: DataFrame) -> DataFrame:
    """For each request (``request_id``, ``soc_from``, ``soc_to``, ``amps``) the sum of
    the lookup's minutes over the ten-percent bands between; bands that the
    lookup lacks are passed over; null if it has none of them."""
    first = F.floor(F.col("soc_from") / 10) * 10
    last = F.ceil(F.col("soc_to") / 10) * 10 - 10
    bands = F.when(first <= last, F.sequence(first.cast("int"), last.cast("int"), F.lit(10)))
    rows = requests.withColumns({"soc_lo": F.explode_outer(bands), "bin": current_bin4(F.col("amps"))})
    return rows.join(lookup, ["soc_lo", "bin"], "left").groupBy("request_id").agg(F.sum("avg_minutes").alias("minutes"))


SQL_BINS = """
timed AS (SELECT *, least(greatest(coalesce((epoch_us(minute) - epoch_us(lag(minute) OVER (PARTITION BY vehicle_id, yyyymm, session_id ORDER BY minute))) / 1e6, 0), 1), 180) / 60 AS dt_min FROM gated),
binned AS (SELECT vehicle_id, yyyymm, session_id, floor(soc / 5) * 5 AS soc_lo, abs(current) AS amps, dt_min,
    CASE WHEN abs(current) >= 1000 THEN NULL WHEN abs(current) >= 200 THEN 7 WHEN abs(current) >= 80 THEN 6 WHEN abs(current) >= 40 THEN 5 WHEN abs(current) >= 20 THEN 4 WHEN abs(current) >= 10 THEN 3 WHEN abs(current) >= 5 THEN 2 WHEN abs(current) >= 1 THEN 1 ELSE 0 END AS bucket
  FROM timed WHERE sign * current < 0 AND abs(current) <= 1000 AND soc IS NOT NULL),
bymode AS (SELECT vehicle_id, yyyymm, session_id, soc_lo, bucket, sum(dt_min) AS m FROM binned WHERE bucket IS NOT NULL GROUP BY ALL),
modes AS (SELECT *, sum(m) OVER v AS minutes_total, row_number() OVER (PARTITION BY vehicle_id, yyyymm, session_id, soc_lo ORDER BY round(m, 9) DESC, bucket) AS n FROM bymode WINDOW v AS (PARTITION BY vehicle_id, yyyymm, session_id, soc_lo)),
figures AS (SELECT vehicle_id, yyyymm, session_id, soc_lo, median(amps) AS median_abs_current, avg(amps) AS mean_abs_current FROM binned GROUP BY ALL),
soc_intervals AS (SELECT m.vehicle_id, m.yyyymm, m.session_id, m.soc_lo, m.soc_lo + 5 AS soc_hi, minutes_total, ['0–1 A','1–5 A','5–10 A','10–20 A','20–40 A','40–80 A','80–200 A','200+ A'][bucket + 1] AS mode_bucket,
    m.m AS mode_minutes, m.m / minutes_total AS confidence, median_abs_current, mean_abs_current
  FROM modes m JOIN figures f USING (vehicle_id, yyyymm, session_id, soc_lo) WHERE n = 1)"""

SQL_LOOKUP = """
perband AS (SELECT vehicle_id, yyyymm, session_id, (floor(least(greatest(soc, 0), 100) / 10) * 10)::INT AS soc_lo, count(*) AS minutes, avg(abs(current)) AS amps
  FROM rct WHERE soc < 100 AND current IS NOT NULL GROUP BY ALL),
lookup AS (SELECT soc_lo, CASE WHEN amps <= 1 THEN 0 WHEN amps <= 5 THEN 1 WHEN amps <= 10 THEN 2 ELSE 3 END AS bin, median(minutes) AS avg_minutes, count(*) AS n_sessions FROM perband GROUP BY ALL)"""
