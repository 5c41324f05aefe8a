"""Overlapping bands of charge: when a session passes each percent, how long a
band takes, at which current; pivots and a time estimator on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import bucket_label, bucket_middle, current_bucket, range_labels, seconds_between
from ..settings import CURRENT_EDGES, SESSION
from ..storage import written
from .sessions import sign_of, together

#: The current of each series; that of the pack is the one that ``charging_rows`` chose.
SERIES = {"pack": "i_eff", "master": "current_master", "slave": "current_slave"}
#: Where the pack's current comes from: the first of these that the table has.
SOURCES = ("current", "current_master", "current_slave")


def charging_rows(rct: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows at which any unit or the pack charges, by the sign of the current that
    the vehicle's charge rises with; adds ``sign`` and ``i_eff``, the current of
    the pack, else of the master, else of the slave (by which the table has)."""
    keys = keys or ["vehicle_id"]
    order = Window.partitionBy(*keys).orderBy("yyyymm", "session_id", "timestamp_local")
    rows = rct.withColumn("_ds", F.col("soc") - F.lag("soc").over(order))
    whole = Window.partitionBy(*keys)
    have = [c for c in SOURCES if c in rct.columns]
    rising = F.median(F.when(F.col("_ds") > 0, F.col(have[0]))).over(whole)
    rows = rows.withColumn("sign", sign_of(rising, together(whole, "_ds", have[0])))
    charging = F.lit(False)
    for c in have:
        charging = charging | F.coalesce(F.col("sign") * F.col(c) < 0, F.lit(False))
    return rows.filter(charging).withColumn("i_eff", F.col(have[0])).drop("_ds")


def minutes_in_session(rows: DataFrame) -> DataFrame:
    """Adds ``tmin``, minutes since the session's first row."""
    first = F.min("timestamp_local").over(Window.partitionBy(*SESSION))
    return rows.withColumn("tmin", seconds_between(F.col("timestamp_local"), first) / 60)


def time_at_soc(rows: DataFrame) -> DataFrame:
    """``soc_at``, ``t_at`` for each whole percent that a session's charge covers:
    linear between samples of its running maximum, of equal ones the first.

    Each pair of neighbours explodes into the percents between them; a session
    has at most 101, whatever its number of rows.
    """
    w = Window.partitionBy(*SESSION).orderBy("tmin")
    mono = rows.filter("soc is not null").select(*SESSION, "tmin", F.max("soc").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    before = F.lag("s").over(w)
    mono = mono.withColumn("_b", before).filter("_b is null or s - _b > 1e-9")
    pairs = mono.select(*SESSION, "tmin", "s", F.lag("tmin").over(w).alias("t0"), F.lag("s").over(w).alias("s0"))
    # A segment (s0, s]; a session's first sample is a segment of one point.
    low = F.when(F.col("s0").isNull(), F.ceil("s")).otherwise(F.floor("s0") + 1).cast("int")
    high = F.floor("s").cast("int")
    points = pairs.withColumn("soc_at", F.explode(F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))))
    slope = F.col("t0") + (F.col("tmin") - F.col("t0")) * (F.col("soc_at") - F.col("s0")) / (F.col("s") - F.col("s0"))
    return points.select(*SESSION, "soc_at", F.when(F.col("s0").isNull(), F.col("tmin")).otherwise(slope).alias("t_at"))


def sliding_soc_bands(rows: DataFrame, band: int = 5, min_minutes: float = 0.5) -> DataFrame:
    """``soc_start``, ``soc_end``, ``t0``, ``t1``, ``minutes_total`` of each band of
    ``band`` percent, one beginning at every percent, that a session of at least
    three rows passes in ``min_minutes`` or more."""
    whole = Window.partitionBy(*SESSION)
    at = time_at_soc(rows.filter("soc is not null").withColumn("_rows", F.count(F.lit(1)).over(whole)).filter("_rows >= 3").drop("_rows"))
    # The end of a band is the row ``band`` percent on in the same session: no self-join.
    w = Window.partitionBy(*SESSION).orderBy("soc_at").rangeBetween(band, band)
    out = at.select(*SESSION, F.col("soc_at").alias("soc_start"), (F.col("soc_at") + band).alias("soc_end"), F.col("t_at").alias("t0"), F.max("t_at").over(w).alias("t1"))
    return out.withColumn("minutes_total", F.col("t1") - F.col("t0")).filter(F.col("minutes_total") >= min_minutes)


def _with_level(rows: DataFrame) -> DataFrame:
    """Adds ``_level``, the whole percents below the charge at each row's time on the line
    of ``time_at_soc``: between the first times of two values of the running maximum.
    A band is open at that time only if it begins at or below, and ends at or above it."""
    w = Window.partitionBy(*SESSION).orderBy("tmin")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_s", F.max("soc").over(upto))
    before = F.lag("_s").over(w)
    rows = rows.withColumn("_knot", F.when(before.isNull() | (F.col("_s") - before > 1e-9), F.struct(F.col("tmin").alias("t"), F.col("_s").alias("s"))))
    later = Window.partitionBy(*SESSION).orderBy(F.desc("tmin")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"_k0": F.last("_knot", True).over(upto), "_k1": F.last("_knot", True).over(later)})
    a, b = F.col("_k0"), F.col("_k1")
    along = a["s"] + (b["s"] - a["s"]) * F.coalesce(F.try_divide(F.col("tmin") - a["t"], b["t"] - a["t"]), F.lit(1.0))
    return rows.withColumn("_level", F.floor(F.coalesce(along, a["s"])).cast("int")).drop("_s", "_knot", "_k0", "_k1", "soc")


def band_current_stats(bands: DataFrame, rows: DataFrame, edges=CURRENT_EDGES, band: int = 5) -> DataFrame:
    """For each band and series (pack, master, slave): ``bucket``, ``confidence``,
    ``mean_abs_current``, ``median_abs_current`` within its time.

    Currents hold between neighbouring samples inside the band at their mean,
    for the time between; the first and last sample of the session's series
    reach to the band's ends. Shares are of the time covered so; the median is
    the first current at which half of it is passed. One sample alone: its own
    value. No time between: plain mean and median, no share. No sample: nulls.

    A sample goes to those bands alone that begin below and end above the charge at
    its time (``band`` + 3, for the edges), and there meets the band's row, which brings the band's times and the
    first and last sample of each series: one shuffle by session and band.
    """
    keys, of_band = [*SESSION, "series"], [*SESSION, "soc_start"]
    figures = ["soc_start", "soc_end", "t0", "t1", "minutes_total"]
    series = {n: (F.abs(F.col(c)) if c in rows.columns else F.lit(None)).cast("double").alias(n) for n, c in SERIES.items()}
    known = rows.filter("soc is not null")
    samples = _with_level(known.select(*SESSION, "tmin", "soc", *series.values()))
    starts = F.sequence(F.col("_level") - band - 1, F.col("_level") + 1)
    # Of samples at one time the one of least current is first, and last.
    end = lambda n, back: F.min(F.when(F.col(n).isNotNull(), F.struct((-F.col("tmin") if back else F.col("tmin")).alias("t"), F.col(n).alias("a"))))
    ends = samples.groupBy(*SESSION).agg(*[F.struct(end(n, False).alias("first"), end(n, True).alias("last")).alias(f"_{n}") for n in SERIES])
    mark = F.struct(*figures[1:], *[f"_{n}" for n in SERIES]).alias("_band")
    marks = bands.join(ends, SESSION, "left").select(*of_band, mark)
    # Rows grow where they are read: adaptive execution, which joins partitions by the bytes read,
    # would leave it too few tasks, a number given here does not.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mixed = samples.select(*SESSION, F.explode(starts).alias("soc_start"), "tmin", *SERIES).unionByName(marks, allowMissingColumns=True).repartition(parts, *of_band)
    mixed = mixed.withColumns({"_mark": F.col("_band").isNotNull(), "_band": F.first("_band", True).over(Window.partitionBy(*of_band))}).filter("_band is not null")
    t0, t1, none = F.col("_band.t0"), F.col("_band.t1"), F.lit(None).cast("double")
    point = lambda n, at, amps: F.struct(F.lit(n).alias("series"), at.alias("tmin"), amps.alias("amps"))
    found = []
    for n in SERIES:
        first, last = F.col(f"_band._{n}.first"), F.col(f"_band._{n}.last")
        found += [
            F.when(~F.col("_mark") & F.col(n).isNotNull() & F.col("tmin").between(t0, t1), point(n, F.col("tmin"), F.col(n))),
            F.when(F.col("_mark") & (t0 < first["t"]), point(n, t0, first["a"])),
            F.when(F.col("_mark") & (t1 > -last["t"]), point(n, t1, last["a"])),
            # So that each band has a row, whatever is known of its currents.
            F.when(F.col("_mark"), point(n, none, none)),
        ]
    points = mixed.select(*of_band, *[F.col(f"_band.{f}").alias(f) for f in figures[1:]], F.explode(F.array_compact(F.array(*found))).alias("p"))
    points = points.select(*SESSION, *figures, "p.series", "p.tmin", "p.amps")
    slice_ = [*keys, *figures]
    of_slice = [*keys, "soc_start"]
    w = Window.partitionBy(*of_slice).orderBy("tmin", "amps")
    points = points.withColumns({"dt": F.col("tmin") - F.lag("tmin").over(w), "mid": (F.col("amps") + F.lag("amps").over(w)) / 2})
    points = points.withColumn("bucket", current_bucket(F.col("mid"), edges, "clip"))
    whole = Window.partitionBy(*of_slice)
    points = points.withColumns({"dur": F.coalesce(F.sum("dt").over(whole), F.lit(0.0)), "n": F.count("amps").over(whole)})
    upto = F.sum("dt").over(Window.partitionBy(*of_slice).orderBy("mid", "tmin").rowsBetween(Window.unboundedPreceding, 0))
    points = points.withColumn("passed", upto / F.when(F.col("dur") > 0, F.col("dur")))
    by_bucket = points.groupBy(*slice_, "bucket").agg(
        F.sum("dt").alias("m"), F.sum(F.col("mid") * F.col("dt")).alias("weighted"), F.max("dur").alias("dur"), F.max("n").alias("n"), F.sum("amps").alias("amps"),
        F.min(F.when(F.col("dt").isNotNull() & (F.round("passed", 9) >= 0.5), F.col("mid"))).alias("half"),
        # Values are wanted only where no time passes between them.
        F.collect_list(F.when(F.col("dur") == 0, F.col("amps"))).alias("all"),
    )
    top = F.max(F.when(F.col("m").isNotNull(), F.struct(F.round("m", 9).alias("r"), (-F.col("bucket")).alias("b"), "m")))
    slices = by_bucket.groupBy(*slice_).agg(
        top.alias("top"), F.sum("weighted").alias("weighted"), F.max("dur").alias("dur"), F.max("n").alias("n"), F.sum("amps").alias("amps"),
        F.min("half").alias("half"), F.array_sort(F.flatten(F.collect_list("all"))).alias("all"),
    )
    k = F.size("all")
    plain = (F.get("all", F.floor((k - 1) / 2).cast("int")) + F.get("all", F.floor(k / 2).cast("int"))) / 2
    moving, one = F.col("dur") > 0, F.col("n") == 1
    bucket = F.when(moving, -F.col("top.b")).when(one, current_bucket(F.col("amps"), edges, "clip")).otherwise(0)
    return slices.select(
        *slice_,
        bucket.alias("bucket"),
        F.when(moving, F.col("top.m") / F.col("dur")).when(one, 1.0).otherwise(0.0).alias("confidence"),
        F.when(moving, F.col("weighted") / F.col("dur")).when(F.col("n") > 0, F.col("amps") / F.col("n")).alias("mean_abs_current"),
        F.when(moving, F.col("half")).otherwise(plain).alias("median_abs_current"),
        bucket_label(bucket, edges).alias("label"),
    )


def interval_samples(rct: DataFrame, band: int = 5, min_minutes: float = 0.5) -> DataFrame:
    """Bands and their current figures of all sessions of a labelled table. The
    charging rows are written once: bands and figures read that table."""
    charging = minutes_in_session(charging_rows(rct))
    rows = written(charging.select(*SESSION, "timestamp_local", "soc", "tmin", *[c for c in SERIES.values() if c in charging.columns]))
    return band_current_stats(sliding_soc_bands(rows, band, min_minutes), rows, band=band)


def interval_pivots(stats: DataFrame) -> DataFrame:
    """Mean minutes by series, band and prevailing range, one row each."""
    return stats.groupBy("series", "soc_start", "bucket").agg(F.avg("minutes_total").alias("mean_minutes"), F.count(F.lit(1)).alias("n"))


def interval_pivot(stats: DataFrame, series: str = "pack") -> DataFrame:
    """Those of one series."""
    return interval_pivots(stats.filter(F.col("series") == series)).drop("series")


def pivot_wide(pivot: DataFrame, edges=CURRENT_EDGES) -> DataFrame:
    """The same as one row a band (of each series, where there are several), with a
    column for each range, whether it occurs or not (for output)."""
    by = [c for c in ("series", "soc_start") if c in pivot.columns]
    cells = [F.max(F.when(F.col("bucket") == i, F.col("mean_minutes"))).alias(name) for i, name in enumerate(range_labels(edges))]
    return pivot.groupBy(*by).agg(*cells)


def estimator_params(pivot: DataFrame, band: int = 5) -> tuple[DataFrame, DataFrame]:
    """Mean over a band's cells, each the same; and over the bands, a percent."""
    means = pivot.groupBy("soc_start").agg(F.avg("mean_minutes").alias("band_minutes"))
    return means, means.agg(F.coalesce(F.avg("band_minutes") / band, F.lit(1.0)).alias("minutes_per_percent"))


def nearest_bucket(amps: Column, used: Column, edges=CURRENT_EDGES) -> Column:
    """The range among those in the array ``used`` whose middle is nearest; the lower of two."""
    pairs = F.transform(used, lambda b: F.struct(F.abs(bucket_middle(b, edges) - F.abs(amps)).alias("d"), b.alias("b")))
    return F.when(amps.isNotNull(), F.array_min(pairs)["b"])


def estimate_remaining_time(requests: DataFrame, pivot: DataFrame, band: int = 5) -> DataFrame:
    """``minutes`` for each request (``request_id``, ``cur_soc``, ``tgt_soc``, ``amps``):
    the sum over bands from current to target charge of the cell's mean, else
    the band's, else the global mean; 0 if the target is reached."""
    pivot = written(pivot)  # small, and used four times
    means, per = estimator_params(pivot, band)
    first, last = F.floor(F.col("cur_soc") / band) * band, F.floor(F.col("tgt_soc") / band) * band - band
    starts = F.when((F.col("tgt_soc") > F.col("cur_soc")) & (first <= last), F.sequence(first.cast("int"), last.cast("int"), F.lit(band)))
    used = pivot.agg(F.array_sort(F.collect_set("bucket")).alias("_used"))  # a row, a range each at most
    rows = requests.crossJoin(F.broadcast(used)).withColumns({"soc_start": F.explode_outer(starts), "bucket": nearest_bucket(F.col("amps"), F.col("_used"))})
    rows = rows.join(pivot.select("soc_start", "bucket", "mean_minutes"), ["soc_start", "bucket"], "left").join(means, "soc_start", "left").crossJoin(F.broadcast(per))
    cell = F.when(F.col("soc_start").isNull(), 0.0).otherwise(F.coalesce("mean_minutes", "band_minutes", F.col("minutes_per_percent") * band))
    return rows.groupBy("request_id").agg(F.sum(cell).alias("minutes"))


SQL = """
csign0 AS (SELECT *, soc - lag(soc) OVER (PARTITION BY vehicle_id ORDER BY yyyymm, session_id, timestamp_local) AS ds2 FROM rct),
csign1 AS (SELECT vehicle_id, median(CASE WHEN ds2 > 0 THEN current END) AS md2, corr(coalesce(current, 0), coalesce(ds2, 0)) AS co2 FROM csign0 GROUP BY ALL),
charging AS (SELECT * EXCLUDE (sign, ds2, md2, co2), CASE WHEN md2 IS NULL THEN CASE WHEN NOT isnan(co2) AND co2 > 0 THEN -1 ELSE 1 END WHEN md2 > 0 THEN -1 ELSE 1 END AS sign FROM csign0 JOIN csign1 USING (vehicle_id)),
crows AS (SELECT *, (epoch_us(timestamp_local) - epoch_us(min(timestamp_local) OVER (PARTITION BY vehicle_id, yyyymm, session_id))) / 60e6 AS tmin FROM charging
  WHERE coalesce(sign * current < 0, false) OR coalesce(sign * current_master < 0, false) OR coalesce(sign * current_slave < 0, false)),
mono0 AS (SELECT vehicle_id, yyyymm, session_id, tmin, max(soc) OVER (PARTITION BY vehicle_id, yyyymm, session_id ORDER BY tmin) AS s FROM crows WHERE soc IS NOT NULL),
mono AS (SELECT * FROM (SELECT *, lag(s) OVER (PARTITION BY vehicle_id, yyyymm, session_id ORDER BY tmin) AS b FROM mono0) WHERE b IS NULL OR s - b > 1e-9),
segs AS (SELECT *, lag(tmin) OVER w AS t0, lag(s) OVER w AS s0 FROM mono WINDOW w AS (PARTITION BY vehicle_id, yyyymm, session_id ORDER BY tmin)),
attimes AS (SELECT g.vehicle_id, g.yyyymm, g.session_id, p.x::INT AS soc_at, CASE WHEN s0 IS NULL THEN tmin ELSE t0 + (tmin - t0) * (p.x - s0) / (s - s0) END AS t_at
  FROM segs g JOIN range(0, 101) p(x) ON (s0 IS NULL AND p.x = s) OR (p.x > s0 AND p.x <= s)),
enough AS (SELECT vehicle_id, yyyymm, session_id FROM crows WHERE soc IS NOT NULL GROUP BY ALL HAVING count(*) >= 3),
bands AS (SELECT a.vehicle_id, a.yyyymm, a.session_id, a.soc_at AS soc_start, b.soc_at AS soc_end, a.t_at AS t0, b.t_at AS t1, b.t_at - a.t_at AS minutes_total
  FROM attimes a JOIN attimes b ON a.vehicle_id = b.vehicle_id AND a.yyyymm = b.yyyymm AND a.session_id = b.session_id AND b.soc_at = a.soc_at + 5 JOIN enough e ON e.vehicle_id = a.vehicle_id AND e.yyyymm = a.yyyymm AND e.session_id = a.session_id
  WHERE b.t_at - a.t_at >= 0.5)"""

SQL_STATS = """
longer AS (SELECT * FROM (SELECT vehicle_id, yyyymm, session_id, tmin, 'pack' AS series, abs(current) AS amps FROM crows WHERE soc IS NOT NULL UNION ALL
  SELECT vehicle_id, yyyymm, session_id, tmin, 'master', abs(current_master) FROM crows WHERE soc IS NOT NULL UNION ALL SELECT vehicle_id, yyyymm, session_id, tmin, 'slave', abs(current_slave) FROM crows WHERE soc IS NOT NULL) WHERE amps IS NOT NULL),
spans AS (SELECT vehicle_id, yyyymm, session_id, series, arg_min(amps, tmin) AS a0, min(tmin) AS tf, arg_max(amps, tmin) AS a1, max(tmin) AS tl FROM longer GROUP BY ALL),
pts AS (SELECT vehicle_id, yyyymm, session_id, series, soc_start, tmin, amps FROM bands JOIN longer USING (vehicle_id, yyyymm, session_id) WHERE tmin BETWEEN t0 AND t1 UNION ALL
  SELECT vehicle_id, yyyymm, session_id, series, soc_start, t0, a0 FROM bands JOIN spans USING (vehicle_id, yyyymm, session_id) WHERE t0 < tf UNION ALL
  SELECT vehicle_id, yyyymm, session_id, series, soc_start, t1, a1 FROM bands JOIN spans USING (vehicle_id, yyyymm, session_id) WHERE t1 > tl),
steps AS (SELECT *, tmin - lag(tmin) OVER w AS dt, (amps + lag(amps) OVER w) / 2 AS mid FROM pts WINDOW w AS (PARTITION BY vehicle_id, yyyymm, session_id, series, soc_start ORDER BY tmin, amps)),
steps2 AS (SELECT *, CASE WHEN mid IS NULL THEN 0 WHEN mid >= 200 THEN 7 WHEN mid >= 80 THEN 6 WHEN mid >= 40 THEN 5 WHEN mid >= 20 THEN 4 WHEN mid >= 10 THEN 3 WHEN mid >= 5 THEN 2 WHEN mid >= 1 THEN 1 ELSE 0 END AS bucket,
    coalesce(sum(dt) OVER (PARTITION BY vehicle_id, yyyymm, session_id, series, soc_start), 0) AS dur,
    sum(dt) OVER (PARTITION BY vehicle_id, yyyymm, session_id, series, soc_start ORDER BY mid NULLS FIRST, tmin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM steps),
modal AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id, yyyymm, session_id, series, soc_start ORDER BY round(m, 9) DESC, bucket) AS n FROM (
  SELECT vehicle_id, yyyymm, session_id, series, soc_start, bucket, sum(dt) AS m FROM steps2 WHERE dt IS NOT NULL GROUP BY ALL)) WHERE n = 1),
slices AS (SELECT vehicle_id, yyyymm, session_id, series, soc_start, max(dur) AS dur, count(*) AS n, sum(mid * dt) AS weighted, avg(amps) AS plain_mean, median(amps) AS plain_median, max(amps) AS one,
    min(CASE WHEN dt IS NOT NULL AND dur > 0 AND round(upto / dur, 9) >= 0.5 THEN mid END) AS half FROM steps2 GROUP BY ALL),
stats AS (SELECT b.*, z.series, coalesce(CASE WHEN dur > 0 THEN m.bucket WHEN s.n = 1 THEN CASE WHEN one >= 200 THEN 7 WHEN one >= 80 THEN 6 WHEN one >= 40 THEN 5 WHEN one >= 20 THEN 4 WHEN one >= 10 THEN 3 WHEN one >= 5 THEN 2 WHEN one >= 1 THEN 1 ELSE 0 END ELSE 0 END, 0) AS bucket,
    coalesce(CASE WHEN dur > 0 THEN m.m / dur WHEN s.n = 1 THEN 1 ELSE 0 END, 0) AS confidence, CASE WHEN dur > 0 THEN weighted / dur ELSE plain_mean END AS mean_abs_current, CASE WHEN dur > 0 THEN half ELSE plain_median END AS median_abs_current
  FROM bands b CROSS JOIN (SELECT unnest(['pack', 'master', 'slave']) AS series) z LEFT JOIN slices s ON s.vehicle_id = b.vehicle_id AND s.yyyymm = b.yyyymm AND s.session_id = b.session_id AND s.soc_start = b.soc_start AND s.series = z.series
  LEFT JOIN modal m ON m.vehicle_id = b.vehicle_id AND m.yyyymm = b.yyyymm AND m.session_id = b.session_id AND m.soc_start = b.soc_start AND m.series = z.series),
pivot_pack AS (SELECT soc_start, bucket, avg(minutes_total) AS mean_minutes, count(*) AS n FROM stats WHERE series = 'pack' GROUP BY ALL),
band_means AS (SELECT soc_start, avg(mean_minutes) AS band_minutes FROM pivot_pack GROUP BY ALL),
per_percent AS (SELECT coalesce(avg(band_minutes) / 5, 1.0) AS minutes_per_percent FROM band_means)"""
