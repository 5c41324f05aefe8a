"""Queries over the sessions job: alignment, curation, sessions, labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import align, curate, features, sessions
from ..settings import KEYS, SESSION
from . import telemetry as tele

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded (off the halves, which engines round differently), others as they are."""
    return df.select(*[(F.round(F.col(c) + 1e-9, digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def samples(spark: SparkSession, d: str) -> DataFrame:
    return tele.telemetry(spark, d)


def aligned(spark: SparkSession, d: str) -> DataFrame:
    return align.align_nearest(samples(spark, d))


def curated(spark: SparkSession, d: str) -> DataFrame:
    return curate.curate(aligned(spark, d))


def sessioned(spark: SparkSession, d: str) -> DataFrame:
    return sessions.sessionize(curated(spark, d))


def gated(spark: SparkSession, d: str) -> DataFrame:
    return sessions.gate_sessions(sessioned(spark, d))


def rct(spark: SparkSession, d: str) -> DataFrame:
    return features.rct_rows(gated(spark, d))


#: Stages of the SQL, each on those before.
CHAIN = [("telemetry", tele.SQL), ("aligned", align.SQL), ("curated", curate.SQL), ("sessions", sessions.SQL), ("rct", features.SQL)]


def sql(upto: str, select: str, *more: str) -> str:
    """A WITH chain up to a stage, more stages, and the final select."""
    parts = []
    for name, text in CHAIN:
        parts.append(text.strip())
        if name == upto:
            break
    return "WITH " + ",\n".join([*parts, *[m.strip() for m in more]]) + "\n" + select


def r(*names: str) -> str:
    return ", ".join(f"round({n} + 1e-9, 6) + 0.0 AS {n}" for n in names)


ALIGNED = ["soc", "soc_master", "soc_slave", "voltage", "voltage_master", "voltage_slave", "current", "current_master", "current_slave", "speed", "cell_temp", "bms_temp", "pack_delta", "charge_limit", "discharge_limit", "km"]
CURATED = [*ALIGNED, "power_kw"]
RCT = [*CURATED, "soc_rate_per_min", "temp_rise_rate", "elapsed_min", "rct_minutes", "slave_power_kw", "soc_delta_to_full"]
K, S = ", ".join(KEYS), ", ".join(SESSION)


def _p5(spark, d):
    return rounded(aligned(spark, d).select(*KEYS, "ts_local", "soc", "voltage", "current"))


def _p6(spark, d):
    return rounded(curate.with_power_idle(curate.curate_minute(aligned(spark, d))).select(*KEYS, "minute", "power_kw", "idle"))


def _p7(spark, d):
    rows = samples(spark, d).select("seq", "current")
    scaled = F.col("current") * 2
    return rows.select(
        "seq",
        C.current_bucket(scaled).alias("bucket_null"),
        C.current_bucket(scaled, beyond="clip").alias("bucket_clip"),
        C.current_bucket(scaled, beyond="last").alias("bucket_last"),
        C.bucket_label(C.current_bucket(scaled, beyond="last")).alias("label"),
    )


def _bucket_sql(x: str, beyond: str) -> str:
    edges = [0, 1, 5, 10, 20, 40, 80, 200, 1000]
    whens = " ".join(f"WHEN abs({x}) >= {e} THEN {i}" for i, e in reversed(list(enumerate(edges[:-1]))))
    top = "NULL" if beyond == "null" else "7"
    case = f"CASE WHEN abs({x}) >= 1000 THEN {top} {whens} END"
    return f"coalesce({case}, 0)" if beyond == "clip" else case


LABELS_SQL = "[" + ", ".join(f"'{x}'" for x in C.range_labels()) + "]"


def _p8(spark, d):
    b = C.current_bin4(F.col("current") / 3)
    return samples(spark, d).select("seq", b.alias("bin"), C.bin4_label(b).alias("bin_label"))


def _p9(spark, d):
    s = F.col("soc")
    return rounded(
        samples(spark, d).select(
            "seq", C.soc_band10(s).alias("band10"), C.soc_floor(s, 5).cast("double").alias("band5"),
            C.soc_band_right(s, [20, 40, 60, 80], True).alias("band20_80"), C.soc_band_right(s, [0, 20, 40, 60, 80, 100]).alias("band20"),
        )
    )


def _p12(spark, d):
    return rounded(rct(spark, d).select(*SESSION, "timestamp_local", C.label_clip(F.col("rct_minutes") * 30).alias("label")))


def _p13(spark, d):
    m = F.col("rct_minutes") * 7.5 - 20
    return rounded(rct(spark, d).select(*SESSION, "timestamp_local", C.clip_minutes(m).alias("minutes"), C.format_minutes(m).alias("shown")))


def _p11(spark, d):
    rows = gated(spark, d).select(*SESSION).distinct()
    return rows.withColumn("session_key", C.session_key(F.col("yyyymm"), F.col("session_id")))


def _w1(spark, d):
    rows = curate.curate_minute(aligned(spark, d))
    return rounded(curate.sanitize_km(rows).select(*KEYS, "minute", "km"))


def _w3(spark, d):
    rows = rct(spark, d).select("vehicle_id", F.row_number().over(_by_time()).alias("seq"), "soc", "elapsed_min")
    return sessions.synthesize_sessions(rows, ["vehicle_id"]).select("vehicle_id", "seq", "session_id")


def _by_time():
    from pyspark.sql import Window

    return Window.partitionBy("vehicle_id").orderBy("yyyymm", "session_id", "timestamp_local")


def _k1(spark, d):
    rows = samples(spark, d).select("vehicle_id", curate.minute_of().alias("minute"), "seq", "soc")
    return rounded(features.dedupe_keep_first(rows, ["vehicle_id", "minute"], "seq"))


def _f1(spark, d):
    rows = sessions.with_charge_sign(curated(spark, d))
    return rows.select(*KEYS, "minute", sessions.charge_mask().alias("charging"))


QUERIES: dict[str, tuple[Query, str]] = {
    "p4_to_double": (
        lambda s, d: rounded(s.read.parquet(f"{d}/events.parquet").select("event_id", C.to_double(F.when(F.col("event_id") % 5 == 0, F.col("event_type")).otherwise(F.col("value").cast("string"))).alias("number"))),
        "SELECT event_id, round(TRY_CAST(CASE WHEN event_id % 5 = 0 THEN event_type ELSE CAST(value AS VARCHAR) END AS DOUBLE) + 1e-9, 6) + 0.0 AS number FROM events",
    ),
    "p5_fuse_units": (_p5, sql("aligned", f"SELECT {K}, ts_local, {r('soc', 'voltage', 'current')} FROM aligned")),
    "p6_with_power_idle": (_p6, sql("curated", f"SELECT {K}, minute, {r('power_kw')}, idle FROM curated")),
    "p7_current_bucket": (
        _p7,
        sql("telemetry", f"SELECT seq, {_bucket_sql('current * 2', 'null')} AS bucket_null, {_bucket_sql('current * 2', 'clip')} AS bucket_clip, {_bucket_sql('current * 2', 'last')} AS bucket_last, {LABELS_SQL}[{_bucket_sql('current * 2', 'last')} + 1] AS label FROM telemetry"),
    ),
    "p8_current_bin4": (
        _p8,
        sql("telemetry", "SELECT seq, b AS bin, ['≤1A', '1–5A', '5–10A', '>10A'][b + 1] AS bin_label FROM (SELECT seq, CASE WHEN abs(current / 3) <= 1 THEN 0 WHEN abs(current / 3) <= 5 THEN 1 WHEN abs(current / 3) <= 10 THEN 2 WHEN current IS NOT NULL THEN 3 END AS b FROM telemetry)"),
    ),
    "p9_soc_band": (
        _p9,
        sql("telemetry", """SELECT seq, CASE WHEN soc IS NOT NULL AND least(greatest(soc, 0), 100) < 100 THEN floor(least(greatest(soc, 0), 100) / 10) * 10 END::INT AS band10,
          (floor(soc / 5) * 5)::DOUBLE AS band5,
          CASE WHEN soc >= 20 AND soc <= 40 THEN 20 WHEN soc > 40 AND soc <= 60 THEN 40 WHEN soc > 60 AND soc <= 80 THEN 60 END AS band20_80,
          CASE WHEN soc > 0 AND soc <= 20 THEN 0 WHEN soc > 20 AND soc <= 40 THEN 20 WHEN soc > 40 AND soc <= 60 THEN 40 WHEN soc > 60 AND soc <= 80 THEN 60 WHEN soc > 80 AND soc <= 100 THEN 80 END AS band20 FROM telemetry"""),
    ),
    "p10_soc_to_percent": (
        lambda s, d: rounded(C.soc_to_percent(samples(s, d).select("seq", (F.col("soc") / 100).alias("soc")))),
        sql("telemetry", "SELECT seq, round(CASE WHEN (SELECT max(soc / 100) FROM telemetry) <= 1.5 THEN soc / 100 * 100 ELSE soc / 100 END + 1e-9, 6) + 0.0 AS soc FROM telemetry"),
    ),
    "p11_session_key": (_p11, sql("rct", f"SELECT DISTINCT {S}, yyyymm || '-' || lpad(CAST(session_id AS VARCHAR), 6, '0') AS session_key FROM gated")),
    "p12_label_clip": (_p12, sql("rct", f"SELECT {S}, timestamp_local, round(least(rct_minutes * 30, 1440) + 1e-9, 6) + 0.0 AS label FROM rct")),
    "p13_clip_and_format_minutes": (
        _p13,
        sql("rct", f"SELECT {S}, timestamp_local, round(m + 1e-9, 6) + 0.0 AS minutes, printf('%d hr %d min', CAST(round_even(m, 0) AS BIGINT) // 60, CAST(round_even(m, 0) AS BIGINT) % 60) AS shown FROM (SELECT *, greatest(0, least(rct_minutes * 7.5 - 20, 240)) AS m FROM rct)"),
    ),
    "u1_timestamp_spine": (lambda s, d: align.timestamp_spine(samples(s, d)), sql("telemetry", f"SELECT DISTINCT {K}, ts_local FROM telemetry")),
    "j1_align_asof": (lambda s, d: rounded(aligned(s, d).select(*KEYS, "ts_local", *ALIGNED)), sql("aligned", f"SELECT {K}, ts_local, {r(*ALIGNED)} FROM aligned")),
    "j1_align_in_chunks": (
        lambda s, d: rounded(align.align_in_chunks(samples(s, d), chunk_s=300).select(*KEYS, "ts_local", *ALIGNED)),
        sql("aligned", f"SELECT {K}, ts_local, {r(*ALIGNED)} FROM aligned"),
    ),
    "a1_curate_in_chunks": (
        lambda s, d: rounded(curate.curate_minute(align.align_in_chunks(samples(s, d), chunk_s=600, keep_chunk=True), [*KEYS, "chunk"]).select(*KEYS, "minute", *ALIGNED)),
        sql("curated", f"SELECT {K}, minute, {r(*[c for c in ALIGNED if c != 'km'])}, round(km0 + 1e-9, 6) + 0.0 AS km FROM minutes"),
    ),
    "a1_curate_minute": (
        lambda s, d: rounded(curate.curate_minute(aligned(s, d)).select(*KEYS, "minute", *ALIGNED)),
        sql("curated", f"SELECT {K}, minute, {r(*[c for c in ALIGNED if c != 'km'])}, round(km0 + 1e-9, 6) + 0.0 AS km FROM minutes"),
    ),
    "w1_sanitize_km": (_w1, sql("curated", f"SELECT {K}, minute, {r('km')} FROM curated")),
    "a2_charge_sign": (lambda s, d: sessions.charge_sign(curated(s, d)), sql("sessions", f"SELECT {K}, sign FROM sign")),
    "f1_charge_mask": (_f1, sql("sessions", f"SELECT {K}, minute, charging FROM masked")),
    "w2_split_sessions": (lambda s, d: sessioned(s, d).select(*KEYS, "minute", "charging", "session_id"), sql("sessions", f"SELECT {K}, minute, charging, session_id FROM sessions")),
    "a3_session_energy": (
        lambda s, d: rounded(sessions.session_energy(sessioned(s, d))),
        sql("sessions", f"SELECT {S}, {r('energy_master_kwh', 'energy_slave_kwh', 'total_energy_kwh', 'mean_pack_kw')} FROM quality0"),
    ),
    "a4_session_quality": (
        lambda s, d: rounded(sessions.session_quality(sessioned(s, d)).withColumn("reasons", F.array_join("reasons", ","))),
        sql("sessions", f"SELECT {S}, n_minutes, {r('duration_min', 'delta_soc', 'idle_frac', 'median_abs_current', 'total_energy_kwh')}, array_to_string(reasons, ',') AS reasons FROM quality"),
    ),
    "f5_gate_sessions": (lambda s, d: rounded(gated(s, d).select(*SESSION, "minute", "soc", "current")), sql("sessions", f"SELECT {S}, minute, {r('soc', 'current')} FROM gated")),
    "w4_rate_features": (
        lambda s, d: rounded(features.rate_features(gated(s, d)).select(*SESSION, "minute", "soc_rate_per_min", "temp_rise_rate")),
        sql("rct", f"SELECT {S}, minute, {r('soc_rate_per_min', 'temp_rise_rate')} FROM rct0"),
    ),
    "w5_rct_rows": (lambda s, d: rounded(rct(s, d).select(*SESSION, "timestamp_local", *RCT, "idle")), sql("rct", f"SELECT {S}, timestamp_local, {r(*RCT)}, idle FROM rct")),
    "k1_dedupe_keep_first": (
        _k1,
        sql("telemetry", "SELECT vehicle_id, minute, seq, round(soc + 1e-9, 6) + 0.0 AS soc FROM (SELECT *, date_trunc('minute', ts_local) AS minute, row_number() OVER (PARTITION BY vehicle_id, date_trunc('minute', ts_local) ORDER BY seq) AS n FROM telemetry) WHERE n = 1"),
    ),
    "w3_synthesize_sessions": (
        _w3,
        sql("rct", """SELECT vehicle_id, seq, CAST(sum(CASE WHEN soc - s0 < -1 OR elapsed_min - e0 > 60 OR elapsed_min - e0 < 0 THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle_id ORDER BY seq) AS BIGINT) AS session_id FROM (
          SELECT vehicle_id, seq, soc, elapsed_min, lag(soc) OVER (PARTITION BY vehicle_id ORDER BY seq) AS s0, lag(elapsed_min) OVER (PARTITION BY vehicle_id ORDER BY seq) AS e0 FROM (
            SELECT vehicle_id, CAST(row_number() OVER (PARTITION BY vehicle_id ORDER BY yyyymm, session_id, timestamp_local) AS INT) AS seq, soc, elapsed_min FROM rct))"""),
    ),
}
