"""Queries over parsing, requests, months' tables, models and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import timeparse as T
from ..operators import dataset, evaluate, features, model
from ..operators import postprocess as P
from ..settings import FEATURES, KEYS, LABEL, SESSION
from ..sources import unit_files as U
from ..storage import move, names, scratch, written
from ..streaming import live
from .queries_core import ALIGNED, K, Query, S, aligned, r, rct, rounded, samples, sessioned, sql
from .queries_predictions import GROUP_SIZES, KEYED, _split_sql, keyed, ready

MONTH = "2024-01-01 00:00:00"


def _absolute(spark: SparkSession, d: str) -> DataFrame:
    """Sample times written in the accepted absolute forms, and bad ones."""
    at = F.col("ts_local")
    forms = ["d/MM/yyyy h:mm:ss a", "dd/MM/yyyy  HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'"]
    text = F.when(F.col("seq") % 5 == 4, F.lit("31/02/2024 10:00"))
    for i, form in enumerate(forms):
        text = text.when(F.col("seq") % 5 == i, F.date_format(at, form))
    return samples(spark, d).select("seq", text.alias("text"))


def _p1(spark, d):
    return _absolute(spark, d).select("seq", T.parse_local_absolute(F.col("text")).alias("ts_local"))


def _file_rows(spark: SparkSession, d: str, mmss: bool) -> DataFrame:
    """Samples of a vehicle's unit as the rows of a file with relative times."""
    at = F.col("ts_local")
    since = F.floor(C.seconds_between(at, F.lit(MONTH).cast("timestamp_ntz")))
    first = F.row_number().over(Window.partitionBy("vehicle_id", "unit").orderBy("ts_local", "seq")) == 1
    if mmss:
        text = F.concat(F.lpad(F.floor(since / 60).cast("string"), 3, "0"), F.lit(":"), F.lpad((since % 60).cast("string"), 2, "0"))
    else:
        clock = F.when(first, F.date_format(at, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(at, "HH:mm:ss"))
        text = F.when(F.col("vehicle_id") % 2 == 0, clock).otherwise(since.cast("string"))
    rows = samples(spark, d).select("vehicle_id", "unit", "seq", "yyyymm", at.alias("order_at"), text.alias("text"))
    return rows.withColumn("text", F.when(F.col("seq") % 9 == 5, F.lit("abc")).otherwise(F.col("text"))) if mmss else rows


def _parsed(spark, d, mmss):
    return T.parse_local(_file_rows(spark, d, mmss), "text", "yyyymm", ["vehicle_id", "unit"], ["order_at", "seq"]).select("seq", "ts_local")


def _s8(spark, d):
    """A request for each sample: JSON with instances, one object, a list, or CSV."""
    values = F.struct("soc", "voltage", "current")
    csv = F.concat_ws(",", *[F.coalesce(F.col(f).cast("string"), F.lit("")) if f in ("soc", "voltage", "current") else F.lit("") for f in FEATURES])
    kind = F.col("seq") % 4
    body = (
        F.when(kind == 0, F.to_json(F.struct(F.array(values, values).alias("instances"))))
        .when(kind == 1, F.to_json(F.struct(F.lit(1.5).alias("km"), "soc", "voltage", "current")))
        .when(kind == 2, F.to_json(F.array(values)))
        .otherwise(csv)
    )
    bodies = samples(spark, d).select("seq", body.alias("body"))
    return rounded(U.parse_scoring_requests(bodies, "body").select("seq", "instance", "soc", "voltage", "current", "km"))


def _u2(spark, d):
    rows = samples(spark, d)
    parts = [rows.filter("unit = 'master'").select("vehicle_id", "seq", "soc", "speed"), rows.filter("unit = 'slave'").select("vehicle_id", "seq", "soc", "voltage")]
    return rounded(U.union_months(parts))


def _training(spark: SparkSession, d: str) -> DataFrame:
    """Labelled rows with their split, by whole sessions; written, as every fit reads them often."""
    return written(dataset.group_split(keyed(spark, d)).select("session_key", "timestamp_local", "split", LABEL, *FEATURES))


def _m1(spark, d):
    from pyspark.ml.functions import vector_to_array

    rows = _training(spark, d)
    fit = model.impute_standardize(rows.filter("split = 'train'"))
    out = fit.transform(rows).withColumn("_x", vector_to_array("features"))
    return rounded(out.select("session_key", "timestamp_local", *[F.col("_x")[i].alias(f) for i, f in enumerate(FEATURES)]))


def _s1(spark, d):
    """The master's samples as files of eight folders, under other headers, read again."""
    folder = scratch(spark, "csv")
    rows = samples(spark, d).filter("unit = 'master'")
    time = F.date_format("ts_local", "yyyy-MM-dd HH:mm:ss").alias("Time")
    named = rows.select((F.col("vehicle_id") % 8).alias("vehicle_id"), time, F.col("soc").alias("avg_soc"), F.col("voltage").alias("Voltage"), F.col("current").alias("pack_current"), F.col("speed").alias("veh_speed"), F.col("seq").alias("odo_km"))
    named.repartition("vehicle_id").write.partitionBy("vehicle_id").option("header", True).csv(folder)
    for place in names(spark, folder):
        for i, file in enumerate(sorted(f for f in names(spark, f"{folder}/{place}") if f.endswith(".csv")) if place.startswith("vehicle_id=") else []):
            move(spark, f"{folder}/{place}/{file}", f"{folder}/{place}/{i}_2024-01.csv")
    back = U.read_month_csv(spark, [folder], "master")
    return rounded(back.select("vehicle_id", "yyyymm", "ts_raw", "km", "soc", "voltage", "current", "speed"))


def _s4(spark, d):
    path = scratch(spark, "any")
    rows = samples(spark, d).select("seq", "soc", "current")
    rows.write.option("header", True).csv(f"{path}/rows.csv")
    rows.write.parquet(f"{path}/rows")
    parts = [U.read_any(spark, p).withColumn("kind", F.lit(k)) for p, k in ((f"{path}/rows.csv", "csv"), (f"{path}/rows", "parquet"))]
    return rounded(parts[0].unionByName(parts[1]).withColumn("seq", F.col("seq").cast("long")))


def _s7(spark, d):
    path = scratch(spark, "set")
    U.write_training_set(_training(spark, d), path)
    kinds = ", ".join(f"`{c}` double" for c in [*FEATURES, LABEL])
    back = spark.read.schema(f"{kinds}, split string").option("header", True).csv(f"{path}/data")
    return rounded(back.select("split", LABEL, *FEATURES))


def _by_split(rows: DataFrame, name: str) -> DataFrame:
    return evaluate.regression_metrics(rows, ["split"]).withColumn("model", F.lit(name))


def _m2(spark, d):
    rows = _training(spark, d)
    return _by_split(model.predict_batch(rows, None, model.ridge_baseline(rows.filter("split = 'train'"))), "ridge")


def _tree(rows: DataFrame):
    return model.gbt_search(rows, trials=2, rounds=8, rungs=1)


def _m3(spark, d):
    tried = model.gbt_search(_training(spark, d), trials=6, rounds=8, rungs=2)[1]
    return spark.createDataFrame([(i, t["rung"], float(t["rmse"]), int(t["trees"])) for i, t in enumerate(tried)], "trial int, rung int, rmse double, trees int")


def _m4(spark, d):
    rows = _training(spark, d)
    return rounded(model.predict_batch(rows, _tree(rows)[0]).select("session_key", "timestamp_local", "prediction"))


def _m5(spark, d):
    rows = _training(spark, d)
    found = _by_split(model.predict_batch(rows, model.ridge_baseline(rows.filter("split = 'train'"))), "ridge")
    return evaluate.success_checks(found.union(_by_split(model.predict_batch(rows, _tree(rows)[0]), "gbt")))


def _m5_given(spark, d):
    """Checks on errors that a rule gives, so that SQL can follow."""
    errors = rct(spark, d).select(F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(s).alias("split"), F.lit(f).alias("f")) for m, s, f in GIVEN])).alias("x"), LABEL)
    rows = errors.select("x.model", "x.split", LABEL, (F.col(LABEL) * F.col("x.f")).alias("prediction"))
    return evaluate.success_checks(evaluate.regression_metrics(rows, ["model", "split"]))


GIVEN = [("ridge", "test", 0.5), ("ridge", "val", 0.62), ("gbt", "test", 0.7), ("gbt", "val", 0.68)]


def _k2(spark, d):
    rows = _training(spark, d)
    return model.top_importances(_tree(rows)[0], rows)


def streamed(rows: DataFrame, transform, state_store: str | None = None) -> DataFrame:
    """What a stream over the written rows has put out once it has read them all."""
    spark = rows.sparkSession
    key = "spark.sql.streaming.stateStore.providerClass"
    if state_store and spark.conf.get(key) != state_store:
        used = spark.conf.get(key)
        spark.conf.set(key, state_store)
        try:
            return streamed(rows, transform)
        finally:
            spark.conf.set(key, used)
    folder = scratch(spark, "stream")
    rows.write.parquet(f"{folder}/in")
    out = transform(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"))
    writer = out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/out")


def _r1(spark, d):
    return rounded(streamed(aligned(spark, d).select(*KEYS, "ts_local", *ALIGNED), live.stream_curate_minute).select(*KEYS, "minute", *ALIGNED))


def _r2(spark, d):
    rows = sessioned(spark, d).filter("charging").select("vehicle_id", F.col("minute").alias("ts_local"))
    return streamed(rows, live.stream_sessions).select("vehicle_id", "started", "ended", "n")


def _k3(spark, d):
    return rounded(features.ordered_output(rct(spark, d).select(*SESSION, "timestamp_local", "soc"), [*SESSION, "timestamp_local"]))


DESCRIBED = """SELECT '{c}' AS "column", count({c}) AS n, avg({c}) AS mean, stddev({c}) AS std, min({c}) AS lowest, max({c}) AS highest,
  quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75 FROM {t}"""
_FIGURES = ["mean", "std", "lowest", "highest", "p25", "p50", "p75"]
TIMES = "date_trunc('second', ts_local)"

QUERIES: dict[str, tuple[Query, str]] = {
    "p1_parse_local_absolute": (
        _p1,
        sql("telemetry", f"SELECT seq, CASE seq % 5 WHEN 0 THEN {TIMES} WHEN 1 THEN date_trunc('minute', ts_local) WHEN 2 THEN {TIMES} WHEN 3 THEN {TIMES} + INTERVAL 11 HOUR END AS ts_local FROM telemetry"),
    ),
    "p2_parse_local_relative": (lambda s, d: _parsed(s, d, False), sql("telemetry", f"SELECT seq, {TIMES} AS ts_local FROM telemetry")),
    "p3_parse_local_mmss": (lambda s, d: _parsed(s, d, True), sql("telemetry", f"SELECT seq, CASE WHEN seq % 9 <> 5 THEN {TIMES} END AS ts_local FROM telemetry")),
    "s8_parse_scoring_requests": (
        _s8,
        sql("telemetry", f"SELECT seq, x::INT AS instance, {r('soc', 'voltage', 'current')}, CASE WHEN seq % 4 = 1 THEN 1.5 END::DOUBLE AS km FROM telemetry JOIN range(2) t(x) ON x = 0 OR seq % 4 = 0"),
    ),
    "u2_union_months": (
        _u2,
        sql("telemetry", "SELECT vehicle_id, seq, round(soc + 1e-9, 6) + 0.0 AS soc, round(CASE WHEN unit = 'master' THEN speed END + 1e-9, 6) + 0.0 AS speed, round(CASE WHEN unit = 'slave' THEN voltage END + 1e-9, 6) + 0.0 AS voltage FROM telemetry"),
    ),
    "k3_ordered_output": (_k3, sql("rct", f"SELECT {S}, timestamp_local, {r('soc')} FROM rct")),
    "a15_step_distribution": (
        lambda s, d: rounded(evaluate.step_distribution(rct(s, d), SESSION)),
        sql("rct", f"SELECT round(st + 1e-9, 6) + 0.0 AS step, count(*) AS n FROM (SELECT round(elapsed_min - lag(elapsed_min) OVER (PARTITION BY {S} ORDER BY elapsed_min), 3) AS st FROM rct) WHERE st IS NOT NULL GROUP BY st"),
    ),
    "a16_described": (
        lambda s, d: rounded(evaluate.described(P.session_soc_ranges(ready(s, d)), ["soc_min", "soc_max", "soc_span"])),
        sql("rct", f'SELECT "column", n, {r(*_FIGURES)} FROM (' + " UNION ALL ".join(DESCRIBED.format(c=c, t="ranges") for c in ("soc_min", "soc_max", "soc_span")) + ")", P.SQL),
    ),
    "s1_read_month_csv": (
        _s1,
        sql("telemetry", f"SELECT vehicle_id % 8 AS vehicle_id, yyyymm, strftime(ts_local, '%Y-%m-%d %H:%M:%S') AS ts_raw, seq::DOUBLE AS km, {r('soc', 'voltage', 'current', 'speed')} FROM telemetry WHERE unit = 'master'"),
    ),
    "s4_read_any": (_s4, sql("telemetry", f"SELECT seq, kind, {r('soc', 'current')} FROM telemetry CROSS JOIN (SELECT unnest(['csv', 'parquet']) AS kind)")),
    "s7_write_training_set": (_s7, sql("rct", f"SELECT split, {r(LABEL, *FEATURES)} FROM keyed JOIN splits USING (session_key)", KEYED, _split_sql("session_key", "session_key", GROUP_SIZES))),
    "m1_impute_standardize": (
        _m1,
        sql("rct", f"SELECT session_key, timestamp_local, {', '.join(f'round((f.{c} - s.{c}_mean) / CASE WHEN s.{c}_dev > 0 THEN s.{c}_dev ELSE 1 END + 1e-9, 6) + 0.0 AS {c}' for c in FEATURES)} FROM filled f CROSS JOIN stat s",
            KEYED, _split_sql("session_key", "session_key", GROUP_SIZES), "named AS (SELECT * FROM keyed JOIN splits USING (session_key))",
            "med AS (SELECT " + ", ".join(f"median({c}) AS {c}" for c in FEATURES) + " FROM named WHERE split = 'train')",
            "filled AS (SELECT session_key, timestamp_local, split, " + ", ".join(f"coalesce(n.{c}, m.{c}, 0) AS {c}" for c in FEATURES) + " FROM named n CROSS JOIN med m)",
            "stat AS (SELECT " + ", ".join(f"avg({c}) AS {c}_mean, stddev_pop({c}) AS {c}_dev" for c in FEATURES) + " FROM filled WHERE split = 'train')"),
    ),
    "m2_ridge_baseline": (_m2, ""),
    "m3_gbt_search": (_m3, ""),
    "m4_predict_batch": (_m4, ""),
    "m5_success_checks": (_m5, ""),
    "m5_checks_of_given_errors": (
        _m5_given,
        sql("rct", "SELECT max(e) FILTER (m = 'gbt/val') <= 1.1 * max(e) FILTER (m = 'gbt/test') AS stable, max(e) FILTER (m = 'gbt/val') <= 0.8 * max(e) FILTER (m = 'ridge/val') AS better_than_linear FROM ("
            + " UNION ALL ".join(f"SELECT '{m}/{s}' AS m, sqrt(avg((rct_minutes - rct_minutes * {f}) * (rct_minutes - rct_minutes * {f}))) AS e FROM rct" for m, s, f in GIVEN) + ")"),
    ),
    "k2_top_importances": (_k2, ""),
    "r1_stream_curate_minute": (
        _r1,
        sql("curated", f"SELECT {K}, minute, {r(*[c for c in ALIGNED if c != 'km'])}, round(km0 + 1e-9, 6) + 0.0 AS km FROM minutes WHERE minute + INTERVAL 1 MINUTE <= (SELECT date_trunc('millisecond', max(ts_local)) - INTERVAL 2 MINUTE FROM aligned)"),
    ),
    "r2_stream_sessions": (
        _r2,
        sql("sessions", """SELECT * FROM (SELECT vehicle_id, min(minute) AS started, max(minute) AS ended, count(*) AS n FROM sessions WHERE charging GROUP BY vehicle_id, yyyymm, session_id)
          WHERE ended + INTERVAL 10 MINUTE <= (SELECT max(minute) - INTERVAL 2 MINUTE FROM sessions WHERE charging)"""),
    ),
}
