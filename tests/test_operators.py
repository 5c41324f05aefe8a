"""The library's core on small frames: ties, nulls, absent units, empty tables."""

import math
import random
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from chargeflow.functions import columns as C
from chargeflow.functions.quantiles import quantiles
from chargeflow.operators import align, curate, dataset, evaluate, features, model, postprocess, sessions, soc_bands, soc_bins
from chargeflow.settings import FEATURES, LABEL
from chargeflow.streaming import live

T0 = datetime(2024, 3, 31, 1, 0)
SAMPLE = "vehicle_id long, yyyymm string, unit string, seq long, ts_local timestamp_ntz, soc double, voltage double, current double, speed double, cell_temp double, bms_temp double, pack_delta double, charge_limit double, discharge_limit double, km double"


def sample(unit, seq, seconds, soc=50.0, volts=600.0, amps=-20.0, km=5.0, vehicle=1, **other):
    return (vehicle, "2024-03", unit, seq, T0 + timedelta(seconds=seconds), soc, volts, amps, other.get("speed"), None, 27.0, 0.1, 100.0, 200.0, km)


def samples(spark, rows):
    return spark.createDataFrame(rows, SAMPLE)


def minutes(spark, rows):
    """(minute, soc, current) of one vehicle's month as curated rows."""
    full = [sample("master", i, 60 * m, s, 650.0, a) for i, (m, s, a) in enumerate(rows)]
    return curate.curate(align.align_nearest(samples(spark, full)))


def test_nearest_sample_within_tolerance(spark):
    rows = [sample("master", 1, 100, 50.0), sample("slave", 2, 90, 40.0), sample("slave", 3, 110, 60.0), sample("slave", 4, 200, 70.0), sample("master", 5, 100, 51.0), sample("master", 6, 100, None)]
    got = {int((r.ts_local - T0).total_seconds()): r for r in align.align_nearest(samples(spark, rows)).collect()}
    assert sorted(got) == [90, 100, 110, 200]
    # Equally near: the earlier; several at one time: the highest seq, with its nulls.
    assert got[100].soc_slave == 40.0 and got[100].soc_master is None and got[100].soc == 40.0
    assert got[200].voltage_master is None and got[200].soc == 70.0
    assert got[90].current == -40.0


def test_absent_unit_and_empty_input(spark):
    one = align.align_nearest(samples(spark, [sample("master", 1, 0)]))
    assert one.first().soc_slave is None and one.first().soc == 50.0
    none = samples(spark, [])
    rct = features.rct_rows(sessions.gate_sessions(sessions.sessionize(curate.curate(align.align_nearest(none)))))
    assert rct.count() == 0
    assert evaluate.regression_metrics(rct.withColumn("prediction", F.lit(1.0))).first().n == 0
    assert soc_bands.interval_samples(rct).count() == 0
    assert soc_bins.soc_current_lookup(rct).count() == 0
    assert dataset.group_split(rct.withColumn("session_key", F.lit("x"))).count() == 0


def test_curation(spark):
    rows = [sample("master", 1, 5, 50.0, km=7.0), sample("master", 2, 50, None, 610.0, km=6.0), sample("master", 3, 65, 51.0, km=-1.0), sample("master", 4, 125, 52.0, km=6.5), sample("master", 5, 185, 53.0, km=8.0)]
    got = curate.curate(align.align_nearest(samples(spark, rows))).orderBy("minute").collect()
    assert [r.soc for r in got] == [50.0, 51.0, 52.0, 53.0] and got[0].voltage == 605.0
    assert [r.km for r in got] == [6.0, 6.0, 6.5, 8.0] and all(r.idle for r in got)


def test_wall_clock_does_not_depend_on_the_session(spark):
    rows = spark.createDataFrame([(datetime(2024, 3, 31, 1, 30), datetime(2024, 3, 31, 3, 30), datetime(1969, 12, 31, 23, 59, 59, 500000))], "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz")
    seen = set()
    for zone in ("UTC", "Europe/Berlin", "Australia/Melbourne"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            r = rows.select(C.seconds_between(F.col("b"), F.col("a")).alias("s"), C.clock(F.col("c")).alias("c"), C.wall(C.clock(F.col("c"))).alias("w"), curate.minute_of("b").alias("m")).first()
            seen.add(tuple(r))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen == {(7200.0, -500_000, datetime(1969, 12, 31, 23, 59, 59, 500000), datetime(2024, 3, 31, 3, 30))}


def test_sessions(spark):
    up = [(m, 20.0 + m, -30.0) for m in range(6)] + [(15, 26.0, -30.0)] + [(26, 27.0, -30.0), (27, 28.0, -30.0), (28, 29.0, 40.0)]
    got = sessions.sessionize(minutes(spark, up)).orderBy("minute").collect()
    # A gap of eleven minutes parts sessions, one of ten does not; discharge is in none.
    assert [r.session_id for r in got] == [1] * 7 + [2, 2, None]
    table = sessions.sessionize(minutes(spark, up))
    passed = sessions.gate_sessions(table)
    good = {(r.vehicle_id, r.session_id) for r in sessions.session_quality(table).filter(~sessions.hard_fail()).collect()}
    assert {(r.vehicle_id, r.session_id) for r in passed.select("vehicle_id", "session_id").distinct().collect()} == good and passed.columns == table.columns


def labelled(spark, n=40):
    return features.rct_rows(sessions.gate_sessions(sessions.sessionize(minutes(spark, [(m, 20.0 + m, -10.0 - m % 3) for m in range(n)]))))


def test_labels_and_bands(spark):
    rct = labelled(spark)
    rows = rct.orderBy("timestamp_local").collect()
    assert rows[0].elapsed_min == 0 and rows[0].rct_minutes == rows[-1].elapsed_min + rows[-1].rct_minutes and min(r.rct_minutes for r in rows) > 0
    stats = soc_bands.interval_samples(rct)
    got = stats.filter("series = 'pack'").orderBy("soc_start").collect()
    assert got and all(r.minutes_total == pytest.approx(5.0) and r.confidence == pytest.approx(1.0) and r.bucket == 3 for r in got)
    # The slave is absent: a row for each band, without figures.
    slave = stats.filter("series = 'slave'").collect()
    assert len(slave) == len(got) and all(r.mean_abs_current is None and r.confidence == 0 for r in slave)
    pivot = soc_bands.interval_pivot(stats)
    ask = spark.createDataFrame([(1, 20.0, 40.0, 12.0), (2, 50.0, 40.0, 12.0), (3, 20.0, 40.0, None), (4, 20.0, 40.0, 900.0)], "request_id long, cur_soc double, tgt_soc double, amps double")
    minutes_ = {r.request_id: r.minutes for r in soc_bands.estimate_remaining_time(ask, pivot).collect()}
    assert minutes_[1] == pytest.approx(20.0) and minutes_[2] == 0 and minutes_[3] == pytest.approx(20.0) and minutes_[4] == pytest.approx(20.0)
    none = soc_bands.estimate_remaining_time(ask, pivot.limit(0)).filter("request_id = 1").first()
    assert none.minutes == pytest.approx(20.0)  # a minute a percent


def test_quantiles_are_exact(spark):
    rows = spark.createDataFrame([(k, float(v)) for k in (1, None) for v in [3, 1, 1, 2, 7, 7, 7]] + [(2, None), (3, 5.0)], "k int, v double").repartition(3)
    got = {r.k: r.quantiles for r in quantiles(rows, F.col("v"), [0.0, 0.25, 0.9, 1.0], ["k"]).collect()}
    want = {r.k: r.q for r in rows.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.9, 1.0)])).alias("q")).collect()}
    assert got == {k: pytest.approx(q) for k, q in want.items() if k != 2}
    assert quantiles(rows, F.col("v"), [0.5]).first().quantiles == [3.0]
    assert quantiles(rows.filter("v > 99"), F.col("v"), [0.5]).first().quantiles == [None]


def test_quantiles_between_near_values_are_those_of_sql(spark):
    rng, shares = random.Random(4), [i / 10 for i in range(11)]
    values = {k: [rng.choice([55.37, math.nextafter(55.37, 56), 122.79, math.nextafter(122.79, 0)]) for _ in range(rng.randrange(12, 90))] for k in range(200)}
    rows = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k int, v double")
    got = {r.k: r.quantiles for r in quantiles(rows, F.col("v"), shares, ["k"]).collect()}
    con = duckdb.connect()
    assert got == {k: con.execute("SELECT quantile_cont(v, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) FROM (SELECT unnest(?::DOUBLE[]) AS v)", [vs]).fetchall()[0][0] for k, vs in values.items()}


def test_metrics(spark):
    rows = spark.createDataFrame([(10.0, 12.0, "a"), (0.5, 1.5, "a"), (4.0, 1.0, None), (None, 1.0, "a"), (3.0, None, "b")], "rct_minutes double, prediction double, g string")
    whole = evaluate.regression_metrics(rows).first()
    assert (whole.n, whole.mae, whole.p90, whole.median_prediction) == (3, 2.0, pytest.approx(2.8), 1.5) and whole.mape == pytest.approx((0.2 + 0.75) / 2 * 100)
    by = {r.g: r.n for r in evaluate.regression_metrics(rows, ["g"]).collect()}
    assert by == {"a": 2, None: 1}
    scores = spark.createDataFrame([("gbt", "val", 1.0), ("gbt", "test", 1.0), ("ridge", "val", 1.2)], "model string, split string, rmse double")
    assert tuple(evaluate.success_checks(scores).first()) == (True, False)


def test_predictions_are_smoothed_and_fall(spark):
    rows = [(1, "2024-03", 1, float(i), 20.0 + 10 * i, p, -5.0, -5.0, -5.0) for i, p in enumerate([60.0, 90.0, 40.0, 41.0, -3.0, 5.0])]
    table = spark.createDataFrame(rows, "vehicle_id long, yyyymm string, session_id long, elapsed_min double, soc double, predicted_rct double, current double, current_master double, current_slave double")
    got = [r.monotone for r in postprocess.prepared(table).orderBy("elapsed_min").collect()]
    assert got == sorted(got, reverse=True) and min(got) >= 0
    assert postprocess.prepared(table.limit(0)).count() == 0


def test_splits_hold_groups_together(spark):
    rows = spark.createDataFrame([(f"s{i % 12}", i) for i in range(60)] + [(None, 99)], "session_key string, i long")
    got = dataset.group_split(rows).collect()
    of = {}
    for r in got:
        of.setdefault(r.session_key, set()).add(r.split)
    assert all(len(s) == 1 for s in of.values()) and of[None] == {"train"} and {x for s in of.values() for x in s} == {"train", "val", "test"}
    shares = [r.split for r in dataset.row_split(rows, ["i"]).collect()]
    assert shares.count("test") == 12 and len(shares) == 61


def test_pruning_and_guards(spark):
    rows = spark.createDataFrame([(1.0, None, 3.0, 1.0), (2.0, None, 3.0, 2.0)], f"soc double, km double, voltage double, {LABEL} double")
    assert dataset.prune_features(rows).columns == ["soc", LABEL]
    assert C.guarded(["soc", "pack_energy", "charging_efficiency", "vehicle", "session_id", "km"]) == ["soc", "km"]
    kept = C.drop_forbidden(spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "vehicle_id long, soc double, loss_kwh double, Charger_Energy double"))
    assert kept.columns == ["soc"]


def training(spark, splits=("train", "val", "test")):
    rows = [(splits[i % len(splits)], 100.0 - i, *[float(i + j) if j != 3 or i % 4 else None for j in range(len(FEATURES))]) for i in range(60)]
    return spark.createDataFrame(rows, f"split string, {LABEL} double, " + ", ".join(f"{f} double" for f in FEATURES))


def test_models(spark):
    rows = training(spark)
    ridge = model.ridge_baseline(rows.filter("split = 'train'"))
    tree, tried = model.gbt_search(rows, trials=2, rounds=3)
    again = model.gbt_search(rows, trials=2, rounds=3)[1]
    assert tried == again and len(tried) == 2 and set(model.SPACE) <= set(tried[0])
    for used in ((tree, ridge), (None, ridge)):
        got = model.predict_batch(rows, *used)
        assert got.columns == [*rows.columns, "prediction"] and got.filter("prediction is null or prediction < 0").count() == 0
    with pytest.raises(ValueError):
        model.predict_batch(rows, None)
    assert model.top_importances(tree, rows, k=5).count() == 5
    assert evaluate.regression_metrics(model.predict_batch(rows, ridge)).first().rmse < 5


def test_search_without_trials_or_rows(spark):
    rows = training(spark)
    assert model.gbt_search(rows, trials=0) == (None, []) and model.gbt_search(rows.filter("split = 'val'"), trials=1) == (None, [])
    alone, tried = model.gbt_search(training(spark, ("train",)), trials=1, rounds=2)
    assert alone is not None and tried[0]["rmse"] is None


def test_streams_give_the_batch_rows(spark, tmp_path):
    rows = align.align_nearest(samples(spark, [sample("master", i, 37 * i, 20.0 + i % 5, amps=-30.0 - i) for i in range(60)] + [sample("master", 90, 60 * 60, vehicle=2)]))
    rows.write.parquet(f"{tmp_path}/in")

    def run(name, transform):
        out = transform(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"))
        query = out.writeStream.format("parquet").option("path", f"{tmp_path}/{name}").option("checkpointLocation", f"{tmp_path}/{name}-state")
        query.trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(out.schema).parquet(f"{tmp_path}/{name}")

    got = {(r.vehicle_id, r.yyyymm, r.minute): (r.soc, r.voltage, r.km) for r in run("minutes", live.stream_curate_minute).collect()}
    want = {(r.vehicle_id, r.yyyymm, r.minute): (r.soc, r.voltage, r.km) for r in curate.curate_minute(rows).filter("vehicle_id = 1").collect()}
    assert got == want
    ended = run("sessions", live.stream_sessions).collect()
    assert [(r.vehicle_id, r.n) for r in ended] == [(1, 60)] and (ended[0].started, ended[0].ended) == (T0, T0 + timedelta(seconds=37 * 59))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError):
            live.stream_curate_minute(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ordered_output(spark):
    rows = spark.createDataFrame([(i * 37 % 101, i) for i in range(101)], "a long, b long").repartition(4)
    assert [r.a for r in features.ordered_output(rows, ["a"]).collect()] == list(range(101))
