"""Months: chunks, borders, replacement, live alignment, slices, sketches, the time scan."""

import random
import shutil
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chargeflow.functions import clock_scan as scan
from chargeflow.functions import sketches
from chargeflow.functions.quantiles import quantiles
from chargeflow.functions.timeparse import parse_local
from chargeflow.operators import align, borders, curate, evaluate, features, sessions
from chargeflow.settings import KEYS
from chargeflow.sources import unit_files as U
from chargeflow.storage import exists, owned
from chargeflow.streaming import live, live_align

from .test_operators import SAMPLE, T0, sample, samples


def rows_of(df, *order):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


# ---------------------------------------------------------------- alignment in stretches


def random_samples(rng, n=400, span=900):
    """Times on and around the edges of stretches of 100 s, with ties and repeats."""
    out = []
    for i in range(n):
        at = rng.choice([rng.randrange(span), 100 * rng.randrange(span // 100) + rng.choice([-15.000001, -15, -14.5, -0.000001, 0, 0.5, 15, 15.5])])
        out.append(sample(rng.choice(["master", "slave"]), i, at, soc=rng.choice([None, float(i)]), vehicle=rng.choice([1, 2])))
    return out


@pytest.mark.parametrize("chunk", [16, 30, 100, 86_400])
def test_stretches_give_the_rows_of_the_whole(spark, chunk):
    table = samples(spark, random_samples(random.Random(chunk)))
    assert rows_of(align.align_in_chunks(table, chunk_s=chunk)) == rows_of(align.align_nearest(table))


def test_months_stay_apart_in_stretches(spark):
    other = [(*r[:1], "2024-04", *r[2:]) for r in random_samples(random.Random(2), 100)]
    table = samples(spark, random_samples(random.Random(3), 100) + other)
    assert rows_of(align.align_in_chunks(table, chunk_s=60)) == rows_of(align.align_nearest(table))


def test_a_stretch_is_longer_than_the_tolerance(spark):
    with pytest.raises(ValueError):
        align.align_in_chunks(samples(spark, []), chunk_s=15)
    assert align.align_in_chunks(samples(spark, [])).count() == 0


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x.strip() for x in plan.split("\n") if "Exchange" in x]


def test_minutes_in_stretches_need_one_exchange(spark):
    table = samples(spark, random_samples(random.Random(4), 50))
    minutes = curate.curate_minute(align.align_in_chunks(table, chunk_s=600, keep_chunk=True), [*KEYS, "chunk"])
    found = exchanges(minutes)
    assert len(found) == 1 and "chunk" in found[0]
    assert rows_of(minutes.drop("chunk")) == rows_of(curate.curate_minute(align.align_nearest(table)))


# ---------------------------------------------------------------- months


def curated_rows(spark, seed, months=4, vehicles=6):
    """Curated minutes of vehicles whose sessions go over the ends of months of 40 minutes."""
    rng = random.Random(seed)
    rows = []
    for v in range(vehicles):
        at, soc = 0, 20.0
        while at < 40 * months:
            n, on = rng.randrange(1, 60), rng.random() < 0.7
            for _ in range(n):
                if at >= 40 * months:
                    break
                if rng.random() < 0.9 and not (v == 3 and 40 <= at < 80):  # a vehicle without one of the months
                    soc += rng.choice([0.0, 0.1, 0.3]) if on else -0.2
                    amps = rng.choice([-30.0, -25.5, -8.0]) if on else 12.0
                    rows.append((v, f"2024-{1 + at // 40:02d}", at, rng.choice([soc, soc, soc, None]), amps, rng.choice([None, 30.0, 31.5]), rng.choice([True, True, None])))
                at += 1
            at += rng.choice([0, 3, 9, 10, 11])
    raw = spark.createDataFrame(rows, "vehicle_id long, yyyymm string, at int, soc double, current double, cell_temp double, idle boolean")
    minute = F.lit("2024-01-31 23:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("at"))
    half = F.col("current") / 2
    return raw.select(
        *KEYS, minute.alias("minute"), "soc", "current", "cell_temp", F.lit(29.0).alias("bms_temp"), "idle", F.lit(640.0).alias("voltage"),
        F.lit(640.0).alias("voltage_master"), F.lit(640.0).alias("voltage_slave"), half.alias("current_master"), half.alias("current_slave"),
    )


def near(rows):
    return [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows]


def test_appended_months_equal_windows_over_all_time(spark, tmp_path):
    for seed in (1, 2):
        path = f"{tmp_path}/{seed}"
        table = curated_rows(spark, seed).cache()
        months = sorted(r.yyyymm for r in table.select("yyyymm").distinct().collect())
        after = None
        for m in months:
            borders.append_month(table, path, m, after)
            after = m
        whole = borders.across_months(table).cache()
        keep = ["vehicle_id", "yyyymm", "minute", "session_id"]
        stored, pieces = spark.read.parquet(f"{path}/minutes"), spark.read.parquet(f"{path}/pieces")
        assert rows_of(stored.select(*keep)) == rows_of(whole.select(*keep))
        assert whole.filter("charging").groupBy("vehicle_id", "session_id").agg(F.count_distinct("yyyymm").alias("n")).agg(F.max("n")).first()[0] > 1
        # Sums over months equal those of the whole sessions, worked on as if they were of one month.
        flat = whole.withColumn("yyyymm", F.lit("2024-01"))
        quality = borders.merged_quality(pieces)
        figures = ["n_minutes", "duration_min", "delta_soc", "idle_frac", "median_abs_current", "total_energy_kwh", "reasons"]
        want = sessions.session_quality(flat).select("vehicle_id", "session_id", *figures)
        assert near(rows_of(quality.select("vehicle_id", "session_id", *figures))) == near(rows_of(want))
        energy = ["energy_master_kwh", "energy_slave_kwh", "total_energy_kwh", "mean_pack_kw"]
        assert near(rows_of(quality.select("vehicle_id", "session_id", *energy))) == near(rows_of(sessions.session_energy(flat).select("vehicle_id", "session_id", *energy)))
        labels = ["timestamp_local", "elapsed_min", "rct_minutes", "soc_rate_per_min", "temp_rise_rate"]
        got = borders.rct_across(stored, quality).select("vehicle_id", "session_id", *labels)
        assert near(rows_of(got)) == near(rows_of(features.rct_rows(flat).select("vehicle_id", "session_id", *labels)))


def test_an_appended_month_reads_one_border(spark, tmp_path):
    table = curated_rows(spark, 5).cache()
    months = sorted(r.yyyymm for r in table.select("yyyymm").distinct().collect())
    after = None
    for m in months:
        borders.append_month(table, f"{tmp_path}/all", m, after)
        # Only the border before is there when the month is appended.
        if after:
            one = f"one-{m}"
            shutil.copytree(tmp_path / "all" / "borders" / f"yyyymm={after}", tmp_path / one / "borders" / f"yyyymm={after}")
            borders.append_month(table, f"{tmp_path}/{one}", m, after)
            for name in ("minutes", "pieces", "borders"):
                read = lambda top: spark.read.parquet(f"{tmp_path}/{top}/{name}/yyyymm={m}")  # noqa: B023, E731
                assert rows_of(read(one)) == rows_of(read("all"))
        after = m
    # A rerun of the last month changes nothing.
    before = rows_of(spark.read.parquet(f"{tmp_path}/all/minutes"))
    borders.append_month(table, f"{tmp_path}/all", months[-1], months[-2])
    assert rows_of(spark.read.parquet(f"{tmp_path}/all/minutes")) == before


def test_months_are_replaced_one_by_one(spark, tmp_path):
    def month(m, values):
        return spark.createDataFrame([(i, m, float(v)) for i, v in enumerate(values)], "vehicle_id long, yyyymm string, soc double")

    path = f"{tmp_path}/t"
    read = lambda: sorted((r.yyyymm, r.soc) for r in U.consolidate_curated(spark, path).collect())
    U.write_monthly(month("2024-01", [1, 2]), path)
    U.write_monthly(month("2024-02", [3]), path)
    assert read() == [("2024-01", 1.0), ("2024-01", 2.0), ("2024-02", 3.0)]
    for _ in range(2):
        U.write_monthly(month("2024-01", [9]).union(month("2024-03", [5])), path, months=["2024-01"])
    assert read() == [("2024-01", 9.0), ("2024-02", 3.0)]
    U.write_monthly(month("2024-01", []), path, months=["2024-01", "2024-07"])
    assert read() == [("2024-02", 3.0)]
    U.write_monthly(month("2024-04", range(100)), path, max_rows=30)
    assert [r.soc for r in U.consolidate_curated(spark, path, ["2024-02"]).collect()] == [3.0]
    per_file = spark.read.parquet(path).filter("yyyymm = '2024-04'").groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in per_file) <= 30 and sum(r["count"] for r in per_file) == 100


def test_a_run_writes_its_three_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01", 5.0)], "vehicle_id long, yyyymm string, soc double")
    U.write_months({"curated": rows, "rct": rows}, f"{tmp_path}/run", ["2024-01"])
    U.write_months({"curated": rows.withColumn("yyyymm", F.lit("2024-02"))}, f"{tmp_path}/run", ["2024-02"])
    got = U.read_months(spark, f"{tmp_path}/run")
    assert {k: v.count() for k, v in got.items()} == {"curated": 2, "rct": 1}
    assert exists(spark, f"{tmp_path}/run/features/rct_csv/yyyymm=2024-01")


def test_owned_tables_go(spark):
    with owned(spark.range(5), spark.range(3)) as (a, b):
        folder = a.inputFiles()[0].rsplit("/", 2)[0]
        assert (a.count(), b.count(), exists(spark, folder)) == (5, 3, True)
    assert not exists(spark, folder)


# ---------------------------------------------------------------- live alignment


@pytest.fixture
def state_store(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    used = spark.conf.get(key)
    spark.conf.set(key, live_align.STATE_STORE)
    yield
    spark.conf.set(key, used)


def fed(spark, tmp_path, batches, transform):
    """What a stream has put out after each of several runs over one more file each."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    for rows in batches:
        samples(spark, rows).coalesce(1).write.mode("append").parquet(str(inbox))
        out = transform(spark.readStream.schema(samples(spark, []).schema).parquet(str(inbox)))
        writer = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state")
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{tmp_path}/out")


def live_batches():
    rng = random.Random(11)
    rows = [sample(rng.choice(["master", "slave"]), i, 7 * i + rng.choice([0, 0, 3, 0.25]), soc=rng.choice([None, 40.0 + i]), vehicle=rng.choice([1, 2])) for i in range(160)]
    # Out of order, but never by more than the delay.
    order = sorted(range(160), key=lambda i: i + rng.randrange(12))
    parts = [[rows[i] for i in order[k : k + 40]] for k in range(0, 160, 40)]
    late = sample("master", 900, 1, soc=99.0, vehicle=1)
    parts[3].append(late)
    flush = [sample("slave", 999, 9000, vehicle=9)]
    return rows, [*parts, flush]


def test_live_alignment_equals_the_batch(spark, tmp_path, state_store):
    rows, batches = live_batches()
    got = fed(spark, tmp_path, batches, lambda s: live_align.stream_align(s).drop("ts"))
    assert rows_of(got) == rows_of(align.align_nearest(samples(spark, rows)))


def test_live_minutes_equal_the_batch(spark, tmp_path, state_store):
    rows, batches = live_batches()
    got = fed(spark, tmp_path, batches, lambda s: live.stream_curate_minute(live_align.stream_align(s), lag_s=15.0))
    want = curate.curate_minute(align.align_nearest(samples(spark, rows)))
    assert near(rows_of(got)) == near(rows_of(want.select(*got.columns)))


def test_live_alignment_needs_its_state_store(spark):
    with pytest.raises(ValueError):
        live_align.stream_align(samples(spark, []))


@given(st.lists(st.integers(0, 60), max_size=12), st.lists(st.integers(0, 60), max_size=12), st.integers(0, 20))
def test_nearest(times, at, tolerance):
    at = sorted(set(at))
    got = live_align.nearest(np.array(times, np.int64), np.array(at, np.int64), tolerance)
    for t, i in zip(times, got.tolist()):
        close = [(abs(t - a), a) for a in at if abs(t - a) <= tolerance]
        assert (at[i] if i >= 0 else None) == (min(close)[1] if close else None)


# ---------------------------------------------------------------- errors by slice


def scored(spark):
    rows = []
    rng = random.Random(13)
    for s in ("train", "val", "test", None):
        for i, soc in enumerate([0.0, 20.0, 20.5, 25.0, 75.0, 80.0, 100.0, 100.5, -1.0, None] * 3):
            rows.append((s, soc, rng.choice([None, 5.0, -5.0, float(i)]), float(rng.randrange(0, 30)), rng.choice([None, float(rng.randrange(0, 30))]), f"2024-0{1 + i % 3}"))
    return spark.createDataFrame(rows, "split string, soc double, current double, rct_minutes double, prediction double, yyyymm string")


def plain_metrics(rows):
    e = [abs(r.rct_minutes - r.prediction) for r in rows]
    rel = [abs(r.rct_minutes - r.prediction) / r.rct_minutes for r in rows if r.rct_minutes >= 1]
    return (round((sum(x * x for x in e) / len(e)) ** 0.5, 9), round(sum(e) / len(e), 9), round(100 * sum(rel) / len(rel), 9) if rel else None, len(e))


def test_bundle_of_splits_and_slices(spark):
    table = scored(spark)
    got = {(r.split, r.slice_type, r.slice): tuple(None if x is None else round(x, 9) for x in (r.rmse, r.mae, r.mape, r.n)) for r in evaluate.metrics_bundle(table).collect()}
    rows = [r for r in table.collect() if r.rct_minutes is not None and r.prediction is not None]
    want = {}
    for s in ("train", "val", "test", None):
        own = [r for r in rows if r.split == s]
        want[s, "all", "all"] = plain_metrics(own)
        for lo in (0, 20, 40, 60, 80):
            band = [r for r in own if r.soc is not None and (lo < r.soc <= lo + 20 or lo == r.soc == 0)]
            if band:
                want[s, "soc_band", f"{lo}-{lo + 20}"] = plain_metrics(band)
        amps = [abs(r.current) for r in own if r.current is not None]
        edges = sorted(set(np.quantile(amps, np.arange(11) / 10).tolist()))
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            part = [r for r in own if r.current is not None and (a < abs(r.current) <= b or (i == 0 and abs(r.current) == a))]
            if part:
                want[s, "current_decile", str(i + 1)] = plain_metrics(part)
    assert got == want


def test_bundle_of_nothing(spark):
    assert evaluate.metrics_bundle(scored(spark).limit(0)).collect() == []


def test_currents_on_an_edge_are_within_it(spark):
    amps = [1.0] + 12 * [55.37] + [99.0]  # 55.37 * 0.7 + 55.37 * 0.3 is less than 55.37
    table = spark.createDataFrame([("s", 50.0, a, 10.0, 9.0) for a in amps], "split string, soc double, current double, rct_minutes double, prediction double")
    found = evaluate.metrics_bundle(table).filter("slice_type = 'current_decile'").collect()
    assert sorted((r.slice, r.slice_lo, r.slice_hi, r.n) for r in found) == [("1", 1.0, 55.37, 13), ("2", 55.37, 99.0, 1)]


def test_edges_of_bands(spark):
    rows = spark.createDataFrame([(float(s), 10.0, float(s)) for s in (0, 20, 25, 75, 80, 81)], "soc double, rct_minutes double, prediction double")
    assert sorted((r.soc_lo, r.n) for r in evaluate.metrics_by_soc_band(rows).collect()) == [(0, 2), (20, 1), (60, 2), (80, 1)]
    got = sorted(map(tuple, evaluate.avg_prediction_by_band(rows).collect()))
    # 20 and 25 are of the first band, 75 of the last but one; the last mean has 75 and 80.
    assert got == [(20, 22.5, 200.0, 22.5 - 77.5), (70, 75.0, 200.0, 22.5 - 77.5), (75, 80.0, 200.0, 22.5 - 77.5)]


def test_checks_compare_val(spark):
    rows = spark.createDataFrame([("gbt", "val", 1.0), ("gbt", "test", 0.5), ("ridge", "val", 2.0), ("ridge", "test", 0.5)], "model string, split string, rmse double")
    assert tuple(evaluate.success_checks(rows).first()) == (False, True)


# ---------------------------------------------------------------- sketches


def test_merged_sketches_keep_ranks(spark):
    rows = spark.range(200_000).select((F.col("id") % 12).cast("string").alias("yyyymm"), (F.pow(F.xxhash64("id") % 1000, F.lit(2)) / 7).alias("x"), F.rand(3).alias("y"))
    months = sketches.month_sketches(rows, {"x": F.col("x"), "y": F.col("y")})
    assert months.count() == 12
    found = sketches.merged(months, ["x", "y"])
    for c in ("x", "y"):
        for share in (0.0, 0.1, 0.5, 0.9, 1.0):
            q = found.select(sketches.quantile(c, share)).first()[0]
            low, high = rows.agg(F.avg((F.col(c) < q).cast("int")), F.avg((F.col(c) <= q).cast("int"))).first()
            assert low - sketches.RANK_ERROR <= share <= high + sketches.RANK_ERROR
    exact = quantiles(rows, F.col("y"), [0.25]).first().quantiles[0]
    assert abs(found.select(sketches.quantile("y", 0.25)).first()[0] - exact) < 2 * sketches.RANK_ERROR


def test_metrics_from_months_equal_those_from_rows(spark):
    table = scored(spark)
    months = evaluate.month_metrics(table)
    exact, merged = evaluate.regression_metrics(table).first(), evaluate.metrics_of_months(months).first()
    assert near([tuple(exact)[:3], (exact.n,)]) == near([tuple(merged)[:3], (merged.n,)])
    assert sum(r.n for r in evaluate.deciles_of_months(months).collect()) == table.filter("current is not null and prediction is not null").count()
    none = evaluate.metrics_of_months(evaluate.month_metrics(table.limit(0))).first()
    assert none.n is None and none.rmse is None and none.p90 is None


# ---------------------------------------------------------------- times that depend on the row before

MAP = st.one_of(
    st.tuples(st.just(0), st.integers(0, 5 * scan.DAY)),
    st.tuples(st.just(1), st.integers(0, scan.DAY - 1)),
    st.tuples(st.just(2), st.integers(0, 5 * scan.DAY)),
    st.tuples(st.just(3), st.integers(0, 5 * scan.DAY)),
    st.tuples(st.just(-1), st.just(0)),
)


@settings(max_examples=200, deadline=None)
@given(st.lists(MAP, max_size=14), st.integers(0, 5 * scan.DAY), st.booleans())
def test_maps_compose(rows, start, number_before):
    kind, at = np.array([k for k, _ in rows], np.int64), np.array([a for _, a in rows], np.int64)
    last, held, want = start, start if number_before else None, []
    for k, a in rows:
        if k == 0:
            last, held = a, None
        elif k == 1:
            last, held = last + (a - last) % scan.DAY, None
        elif k == 2:
            last, held = (a if a >= last else last + 1_000_000), None
        elif k == 3:
            held = a if held is None else max(held, a)
            last = held
        want.append(last)
    maps = scan.row_maps(kind, at, scan.last_valid(kind, 3 if number_before else -1) == 3)
    assert scan.scanned(maps)(np.full(len(rows), start)).tolist() == want
    assert int(scan.joined(maps)(np.array([start]))[0]) == (want[-1] if want else start)
    for cut in range(len(rows) + 1):
        both = scan.then(scan.joined(maps.at(slice(None, cut))), scan.joined(maps.at(slice(cut, None))))
        assert int(both(np.array([start]))[0]) == (want[-1] if want else start)


def plain_times(texts, start):
    """The rules row by row."""
    import re

    last, held, out = start, None, []
    for t in texts:
        now = None
        if t and (m := re.fullmatch(r"(\d{4})-(\d\d)-(\d\d) (\d\d):(\d\d):(\d\d)", t)):
            now, held = datetime(*map(int, m.groups())), None
        elif t and (m := re.fullmatch(r"((?:[01]?\d|2[0-3])):([0-5]\d)(?::([0-5]\d))?", t)):
            now = datetime(last.year, last.month, last.day, int(m[1]), int(m[2]), int(m[3] or 0))
            now, held = now + timedelta(days=now < last), None
        elif t and (m := re.fullmatch(r"(\d{1,3}):([0-5]\d)", t)):
            now, held = start + timedelta(minutes=int(m[1]), seconds=int(m[2])), None
            now = now if now >= last else last + timedelta(seconds=1)
        elif t and re.fullmatch(r"\d+(\.\d+)?", t):
            held = float(t) if held is None else max(held, float(t))
            now = start + timedelta(seconds=held)
        last = now or last
        out.append(now)
    return out


def test_long_files_are_scanned_in_blocks(spark):
    rng = random.Random(17)
    kinds = [lambda: f"{rng.randrange(24, 999)}:{rng.randrange(60):02d}", lambda: f"{rng.randrange(24):02d}:{rng.randrange(60):02d}", lambda: str(rng.randrange(90_000)), lambda: f"{rng.randrange(90_000)}.5", lambda: "abc", lambda: None, lambda: f"2024-03-{rng.randrange(1, 29):02d} 10:11:12"]
    files = {f: [rng.choice(kinds)() for _ in range(n)] for f, n in ((0, 700), (1, 40), (2, 1), (3, 60))}
    files[3] = ["75:30"] + [str(rng.randrange(9000)) for _ in range(59)]  # numbers up to the end
    files[4] = ["abc", None, "99:59"]
    rows = [(f, "2024-03", i, t) for f, texts in files.items() for i, t in enumerate(texts)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "f long, yyyymm string, line int, text string")
    got = {(r.f, r.line): r.ts_local for r in parse_local(table, "text", "yyyymm", ["f"], ["line"]).collect()}
    for f, texts in files.items():
        assert [got[f, i] for i in range(len(texts))] == plain_times(texts, datetime(2024, 3, 1)), f
    assert len(got) == len(rows)
