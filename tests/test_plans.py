"""Physical plans of the main jobs: how often tables are read and dealt out."""

import random
import re

import pytest
from pyspark.sql import functions as F

from chargeflow.operators import soc_bands
from chargeflow.plans import registry
from chargeflow.settings import SESSION

SMALL = "/root/testdata/sf0.001"


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


def count(text, what):
    return len(re.findall(rf"(?m)^[ :+*()\d-]*{what}", text))


@pytest.mark.parametrize("name, scans, exchanges", [("j1_align_asof", 1, 1), ("a1_curate_minute", 1, 1), ("w2_split_sessions", 1, 1), ("w5_rct_rows", 1, 1), ("a4_session_quality", 1, 1), ("j1_align_in_chunks", 1, 1), ("a1_curate_in_chunks", 1, 1), ("w2_windows_by_vehicle", 1, 4)])
def test_one_scan_and_few_shuffles(spark, name, scans, exchanges):
    text = plan(registry.queries()[name](spark, SMALL))
    assert count(text, "(?:File)?Scan parquet") == scans
    assert count(text, "Exchange") <= exchanges


@pytest.mark.parametrize("name", ["w5_rct_rows", "a5_soc_modal_buckets", "w11_sliding_soc_bands", "w12_band_current_stats", "w9_minutes_per_band", "l1_group_split", "a12_regression_metrics", "w5_across_months"])
def test_no_window_over_a_whole_table(spark, name):
    text = plan(registry.queries()[name](spark, SMALL))
    # A window without keys is one task; only sums over a few thousand counts may be such.
    lone = [line for line in text.split("\n") if re.search(r"Window \[.*windowspecdefinition\((?:specifiedwindowframe|_p#\d+ ASC)", line)]
    assert all("_before" in line or " AS n#" in line for line in lone)


def test_charging_rows_of_a_table_without_the_pack(spark):
    """The pack's current is the master's, else the slave's, where the table has none."""
    rct = registry.queries()["w5_rct_rows"](spark, SMALL)
    alone = rct.drop("current", "current_slave")
    stats = soc_bands.interval_samples(alone)
    by = {r.series: r for r in stats.groupBy("series").agg(F.count("mean_abs_current").alias("known"), F.count(F.lit(1)).alias("n"), F.sum("mean_abs_current").alias("sum")).collect()}
    assert by["slave"].known == 0 < by["slave"].n == by["pack"].n
    assert (by["pack"].known, by["pack"].sum) == (by["master"].known, by["master"].sum) and by["pack"].known > 0
    assert stats.count() == 3 * stats.select(*SESSION, "soc_start").distinct().count()


def test_means_of_bands_over_plateaus_and_jumps(spark):
    """Against every pair of band and sample: charge that stands still, then jumps."""
    rng = random.Random(4)
    rows = []
    for s in range(12):
        soc = 20.0
        for t in range(40):
            soc = min(100.0, soc + rng.choice([0, 0, 0, 0.2, 1, 7.5, 20]) * rng.choice([1, 1, 0]))
            rows.append((1, "2024-01", s, float(t), rng.choice([soc, soc, None]), rng.choice([None, -rng.uniform(1, 90)]), -5.0))
    table = spark.createDataFrame(rows, "vehicle_id long, yyyymm string, session_id long, tmin double, soc double, i_eff double, current_master double")
    bands = soc_bands.sliding_soc_bands(table)
    got = {(r.session_id, r.soc_start): r.mean_abs_current for r in soc_bands.band_current_stats(bands, table).filter("series = 'pack'").collect()}
    known = {}
    for _, _, s, t, soc, amps, _ in rows:
        if soc is not None and amps is not None:
            known.setdefault(s, []).append((t, abs(amps)))
    n = 0
    for b in bands.collect():
        own = sorted(known.get(b.session_id, []))
        points = [p for p in own if b.t0 <= p[0] <= b.t1]
        if own and b.t0 < own[0][0]:
            points = [(b.t0, own[0][1]), *points]
        if own and b.t1 > own[-1][0]:
            points = [*points, (b.t1, own[-1][1])]
        steps = [(y[0] - x[0], (x[1] + y[1]) / 2) for x, y in zip(points, points[1:])]
        time = sum(d for d, _ in steps)
        want = sum(d * m for d, m in steps) / time if time > 0 else sum(a for _, a in points) / len(points) if points else None
        assert got[b.session_id, b.soc_start] == (None if want is None else pytest.approx(want))
        n += len(points) > 2
    assert n > 20 and len(got) == bands.count()
