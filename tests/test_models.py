"""Headers from first blocks; imputation, ridge and tree search against plain rules."""

import io
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from chargeflow.operators import model
from chargeflow.settings import LABEL
from chargeflow.sources import headers as H
from chargeflow.sources import unit_files as U

# ---------------------------------------------------------------- headers


@pytest.mark.parametrize(
    "raw, head, encoding, rows",
    [
        (b"", None, "UTF-8", False),
        (b"# only\n#comments\n", None, "UTF-8", False),
        (b"\n  \n", None, "UTF-8", False),
        (b"time,soc", "time,soc", "UTF-8", False),
        (b"time,soc\n", "time,soc", "UTF-8", False),
        (b"time,soc\n1,2", "time,soc", "UTF-8", True),
        (b"\xef\xbb\xbf# x\n\ntime;soc\r\n# y\r\n1;2\r\n", "time;soc", "UTF-8", True),
        ("time;spéed\n1;2\n".encode("latin-1"), "time;spéed", "ISO-8859-1", True),
        ("time;spéed\n1;2\n".encode(), "time;spéed", "UTF-8", True),
        ("time,soc\n1,2\n".encode("utf-16"), "time,soc", "UTF-16LE", True),
        (b"\xfe\xff" + "time,soc\n1,2\n".encode("utf-16-be"), "time,soc", "UTF-16BE", True),
    ],
)
def test_header_lines(raw, head, encoding, rows):
    for block in (2, 3, 7, 64, H.BLOCK):
        if encoding.startswith("UTF-16") and block < 4:
            continue
        assert H.first_line(io.BytesIO(raw), block)[:3] == (head, encoding, rows), block


def test_bytes_read_do_not_depend_on_the_length(spark, tmp_path):
    for name, lines in (("a", 10_000), ("b", 200_000)):
        (tmp_path / f"{name} 2024-03.csv").write_text("# note\ntime,soc\n" + "2024-03-05 10:00:00,50\n" * lines)
    (tmp_path / "c_2024-03.csv").write_bytes(b"x" * (4 << 20))  # no line end at all
    found = {r.file.rsplit("/", 1)[1][0]: r for r in H.headers(spark, [str(tmp_path)]).collect()}
    assert found["a"].bytes_read == found["b"].bytes_read == H.BLOCK and found["b"].head == "time,soc" and found["b"].rows
    assert found["c"].head is None and found["c"].bytes_read <= 2 * H.LONGEST
    assert H.headers(spark, [str(tmp_path)]).count() == 3


def test_readers_of_stores_that_only_spark_reaches(spark, tmp_path):
    (tmp_path / "a_2024-03.csv").write_text("# note\ntime,soc\n1,2\n")
    a, b = H.headers(spark, [str(tmp_path)]).first(), H._by_spark(spark, [str(tmp_path)]).first()
    assert (a.head, a.encoding, a.rows) == (b.head, b.encoding, b.rows)


def test_files_of_utf_16_are_read(spark, tmp_path):
    (tmp_path / "u_2024-03.csv").write_bytes("time,soc\n2024-03-05 10:00:00,50\n2024-03-05 10:01:00,51\n".encode("utf-16"))
    (tmp_path / "v_2024-03.csv").write_text("# nothing but this\n")
    got = U.read_month_csv(spark, [str(tmp_path)], "master", 7)
    assert sorted((r.ts_raw, r.soc) for r in got.collect()) == [("2024-03-05 10:00:00", 50.0), ("2024-03-05 10:01:00", 51.0)]


# ---------------------------------------------------------------- models


def test_medians_are_exact_and_deviations_those_of_the_population(spark):
    rows = spark.range(1, 100_001).select(F.col("id").cast("double").alias("a"), F.when(F.col("id") % 3 == 0, F.col("id") % 7).cast("double").alias("b"), F.lit(4.0).alias("c"), F.lit(None).cast("double").alias("d"))
    fit = model.impute_standardize(rows, ["a", "b", "c", "d"])
    assert "50000.5D" in fit.stages[0].getStatement()
    x = np.array([r[0] for r in fit.transform(rows.limit(100_000)).select(vector_to_array("features")).collect()])
    b = np.array([i % 7 if i % 3 == 0 else np.nan for i in range(1, 100_001)], float)
    b = np.where(np.isnan(b), np.nanmedian(b), b)
    want = np.column_stack([np.arange(1, 100_001.0), b])
    want = (want - want.mean(0)) / want.std(0)
    assert np.allclose(np.sort(x[:, :2], 0), np.sort(want, 0)) and not x[:, 2:].any()


FEATURES = ["soc", "x1", "x2"]


def table(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        soc, a, b = rng.uniform(0, 100), rng.uniform(-2, 2), rng.choice([None, rng.uniform(0, 9)])
        y = 40 + 25 * np.sin(2 * a) + 6 * (soc > 50) * (b or 4) + rng.gauss(0, 1)
        rows.append((i, soc, a, b, float(y), "val" if i % 5 == 0 else "train"))
    return spark.createDataFrame(rows, f"i int, soc double, x1 double, x2 double, {LABEL} double, split string")


def test_ridge_solves_the_normal_equations(spark):
    rows = table(spark)
    fit = model.ridge_baseline(rows, FEATURES, alpha=30.0)
    x = np.array([[r.soc, r.x1, np.nan if r.x2 is None else r.x2] for r in rows.collect()])
    y = np.array([r[LABEL] for r in rows.collect()])
    x = np.where(np.isnan(x), np.nanmedian(x, 0), x)
    z = (x - x.mean(0)) / x.std(0)
    w = np.linalg.solve(z.T @ z + 30.0 * np.eye(3), z.T @ (y - y.mean()))
    assert np.allclose(fit.stages[-1].coefficients.toArray(), w, rtol=1e-5) and fit.stages[-1].intercept == pytest.approx(y.mean())
    got = {r.i: r.prediction for r in model.predict_batch(rows, fit).collect()}
    assert np.allclose([got[i] for i in range(len(y))], np.maximum(z @ w + y.mean(), 0), rtol=1e-5)


def test_rungs_halve():
    assert model.rungs_of(48, 100, 3) == [(48, 25), (24, 50), (12, 100)]
    assert model.rungs_of(1, 1, 4) == [(1, 1)] * 4 and model.rungs_of(5, 8, 1) == [(5, 8)]


def test_search_beats_ridge_and_repeats(spark):
    rows = table(spark)
    best, tried = model.gbt_search(rows, FEATURES, trials=4, rounds=8, rungs=2, at_once=4)
    again = model.gbt_search(rows, FEATURES, trials=4, rounds=8, rungs=2, at_once=1)[1]
    assert tried == again and sorted(t["rung"] for t in tried) == [0, 0, 1, 1]
    rmse = lambda m: model.predict_batch(rows.filter("split = 'val'"), m).agg(F.sqrt(F.avg((F.col("prediction") - F.col(LABEL)) ** 2))).first()[0]
    tree, line = rmse(best), rmse(model.ridge_baseline(rows.filter("split = 'train'"), FEATURES))
    assert tree < 0.8 * line and tree == pytest.approx(min(t["rmse"] for t in tried if t["rung"] == 1))


def test_csv_requests_may_be_quoted(spark):
    bodies = spark.createDataFrame([(1, '1.5,"2",x\n"3,5", 4 ,5,6\n'), (2, "7"), (3, None)], "id long, body string")
    got = U.parse_scoring_requests(bodies, "body", ["a", "b", "c"]).orderBy("id", "instance").collect()
    assert [tuple(r)[2:] for r in got] == [(0, 1.5, 2.0, None), (1, None, 4.0, 5.0), (0, 7.0, None, None)]
