import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chargeflow.functions.timeparse import parse_local
from chargeflow.operators.align import align_nearest
from chargeflow.sources import unit_files as U


def times(spark, values, month="2024-03"):
    rows = spark.createDataFrame([(1, month, i, v) for i, v in enumerate(values)], "vehicle_id long, yyyymm string, seq long, t string")
    out = parse_local(rows, "t", "yyyymm", ["vehicle_id", "yyyymm"], ["seq"])
    return [r.ts_local for r in out.orderBy("seq").collect()]


def at(d, h=0, m=0, s=0):
    return datetime(2024, 3, d, h, m, s)


def test_absolute_times(spark):
    values = ["5/03/2024 3:07:09 PM", "05/03/2024  15:07", "2024-03-05 15:07:09", "2024-03-05T04:07:09Z", "abc", "", None, "31/02/2024 10:00", "05/03/2024 12:01 am"]
    assert times(spark, values) == [at(5, 15, 7, 9), at(5, 15, 7), at(5, 15, 7, 9), at(5, 15, 7, 9), None, None, None, None, at(5, 0, 1)]


def test_clock_values_carry_the_date_and_roll_over(spark):
    values = ["10:00", "05/03/2024 23:58", "23:59", "bad", "00:01", "00:00:30", "07/03/2024 01:00", "00:59"]
    assert times(spark, values) == [at(1, 10), at(5, 23, 58), at(5, 23, 59), None, at(6, 0, 1), at(7, 0, 0, 30), at(7, 1), at(8, 0, 59)]


def test_numbers_are_held_within_a_run(spark):
    values = ["3600", "3599.5", "bad", "3601", "05/03/2024 10:00", "60", "00:00:30"]
    assert times(spark, values) == [at(1, 1), at(1, 1), None, at(1, 1, 0, 1), at(5, 10), at(1, 0, 1), at(2, 0, 0, 30)]


def test_minutes_go_on_by_a_second_where_they_would_go_back(spark):
    values = ["75:30", "74:00", "02/03/2024 01:00", "90:00", "01:30", "100"]
    assert times(spark, values) == [at(1, 1, 15, 30), at(1, 1, 15, 31), at(2, 1), at(2, 1, 0, 1), at(2, 1, 30), at(1, 0, 1, 40)]


@pytest.fixture
def folder(tmp_path):
    m, s = tmp_path / "master", tmp_path / "slave"
    m.mkdir(), s.mkdir()
    (m / "unit_2024-03.csv").write_text("﻿# logger 7\n\nTime,avg_soc,Voltage,pack_current,km_driven,empty\n2024-03-05 10:00:00,50,650,-20,1000,\n# note\n2024-03-05 10:00:30,x,651,-21,1001,\n1,2,3,4,5,6,7,8\n", encoding="utf-8")
    (m / "unit_2024-04.csv").write_bytes("timestamp;soc;spéed;avg_soc\n01/04/2024 10:00;;9;77\n".encode("latin-1"))
    (s / "unit_2024-03.CSV").write_text("dt\tslave_soc\tslave_voltage\tslave_current\n2024-03-05 10:00:10\t49\t640\t-10\n")
    (s / "unit_2024-05.csv").write_text("dt,slave_soc\n")
    return m, s


def test_unit_files_of_all_dialects(spark, folder):
    master = U.read_month_csv(spark, [str(folder[0])], "master", 7)
    got = [(r.yyyymm, r.ts_raw, r.soc, r.voltage, r.current, r.speed, r.km) for r in master.orderBy("yyyymm", "seq").collect()]
    assert got == [("2024-03", "2024-03-05 10:00:00", 50.0, 650.0, -20.0, None, 1000.0), ("2024-03", "2024-03-05 10:00:30", None, 651.0, -21.0, None, 1001.0), ("2024-04", "01/04/2024 10:00", 77.0, None, None, None, None)]
    assert U.read_month_csv(spark, [str(folder[0])], "master", 7, ["2024-04"]).count() == 1
    slave = U.read_month_csv(spark, [str(folder[1])], "slave", 7)
    aligned = align_nearest(U.unit_samples(master, slave)).orderBy("ts_local").collect()
    assert [(r.soc_master, r.soc_slave, r.current) for r in aligned] == [(50.0, 49.0, -30.0), (50.0, 49.0, -30.0), (None, None, -21.0), (77.0, None, None)]


def test_written_tables_come_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-03", 1.0), (2, "2024-04", 2.0)], "vehicle_id long, yyyymm string, soc double")
    U.write_monthly(df, f"{tmp_path}/t")
    assert U.consolidate_curated(spark, f"{tmp_path}/t", ["2024-04"]).select("vehicle_id").collect() == [(2,)]
    assert U.read_any(spark, f"{tmp_path}/t").count() == 2
    U.write_monthly(df, f"{tmp_path}/c.csv", csv=True)
    assert U.read_any(spark, f"{tmp_path}/c.csv").agg(F.sum("soc")).first()[0] == 3.0
    assert U.union_months([df, df.drop("soc")]).filter("soc is null").count() == 2


def test_training_set_files(spark, tmp_path):
    rows = spark.createDataFrame([("train", 1.0, 2.0, 3.0), ("test", 4.0, 5.0, 6.0)], "split string, a double, b double, rct_minutes double")
    schema = U.write_training_set(rows, str(tmp_path / "out"), ["b", "a"])
    assert schema["rows"] == {"train": 1, "val": 0, "test": 1}
    assert spark.read.text(f"{tmp_path}/out/feature_list").count() == 2
    assert json.loads(spark.read.text(f"{tmp_path}/out/schema").first()[0]) == schema
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/data").columns == ["b", "a", "rct_minutes", "split"]


def test_scoring_requests(spark):
    bodies = ['{"instances":[{"a":1,"b":2},{"a":3}]}', '{"inputs":[{"b":4}]}', '{"a":5,"b":6}', '[{"a":7}]', "8,9\n10,\n", '{"x":1}', "", None]
    df = spark.createDataFrame(list(enumerate(bodies)), "id long, body string")
    got = sorted((r.id, r.instance, r.a, r.b) for r in U.parse_scoring_requests(df, "body", ["a", "b"]).collect())
    assert got == [(0, 0, 1.0, 2.0), (0, 1, 3.0, None), (1, 0, None, 4.0), (2, 0, 5.0, 6.0), (3, 0, 7.0, None), (4, 0, 8.0, 9.0), (4, 1, 10.0, None)]
