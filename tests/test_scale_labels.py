"""Groups with one label keep figures of their own."""

from __future__ import annotations

import datetime as dt

import pytest

from tidemark.plans import scale, trip_day

DAY = dt.date(2024, 1, 5)


@pytest.fixture
def tables(spark):
    none = "device_name string, add_time timestamp_ntz"
    return scale.ScaleInputs(
        spark.createDataFrame([("a", DAY), ("b", DAY), ("c", DAY)], "sn string, day date"), spark.createDataFrame([], none), spark.createDataFrame([], none), [],
        spark.createDataFrame([], "sn string, day date, tag string"), spark.createDataFrame([], "device_name string, day date"),
        spark.createDataFrame([(DAY,)], "day date"))


def test_trip_figures_go_to_their_own_group(spark, tables):
    bindings = spark.createDataFrame([("a", None, "x", DAY), ("b", 0, "x", DAY), ("c", 0, None, DAY)], "third_code string, city_sn int, car_type string, bind_day date")
    figures = spark.createDataFrame(
        [(DAY, None, "x", 0, 7, 600.0), (DAY, 0, "x", 0, 1, 6000.0), (DAY, 0, None, 0, 9, 60.0)],
        "date date, city_sn int, car_type string, total_play_dev_cnt long, trip_cnt long, trip_time_sum double")
    got = scale.device_scale(tables, bindings, figures, DAY, DAY)
    assert sorted((r.city_sn, r.car_type, r.trip_cnt, r.trip_time) for r in got.collect()) == [(0, "0", 0, 0.0), (0, "x", 0, 0.0), (0, "x", 1, 100.0)]


def test_the_trip_report_has_both_groups(spark):
    figures = spark.createDataFrame([(DAY, None, None, 1), (DAY, 0, "0", 2)], "date date, city_sn int, car_type string, trip_cnt long")
    assert sorted(map(tuple, trip_day.trip_labels(figures).collect())) == [(DAY, 0, "0", 1), (DAY, 0, "0", 2)]
