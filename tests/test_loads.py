"""Day windows, idempotent loads, run order."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import days as sink
from tidemark.sinks.layouts import LAYOUTS, to_layout
from tidemark.streaming.incremental import DayWindow, Report, load, next_window, run_all

D = dt.date


def rows(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("day", "n").collect())


def frame(spark, *pairs):
    return spark.createDataFrame([(D(2024, 1, d), n) for d, n in pairs], "day date, n int")


def test_window():
    assert next_window(D(2024, 1, 1), D(2024, 1, 5)) == DayWindow(D(2024, 1, 2), D(2024, 1, 4))
    assert next_window(D(2024, 1, 4), D(2024, 1, 5)).empty and len(next_window(D(2024, 1, 4), D(2024, 1, 5))) == 0


def test_replacing_days(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.replace_days(frame(spark, (1, 1), (2, 2), (3, 3)), path, D(2024, 1, 1), D(2024, 1, 3))
    for _ in range(2):  # twice gives the same table; day 2 is emptied, day 9 is outside the window
        sink.replace_days(frame(spark, (3, 30), (9, 9)), path, D(2024, 1, 2), D(2024, 1, 3))
        assert rows(spark, path) == [(D(2024, 1, 1), 1), (D(2024, 1, 3), 30)]


def test_files_are_sorted(spark, tmp_path):
    rows = [(D(2024, 1, 1), n) for n in (5, 3, 9, 1)]
    sink.append_days(spark.createDataFrame(rows, "day date, n int"), str(tmp_path / "t"), sort=("n",))
    got = spark.read.parquet(str(tmp_path / "t")).select("n", F.col("_metadata.file_path").alias("f")).collect()
    by_file = {}
    for r in got:
        by_file.setdefault(r.f, []).append(r.n)
    assert all(v == sorted(v) for v in by_file.values()) and len(got) == 4


def test_two_windows_equal_one(spark, tmp_path):
    data = frame(spark, *[(d, d) for d in range(1, 11)])
    report = Report("r", lambda w: data.filter(F.col("day").between(F.lit(w.start), F.lit(w.end))), default=D(2023, 12, 31))
    for today in (D(2024, 1, 5), D(2024, 1, 5), D(2024, 1, 9)):
        load(spark, report, str(tmp_path / "steps"), today)
    load(spark, report, str(tmp_path / "once"), D(2024, 1, 9))
    assert rows(spark, str(tmp_path / "steps")) == rows(spark, str(tmp_path / "once"))
    assert sink.high_water_mark(spark, str(tmp_path / "once"), D(2000, 1, 1)) == D(2024, 1, 8)


def test_up_to_date_table_is_not_touched(spark, tmp_path):
    def fail(w):
        raise AssertionError("nothing to load")

    sink.append_days(frame(spark, (4, 1)), str(tmp_path / "t"))
    assert load(spark, Report("r", fail, default=D(2020, 1, 1)), str(tmp_path / "t"), D(2024, 1, 5)).empty


def test_run_order(spark, tmp_path):
    a = Report("a", lambda w: frame(spark, (1, 1)), default=D(2023, 12, 31), mode="append")
    b = Report("b", lambda w: spark.read.parquet(f"{tmp_path}/a"), default=D(2023, 12, 31), after=("a",))
    c = Report("c", lambda w: frame(spark, (1, 7)), mode="refresh")
    done = run_all(spark, [a, b, c], str(tmp_path), D(2024, 1, 2))
    assert list(done) == ["a", "b", "c"] and rows(spark, f"{tmp_path}/b") == [(D(2024, 1, 1), 1)]
    assert list(run_all(spark, [b], str(tmp_path), D(2024, 1, 2))) == ["b"]  # its table of an earlier run is there
    with pytest.raises(ValueError, match="after a"):
        run_all(spark, [b], str(tmp_path / "elsewhere"), D(2024, 1, 2))


def test_layout_adds_placeholders(spark):
    cols = [c if isinstance(c, str) else None for c in LAYOUTS["agent_day"]]
    df = spark.range(1).select(*[F.lit(1).alias(c) for c in cols if c])
    got = to_layout(df, "agent_day").collect()[0].asDict()
    assert got["normal_dev_num"] is None and got["trip_cnt"] == 1 and list(got)[4:6] == ["total_play_dev_cnt", "normal_dev_num"]


class _Session:
    """Just the two settings shared_dir reads."""

    def __init__(self, folder, master):
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.sparkContext = type("C", (), {"master": master})


def test_shared_folder_is_the_clusters():
    from tidemark.session import shared_dir

    assert shared_dir(_Session("hdfs://x/tmp/", "spark://m:7077")) == "hdfs://x/tmp"
    for master in ("local[2]", "spark://m:7077"):
        with pytest.raises(RuntimeError):
            shared_dir(_Session(None, master))
