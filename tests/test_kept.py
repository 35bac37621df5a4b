"""Kept state: a run may stop after any of its writes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import DataFrameWriter

from test_loads import frame as day_frame
from testbed.registry import plain
from tidemark.plans import plays, scale
from tidemark.sinks import days as sink
from tidemark.streaming import kept
from tidemark.streaming.incremental import DayWindow, Report, load

D = dt.date
HISTORY = D(2023, 1, 1)


class Stop(Exception):
    pass


def stop_after(monkeypatch, writes: int):
    """Let so many tables be written and stop at the next."""
    real, done = DataFrameWriter.parquet, []

    def parquet(self, *args, **kw):
        if len(done) == writes:
            raise Stop
        done.append(args)
        return real(self, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)


EVENT = """p_date date, devicename string, traceid string, contentid string, tag string, message string, env string, versioncode string,
 playtime double"""


def events(spark, *more):
    """One new device a day, and one that comes every day."""
    rows = [(D(2024, 1, d), dev, f"t{d}", "c", "splash_show_begin", "", "prod", "200", 1.0) for d in range(1, 9) for dev in (f"d{d}", "always")]
    return spark.createDataFrame(rows + [(D(2024, 1, d), dev, "t", "c", "splash_show_begin", "", "prod", "200", 2.0) for d, dev in more], EVENT)


def report(rows) -> Report:
    return Report("total", None, day="date", default=D(2024, 1, 2),
                  run=lambda w, s: plays.content_play_run(rows, None, w.start, w.end, s, history=HISTORY))


def figures(spark, path):
    return sorted((r.date.day, r.total_play_dev_cnt, r.total_play_cnt, r.total_play_time) for r in spark.read.parquet(path).collect())


WANT = [(d, d + 1, 2 * d, 2.0 * d) for d in range(3, 9)]


def test_a_run_may_stop_after_any_write(spark, tmp_path, monkeypatch):
    rows, stops = events(spark), 0
    for writes in range(20):
        path = str(tmp_path / f"t{writes}")
        load(spark, report(rows), path, D(2024, 1, 5))
        with monkeypatch.context() as m:
            stop_after(m, writes)
            try:
                load(spark, report(rows), path, D(2024, 1, 7))
            except Stop:
                stops += 1
        for today in (D(2024, 1, 7), D(2024, 1, 9)):
            load(spark, report(rows), path, today)
        assert figures(spark, path) == WANT, f"stopped after {writes} writes"
        if stops <= writes:  # this run was not stopped any more
            break
    assert stops >= 4  # added rows, totals, the commit, the report


def test_a_table_behind_or_ahead_of_its_state(spark, tmp_path):
    path, rows = str(tmp_path / "t"), events(spark)
    for today in (D(2024, 1, 4), D(2024, 1, 5), D(2024, 1, 6)):
        load(spark, report(rows), path, today)
    before = kept.kept(spark, path)
    kept.commit(spark, path, report(rows).run(DayWindow(D(2024, 1, 6), D(2024, 1, 8)), before.state), D(2024, 1, 8), before)
    assert kept.kept(spark, path).upto == D(2024, 1, 8) and kept.kept(spark, path, D(2024, 1, 7)).upto == D(2024, 1, 5)
    assert load(spark, report(rows), path, D(2024, 1, 8)) == DayWindow(D(2024, 1, 6), D(2024, 1, 7))  # back to the table's mark
    assert kept.kept(spark, path).upto == D(2024, 1, 7)  # the state ahead of it is left behind
    load(spark, report(rows), path, D(2024, 1, 9))
    assert figures(spark, path) == WANT
    # a table that has days the state lacks is loaded from the state's day on
    other = str(tmp_path / "other")
    load(spark, report(rows), other, D(2024, 1, 5))
    sink.replace_days(spark.read.parquet(path), other, D(2024, 1, 5), D(2024, 1, 7), "date")
    assert load(spark, report(rows), other, D(2024, 1, 9)).start == D(2024, 1, 5)
    assert figures(spark, other) == WANT


def test_without_its_state_the_history_is_read(spark, tmp_path):
    path, rows = str(tmp_path / "t"), events(spark)
    sink.replace_days(spark.createDataFrame([(D(2024, 1, 6), "c", "splash_show_begin", 0, 0.0, 0)],
                                            "date date, contentid string, tag string, total_play_cnt long, total_play_time double, total_play_dev_cnt long"),
                      path, D(2024, 1, 6), D(2024, 1, 6), "date")
    assert load(spark, report(rows), path, D(2024, 1, 9)).start == D(2024, 1, 7)
    assert figures(spark, path)[1:] == WANT[4:]


def test_a_day_is_loaded_again(spark, tmp_path):
    path, late = str(tmp_path / "t"), events(spark, (4, "d9"), (4, "d8"))
    for today in (D(2024, 1, 4), D(2024, 1, 6), D(2024, 1, 8)):
        load(spark, report(events(spark)), path, today)
    assert load(spark, report(late), path, D(2024, 1, 8), since=D(2024, 1, 4)) == DayWindow(D(2024, 1, 4), D(2024, 1, 7))
    load(spark, report(late), path, D(2024, 1, 9))
    once = str(tmp_path / "once")
    load(spark, report(late), once, D(2024, 1, 9))
    assert figures(spark, path) == figures(spark, once) and figures(spark, path) != WANT
    # states of the former line are not used any more, although they cover earlier days than the last one
    assert kept.kept(spark, path, D(2024, 1, 6)).upto == D(2024, 1, 3)


def test_many_commits_are_read_from_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(kept, "WHOLE_EVERY", 2)
    path, rows = str(tmp_path / "t"), events(spark)
    for d in range(4, 10):
        load(spark, report(rows), path, D(2024, 1, d))
        assert len(kept.kept(spark, path).commits) <= 2
    assert figures(spark, path) == WANT and len(kept.commits(spark, path)) == 6
    load(spark, report(events(spark, (5, "x"))), path, D(2024, 1, 9), since=D(2024, 1, 5))  # back beyond a whole one
    assert figures(spark, path)[2:] == [(d, d + 2, 2 * d + 1, 2.0 * d + 2) for d in range(5, 9)]


def trips(spark, *rows):
    return spark.createDataFrame([(dev, dt.datetime(2024, 1, d)) for dev, d in rows], "device_name string, add_time timestamp_ntz")


def test_first_days_meet_bindings_at_report_time(spark, tmp_path):
    beats = spark.createDataFrame([("a", D(2024, 1, 2)), ("b", D(2024, 1, 4)), ("a", D(2024, 1, 6))], "sn string, day date")
    t = scale.ScaleInputs(beats, trips(spark, ("b", 3), ("c", 6)), trips(spark, ("a", 5)), [trips(spark, ("c", 1))],
                          spark.createDataFrame([], "sn string, day date, tag string"), spark.createDataFrame([], "device_name string, day date"))
    path = str(tmp_path / "firsts")
    state = Report("firsts", None, mode="state", default=D(2024, 1, 1), run=lambda w, s: scale.firsts_run(t, w.start, w.end, s))
    for today in (D(2024, 1, 3), D(2024, 1, 5), D(2024, 1, 5), D(2024, 1, 8)):
        load(spark, state, path, today)
    got = scale.merged_firsts(kept.kept(spark, path).state.seen)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, scale.device_firsts(t, "2024-01-07").collect()))
    bind = lambda day: spark.createDataFrame([("a", 1, day), ("b", 1, D(2024, 1, 1))], "third_code string, city_sn int, bind_day date")
    for day, beats_on_5 in ((D(2024, 1, 1), 2), (D(2024, 1, 6), 1)):
        total = scale.device_totals(got, bind(day), ["city_sn"], "2024-01-05", "2024-01-05").first()
        assert (total.total_heartbeat_dev_num, total.total_trip_dev_num) == (beats_on_5, 2)


def test_a_stopped_refresh_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n in (1, 2, 3, 4):
        sink.refresh(day_frame(spark, (n, n)), path)
        assert [r.n for r in sink.read_report(spark, path).collect()] == [n]
    for writes in (0, 1):
        with monkeypatch.context() as m:
            stop_after(m, writes)
            with pytest.raises(Stop):
                sink.refresh(day_frame(spark, (9, 9)), path)
        assert [r.n for r in sink.read_report(spark, path).collect()] == [4]
    sink.refresh(day_frame(spark, (5, 5)), path)
    assert [r.n for r in sink.read_report(spark, path).collect()] == [5]


def test_a_missing_table_is_an_error(spark, tmp_path):
    like, path = day_frame(spark, (1, 1)), str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sink.read_loaded(like, path)
    sink.replace_days(like.filter("n > 5"), path, D(2024, 1, 1), D(2024, 1, 2))  # loaded, without rows
    assert sink.read_loaded(like, path).collect() == [] and sink.exists(spark, path) and not sink.exists(spark, path + "x")


def test_rows_in_order_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).selectExpr("id * 7919 % 1009 AS n", "id").repartition(7)
    sink.refresh(rows, path, order=["n"])
    table = sink.read_report(spark, path)
    got = sink.read_ordered(table)
    assert got.columns == ["n", "id", "place"] and table.select("_metadata.file_path").distinct().count() > 0
    assert [r.n for r in got.orderBy("place").collect()] == sorted(r.n for r in rows.collect())
    assert plain(got).count() == 1000
