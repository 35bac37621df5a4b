"""Day logs: what is new is read, what was read is not."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.plans.daily import load_scan_logs
from tidemark.sources import logs

D = dt.date
AFTER = D(2024, 1, 1)


def line(day: int, driver: str = "7") -> str:
    return f"2024-01-{day:02d} 08:00:00,1 [INFO ]x submitRequest|home|1|u|s|{driver}"


def put(root, host, folder, day, *lines, suffix=""):
    path = Path(root) / host / folder / f"app.log.2024-01-{day:02d}{suffix}"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{x}\n" for x in lines))


def loaded(spark, path):
    good = spark.read.parquet(path).select("day", "host", "folder", "driver_id").collect()
    return sorted((r.day.day, r.host, r.folder, r.driver_id) for r in good)


def rejects(spark, path):
    return sorted((r.day.day, r.host, r.arrived.day) for r in spark.read.parquet(path + "_rejects").select("day", "host", "arrived").collect())


def test_only_new_files_are_read(spark, tmp_path, monkeypatch):
    root, path = str(tmp_path / "logs"), str(tmp_path / "scan_log")
    read = []
    real = logs.read_files
    monkeypatch.setattr(logs, "read_files", lambda s, p: (read.append(sorted(Path(x).parent.parent.name + Path(x).name[-2:] for x in p)), real(s, p))[1])
    put(root, "a", "goods", 2, line(2), "other line", line(2, "x1"))
    put(root, "b", "goods", 2, line(2, "null"))
    put(root, "b", "goods", 1, line(1))  # not after the first day
    put(root, "b", "goods", 9, line(9))  # not yet
    (tmp_path / "logs" / "readme.txt").write_text("x")
    assert load_scan_logs(spark, root, path, AFTER, D(2024, 1, 4)).end == D(2024, 1, 2) and read == [["a02", "b02"]]
    assert load_scan_logs(spark, root, path, AFTER, D(2024, 1, 4)).empty and len(read) == 1
    assert loaded(spark, path) == [(2, "a", "goods", 7), (2, "b", "goods", None)] and rejects(spark, path) == [(2, "a", 4)]
    # a late file of an old day, a file that has grown, one whose lines are all bad now
    put(root, "c", "goods", 2, line(2, "8"))
    put(root, "a", "goods", 2, line(2), line(2, "9"), line(2, "y22"))
    put(root, "b", "goods", 2, line(2, "bad one"))
    load_scan_logs(spark, root, path, AFTER, D(2024, 1, 6))
    assert read[1:] == [["a02", "b02", "c02"]]
    assert loaded(spark, path) == [(2, "a", "goods", 7), (2, "a", "goods", 9), (2, "c", "goods", 8)]
    assert rejects(spark, path) == [(2, "a", 6), (2, "b", 6)]
    load_scan_logs(spark, root, path, AFTER, D(2024, 1, 12))
    assert read[2:] == [["b09"]] and (9, "b", "goods", 7) in loaded(spark, path)


def test_a_stopped_load_is_repeated(spark, tmp_path, monkeypatch):
    from test_kept import Stop, stop_after

    root = str(tmp_path / "logs")
    put(root, "a", "goods", 2, line(2), line(2, "x1"))
    for writes in range(3):
        path = str(tmp_path / f"t{writes}")
        with monkeypatch.context() as m:
            stop_after(m, writes)
            with pytest.raises(Stop):
                load_scan_logs(spark, root, path, AFTER, D(2024, 1, 4))
        for _ in range(2):
            load_scan_logs(spark, root, path, AFTER, D(2024, 1, 5))
        assert loaded(spark, path) == [(2, "a", "goods", 7)] and rejects(spark, path) == [(2, "a", 5)]


def test_names_of_log_files(spark, tmp_path):
    root = str(tmp_path / "logs")
    put(root, "host=a", "folder=goods-web", 2, line(2))
    put(root, "10.0.0.1", "order-web", 3, line(3))
    put(root, "b", "x", 4, line(4), suffix=".tmp")  # no log file
    got = logs.log_files(spark, root).select("day", "host", "folder").collect()
    assert sorted((r.day.day, r.host, r.folder) for r in got) == [(2, "a", "goods-web"), (3, "10.0.0.1", "order-web")]


def test_a_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_scan_logs(spark, str(tmp_path / "none"), str(tmp_path / "t"), AFTER, D(2024, 1, 4))


@pytest.mark.parametrize("host", ["a", "007"])
def test_lines_are_parsed_once_for_each_table(spark, tmp_path, host):
    """Which logs have lost their rows is told by the files written, not by parsing all lines again."""
    root, path = str(tmp_path / "logs"), str(tmp_path / "scan_log")
    put(root, host, "goods", 2, line(2), line(2, "x1"))
    put(root, host, "order", 2, line(2), line(2, "x1"))
    put(root, host, "order", 3, line(3))
    load_scan_logs(spark, root, path, AFTER, D(2024, 1, 6))
    put(root, host, "goods", 2, line(2, "bad one"))  # no good line any more
    put(root, host, "order", 2, line(2, "8"))  # no bad line any more
    parsed = spark.sparkContext.accumulator(0)
    real = logs.read_files

    def counted(s, paths):
        lines = real(s, paths)

        def count(batches):
            for b in batches:
                parsed.add(b.num_rows)
                yield b
        return lines.mapInArrow(count, lines.schema)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(logs, "read_files", counted)
        load_scan_logs(spark, root, path, AFTER, D(2024, 1, 6))
    assert parsed.value == 2 * 2  # two lines, two tables
    good = spark.read.schema("driver_id bigint, day date, host string, folder string").parquet(path)
    assert sorted((r.day.day, r.host, r.folder, r.driver_id) for r in good.collect()) == [(2, host, "order", 8), (3, host, "order", 7)]
    assert [(r.day.day, r.folder) for r in spark.read.parquet(path + "_rejects").collect()] == [(2, "goods")]


def test_the_end_of_a_path_names_the_log(spark):
    """Whatever stands before the last folders."""
    ends = ["h/m/app.log.2024-01-02", "h/m/app.log.2024-01-02/part-0.txt", "host=h/folder=m/log=app.log.2024-01-02/part-0", "h/m/app.log.2024-01-02.gz",
            "h/m/app.log.2024-01-02.tmp", "m/app.log.2024-01-02", "x/h=1/m/app.log.2024-01-02", "h/m/app.log.2024-01-02/a/b"]
    paths = spark.createDataFrame([(f"{start}{end}",) for end in ends for start in ("", "/", "file:/x/app.log.2023-01-01/", "hdfs://n:1/a/b=c/d/e/f/")], "path string")
    whole = [F.regexp_extract("path", logs.FILE, i) for i in (3, 1, 2)]
    got = paths.select(F.array(*[c.cast("string") for c in logs._log_of(F.col("path"))]).alias("a"), F.array(whole[0].try_cast("date").cast("string"), *whole[1:]).alias("b"))
    assert got.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0 and got.filter("b[0] is not null").count() >= 16
    text = logs.read_files(spark, [__file__])._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_extract(") == text.count("regexp_extract(substring_index(") == 3  # for every line: not the whole path
