"""Report tables as parquet, one partition per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.cells import Day, day_lit


MISSING, NO_ROWS = "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"
#: Folders that the versions of a refreshed table take in turn: the newest, and those that readers may still have open.
SLOTS = 3


def _read(spark: SparkSession, path: str) -> DataFrame | str:
    """A table as it stands, or why there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in (MISSING, NO_ROWS):
            return e.getCondition()
        raise


def _version(spark: SparkSession, path: str) -> int | None:
    """The newest complete version of a refreshed table."""
    table = _read(spark, f"{path}/published")
    return None if isinstance(table, str) else table.agg(F.max("version")).first()[0]


def _table(spark: SparkSession, path: str) -> DataFrame | str:
    version = _version(spark, path)
    return _read(spark, path if version is None else f"{path}/versions/{version % SLOTS}")


def read_report(spark: SparkSession, path: str) -> DataFrame | None:
    """A report table (its newest complete version, if it is refreshed), or None when it has no rows yet."""
    table = _table(spark, path)
    return None if isinstance(table, str) else table


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a report was ever loaded, with rows or without."""
    table = _table(spark, path)
    return not isinstance(table, str) or table != MISSING


def read_loaded(like: DataFrame, path: str) -> DataFrame:
    """A report table that an earlier load has written; no rows of the same shape where it had none.

    A table that was never loaded is an error: a wrong folder must not read as "no rows"."""
    table = _table(like.sparkSession, path)
    if isinstance(table, str):
        if table == MISSING:
            raise FileNotFoundError(f"{path} was never loaded")
        return like.sparkSession.createDataFrame([], like.schema)
    return table


def _by_day(df: DataFrame, day: str, sort: Sequence[str] = ()) -> DataFrame:
    # Rebalancing writes few files per day and still splits a day that is too big for one task.
    # Rows are sorted within a file only, so no total order has to be shuffled for.
    return df.hint("rebalance", F.col(day)).sortWithinPartitions(day, *sort)


def append_days(df: DataFrame, path: str, day: str = "day", sort: Sequence[str] = ()) -> None:
    """Add rows; a table of days and nothing else is not partitioned."""
    if df.columns == [day]:
        df.coalesce(1).write.mode("append").parquet(path)
    else:
        _by_day(df, day, sort).write.mode("append").partitionBy(day).parquet(path)


def _files(spark: SparkSession, path: str, start: Day, end: Day, day: str) -> dict:
    """A file name per day that holds rows: one small value per day of the
    window.  Reads no column, only what is kept about the files."""
    table = read_report(spark, path)
    if table is None:
        return {}
    rows = table.filter(F.col(day).between(day_lit(start), day_lit(end)))
    return {r[0]: r[1] for r in rows.groupBy(day).agg(F.max("_metadata.file_path")).collect()}


def replace_days(df: DataFrame, path: str, start: Day, end: Day, day: str = "day", sort: Sequence[str] = ()) -> None:
    """Make the days [start, end] of the table hold exactly the rows of ``df``.

    Running it again gives the same table.  A day that had rows and has none any
    more is emptied; a dynamic overwrite alone would leave it as it was.
    """
    spark = df.sparkSession
    rows = df.filter(F.col(day).between(day_lit(start), day_lit(end)))
    before = _files(spark, path, start, end, day)
    (_by_day(rows, day, sort).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day).parquet(path))
    after = _files(spark, path, start, end, day) if before else {}
    for d in [d for d, name in before.items() if after.get(d) == name]:
        empty = spark.createDataFrame([], rows.drop(day).schema)
        empty.coalesce(1).write.mode("overwrite").parquet(f"{path}/{day}={d}")


def refresh(df: DataFrame, path: str, order: Sequence[str | Column] = ()) -> None:
    """Replace the whole table, in a total order over its files if one is given.

    Rows go to a folder that no reader uses, and a small file that names the version makes it the table; a refresh that stops
    before leaves the table as it was.  Read it with ``read_report``.
    """
    spark = df.sparkSession
    version = (_version(spark, path) or 0) + 1
    place = f"{path}/versions/{version % SLOTS}"
    write_ordered(df, place, order) if order else df.write.mode("overwrite").parquet(place)
    spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{path}/published")


def write_ordered(df: DataFrame, path: str, order: Sequence[str | Column]) -> None:
    """Write rows in one order over all files: ranges of the keys are dealt to tasks, each sorts its own, and files are
    numbered in the order of the ranges."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)


def read_ordered(df: DataFrame) -> DataFrame:
    """The rows of a table read from ordered files, with ``place``: 1 for the first row of the first file, and so on.

    Only one small row per file is put in order in one place."""
    number = [F.regexp_extract("_metadata.file_name", pattern, 1).cast("bigint") for pattern in (r"^part-(\d+)", r"-c(\d+)\.")]
    rows = df.select("*", F.struct(*[F.coalesce(n, F.lit(0)).alias(f"n{i}") for i, n in enumerate(number)]).alias("__file"),
                     F.col("_metadata.row_index").alias("__row"))
    files = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return rows.join(files, "__file").select(*df.columns, (F.col("__before") + F.col("__row") + 1).alias("place"))


def _part_files(like: DataFrame, path: str, parts: Sequence[str], values: Sequence[Sequence[object]]) -> dict:
    """A file name per partition that holds rows, for partitions that share their first part with ``values``.  Reads no column,
    only what is kept about the files."""
    spark = like.sparkSession
    if not values or isinstance(_read(spark, path), str):
        return {}
    table = spark.read.schema(like.schema).parquet(path)  # the parts keep their types: a host may be called 007
    rows = table.filter(F.col(parts[0]).isin(list({v[0] for v in values}))).groupBy(*parts).agg(F.max("_metadata.file_path"))
    return {tuple(map(str, r[:-1])): r[-1] for r in rows.collect()}


def replace_parts(df: DataFrame, path: str, parts: Sequence[str], changed: Sequence[Sequence[object]] = ()) -> None:
    """Make the partitions that ``df`` has rows of hold exactly these rows, and empty those of ``changed`` that it has none of.

    ``df`` is computed once: partitions whose files are still there after the write had no rows in it.
    """
    spark = df.sparkSession
    before = _part_files(df, path, parts, changed)
    # few files per partition, and a large one is split
    df.hint("rebalance", *map(F.col, parts)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    after = _part_files(df, path, parts, changed) if before else {}
    for values in changed:  # files that were read before and have no such rows any more: few
        part = tuple(map(str, values))
        if part in before and after.get(part) == before[part]:
            empty = spark.createDataFrame([], df.drop(*parts).schema)
            empty.coalesce(1).write.mode("overwrite").parquet("/".join([path, *[f"{p}={v}" for p, v in zip(parts, values)]]))


def high_water_mark(spark: SparkSession, path: str, default: Day, day: str = "day"):
    """Last day held by a table, or the default for an empty one.  Only the
    partition column is read."""
    table = read_report(spark, path)
    if table is None:
        return default
    return table.agg(F.max(F.col(day).cast("date"))).first()[0] or default
