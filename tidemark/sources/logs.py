"""Scan records from application logs.

A record line reads ``<time>,<ms> [INFO ]... submitRequest...|module|tel|user|shelf|driver``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cells import null_text, strip

# Fixed values of the log format.
MARKER = "submitRequest"
LEVEL = "[INFO ]"
MODULE, USER_TEL, USER_ID, SHELF, DRIVER = 1, 2, 3, 4, 5


#: The day's log of a module on a host: ``<host>/<module>/app.log.<day>``, a file or a folder of files; folders may be
#: named ``key=value``.
FILE = r"(?:^|/)(?:[^/=]+=)?([^/=]+)/(?:[^/=]+=)?([^/=]+)/(?:[^/=]+=)?app\.log\.(\d{4}-\d{2}-\d{2})(?:\.gz)?(?:/[^/]+)?$"
LOG = ("day", "host", "folder")


DEEP = 4  # folders and names that FILE looks at, from the end of a path


def _log_of(path: Column) -> list[Column]:
    """Day, host and module folder of a log file, from its name.  Every line asks for them, so only the end of the path is searched."""
    host, folder, day = [F.regexp_extract(F.substring_index(path, "/", -DEEP), FILE, i) for i in (1, 2, 3)]
    return [day.try_cast("date").alias("day"), host.alias("host"), folder.alias("folder")]


def log_files(spark: SparkSession, root: str) -> DataFrame:
    """The log files under ``root``: day, host, folder, path, size.  Names are listed, nothing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(*_log_of(F.col("path")), "path", F.col("length").alias("size")).filter(F.col("day").isNotNull())


def unread_logs(files: DataFrame, read: DataFrame | None) -> DataFrame:
    """All files of the logs that have a new file or one of another size: what is read is a day's log of a module and host,
    as a whole.  ``known`` tells that some of it was read before."""
    if read is None:
        return files.withColumn("known", F.lit(False))
    fresh = files.join(read.select("path", "size"), ["path", "size"], "left_anti").select(*LOG).distinct()
    old = read.select(*LOG).distinct().withColumn("known", F.lit(True))
    return files.join(fresh, list(LOG), "left_semi").join(old, list(LOG), "left").fillna(False, subset=["known"])


def read_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The lines of log files as one distributed read, with day, host and folder of their file."""
    return spark.read.text(list(paths)).select("value", *_log_of(F.col("_metadata.file_path")))


def parse_scan_lines(lines: DataFrame, line: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Marked lines split into fields, with ``ok`` telling good from bad; columns to ``keep`` go along.

    The word null in a field is no value.  A line is bad when it has too few
    fields, a driver that is no whole number, or a time that cannot be read.
    """
    clean = strip(F.replace(F.col(line), F.lit(LEVEL), F.lit("")))
    marked = lines.filter(F.col(line).contains(MARKER)).select(clean.alias("line"), *keep)
    # Split once: the fields are read off a generated column, which no filter is pushed below.
    split = marked.select("line", *keep, F.explode(F.array(F.split("line", r"\|"))).alias("parts"))

    def field(i: int) -> Column:
        return F.get("parts", F.lit(i))

    driver = null_text(field(DRIVER))
    time = F.substring_index("line", ",", 1).try_cast("timestamp_ntz")
    return split.select(
        field(MODULE).alias("module"),
        null_text(field(USER_TEL)).alias("user_tel"),
        null_text(field(USER_ID)).alias("user_id"),
        null_text(field(SHELF)).alias("shelf_sn"),
        driver.try_cast("bigint").alias("driver_id"),
        time.alias("add_time"),
        ((F.size("parts") > DRIVER) & time.isNotNull() & (driver.isNull() | driver.try_cast("bigint").isNotNull())).alias("ok"),
        "line", *keep,
    )


def scan_log(parsed: DataFrame) -> DataFrame:
    return parsed.filter("ok").drop("ok", "line")


def scan_log_rejects(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return parsed.filter("not ok").select("line", *keep)
