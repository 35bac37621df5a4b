"""Named filters over the event log and the device tables.

All of them are plain Column expressions, so Catalyst can push the simple ones
to the scan and keep the rest inside generated code.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions.cells import Day, day_lit


def in_days(start: Day, end: Day, day: str = "p_date") -> Column:
    return F.col(day).between(day_lit(start), day_lit(end))


def in_trip() -> Column:
    """A trip id is present (NULL and empty both fail)."""
    return F.col("traceid") != ""


def min_version(v: int) -> Column:
    """Client version at least v; a version that is no number fails."""
    return F.col("versioncode").try_cast("int") >= v


def counted_trip() -> Column:
    """In a trip, on a client version that reports trips."""
    return in_trip() & min_version(V.TRIP_MIN_VERSION)


def prod() -> Column:
    return F.col("env") == "prod"


def ended_normally() -> Column:
    return (F.col("tag") == V.RECOVER_END) & F.col("message").startswith(V.ENDED_NORMALLY)


def played(tags: Sequence[str]) -> Column:
    """One of the tags, or a play that ended normally."""
    return F.col("tag").isin(*tags) | ended_normally()


def play_timed(tags: Sequence[str]) -> Column:
    """One of the tags, or any end of play: the rule for play time."""
    return F.col("tag").isin(*tags, V.RECOVER_END)


# Three different meanings of "ad" live side by side in the reports.
def is_ad() -> Column:
    return F.col("adsn") != ""


def blank_ad() -> Column:
    return F.col("adsn") == ""


def no_ad() -> Column:
    return F.coalesce(F.col("adsn"), F.lit("")) == ""


def has_content() -> Column:
    return F.col("contentid") != ""


Excluded = DataFrame | Collection[str] | None


def exclusions(table: DataFrame) -> DataFrame:
    """The excluded devices, each once.  How they are joined is left to the optimizer, whatever their number."""
    return table.filter(F.col("devicename").isNotNull()).select("devicename").distinct()


def known_devices(events: DataFrame, excluded: Excluded) -> DataFrame:
    """Rows of a named device that is not excluded.

    ``excluded`` is a list or a table with the column ``devicename``.  The rule
    is a plain NOT IN, so a row with a NULL device is dropped, also when nothing
    is excluded.
    """
    events = events.filter(F.col("devicename").isNotNull())
    if excluded is None:
        return events
    if isinstance(excluded, DataFrame):
        return events.join(excluded.filter(F.col("devicename").isNotNull()), "devicename", "left_anti")
    return events.filter(~F.col("devicename").isin(*excluded)) if excluded else events


def prod_events(events: DataFrame, excluded: Excluded, start: Day, end: Day) -> DataFrame:
    """Production rows of the day window without test devices."""
    return known_devices(events.filter(in_days(start, end) & prod()), excluded)
