"""Trip report by (date, city, car) and the device figures behind it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions import predicates as P
from tidemark.functions.cells import Day
from tidemark.operators.cumulative import State, Step, entities, first_seen, running, whole
from tidemark.operators.frames import fill_keys
from tidemark.operators.presence import count_devices, marks, presence, seen
from tidemark.operators.rollup import roll_up
from tidemark.operators.trips import device_days, with_points

KEYS = ("date", "city_sn", "car_type")


def heartbeat_devices(heartbeat: DataFrame, dim: DataFrame, keys: tuple[str, ...], start: Day, end: Day) -> DataFrame:
    """Distinct devices with a heartbeat per day and dimension attributes."""
    return heartbeats_by(presence(marks(heartbeat=heartbeat.filter(P.in_days(start, end, "day")))), dim, keys)


def heartbeats_by(shown: DataFrame, dim: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The same from ``presence`` rows, which may have signs of other kinds."""
    return count_devices(shown.filter(seen("heartbeat")), dim, keys, {"daily_heartbeat_dev_num": seen("heartbeat")})


def trip_summary(events: DataFrame, excluded: P.Excluded, start: Day, end: Day) -> DataFrame:
    """Trips, seconds, ads, splashes and play time per device and day in trips."""
    days = device_days(P.prod_events(events, excluded, start, end))
    return days.filter(F.col("trip_cnt") > 0).select(
        "devicename", F.col("p_date").alias("date"), "trip_cnt", F.col("trip_time").alias("trip_time_sum"), "ad_cnt",
        "show_video_start", "video_time")


def on_road_devices(events: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day, end: Day) -> DataFrame:
    """Devices with a counted trip, by (date, city, car)."""
    rows = P.prod_events(events, excluded, start, end).filter(P.counted_trip())
    devices = rows.select(F.col("p_date").alias("date"), "devicename").distinct()
    return roll_up(devices, city, KEYS, count="daily_trip_dev_cnt")


def points_of_day(events: DataFrame, snapshot: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day,
                  end: Day) -> DataFrame:
    """Playing points by (date, city, car)."""
    days = with_points(device_days(P.prod_events(events, excluded, start, end)), snapshot, start, end)
    points = days.filter("is_point").select(F.col("p_date").alias("date"), "devicename")
    return roll_up(points, city, KEYS, count="daily_play_dev_cnt")


def fulltime_streams(events: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day, end: Day) -> DataFrame:
    """Stream ads, screensaver ads and play time, in and outside trips."""
    days = device_days(P.prod_events(events, excluded, start, end)).withColumnRenamed("p_date", "date")
    return roll_up(days, city, KEYS, sums=["stream_ad_cnt_fulltime", "screensaver_ad_cnt_fulltime",
                                           "video_time_fulltime"])


def _devices_run(rows: DataFrame, city: DataFrame, start: Day, end: Day, name: str, before: State | None) -> Step:
    """Devices with their first day are kept; they are rolled up where they are bound at the time of the report."""
    devices = first_seen(rows.withColumnRenamed("p_date", "date"), ["devicename"], "date")

    def report(known: DataFrame) -> DataFrame:
        return running(roll_up(known, city, KEYS, count=name), ["city_sn", "car_type"], [name], start, end, "date")

    return entities(devices, ["devicename"], before, report)


def points_total(events: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day, end: Day,
                 history: Day = V.EVENT_HISTORY_START) -> DataFrame:
    """Devices that ever showed a splash, up to each day."""
    return whole(points_run(events, city, excluded, start, end, None, history))


def points_run(events: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day, end: Day, before: State | None,
               history: Day = V.EVENT_HISTORY_START, days: DataFrame | None = None) -> Step:
    """The same from the state that earlier runs kept: then only the window's days are read, or ``days``, their
    ``trips.device_days``, if they are at hand."""
    if before is not None and days is not None:
        rows = days.filter(F.col("splashes_fulltime") > 0)
    else:
        rows = P.prod_events(events, excluded, history if before is None else start, end).filter(F.col("tag") == V.SPLASH)
    return _devices_run(rows, city, start, end, "total_play_dev_cnt", before)


def on_road_total(events: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day, end: Day,
                  history: Day = V.EVENT_HISTORY_START) -> DataFrame:
    """Devices that ever had a counted trip, up to each day."""
    return whole(on_road_run(events, city, excluded, start, end, None, history))


def on_road_run(events: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day, end: Day, before: State | None,
                history: Day = V.EVENT_HISTORY_START, days: DataFrame | None = None) -> Step:
    """The same from the state that earlier runs kept, as ``points_run``."""
    if before is not None and days is not None:
        rows = days.filter(F.col("trip_cnt") > 0)
    else:
        rows = P.prod_events(events, excluded, history if before is None else start, end).filter(P.counted_trip())
    return _devices_run(rows, city, start, end, "total_trip_dev_cnt", before)


def trip_figures(
    days: DataFrame, snapshot: DataFrame, heartbeat: DataFrame, city: DataFrame, start: Day, end: Day,
    special_city: int = V.SPECIAL_CITY, shown: DataFrame | None = None,
) -> DataFrame:
    """Heartbeat groups of each day with all event figures, by the raw keys: one row per (date, city, car), NULLs included.

    ``days`` is ``trips.device_days`` of the window: every event figure comes
    from that one pass and one roll-up.  Groups without a heartbeat are not
    reported.  In the special city the ad count is stream plus screensaver.
    The two cumulative columns are 0 here; ``points_total`` and
    ``on_road_total`` hold the real figures.  ``shown`` is the window's
    ``presence``, if it is at hand; then the heartbeat table is not read.
    """
    if shown is None:
        shown = presence(marks(heartbeat=heartbeat.filter(P.in_days(start, end, "day"))))
    base = heartbeats_by(shown, city, ("city_sn", "car_type")).withColumnRenamed("day", "date")
    facts = with_points(days, snapshot, start, end, special_city).select(
        F.col("p_date").alias("date"), "devicename",
        (F.col("trip_cnt") > 0).cast("bigint").alias("daily_trip_dev_cnt"),
        F.col("is_point").cast("bigint").alias("daily_play_dev_cnt"),
        "ad_cnt", "show_video_start", "trip_cnt", F.col("trip_time").alias("trip_time_sum"), "video_time",
        "stream_ad_cnt_fulltime", "screensaver_ad_cnt_fulltime", "video_time_fulltime",
    )
    measures = [c for c in facts.columns if c not in ("date", "devicename")]
    joined = base.join(roll_up(facts, city, KEYS, sums=measures), list(KEYS), "left").fillna(0, subset=measures)
    ads = F.when(F.col("city_sn") == special_city,
                 F.col("stream_ad_cnt_fulltime") + F.col("screensaver_ad_cnt_fulltime")).otherwise(F.col("ad_cnt"))
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "date", "city_sn", "car_type",
        "daily_trip_dev_cnt", "daily_play_dev_cnt", zero.alias("total_trip_dev_cnt"), zero.alias("total_play_dev_cnt"),
        ads.alias("ad_cnt"), "show_video_start", "trip_cnt", "trip_time_sum", "video_time", "daily_heartbeat_dev_num",
        "stream_ad_cnt_fulltime", "screensaver_ad_cnt_fulltime", "video_time_fulltime",
    )


def trip_labels(figures: DataFrame) -> DataFrame:
    """The trip report: the figures with 0 in place of a missing city or car."""
    return fill_keys(figures, city_sn=0, car_type="0")


def trip_day(days: DataFrame, snapshot: DataFrame, heartbeat: DataFrame, city: DataFrame, start: Day, end: Day,
             special_city: int = V.SPECIAL_CITY) -> DataFrame:
    """The trip report of a window; see ``trip_figures``."""
    return trip_labels(trip_figures(days, snapshot, heartbeat, city, start, end, special_city))
