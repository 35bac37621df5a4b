"""Trip summaries and device-day facts from one pass over the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions import predicates as P
from tidemark.functions.cells import flag

TRIP_MEASURES = ("trip_cnt", "trip_time", "ad_cnt", "ad_cnt_ended", "show_video_start", "video_time")
FULLTIME_MEASURES = ("stream_ad_cnt_fulltime", "screensaver_ad_cnt_fulltime", "stream_ad_ended_fulltime",
                     "video_time_fulltime")


def device_days(events: DataFrame) -> DataFrame:
    """One row per (device, day) with the in-trip and the full-time figures.

    ``events`` are production rows (see ``predicates.prod_events``).  A trip is
    (device, trip id, day): one that runs past midnight is two trips.  The rows
    of a day outside any counted trip share one group, which combines on the map
    side.  Two definitions of "ad" are kept: begin of content (``ad_cnt``) and
    ended normally (``ad_cnt_ended``).
    """
    tag = F.col("tag")
    splash, recover = tag == V.SPLASH, tag == V.RECOVER_END
    begin_ad = (tag == V.CONTENT_BEGIN) & P.is_ad()
    ended_ad = P.ended_normally() & P.is_ad()
    trip = F.col("__trip").isNotNull()

    by_trip = (
        events.withColumn("__trip", F.when(P.counted_trip(), F.col("traceid")))
        .groupBy("devicename", "p_date", "__trip")
        .agg(
            F.min("time_stamp").alias("t0"),
            F.max("time_stamp").alias("t1"),
            F.count_if(flag(begin_ad)).alias("begin_ads"),
            F.count_if(flag(ended_ad)).alias("ended_ads"),
            F.count_if(flag(splash)).alias("splashes"),
            F.count_if(flag(tag == V.SCREENSAVER)).alias("savers"),
            F.sum(F.when(recover, F.col("playtime"))).alias("played"),
            F.bool_or(flag(tag.isin(V.SPLASH, V.CONTENT_BEGIN) & P.in_trip())).alias("point_in_trip"),
            F.bool_or(flag(tag.isin(V.SCREENSAVER, V.CONTENT_BEGIN))).alias("point_any"),
        )
    )

    def in_trip_sum(c):
        return F.coalesce(F.sum(F.when(trip, c)), F.lit(0))

    return by_trip.groupBy("devicename", "p_date").agg(
        F.count("__trip").alias("trip_cnt"),
        # whole milliseconds are summed, so the result does not depend on task order
        (in_trip_sum(F.col("t1") - F.col("t0")) / 1000).alias("trip_time"),
        in_trip_sum(F.col("begin_ads") + F.col("splashes")).alias("ad_cnt"),
        in_trip_sum(F.col("ended_ads") + F.col("splashes")).alias("ad_cnt_ended"),
        in_trip_sum(F.col("splashes")).alias("show_video_start"),
        in_trip_sum(F.col("played")).alias("video_time"),
        F.sum("begin_ads").alias("stream_ad_cnt_fulltime"),
        F.sum("savers").alias("screensaver_ad_cnt_fulltime"),
        F.sum("ended_ads").alias("stream_ad_ended_fulltime"),
        F.coalesce(F.sum("played"), F.lit(0)).alias("video_time_fulltime"),
        F.sum("splashes").alias("splashes_fulltime"),
        F.bool_or("point_in_trip").alias("point_in_trip"),
        F.bool_or("point_any").alias("point_any"),
    )


def with_points(days: DataFrame, snapshot: DataFrame, start, end, special_city: int = V.SPECIAL_CITY) -> DataFrame:
    """Add ``is_point``: the device counted as a playing point that day.

    A device counts when the device snapshot of the window lists it (on any day)
    and it showed a splash or content in a trip, or, in the special city, a
    screensaver or content at any time.
    """
    listed = (
        snapshot.filter(P.in_days(start, end))
        .groupBy("devicename").agg(F.bool_or(flag(F.col("city_sn") == special_city)).alias("__special"))
    )
    return days.join(listed, "devicename", "left").withColumn(
        "is_point",
        flag(F.col("__special").isNotNull() & (F.col("point_in_trip") | (F.col("point_any") & F.col("__special")))),
    ).drop("__special")
