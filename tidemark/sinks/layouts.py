"""Column order of the report tables, with the columns no longer computed.

A placeholder column is 0, or NULL where the table holds NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ZERO, EMPTY = object(), object()

LAYOUTS: dict[str, list] = {
    "content_play_day": [
        "date", "contentid", "tag", "play_dev_cnt", "play_trip_cnt", "play_cnt", "scan_cnt",
        ("total_play_dev_cnt", ZERO), ("total_play_cnt", ZERO), ("total_scan_cnt", ZERO), "play_time",
        ("total_play_time", ZERO)],
    "ad_play_day": [
        "date", "city_sn", "car_type", "contentid", "tag", "play_dev_cnt", "play_trip_cnt", "play_cnt",
        ("total_play_dev_cnt", ZERO), ("total_play_trip_cnt", ZERO), ("total_play_cnt", ZERO), "play_time",
        ("total_play_time", ZERO)],
    "ad_play_fulltime": [
        "date", "city_sn", "car_type", "contentid", "tag", "play_dev_cnt", "play_cnt", ("total_play_dev_cnt", ZERO),
        ("total_play_cnt", ZERO), "play_time", ("total_play_time", ZERO)],
    "agent_day": [
        "day", "parent_id", "total_dev_num", "total_trip_dev_num", ("total_play_dev_cnt", EMPTY),
        ("normal_dev_num", EMPTY), "daily_trip_dev_num", "daily_online_dev_num", "daily_play_dev_num", "trip_cnt",
        "trip_time_total", "ad_cnt", "show_video_start", "video_time", "total_heartbeat_dev_num",
        "daily_heartbeat_dev_num", "stream_ad_cnt_fulltime", "video_time_fulltime"],
}


def to_layout(df: DataFrame, report: str) -> DataFrame:
    """The report in the column order of its table."""
    fill = {ZERO: F.lit(0).cast("bigint"), EMPTY: F.lit(None).cast("bigint")}
    cols = [fill[c[1]].alias(c[0]) if isinstance(c, tuple) else F.col(c) for c in LAYOUTS[report]]
    return df.select(*cols)
