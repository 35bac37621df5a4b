"""Tab clicks, video and banner clicks, raw scan extract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions import predicates as P
from tidemark.functions.cells import Day, blank_to_zero
from tidemark.operators.rollup import roll_up


def tab_clicks(events: DataFrame, city: DataFrame, excluded: P.Excluded, start: Day, end: Day) -> DataFrame:
    """Clicks, trips and devices by (date, city, car, tab target)."""
    rows = P.prod_events(events, excluded, start, end).filter(P.counted_trip() & (F.col("tag") == V.TAB_CLICK))
    per_device = rows.groupBy(
        F.col("p_date").alias("date"), "devicename", F.col("targetvalue").alias("__raw"),
        blank_to_zero(F.col("targetvalue")).alias("targetvalue"),
    ).agg(F.count(F.lit(1)).alias("click_times"), F.count_distinct("traceid").alias("click_trip_cnt"))
    keys = ["date", "city_sn", "car_type", "targetvalue"]
    rolled = roll_up(per_device, city, keys, sums=["click_times", "click_trip_cnt"], count="click_dev_cnt")
    return rolled.select(*keys, "click_times", "click_trip_cnt", "click_dev_cnt")


def video_clicks(events: DataFrame, excluded: P.Excluded, start: Day, end: Day) -> DataFrame:
    """Trips and clicks on video details and banners by (date, tag, page, value)."""
    rows = P.prod_events(events, excluded, start, end).filter(
        P.in_trip() & P.min_version(V.CLICK_MIN_VERSION)
        & F.col("tag").isin("click_video_detail", "video_banner_click"))
    grouped = rows.groupBy(F.col("p_date").alias("date"), "tag", "page", "currentvalue").agg(
        F.count_distinct("traceid").alias("click_trip_cnt"), F.count(F.lit(1)).alias("click_cnt"))
    return grouped.withColumns({c: blank_to_zero(F.col(c)) for c in ("page", "currentvalue")})


def scan_extract(events: DataFrame, excluded: P.Excluded, start: Day, end: Day) -> DataFrame:
    """One row per scan; no scans give an empty result."""
    rows = P.prod_events(events, excluded, start, end).filter(F.col("event") == "SCAN")
    return rows.select(
        *[blank_to_zero(F.col(c)).alias(c) for c in ("utmsource", "utmcampaign", "utmcontent")],
        F.col("p_date").alias("date"))
